import pytest
from pyspark.sql import functions as F

from lendlens.operators.clean import clean, derive
from lendlens.operators.rollup import build_mart, payment_features, rollup_numeric, status_rollup
from lendlens.plans.mart import applicant_mart


def test_rollup_groups_and_empty_groups(spark):
    df = spark.createDataFrame(
        [(1, 10, 2.0, "x"), (1, 11, 4.0, "y"), (2, 12, None, "z"), (None, 13, 9.0, "z")],
        "SK_ID_CURR bigint, SK_ID_PREV bigint, AMT double, KIND string",
    )
    got = {r["SK_ID_CURR"]: r.asDict() for r in rollup_numeric(df, "SK_ID_CURR", "PREV", ("SK_ID_PREV",)).collect()}
    assert set(got) == {1, 2}
    assert got[1] == {"SK_ID_CURR": 1, "PREV_AMT_mean": 3.0, "PREV_AMT_max": 4.0, "PREV_AMT_min": 2.0}
    assert got[2]["PREV_AMT_mean"] == 0.0


def test_status_rollup_counts_text_zero(spark):
    df = spark.createDataFrame(
        [(1, -1, "0"), (1, -3, "C"), (1, -2, "0"), (2, -1, "1")], "SK_ID_BUREAU bigint, MONTHS_BALANCE bigint, STATUS string"
    )
    got = {r[0]: tuple(r)[1:] for r in status_rollup(df, "SK_ID_BUREAU").collect()}
    assert got == {1: (-3, -1, -2.0, 2), 2: (-1, -1, -1.0, 0)}


def test_payment_ratio_without_divisor(spark):
    df = spark.createDataFrame([(10.0, -0.0001), (10.0, 5.0), (None, 5.0)], "AMT_PAYMENT double, AMT_INSTALMENT double")
    got = payment_features(df).select("PAYMENT_DIFF", "PAYMENT_RATIO").collect()
    assert got[0]["PAYMENT_RATIO"] is None
    assert got[1]["PAYMENT_DIFF"] == 5.0 and got[1]["PAYMENT_RATIO"] == pytest.approx(10 / 5.0001)
    assert got[2]["PAYMENT_DIFF"] is None


def test_mart_keeps_every_applicant_and_ignores_nan(spark):
    app = spark.createDataFrame([(1, 0), (2, 1)], "SK_ID_CURR bigint, TARGET int")
    prev = spark.createDataFrame(
        [(1, 5, 3.0), (1, 6, float("nan")), (9, 7, 1.0)], "SK_ID_CURR bigint, SK_ID_PREV bigint, AMT_X double"
    )
    mart = applicant_mart({"application": app, "previous_application": prev})
    got = {r["SK_ID_CURR"]: r["PREV_AMT_X_mean"] for r in mart.collect()}
    assert got == {1: 3.0, 2: None}
    assert not [c for c in mart.columns if c.startswith(("BUREAU", "CC", "POS", "INST"))]


def test_build_mart_has_one_row_per_applicant(spark):
    app = spark.range(5).withColumnRenamed("id", "k")
    side = spark.range(3).select(F.col("id").alias("k"), F.lit(1).alias("x"))
    assert build_mart(app, [side, side.withColumnRenamed("x", "y")], "k").count() == 5


def test_derive_only_what_exists(spark):
    df = spark.createDataFrame([(1, 0.4, -3652.5)], "SK_ID_CURR bigint, EXT_SOURCE_2 double, DAYS_BIRTH double")
    row = derive(df).first().asDict()
    assert row["AGE_YEARS"] == 10.0 and row["EXT_SOURCE_MEAN"] == 0.4 and row["EXT_SOURCE_STD"] is None
    assert "CREDIT_INCOME_RATIO" not in row and "DAYS_EMPLOYED_PERCENT" not in row


def test_clean_fills_numbers_and_text(spark):
    df = spark.createDataFrame(
        [(float("inf"), float("nan"), None, None, None), (1.5, -2.0, 3, "a b", 7)],
        "a double, b double, c int, `d/e` string, k int",
    )
    rows = [tuple(r) for r in clean(df, keep=("k",)).collect()]
    assert rows == [(0.0, 0.0, 0, "0", None), (1.5, -2.0, 3, "a b", 7)]
