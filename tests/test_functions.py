import math

import pytest
from pyspark.sql import functions as F

from lendlens.functions import hashed_int, hashed_uniform, row_stats, safe_ratio, vector_spread, yeo_johnson, years


def test_row_stats_skip_nulls(spark):
    df = spark.createDataFrame(
        [(1, 0.5, None, 0.7), (2, None, None, 0.4), (3, None, None, None), (4, 0.1, 0.2, 0.6)],
        "id int, a double, b double, c double",
    )
    got = {r["id"]: r for r in df.select("id", *[v.alias(k) for k, v in row_stats([F.col(c) for c in "abc"]).items()]).collect()}
    assert got[1]["mean"] == pytest.approx(0.6) and got[1]["std"] == pytest.approx(0.141421, abs=1e-6)
    assert (got[2]["mean"], got[2]["std"], got[2]["min"], got[2]["max"]) == (0.4, None, 0.4, 0.4)
    assert all(got[3][k] is None for k in ("mean", "std", "min", "max"))
    assert got[4]["mean"] == pytest.approx(0.3) and got[4]["std"] == pytest.approx(0.264575, abs=1e-6)


@pytest.mark.parametrize(
    ("x", "lam", "want"),
    [
        (-2, 0.5, -2.797435), (-2, 0, -4), (-2, 2, -1.098612),
        (0, 0.5, 0), (0, 0, 0), (0, 2, 0),
        (3, 0.5, 2), (3, 0, 1.386294), (3, 2, 7.5),
        (3, 5e-17, 1.386294),
    ],
)
def test_yeo_johnson_fixed(spark, x, lam, want):
    got = spark.range(1).select(yeo_johnson(F.lit(float(x)), F.lit(float(lam)))).first()[0]
    assert got == pytest.approx(want, abs=1e-6)


def test_ratio_and_years(spark):
    df = spark.createDataFrame([(5.0, -1.0, -730.5, 100)], "a double, b double, d double, e int")
    row = df.select(
        safe_ratio(F.col("a"), F.col("b"), 1.0), years(F.col("d")), years(F.col("e"), floor_zero=True),
        years(F.lit(None).cast("int"), floor_zero=True),
    ).first()
    assert tuple(row) == (None, 2.0, 0.0, None)


def test_hashes_do_not_depend_on_partitioning(spark):
    draw = [hashed_uniform(F.col("id"), 42), hashed_int(F.col("id"), "x", 17)]
    one = spark.range(200).select("id", *draw).collect()
    other = spark.range(200).repartition(7).select("id", *draw).collect()
    assert sorted(one) == sorted(other)
    assert all(0 <= r[1] < 1 and 0 <= r[2] < 17 for r in one)


def test_vector_spread(spark):
    df = spark.createDataFrame([([1.0, 2.0, 4.0],)], "v array<double>")
    assert df.select(vector_spread(F.col("v"))).first()[0] == pytest.approx(1.247219, abs=1e-6)
    assert df.select(vector_spread(F.col("v"), "var")).first()[0] == pytest.approx(math.pow(1.247219, 2), abs=1e-5)
    with pytest.raises(ValueError):
        vector_spread(F.col("v"), "range")
