import pytest
from pyspark.sql import functions as F

from lendlens.operators import report, thinfile


def test_floor_is_strict(spark):
    flags = spark.range(100).select(F.col("id").alias("k"), (F.col("id") < 9).alias("is_thin"))
    more = thinfile.with_floor(flags, "k", "is_thin").filter("is_thin")
    assert more.count() > 9 and more.filter("k < 9").count() == 9
    ten = spark.range(100).select(F.col("id").alias("k"), (F.col("id") < 10).alias("is_thin"))
    assert thinfile.with_floor(ten, "k", "is_thin").filter("is_thin").count() == 10


def test_family_mask_prefers_history_rule(spark):
    df = spark.createDataFrame(
        [(i, [0.0 if i < 20 else 1.0, float(i), 0.0]) for i in range(100)], "k bigint, f array<double>"
    )
    by_history = thinfile.mask_family(df, "k", "f", ["BUREAU_X", "AMT_Y", "Z"])
    assert {r["k"] for r in by_history.filter("is_thin").collect()} == set(range(20))
    by_amount = thinfile.mask_family(df, "k", "f", ["OTHER", "AMT_Y", "Z"])
    assert {r["k"] for r in by_amount.filter("is_thin").collect()} == set(range(20))  # strictly below 19.8
    none = thinfile.mask_family(df, "k", "f", ["P", "Q", "Z"], floor=False)
    assert none.filter("is_thin").count() == 0


def test_spread_mask(spark):
    df = spark.createDataFrame([(i, [0.0, float(i)]) for i in range(11)], "k bigint, f array<double>")
    for stat in ("std", "var"):
        thin = thinfile.mask_spread(df, "k", "f", stat, floor=False).filter("is_thin")
        assert {r["k"] for r in thin.collect()} == {0, 1}


def test_no_history_mask(spark):
    got = thinfile.mask_no_history(
        spark.range(4).toDF("k"), spark.createDataFrame([(1,), (1,), (3,)], "k bigint"), "k"
    ).collect()
    assert {r["k"] for r in got if r["is_thin"]} == {0, 2}


def test_empty_and_one_class_slices(spark):
    df = spark.createDataFrame(
        [(i, i % 2, i / 10, m, m == "thin") for i in range(8) for m in ("thin", "regular")],
        "k bigint, y int, s double, m string, is_thin boolean",
    )
    got = {r["m"]: r for r in thinfile.slice_metrics(df, "k", "s", "y", "is_thin", ["m"]).collect()}
    assert got["thin"]["auc_regular"] == 0 and got["thin"]["acceptance_regular"] == 0
    assert got["thin"]["auc_thin_file"] == pytest.approx(0.625)
    one = df.withColumn("y", F.lit(1))
    assert thinfile.slice_metrics(one, "k", "s", "y", "is_thin", ["m"]).filter("m = 'thin'").first()["auc_thin_file"] is None


def test_profile(spark):
    df = spark.createDataFrame([(True, 1), (True, 0), (False, 0), (False, 0)], "f boolean, y int")
    r = thinfile.profile(df, "f", "y").first()
    assert tuple(r) == (2, 2, 0.5, 0.5, 0.0)


@pytest.fixture
def results(spark):
    rows = [
        ("A", "all", 0.8, 0.9), ("A", "traditional", 0.7, 0.6), ("A", "alternative", 0.75, 0.7),
        ("SVM", "traditional", 0.6, 0.5), ("SVM", "alternative", 0.55, 0.4),
        ("C", "all", 0.8, 0.3), ("C", "alternative", 0.5, 0.2),
    ]
    return spark.createDataFrame(rows, "model_name string, feature_set string, auc_score double, acceptance_rate double")


def test_rankings(results):
    assert [r["model_name"] for r in report.top(results, 2).collect()] == ["A", "C"]
    assert report.best(results, "acceptance_rate").first()["model_name"] == "A"
    pivot = {r["model_name"]: r for r in report.metric_pivot(results, "auc_score").collect()}
    assert pivot["SVM"]["all"] is None and pivot["A"]["alternative"] == 0.75
    avg = {r["feature_set"]: r["auc_score"] for r in report.averages(results).collect()}
    assert avg["alternative"] == pytest.approx(0.6)


def test_family_tables(results):
    diff = {r["model_name"]: r for r in report.family_difference(results).collect()}
    assert set(diff) == {"A", "SVM"} and diff["SVM"]["acceptance_difference"] == pytest.approx(-0.1)
    impact = report.alternative_impact(results.withColumnRenamed("auc_score", "auc"))
    by = {r["model"]: r for r in impact.collect()}
    assert set(by) == {"A", "SVM"} and by["SVM"]["auc_all"] == 0.0
    summary = report.impact_summary(impact).first()
    assert summary["mean_improvement"] == pytest.approx(0.0) and summary["best_model"] == "A"
    gains = report.thin_family_gain(results.withColumnRenamed("auc_score", "auc_thin_file")).collect()
    assert {(r["model_name"], r["comparison"]) for r in gains} == {
        ("A", "alternative_vs_traditional"), ("A", "all_vs_traditional"), ("SVM", "alternative_vs_traditional")
    }
    assert all(r["same_rows"] == (r["comparison"] == "all_vs_traditional") for r in gains)


def test_consolidated(results):
    thin = results.selectExpr(
        "model_name", "feature_set", "0.5D AS auc_thin_file", "0.1D AS auc_difference", "0.4D AS acceptance_thin_file"
    )
    full = results.selectExpr("*", "0.3D AS threshold", "0.05D AS actual_bad_rate")
    out = report.consolidated(full, thin).collect()
    assert len(out) == 7 and out[0]["auc_score"] == 0.8
    assert {r["category"] for r in out if r["model_name"] == "SVM"} == {"Others"}
