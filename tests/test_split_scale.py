import math

import pytest
from pyspark.sql import functions as F

from lendlens.operators import scale, split


@pytest.mark.parametrize("n", [7, 100, 1003])
def test_split_sizes_and_shares(spark, n):
    df = spark.range(n).select(F.col("id").alias("k"), (F.col("id") % 11 == 0).cast("int").alias("t"))
    got = split.stratified(df, "k", "t").groupBy("t", "is_val").count().collect()
    sizes = {(r["t"], r["is_val"]): r["count"] for r in got}
    assert sum(v for (_, val), v in sizes.items() if val) == math.ceil(0.2 * n)
    rare = math.ceil(n / 11)
    assert abs(sizes.get((1, False), 0) - rare * 0.8) <= 1


def test_split_does_not_depend_on_partitioning_or_prefix(spark, monkeypatch):
    df = spark.range(3000).select(F.col("id").alias("k"), (F.col("id") % 9 == 0).cast("int").alias("t"))
    one = {r["k"]: r["is_val"] for r in split.stratified(df, "k", "t").collect()}
    monkeypatch.setattr(split, "ROWS_PER_PREFIX", 5)
    other = {r["k"]: r["is_val"] for r in split.stratified(df.repartition(9), "k", "t").collect()}
    assert one == other


def test_copies_of_an_id_stay_together(spark):
    df = spark.range(900).select(
        F.when(F.col("id") < 300, 7).when(F.col("id") < 310, None).otherwise(F.col("id")).alias("k"), F.lit(0).alias("t")
    )
    got = split.stratified(df, "k", "t")
    assert got.groupBy("k").agg(F.count_distinct("is_val").alias("n")).filter("n <> 1").count() == 0
    assert got.filter("is_val").count() + got.filter("NOT is_val").count() == 900


def test_split_moves_no_rows(spark):
    df = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") % 9 == 0).cast("int").alias("t"))
    plan = split.stratified(df, "k", "t")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan


def test_quotas_go_to_the_largest_remainder():
    assert split.train_quotas({0: 95, 1: 5}) == {0: 76, 1: 4}
    assert split.train_quotas({0: 282686, 1: 24825}) == {0: 226148, 1: 19860}
    assert sum(split.train_quotas({0: 6, 1: 3}).values()) == 7


def test_scaler_is_population_and_constant_is_zero(spark):
    df = spark.createDataFrame([(1.0, 0.1), (2.0, 0.1), (4.0, 0.1)], "x double, c double")
    fitted = scale.fit_scaler(df, ["x", "c"])
    assert fitted.stds[0] == pytest.approx(1.247219, abs=1e-6) and fitted.stds[1] == 0.0
    rows = scale.scale_columns(df, fitted).collect()
    assert [round(r["c"], 12) for r in rows] == [0, 0, 0]
    assert sum(r["x"] for r in rows) == pytest.approx(0) and sum(r["x"] ** 2 for r in rows) / 3 == pytest.approx(1)
    array = scale.scale_to_array(df, fitted.subset(["x"]), []).collect()
    assert [r["features"][0] for r in array] == [r["x"] for r in rows]


def test_scaler_table_roundtrip(spark):
    fitted = scale.Scaler(("b", "a"), (1.0, 2.0), (0.5, 0.0))
    assert scale.scaler_from_table(fitted.table(spark)) == fitted


def test_vector_scaler(spark):
    df = spark.createDataFrame([([1.0, 5.0],), ([3.0, 5.0],)], "v array<double>")
    fitted = scale.fit_vector_scaler(df, "v", 2)
    assert [r["features"] for r in scale.scale_vector(df, "v", fitted).collect()] == [[-1.0, 0.0], [1.0, 0.0]]


def test_varying_column_is_no_constant_at_any_size(spark):
    df = spark.range(200).selectExpr("1e14 + 2 * (id % 2) - 1 AS x", "0.1 AS same")
    got = scale.fit_scaler(df, ["x", "same"])
    assert got.stds[0] == pytest.approx(1.0, rel=0.05) and got.stds[1] == 0.0
