"""Gradient descent against the full optimum, and at several partitionings."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lendlens.operators import descent


def table(spark, x, y, parts=3):
    rows = [(i, int(v), [float(a) for a in r], "k") for i, (r, v) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id bigint, y int, f array<double>, shard string").repartition(parts)


def made(n, seed=1, features=6):
    draw = np.random.default_rng(seed)
    x = draw.normal(size=(n, features))
    x[:, 1] += x[:, 0]
    return x, (draw.random(n) < 1 / (1 + np.exp(2 - x[:, 0] - 0.5 * x[:, 2]))).astype(int)


def loss_and_gradient(x, y, w, b, penalty=1e-4):
    weight = np.where(y > 0, len(y) / 2 / y.sum(), len(y) / 2 / (len(y) - y.sum()))
    margin = x @ w + b
    miss = weight * (1 / (1 + np.exp(-margin)) - y)
    loss = weight @ (np.logaddexp(0, margin) - y * margin) / len(y) + penalty / 2 * w @ w
    return loss, np.append(miss @ x / len(y) + penalty * w, miss.mean())


def optimum(x, y, penalty=1e-4):
    """Newton's method on all rows."""
    w = np.zeros(x.shape[1] + 1)
    full = np.column_stack([x, np.ones(len(x))])
    weight = np.where(y > 0, len(y) / 2 / y.sum(), len(y) / 2 / (len(y) - y.sum()))
    for _ in range(30):
        p = 1 / (1 + np.exp(-(full @ w)))
        h = (full * (weight * p * (1 - p))[:, None]).T @ full / len(y) + penalty * np.diag([1.0] * x.shape[1] + [0.0])
        w -= np.linalg.solve(h, loss_and_gradient(x, y, w[:-1], w[-1])[1])
    return w


def test_near_the_full_optimum(spark):
    x, y = made(3_000)
    best = optimum(x, y)
    least, slope = loss_and_gradient(x, y, best[:-1], best[-1])
    assert np.linalg.norm(slope) < 1e-9
    model = descent.Descent().fit(table(spark, x, y), "f", "id", "y")
    loss, slope = loss_and_gradient(x, y, np.array(model.weights), model.intercept)
    start = np.linalg.norm(loss_and_gradient(x, y, np.zeros(6), 0.0)[1])
    assert loss < 1.02 * least and np.linalg.norm(slope) < 0.1 * start
    assert min(model.losses) < model.losses[0]


def test_same_at_any_partitioning(spark):
    x, y = made(400)
    x[10:20], y[10:20] = x[0], 1  # repeated rows
    fitted = [descent.Descent(epochs=6).fit(table(spark, x, y, p), "f", "id", "y") for p in (1, 4, 16)]
    assert fitted[0] == fitted[1] == fitted[2]
    by_rows = [descent.Descent(epochs=3).fit(table(spark, x, y, p), "f", "f", "y") for p in (1, 5)]
    assert by_rows[0] == by_rows[1]


def test_wide_values_begin_again_with_a_smaller_step(spark):
    x, y = made(300)
    model = descent.Descent(epochs=8).fit(table(spark, x * 1e4, y), "f", "id", "y")
    assert np.isfinite(model.weights).all() and all(v <= np.log(2) for v in model.losses)


def test_odd_tables(spark, tmp_path):
    x, y = made(40)
    empty = descent.Descent().fit(table(spark, x, y).limit(0), "f", "id", "y")
    one = descent.Descent().fit(table(spark, x, [1] * 40), "f", "id", "y")
    assert empty.weights == [] and empty.intercept == 0 and one.intercept > 20
    model = descent.Descent(epochs=4).fit(table(spark, x, y), "f", "id", "y")
    model.save(spark, str(tmp_path / "m"))
    assert descent.LinearModel.load(spark, str(tmp_path / "m")) == model
    from pyspark.sql import functions as F

    df = table(spark, x, y)
    got = {r["id"]: r["p"] for r in df.withColumn("p", model.score(F.col("f"))).collect()}
    want = 1 / (1 + np.exp(-(x @ np.array(model.weights) + model.intercept)))
    assert [got[i] for i in range(40)] == pytest.approx(list(want))


def test_order_compares_only_rows_of_one_draw():
    made = np.random.default_rng(1)
    x = made.integers(0, 2, size=(400, 5)).astype(float)
    draw, y = made.integers(0, 60, 400).astype(np.uint64), made.integers(0, 2, 400)
    full = np.lexsort((*x.T[::-1], y, draw))
    found = descent.ordered(draw, y, x)
    assert (x[found] == x[full]).all() and (y[found] == y[full]).all() and (draw[found] == draw[full]).all()
    assert sorted(found) == list(range(400))


def test_a_shard_is_read_by_one_task_also_where_files_are_split(spark):
    x, y = made(20_000, 7, 12)
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    hadoop.set("parquet.block.size", "65536")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "32k")
    try:
        stored = descent.Descent()._stored(table(spark, x, y), "f", "id", "y", 3)
        tasks = stored.select("shard", F.spark_partition_id().alias("task")).distinct().groupBy("shard").count()
        assert sorted(r["count"] for r in tasks.collect()) == [1, 1, 1]
        assert stored.count() < 100
    finally:
        hadoop.unset("parquet.block.size")
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
