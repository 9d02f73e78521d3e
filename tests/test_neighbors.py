import numpy as np
import pytest
from pyspark.sql import functions as F

from lendlens.operators import neighbors as nb
from lendlens.operators import oversample


def brute(ids, x, k):
    gap = np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(axis=2))
    np.fill_diagonal(gap, np.inf)
    return {i: [int(ids[j]) for j in np.lexsort((ids, gap[n]))[:k]] for n, i in enumerate(ids.tolist())}


def as_lists(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["a"], r["rank"])):
        out.setdefault(r["a"], []).append(r["b"])
    return out


def frame(spark, ids, x):
    return spark.createDataFrame([(int(i), [float(v) for v in row]) for i, row in zip(ids, x)], "id bigint, v array<double>")


@pytest.fixture
def small_blocks(monkeypatch):
    monkeypatch.setattr(nb, "ROWS_PER_PIVOT", 40)


def test_equal_to_brute_force_over_many_blocks(spark, small_blocks, monkeypatch):
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(6, 5)) * 8
    x = centres[rng.integers(0, 6, 1500)] + rng.normal(size=(1500, 5))
    ids = rng.permutation(10_000)[:1500]
    got = as_lists(nb.neighbors(frame(spark, ids, x), "id", "v", 5, block_bytes=1))
    assert got == brute(ids, x, 5)


def test_a_third_of_the_rows_are_copies(spark, small_blocks):
    rng = np.random.default_rng(2)
    x = rng.integers(0, 3, size=(600, 3)).astype(float)
    x[:200] = 1.0
    ids = np.arange(600)
    assert as_lists(nb.neighbors(frame(spark, ids, x), "id", "v", 5)) == brute(ids, x, 5)


def test_far_fewer_visits_than_blocks_on_clustered_rows(spark, small_blocks):
    rng = np.random.default_rng(3)
    x = np.repeat(np.eye(8) * 100, 100, axis=0) + rng.normal(size=(800, 8)) * 0.1
    rows = frame(spark, np.arange(800), x)
    pivots = [list(map(float, x[i * 100])) for i in range(8)]
    visits = nb._visits(rows, pivots, nb._cell_stats(nb._with_cells(rows, pivots), 5), 5, 1000, 1)
    assert visits.count() == 800


def test_rows_see_only_the_blocks_that_may_hold_a_neighbour(spark, small_blocks):
    rng = np.random.default_rng(3)
    x = np.repeat(np.eye(8) * 100, 100, axis=0) + rng.normal(size=(800, 8)) * 0.1
    rows = frame(spark, np.arange(800), x)
    pivots = [list(map(float, x[i * 100])) for i in range(8)]
    stats = nb._cell_stats(nb._with_cells(rows, pivots), 5)
    visits = nb._visits(rows, pivots, stats, 5, 100, 1)
    assert visits.agg(F.countDistinct("chunk"), F.sum(F.size("blocks"))).first()[:] == (8, 800)


def test_cells_share_blocks_of_bounded_size():
    rng = np.random.default_rng(5)
    pivots, sizes = rng.normal(size=(60, 3)).tolist(), rng.integers(1, 90, 60).tolist()
    sizes[7] = 650
    layout = nb._layout(pivots, [{"cell": c, "n": n} for c, n in enumerate(sizes)], 200)
    held = {}
    for c, (first, parts) in layout.items():
        held[first] = held.get(first, 0) + sizes[c] / parts
    assert layout[7][1] == 4 and max(held.values()) <= 200
    assert len(held) + 3 <= 2 * (sum(sizes) / 200) + 4


def test_vectors_are_not_sent_once_for_each_cell(spark, small_blocks):
    """Rows without clusters see every cell; only packed rows and the answers are shuffled."""
    rng = np.random.default_rng(6)
    x, ids = rng.normal(size=(1200, 6)), np.arange(1200)
    found = nb.neighbors(frame(spark, ids, x), "id", "v", 5, block_bytes=1)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert as_lists(found) == brute(ids, x, 5)
    moved = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert len(moved) == 1 and "FlatMapCoGroups" not in plan


def test_repeated_ids_are_not_their_own_neighbours(spark):
    x = np.array([[0.0], [0.0], [1.0], [1.0], [3.0], [3.0], [7.0], [7.0]])
    got = nb.neighbors(frame(spark, [0, 0, 1, 1, 2, 2, 3, 3], x), "id", "v", 3).collect()
    assert all(r["a"] != r["b"] for r in got)
    assert {r["a"]: sorted(b["b"] for b in got if b["a"] == r["a"]) for r in got} == {0: [1, 1, 1], 1: [0, 0, 0], 2: [1, 1, 1], 3: [2, 2, 2]}


def test_fewer_rows_than_neighbours(spark):
    x = np.array([[0.0], [1.0], [5.0]])
    got = as_lists(nb.neighbors(frame(spark, np.arange(3), x), "id", "v", 5))
    assert got == {0: [1, 2], 1: [0, 2], 2: [1, 0]}


def test_new_row_count():
    assert oversample.new_row_count(19860, 226148) == 93214
    with pytest.raises(ValueError):
        oversample.new_row_count(5, 100)
    with pytest.raises(ValueError):
        oversample.new_row_count(60, 100)


def test_smote_properties(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(230, 4))
    df = frame(spark, np.arange(230), x).withColumn("t", (F.col("id") < 30).cast("int"))
    out = oversample.smote(df, "id", "v", "t")
    counts = {r["t"]: r["count"] for r in out.groupBy("t").count().collect()}
    assert counts == {0: 200, 1: 100}
    made = oversample.synthetic_rows(df.filter("t = 1"), "id", "v", 70, 30).collect()
    near = brute(np.arange(30), x[:30], 5)
    for r in made:
        assert r["b"] in near[r["a"]] and 0 <= r["u"] < 1
        lo, hi = np.minimum(x[r["a"]], x[r["b"]]), np.maximum(x[r["a"]], x[r["b"]])
        assert np.all(np.array(r["v"]) >= lo - 1e-12) and np.all(np.array(r["v"]) <= hi + 1e-12)
    again = oversample.synthetic_rows(df.repartition(5).filter("t = 1"), "id", "v", 70, 30).collect()
    assert sorted((r["i"], r["a"], r["b"]) for r in made) == sorted((r["i"], r["a"], r["b"]) for r in again)


def test_popular_key_is_joined_apart(spark, monkeypatch):
    monkeypatch.setattr(oversample, "HOT_ROWS", 50)
    left = spark.range(300).select("id", F.when(F.col("id") < 100, 7).otherwise(F.col("id")).alias("k"))
    right = spark.range(400).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    got = oversample.join_popular(left, right, "k", left.select("k"))
    assert sorted(map(tuple, got.select("id", "k", "w").collect())) == sorted(
        map(tuple, left.join(right, "k").select("id", "k", "w").collect())
    )
    assert "Union" in got._jdf.queryExecution().optimizedPlan().toString()
