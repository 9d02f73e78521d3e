import numpy as np
import pytest
from pyspark.sql import functions as F

from lendlens.operators import metrics, ordered


def rows(spark, labels, scores):
    data = [(i, int(y), float(s)) for i, (y, s) in enumerate(zip(labels, scores))]
    return spark.createDataFrame(data, "id bigint, y int, s double")


def plain_auc(y, s):
    pos, neg = s[y == 1], s[y == 0]
    return ((pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()) / (len(pos) * len(neg))


def plain_acceptance(y, s, target):
    order = np.lexsort((np.arange(len(y)), s))
    rate = np.cumsum(y[order]) / np.arange(1, len(y) + 1)
    ok = np.nonzero(rate <= target)[0]
    n = ok[-1] + 1 if len(ok) else max(1, int(0.1 * len(y)))
    return n / len(y)


def test_auc_with_ties(spark):
    assert metrics.auc(rows(spark, [0, 1, 0, 1, 1], [0.1, 0.5, 0.5, 0.9, 0.5]), "s", "y").first()["auc"] == pytest.approx(0.833333, abs=1e-6)


def test_auc_of_one_class_is_null(spark):
    assert metrics.auc(rows(spark, [1, 1], [0.1, 0.2]), "s", "y").first()["auc"] is None


@pytest.mark.parametrize(
    ("labels", "target", "want"),
    [
        ([1, 0, 0, 0, 0, 1, 1, 1], 0.25, (0.625, 0.5, 0.2)),
        ([1, 0, 0, 0, 0, 1, 1, 1], 0.05, (0.125, 0.1, 1.0)),
        ([0, 0, 0], 0.05, (1.0, 1.0, 0.0)),
    ],
)
def test_acceptance_examples(spark, labels, target, want):
    scores = [(i + 1) / 10 for i in range(len(labels))]
    r = metrics.acceptance(rows(spark, labels, scores), "id", "s", "y", target).first()
    assert (r["acceptance_rate"], r["threshold"], r["actual_bad_rate"]) == pytest.approx(want)


@pytest.mark.parametrize("seed", range(3))
def test_random_experiments_with_a_hot_score(spark, seed):
    rng = np.random.default_rng(seed)
    n = 3000
    s = np.round(rng.random(n), 3)
    s[: n // 3] = 0.0  # a third of the rows share one score
    y = (rng.random(n) < 0.02 + 0.2 * s).astype(int)
    df = rows(spark, y, s).withColumn("m", F.when(F.col("id") % 2 == 0, "a").otherwise("b"))
    got = {r["m"]: r for r in metrics.experiment_metrics(df, "id", "s", "y", ["m"]).collect()}
    one = {r["m"]: r for r in metrics.auc(df, "s", "y", ["m"]).collect()}
    for m, part in (("a", slice(0, None, 2)), ("b", slice(1, None, 2))):
        assert got[m]["auc"] == pytest.approx(plain_auc(y[part], s[part]), abs=1e-12)
        assert got[m]["auc"] == pytest.approx(one[m]["auc"], abs=1e-12)
        assert got[m]["acceptance_rate"] == pytest.approx(plain_acceptance(y[part], s[part], 0.05))


def test_reversed_score_and_growing_target(spark):
    rng = np.random.default_rng(9)
    s = np.round(rng.random(400), 2)
    y = (rng.random(400) < 0.3 * s).astype(int)
    df = rows(spark, y, s)
    up = metrics.auc(df, "s", "y").first()["auc"]
    down = metrics.auc(df.withColumn("s", -F.col("s")), "s", "y").first()["auc"]
    assert up + down == pytest.approx(1)
    rates = []
    for target in (0.05, 0.1, 0.2, 0.5):
        r = metrics.acceptance(df, "id", "s", "y", target).first()
        if not r["is_fallback"]:
            rates.append(r["acceptance_rate"])
    assert rates == sorted(rates)


def test_whole_ties(spark):
    df = rows(spark, [0, 0, 1, 0], [0.1, 0.2, 0.2, 0.3])
    assert metrics.acceptance(df, "id", "s", "y", 0.0).first()["acceptance_rate"] == 0.5
    assert metrics.acceptance(df, "id", "s", "y", 0.0, tie="whole").first()["acceptance_rate"] == 0.25


def test_threshold_search_matches_plain(spark):
    rng = np.random.default_rng(5)
    s = rng.normal(size=500)
    y = (s + rng.normal(size=500) > 0.8).astype(int)
    cuts = np.linspace(s.min(), s.max(), 100)
    acc = [((s > t).astype(int) == y).mean() for t in cuts]
    got = metrics.threshold_search(rows(spark, y, s), "s", "y").first()
    assert got["threshold"] == pytest.approx(cuts[int(np.argmax(acc))]) and got["accuracy"] == pytest.approx(max(acc))
    curve = metrics.threshold_curve(rows(spark, y, s), "s", "y").orderBy("k").collect()
    assert [r["accuracy"] for r in curve] == pytest.approx(acc)


def test_threshold_search_on_equal_scores(spark):
    got = metrics.threshold_search(rows(spark, [1, 1], [0.3, 0.3]), "s", "y").first()
    assert (got["threshold"], got["accuracy"]) == (0.5, 0.0)


@pytest.mark.parametrize(("values", "q"), [((1, 2, 4, 9), 0.2), ((5,), 0.2), ((3, 3, 3, 1), 0.5), (tuple(range(101)), 0.2)])
def test_percentile(spark, values, q):
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    assert ordered.percentile_value(df, "x", q) == pytest.approx(np.percentile(values, q * 100))


def test_percentile_of_nothing(spark):
    assert ordered.percentile_value(spark.createDataFrame([], "x double"), "x", 0.2) is None


def test_positions_by_group(spark):
    df = spark.range(50).select(F.col("id").alias("k"), (F.col("id") % 3).alias("g"))
    got = {r["k"]: r["pos"] for r in ordered.positions(df, ["k"], ["g"]).collect()}
    assert got == {k: k // 3 + 1 for k in range(50)}


def test_no_window_over_all_raw_rows(spark):
    df = rows(spark, [0, 1] * 50, [i / 100 for i in range(100)])
    plan = metrics.acceptance_curve(df, "id", "s", "y")._jdf.queryExecution().executedPlan().toString()
    for part in plan.split("Exchange SinglePartition")[1:]:
        # only the per-range sums may meet in one partition
        assert "HashAggregate" in part.split("FileScan")[0]


def test_null_group_is_a_group(spark):
    from lendlens.operators.metrics import acceptance, auc
    from lendlens.operators.ordered import percentile

    rows = [(g, i, float(i % 5), int(i % 3 == 0)) for g in ("a", None) for i in range(30)]
    df = spark.createDataFrame(rows, "g string, id bigint, score double, bad int")
    for made in (auc(df, "score", "bad", ["g"]), acceptance(df, "id", "score", "bad", 0.4, ["g"]), percentile(df, "score", 0.3, ["g"])):
        found = {r["g"]: tuple(r)[1:] for r in made.collect()}
        assert set(found) == {"a", None} and found["a"] == found[None]
