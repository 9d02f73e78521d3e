"""AUC, acceptance at a bad rate, and the threshold search, for any number of experiments in one job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lendlens.operators.ordered import running_totals

BAD_RATE = 0.05
FALLBACK_SHARE = 0.1
CUT_POINTS = 100


def auc(df: DataFrame, score: str, label: str, by: list[str] | None = None) -> DataFrame:
    """Exact area under the ROC curve, ties counted half: ``by``, ``n_pos``, ``n_neg``, ``auc``.

    NULL if one class is missing. Rows of equal score are counted together before the shuffle.
    """
    by = by or []
    positive = F.col(label) == 1
    ties = df.groupBy(*by, score).agg(
        F.count_if(positive).alias("pos"), F.count_if(~positive).alias("neg")
    )
    run = running_totals(ties, [score], ["pos", "neg"], by)
    # a positive wins against the negatives below it and half of those beside it
    wins = F.sum(F.col("pos").cast("double") * (F.col("cum_neg") - F.col("neg") / 2))
    sums = run.groupBy(*by).agg(F.max("all_pos").alias("n_pos"), F.max("all_neg").alias("n_neg"), wins.alias("_wins"))
    pairs = F.col("n_pos").cast("double") * F.col("n_neg")
    return sums.select(*by, "n_pos", "n_neg", F.try_divide("_wins", pairs).alias("auc"))


def _running(df: DataFrame, id_col: str, score: str, label: str, by: list[str]) -> DataFrame:
    """Rows with ``n`` and ``bad`` accepted up to and including them, sorted by score, ties by id."""
    rows = df.select(
        *by, id_col, score, F.col(label).cast("bigint").alias("bad"), F.lit(1).cast("bigint").alias("n")
    )
    run = running_totals(rows, [score, id_col], ["n", "bad"], by)
    return run.select(
        *by,
        id_col,
        score,
        F.col("bad").alias("is_bad"),
        F.col("cum_n").alias("n"),
        F.col("cum_bad").alias("bad"),
        (F.col("cum_bad") / F.col("cum_n")).alias("bad_rate"),
        F.col("all_n").alias("n_all"),
    )


def acceptance_curve(df: DataFrame, id_col: str, score: str, label: str, by: list[str] | None = None) -> DataFrame:
    """Every cut of the rows sorted by score (ties by id): ``n`` accepted of ``n_all``, ``bad`` among
    them and the ``bad_rate``."""
    return _running(df, id_col, score, label, by or []).drop("is_bad")


def _candidates(score: str, target: float) -> list[Column]:
    """The last cut that keeps the bad rate, and the cut at the best tenth for when there is none.

    ``n``, ``bad`` and score all rise along the sort, so the three extremes belong to one row; as plain
    numbers they are hash-aggregated without another sort.
    """
    qualifies = F.col("bad") / F.col("n") <= target
    tenth = F.col("n") >= F.greatest(F.lit(1), F.floor(F.lit(FALLBACK_SHARE) * F.col("n_all")))
    return [F.max("n_all").alias("n_all")] + [
        agg(F.when(condition, F.col(value))).alias(f"{name}_{place}")
        for name, agg, condition in (("_best", F.max, qualifies), ("_few", F.min, tenth))
        for place, value in (("n", "n"), ("bad", "bad"), ("score", score))
    ]


def _widest(names: list[str]) -> list[Column]:
    return [(F.max(n) if n.startswith("_best") else F.min(n)).alias(n) for n in names]


CUT_COLUMNS = [f"{name}_{place}" for name in ("_best", "_few") for place in ("n", "bad", "score")]


def _chosen() -> list[Column]:
    n, bad, score = (F.coalesce(f"_best_{p}", f"_few_{p}") for p in ("n", "bad", "score"))
    return [
        n.alias("n_accepted"),
        (n / F.col("n_all")).alias("acceptance_rate"),
        F.when(F.col("_best_n") == F.col("n_all"), F.lit(1.0)).otherwise(score).alias("threshold"),
        (bad / n).alias("actual_bad_rate"),
        F.col("_best_n").isNull().alias("is_fallback"),
    ]


def acceptance(
    df: DataFrame,
    id_col: str,
    score: str,
    label: str,
    target: float = BAD_RATE,
    by: list[str] | None = None,
    tie: str = "cut",
) -> DataFrame:
    """The largest share that can be accepted with a bad rate of at most ``target``.

    Columns ``by``, ``n_all``, ``n_accepted``, ``acceptance_rate``, ``threshold``, ``actual_bad_rate``,
    ``is_fallback``. If no cut qualifies, the best tenth is taken. ``tie='whole'`` accepts all rows of
    one score or none.
    """
    by = by or []
    curve = acceptance_curve(df, id_col, score, label, by)
    if tie == "whole":
        curve = curve.groupBy(*by, score).agg(
            F.max("n").alias("n"), F.max("bad").alias("bad"), F.max("n_all").alias("n_all")
        )
    elif tie != "cut":
        raise ValueError(f"tie must be 'cut' or 'whole', not {tie!r}")
    return curve.groupBy(*by).agg(*_candidates(score, target)).select(*by, "n_all", *_chosen())


def experiment_metrics(
    scores: DataFrame, id_col: str, score: str, label: str, by: list[str], target: float = BAD_RATE
) -> DataFrame:
    """The columns of ``auc`` and ``acceptance`` for every experiment, from one sort of the scores."""
    run = _running(scores, id_col, score, label, by)
    # equal scores first, as they share one rank in the AUC
    per_score = run.groupBy(*by, score).agg(
        *_candidates(score, target),
        F.max(F.col("n") - F.col("bad")).alias("_neg_upto"),
        F.sum("is_bad").alias("_pos"),
        F.sum(1 - F.col("is_bad")).alias("_neg"),
    )
    whole = per_score.groupBy(*by).agg(
        F.max("n_all").alias("n_all"),
        *_widest(CUT_COLUMNS),
        F.sum("_pos").alias("n_pos"),
        F.sum("_neg").alias("n_neg"),
        F.sum(F.col("_pos").cast("double") * (F.col("_neg_upto") - F.col("_neg") / 2)).alias("_wins"),
    )
    pairs = F.col("n_pos").cast("double") * F.col("n_neg")
    return whole.select(
        *by, "n_pos", "n_neg", F.try_divide("_wins", pairs).alias("auc"), "n_all", *_chosen()
    )


def threshold_curve(df: DataFrame, score: str, label: str, n: int = CUT_POINTS) -> DataFrame:
    """Accuracy of ``score > threshold`` at n even cut points from the lowest to the highest score:
    (k, threshold, accuracy). One pass counts rows by the number of cuts below their score."""
    lo, hi = df.agg(F.min(score), F.max(score)).first()
    if lo is None:
        raise ValueError("no scores to search a threshold in")
    step = (hi - lo) / (n - 1)
    cuts = [lo + k * step for k in range(n - 1)] + [hi]
    cut_array = F.array(*[F.lit(float(c)) for c in cuts])
    if step > 0:
        # the quotient is right to within one cut; comparisons with the cuts themselves decide
        guess = F.floor((F.col(score) - F.lit(lo)) / F.lit(step)).cast("int") - 1
        first = F.greatest(F.lit(0), F.least(F.lit(n - 1), guess))
        below = first
        for j in range(4):
            cut = F.get(cut_array, first + j)
            below = below + F.coalesce((cut < F.col(score)).cast("int"), F.lit(0))
    else:
        below = F.lit(0)
    counted = (
        df.select(below.alias("b"), (F.col(label) == 1).alias("_pos"))
        .groupBy("b")
        .agg(F.count_if("_pos").alias("pos"), F.count_if(~F.col("_pos")).alias("neg"))
    )
    # from here on at most n + 1 rows
    grid = df.sparkSession.createDataFrame([(k, float(c)) for k, c in enumerate(cuts)], "k int, threshold double")
    table = counted.unionByName(
        df.sparkSession.range(n + 1).select(
            F.col("id").cast("int").alias("b"), F.lit(0).cast("bigint").alias("pos"), F.lit(0).cast("bigint").alias("neg")
        )
    )
    small = table.groupBy("b").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    all_rows = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    upto = Window.partitionBy().orderBy("b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    hits = small.select(
        F.col("b").alias("k"),
        (F.sum("pos").over(all_rows) - F.sum("pos").over(upto) + F.sum("neg").over(upto)).alias("hits"),
        F.sum(F.col("pos") + F.col("neg")).over(all_rows).alias("rows"),
    )
    return grid.join(hits, "k").select("k", "threshold", (F.col("hits") / F.col("rows")).alias("accuracy"))


def threshold_search(df: DataFrame, score: str, label: str, n: int = CUT_POINTS) -> DataFrame:
    """The first cut point with the best accuracy: (threshold, accuracy)."""
    best = threshold_curve(df, score, label, n).agg(
        F.max(F.struct(F.col("accuracy"), (-F.col("k")).alias("k"), F.col("threshold"))).alias("b")
    )
    return best.select(
        F.when(F.col("b.accuracy") > 0, F.col("b.threshold")).otherwise(F.lit(0.5)).alias("threshold"),
        F.col("b.accuracy").alias("accuracy"),
    )
