"""Exact stratified split by hash order, without sorting or shuffling the rows."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lendlens.functions import hashed_order

SEED = 42
TEST_SHARE = 0.2
# rows of one class that may share the hash prefix in which the cut lies
ROWS_PER_PREFIX = 20_000


def class_counts(df: DataFrame, target: str) -> DataFrame:
    return df.groupBy(target).agg(F.count("*").alias("cnt"))


def train_quotas(counts: dict[int, int], test: float = TEST_SHARE) -> dict[int, int]:
    """Train rows per class: the floor of each share, missing rows go to the largest remainders."""
    total = sum(counts.values())
    n_train = total - math.ceil(test * total)
    shares = {c: n_train * k / total for c, k in counts.items()}
    quotas = {c: math.floor(s) for c, s in shares.items()}
    missing = n_train - sum(quotas.values())
    for c in sorted(counts, key=lambda c: (quotas[c] - shares[c], c))[:missing]:
        quotas[c] += 1
    return quotas


def _order(id_col: str, seed: int) -> Column:
    return hashed_order(F.coalesce(F.col(id_col).cast("string"), F.lit("")), seed)


def _cut_points(df: DataFrame, id_col: str, target: str, quotas: dict[int, int], n_rows: int, seed: int) -> dict[int, str]:
    """Per class the hash of the last train row in hash order.

    Rows are counted per hash prefix, which tells the prefix the cut lies in; only the hashes inside it
    are put in order, and copies of one id are counted before that.
    """
    digits = max(1, math.ceil(math.log(max(n_rows / ROWS_PER_PREFIX, 1), 16)))
    hashed = df.select(F.col(target), _order(id_col, seed).alias("_h")).withColumn("_p", F.substring("_h", 1, digits))
    wanted = F.create_map(*[F.lit(v) for pair in quotas.items() for v in pair])[F.col(target)]

    def holding(counts: DataFrame, place: str, need: Column) -> DataFrame:
        """The place in which the running count reaches what is needed, and what is needed inside it."""
        upto = Window.partitionBy(target).orderBy(place).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        run = counts.withColumn("_need", need).withColumn("_cum", F.sum("_c").over(upto))
        reached = (F.col("_cum") >= F.col("_need")) & (F.col("_cum") - F.col("_c") < F.col("_need"))
        return run.filter(reached).select(target, place, (F.col("_need") - F.col("_cum") + F.col("_c")).alias("_need"))

    per_prefix = hashed.groupBy(target, "_p").agg(F.count("*").alias("_c"))
    prefixes = holding(per_prefix, "_p", wanted).collect()
    if not prefixes:
        return {}
    inside = reduce(lambda a, b: a | b, [(F.col(target) == r[target]) & (F.col("_p") == r["_p"]) for r in prefixes])
    need = F.create_map(*[F.lit(v) for r in prefixes for v in (r[target], r["_need"])])[F.col(target)]
    per_hash = hashed.filter(inside).groupBy(target, "_h").agg(F.count("*").alias("_c"))
    return {r[target]: r["_h"] for r in holding(per_hash, "_h", need).collect()}


def stratified(
    df: DataFrame, id_col: str, target: str, test: float = TEST_SHARE, seed: int = SEED
) -> DataFrame:
    """Adds ``is_val``. The validation part holds ceil(test * n) rows in the proportions of the classes.

    The sizes are exact if ``id_col`` is unique; copies of an id always stay on one side. The flag itself
    is a plain comparison with one cut point per class, so the wide rows are not moved.
    """
    counts = {r[target]: r["cnt"] for r in class_counts(df, target).collect()}
    cuts = _cut_points(df, id_col, target, train_quotas(counts, test), max(counts.values(), default=0), seed)
    order = _order(id_col, seed)
    is_train: Column = F.lit(False)
    for cls, cut in cuts.items():
        is_train = is_train | ((F.col(target) == cls) & (order <= cut))
    return df.withColumn("is_val", ~is_train)
