"""Oversampling of the rare class by interpolation between neighbours (Chawla et al. 2002)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendlens.functions import hashed_int, hashed_uniform
from lendlens.operators.neighbors import neighbors
from lendlens.operators.ordered import positions
from lendlens.session import materialize

RATIO = 0.5
NEIGHBORS = 5
SEED = 42
# a neighbour chosen more often than this is joined apart; at most HOT_SHARE of them can exist
HOT_ROWS = 100_000
HOT_SHARE = 1_000


def new_row_count(n_minor: int, n_major: int, ratio: float = RATIO, k: int = NEIGHBORS) -> int:
    """How many rows lift the rare class to ``ratio`` of the common one."""
    if n_minor <= k:
        raise ValueError(f"the rare class has {n_minor} rows, more than {k} are needed")
    missing = int(n_major * ratio - n_minor)
    if missing <= 0:
        raise ValueError("the rare class already has the wanted share")
    return missing


def join_popular(left: DataFrame, right: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """Inner join with a table that holds ``key`` once, where a few keys of ``left`` may be very frequent.

    ``keys`` is a narrow table with the key column of ``left``. Its frequent keys are at most HOT_SHARE, so
    their rows of ``right`` are broadcast; every other key has a bounded number of rows and goes through
    the ordinary join.
    """
    total = keys.count()
    limit = max(HOT_ROWS, total // HOT_SHARE)
    if total <= limit:
        return left.join(right, key)
    counts = keys.groupBy(key).agg(F.count("*").alias("_n"))
    hot = [r[key] for r in counts.filter(F.col("_n") > limit).collect()]
    if not hot:
        return left.join(right, key)
    is_hot = F.col(key).isin(hot)
    often = left.filter(is_hot).join(F.broadcast(right.filter(is_hot)), key)
    return often.unionByName(left.filter(~is_hot).join(right.filter(~is_hot), key))


def draws(spark, n_new: int, n_minor: int, k: int = NEIGHBORS, seed: int = SEED) -> DataFrame:
    """One row per new sample: base position j, neighbour rank r and step u, all by hash of the number."""
    numbers = spark.range(n_new).withColumnRenamed("id", "i")
    pick = hashed_int(F.col("i"), f"{seed}:pick", n_minor * k)
    return numbers.select(
        "i",
        (F.floor(pick / k) + 1).alias("j"),
        (pick % k + 1).cast("int").alias("rank"),
        hashed_uniform(F.col("i"), f"{seed}:step").alias("u"),
    )


def synthetic_rows(
    minor: DataFrame, id_col: str, vec: str, n_new: int, n_minor: int, k: int = NEIGHBORS, seed: int = SEED
) -> DataFrame:
    """(i, a, b, u, features): ``features`` lies on the line from row a to its neighbour b."""
    spark = minor.sparkSession
    rows = materialize(minor.select(F.col(id_col).cast("bigint").alias("a"), F.col(vec).cast("array<double>").alias("x")))
    pairs = materialize(neighbors(rows, "a", "x", k).select("a", "b", "rank"), "pairs")
    numbered = positions(rows.select("a"), ["a"], name="j")
    chosen = (
        draws(spark, n_new, n_minor, k, seed)
        .join(numbered, "j")
        .join(pairs, ["a", "rank"])
        .select("i", "a", "b", "u")
    )
    chosen = materialize(chosen, "chosen")
    with_base = chosen.join(rows, "a")
    both = join_popular(with_base, rows.select(F.col("a").alias("b"), F.col("x").alias("y")), "b", chosen)
    step = F.zip_with("x", F.zip_with("x", "y", lambda p, q: q - p), lambda p, d: p + F.col("u") * d)
    return both.select("i", "a", "b", "u", step.alias(vec))


def new_rows(
    df: DataFrame,
    id_col: str,
    vec: str,
    target: str,
    ratio: float = RATIO,
    k: int = NEIGHBORS,
    seed: int = SEED,
    rare: int = 1,
) -> DataFrame:
    """The new rows of the rare class, with ids below 0."""
    is_rare = F.col(target) == rare
    n_minor, n_major = df.agg(F.count_if(is_rare), F.count_if(~is_rare)).first()
    n_new = new_row_count(n_minor, n_major, ratio, k)
    made = synthetic_rows(df.filter(is_rare), id_col, vec, n_new, n_minor, k, seed)
    types = dict(df.dtypes)
    return made.select(
        (-F.col("i") - 1).cast(types[id_col]).alias(id_col),
        F.lit(rare).cast(types[target]).alias(target),
        F.col(vec).cast(types[vec]).alias(vec),
    )


def smote(df: DataFrame, id_col: str, vec: str, target: str, **options) -> DataFrame:
    """The rows of ``df`` and the new rows of the rare class."""
    return df.select(id_col, target, vec).unionByName(new_rows(df, id_col, vec, target, **options))
