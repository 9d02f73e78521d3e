"""Running totals and order statistics over any number of rows.

A window without ``partitionBy``, or one partitioned by two or three experiment names, would pull all
rows into a few tasks. Here rows are range-partitioned on the whole sort key first. The place of a row
is stored as a column, so every later step sees the same cut even after a retry, and the window runs
inside each range; only one row per range is added up across ranges. Tied sort values are no hot key as long
as the sort key ends in an id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lendlens.session import materialize


def running_totals(df: DataFrame, order: list[str], totals: list[str], by: list[str] | None = None) -> DataFrame:
    """Adds, for each column t of ``totals``, ``cum_t`` (inclusive running sum in ascending ``order``)
    and ``all_t`` (sum over the whole group). A NULL in ``by`` is a group of its own; ``order`` columns must
    not be null."""
    columns = df.columns
    own = by or []
    # a struct is never NULL and its NULL fields are equal, so joins on it keep such groups
    by = ["_by"] if own else []
    df = df.withColumn("_by", F.struct(*own)) if own else df
    # no fixed number: adjacent small ranges are merged by their measured size, which keeps their order
    placed = materialize(df.repartitionByRange(*by, *order).withColumn("_range", F.spark_partition_id()), "ranges")
    per_range = placed.groupBy(*by, "_range").agg(*[F.sum(t).alias(f"_sum_{t}") for t in totals])
    # at most one row per range and group
    earlier = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    group = Window.partitionBy(*by)
    offsets = per_range.select(
        *by,
        "_range",
        *[F.coalesce(F.sum(f"_sum_{t}").over(earlier), F.lit(0)).alias(f"_before_{t}") for t in totals],
        *[F.sum(f"_sum_{t}").over(group).alias(f"all_{t}") for t in totals],
    )
    inside = (
        Window.partitionBy(*by, "_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    running = placed.select("*", *[F.sum(t).over(inside).alias(f"_inside_{t}") for t in totals])
    # same keys as the window above: the large side is not shuffled again
    joined = running.join(offsets, [*by, "_range"])
    return joined.select(
        *columns,
        *[(F.col(f"_inside_{t}") + F.col(f"_before_{t}")).alias(f"cum_{t}") for t in totals],
        *[f"all_{t}" for t in totals],
    )


def positions(df: DataFrame, order: list[str], by: list[str] | None = None, name: str = "pos") -> DataFrame:
    """Adds the 1-based position of each row in ``order`` within ``by``."""
    ones = running_totals(df.withColumn("_one", F.lit(1).cast("bigint")), order, ["_one"], by)
    return ones.withColumnRenamed("cum__one", name).drop("_one", "all__one")


def percentile(df: DataFrame, value: str, q: float, by: list[str] | None = None) -> DataFrame:
    """Exact percentile with linear interpolation: columns ``by``, ``n``, ``percentile``.

    Equal values are counted together before the shuffle, then only the two values around the wanted
    position are kept.
    """
    by = by or []
    counted = df.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("cnt"))
    run = running_totals(counted, [value], ["cnt"], by)
    place = F.lit(float(q)) * (F.col("all_cnt") - 1)
    around = run.groupBy(*by).agg(
        F.max("all_cnt").alias("n"),
        F.min(F.when(F.col("cum_cnt") > F.floor(place), F.col(value))).alias("_lo"),
        F.min(F.when(F.col("cum_cnt") > F.ceil(place), F.col(value))).alias("_hi"),
        F.max(place - F.floor(place)).alias("_part"),
    )
    return around.select(*by, "n", (F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("_part")).alias("percentile"))


def percentile_value(df: DataFrame, value: str, q: float) -> float:
    """The percentile of the whole column as a number."""
    row = percentile(df, value, q).first()
    return None if row is None else row["percentile"]
