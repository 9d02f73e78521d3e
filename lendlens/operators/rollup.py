"""History tables rolled up to one row per key, and their join to the applicants."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendlens.functions import numeric_columns, safe_ratio
from lendlens.functions.numeric import sql_name


def status_rollup(
    df: DataFrame, key: str, month: str = "MONTHS_BALANCE", status: str = "STATUS", good: str = "0", prefix: str = "BB"
) -> DataFrame:
    """First, last and mean month and the number of good months per credit line."""
    zero = F.lit(0.0)
    return (
        df.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(
            F.coalesce(F.min(month), F.lit(0)).alias(f"{prefix}_{month}_min"),
            F.coalesce(F.max(month), F.lit(0)).alias(f"{prefix}_{month}_max"),
            F.coalesce(F.avg(month), zero).alias(f"{prefix}_{month}_mean"),
            F.count_if(F.col(status) == good).alias(f"{prefix}_{status}_good"),
        )
    )


def rollup_numeric(df: DataFrame, key: str, prefix: str, exclude: tuple[str, ...] = ()) -> DataFrame:
    """Mean, max and min of every numeric column per key, 0 where a group holds no value.

    Text columns are never selected, so they are not read from Parquet. Aggregation is partial before
    the shuffle, so a key with very many rows sends one row per task.
    """
    columns = [c for c in numeric_columns(df) if c != key and c not in exclude]
    # one expression string per output: hundreds of columns are named without hundreds of gateway calls each
    aggregates = [
        F.expr(f"coalesce(double({fn}({sql_name(c)})), 0D) AS {sql_name(f'{prefix}_{c}_{suffix}')}")
        for c in columns
        for suffix, fn in (("mean", "avg"), ("max", "max"), ("min", "min"))
    ]
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(*aggregates)


def payment_features(df: DataFrame, paid: str = "AMT_PAYMENT", due: str = "AMT_INSTALMENT") -> DataFrame:
    """Paid minus due, and paid over due, per instalment."""
    return df.withColumns(
        {
            "PAYMENT_DIFF": F.col(paid) - F.col(due),
            "PAYMENT_RATIO": safe_ratio(F.col(paid), F.col(due), 0.0001),
        }
    )


def build_mart(application: DataFrame, sides: list[DataFrame], key: str) -> DataFrame:
    """Left joins of tables that hold each key once. Their aggregation already partitions them by the
    key, so only the application itself is shuffled; small sides are broadcast by their measured size."""
    mart = application
    for side in sides:
        mart = mart.join(side, key, "left")
    return mart
