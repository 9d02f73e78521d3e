"""Column expressions. All of them are built-in Spark functions, no Python runs per row."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DAYS_PER_YEAR = 365.25


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def sql_name(name: str) -> str:
    """A column name inside a SQL expression: encoded names may hold dots, spaces and slashes."""
    return "`" + name.replace("`", "``") + "`"


def sql_double(value: float) -> str:
    return f"({float(value)!r}D)"


def quoted(name: str) -> Column:
    """A column by its exact name."""
    return F.col(sql_name(name))


def safe_ratio(num: Column, den: Column, offset: float = 0.0) -> Column:
    """``num / (den + offset)``, NULL where the divisor is 0."""
    return F.try_divide(num.cast("double"), den.cast("double") + F.lit(float(offset)))


def years(days: Column, floor_zero: bool = False) -> Column:
    """Days before the application (negative) as positive years."""
    value = -days / F.lit(DAYS_PER_YEAR)
    # greatest() skips NULL, so an unknown day count must be kept unknown
    return F.when(days.isNotNull(), F.greatest(value, F.lit(0.0))) if floor_zero else value


def row_stats(cols: list[Column]) -> dict[str, Column]:
    """Mean, sample deviation, min and max over the non-null ones of a few columns."""
    zero = F.lit(0.0)
    count = reduce(lambda a, b: a + b, [c.isNotNull().cast("double") for c in cols])
    total = reduce(lambda a, b: a + b, [F.coalesce(c, zero) for c in cols])
    mean = F.try_divide(total, count)
    squares = reduce(
        lambda a, b: a + b, [F.when(c.isNotNull(), (c - mean) * (c - mean)).otherwise(zero) for c in cols]
    )
    several = len(cols) > 1
    return {
        "mean": mean,
        "std": F.when(count > 1, F.sqrt(F.try_divide(squares, count - 1))),
        "min": F.least(*cols) if several else cols[0],
        "max": F.greatest(*cols) if several else cols[0],
    }


def yeo_johnson(x: Column, lam: Column) -> Column:
    """Yeo-Johnson power transform (Yeo and Johnson 2000) for a given lambda."""
    return yeo_johnson_of_log(F.signum(x) * F.log1p(F.abs(x)), lam)


def yeo_johnson_of_log(g: Column, lam: Column) -> Column:
    """The transform from g = sign(x) * log(1 + |x|).

    ((x+1)^lambda - 1) / lambda is expm1(lambda * g) / lambda, which keeps its digits near lambda 0.
    """

    def power(log_value: Column, exponent: Column) -> Column:
        return F.when(exponent == 0.0, log_value).otherwise(F.try_divide(F.expm1(exponent * log_value), exponent))

    return F.when(g >= 0, power(g, lam)).when(g < 0, -power(-g, F.lit(2.0) - lam))


def _md5(key: Column, seed: int | str) -> Column:
    return F.md5(F.concat(key.cast("string"), F.lit(f":{seed}")))


def hashed_order(key: Column, seed: int | str) -> Column:
    """A reproducible random sort key of a row: the same on any partitioning and after a retry."""
    return _md5(key, seed)


def hashed_uniform(key: Column, seed: int | str) -> Column:
    """A reproducible draw from [0, 1) per key."""
    return F.conv(F.substring(_md5(key, seed), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def hashed_int(key: Column, seed: int | str, modulus: int) -> Column:
    """A reproducible draw from 0 .. modulus-1 per key (60 hash bits)."""
    return F.conv(F.substring(_md5(key, seed), 1, 15), 16, 10).cast("bigint") % F.lit(modulus)


def vector_sum_abs(vec: Column, positions: list[int]) -> Column:
    """Sum of absolute values over some positions of an array column."""
    picked = F.array(*[F.abs(F.get(vec, F.lit(p))) for p in positions])
    return F.aggregate(picked, F.lit(0.0), lambda acc, x: acc + x)


def vector_spread(vec: Column, stat: str = "std") -> Column:
    """Population variance or deviation over the entries of an array column."""
    size = F.size(vec)
    mean = F.aggregate(vec, F.lit(0.0), lambda acc, x: acc + x) / size
    centred = F.transform(vec, lambda x: x - mean)
    var = F.aggregate(centred, F.lit(0.0), lambda acc, x: acc + x * x) / size
    if stat not in ("var", "std"):
        raise ValueError(f"stat must be 'var' or 'std', not {stat!r}")
    return F.sqrt(var) if stat == "std" else var
