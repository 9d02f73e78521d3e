"""Derived application columns and the cleaning rules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendlens.functions import row_stats, safe_ratio, years
from lendlens.functions.numeric import sql_name

EXTERNAL_SCORES = ("EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3")


def derive(df: DataFrame) -> DataFrame:
    """Ratios, years and score statistics; each one only if its input columns exist."""
    have = set(df.columns)
    new = {}
    for name, num, den in (
        ("CREDIT_INCOME_RATIO", "AMT_CREDIT", "AMT_INCOME_TOTAL"),
        ("ANNUITY_INCOME_RATIO", "AMT_ANNUITY", "AMT_INCOME_TOTAL"),
        ("CREDIT_GOODS_RATIO", "AMT_CREDIT", "AMT_GOODS_PRICE"),
    ):
        if {num, den} <= have:
            new[name] = safe_ratio(F.col(num), F.col(den), 1.0)
    if "DAYS_BIRTH" in have:
        new["AGE_YEARS"] = years(F.col("DAYS_BIRTH"))
    if "DAYS_EMPLOYED" in have:
        new["EMPLOYMENT_YEARS"] = years(F.col("DAYS_EMPLOYED"), floor_zero=True)
    if {"DAYS_EMPLOYED", "DAYS_BIRTH"} <= have:
        # the marker 365243 for "not employed" stays in this share
        new["DAYS_EMPLOYED_PERCENT"] = safe_ratio(F.col("DAYS_EMPLOYED"), F.col("DAYS_BIRTH"), 1.0)
    scores = [F.col(c) for c in EXTERNAL_SCORES if c in have]
    if scores:
        for stat, value in row_stats(scores).items():
            new[f"EXT_SOURCE_{stat.upper()}"] = value
    return df.withColumns(new)


def clean(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Infinity, NaN and NULL become 0; in text columns NULL becomes the category '0'. Truth values become 0 and
    1; dates and times become text, as a file without types has them."""
    out = []
    for field in df.schema.fields:
        name = sql_name(field.name)
        if field.name in keep:
            out.append(name)
        elif isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            # NaN and infinity are not below infinity, and NULL compares as unknown
            finite = f"abs({name}) < double('Infinity')"
            out.append(f"CASE WHEN {finite} THEN {name} ELSE 0D END AS {name}")
        elif isinstance(field.dataType, T.NumericType):
            out.append(f"coalesce({name}, CAST(0 AS {field.dataType.simpleString()})) AS {name}")
        elif isinstance(field.dataType, T.StringType):
            out.append(f"coalesce({name}, '0') AS {name}")
        elif isinstance(field.dataType, T.BooleanType):
            out.append(f"coalesce(int({name}), 0) AS {name}")
        elif isinstance(field.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            out.append(f"coalesce(string({name}), '0') AS {name}")
        else:
            out.append(name)
    return df.selectExpr(*out)
