"""Category encoding: two-valued columns become 0/1, others one 0/1 column for each of the top five values."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lendlens.functions import string_columns
from lendlens.functions.numeric import quoted, sql_name

TOP = 5


@dataclass(frozen=True)
class Encoding:
    """``kind`` is 'label' (values in code order) or 'onehot' (values in column order)."""

    column: str
    kind: str
    values: tuple[str, ...]

    @property
    def outputs(self) -> tuple[str, ...]:
        return (self.column,) if self.kind == "label" else tuple(f"{self.column}_{v}" for v in self.values)


def category_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """Rows per category of each column: (column, value, cnt)."""
    filled = df.select(*[F.coalesce(quoted(c), F.lit("0")).alias(c) for c in cols])
    long = filled.unpivot([], [quoted(c) for c in cols], "column", "value")
    return long.groupBy("column", "value").agg(F.count("*").alias("cnt"))


def category_profile(counts: DataFrame) -> DataFrame:
    """Distinct values and rows per column."""
    return counts.groupBy("column").agg(F.count("*").alias("n_values"), F.sum("cnt").alias("n_rows"))


def top_categories(counts: DataFrame, k: int = TOP) -> DataFrame:
    """The most frequent values of each column, ties by value. The rank filter is pushed below the
    shuffle (a group limit), so a column with very many values sends k rows per task."""
    order = Window.partitionBy("column").orderBy(F.desc("cnt"), F.asc("value"))
    return counts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def fit_categories(df: DataFrame, cols: list[str] | None = None, k: int = TOP) -> list[Encoding]:
    """Brings to the driver at most k rows and one count per text column."""
    cols = string_columns(df) if cols is None else cols
    if not cols:
        return []
    counts = category_counts(df, cols).persist()
    try:
        sizes = {r["column"]: r["n_values"] for r in category_profile(counts).collect()}
        tops: dict[str, list[str]] = {}
        for r in sorted(top_categories(counts, k).collect(), key=lambda r: r["rank"]):
            tops.setdefault(r["column"], []).append(r["value"])
    finally:
        counts.unpersist()
    fitted = []
    for c in cols:
        if c not in sizes:
            continue
        if sizes[c] <= 2:
            fitted.append(Encoding(c, "label", tuple(sorted(tops[c]))))
        else:
            fitted.append(Encoding(c, "onehot", tuple(tops[c])))
    return fitted


def apply_categories(df: DataFrame, encodings: list[Encoding]) -> DataFrame:
    """A value not seen in the fit becomes 0 under 'label', as missing numbers do, and all zeros under 'onehot'.

    Label codes replace their column in place; one-hot columns are appended and their source dropped. A name
    that is taken, also in other letter case (Spark tells columns apart without it), gets a number.
    """
    labels = {e.column: e for e in encodings if e.kind == "label"}
    onehot = {e.column: e for e in encodings if e.kind == "onehot"}

    def text(value: str) -> str:
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"

    out = []
    for c in df.columns:
        name = sql_name(c)
        if c in labels:
            cases = " ".join(f"WHEN {text(v)} THEN {i}" for i, v in enumerate(labels[c].values))
            out.append(f"CASE coalesce({name}, '0') {cases} ELSE 0 END AS {name}")
        elif c not in onehot:
            out.append(name)
    taken = {c.lower() for c in df.columns if c not in onehot}

    def free(name: str) -> str:
        own, k = name, 2
        while own.lower() in taken:
            own, k = f"{name}~{k}", k + 1
        taken.add(own.lower())
        return own

    for e in onehot.values():
        filled = f"coalesce({sql_name(e.column)}, '0')"
        out.extend(f"int({filled} = {text(v)}) AS {sql_name(free(n))}" for v, n in zip(e.values, e.outputs))
    return df.selectExpr(*out)


def to_table(spark, encodings: list[Encoding]) -> DataFrame:
    """Fitted categories as (column, kind, code, value)."""
    rows = [(e.column, e.kind, i, v) for e in encodings for i, v in enumerate(e.values)]
    return spark.createDataFrame(rows, "column string, kind string, code int, value string")


def from_table(df: DataFrame) -> list[Encoding]:
    grouped: dict[tuple[str, str], list[tuple[int, str]]] = {}
    for r in df.collect():
        grouped.setdefault((r["column"], r["kind"]), []).append((r["code"], r["value"]))
    return [Encoding(c, kind, tuple(v for _, v in sorted(vals))) for (c, kind), vals in grouped.items()]
