"""Standardisation with the population deviation, fitted on train rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendlens.functions.numeric import sql_double, sql_name


@dataclass(frozen=True)
class Scaler:
    names: tuple[str, ...]
    means: tuple[float, ...]
    stds: tuple[float, ...]

    def subset(self, names: list[str]) -> Scaler:
        """Statistics are per column and taken on the same train rows, so a feature set needs no new fit."""
        at = {n: i for i, n in enumerate(self.names)}
        return Scaler(
            tuple(names), tuple(self.means[at[n]] for n in names), tuple(self.stds[at[n]] for n in names)
        )

    def table(self, spark: SparkSession) -> DataFrame:
        rows = [(i, *r) for i, r in enumerate(zip(self.names, self.means, self.stds))]
        return spark.createDataFrame(rows, "pos int, column string, mean double, std double")


def scaler_from_table(df: DataFrame) -> Scaler:
    rows = sorted(df.collect(), key=lambda r: r["pos"])
    return Scaler(
        tuple(r["column"] for r in rows), tuple(r["mean"] for r in rows), tuple(r["std"] for r in rows)
    )


def _fit(vectors: DataFrame, names: list[str]) -> Scaler:
    """One pass with a fixed-size buffer per task, for any number of columns."""
    row = vectors.select(Summarizer.metrics("count", "mean", "variance", "min", "max").summary(F.col("_v")).alias("s")).first()["s"]
    n = row["count"]
    stds = []
    for var, low, high in zip(row["variance"], row["min"], row["max"]):
        pop = max(float(var), 0.0) * (n - 1) / n if n > 1 else 0.0
        # the variance of a constant may be rounding noise
        stds.append(0.0 if low == high else pop**0.5)
    return Scaler(tuple(names), tuple(float(m) for m in row["mean"]), tuple(stds))


def fit_scaler(df: DataFrame, cols: list[str]) -> Scaler:
    renamed = df.selectExpr(*[f"double({sql_name(c)}) AS c{i}" for i, c in enumerate(cols)])
    assembled = VectorAssembler(inputCols=renamed.columns, outputCol="_v").transform(renamed)
    return _fit(assembled.select("_v"), cols)


def fit_vector_scaler(df: DataFrame, vec: str, size: int) -> Scaler:
    """The same for an array column of fixed length."""
    vectors = df.select(array_to_vector(F.col(vec).cast("array<double>")).alias("_v"))
    return _fit(vectors, [str(i) for i in range(size)])


def _scaled(value: str, mean: float, std: float) -> str:
    return f"(double({value}) - {sql_double(mean)}) / {sql_double(std if std > 0 else 1.0)}"


def scale_columns(df: DataFrame, scaler: Scaler) -> DataFrame:
    stats = {n: (m, s) for n, m, s in zip(scaler.names, scaler.means, scaler.stds)}
    return df.selectExpr(
        *[f"{_scaled(sql_name(c), *stats[c])} AS {sql_name(c)}" if c in stats else sql_name(c) for c in df.columns]
    )


def scale_to_array(df: DataFrame, scaler: Scaler, keep: list[str], out: str = "features") -> DataFrame:
    """Kept columns plus one array with all scaled features: narrow rows, whatever the number of features."""
    parts = [_scaled(sql_name(n), m, s) for n, m, s in zip(scaler.names, scaler.means, scaler.stds)]
    return df.select(*keep, F.expr(f"array({', '.join(parts)})").alias(out))


def scale_vector(df: DataFrame, vec: str, scaler: Scaler, out: str = "features") -> DataFrame:
    parts = [_scaled(f"get({sql_name(vec)}, {i})", m, s) for i, (m, s) in enumerate(zip(scaler.means, scaler.stds))]
    return df.withColumn(out, F.expr(f"array({', '.join(parts)})"))
