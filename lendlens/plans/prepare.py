"""From the applicant mart to three feature sets, and the fitted state that prepares new rows alike."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendlens.functions import string_columns
from lendlens.functions.numeric import quoted
from lendlens.operators import encode, power, split
from lendlens.operators.clean import clean
from lendlens.operators.families import features_of
from lendlens.operators.oversample import new_rows
from lendlens.operators.parallel import side_by_side
from lendlens.operators.scale import Scaler, fit_scaler, scale_to_array, scaler_from_table
from lendlens.plans.mart import KEY, TARGET
from lendlens.session import CODEC, materialize, scratch, work_dir
from lendlens.sources.tables import content_digest, delete, exists


@dataclass(frozen=True)
class Params:
    """Everything fitted: small tables, one entry per column."""

    lambdas: dict[str, float]
    encodings: list[encode.Encoding]
    scaler: Scaler
    sets: dict[str, list[str]]


@dataclass(frozen=True)
class FeatureSet:
    """(id, target, features) rows; ``train`` is scaled and oversampled, ``val`` only scaled."""

    train: DataFrame
    val: DataFrame
    features: list[str]


@dataclass(frozen=True)
class Prepared:
    params: Params
    sets: dict[str, FeatureSet]
    path: str


def transform(df: DataFrame, lambdas: dict[str, float], encodings: list[encode.Encoding]) -> DataFrame:
    return encode.apply_categories(power.apply_power(df, lambdas), encodings)


def prepare(
    mart: DataFrame,
    path: str | None = None,
    key: str = KEY,
    target: str = TARGET,
    fit_on: str = "all",
    seed: int = split.SEED,
    ratio: float = 0.5,
    families: dict | None = None,
    sources: dict | None = None,
) -> Prepared:
    """Clean, transform, encode, split, scale and oversample; the result is written under ``path``.

    ``fit_on='all'`` fits transforms and categories on all rows, validation included, as the published
    numbers did; ``'train'`` leaves the validation rows out. Scaling is always fitted on train rows. The
    manifest beside the data tells the options, what the sources were, and a digest of every set.
    """
    asked = _asked(key, target, fit_on, seed, ratio, families, sources)
    if fit_on not in ("all", "train"):
        raise ValueError(f"fit_on must be 'all' or 'train', not {fit_on!r}")
    spark = mart.sparkSession
    path = path or f"{work_dir(spark)}/prepared-{uuid.uuid4().hex}"
    with scratch(spark):
        rows = materialize(
            clean(mart, keep=(key, target)).withColumn(key, F.col(key).cast("bigint")).withColumn(
                target, F.col(target).cast("int")
            ),
            "clean",
        )
        rows = split.stratified(rows, key, target, seed=seed)
        basis = rows if fit_on == "all" else rows.filter(~F.col("is_val"))
        inputs = basis.drop(key, target, "is_val")
        lambdas = power.fit_power(inputs)
        encodings = encode.fit_categories(inputs, string_columns(inputs))
        # from here on only row-by-row expressions: nothing wide is written before the sets themselves
        encoded = transform(rows, lambdas, encodings)
        sets = features_of(encoded.columns, not_features=(key, target, "is_val"), **(families or {}))
        train_rows = encoded.filter(~F.col("is_val"))
        scaler = fit_scaler(train_rows, sets["all"])

        def write_set(name: str) -> None:
            own = scaler.subset(sets[name])
            val = scale_to_array(encoded.filter("is_val"), own, [key, target])
            val.write.mode("overwrite").parquet(f"{path}/{name}/val", compression=CODEC)
            own_rows = scale_to_array(train_rows, own, [key, target])
            own_rows.write.mode("overwrite").parquet(f"{path}/{name}/train", compression=CODEC)
            train = spark.read.parquet(f"{path}/{name}/train")
            with scratch(spark):
                made = new_rows(train, key, "features", target, ratio=ratio, seed=seed)
                made.write.mode("append").parquet(f"{path}/{name}/train", compression=CODEC)

        # a half-written preparation must not look complete
        delete(spark, f"{path}/params")
        side_by_side(spark, write_set, list(sets))
        params = Params(lambdas, encodings, scaler, sets)
        digests = {f"{name}/{part}": content_digest(df) for name, part, df in _parts(spark, path, list(sets))}
        told = spark.createDataFrame([(json.dumps(asked, sort_keys=True), json.dumps(digests))], "asked string, digests string")
        told.coalesce(1).write.mode("overwrite").parquet(f"{path}/manifest")
        save_params(spark, params, f"{path}/params")
    return load_prepared(spark, path)


def _asked(key, target, fit_on="all", seed=split.SEED, ratio=0.5, families=None, sources=None) -> dict:
    plain = {k: list(v) if isinstance(v, (tuple, set, frozenset)) else v for k, v in (families or {}).items()}
    options = {"key": key, "target": target, "fit_on": fit_on, "seed": seed, "ratio": ratio, "families": plain}
    return json.loads(json.dumps(options | {"sources": sources}))


def _parts(spark: SparkSession, path: str, sets: list[str]) -> list[tuple[str, str, DataFrame]]:
    return [(name, part, spark.read.parquet(f"{path}/{name}/{part}")) for name in sets for part in ("train", "val")]


def manifest(spark: SparkSession, path: str) -> tuple[dict, dict]:
    """What was asked for, and (rows, digest) by set and part."""
    row = spark.read.parquet(f"{path}/manifest").first()
    return json.loads(row["asked"]), json.loads(row["digests"])


def verify(prepared: Prepared) -> DataFrame:
    """(feature_set, part, n, unchanged): the sets as they are on disk against the manifest."""
    spark = next(iter(prepared.sets.values())).train.sparkSession
    _, digests = manifest(spark, prepared.path)
    rows = []
    for name, part, df in _parts(spark, prepared.path, list(prepared.sets)):
        n, digest = content_digest(df)
        rows.append((name, part, n, [n, digest] == digests[f"{name}/{part}"]))
    return spark.createDataFrame(rows, "feature_set string, part string, n bigint, unchanged boolean")


def save_params(spark: SparkSession, params: Params, path: str) -> None:
    """Parameter tables; written last, so their presence says that the preparation is complete."""
    tables = {
        "lambdas": spark.createDataFrame(list(params.lambdas.items()), "column string, lambda double"),
        "categories": encode.to_table(spark, params.encodings),
        "scaler": params.scaler.table(spark),
        "sets": spark.createDataFrame(
            [(s, i, c) for s, cols in params.sets.items() for i, c in enumerate(cols)],
            "feature_set string, pos int, column string",
        ),
    }
    for name, table in tables.items():
        table.coalesce(1).write.mode("overwrite").parquet(f"{path}/{name}")


def load_params(spark: SparkSession, path: str) -> Params:
    lambdas = {r["column"]: r["lambda"] for r in spark.read.parquet(f"{path}/lambdas").collect()}
    encodings = encode.from_table(spark.read.parquet(f"{path}/categories"))
    scaler = scaler_from_table(spark.read.parquet(f"{path}/scaler"))
    sets: dict[str, list[str]] = {}
    for r in sorted(spark.read.parquet(f"{path}/sets").collect(), key=lambda r: (r["feature_set"], r["pos"])):
        sets.setdefault(r["feature_set"], []).append(r["column"])
    return Params(lambdas, encodings, scaler, sets)


def load_prepared(spark: SparkSession, path: str) -> Prepared:
    params = load_params(spark, f"{path}/params")
    order = [s for s in ("all", "traditional", "alternative") if s in params.sets]
    sets = {
        name: FeatureSet(
            spark.read.parquet(f"{path}/{name}/train"), spark.read.parquet(f"{path}/{name}/val"), params.sets[name]
        )
        for name in order
    }
    return Prepared(params, sets, path)


def load_or_prepare(
    spark: SparkSession, path: str, build: Callable[[], DataFrame], reprocess: bool = False, **options
) -> Prepared:
    """Reuse what an earlier run prepared under ``path`` with the same options and sources, or build the mart
    and prepare it."""
    asked = _asked(options.get("key", KEY), options.get("target", TARGET), **{k: v for k, v in options.items() if k not in ("key", "target")})
    if not reprocess and exists(spark, f"{path}/params/sets/_SUCCESS") and exists(spark, f"{path}/manifest/_SUCCESS"):
        if manifest(spark, path)[0] == asked:
            return load_prepared(spark, path)
    with scratch(spark):
        return prepare(build(), path, **options)


def apply_params(mart: DataFrame, params: Params, feature_set: str, key: str = KEY) -> DataFrame:
    """New applicants through the fitted transforms: (key, features). Columns that are absent count 0."""
    cols = params.sets[feature_set]
    given = set(mart.columns)
    encoded = transform(
        clean(mart, keep=(key,)),
        {c: v for c, v in params.lambdas.items() if c in given},
        [e for e in params.encodings if e.column in given],
    )
    have = set(encoded.columns)
    full = encoded.select(
        F.col(key).cast("bigint").alias(key),
        *[quoted(c) if c in have else F.lit(0.0).alias(c) for c in cols],
    )
    return scale_to_array(full, params.scaler.subset(cols), [key])
