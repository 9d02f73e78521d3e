"""The whole run: mart, feature sets, models, thin-file analysis, family comparison and reports."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendlens.operators import models, report
from lendlens.operators.metrics import auc, experiment_metrics
from lendlens.operators.thinfile import mask_for, mask_spread, profile, slice_metrics
from lendlens.plans.mart import KEY, TARGET, applicant_mart
from lendlens.plans.prepare import FeatureSet, Prepared, apply_params, load_or_prepare, load_params, manifest
from lendlens.session import materialize
from lendlens.sources.tables import fingerprint, read_sources, write_csv

EXPERIMENT = ["model_name", "feature_set"]


@dataclass(frozen=True)
class Results:
    metrics: DataFrame
    thin_profile: DataFrame
    thin_metrics: DataFrame
    thin_gains: DataFrame
    thin_gain_summary: DataFrame
    impact: DataFrame
    impact_summary: DataFrame
    family_difference: DataFrame
    report: DataFrame
    top10: DataFrame
    best: DataFrame
    best_thin: DataFrame
    errors: DataFrame


def metrics_of(scores: DataFrame, n_features: dict[str, int], key: str = KEY, target: str = TARGET) -> DataFrame:
    """One row per experiment, all of them in one grouped job."""
    counts = F.create_map(*[F.lit(v) for pair in n_features.items() for v in pair])
    table = experiment_metrics(scores, key, "score", target, EXPERIMENT)
    return table.select(
        *EXPERIMENT,
        F.col("auc").alias("auc_score"),
        "acceptance_rate",
        "threshold",
        "actual_bad_rate",
        counts[F.col("feature_set")].alias("n_features"),
    )


def thin_masks(sets: dict[str, FeatureSet], key: str = KEY, target: str = TARGET) -> DataFrame:
    """(key, target, feature_set, is_thin) by the rule of each feature set."""
    masks = None
    for name, data in sets.items():
        mask = mask_for(name, data.val, key, "features", data.features, (target,)).withColumn("feature_set", F.lit(name))
        masks = mask if masks is None else masks.unionByName(mask)
    return masks


def impact_on_common_mask(
    scores: DataFrame, sets: dict[str, FeatureSet], key: str = KEY, target: str = TARGET
) -> DataFrame:
    """Family against family on the rows whose full feature set varies least."""
    mask = mask_spread(sets["all"].val, key, "features", "var", floor=False)
    thin = scores.join(mask.filter("is_thin").select(key), key, "left_semi")
    return report.alternative_impact(auc(thin, "score", target, EXPERIMENT))


def evaluate(prepared: Prepared, swept: models.Sweep, key: str = KEY, target: str = TARGET) -> Results:
    scores, sets = swept.scores, prepared.sets
    metrics = materialize(metrics_of(scores, {n: len(s.features) for n, s in sets.items()}, key, target), "metrics")
    masks = materialize(thin_masks(sets, key, target), "masks")
    flagged = scores.join(masks.drop(target), [key, "feature_set"])
    thin = materialize(slice_metrics(flagged, key, "score", target, "is_thin", EXPERIMENT), "thin")
    impact = materialize(impact_on_common_mask(scores, sets, key, target), "impact")
    gains = report.thin_family_gain(thin)
    told = report.consolidated(metrics, thin).withColumn("error", F.lit(None).cast("string"))
    failed = swept.errors.withColumn("category", report.category())
    return Results(
        metrics=metrics,
        thin_profile=profile(masks, "is_thin", target, ["feature_set"]),
        thin_metrics=thin,
        thin_gains=gains,
        thin_gain_summary=report.thin_gain_summary(gains),
        impact=impact,
        impact_summary=report.impact_summary(impact),
        family_difference=report.family_difference(metrics),
        # a fit that failed is a row without metrics
        report=told.unionByName(failed, allowMissingColumns=True).orderBy(F.desc_nulls_last("auc_score"), *EXPERIMENT),
        top10=report.top(metrics, 10),
        best=report.best(metrics),
        best_thin=report.best(thin, "auc_thin_file"),
        errors=swept.errors,
    )


def run(
    spark: SparkSession,
    paths: dict[str, str],
    work: str,
    selection: str | None = "99",
    reprocess: bool = False,
    settings: models.Settings | None = None,
    results_to: str | None = None,
    schemas: dict | None = None,
    **options,
) -> Results:
    """Everything from source paths to reports. ``work`` keeps prepared data, models and the ledger of finished
    fits for the next run, which takes up what fits its options and sources. ``options`` go to ``prepare``."""
    prepared = load_or_prepare(
        spark,
        f"{work}/prepared",
        lambda: applicant_mart(read_sources(spark, paths, schemas=schemas), stored=True),
        reprocess=reprocess,
        sources=fingerprint(spark, paths),
        **options,
    )
    swept = models.sweep(
        prepared.sets,
        models.select_models(selection),
        KEY,
        TARGET,
        settings,
        save_to=f"{work}/models",
        run=json.dumps(manifest(spark, prepared.path), sort_keys=True),
    )
    results = evaluate(prepared, swept)
    if results_to:
        write_csv(results.metrics, f"{results_to}/model_results")
        write_csv(results.thin_metrics, f"{results_to}/thin_file_analysis_by_features")
        write_csv(results.thin_gain_summary, f"{results_to}/thin_file_gains")
        write_csv(results.impact, f"{results_to}/alternative_impact_thin_file")
        write_csv(results.report, f"{results_to}/report")
    return results


def score_new(
    spark: SparkSession, paths: dict[str, str], work: str, model: str, feature_set: str = "all"
) -> DataFrame:
    """Scores of new applicants with the saved state and model: (key, score, prediction)."""
    mart = applicant_mart(read_sources(spark, paths), stored=True)
    rows = apply_params(mart, load_params(spark, f"{work}/prepared/params"), feature_set)
    return models.score(models.load(spark, f"{work}/models/{model}_{feature_set}"), rows, "features").drop("features")
