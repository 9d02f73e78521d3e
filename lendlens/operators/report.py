"""Report tables over experiment metrics: one row per model and feature set goes in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendlens.operators.families import FEATURE_SETS

# Model groups as the report names them
CATEGORIES = {
    "Linear_Regression": "Linear Model",
    "Logistic_Regression": "Linear Model",
    "Decision_Tree": "Tree-based Model",
    "Random_Forest": "Tree-based Model",
    "Gradient_Boosting": "Tree-based Model",
    "LightGBM": "Tree-based Model",
    "Extra_Trees": "Tree-based Model",
    "SVM": "Others",
}


def category(model: str = "model_name") -> Column:
    known = F.create_map(*[F.lit(v) for pair in CATEGORIES.items() for v in pair])
    return F.coalesce(F.try_element_at(known, F.col(model)), F.lit("Others"))


def consolidated(metrics: DataFrame, thin: DataFrame) -> DataFrame:
    """Metrics and thin-file metrics side by side, best AUC first."""
    keys = ["model_name", "feature_set"]
    joined = metrics.join(thin, keys)
    return joined.select(
        category().alias("category"),
        *keys,
        "auc_score",
        "acceptance_rate",
        "threshold",
        "actual_bad_rate",
        "auc_thin_file",
        "auc_difference",
        "acceptance_thin_file",
    ).orderBy(F.desc("auc_score"), *keys)


def top(metrics: DataFrame, n: int, metric: str = "auc_score") -> DataFrame:
    """The n best experiments by a metric, ties by name."""
    return metrics.orderBy(F.desc(metric), "model_name", "feature_set").limit(n)


def best(metrics: DataFrame, metric: str = "auc_score") -> DataFrame:
    return top(metrics, 1, metric)


def metric_pivot(metrics: DataFrame, metric: str) -> DataFrame:
    """Mean metric, models down and feature sets across."""
    return metrics.groupBy("model_name").pivot("feature_set", list(FEATURE_SETS)).agg(F.avg(metric))


def averages(metrics: DataFrame) -> DataFrame:
    return metrics.groupBy("feature_set").agg(
        F.avg("auc_score").alias("auc_score"), F.avg("acceptance_rate").alias("acceptance_rate")
    )


def _of(feature_set: str, metric: str) -> Column:
    return F.max(F.when(F.col("feature_set") == feature_set, F.col(metric)))


def _has(feature_set: str) -> Column:
    return F.count_if(F.col("feature_set") == feature_set) > 0


def family_difference(metrics: DataFrame) -> DataFrame:
    """Alternative minus traditional on all validation rows, for models that have both."""
    wide = metrics.groupBy("model_name").agg(
        (_has("alternative") & _has("traditional")).alias("_both"),
        (_of("alternative", "auc_score") - _of("traditional", "auc_score")).alias("auc_difference"),
        (_of("alternative", "acceptance_rate") - _of("traditional", "acceptance_rate")).alias("acceptance_difference"),
    )
    return wide.filter("_both").drop("_both")


def thin_family_gain(thin: DataFrame) -> DataFrame:
    """AUC gains on thin files per model: (model_name, comparison, gain, same_rows).

    ``same_rows`` is false where the two feature sets flag different applicants, so that the difference
    cannot be read as an effect of the data family.
    """
    wide = thin.groupBy("model_name").agg(*[_of(s, "auc_thin_file").alias(s) for s in FEATURE_SETS])
    rows = F.array(
        F.struct(
            F.lit("alternative_vs_traditional").alias("comparison"),
            (F.col("alternative") - F.col("traditional")).alias("gain"),
            F.lit(False).alias("same_rows"),
        ),
        F.struct(
            F.lit("all_vs_traditional").alias("comparison"),
            (F.col("all") - F.col("traditional")).alias("gain"),
            F.lit(True).alias("same_rows"),
        ),
    )
    return wide.select("model_name", F.inline(rows)).filter("gain IS NOT NULL")


def alternative_impact(slice_auc: DataFrame) -> DataFrame:
    """Family against family on one common thin-file mask; input (model_name, feature_set, auc).

    Models without both families are left out, a missing 'all' counts 0. An AUC that does not exist
    (one class among the thin files) stays NULL.
    """
    wide = slice_auc.groupBy("model_name").agg(
        (_has("alternative") & _has("traditional")).alias("_both"),
        _has("all").alias("_has_all"),
        *[_of(s, "auc").alias(f"auc_{s}") for s in FEATURE_SETS],
    )
    both = wide.filter("_both")
    improvement = F.col("auc_alternative") - F.col("auc_traditional")
    return both.select(
        F.col("model_name").alias("model"),
        "auc_traditional",
        "auc_alternative",
        F.when(F.col("_has_all"), F.col("auc_all")).otherwise(F.lit(0.0)).alias("auc_all"),
        improvement.alias("improvement"),
        (F.try_divide(improvement, F.col("auc_traditional")) * 100).alias("improvement_percent"),
    )


def impact_summary(gains: DataFrame, model: str = "model", gain: str = "improvement") -> DataFrame:
    """Mean and best gain over the models, and the model that has the best (first by name on a tie)."""
    top_gain = F.max(F.col(gain))
    return gains.agg(
        F.avg(gain).alias("mean_improvement"),
        top_gain.alias("max_improvement"),
        F.min_by(model, F.struct(-F.col(gain), F.col(model))).alias("best_model"),
    )


def thin_gain_summary(gains: DataFrame) -> DataFrame:
    """Mean and best thin-file gain over the models, per comparison of ``thin_family_gain``."""
    return gains.groupBy("comparison").agg(
        F.avg("gain").alias("mean_gain"),
        F.max("gain").alias("max_gain"),
        F.min_by("model_name", F.struct(-F.col("gain"), F.col("model_name"))).alias("best_model"),
    )
