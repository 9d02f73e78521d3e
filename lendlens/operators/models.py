"""The eight classifiers, with scoring, saving and the experiment sweep."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.ml import Estimator, Model
from pyspark.ml.classification import (
    DecisionTreeClassificationModel,
    DecisionTreeClassifier,
    LogisticRegression,
    LogisticRegressionModel,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendlens.operators.descent import Descent, LinearModel
from lendlens.operators.metrics import threshold_search
from lendlens.operators.parallel import PARALLELISM, side_by_side
from lendlens.operators.trees import Boosting, Forest, TreeModel
from lendlens.session import materialize, scratch, work_dir
from lendlens.sources.tables import exists

SEED = 42
VECTOR = "_vec"
DRAW = "_draw"

# Names in menu order, and the short list for a quick run
MODEL_NAMES = (
    "Linear_Regression",
    "Logistic_Regression",
    "Decision_Tree",
    "Random_Forest",
    "Gradient_Boosting",
    "LightGBM",
    "Extra_Trees",
    "SVM",
)
QUICK_MODELS = ("LightGBM", "Random_Forest", "Logistic_Regression")
BOOSTED = ("Gradient_Boosting", "LightGBM")


# Codes of whole lists; 1, 2, … stand for the names in menu order
LIST_CODES = {"0": MODEL_NAMES, "77": MODEL_NAMES, "99": QUICK_MODELS, "all": MODEL_NAMES, "quick": QUICK_MODELS}


def select_models(selection: str | None = None) -> list[str]:
    """'all', 'quick', or names parted by commas; codes stand for them. A number without a name is passed
    over, any other unknown word makes it the quick list."""
    words = [w.strip() for w in (selection or "quick").split(",")]
    if len(words) == 1 and words[0] in LIST_CODES:
        return list(LIST_CODES[words[0]])
    named = {str(k): name for k, name in enumerate(MODEL_NAMES, 1)} | {name: name for name in MODEL_NAMES}
    if any(w not in named and not w.isdigit() for w in words):
        return list(QUICK_MODELS)
    return [named[w] for w in words if w in named]


@dataclass(frozen=True)
class Settings:
    """Sizes that drive the run time. The defaults are those of the published experiments."""

    trees: int = 100
    rounds: int = 100
    max_iter: int = 1000


def estimator(name: str, label: str, n_rows: int, settings: Settings | None = None) -> Estimator | Forest | Boosting | Descent:
    """A fresh estimator."""
    s = settings or Settings()
    io = {"featuresCol": VECTOR, "labelCol": label}
    logistic = {**io, "maxIter": s.max_iter, "elasticNetParam": 0.0, "standardization": False}
    made: dict[str, Callable[[], Estimator | Forest | Boosting | Descent]] = {
        # by the normal equations, and iteratively beyond the width that those allow
        "Linear_Regression": lambda: LinearRegression(**io, regParam=0.0, solver="auto"),
        # a penalty of 1 on the summed loss is 1/n on the mean loss
        "Logistic_Regression": lambda: LogisticRegression(**logistic, regParam=1.0 / n_rows),
        "Decision_Tree": lambda: DecisionTreeClassifier(
            **io, seed=SEED, maxMemoryInMB=1024, maxDepth=10, impurity="gini", maxBins=255
        ),
        "Random_Forest": lambda: Forest(trees=s.trees, depth=10, seed=SEED),
        "Gradient_Boosting": lambda: Boosting(
            rounds=s.rounds, leaves=32, depth=5, min_rows=1, min_curvature=0.0, newton=False
        ),
        "LightGBM": lambda: Boosting(rounds=s.rounds, leaves=31, min_rows=20),
        "Extra_Trees": lambda: Forest(trees=s.trees, depth=10, random_cuts=True, seed=SEED),
        "SVM": lambda: Descent(epochs=min(60, s.max_iter), seed=SEED),
    }
    if name not in made:
        raise ValueError(f"unknown model {name!r}")
    return made[name]()


MODEL_CLASSES = {
    "Linear_Regression": LinearRegressionModel,
    "Logistic_Regression": LogisticRegressionModel,
    "Decision_Tree": DecisionTreeClassificationModel,
    "Random_Forest": TreeModel,
    "Gradient_Boosting": TreeModel,
    "LightGBM": TreeModel,
    "Extra_Trees": TreeModel,
    "SVM": LinearModel,
}
#: Models of this library; the others are of ``pyspark.ml``.
OWN = (TreeModel, LinearModel)


@dataclass(frozen=True)
class Fitted:
    name: str
    model: Model | TreeModel | LinearModel
    threshold: float = 0.5


# train partitions below the first size are merged, as fits run hundreds of short jobs over them; beyond two a core
# they are merged up to the second size, so that the tasks of a pass do not grow in number with the rows
PARTITION_BYTES, MOST_BYTES = 1024 * 1024, 64 * 1024 * 1024


def _packed(df: DataFrame, vec: str) -> DataFrame:
    """Fewer partitions if the rows are few; never more, and no shuffle."""
    some = df.select(F.size(vec)).first()
    if some is None:
        return df
    size = df.count() * 8 * some[0]
    most = max(2 * df.sparkSession.sparkContext.defaultParallelism, math.ceil(size / MOST_BYTES))
    return df.coalesce(max(1, min(most, math.ceil(size / PARTITION_BYTES))))


def with_vector(df: DataFrame, vec: str, label: str | None = None, key: str | None = None) -> DataFrame:
    """Adds the ML vector and, with a label, what rows are drawn by: ``key``, or else the row's numbers."""
    out = df.withColumn(VECTOR, array_to_vector(F.col(vec)))
    return out if label is None else out.withColumn(DRAW, F.xxhash64(key or vec))


def fit_prepared(
    name: str, train: DataFrame, label: str, n_rows: int, settings: Settings | None = None, vec: str = "features"
) -> Fitted:
    """Fit on rows that already carry the columns of ``with_vector``. They are read from where they lie: a fit
    of many passes keeps its own, smaller copy, in tables that go with it."""
    made = estimator(name, label, n_rows, settings)
    with scratch(train.sparkSession):
        if not isinstance(made, Estimator):
            return Fitted(name, made.fit(train.select(DRAW, label, vec), vec, DRAW, label))
        model = made.fit(train.select(label, VECTOR))
        if name != "Linear_Regression":
            return Fitted(name, model)
        raw = materialize(model.transform(train.select(label, VECTOR)).select("prediction", label), "raw")
        return Fitted(name, model, threshold_search(raw, "prediction", label).first()["threshold"])


def fit(
    name: str, train: DataFrame, vec: str, label: str, settings: Settings | None = None, key: str | None = None
) -> Fitted:
    work_dir(train.sparkSession)  # passes over the rows write there
    return fit_prepared(name, with_vector(_packed(train, vec), vec, label, key), label, train.count(), settings, vec)


def _add_score(df: DataFrame, fitted: Fitted, score: str, prediction: str) -> DataFrame:
    """Probability of class 1 and the predicted label; the vector column must be present."""
    if isinstance(fitted.model, OWN):
        scored = df.withColumn(score, fitted.model.score(vector_to_array(VECTOR)))
        return scored.withColumn(prediction, (F.col(score) > 0.5).cast("int"))
    if fitted.name == "Linear_Regression":
        raw = fitted.model.setPredictionCol("_raw").transform(df)
        clipped = F.least(F.greatest(F.col("_raw"), F.lit(0.0)), F.lit(1.0))
        return raw.withColumns(
            {score: clipped, prediction: (F.col("_raw") > F.lit(fitted.threshold)).cast("int")}
        ).drop("_raw")
    model = fitted.model.setProbabilityCol("_prob").setPredictionCol("_pred").setRawPredictionCol("_rawp")
    out = model.transform(df)
    return out.withColumns(
        {score: F.get(vector_to_array("_prob"), F.lit(1)), prediction: F.col("_pred").cast("int")}
    ).drop("_prob", "_pred", "_rawp")


def score(fitted: Fitted, df: DataFrame, vec: str) -> DataFrame:
    """Adds ``score`` and ``prediction``."""
    return _add_score(with_vector(df, vec), fitted, "score", "prediction").drop(VECTOR)


def score_all(fitted: list[Fitted], df: DataFrame, vec: str, keep: list[str]) -> DataFrame:
    """Long scores of several models from one read of ``df``: keep, model_name, score, prediction."""
    wide = with_vector(df.select(*keep, vec), vec)
    for i, f in enumerate(fitted):
        wide = _add_score(wide, f, f"_s{i}", f"_p{i}")
    rows = F.array(
        *[
            F.struct(F.lit(f.name).alias("model_name"), F.col(f"_s{i}").alias("score"), F.col(f"_p{i}").alias("prediction"))
            for i, f in enumerate(fitted)
        ]
    )
    return wide.select(*keep, F.inline(rows))


def save(spark: SparkSession, fitted: Fitted, path: str) -> None:
    if isinstance(fitted.model, OWN):
        fitted.model.save(spark, f"{path}/model")
    else:
        fitted.model.write().overwrite().save(f"{path}/model")
    rows = [(fitted.name, float(fitted.threshold))]
    spark.createDataFrame(rows, "name string, threshold double").coalesce(1).write.mode("overwrite").parquet(
        f"{path}/about"
    )


def load(spark: SparkSession, path: str) -> Fitted:
    about = spark.read.parquet(f"{path}/about").first()
    kind = MODEL_CLASSES[about["name"]]
    model = kind.load(spark, f"{path}/model") if kind in OWN else kind.load(f"{path}/model")
    return Fitted(about["name"], model, about["threshold"])


@dataclass
class Sweep:
    scores: DataFrame
    errors: DataFrame
    fitted: dict[tuple[str, str], Fitted] = field(default_factory=dict)


def sweep(
    feature_sets: dict,
    models: list[str],
    id_col: str,
    label: str,
    settings: Settings | None = None,
    save_to: str | None = None,
    parallelism: int = PARALLELISM,
    run: str = "",
) -> Sweep:
    """Fit every model on every feature set and score its validation rows.

    A failing fit becomes a row of ``errors`` and does not stop the others. ``parallelism`` fits run side by
    side, set after set. With ``save_to``, a fit that ends is entered in the ledger there, model first and scores last, and a sweep
    that is started again with the same ``run`` (a name for data and settings) takes it from there. Without,
    validation rows are read once per feature set for all models together.
    """
    spark = next(iter(feature_sets.values())).train.sparkSession
    work_dir(spark)
    schema = f"{id_col} bigint, {label} int, model_name string, score double, prediction int, feature_set string"
    ledger = f"{save_to}/ledger-{hashlib.sha256(f'{run}|{settings or Settings()}'.encode()).hexdigest()[:16]}" if save_to else None
    # the long fits of a set start first
    tasks = [(m, s) for s in feature_sets for m in sorted(models, key=lambda m: m not in BOOSTED)]
    entry = {task: f"{ledger}/{task[0]}_{task[1]}" for task in tasks}
    known = {task for task in tasks if ledger and exists(spark, f"{entry[task]}/_SUCCESS")}
    left = {set_name for _, set_name in (t for t in tasks if t not in known)}
    ready = {n: with_vector(_packed(feature_sets[n].train, "features"), "features", label, id_col) for n in left}
    sizes = {n: feature_sets[n].train.count() for n in left}

    def one(task: tuple[str, str]) -> tuple[Fitted | None, str]:
        name, set_name = task
        if task in known:
            return load(spark, f"{save_to}/{name}_{set_name}"), ""
        try:
            fitted = fit_prepared(name, ready[set_name], label, sizes[set_name], settings)
            if save_to:
                save(spark, fitted, f"{save_to}/{name}_{set_name}")
                own = score_all([fitted], feature_sets[set_name].val, "features", [id_col, label])
                own = own.withColumn("feature_set", F.lit(set_name))
                own.select([c.split()[0] for c in schema.split(", ")]).write.mode("overwrite").parquet(entry[task])
            return fitted, ""
        except Exception as problem:  # noqa: BLE001 - reported as a result row
            return None, str(problem)

    outcomes = dict(zip(tasks, side_by_side(spark, one, tasks, parallelism)))

    kept = {task: fitted for task, (fitted, _) in outcomes.items() if fitted is not None}
    errors = [(*task, problem) for task, (fitted, problem) in outcomes.items() if fitted is None]
    failed = spark.createDataFrame(errors, "model_name string, feature_set string, error string")
    if ledger and kept:
        return Sweep(spark.read.schema(schema).parquet(*[entry[t] for t in kept]), failed, kept)
    scores = spark.createDataFrame([], schema)
    for set_name, data in feature_sets.items():
        done = [kept[(name, set_name)] for name in models if (name, set_name) in kept]
        if done:
            scored = score_all(done, data.val, "features", [id_col, label])
            scores = scores.unionByName(scored.withColumn("feature_set", F.lit(set_name)))
    return Sweep(materialize(scores, "scores"), failed, kept)
