"""The whole run on a small planted task, and each model on it."""

import pytest
from pyspark.sql import functions as F

from entrypoint import tables
from lendlens.functions import hashed_uniform
from lendlens.operators import models
from lendlens.operators.metrics import auc
from lendlens.plans import experiments
from lendlens.plans.mart import KEY, TARGET, applicant_mart
from lendlens.plans.prepare import apply_params, load_or_prepare, load_params, prepare, verify
from lendlens.session import work_dir

SMALL = models.Settings(trees=20, rounds=5, max_iter=100)


@pytest.fixture(scope="module")
def mart(spark):
    return applicant_mart(tables.sources(spark, "/root/testdata/sf0.01"))


@pytest.fixture(scope="module")
def ready(spark, mart, tmp_path_factory):
    return prepare(mart, str(tmp_path_factory.mktemp("ready")))


def test_sets(ready):
    assert list(ready.sets) == ["all", "traditional", "alternative"]
    sizes = {n: len(s.features) for n, s in ready.sets.items()}
    assert sizes["all"] == sizes["traditional"] + sizes["alternative"]
    for data in ready.sets.values():
        counts = {r[TARGET]: r["count"] for r in data.train.groupBy(TARGET).count().collect()}
        assert counts[1] == counts[0] // 2
        assert data.val.count() == 300
        assert data.train.join(data.val, KEY).count() == 0
        assert {len(r["features"]) for r in data.val.select("features").collect()} == {len(data.features)}


def test_prepared_is_reused(spark, ready):
    def never():
        raise AssertionError("must not be built again")

    again = load_or_prepare(spark, ready.path, never)
    assert again.params == ready.params


def test_reused_only_for_equal_options_and_sources(spark, mart, tmp_path):
    small = mart.select(KEY, TARGET, "AMT_CREDIT", "EXT_SOURCE_1", "NAME_SEGMENT")
    built = []

    def build():
        built.append(1)
        return small

    path = str(tmp_path / "sets")
    for options in ({}, {}, {"seed": 7}, {"seed": 7}, {"seed": 7, "sources": {"application": [["/a", 1, 2]]}}):
        load_or_prepare(spark, path, build, **options)
    assert len(built) == 3
    ready = load_or_prepare(spark, path, build, seed=7, sources={"application": [["/a", 1, 2]]})
    assert len(built) == 3 and verify(ready).where("NOT unchanged").count() == 0
    # a set that was written again is told
    ready.sets["all"].val.limit(5).coalesce(1).write.mode("append").parquet(f"{path}/all/val")
    changed = verify(ready).where("NOT unchanged").collect()
    assert [(r["feature_set"], r["part"]) for r in changed] == [("all", "val")]


def test_preparation_leaves_nothing_but_the_sets(spark, mart, ready, tmp_path):
    import os

    folder = work_dir(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    again = load_or_prepare(spark, str(tmp_path / "sets"), lambda: applicant_mart(tables.sources(spark, "/root/testdata/sf0.01"), stored=True))
    assert set(os.listdir(folder)) == before
    for name, data in again.sets.items():
        assert data.features == ready.sets[name].features
        for own, other in ((data.train, ready.sets[name].train), (data.val, ready.sets[name].val)):
            keys = [df.select(KEY, TARGET).groupBy(KEY, TARGET).count() for df in (own, other)]
            assert keys[0].exceptAll(keys[1]).count() == 0 and own.count() == other.count()


def test_fit_on_train_differs(mart, ready, tmp_path):
    other = prepare(mart, str(tmp_path / "train"), fit_on="train")
    assert other.params.lambdas != ready.params.lambdas
    with pytest.raises(ValueError):
        prepare(mart, fit_on="some")


def test_new_rows_match_the_validation_rows(spark, mart, ready):
    params = load_params(spark, f"{ready.path}/params")
    new = apply_params(mart.drop(TARGET), params, "alternative").withColumnRenamed("features", "again")
    both = ready.sets["alternative"].val.join(new, KEY)
    gap = F.aggregate(F.zip_with("features", "again", lambda a, b: F.abs(a - b)), F.lit(0.0), lambda s, x: s + x)
    assert both.count() == 300 and both.agg(F.max(gap)).first()[0] < 1e-9


def test_new_rows_without_a_source(spark, ready):
    app = applicant_mart({"application": tables.application_inputs(spark, "/root/testdata/sf0.01")})
    rows = apply_params(app, ready.params, "all").select(F.size("features").alias("n")).distinct().collect()
    assert [r["n"] for r in rows] == [len(ready.sets["all"].features)]


@pytest.mark.parametrize("name", models.MODEL_NAMES)
def test_model_learns_and_survives_saving(spark, ready, tmp_path, name):
    data = ready.sets["all"]
    fitted = models.fit(name, data.train, "features", TARGET, SMALL)
    scored = models.score(fitted, data.val, "features")
    value = auc(scored, "score", TARGET).first()["auc"]
    assert value > (0.55 if name == "Decision_Tree" else 0.75)
    assert scored.filter("score < 0 OR score > 1").count() == 0
    models.save(spark, fitted, str(tmp_path / name))
    again = models.score(models.load(spark, str(tmp_path / name)), data.val, "features")
    assert scored.select(KEY, "score", "prediction").exceptAll(again.select(KEY, "score", "prediction")).count() == 0


def test_shuffled_target_is_not_learnt(ready):
    data = ready.sets["all"]
    noise = data.train.withColumn(TARGET, (hashed_uniform(F.col(KEY), "noise") < 0.3).cast("int"))
    fitted = models.fit("Logistic_Regression", noise, "features", TARGET, SMALL)
    assert abs(auc(models.score(fitted, data.val, "features"), "score", TARGET).first()["auc"] - 0.5) < 0.2


def test_linear_model_is_least_squares(spark):
    rows = [(i, int(i >= 5), [float(i), float(i % 3)]) for i in range(10)]
    df = spark.createDataFrame(rows, "k bigint, y int, f array<double>")
    fitted = models.fit("Linear_Regression", df, "f", "y")
    import numpy as np

    x = np.array([[1.0, *r[2]] for r in rows])
    want = np.linalg.lstsq(x, np.array([r[1] for r in rows]), rcond=None)[0]
    assert list(fitted.model.coefficients) == pytest.approx(want[1:]) and fitted.model.intercept == pytest.approx(want[0])
    scored = models.score(fitted, df, "f").orderBy("k").collect()
    assert [r["score"] for r in scored] == pytest.approx(np.clip(x @ want, 0, 1))
    assert [r["prediction"] for r in scored] == [r[1] for r in rows]


def test_selection():
    assert models.select_models("0") == list(models.MODEL_NAMES) == models.select_models("77")
    assert models.select_models("99") == list(models.QUICK_MODELS) == models.select_models("x,1") == models.select_models(None)
    assert models.select_models("8, 1,40") == ["SVM", "Linear_Regression"]
    assert models.select_models("all") == list(models.MODEL_NAMES) and models.select_models("") == list(models.QUICK_MODELS)
    assert models.select_models("LightGBM,SVM") == ["LightGBM", "SVM"] and models.select_models("40") == []


def test_sweep_goes_on_after_a_failure(spark, ready, monkeypatch):
    plain = models.estimator

    def failing(name, *rest):
        if name == "SVM":
            raise RuntimeError("no luck")
        return plain(name, *rest)

    monkeypatch.setattr(models, "estimator", failing)
    swept = models.sweep(ready.sets, ["Logistic_Regression", "SVM"], KEY, TARGET, SMALL)
    assert swept.scores.count() == 900
    assert {tuple(r)[:2] for r in swept.errors.collect()} == {("SVM", s) for s in ready.sets}
    results = experiments.evaluate(ready, swept)
    assert results.metrics.count() == 3 and results.impact.count() == 1
    assert results.thin_profile.count() == 3 and results.report.count() == 6
    lost = results.report.where("error IS NOT NULL").collect()
    assert {(r["model_name"], r["category"], r["auc_score"]) for r in lost} == {("SVM", "Others", None)}
    assert all("no luck" in r["error"] for r in lost)


def test_sweep_goes_on_from_its_ledger(spark, ready, monkeypatch, tmp_path):
    """Three fits end, the others are stopped; the next sweep fits those only."""
    plain, fitted = models.fit_prepared, []

    def stopping(name, *rest):
        if len(fitted) == 3:
            raise KeyboardInterrupt("stopped")
        fitted.append(name)
        return plain(name, *rest)

    names = ["Logistic_Regression", "Linear_Regression"]
    sweep = lambda run="a": models.sweep(ready.sets, names, KEY, TARGET, SMALL, str(tmp_path), parallelism=1, run=run)
    monkeypatch.setattr(models, "fit_prepared", stopping)
    with pytest.raises(KeyboardInterrupt):
        sweep()
    monkeypatch.setattr(models, "fit_prepared", lambda name, *rest: fitted.append(name) or plain(name, *rest))
    again = sweep()
    assert len(fitted) == 6 and len(again.fitted) == 6 and again.scores.count() == 6 * 300
    assert sweep().scores.count() == 6 * 300 and len(fitted) == 6
    whole = models.sweep(ready.sets, names, KEY, TARGET, SMALL)
    columns = [KEY, "model_name", "feature_set", "prediction"]
    assert whole.scores.select(columns).exceptAll(again.scores.select(columns)).count() == 0
    sweep("other data")
    assert len(fitted) == 18


def test_run_from_paths(spark, tmp_path):
    for name, df in tables.sources(spark, "/root/testdata/sf0.01").items():
        df.write.parquet(str(tmp_path / name))
    paths = {n: str(tmp_path / n) for n in ("application", *tables.SIDES)}
    work = str(tmp_path / "work")
    results = experiments.run(spark, paths, work, selection="2", settings=SMALL, results_to=str(tmp_path / "out"))
    best = results.best.first()
    assert best["auc_score"] > 0.75 and best["model_name"] == "Logistic_Regression"
    assert spark.read.option("header", True).csv(str(tmp_path / "out" / "report")).count() == 3
    new = {n: p for n, p in paths.items() if n != "bureau_balance"}
    scores = experiments.score_new(spark, new, work, "Logistic_Regression")
    assert scores.count() == 1500 and scores.columns == [KEY, "score", "prediction"]


def test_text_quality_is_learnt_from_whole_texts(spark, tmp_path):
    """A second task with a real signal: rare low-quality documents, told by simple shares of their text."""
    d = "/root/testdata/sf0.01"
    words = F.split(F.trim("text"), r"\s+")
    size = F.length("text").cast("double")
    inputs = (
        spark.read.parquet(f"{d}/documents.parquet")
        .join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id")
        .select(
            F.col("doc_id").alias(KEY),
            (F.col("quality") == 0).cast("int").alias(TARGET),
            (1 - F.length(F.regexp_replace("text", r"[\p{Punct}]", "")) / size).alias("PUNCT_SHARE"),
            (F.length(F.regexp_replace("text", r"[^\p{L}]", "")) / size).alias("LETTER_SHARE"),
            (F.size(F.array_distinct(words)) / F.size(words)).alias("DISTINCT_SHARE"),
            (size / F.size(words)).alias("WORD_LENGTH"),
            F.col("n_chars").alias("AMT_CHARS"),
        )
    )
    ready = prepare(inputs, str(tmp_path / "text"))
    assert list(ready.sets) == ["all", "traditional"] and "AMT_CHARS" in ready.params.lambdas
    for name in ("Logistic_Regression", "Random_Forest"):
        fitted = models.fit(name, ready.sets["all"].train, "features", TARGET, SMALL)
        assert auc(models.score(fitted, ready.sets["all"].val, "features"), "score", TARGET).first()["auc"] > 0.8


def test_train_partitions_do_not_grow_in_number_with_the_rows(spark, monkeypatch):
    rows = spark.range(0, 64_000, 1, 64).selectExpr("id", "array(double(id), 1D) AS f")
    monkeypatch.setattr(models, "PARTITION_BYTES", 16_000)
    cores = spark.sparkContext.defaultParallelism
    assert models._packed(rows, "f").rdd.getNumPartitions() == 2 * cores
    monkeypatch.setattr(models, "MOST_BYTES", 32_000)
    assert models._packed(rows, "f").rdd.getNumPartitions() == 32


def test_a_fit_keeps_no_second_copy_of_the_rows(spark, ready, monkeypatch):
    import os

    seen, plain = [], models.fit_prepared
    monkeypatch.setattr(models, "fit_prepared", lambda name, train, *rest: seen.append(train.is_cached) or plain(name, train, *rest))
    folder = work_dir(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    for name in ("Linear_Regression", "Logistic_Regression", "SVM", "Extra_Trees"):
        models.fit(name, ready.sets["alternative"].train, "features", TARGET, models.Settings(trees=3, max_iter=5))
    assert seen == [False] * 4 and set(os.listdir(folder)) == before
    assert spark.sparkContext._jsc.getPersistentRDDs().isEmpty()
