"""One query per operator: the library functions bound to the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from entrypoint import tables as t
from lendlens.functions import hashed_uniform, yeo_johnson
from lendlens.functions.numeric import quoted, sql_name
from lendlens.operators import encode, families, metrics, models, ordered, power, report, rollup, scale, split, thinfile
from lendlens.operators.clean import clean, derive
from lendlens.operators.neighbors import neighbors
from lendlens.operators.oversample import new_row_count, smote, synthetic_rows
from lendlens.plans import experiments
from lendlens.plans.mart import applicant_mart, credit_history
from lendlens.plans.prepare import Params, Prepared, apply_params, load_or_prepare, verify
from lendlens.session import materialize, work_dir

KEY, TARGET = t.KEY, t.TARGET
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


def r(value: Column | str, places: int = 6) -> Column:
    """Rounded for comparison with another engine; moved a little off the ties of rounding, on both sides."""
    col = F.col(value) if isinstance(value, str) else value
    return F.round(col.cast("double") + F.lit(float(f"3.7e-{places + 2}")), places) + F.lit(0.0)


def rounded(df: DataFrame, places: int = 6, keep: tuple[str, ...] = ()) -> DataFrame:
    """Every double column rounded as by ``r``."""
    out = []
    for n, kind in df.dtypes:
        name = sql_name(n)
        rounds = kind == "double" and n not in keep
        out.append(f"round({name} + {float(f'3.7e-{places + 2}')!r}D, {places}) + 0D AS {name}" if rounds else name)
    return df.selectExpr(*out)


# ---- roll-ups and the mart -------------------------------------------------------------------


@query
def monthly_status_rollup(spark, d):
    return rounded(rollup.status_rollup(t.bureau_balance(spark, d), "SK_ID_BUREAU"))


@query
def credit_history_rollup(spark, d):
    return rounded(credit_history(t.bureau(spark, d), t.bureau_balance(spark, d)), 4)


@query
def orders_rollup(spark, d):
    return rounded(rollup.rollup_numeric(t.previous_application(spark, d), KEY, "PREV", ("SK_ID_PREV",)), 4)


@query
def events_rollup(spark, d):
    return rounded(rollup.rollup_numeric(t.credit_card_balance(spark, d), KEY, "CC", ("SK_ID_PREV",)))


@query
def payment_features(spark, d):
    payments = rollup.payment_features(t.installments_payments(spark, d))
    return rounded(rollup.rollup_numeric(payments, KEY, "INST", ("SK_ID_PREV",)), 4)


@query
def applicant_mart_full(spark, d):
    return rounded(applicant_mart(t.sources(spark, d)), 4)


QUERIES["applicant_mart"] = QUERIES.pop("applicant_mart_full")


@query
def mart_optional_source(spark, d):
    absent = ("bureau_balance", "credit_card_balance", "pos_cash_balance")
    return rounded(applicant_mart(t.sources(spark, d, without=absent)), 4)


# ---- derived columns and cleaning ------------------------------------------------------------


@query
def derived_ratios(spark, d):
    df = derive(t.application_inputs(spark, d))
    return rounded(df.select(KEY, "CREDIT_INCOME_RATIO", "ANNUITY_INCOME_RATIO", "CREDIT_GOODS_RATIO"))


@query
def derived_years(spark, d):
    df = derive(t.application_inputs(spark, d))
    return rounded(df.select(KEY, "AGE_YEARS", "EMPLOYMENT_YEARS", "DAYS_EMPLOYED_PERCENT"))


@query
def row_score_stats(spark, d):
    df = derive(t.application_inputs(spark, d))
    return rounded(df.select(KEY, *[f"EXT_SOURCE_{s}" for s in ("MEAN", "STD", "MIN", "MAX")]))


@query
def clean_nonfinite(spark, d):
    """Balance over region number, infinite where the region number is 0, next to columns with nulls."""
    app = t.application_inputs(spark, d)
    zone = F.col("REGION_RATING_CLIENT") - 1
    infinite = F.when(zone == 0, F.lit(float("inf"))).otherwise(F.try_divide(F.col("AMT_INCOME_TOTAL"), zone))
    dirty = app.select(
        KEY,
        infinite.alias("RATIO_INF"),
        F.when(zone == 1, F.lit(float("nan"))).otherwise(F.col("AMT_CREDIT")).alias("RATIO_NAN"),
        "AMT_ANNUITY",
        "NAME_SEGMENT",
    )
    return rounded(clean(dirty, keep=(KEY,)))


# ---- skew and power transform ----------------------------------------------------------------


def _clean_mart(spark, d) -> DataFrame:
    return materialize(clean(applicant_mart(t.sources(spark, d)), keep=(KEY, TARGET)), "mart")


@query
def skew_profile(spark, d):
    mart = _clean_mart(spark, d).drop(KEY, TARGET)
    table = power.skew_table(mart, power.candidates(mart))
    chosen = (F.abs(F.col("skew")) > power.SKEW_LIMIT).cast("int")
    return table.select("column", "n", r("skew").alias("skew"), F.coalesce(chosen, F.lit(0)).alias("chosen"))


@query
def yeo_johnson_grid(spark, d):
    lines = t.read(spark, d, "lineitem").select("l_extendedprice", "l_quantity")
    grid = power.even_grid(-1.0, 2.0)
    table = power.likelihood_grid(power.signed_logs(lines, lines.columns), {0: grid, 1: grid})
    name = F.when(F.col("c") == 0, lines.columns[0]).otherwise(lines.columns[1])
    return table.select(name.alias("column"), r("lambda", 4).alias("lambda"), r("loglik", 2).alias("loglik"))


@query
def yeo_johnson_apply(spark, d):
    events = t.read(spark, d, "events").select("event_id", (F.col("value") - 20.0).alias("v"))
    return events.select(
        "event_id",
        *[r(yeo_johnson(F.col("v"), F.lit(lam))).alias(n) for n, lam in (("half", 0.5), ("zero", 0.0), ("two", 2.0), ("minus", -0.25))],
    )


@query
def yeo_johnson_mart(spark, d):
    """The fitted lambda of every skewed column and the skew that is left."""
    mart = _clean_mart(spark, d).drop(KEY, TARGET)
    lambdas = power.fit_power(mart)
    after = power.skew_table(power.apply_power(mart, lambdas), list(lambdas))
    fitted = spark.createDataFrame(list(lambdas.items()), "column string, lambda double")
    return fitted.join(after, "column").select("column", r("lambda", 4).alias("lambda"), r("skew", 4).alias("skew_after"))


# ---- categories and families -----------------------------------------------------------------

TEXT = ["NAME_SEGMENT", "ORGANIZATION_NATION", "FLAG_OWN_CAR"]


@query
def category_profile(spark, d):
    return encode.category_profile(encode.category_counts(t.application_inputs(spark, d), TEXT))


@query
def top5_categories(spark, d):
    return encode.top_categories(encode.category_counts(t.application_inputs(spark, d), TEXT))


@query
def label_encode_binary(spark, d):
    app = t.application_inputs(spark, d).select(KEY, "FLAG_OWN_CAR")
    return encode.apply_categories(app, encode.fit_categories(app, ["FLAG_OWN_CAR"]))


@query
def one_hot_top5(spark, d):
    """The 0/1 columns in long form, as their names come from the data."""
    app = t.application_inputs(spark, d).select(KEY, *TEXT[:2])
    wide = encode.apply_categories(app, encode.fit_categories(app, TEXT[:2]))
    flags = [c for c in wide.columns if c != KEY]
    return wide.unpivot([KEY], [quoted(c) for c in flags], "feature", "flag")


@query
def feature_family(spark, d):
    """Family and place of every numeric mart column, with its mean over all applicants."""
    mart = applicant_mart(t.sources(spark, d))
    cols = [c for c, kind in mart.dtypes if kind != "string" and c not in (KEY, TARGET)]
    catalog = families.catalog(spark, cols)
    means = power.long_form(clean(mart), cols).groupBy("column").agg(F.avg("value").alias("mean"))
    joined = catalog.join(means, F.col("name") == F.col("column"))
    return joined.select("name", "family", "pos", r("mean", 3).alias("mean"))


@query
def feature_set_columns(spark, d):
    mart = clean(applicant_mart(t.sources(spark, d)), keep=(KEY, TARGET))
    numeric = [c for c, kind in mart.dtypes if kind != "string"]
    return rounded(mart.select(KEY, *families.features_of(numeric)["alternative"]))


# ---- split, scale, oversample ----------------------------------------------------------------


@query
def class_balance(spark, d):
    return split.class_counts(t.planted_target(spark, d), TARGET)


@query
def stratified_split(spark, d):
    df = split.stratified(t.planted_target(spark, d), KEY, TARGET)
    return df.select(KEY, TARGET, F.col("is_val").cast("int").alias("is_val"))


def _vectors(spark, d) -> DataFrame:
    return t.read(spark, d, "embeddings").select(
        "vec_id", (F.col("label") == 0).cast("int").alias(TARGET), F.col("embedding").cast("array<double>").alias("v")
    )


def _scaled_vectors(spark, d) -> DataFrame:
    vectors = _vectors(spark, d)
    scaler = scale.fit_vector_scaler(vectors, "v", 64)
    return scale.scale_vector(vectors, "v", scaler).select("vec_id", TARGET, "features")


@query
def standard_scale(spark, d):
    cells = _scaled_vectors(spark, d).select("vec_id", F.posexplode("features").alias("pos", "value"))
    return cells.select("vec_id", "pos", r("value").alias("value"))


def _total(vec: str = "features") -> Column:
    return F.aggregate(vec, F.lit(0.0), lambda acc, x: acc + x)


@query
def minority_neighbors(spark, d):
    rare = _vectors(spark, d).filter(F.col(TARGET) == 1)
    return neighbors(rare, "vec_id", "v").select("a", "b", "rank", r("distance").alias("distance"))


def _counts(df: DataFrame) -> tuple[int, int]:
    return tuple(df.agg(F.count_if(F.col(TARGET) == 1), F.count_if(F.col(TARGET) == 0)).first())


@query
def smote_samples(spark, d):
    vectors = _vectors(spark, d)
    n_minor, n_major = _counts(vectors)
    made = synthetic_rows(vectors.filter(F.col(TARGET) == 1), "vec_id", "v", new_row_count(n_minor, n_major), n_minor)
    return made.select("i", "a", "b", r("u").alias("u"), r(_total("v")).alias("total"), r(F.get("v", F.lit(0))).alias("first"))


@query
def smote_balanced(spark, d):
    """All rows after oversampling, synthetic ones with ids below 0."""
    balanced = smote(_vectors(spark, d), "vec_id", "v", TARGET)
    return balanced.select("vec_id", TARGET, r(_total("v")).alias("total"))


# ---- metrics on fixed scores -----------------------------------------------------------------


def base_scores(spark, d) -> DataFrame:
    """Per applicant: label and two signals, one from the order history and one from the balance."""
    return t.order_signals(spark, d).select(
        KEY,
        TARGET,
        r(F.col("price") / 500000.0).alias("trad"),
        r((F.col("balance") + 1000.0) / 11000.0).alias("alt"),
    )


def fixed_scores(base: DataFrame) -> DataFrame:
    """Scores of 8 x 3 experiments: mixtures of the signals and hashed noise that grows with the model
    number; models with an even number round to 2 places, so that they tie."""
    rows = []
    for number, name in enumerate(models.MODEL_NAMES, start=1):
        noise = (0.05 * number) * hashed_uniform(F.col(KEY), name)
        for feature_set, signal in (
            ("all", 0.6 * F.col("trad") + 0.4 * F.col("alt")),
            ("traditional", F.col("trad")),
            ("alternative", F.col("alt")),
        ):
            value = r(signal + noise, 2 if number % 2 == 0 else 6)
            rows.append(
                F.struct(F.lit(name).alias("model_name"), F.lit(feature_set).alias("feature_set"), value.alias("score"))
            )
    return base.select(KEY, TARGET, F.inline(F.array(*rows)))


def fixed_masks(base: DataFrame) -> DataFrame:
    """(key, feature_set, is_thin): the fifth with the lowest history signal, or balance signal."""
    low_trad = ordered.percentile_value(base, "trad", thinfile.LOW_SHARE)
    low_alt = ordered.percentile_value(base, "alt", thinfile.LOW_SHARE)
    flags = [
        ("all", F.col("trad") < low_trad),
        ("traditional", F.col("trad") < low_trad),
        ("alternative", F.col("alt") < low_alt),
    ]
    rows = F.array(*[F.struct(F.lit(n).alias("feature_set"), flag.alias("is_thin")) for n, flag in flags])
    return base.select(KEY, F.inline(rows))


EXPERIMENT = experiments.EXPERIMENT


def _fixed_metrics(spark, d) -> DataFrame:
    scores = materialize(fixed_scores(base_scores(spark, d)), "scores")
    table = experiments.metrics_of(scores, {"all": 2, "traditional": 1, "alternative": 1})
    return materialize(table, "metrics")


def _flagged(spark, d) -> DataFrame:
    base = base_scores(spark, d)
    return materialize(fixed_scores(base).join(fixed_masks(base), [KEY, "feature_set"]), "flagged")


def _thin_metrics(spark, d) -> DataFrame:
    return thinfile.slice_metrics(_flagged(spark, d), KEY, "score", TARGET, "is_thin", EXPERIMENT)


@query
def auc_exact(spark, d):
    table = metrics.auc(fixed_scores(base_scores(spark, d)), "score", TARGET, EXPERIMENT)
    return table.select(*EXPERIMENT, "n_pos", "n_neg", r("auc", 9).alias("auc"))


@query
def acceptance_curve(spark, d):
    base = base_scores(spark, d)
    table = metrics.acceptance_curve(base, KEY, "trad", TARGET)
    return table.select(KEY, "n", "bad", r("bad_rate", 9).alias("bad_rate"))


@query
def acceptance_at_bad_rate(spark, d):
    table = metrics.acceptance(fixed_scores(base_scores(spark, d)), KEY, "score", TARGET, by=EXPERIMENT)
    return rounded(table.withColumn("is_fallback", F.col("is_fallback").cast("int")), 9)


@query
def acceptance_fallback(spark, d):
    """Bad applicants first: no cut qualifies and the best tenth is taken."""
    base = base_scores(spark, d)
    reverse = r(0.5 * hashed_uniform(F.col(KEY), "reverse") + 0.5 * (1 - F.col(TARGET)))
    table = metrics.acceptance(base.withColumn("score", reverse), KEY, "score", TARGET)
    return rounded(table.withColumn("is_fallback", F.col("is_fallback").cast("int")), 9)


@query
def experiment_metrics(spark, d):
    return rounded(_fixed_metrics(spark, d), 9)


@query
def threshold_search(spark, d):
    base = base_scores(spark, d)
    found = metrics.threshold_search(base.withColumn("score", 0.6 * F.col("trad") + 0.4 * F.col("alt")), "score", TARGET)
    return rounded(found, 9)


@query
def threshold_curve(spark, d):
    return rounded(metrics.threshold_curve(base_scores(spark, d), "alt", TARGET), 9)


@query
def percentile_exact(spark, d):
    """20th percentile of price and quantity per ship mode of return, over all lines."""
    lines = t.read(spark, d, "lineitem").select("l_returnflag", "l_extendedprice")
    return rounded(ordered.percentile(lines, "l_extendedprice", 0.2, ["l_returnflag"]), 4)


# ---- thin files ------------------------------------------------------------------------------

CREDIT_SPACE = [
    "BUREAU_AMT_CREDIT_SUM_mean",
    "BUREAU_DAYS_CREDIT_min",
    "AMT_CREDIT",
    "AMT_INCOME_TOTAL",
    "CREDIT_GOODS_RATIO",
    "CNT_CHILDREN",
]


def _credit_space(spark, d) -> DataFrame:
    """Validation rows with six scaled columns, scaled by the train rows."""
    sources = {n: df for n, df in t.sources(spark, d).items() if n in ("application", "bureau")}
    mart = clean(applicant_mart(sources), keep=(KEY, TARGET)).select(KEY, TARGET, *CREDIT_SPACE)
    rows = split.stratified(materialize(mart, "credit"), KEY, TARGET)
    scaler = scale.fit_scaler(rows.filter("NOT is_val"), CREDIT_SPACE)
    return scale.scale_to_array(rows.filter("is_val"), scaler, [KEY, TARGET])


def _flag(df: DataFrame) -> DataFrame:
    return df.withColumn("is_thin", F.col("is_thin").cast("int"))


@query
def thin_mask_family(spark, d):
    return _flag(thinfile.mask_family(_credit_space(spark, d), KEY, "features", CREDIT_SPACE))


@query
def thin_mask_std(spark, d):
    return _flag(thinfile.mask_spread(_scaled_vectors(spark, d), "vec_id", "features", "std"))


@query
def thin_mask_variance(spark, d):
    return _flag(thinfile.mask_spread(_scaled_vectors(spark, d), "vec_id", "features", "var", floor=False))


@query
def thin_mask_floor(spark, d):
    rare = t.read(spark, d, "customer").select(F.col("c_custkey").alias(KEY), (F.col("c_acctbal") < -700.0).alias("is_thin"))
    return _flag(thinfile.with_floor(rare, KEY, "is_thin"))


@query
def thin_file_profile(spark, d):
    base = base_scores(spark, d)
    return rounded(thinfile.profile(base.join(fixed_masks(base), KEY), "is_thin", TARGET, ["feature_set"]), 9)


@query
def thin_file_metrics(spark, d):
    return rounded(_thin_metrics(spark, d), 9)


@query
def thin_family_gain(spark, d):
    gains = report.thin_family_gain(_thin_metrics(spark, d))
    return rounded(gains.withColumn("same_rows", F.col("same_rows").cast("int")), 9)


@query
def thin_gain_summary(spark, d):
    return rounded(report.thin_gain_summary(report.thin_family_gain(_thin_metrics(spark, d))), 9)


# ---- reports ---------------------------------------------------------------------------------


def _impact(spark, d) -> DataFrame:
    """Family against family on one mask for all feature sets."""
    base = base_scores(spark, d)
    low = ordered.percentile_value(base, "trad", thinfile.LOW_SHARE)
    thin = fixed_scores(base.filter(F.col("trad") < low))
    return materialize(report.alternative_impact(metrics.auc(thin, "score", TARGET, EXPERIMENT)), "impact")


@query
def alternative_impact(spark, d):
    return rounded(_impact(spark, d), 9)


@query
def impact_summary(spark, d):
    return rounded(report.impact_summary(_impact(spark, d)), 9)


@query
def family_difference(spark, d):
    return rounded(report.family_difference(_fixed_metrics(spark, d)), 9)


@query
def metric_pivot(spark, d):
    return rounded(report.metric_pivot(_fixed_metrics(spark, d), "auc_score"), 9)


@query
def acceptance_pivot(spark, d):
    return rounded(report.metric_pivot(_fixed_metrics(spark, d), "acceptance_rate"), 9)


@query
def avg_by_feature_set(spark, d):
    return rounded(report.averages(_fixed_metrics(spark, d)), 9)


def _both_metrics(spark, d) -> tuple[DataFrame, DataFrame]:
    """Metrics on all rows and per slice, from scores written once."""
    flagged = _flagged(spark, d)
    overall = experiments.metrics_of(flagged, {"all": 2, "traditional": 1, "alternative": 1})
    return overall, thinfile.slice_metrics(flagged, KEY, "score", TARGET, "is_thin", EXPERIMENT)


@query
def model_report(spark, d):
    return rounded(report.consolidated(*_both_metrics(spark, d)), 9)


@query
def top10_models(spark, d):
    return rounded(report.top(_fixed_metrics(spark, d), 10).select(*EXPERIMENT, "auc_score", "acceptance_rate"), 9)


@query
def top5_models(spark, d):
    return rounded(report.top(_fixed_metrics(spark, d), 5).select(*EXPERIMENT, "auc_score"), 9)


@query
def best_configuration(spark, d):
    """Best experiment on all rows and best on thin files."""
    overall, thin = _both_metrics(spark, d)
    first = report.best(overall).select(
        F.lit("overall").alias("scope"), *EXPERIMENT, F.col("auc_score").alias("auc"), "acceptance_rate"
    )
    second = report.best(thin, "auc_thin_file").select(
        F.lit("thin_file").alias("scope"),
        *EXPERIMENT,
        F.col("auc_thin_file").alias("auc"),
        F.col("acceptance_thin_file").alias("acceptance_rate"),
    )
    return rounded(first.unionByName(second), 9)


# ---- prepared sets, models, experiments ------------------------------------------------------


def prepared(spark, d) -> Prepared:
    """Prepared once per session and table folder, then read back."""
    folder = d.rstrip("/").replace("/", "_")
    return load_or_prepare(spark, f"{work_dir(spark)}/sets{folder}", lambda: applicant_mart(t.sources(spark, d), stored=True))


@query
def prepared_roundtrip(spark, d):
    """Rows per class of every prepared set, read back from disk."""
    prepared(spark, d)
    again = prepared(spark, d)
    parts = None
    for name, data in again.sets.items():
        for part, df in (("train", data.train), ("val", data.val)):
            one = df.groupBy(TARGET).agg(F.count("*").alias("cnt")).withColumns(
                {"feature_set": F.lit(name), "part": F.lit(part)}
            )
            parts = one if parts is None else parts.unionByName(one)
    return parts.select("feature_set", "part", TARGET, "cnt")


@query
def prepared_digests(spark, d):
    """Rows of every prepared set, and whether its content is what the manifest says."""
    rows = verify(prepared(spark, d))
    return rows.withColumn("unchanged", F.col("unchanged").cast("int"))


NEW_LAMBDAS = {"AMT_CREDIT": 0.5, "AMT_INCOME_TOTAL": 0.25}


@query
def preprocess_new_rows(spark, d):
    """State fitted on train rows, with given lambdas, applied to the raw validation rows; long form."""
    app = derive(t.application(spark, d))
    rows = split.stratified(materialize(app, "application"), KEY, TARGET)
    train = clean(rows.filter("NOT is_val").drop("is_val"), keep=(KEY, TARGET))
    encodings = encode.fit_categories(train.drop(KEY, TARGET))
    ready = encode.apply_categories(power.apply_power(train, NEW_LAMBDAS), encodings)
    cols = families.features_of(ready.columns)["all"]
    params = Params(NEW_LAMBDAS, encodings, scale.fit_scaler(ready, cols), {"all": cols})
    new = apply_params(rows.filter("is_val").drop("is_val", TARGET), params, "all")
    names = F.array(*[F.lit(c) for c in cols])
    cells = new.select(KEY, F.posexplode("features").alias("pos", "value"))
    return cells.select(KEY, F.get(names, F.col("pos")).alias("feature"), r("value").alias("value"))


def _model_query(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark, d):
        data = prepared(spark, d).sets["all"]
        fitted = models.fit(name, data.train, "features", TARGET)
        return models.score(fitted, data.val, "features").select(KEY, TARGET, "score", "prediction")

    return run


for _name in models.MODEL_NAMES:
    QUERIES[f"model_{_name.lower()}"] = _model_query(_name)


@query
def model_roundtrip(spark, d):
    """A saved and reloaded model gives the same scores."""
    data = prepared(spark, d).sets["all"]
    fitted = models.fit("Logistic_Regression", data.train, "features", TARGET)
    path = f"{work_dir(spark)}/roundtrip-model"
    models.save(spark, fitted, path)
    before = models.score(fitted, data.val, "features").select(KEY, F.col("score").alias("before"))
    after = models.score(models.load(spark, path), data.val, "features").select(KEY, "score")
    both = before.join(after, KEY)
    return both.agg(F.count("*").alias("n_rows"), F.count_if(F.col("before") != F.col("score")).alias("n_different"))


@query
def score_new_rows(spark, d):
    """All applicants without their target through the saved state and a model."""
    ready = prepared(spark, d)
    fitted = models.fit("Logistic_Regression", ready.sets["all"].train, "features", TARGET)
    new = apply_params(applicant_mart(t.sources(spark, d, target=False), stored=True), ready.params, "all")
    return models.score(fitted, new, "features").select(KEY, "score", "prediction")


@query
def experiment_sweep(spark, d):
    """All 24 experiments: metrics on all validation rows and on thin files."""
    ready = prepared(spark, d)
    swept = models.sweep(ready.sets, list(models.MODEL_NAMES), KEY, TARGET)
    results = experiments.evaluate(ready, swept)
    return results.report
