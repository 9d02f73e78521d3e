"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

Features of a whole text: densities of a word list and of a lexicon learned from labelled rows, listed
words near a word of the second person, share of capitals, punctuation, and obfuscated words. Trees are
fitted on a bounded sample of labelled rows, calibrated on other labelled rows, and applied to all. A class
is drawn at its own rate, so each row weighs the inverse of it: scores keep the prior of all labelled rows.

Odd input: null and empty texts have zero features and get the score of those; repeated rows are kept;
labels of ids without a text and null labels are ignored; an id with several labels is toxic if one says
so; with labels of one class only, the score is that class's share for every text. Other columns of the
inputs are ignored (``keep_clean`` keeps them).
"""

from __future__ import annotations

import re
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendlens.llm.common import per_batch, without
from lendlens.session import materialize

THRESHOLD = 0.3
#: Most labelled rows used to fit, chosen by a hash of the id; a class has at most half of them.
SAMPLE = 20_000
LEXICON = 200
NEAR = 6

# Common insults
INSULTS = (
    "idiot moron stupid dumb loser trash scum worthless pathetic disgusting clown garbage fool jerk creep "
    "imbecile filth vermin ugly freak liar coward bastard bitch damn crap"
).split()
SECOND_PERSON = "you your yours yourself youre u ur".split()
# Characters written for letters
LEET = str.maketrans("01345$@!7", "oleassait")

_WORD = re.compile(r"[^\W_]+(?:['’][^\W_]+)?")
_MASKED = re.compile(r"\b[A-Za-z]+[@$*!013457]+[A-Za-z]+\b|\b(?:[A-Za-z][.\-_*]){3,}[A-Za-z]\b")
NAMES = (
    "insults near_you learned any_insult any_learned capitals shouted punctuation exclaim masked masked_hits "
    "log_words second insult_count learned_count"
).split()


def features(text: str, learned: dict[str, float], insults: frozenset = frozenset(INSULTS)) -> list[float]:
    """One value for each of ``NAMES``."""
    tokens = _WORD.findall(text)
    low = [t.lower() for t in tokens]
    n = len(low) or 1
    size = len(text) or 1
    hits = [i for i, w in enumerate(low) if w in insults]
    you = [i for i, w in enumerate(low) if w in _YOU]
    # the first word of the second person within or after a hit's reach decides
    near = sum((k := bisect_left(you, i - NEAR)) < len(you) and you[k] <= i + NEAR for i in hits)
    # a learned entry is a word, or a stem of four letters and a star
    weights = [x for w in low if (x := learned.get(w) or (len(w) > 4 and learned.get(w[:4] + "*")))]
    masked = _MASKED.findall(text)
    plain = [re.sub(r"[.\-_*]", "", m.translate(LEET)).lower() for m in masked]
    capitals = sum(map(str.isupper, tokens))
    upper = len(re.findall(r"[A-Z]", text))
    marks = len(re.findall(r"[^\w\s]", text))
    return [
        len(hits) / n,
        near / n,
        sum(weights) / n,
        float(bool(hits)),
        float(bool(weights)),
        upper / size,
        capitals / n,
        marks / size,
        (text.count("!") + text.count("?")) / size,
        len(masked) / n,
        sum(p in insults or p in learned for p in plain) / n,
        float(np.log1p(len(low))),
        len(you) / n,
        float(len(hits)),
        float(len(weights)),
    ]


_YOU = frozenset(SECOND_PERSON)


def held_out(doc_id: Column | str) -> Column:
    """Rows whose labels are never learned from."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2


def _sample(documents: DataFrame, labels: DataFrame, sample: int) -> DataFrame:
    """(doc_id, text, toxic, weight, draw) of at most ``sample`` labelled rows outside the held-out ones."""
    own = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    own = own.where(~F.coalesce(held_out("doc_id"), F.lit(False)))
    draw = F.pmod(F.xxhash64(F.lit("toxicity"), "doc_id"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    sizes = {r["toxic"]: r["n"] for r in own.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    share = F.lit(1.0)
    for value, n in sizes.items():
        share = F.when(F.col("toxic") == value, F.lit(min(1.0, sample / 2 / n))).otherwise(share)
    own = own.withColumn("draw", draw).withColumn("weight", 1 / share).where(F.col("draw") < share)
    own = own.select("doc_id", (F.col("toxic") > 0).cast("int").alias("toxic"), "weight", F.xxhash64(F.lit("fold"), "doc_id").alias("draw"))
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    # about ``sample`` rows of a few numbers; the texts stay where they are
    return texts.join(F.broadcast(own), "doc_id")


def learn_lexicon(sample: DataFrame, size: int = LEXICON) -> dict[str, float]:
    """Words and four-letter stems with the largest log-odds of the toxic class, by documents that hold them,
    at least five."""
    found = F.regexp_extract_all(F.lower("text"), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))
    stems = F.transform(F.filter(found, lambda w: F.length(w) > 4), lambda w: F.concat(F.substring(w, 1, 4), F.lit("*")))
    word = F.explode(F.array_distinct(F.concat(found, stems)))
    totals = sample.groupBy("toxic").count().collect()
    n = {r["toxic"]: r["count"] for r in totals}
    if len(n) < 2:
        return {}
    counts = sample.select("toxic", word.alias("word")).groupBy("word").agg(
        F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c")
    )
    odds = F.log((F.col("t") + 0.5) / n[1]) - F.log((F.col("c") + 0.5) / n[0])
    best = counts.where("t >= 5").withColumn("odds", odds).where("odds > 2.5")
    return {r["word"]: float(r["odds"]) for r in best.orderBy(F.desc("odds"), "word").limit(size).collect()}


def _featured(df: DataFrame, learned: dict[str, float], keep: str) -> DataFrame:
    names = [c.split()[0] for c in keep.split(", ")]

    def work(batch: pa.RecordBatch) -> dict:
        values = [features(t or "", learned) for t in batch.column("text").to_pylist()]
        return {n: batch.column(n) for n in names} | {"values": values}

    out = per_batch(df.select(*names, "text"), work, f"{keep}, values array<double>")
    return out.select(*names, array_to_vector("values").alias("features"))


class Scorer:
    """A fitted model: lexicon, trees and calibration."""

    def __init__(self, documents: DataFrame, labels: DataFrame, sample: int = SAMPLE):
        rows = materialize(_sample(documents, labels, sample), "labelled")
        self.share = float(rows.agg(F.sum(F.col("toxic") * F.col("weight")) / F.sum("weight")).first()[0] or 0.0)
        self.trees = None
        if not 0 < self.share < 1:
            return
        fit, rest = rows.where("pmod(draw, 4) <> 0"), rows.where("pmod(draw, 4) = 0")
        self.learned = learn_lexicon(fit)
        fit = materialize(_featured(fit, self.learned, "toxic int, weight double, doc_id bigint"), "fit").coalesce(2)
        if fit.select("toxic").distinct().count() < 2:
            return
        trees = GBTClassifier(labelCol="toxic", weightCol="weight", maxDepth=4, maxIter=20, stepSize=0.2, seed=7, minInstancesPerNode=5)
        self.trees = trees.fit(fit)
        margin = self._margin(_featured(rest, self.learned, "toxic int, weight double, doc_id bigint"))
        margin = margin.select("margin", "weight", F.col("toxic").cast("double").alias("toxic"))
        self.isotonic = None
        if margin.limit(1).count():
            self.isotonic = IsotonicRegression(featuresCol="margin", labelCol="toxic", weightCol="weight").fit(margin)

    def _margin(self, df: DataFrame) -> DataFrame:
        scored = self.trees.transform(df).withColumn("margin", vector_to_array("rawPrediction")[1])
        return scored.drop("prediction", "rawPrediction", "probability")

    def score(self, documents: DataFrame) -> DataFrame:
        """(doc_id, text_key, score) for every row, the key a hash of the text."""
        own = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text")
        if self.trees is None:
            return own.select("doc_id", "text_key", F.lit(self.share).alias("score"))
        scored = self._margin(_featured(own, self.learned, "doc_id bigint, text_key bigint"))
        raw = 1 / (1 + F.exp(-2 * F.col("margin")))
        if self.isotonic is None:
            return scored.select("doc_id", "text_key", raw.alias("score"))
        step = self.isotonic.transform(scored).withColumn("step", F.col("prediction"))
        # a little of the raw value keeps the order within a calibrated step
        return step.select("doc_id", "text_key", (0.98 * F.col("step") + 0.02 * raw).alias("score"))


def classify(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The contract's columns."""
    return _predicted(documents, labels, threshold).drop("text_key")


def _predicted(documents: DataFrame, labels: DataFrame, threshold: float) -> DataFrame:
    scored = Scorer(documents, labels).score(documents)
    return scored.select(
        "doc_id",
        "text_key",
        F.coalesce(held_out("doc_id"), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def keep_clean(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that are not rejected, with all their columns; each row, also one with a null or repeated
    id, is judged by its own text."""
    rejected = _predicted(documents, labels, threshold).where("predicted = 1").select("doc_id", "text_key")
    return without(documents, rejected)
