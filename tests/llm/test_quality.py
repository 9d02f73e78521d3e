"""Line labelling against plain counts, all labellings, and held-out labels."""

import itertools
import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from lendlens.llm import quality, queries
from lendlens.llm.common import read
from lendlens.llm.toxicity import held_out

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ODD = [(1, None), (2, ""), (3, " \n\t"), (4, "one"), (4, "one"), (5, "x " * 30_000), (6, "é" * 50_000), (None, "one two\n\none two")]


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    hit = {k for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for k in range(i, i + 8)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    failed = len(words) < 20 or 100 * len(hit) > 30 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit), failed


def got(rows):
    names = "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed".split()
    return sorted((tuple(r[n] for n in names) for r in rows), key=repr)


def test_counts_like_plain(spark):
    draw = random.Random(3)
    parts = ["a", "b", "cc", "é|", "#x", " ", "\x1c", "日本", "&", "\n", "\n", " ", "\t", "\x0b", "\r", "  ", ""]
    texts = ["".join(draw.choice(parts) + draw.choice([" ", "", "\n"]) for _ in range(draw.randrange(120))) for _ in range(600)]
    texts += ["a b c d e f g h\n" * 2, "a " * 8, "a " * 9, "a b c d e f g h x a b c d e f g h", "x\x00y\n" * 3]
    rows = [*enumerate(texts, 100), *ODD]
    docs = spark.createDataFrame([(d, t, 1.0, "k") for d, t in rows], "doc_id bigint, text string, kept double, field string")
    out = quality.judged(quality.mark(docs, None)).collect()
    assert got(out) == sorted(((d, *plain(t)) for d, t in rows), key=repr)
    assert all(r["content_share"] == (1.0 if r["n_words"] else 0.0) and r["boilerplate"] == [] for r in out)


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    labels = spark.createDataFrame([], "doc_id bigint, quality int")
    field = quality.fit(docs, labels)
    assert field is None and quality.mark(docs, field).count() == 0 and quality.keep_content(docs, field).count() == 0


def made_field(seed):
    draw = np.random.default_rng(seed)
    return quality.Field(draw.normal(size=len(quality.FEATURES)), draw.normal(size=(2, 2)))


def scores(field, lines):
    """The score of each labelling of a chain."""
    out = {}
    for labels in itertools.product((0, 1), repeat=len(lines)):
        own = sum(float(x @ field.weights) for x, v in zip(lines, labels) if v)
        out[labels] = own + sum(field.steps[a][b] for a, b in zip(labels, labels[1:]))
    return out


def test_viterbi_and_likelihood_like_all_labellings():
    draw = np.random.default_rng(1)
    for seed in range(30):
        field = made_field(seed)
        chains = []
        for n in draw.integers(1, 8, 5):
            lines = draw.normal(size=(n, len(quality.FEATURES)))
            all_of = scores(field, lines)
            assert tuple(field.viterbi(lines).astype(int)) == max(all_of, key=all_of.get)
            chains.append((lines, draw.integers(0, 2, n).astype(np.uint8), float(draw.uniform(0.5, 2))))
        want = sum(w * (np.logaddexp.reduce(list(scores(field, x).values())) - scores(field, x)[tuple(v)]) for x, v, w in chains)
        loss, grad = quality.likelihood(field, chains)
        assert abs(loss - want) < 1e-8
        flat = np.concatenate([field.weights, field.steps.ravel()])
        for k in (0, 5, len(flat) - 4, len(flat) - 3, len(flat) - 2, len(flat) - 1):
            step = np.zeros(len(flat))
            step[k] = 1e-5
            up, down = (quality.likelihood(quality._field(flat + s), chains)[0] for s in (step, -step))
            assert abs((up - down) / 2e-5 - grad[k]) < 1e-5


def test_held_out_documents(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = read(spark, d, "documents"), read(spark, d, "labels")
    rows = queries.op12_quality(spark, d)
    assert rows.count() == docs.count()
    judged = rows.join(labels, "doc_id").where(held_out("doc_id")).where("NOT base_failed").collect()
    assert len(judged) > 50
    right = [r["kept"] == (r["quality"] == 1) for r in judged]
    assert sum(right) / len(right) > 0.97
    assert np.mean([r["kept"] for r in judged if r["quality"] == 1]) > 0.98


def test_marks_the_lines_and_keeps_columns(spark):
    d = "/root/testdata/sf0.01"
    docs = read(spark, d, "documents")
    field = quality.fit(docs, read(spark, d, "labels"))
    prose = docs.join(read(spark, d, "labels"), "doc_id").where("quality = 1 AND toxic = 0 AND size(split(text, '\n')) BETWEEN 6 AND 12")
    text = prose.orderBy("doc_id").first()["text"]
    n = text.count("\n") + 1
    junk = "\n".join("BUY!! | NOW!! | &&& | *** | $$$" for _ in range(4))
    made = spark.createDataFrame(
        [(7, text + "\n" + junk, "a"), (7, junk, "b"), (None, text, "c"), (None, junk, "d"), (8, None, "e")],
        "doc_id bigint, text string, kept string",
    )
    marked = [r["boilerplate"] for r in quality.mark(made, field).collect()]
    assert marked == [[n, n + 1, n + 2, n + 3], [0, 1, 2, 3], [], [0, 1, 2, 3], []]
    # decided by row: a null or repeated id does not pass its verdict on
    kept = quality.keep_content(made, field)
    assert kept.columns == made.columns and sorted(r["kept"] for r in kept.collect()) == ["a", "c"]
