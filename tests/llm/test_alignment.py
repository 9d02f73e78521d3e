"""Alignment against the two libraries on whole texts, and pair counts against plain counting."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from lendlens.llm import alignment, queries
from lendlens.llm.common import read

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    (1, None), (2, ""), (3, " \n\t"), (4, "one"), (4, "one"), (5, "x " * 20_000), (6, "é" * 3_000), (None, "one two"),
    (7, "a ▁b"), (8, "<|endoftext|> <s> <unk> </s>"), (9, "\x00\x1c \x85 　 ​"), (10, " "), (11, "  lead"),
]


@pytest.fixture(scope="module")
def whole():
    """Tokens' bytes and ids of whole texts by the libraries; the byte table is taken from the tiktoken file."""
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    import base64

    ranks = dict(map(bytes.split, open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb")))
    entry = {int(r): base64.b64decode(k) for k, r in ranks.items()}

    def run(text):
        if not text:
            return [], []
        x = a.encode(" " + text, add_special_tokens=False).ids
        y = b.encode(text)
        left = [(i, entry.get(i, b"?")) for i in x]
        right = []
        for i in y:
            p = b.id_to_piece(i)
            right.append((i, bytes([int(p[1:-1], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()))
        data = (" " + text).encode()
        fine = all(b"".join(t for _, t in side) == data for side in (left, right))
        return (left, right) if fine else ([], [])

    return run


def plain(docs, whole):
    coded = [(d, *whole(t)) for d, t in docs]
    linked, out = [], []
    for _, left, right in coded:
        ends = [{}, {}]
        for side, own in zip(ends, (left, right)):
            at = 0
            for k, (i, t) in enumerate(own):
                at += len(t)
                side[at] = (k, i)
        linked.append([(ends[0][e], ends[1][e]) for e in sorted(ends[0].keys() & ends[1].keys())])
    count = Counter((x[1], y[1]) for links in linked for x, y in links)
    highest = {}
    for (_, b), n in count.items():
        highest[b] = max(highest.get(b, 0), n)
    for (d, left, right), links in zip(coded, linked):
        groups, p, q = [], 0, 0
        for (i, _), (j, _) in links:
            groups.append(",".join(str(v) for v, _ in left[p : i + 1]) + "|" + ",".join(str(v) for v, _ in right[q : j + 1]))
            p, q = i + 1, j + 1
        own = [count[x[1], y[1]] for x, y in links]
        best = sum(count[x[1], y[1]] == highest[y[1]] for x, y in links)
        sha = hashlib.sha256(";".join(groups).encode()).hexdigest() if left else ""
        out.append((d, len(left), len(right), len(groups), len(links), best, sum(own), sha))
    return sorted(out, key=repr), count


NAMES = "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256".split()


def got(df):
    return sorted((tuple(r[n] for n in NAMES) for r in df.collect()), key=repr)


def test_like_the_libraries(spark, whole, monkeypatch):
    draw = random.Random(11)
    parts = ["the", "ing", "Éa", "日本", "x", "12", "'s", " ", "  ", "\n", "\t", ".", "!!", " ", "́", "🙂", "\x1d", "　", "e"]
    texts = ["".join(draw.choice(parts) + draw.choice(["", " "]) for _ in range(draw.randrange(60))) for _ in range(700)]
    docs = [*enumerate(texts, 100), *[(2000 + i, texts[5]) for i in range(40)], *ODD]
    want, count = plain(docs, whole)
    made = spark.createDataFrame([(d, t, 1, 2) for d, t in docs], "doc_id bigint, text string, block int, a int").repartition(3)
    assert got(alignment.align(made, A, B)) == want
    pairs = alignment.pair_counts(alignment.invert(made, A, B)).collect()
    assert {(r["a"], r["b"]): r["links"] for r in pairs} == count
    assert all(1 <= r["documents"] <= r["links"] for r in pairs)


def test_small_blocks(spark, whole, monkeypatch):
    monkeypatch.setattr(alignment, "BLOCK_POSTINGS", 30)
    monkeypatch.setattr(alignment, "CACHE", 5)
    docs = [(i, "one two one two three " * (i % 5) + f"w{i}") for i in range(60)]
    want, _ = plain(docs, whole)
    made = spark.createDataFrame(docs, "doc_id bigint, text string").coalesce(2)
    inverted = alignment.invert(made, A, B)
    assert inverted.select("block").distinct().count() > 4
    assert got(alignment.scored(inverted, alignment.pair_counts(inverted))) == want


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert alignment.align(docs, A, B).count() == 0


def test_bitmaps():
    draw = np.random.default_rng(2)
    for n in (1, 3, 200, 256, 257, 4_000):
        where = np.sort(draw.choice(alignment.BLOCK_DOCS, n, replace=False))
        times = draw.integers(1, 40, n)
        own = alignment.planes(where, times)
        assert (alignment.places(alignment.packed(where)) == where).all()
        assert alignment.popcount(alignment.merged(own)) == n
        assert sum(alignment.popcount(p) << k for k, p in enumerate(own)) == times.sum()
        assert (alignment.places(alignment.merged(own)) == where).all()


def test_whole_table(spark, whole):
    d = "/root/testdata/sf0.001"
    docs = [(r["doc_id"], r["text"]) for r in read(spark, d, "documents").collect()]
    assert got(queries.op11_alignment(spark, d)) == plain(docs, whole)[0]
