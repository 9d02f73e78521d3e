"""Ranked search against a plain ranking of all documents."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from lendlens.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def plain(docs, items, top=10):
    bags = [(d, Counter(terms(t))) for d, t in docs if terms(t)]
    n_docs, total = len(bags), sum(b.total() for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        rows = []
        for d, bag in bags:
            m = 100 - 90 + 90 * bag.total() * n_docs // total
            score = 0
            for t in set(terms(text)) & bag.keys():
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                score += w * ((1_000_000_000 * bag[t]) // (1000 * bag[t] + 8 * m))
            if score > 0:
                rows.append((-score, d is None, d or 0, d))
        rows.sort(key=lambda r: r[:3])
        out += [(item, k, r[3], -r[0]) for k, r in enumerate(rows[:top], 1)]
    return sorted(out, key=repr)


def got(rows):
    return sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in rows), key=repr)


def tables(spark, docs, items):
    made = spark.createDataFrame([(d, t, 1, 2.0) for d, t in docs], "doc_id bigint, text string, key int, score double")
    asked = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id bigint, text string, query int")
    return made.repartition(5), asked


ODD = [(1, None), (2, ""), (3, " \n.,"), (4, "one"), (4, "one"), (None, "one TWO"), (None, "one TWO"), (5, "x " * 40_000 + "one"), (6, "é" * 50_000)]


@pytest.mark.parametrize("seed", range(3))
def test_like_plain(spark, seed):
    draw = random.Random(seed)
    names = [f"{a}{b}" for a in "abcÉ日" for b in "xyzuvw0189"] + ["Hot"]
    pick = lambda n: draw.choice([" ", ".", "-\n"]).join(names[min(50, int(draw.expovariate(0.08)))] for _ in range(n))
    docs = [(100 + i, pick(draw.randrange(1, 200))) for i in range(250)]
    docs += [(1000 + i, docs[3][1]) for i in range(60)] + ODD  # a group of copies, all tied
    draw.shuffle(docs)
    items = [(i, pick(draw.randrange(1, 40))) for i in range(25)]
    items += [(90, docs[3][1]), (91, "nowhere"), (92, None), (93, ""), (94, "ONE"), (94, "ONE"), (None, "two")]
    asked = tables(spark, docs, items)
    assert got(lexical.search(*asked).collect()) == plain(docs, items)


def test_blocks_of_queries_and_chunks(spark, monkeypatch):
    monkeypatch.setattr(lexical, "QUERY_BYTES", 60)
    monkeypatch.setattr(lexical, "QUERY_TERMS", 4)
    monkeypatch.setattr(lexical, "BROADCAST_ROWS", 0)
    docs = [(i, f"a{i % 7} b{i % 5} c{i % 3} " * (1 + i % 4)) for i in range(80)]
    items = [(i, f"a{i % 7} b{i} c{i % 3} d{i} e f g") for i in range(9)]
    made, asked = tables(spark, docs, items)
    assert len(list(lexical._blocks(asked))) > 2
    index = lexical.build(made)
    assert got(lexical.search(made, asked, top=3, index=index).collect()) == plain(docs, items, 3)


def test_empty_tables(spark):
    docs, items = tables(spark, [(1, "a b")], [(1, "a")])
    assert lexical.search(docs.limit(0), items).count() == 0
    assert lexical.search(docs, items.limit(0)).count() == 0


def test_bounds_are_upper_bounds():
    draw = random.Random(5)
    docs = [Counter(f"t{int(draw.expovariate(0.02))}" for _ in range(draw.randrange(1, 300))) for _ in range(200)]
    block = lexical.Block(512)
    for k, bag in enumerate(docs):
        hashes = np.array([lexical.term_hash(t.encode()) for t in bag], np.uint64)
        block.add((k, k, bag.total(), max(bag.values())), hashes, np.array(list(bag.values())))
    items = [(i, sorted({f"t{draw.randrange(200)}".encode() for _ in range(12)})) for i in range(20)]
    df = Counter(t.encode() for bag in docs for t in bag)
    own = lexical.Queries(items, df, len(docs), sum(b.total() for b in docs))
    length = np.array([own.length(b.total()) for b in docs])
    most = np.array([max(b.values()) for b in docs])
    tight = 0
    for chunk in own.chunks():
        for k, bound in lexical.Prepared(own, *chunk).bounds(block.slices[:, :25], len(docs), length, most):
            for d, bag in enumerate(docs):
                held = [(own.weights[t], bag[t.decode()]) for t in items[k][1] if t.decode() in bag]
                score = sum(w * (1_000_000_000 * tf // (1000 * tf + 8 * int(length[d]))) for w, tf in held)
                assert bound[d] >= score
                tight += bound[d] < 1.5 * score + 1
    assert tight > 0.3 * len(docs) * len(items)  # narrow signatures of many terms still tell documents apart
