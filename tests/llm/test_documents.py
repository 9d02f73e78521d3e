"""Operators on documents against plain versions."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from lendlens.llm import decontaminate, minhash, packing, pii, queries, toxicity
from lendlens.llm.common import read

KIND = "doc_id bigint, text string, lang string, source string, n_chars bigint, word string, band long, id long, comp long"


def table(spark, texts):
    rows = [(i, t, "en", "s", 0, "w", 1, 2, 3) for i, t in texts]
    return spark.createDataFrame(rows, KIND)


ODD = [(1, None), (2, ""), (3, " \n\t"), (4, "one"), (4, "one"), (5, "x " * 30_000), (6, "é" * 50_000), (None, "one two")]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- decontamination


def plain_hits(docs, items):
    split = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = lambda t: split.findall((t or "").translate(fold))
    windows = {}
    for i, t in items:
        w = words(t)
        m = min(10, len(w))
        for k in range(len(w) - m + 1 if m else 0):
            windows.setdefault(tuple(w[k : k + m]), set()).add(i)
    sizes = {len(w) for w in windows}
    out = []
    for d, t in docs:
        w = words(t)
        hit, own = set(), set()
        for m in sizes:
            for k in range(len(w) - m + 1):
                found = windows.get(tuple(w[k : k + m]))
                if found:
                    hit.update(range(k, k + m))
                    own |= found - {None}
        out.append((d, len(w), len(hit), len(own), sha(",".join(sorted(map(str, own)))), bool(hit)))
    return sorted(out, key=repr)


def test_decontamination_like_plain(spark):
    sf = "/root/testdata/sf0.01"
    docs = [tuple(r) for r in read(spark, sf, "documents").select("doc_id", "text").collect()]
    items = [tuple(r) for r in read(spark, sf, "benchmark").collect()]
    got = sorted(map(tuple, queries.op10_decontaminate(spark, sf).collect()), key=repr)
    assert got == plain_hits(docs, items)
    assert sum(r[-1] for r in got) > 3


@pytest.mark.parametrize("passes", [1, 3])
def test_decontamination_odd(spark, passes, monkeypatch):
    items = [(1, "one"), (2, "a b c"), (3, None), (4, ""), (5, "b C, d e f g h i j k l m"), (None, "one two"), (2, "a b c")]
    texts = [*ODD, (7, "A-b.c d e f g h i j k l m n"), (8, "a b b c one"), (9, "x x x x x x x x x")]
    if passes > 1:
        monkeypatch.setattr(decontaminate, "TABLE_BYTES", 20)
    bench = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id bigint, text string, doc_id int")
    got = decontaminate.digest(decontaminate.matches(table(spark, texts), bench)).collect()
    assert sorted(map(tuple, got), key=repr) == plain_hits(texts, items)
    kept = decontaminate.clean(table(spark, texts), bench)
    assert kept.columns == table(spark, texts).columns
    empty = decontaminate.matches(table(spark, texts), bench.limit(0))
    assert empty.where("size(spans) > 0").count() == 0
    assert decontaminate.matches(table(spark, []), bench).count() == 0


# --- packing


def check_packing(rows, docs, capacity):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = []
    for d, t in docs:
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 1]
        for k in range(0, len(ids), capacity):
            cut = ids[k : k + capacity]
            want.append((d, k // capacity, k, len(cut), zlib.crc32(np.array(cut, "<u4").tobytes())))
    assert sorted((tuple(r)[:5] for r in rows), key=repr) == sorted(want, key=repr)
    bins = {}
    for r in rows:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for content in bins.values():
        at = 0
        for offset, length in sorted(content):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins), -(-sum(r["length"] for r in rows) // capacity)


def test_packing_like_library(spark):
    sf = "/root/testdata/sf0.01"
    docs = [tuple(r) for r in read(spark, sf, "documents").select("doc_id", "text").collect()]
    used, bound = check_packing(queries.op8_packing(spark, sf).collect(), docs, 4096)
    assert used <= bound + 1


def test_packing_odd(spark):
    texts = [*ODD, (7, "don't  STOP <|endoftext|> now<|startoftext|>é é́ ΑΣ Σ. x"), (8, "á ́b İ ſ")]
    rows = packing.pack(table(spark, texts), public_tokenizers.path("word_bpe_49k.json"), 64).collect()
    check_packing(rows, texts, 64)
    assert packing.pack(table(spark, []), public_tokenizers.path("word_bpe_49k.json")).count() == 0


def test_reduction_keeps_the_best_packing():
    draw = random.Random(3)

    def best(items, capacity):
        items = sorted(items, reverse=True)
        found = [len(items)]

        def place(k, rooms):
            if len(rooms) >= found[0]:
                return
            if k == len(items):
                found[0] = len(rooms)
                return
            for r in {*rooms}:
                if r >= items[k]:
                    i = rooms.index(r)
                    place(k + 1, [*rooms[:i], r - items[k], *rooms[i + 1 :]])
            place(k + 1, [*rooms, capacity - items[k]])

        place(0, [])
        return found[0]

    for _ in range(300):
        capacity = draw.randint(6, 24)
        items = [draw.randint(1, capacity) for _ in range(draw.randint(1, 9))]
        fixed, left = packing.reduce_by_dominance(Counter(items), capacity)
        assert all(sum(c) <= capacity for c, _ in fixed)
        again = Counter(left)
        for content, n in fixed:
            for s in content:
                again[s] += n
        assert again == Counter(items)
        rest = [s for s, n in left.items() for _ in range(n)]
        assert sum(n for _, n in fixed) + best(rest, capacity) == best(items, capacity)
        packed = packing.best_fit(left, capacity)
        assert Counter(s for c, n in packed for s in c for _ in range(n)) == Counter(rest)


# --- near-duplicates


def plain_groups(docs):
    sets = []
    for d, t in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        width = min(5, len(w))
        sets.append({tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if w else set())
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= 75 * (len(a) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(docs):
        least[find(i)] = min(d, least.get(find(i), d))
    return sorted((d, len(sets[i]), least[find(i)], d == least[find(i)]) for i, (d, _) in enumerate(docs))


def test_near_duplicates_like_plain(spark):
    sf = "/root/testdata/sf0.01"
    docs = [tuple(r) for r in read(spark, sf, "documents").select("doc_id", "text").collect()]
    got = sorted(map(tuple, queries.op6_minhash(spark, sf).collect()))
    assert got == plain_groups(docs)
    assert sum(not r[3] for r in got) > 20


def test_near_duplicates_odd(spark):
    draw = random.Random(5)
    base = [f"w{draw.randrange(500)}" for _ in range(120)]
    texts = [x for x in ODD if x[0] is not None]
    for i in range(60):  # a chain of edits: ends are far apart, neighbours are near
        base[(2 * i) % 120] = f"n{i}"
        texts.append((100 + i, " ".join(base)))
    texts += [(300, "a b c d"), (301, "A  b\tc d"), (302, "a b c d e"), (303, "a b c d e")]
    df = table(spark, texts)
    got = sorted(map(tuple, minhash.groups(df).collect()))
    assert got == plain_groups(texts)
    kept = minhash.keep_one(df.unionByName(table(spark, [(None, "one two")])))
    assert kept.columns == df.columns
    assert {r["doc_id"] for r in kept.collect()} == {r[0] for r in got if r[3]} | {None}
    assert minhash.groups(table(spark, [])).count() == 0


def similar(n, start=0):
    """Documents of 400 words that differ in 40 of them, each in its own: alike, but none near another."""
    draw = random.Random(9)
    base, out = [f"w{k}" for k in range(400)], []
    for d in range(start, start + n):
        own = list(base)
        for k in draw.sample(range(400), 20):
            own[k] = f"d{d}x{k}"
        out.append((d, " ".join(own)))
    return out


def test_near_duplicates_without_ids(spark):
    words = " ".join(f"w{k}" for k in range(60))
    near = words + " end"
    texts = [(7, words), (None, near), (3, near), (None, "lone words"), (None, None), (None, "lone  WORDS"), (5, near), (5, "other")]
    df = table(spark, texts)
    got = Counter(map(tuple, minhash.groups(df).select("doc_id", "component_id", "kept").collect()))
    want = [(7, 3, False), (None, 3, False), (3, 3, True), (5, 3, False), (5, 5, True), *[(None, None, True)] * 3]
    assert got == Counter(want)
    kept = sorted(((r["doc_id"] or 0, r["text"] or "") for r in minhash.keep_one(df).collect()))
    assert kept == [(0, ""), (0, "lone  WORDS"), (0, "lone words"), (3, near), (5, "other")]


def test_near_duplicates_in_split_cells(spark, monkeypatch):
    """Small cells: centres and both sides of a group are split, and links across parts are found."""
    monkeypatch.setattr(minhash, "MEMBERS", 4)
    monkeypatch.setattr(minhash, "TURNS", 1)
    draw = random.Random(4)
    texts = similar(60)
    for d, t in similar(60)[::3]:
        own = t.split()
        own[draw.randrange(400)] = "changed"
        texts.append((1_000 + d, " ".join(own)))
    got = sorted(map(tuple, minhash.groups(table(spark, texts)).collect()))
    assert got == plain_groups(texts)


def test_cells_grow_with_members(spark):
    """Four times the members of a group that hangs together but for a few make four times the rows of cells."""
    made = []
    for n in (2_000, 8_000):
        members = spark.range(n).selectExpr("7L as band", "id", "300 as n", "if(id < 5, id, 5L) as comp")
        made.append(minhash._across(members).count())
        assert minhash._across(members).groupBy("band", "i", "j").count().agg(F.max("count")).first()[0] < 1.2 * minhash.MEMBERS
        centres = members.withColumn("comp", F.col("id"))
        assert minhash._stars(centres, 0).count() <= n + n / minhash.MEMBERS + 1
    assert made[1] < 4.1 * made[0]


def test_posterior_bound():
    assert [minhash.needed(n) for n in (32, 64)] == sorted(minhash.needed(n) for n in (32, 64))
    assert minhash.needed(32) < 24 and minhash.needed(168) < 0.75 * 168


# --- personal data


def plain_spans(text):
    found = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            found.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m.group() if c in "0123456789"]
        doubled = sum(d[-1::-2]) + sum(sum(divmod(2 * x, 10)) for x in d[-2::-2])
        if 14 <= len(d) <= 19 and doubled % 10 == 0:
            found.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.findall("[0-9]", m.group())) <= 15:
            found.append(("phone", *m.span()))
    return sorted(found, key=lambda s: (s[1], ["email", "ip", "card", "phone"].index(s[0])))


def test_patterns_like_plain(spark):
    draw = random.Random(1)
    alphabet = "a1.@-_+% (5é42"
    texts = ["".join(draw.choice(alphabet) for _ in range(draw.randrange(60))) for _ in range(20_000)]
    texts += ["4111 1111 1111 1111", "+1 (555) 555-0100", "010.000.255.1", "a@b.c_d@e.f", "1.2.3.4.5.6.7.8", "x@y@z.w"]
    for t in texts:
        assert pii.detect(t) == plain_spans(t), t
    sf = "/root/testdata/sf0.01"
    docs = dict(map(tuple, read(spark, sf, "documents").select("doc_id", "text").collect()))
    for r in queries.op7_pii(spark, sf).collect():
        base = plain_spans(docs[r["doc_id"]])
        assert r["base_sha256"] == sha(",".join(f"{k}:{a}:{b}" for k, a, b in base))
        assert [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]] == [
            sum(k == kind for k, _, _ in base) for kind in pii.KINDS
        ]
        assert r["spans"] == ",".join(f"{k}:{a}:{b}" for k, a, b in base)  # nothing here is disguised


@pytest.mark.parametrize(
    ("text", "kind", "cover"),
    [
        ("mail jane.doe [at] example [dot] com now", "email", "jane.doe [at] example [dot] com"),
        ("mail jane(at)example.com now", "email", "jane(at)example.com"),
        ("mail jane at example dot co dot uk now", "email", "jane at example dot co dot uk"),
        ("mail jane AT example DOT com.", "email", "jane AT example DOT com"),
        ("mail jane@example dot com.", "email", "jane@example dot com"),
        ("mail jane @ example . com ok", "email", "jane @ example . com"),
        ("jаne@exаmple.com", "email", "jаne@exаmple.com"),
        ("jane＠example．com", "email", "jane＠example．com"),
        ("ja​ne@example.com", "email", "ja​ne@example.com"),
        ("at 10[.]0[.]0[.]1 ok", "ip", "10[.]0[.]0[.]1"),
        ("at 10 dot 20 dot 0 dot 1 ok", "ip", "10 dot 20 dot 0 dot 1"),
        ("at １０.2.3.4 ok", "ip", "１０.2.3.4"),
        ("card four one one one " + "one " * 11 + "one, ok", "card", "four one one one " + "one " * 11 + "one"),
        ("card 4111‐1111‐1111‐1111 ok", "card", "4111‐1111‐1111‐1111"),
        ("call plus one five five five five five five zero one zero zero now", "phone", None),
        ("call ＋1 555 555 0100 now", "phone", "＋1 555 555 0100"),
    ],
)
def test_disguises(text, kind, cover):
    found = [(k, text[a:b]) for k, a, b in pii.spans(text)[1]]
    assert (kind, cover if cover is not None else text[5:-4]) in found


@pytest.mark.parametrize("text", ["meet me at noon", "one two three", "look at dot com", "Δεν είναι", "a at b. Dot c", "1 @ 2"])
def test_no_false_disguise(text):
    assert pii.spans(text)[1] == []


def test_pii_odd(spark):
    rows = pii.find(table(spark, [*ODD, (9, "1" * 100_000 + "@"), (10, "a" * 100_000 + "@b")])).collect()
    assert len(rows) == len(ODD) + 2 and not any(r["spans"] for r in rows)
    assert pii.find(table(spark, [])).count() == 0
    text = "x a@b.c and jane [at] example [dot] com."
    out = pii.redact(table(spark, [(1, text), (2, None)])).orderBy("doc_id").collect()
    assert [r["text"] for r in out] == ["x [EMAIL] and [EMAIL].", None]


# --- toxicity


def auc(rows):
    rows = sorted(rows)
    ranks = {}
    for i, (s, _) in enumerate(rows, 1):
        ranks.setdefault(s, []).append(i)
    mean = {s: sum(r) / len(r) for s, r in ranks.items()}
    positive = [mean[s] for s, y in rows if y]
    n, m = len(positive), len(rows) - len(positive)
    return (sum(positive) - n * (n + 1) / 2) / (n * m)


def test_toxicity_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r["doc_id"]: r["toxic"] for r in read(spark, sf, "labels").collect()}
    rows = queries.op5_toxicity(spark, sf).collect()
    assert len(rows) == 1000
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3)
    assert auc([(r["score"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]) > 0.85


def test_toxicity_odd(spark):
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(1, 7)], "doc_id bigint, quality int, toxic int")
    df = table(spark, ODD)
    for own in (labels, labels.limit(0), labels.withColumn("toxic", F.lit(None).cast("int")), labels.withColumn("toxic", F.lit(1))):
        rows = toxicity.classify(df, own).collect()
        assert len(rows) == len(ODD) and all(0 <= r["score"] <= 1 for r in rows)
    assert toxicity.classify(table(spark, []), labels).count() == 0
    assert toxicity.keep_clean(df, labels.limit(0)).columns == df.columns


def test_filters_judge_each_row(spark):
    """Null and repeated ids: a row goes for its own text only."""
    words = [f"w{k}" for k in range(12)]
    leak, plain = " ".join(words), " ".join(reversed(words))
    df = table(spark, [(None, "x " + leak), (None, plain), (5, leak), (5, plain), (6, None)])
    bench = spark.createDataFrame([(1, leak)], "item_id bigint, text string")
    kept = sorted(((r["doc_id"] or 0, r["text"] or "") for r in decontaminate.clean(df, bench).collect()))
    assert kept == [(0, plain), (5, plain), (6, "")]
    draw = random.Random(8)
    texts = [(i, f"word{draw.randrange(50)} " + ("you vile idiot" if i % 3 == 0 else "fine day here")) for i in range(900)]
    labels = spark.createDataFrame([(i, 0, int(i % 3 == 0)) for i, _ in texts], "doc_id bigint, quality int, toxic int")
    df = table(spark, [*texts, (None, texts[0][1]), (None, texts[1][1]), (1, texts[0][1])])
    kept = [(r["doc_id"], r["text"]) for r in toxicity.keep_clean(df, labels).collect()]
    assert sorted(kept, key=repr) == sorted([*(x for x in texts if x[0] % 3), (None, texts[1][1])], key=repr)


@pytest.mark.parametrize("said", [0.1, 0.6])
def test_toxicity_prior_of_a_small_sample(spark, said):
    draw = random.Random(3)
    texts, marks = [], []
    for i in range(6_000):
        toxic = draw.random() < 0.08
        hint = draw.random() < (said if toxic else 0.05)
        texts.append((i, " ".join(draw.choice("abcdefgh") * 2 for _ in range(20)) + (" you idiot" if hint else "")))
        marks.append((i, 1, int(toxic)))
    df, labels = table(spark, texts), spark.createDataFrame(marks, "doc_id bigint, quality int, toxic int")
    true = sum(t for _, _, t in marks) / len(marks)
    for sample in (500, 20_000):
        mean = toxicity.Scorer(df, labels, sample).score(df).agg(F.avg("score")).first()[0]
        assert abs(mean - true) < 0.03


def test_near_words_of_any_length():
    draw = random.Random(5)
    at = toxicity.NAMES.index("near_you")
    for n, often in ((40, 0.1), (3_000, 0.02), (30_000, 0.5)):
        low = [draw.choice(["you", "ur"]) if draw.random() < often else draw.choice(["idiot", *"abcdefgh"]) for _ in range(n)]
        you = {i for i, w in enumerate(low) if w in ("you", "ur")}
        near = sum(w == "idiot" and any(i + d in you for d in range(-toxicity.NEAR, toxicity.NEAR + 1)) for i, w in enumerate(low))
        assert near and toxicity.features(" ".join(low), {})[at] == near / n


def test_toxicity_share_of_a_small_sample(spark):
    labels = spark.createDataFrame([(i, 1, int(i % 10 == 0)) for i in range(3_000)], "doc_id bigint, quality int, toxic int")
    rows = toxicity._sample(table(spark, [(i, "a") for i in range(3_000)]), labels, 200)
    weight, toxic = rows.agg(F.sum("weight"), F.sum(F.col("weight") * F.col("toxic"))).first()
    assert rows.count() < 400 and 0.07 < toxic / weight < 0.13


def test_word_encoder_like_library():
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    library, encoder, draw = Tokenizer.from_file(path), packing.WordEncoder(path), random.Random(3)
    bits = [*"aBzé'́İKK.,-_!1²½“…\x0b\x0c\x1c\x85 \t\n　#@[]{}<|>", "'s", "'LL", "n't", "ß", "Σ", "日本", "</w>"]
    bits += ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>"]
    for _ in range(3_000):
        text = "".join(draw.choice(bits) for _ in range(draw.randrange(14)))
        assert encoder.ids(text.encode()).tolist() == library.encode(text, add_special_tokens=False).ids


def test_signature_in_blocks():
    own = minhash.shingles(b" ".join(b"w%d" % i for i in range(2_000)))
    a, b = minhash._multipliers()
    want = [int((own * a[k] + b[k]).min() >> np.uint64(33)) for k in range(len(a))]
    assert len(own) > 3 * minhash.COLUMNS and minhash.signature(own).tolist() == want
