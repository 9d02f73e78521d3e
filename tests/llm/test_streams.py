"""Repeats, archives, token counts, fingerprints and licences against plain versions."""

import hashlib
import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from lendlens.llm import fingerprints, licences, queries, suffix, tokens, warc
from lendlens.llm.common import read

KIND = "doc_id bigint, text string, doc bigint, gram bigint, row bigint, range bigint"


def table(spark, texts):
    return spark.createDataFrame([(i, t, 1, 2, 3, 4) for i, t in texts], KIND)


ODD = [(1, None), (2, ""), (3, " \n\t"), (4, "one"), (4, "one"), (5, "x " * 3_000), (6, "é" * 4_000), (None, "one two")]


def documents(spark, sf="/root/testdata/sf0.01"):
    return [tuple(r) for r in read(spark, sf, "documents").select("doc_id", "text").collect()]


def sha(data):
    return hashlib.sha256(data).hexdigest()


# --- repeats


def plain_repeats(docs, length=100):
    seen, out = set(), []
    for d, t in sorted(docs, key=lambda r: r[0]):
        data = (t or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - length + 1):
            window = data[i : i + length]
            if window in seen:
                gone[i : i + length] = b"\1" * length
            else:
                seen.add(window)
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        left = bytes(b for b, g in zip(data, gone) if not g)
        out.append((d, len(data), sum(gone), spans, sha(left)))
    return sorted(out)


def test_repeats_like_plain(spark):
    got = sorted(map(tuple, queries.op2_repeats(spark, "/root/testdata/sf0.01").collect()))
    want = plain_repeats(documents(spark))
    assert got == want
    assert sum(r[2] for r in got) > 10_000


def made_of_passages(draw, n):
    passages = ["".join(draw.choice("ab é") for _ in range(draw.randrange(60, 400))) for _ in range(12)]
    texts = []
    for i in range(n):
        parts = [draw.choice(passages) if draw.random() < 0.5 else "".join(draw.choice("abcdefgh ") for _ in range(draw.randrange(200))) for _ in range(draw.randrange(5))]
        texts.append((i, "".join(parts)))
    return [*texts, (900, "z" * 700), (901, "ab" * 300), (902, "z" * 99), (903, "ab" * 300), (904, "q" + "ab" * 300)]


@pytest.mark.parametrize(("bucket", "shards", "piece"), [(2_000, 2, 8_000_000), (5, 3, 150), (2, 1, 8_000_000)])
def test_repeats_in_made_texts(spark, monkeypatch, bucket, shards, piece):
    monkeypatch.setattr(suffix, "BUCKET", bucket)
    monkeypatch.setattr(suffix, "PIECE", piece)
    monkeypatch.setattr(suffix.repeated, "__defaults__", (shards,))
    texts = made_of_passages(random.Random(bucket), 80)
    # small pieces and shards are read in tasks: run those by hand
    rows = []
    for d, t in texts:
        rows += [(g, s, n) for g, s, n in suffix.segments(t.encode())]
        covered = sorted((s, s + n) for _, s, n in suffix.segments(t.encode()))
        assert covered[:1] == [(0, covered[0][1])] if len(t.encode()) >= 100 else not covered
    bodies = [t.encode() for _, t in texts if len(t.encode()) >= 100]
    body, offset, classes = suffix.repeated(bodies, shards)
    by = {}
    for b, o, c in zip(body.tolist(), offset.tolist(), classes.tolist()):
        by.setdefault(c, set()).add(bodies[b][o : o + 100])
    assert all(len(x) == 1 for x in by.values())
    assert len(by) == len({b[o : o + 100] for b in bodies for o in range(len(b) - 99)})
    got = sorted(map(tuple, suffix.kept(suffix.deduplicate(table(spark, texts))).collect()))
    assert got == plain_repeats(texts)


def test_repeats_odd(spark):
    got = suffix.kept(suffix.deduplicate(table(spark, [*ODD, (7, "x " * 3_000)]))).collect()
    by = {r["doc_id"]: r for r in got}
    assert len(got) == 9 and by[1]["n_bytes"] == 0 and by[None]["n_removed"] == 0
    assert (by[5]["n_removed"], by[7]["n_removed"]) == (6_000 - 2, 6_000)
    assert suffix.deduplicate(table(spark, [])).count() == 0


def test_repeats_leave_the_texts_where_they_are(spark, capsys):
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        suffix.deduplicate(table(spark, made_of_passages(random.Random(3), 40))).explain("formatted")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    moved = capsys.readouterr().out.split("Exchange\n")[1:]
    assert moved and not any("text#" in x.split("\n")[0] for x in moved)


def test_segments_carry_no_content(spark):
    texts = table(spark, made_of_passages(random.Random(4), 40)).select(F.col("doc_id").alias("doc"), "text")
    rows = suffix._segment_rows(texts)
    assert [t for _, t in rows.dtypes] == ["bigint"] * 3
    want = {(r["doc"], *s) for r in texts.collect() for s in suffix.segments(r["text"].encode())}
    assert {(r["doc"], r["gram"], r["at"] >> 7, r["at"] & 127) for r in rows.collect()} == want


# --- archives


def test_archives(spark, tmp_path):
    long = "<p>é" + "x" * 200
    rows = [(5, "http://a/b c\r\nX: y", long), (2, None, long), (9, "u", long), (3, "u", None), (4, "u", ""), (6, "u", "s"), (7, "u", "s")]
    rows += [(None, "u", long), (5, "http://a/b", long), (100, "u", "p" * 100), (101, "u", "p" * 100), (102, "u", "\r\n\r\n" * 40_000)]
    pages = spark.createDataFrame([(*r, "t", 1) for r in rows], "page_id bigint, url string, html string, digest string, first int")
    manifest = warc.write(pages, str(tmp_path), roll_bytes=300)
    names = [r["name"] for r in manifest.collect()]
    assert len(names) == len(set(names)) > 2
    assert {p.name for p in tmp_path.glob("*.gz")} == set(names) and not list((tmp_path / "tmp").iterdir())
    back = warc.read_back(manifest, str(tmp_path)).collect()
    want = []
    for page, _, html in rows:
        data = (html or "").encode()
        same = [p for p, _, h in rows if h == html and p is not None]
        first = min(same) if len(data) >= 100 else page
        want.append((page, len(data), sha(data), "response" if page == first else "revisit", None if page == first else first))
    got = [(r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in back]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    full = {r["page_id"]: r["payload"] for r in back if r["record_type"] == "response"}
    assert full[2].decode() == long and full[102].decode() == "\r\n\r\n" * 40_000
    again = warc.write(pages, str(tmp_path / "again"), roll_bytes=300)
    key = ["name", "records", "bytes", "sha256"]
    assert again.select(key).exceptAll(manifest.select(key)).count() == 0
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_broken_archive():
    import gzip
    import io

    good = gzip.compress(warc.record(1, "u", b"hello", sha(b"hello"), 5, None))
    assert [b.endswith(b"hello") for _, b in warc.parse(io.BytesIO(good * 3), 7)] == [True] * 3
    with pytest.raises(ValueError):
        list(warc.parse(io.BytesIO(good[:-20])))


# --- token counts


def library_counts(texts):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return [len(library.encode(t or "", add_special_tokens=False).ids) for t in texts]


def test_tokens_like_library(spark):
    docs = documents(spark)
    got = {r["doc_id"]: r for r in queries.op4_tokens(spark, "/root/testdata/sf0.01").collect()}
    for (d, t), n in zip(docs, library_counts([t for _, t in docs])):
        assert tuple(got[d]) == (d, len(t.encode()), n, n > 512)


@pytest.mark.parametrize(("chunk", "overlap"), [(65_536, 1_024), (100, 64), (300, 80)])
def test_tokens_odd(spark, chunk, overlap):
    draw = random.Random(chunk)
    bits = ["a", " ", "  ", "\n", "'re", "don't", "<|endoftext|>", "é", "1", " ", "word ", ". ", "!?", "\t", "　", "日本", "\x1c", "😀"]
    texts = [(10 + i, "".join(draw.choice(bits) for _ in range(draw.randrange(900)))) for i in range(60)]
    texts += [*ODD, (80, "y" * 5_000), (81, " " * 3_000), (82, "<|endoftext|>" * 200), (83, "a" * 400 + " b" * 400)]
    got = tokens.count_tokens(table(spark, texts), public_tokenizers.path("byte_bpe_50k.json"), chunk, overlap).collect()
    want = sorted(((d, len((t or "").encode()), n) for (d, t), n in zip(texts, library_counts([t for _, t in texts]))), key=repr)
    assert sorted(map(tuple, got), key=repr) == want


# --- fingerprints


def test_fingerprints(spark):
    docs = sorted(documents(spark))
    rows = {r["doc_id"]: r for r in queries.op1_fingerprints(spark, "/root/testdata/sf0.01").collect()}
    assert len(rows) == len(docs)
    better = 0
    for (d, t), (_, after) in zip(docs, [*docs[1:], docs[0]]):
        half = len(t) // 2
        edited = t[: len(t) - half] + after[:half]
        r = rows[d]
        assert r["n_chars"] == len(t) and r["edited_sha256"] == sha(edited.encode())
        assert r["fingerprint"] == fingerprints.fingerprint(t.encode())
        assert r["edited_fingerprint"] == fingerprints.fingerprint(edited.encode())
        assert 0 <= r["near_next"] <= 1
        better += r["near_edited"] > r["near_next"]
    assert better > 0.9 * len(docs)


def test_equal_substrings_share_names():
    draw = random.Random(8)
    common = bytes(draw.randrange(97, 123) for _ in range(2_000))
    one = fingerprints.parse(b"head" + common)
    two = fingerprints.parse(bytes(draw.randrange(97, 123) for _ in range(333)) + common + b"tail")
    for level in (1, 2, 3):
        a, b = set(one[level].tolist()), set(two[level].tolist())
        assert len(a & b) > len(a) * 0.95 - 20
    for names in one:
        assert len(names)
    assert all(len(x) < len(y) for x, y in zip(one[2:], one[1:]))


def test_fingerprints_odd(spark):
    got = fingerprints.fingerprints(table(spark, ODD)).collect()
    assert len(got) == len(ODD)
    by = {r["doc_id"]: r for r in got}
    assert by[1]["fingerprint"] == "" and by[1]["near_edited"] == 1.0
    assert by[6]["edited_sha256"] == sha(("é" * 2_000 + "one two").encode())
    assert fingerprints.fingerprints(table(spark, [])).count() == 0
    alone = fingerprints.fingerprints(table(spark, [(1, "abcd")])).collect()
    assert alone[0]["edited_sha256"] == sha(b"abab")


# --- licences


def test_licences(spark):
    plain = read(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text").where("NOT lower(text) rlike 'licen[cs]e|cc by'")
    told = [
        (9001, "Some words.\nLicensed under the Apache License, Version 2.0.\nMore words here.", "apache-2.0"),
        (9002, "x\n\nReleased under the MIT License.", "mit"),
        (9003, "This work is licensed under the GNU General Public License, version 3.", "gpl"),
        (9004, "Licensed under CC BY-NC 4.0.", "cc-by-nc"),
        (9005, "We may not use this file for the general public.", ""),
    ]
    rest = [(9010, None, ""), (9011, "", ""), (9012, " \n\n", ""), (None, "one", ""), (9013, "one", ""), (9013, "one", "")]
    made = spark.createDataFrame([(d, t) for d, t, _ in [*told, *rest]], "doc_id bigint, text string")
    docs = plain.unionByName(made).withColumns({c: F.lit(1) for c in ("words", "label", "features", "family")})
    rows = licences.scan(docs).collect()
    assert len(rows) == docs.count()
    found = {r["doc_id"]: r["families"] for r in rows}
    assert {d: found[d] for d, _, _ in told} == {d: f for d, _, f in told}
    # the only line of these documents that a family claims
    reserved = {r["doc_id"] for r in plain.where("text LIKE '%All rights reserved.%'").collect()}
    assert {r["doc_id"]: r["families"] for r in rows if r["families"] and (r["doc_id"] or 0) < 9000} == dict.fromkeys(reserved, "proprietary")
    assert licences.scan(docs.limit(0)).count() == 0


def test_lines_of_the_tables(spark):
    lines = [
        ("All rights reserved.", "proprietary"),
        ("Copyright (c) 2020 Acme. All rights reserved.", "proprietary"),
        ("Licensed under the Apache License, Version 2.0.", "apache-2.0"),
        ("Released under the MIT License.", "mit"),
        ("This work is licensed under the GNU General Public License, version 3.", "gpl"),
        ("Licensed under CC BY-NC 4.0.", "cc-by-nc"),
        ("He reserved all the rooms on the right.", ""),
    ]
    made = spark.createDataFrame([(90_000 + i, f"Some words.\n{t}\nMore.") for i, (t, _) in enumerate(lines)], "doc_id bigint, text string")
    docs = read(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text").unionByName(made)
    found = {r["doc_id"]: r["families"] for r in licences.scan(docs).collect()}
    assert [found[90_000 + i] for i in range(len(lines))] == [f for _, f in lines]
    told = {r["doc_id"] for r in docs.where("text rlike '(^|\n)All rights reserved[.](\n|$)'").collect()}
    assert len(told) > 1 and all("proprietary" in found[d].split(",") for d in told)


MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:"""
AS_IS = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE."""
GPL = """    This program is free software: you can redistribute it and/or modify
    it under the terms of the GNU General Public License as published by
    the Free Software Foundation, either version 3 of the License, or
    (at your option) any later version."""
LGPL = """This library is free software; you can redistribute it and/or
modify it under the terms of the GNU Lesser General Public
License as published by the Free Software Foundation; either
version 2.1 of the License, or (at your option) any later version."""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer."""
APACHE = """# Licensed under the Apache License, Version 2.0 (the "License");
# you may not use this file except in compliance with the License.
# You may obtain a copy of the License at
#
#     http://www.apache.org/licenses/LICENSE-2.0
#
# Unless required by applicable law or agreed to in writing, software
# distributed under the License is distributed on an "AS IS" BASIS,
# WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."""
MPL = """/* This Source Code Form is subject to the terms of the Mozilla Public
 * License, v. 2.0. If a copy of the MPL was not distributed with this
 * file, You can obtain one at https://mozilla.org/MPL/2.0/. */"""


def test_wrapped_notices(spark):
    told = [(MIT, "mit"), (AS_IS, "mit"), (GPL, "gpl"), (LGPL, "lgpl"), (BSD, "bsd"), (APACHE, "apache-2.0"), (MPL, "mpl-2.0")]
    told += [("MIT License\n\nCopyright (c) 2020 Acme\n\n" + MIT, "mit"), (MIT.replace("\n", "\r\n"), "mit"), (MIT.replace("\n", " "), "mit")]
    told += [("A walk in the hills\nby the old road\nReleased under the MIT License.\nAnd home", "mit")]
    told += [("The committee met in the hall and agreed\nthat the notes be kept\nby the clerk.\n\nNobody objected.", "")]
    made = spark.createDataFrame([(90_000 + i, t) for i, (t, _) in enumerate(told)], "doc_id bigint, text string")
    docs = read(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text").unionByName(made)
    rows = {r["doc_id"]: r for r in licences.scan(docs).collect()}
    assert [(i, rows[90_000 + i]["families"]) for i in range(len(told))] == [(i, f) for i, (_, f) in enumerate(told)]
    assert [rows[90_000 + i]["n_paragraphs"] for i in (0, 2, 4, 11)] == [1, 1, 2, 2]
    assert all(r["n_confirmed"] <= r["n_licensed"] <= r["n_paragraphs"] for r in rows.values())


def test_unknown_lines_are_whole(spark, monkeypatch):
    longest, vectors = [], licences._vectors

    def seen(df):
        longest.append(df.where("label = 0").agg(F.max(F.size("words"))).first()[0])
        return vectors(df)

    monkeypatch.setattr(licences, "_vectors", seen)
    docs = spark.createDataFrame([(i, "one two three four " * 300) for i in range(40)], "doc_id bigint, text string")
    licences.Classifier(docs)
    assert longest[0] == 1_200


def test_one_range_to_a_task(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "RANGE_BYTES", 2_000)
    rows = [(i * 3, f"text of {i} " * 12) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    dealt = fingerprints._followed(docs, "doc_id")
    found = dealt.select("range", "ghost", "key", F.spark_partition_id().alias("part")).collect()
    parts = {}
    for r in found:
        parts.setdefault(r["part"], set()).add(r["range"])
    assert len(parts) > 15 and all(len(ranges) == 1 for ranges in parts.values())
    spans = {}
    for r in found:
        if not r["ghost"]:
            spans.setdefault(r["range"], []).append(r["key"])
    ends = [(min(v), max(v)) for _, v in sorted(spans.items())]
    assert all(a[1] < b[0] for a, b in zip(ends, ends[1:])) and sum(map(len, spans.values())) == 400
    assert sum(r["ghost"] for r in found) == len(spans)


def test_a_used_folder_and_a_changed_archive(spark, tmp_path):
    pages = spark.createDataFrame([(i, f"http://x/{i}", f"page {i} " * 30) for i in range(40)], "page_id bigint, url string, html string")
    folder = str(tmp_path / "a")
    manifest = warc.write(pages, folder)
    assert warc.read_back(manifest, folder).count() == 40
    with pytest.raises(ValueError, match="holds archives"):
        warc.write(pages, folder)
    one = next((tmp_path / "a").glob("*.warc.gz"))
    one.write_bytes(one.read_bytes() * 2)
    with pytest.raises(Exception, match="not the file of the manifest"):
        warc.read_back(manifest, folder).collect()


def test_licence_scores_are_worked_out_once_a_line(spark, capsys):
    docs = table(spark, [(k, f"Line {k} of some plain text.\nReleased under the MIT License.") for k in range(40)])
    known = licences.Classifier(docs).known(licences.paragraphs(docs))
    known.explain("extended")
    physical = capsys.readouterr().out.split("== Physical Plan ==")[1]
    assert physical.count("regexp_extract_all(") == 1


def test_lines_are_counted_and_drawn_in_one_pass(spark, monkeypatch):
    texts = [None, "", " \n%%\n", "One.\nTwo.\n\nThree\nfour", *(f"Line {k}.\n\nand\nmore of {k}" for k in range(60))]
    docs = table(spark, list(enumerate(texts)))
    lines = licences.paragraphs(docs)
    want = {r["doc_id"]: (r["p"], r["n"]) for r in lines.groupBy("doc_id").agg(F.count_distinct("at").alias("p"), F.count("*").alias("n")).collect()}
    rows = licences.looked(docs, 20).collect()
    assert {r["doc_id"]: (r["n_paragraphs"], r["n_lines"]) for r in rows} == {k: want.get(k, (0, 0)) for k in range(len(texts))}
    # the draw of 20 of all lines is among those kept
    drawn = {(r["doc_id"], r["line"]) for r in lines.where(licences._drawn(F.col("doc_id"), F.col("line"), 20 / lines.count())).collect()}
    kept = {(r["doc_id"], x) for r in rows for x in r["some"]}
    assert drawn and drawn <= kept and len(kept) < lines.count()
    # the corpus is split for the counts and for the scores, not more
    split, asked = licences._paragraphs, []
    monkeypatch.setattr(licences, "_paragraphs", lambda text: asked.append(1) or split(text))
    licences.scan(docs).collect()
    assert len(asked) == 2


def test_every_line_break_ends_a_line(spark):
    breaks = ["\n", "\r\n", "\r", "\x0b", "\f", "\x85", "\u2028", "\u2029"]
    docs = table(spark, [(k, f"First line{b}{b}Second line.{b}Third") for k, b in enumerate(breaks)])
    rows = docs.select("doc_id", licences._paragraphs(F.col("text")).alias("p")).collect()
    assert {tuple(r["p"]) for r in rows} == {("First line", "Second line.", "Third")}


def test_grams_of_few_words(spark):
    words = [[], ["a"], ["a", "b"], ["a", "b", "c"], ["a", "b", "c", "d"]]
    rows = spark.createDataFrame([(k, w) for k, w in enumerate(words)], "id int, words array<string>")
    sizes = [r["features"].numNonzeros() for r in licences._vectors(rows).orderBy("id").collect()]
    assert sizes == [0, 1, 3, 6, 9]
