"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

A pattern is a window of ten consecutive words of a benchmark item, or a whole shorter item. Patterns
of one length are searched together: a shift table on blocks of two words skips impossible positions,
buckets of the last block name the patterns to try, and a direct comparison of all words confirms.

Odd input: null text has no words; an item without words is no pattern; repeated item ids count once in
``items`` and items with a null id are searched but not named; repeated rows are kept, each with its result.
Other columns of the inputs are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendlens.llm.common import per_batch, sha256, utf8, without
from lendlens.session import materialize

WINDOW = 10
#: Benchmark bytes held by one search table; a larger benchmark is searched in several passes.
TABLE_BYTES = 8_000_000

# a-z after lower-casing, 0-9 and all bytes from 0x80 are word bytes, the rest separates
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def words(data: bytes) -> list[bytes]:
    """Lower-cased words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of UTF-8 text."""
    return data.translate(_FOLD).split()


class Table:
    """Shift tables and buckets of one block of items, by pattern length."""

    def __init__(self, items: list[tuple[int | None, list[bytes]]], window: int):
        self.ids: dict[bytes, int] = {}
        patterns: dict[int, dict[tuple, set]] = {}
        for item, tokens in items:
            codes = [self.ids.setdefault(t, len(self.ids) + 1) for t in tokens]
            m = min(window, len(codes))
            for i in range(len(codes) - m + 1 if m else 0):
                patterns.setdefault(m, {}).setdefault(tuple(codes[i : i + m]), set()).add(item)
        self.searches = []
        for m, found in sorted(patterns.items()):
            block = min(2, m)
            shift: dict[tuple, int] = {}
            buckets: dict[tuple, list] = {}
            for pattern, owners in found.items():
                for end in range(block, m + 1):
                    key = pattern[end - block : end]
                    shift[key] = min(shift.get(key, m), m - end)
                buckets.setdefault(pattern[m - block :], []).append((pattern, owners))
            self.searches.append((m, block, shift, buckets))

    def search(self, tokens: list[bytes]) -> tuple[list[tuple[int, int]], set]:
        """Word spans of all occurrences, and the items that own them."""
        codes = list(map(self.ids.get, tokens))  # None: a word of no item
        spans, owners = [], set()
        n = len(codes)
        for m, block, shift, buckets in self.searches:
            skip = m - block + 1
            at = m - 1  # last word of the window under test
            while at < n:
                if codes[at] is None:  # no window may cover this word
                    at += m
                    continue
                key = (codes[at - 1], codes[at]) if block == 2 else (codes[at],)
                step = shift.get(key, skip)
                if step:
                    at += step
                    continue
                start = at - m + 1
                here = tuple(codes[start : at + 1])
                for pattern, items in buckets[key]:
                    if pattern == here:
                        spans.append((start, at + 1))
                        owners |= items
                at += 1
        return spans, owners


def _blocks(benchmark: DataFrame, window: int) -> list:
    """Search tables of bounded size, each with its own share of the items."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = int(size // TABLE_BYTES) + 1
    spark = benchmark.sparkSession
    for k in range(count):
        part = items if count == 1 else items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == k)
        rows = part.collect()  # bounded: one block of about TABLE_BYTES
        yield spark.sparkContext.broadcast([(r[0], words(r[1].encode())) for r in rows])


def matches(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, text, spans, items): merged, sorted word spans inside occurrences, and the owners' ids."""
    kind = "doc_id bigint, text string, spans array<array<int>>, items array<bigint>"
    out = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumns(
        {"spans": F.expr("cast(array() AS array<array<int>>)"), "items": F.expr("cast(array() AS array<bigint>)")}
    )
    for k, block in enumerate(_blocks(benchmark, window)):
        if k:
            out = materialize(out, "matches")  # one search table in memory at a time
        tables = {}

        def work(batch: pa.RecordBatch, block=block, tables=tables) -> dict:
            if not tables:  # once a task
                tables["table"] = Table(block.value, window)
            table = tables["table"]
            spans, items = [], []
            for data, old, had in zip(
                utf8(batch.column("text")), batch.column("spans").to_pylist(), batch.column("items").to_pylist()
            ):
                found, owners = table.search(words(data))
                spans.append(_merge([*map(tuple, old), *found]))
                items.append(sorted(set(had) | {x for x in owners if x is not None}))
            return {"doc_id": batch.column("doc_id"), "text": batch.column("text"), "spans": spans, "items": items}

        out = per_batch(out, work, kind)
    return out


def _merge(spans: list[tuple[int, int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(end, out[-1][1])
        else:
            out.append([start, end])
    return out


def digest(found: DataFrame) -> DataFrame:
    """The contract's columns."""

    def work(batch: pa.RecordBatch) -> dict:
        spans = batch.column("spans").to_pylist()
        items = batch.column("items").to_pylist()
        hit = [sum(b - a for a, b in s) for s in spans]
        return {
            "doc_id": batch.column("doc_id"),
            "n_words": [len(words(x)) for x in utf8(batch.column("text"))],
            "n_hit": hit,
            "n_items": [len(x) for x in items],
            "items_sha256": [sha256(",".join(sorted(map(str, x)))) for x in items],
            "contaminated": np.array(hit, dtype=int) > 0,
        }

    kind = "doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean"
    return per_batch(found, work, kind)


def clean(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents that hold no occurrence, with all their columns; each row, also one with a null or
    repeated id, is judged by its own text."""
    hits = matches(documents, benchmark, window).where(F.size("spans") > 0)
    return without(documents, hits.select("doc_id", F.xxhash64("text").alias("text_key")))
