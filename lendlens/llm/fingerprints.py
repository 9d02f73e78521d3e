"""Document fingerprints by locally consistent parsing.

The bytes of a text are level 0. At each level runs of one name become one name, deterministic coin
tossing reduces neighbouring names to a few labels in a fixed number of rounds, and phrases begin at
label maxima, so that where a phrase begins depends on a few neighbours only. A phrase's name is a hash
of the names in it; the phrases of one level are the sequence of the next. Equal substrings get equal
names inside, wherever they stand. The fingerprint keeps the smallest names of all phrases from level 2
on, which estimates the likeness of the phrase sets.

Odd input: null is empty; an empty text has the empty fingerprint, which is like no other but itself;
a text too short for level 2 is named by its last level; rows are ordered by doc_id, then text; rows
without an id come first; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendlens.llm.common import sha256

KEEP = 32
FROM_LEVEL = 2
#: Bytes of text in a range, about, and most ranges.
RANGE_BYTES, MAX_RANGES = 16_000_000, 20_000
#: Bytes parsed side by side, and rows looked at together.
TOGETHER, ROWS = 65_536, 256
NO_ID = -(1 << 63)  # rows without an id come first
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _ODD
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


@lru_cache(1)
def _toss() -> np.ndarray:
    """Label of a name below 128 beside its left neighbour: lowest differing bit, and its value; at 128 * name + left."""
    a, b = np.meshgrid(np.arange(128), np.arange(128), indexing="ij")
    low = (a ^ b) & -(a ^ b)
    bit = np.log2(np.maximum(low, 1)).astype(int)
    return (2 * bit + ((a >> bit) & 1)).astype(np.uint8).ravel()


@lru_cache(1)
def _byte_names() -> np.ndarray:
    return _mix(np.arange(256, dtype=np.uint64) + np.uint64(1))


def _labels(names: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Labels below 6 for names of which no neighbours of one text are equal; ``first`` are the texts' first places."""
    differ = np.empty_like(names)
    np.bitwise_xor(names[1:], names[:-1], out=differ[1:])
    differ[first] = ~np.uint64(0)
    low = differ & (~differ + np.uint64(1))
    # the place of the one bit is the number of bits below it
    label = 2 * np.bitwise_count(low - np.uint64(1)) + ((names & low) != 0)
    table = _toss()
    for _ in range(3):
        place = label.astype(np.intp) << 7
        place[1:] |= label[:-1]
        place[first] = (label[first].astype(np.intp) << 7) | (label[first] ^ 1)
        label = table.take(place)
    return label


def _sizes(starts: np.ndarray, n: int) -> np.ndarray:
    out = np.empty_like(starts)
    np.subtract(starts[1:], starts[:-1], out=out[:-1])
    out[-1] = n - starts[-1]
    return out


def _hash_blocks(names: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """One name per block: a hash of the names in it, in order."""
    size = _sizes(starts, len(names))
    place = np.arange(1, len(names) + 1) - np.repeat(starts, size)
    terms = _mix(names + _ODD * place.view(np.uint64))
    return _mix(np.add.reduceat(terms, starts) + size.view(np.uint64))


def levels(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text numbers, names) of each level of several texts parsed side by side, the bytes' own names first.

    A text goes down to a single phrase and is not in the levels after it; no phrase reaches over a text's end.
    """
    sizes = np.array([len(t) for t in texts], np.int64)
    text = np.repeat(np.arange(len(texts)), sizes)
    names = _byte_names().take(np.frombuffer(b"".join(texts), np.uint8))
    yield text, names
    while True:
        more = (np.bincount(text, minlength=len(texts)) > 1)[text]
        text, names = text[more], names[more]
        if not len(names):
            return
        new = np.ones(len(names), bool)
        new[1:] = (names[1:] != names[:-1]) | (text[1:] != text[:-1])
        if not new.all():  # runs
            starts = np.flatnonzero(new)
            runs, names, text = _sizes(starts, len(names)), names[starts], text[starts]
            many = np.flatnonzero(runs > 1)
            names[many] = _mix(names[many] + runs[many].view(np.uint64) * _ODD)
        head = np.ones(len(names), bool)
        head[1:] = text[1:] != text[:-1]
        last = np.append(head[1:], True)
        # a run's name may meet its neighbour's only by a collision of 64-bit hashes
        label = _labels(names, np.flatnonzero(head))
        rise = label[1:] > label[:-1]
        begin = head.copy()
        begin[1:-1] |= rise[:-1] & (label[1:-1] > label[2:]) & ~last[1:-1]
        starts = np.flatnonzero(begin)
        alone = (head & last)[starts]  # a text of one run is its name
        names, text = np.where(alone, names[starts], _hash_blocks(names, starts)), text[starts]
        yield text, names


def parse(data: bytes) -> list[np.ndarray]:
    """Names of each level of one text."""
    return [names for _, names in levels([data])] if data else []


def fingerprints_of(texts: list[bytes]) -> list[str]:
    """The fingerprint of each text; parsed together in groups of about ``TOGETHER`` bytes."""
    out: list[str] = []
    start = 0
    while start < len(texts):
        end, size = start + 1, len(texts[start])
        while end < len(texts) and size + len(texts[end]) <= TOGETHER:
            size += len(texts[end])
            end += 1
        out += _fingerprints(texts[start:end])
        start = end
    return out


def _fingerprints(texts: list[bytes]) -> list[str]:
    owners, found = [], []
    deep = np.zeros(len(texts), bool)
    shallow: dict[int, int] = {}
    for k, (text, names) in enumerate(levels(texts)):
        if k >= FROM_LEVEL:
            owners.append(text)
            found.append(names)
            deep[text] = True
        else:  # texts that end before that level have one name there
            single = (np.bincount(text, minlength=len(texts)) == 1)[text]
            shallow |= zip(text[single].tolist(), names[single].tolist())
    out = ["" if not t else f"{shallow.get(i, 0):016x}" for i, t in enumerate(texts)]
    if owners:
        owner, names = np.concatenate(owners), np.concatenate(found)
        order = np.lexsort((names, owner))
        owner, names = owner[order], names[order]
        fresh = np.ones(len(names), bool)
        fresh[1:] = (owner[1:] != owner[:-1]) | (names[1:] != names[:-1])
        owner, names = owner[fresh], names[fresh]
        starts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        for i, a, n in zip(owner[starts].tolist(), starts.tolist(), _sizes(starts, len(owner)).tolist()):
            out[i] = "".join(f"{x:016x}" for x in names[a : a + min(n, KEEP)].tolist())
    return out


def fingerprint(data: bytes) -> str:
    return fingerprints_of([data])[0]


def likeness(a: str, b: str) -> float:
    """Estimated share of common phrases, from the smallest names of both."""
    x = {a[i : i + 16] for i in range(0, len(a), 16)}
    y = {b[i : i + 16] for i in range(0, len(b), 16)}
    if not x or not y:
        return float(x == y)
    both = sorted(x | y)[:KEEP]
    return sum(v in x and v in y for v in both) / len(both)


def _followed(documents: DataFrame, key: str) -> DataFrame:
    """Rows dealt into ranges of ``key``, one to a task; the first row of a range stands also at the end of
    the one before.

    Columns (range, key, text, ghost), sorted. Range ends are quantiles, about ``RANGE_BYTES`` of text apart, so
    they are few and small; a first row is found by its key.
    """
    spark = documents.sparkSession
    total = documents.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    parts = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")), min(MAX_RANGES, math.ceil(total / RANGE_BYTES)))
    id_ = F.coalesce(F.col(key).cast("long"), F.lit(NO_ID))
    own = documents.select(id_.alias("key"), F.coalesce("text", F.lit("")).alias("text"))
    cuts = own.approxQuantile("key", [i / parts for i in range(1, parts)], 0.25 / parts)
    cuts = sorted({int(c) for c in cuts})
    place = F.lit(0)
    if cuts:  # first the chunk of cuts, then the place in it
        size = math.isqrt(len(cuts)) + 1
        chunks = [cuts[k : k + size] for k in range(0, len(cuts), size)]
        literal = lambda values: F.array(*[F.lit(c).cast("long") for c in values])
        before = lambda values: F.size(F.filter(values, lambda c: c <= F.col("key")))
        chunk = before(literal([c[-1] for c in chunks]))
        inside = F.get(F.array(*map(literal, chunks)), chunk)
        place = chunk * size + F.when(inside.isNull(), F.lit(0)).otherwise(before(inside))
        # after the last cut there is no chunk
        place = F.least(place, F.lit(len(cuts)))
    dealt = own.withColumn("range", place)
    firsts = dealt.groupBy("range").agg(F.min("key").alias("key")).collect()  # at most one row per range
    firsts = sorted((r["range"], r["key"]) for r in firsts)
    # a range's first row goes to the range before; the very first also follows the last row of all
    goes = [(before, now[1]) for (before, _), now in zip(firsts, firsts[1:])]
    if firsts:
        goes.append((firsts[-1][0], firsts[0][1]))
    dealt = dealt.withColumn("ghost", F.lit(False))
    if goes:
        moves = F.array(*[F.struct(F.lit(r).alias("r"), F.lit(k).cast("long").alias("k")) for r, k in goes])
        copies = F.explode(F.transform(F.filter(moves, lambda m: m["k"] == F.col("key")), lambda m: m["r"]))
        chosen = own.where(F.col("key").isin([k for _, k in goes]))
        least = chosen.groupBy("key").agg(F.min("text").alias("text"))
        dealt = dealt.unionByName(least.select("key", "text", copies.alias("range"), F.lit(True).alias("ghost")))
    # a number for each range whose hash is the range's own partition
    own_number = spark.range(64 * parts).select("id", F.pmod(F.hash("id"), F.lit(parts)).alias("to"))
    numbers = {r["to"]: r["id"] for r in own_number.groupBy("to").agg(F.min("id").alias("id")).collect()}
    slots = F.array(*[F.lit(numbers.get(k, k)).cast("long") for k in range(len(cuts) + 1)])
    dealt = dealt.withColumn("slot", F.get(slots, F.col("range"))).repartition(parts, "slot").drop("slot")
    return dealt.sortWithinPartitions("range", "ghost", "key", "text")


def fingerprints(documents: DataFrame) -> DataFrame:
    """The contract's columns."""
    kind = (
        "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double"
    )
    names = [c.split()[0] for c in kind.split(", ")]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []  # the last row: (range, key, text, fingerprint, is it a first row's stand-in)
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                some = batch.slice(start, ROWS)
                places, keys, texts, ghosts = (some.column(c).to_pylist() for c in ("range", "key", "text", "ghost"))
                rows = held + list(zip(places, keys, texts, fingerprints_of([t.encode() for t in texts]), ghosts))
                pairs = [(a, b) for a, b in zip(rows, rows[1:]) if a[0] == b[0] and not a[4]]
                held = rows[-1:]
                edited = [_edited(a[2], b[2]) for a, b in pairs]
                prints = fingerprints_of([e.encode() for e in edited])
                out = [
                    (None if a[1] == NO_ID else a[1], len(a[2]), sha256(e), a[3], p, likeness(a[3], p), likeness(a[3], b[3]))
                    for (a, b), e, p in zip(pairs, edited, prints)
                ]
                columns = list(zip(*out)) or [()] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    return _followed(documents, "doc_id").mapInArrow(run, kind)


def _edited(text: str, after: str) -> str:
    half = len(text) // 2
    return text[: len(text) - half] + after[:half]
