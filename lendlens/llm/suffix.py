"""Removal of repeated byte strings by merged shard Burrows-Wheeler transforms.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts earlier in the corpus.

1. Equal whole texts are one text; all but the first go whole. The rows are written once in buckets by document;
   after that only narrow rows move, and what is found is joined to the texts where they lie.
2. Each window of ``LENGTH`` bytes belongs to its smallest 32-byte gram, which only depends on the window.
   Windows in a row with one such gram make a segment, so equal windows lie in segments of one gram.
   The grams are counted alone; segments of a gram that is alone hold no repeat and are not asked for again.
   Equal segments are one, and later ones go whole.
3. The differing segments of a gram meet in buckets of bounded size. A bucket's segments are dealt to shards.
   A symbol is a word of ``WORD`` bytes, and a segment is read from each of its first ``WORD`` places.
   Each shard gets a suffix array and a Burrows-Wheeler transform; the shards' transforms are merged by
   refining their interleave, one symbol a round, which sorts by ``WORD`` more bytes each time and shows
   where common prefixes end. After ``LENGTH // WORD`` rounds, neighbours that were not split are one repeated
   interval, and all but its earliest start go. No suffix is sorted again.
4. A gram with more segments than a bucket should hold is dealt over several; for those, each bucket's
   distinct windows are compared by a 128-bit hash, pre-aggregated, to find the earliest of all buckets.

Odd input: null is empty; texts shorter than ``LENGTH`` lose nothing; rows that repeat id and text are
one document for the order and get one result each; texts of one id are ordered by a hash; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lendlens.llm.common import per_batch, sha256, utf8
from lendlens.session import materialize, work_dir

LENGTH = 100
GRAM = 32
SHARDS = 2
#: Segments that a bucket holds on average.
BUCKET = 2_000
#: Bytes of a text that are looked at together; pieces overlap by a window.
PIECE = 8_000_000
#: Bytes of short texts that are looked at together.
TOGETHER = 1 << 17
#: Bytes of a symbol of the transforms; an even divisor of ``LENGTH``.
WORD = 10
#: Bits for a segment's windows, at most ``LENGTH - GRAM + 1``.
WINDOW_BITS = 7
#: Bytes of the texts of a bucket by doc.
TEXT_BYTES = 16_000_000
#: Spark's limit for the buckets of a table.
MOST_BUCKETS = 100_000


def grams(data: np.ndarray) -> np.ndarray:
    """A hash of the gram at each position."""
    value = (data.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    factor, width = 0xD6E8FEB86659FD93, 1
    while width < GRAM:
        value = value[:-width] * np.uint64(factor) + value[width:]
        value ^= value >> np.uint64(32)
        value *= np.uint64(0xBF58476D1CE4E5B9)
        factor = factor * factor % (1 << 64)
        width *= 2
    return value


def smallest(piece: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(gram hashes, the smallest one's key for each window); a key's lowest 24 bits are its place."""
    value = grams(piece)
    # the place breaks ties to the left; 40 bits of the hash order the grams
    key = (value & ~np.uint64((1 << 24) - 1)) | np.arange(len(value), dtype=np.uint64)
    span = LENGTH - GRAM + 1
    least, width = key, 1
    while width * 2 <= span:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    windows = len(piece) - LENGTH + 1
    return value, np.minimum(least[:windows], least[span - width : span - width + windows])


def segments(data: bytes) -> Iterator[tuple[int, int, int]]:
    """(gram, first window, windows) for each run of windows with one smallest gram."""
    for base in range(0, max(1, len(data) - LENGTH + 1), PIECE):
        piece = np.frombuffer(data[base : base + PIECE + LENGTH - 1], np.uint8)
        if len(piece) < LENGTH:
            continue
        value, least = smallest(piece)
        starts = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
        at = (least[starts] & np.uint64((1 << 24) - 1)).astype(np.int64)
        yield from zip(
            value[at].view(np.int64).tolist(), (starts + base).tolist(), np.diff(starts, append=len(least)).tolist()
        )


def segments_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, gram, first window, windows) of the segments of many texts; short ones are looked at together."""
    found: list[tuple[np.ndarray, ...]] = []
    group: list[int] = []

    def close() -> None:
        lengths = np.array([len(texts[i]) for i in group])
        ends = np.cumsum(lengths)
        owner = np.repeat(np.arange(len(group)), lengths)
        value, least = smallest(np.frombuffer(b"".join(texts[i] for i in group), np.uint8))
        places = np.flatnonzero(np.arange(len(least)) + LENGTH <= ends[owner[: len(least)]])
        least, owner = least[places], owner[places]
        new = np.concatenate([[True], (least[1:] != least[:-1]) | (owner[1:] != owner[:-1])])
        starts = np.flatnonzero(new)
        at, owner = (least[starts] & np.uint64((1 << 24) - 1)).astype(np.int64), owner[starts]
        begin = places[starts] - (ends - lengths)[owner]
        found.append((np.array(group)[owner], value[at].view(np.int64), begin, np.diff(starts, append=len(places))))
        group.clear()

    total = 0
    for i, text in enumerate(texts):
        if len(text) > PIECE:
            found += [tuple(np.array([x]) for x in (i, *s)) for s in segments(text)]
        elif len(text) >= LENGTH:
            if group and total + len(text) > TOGETHER:
                close()
                total = 0
            group.append(i)
            total += len(text)
    if group:
        close()
    if not found:
        found.append((np.zeros(0, np.int64),) * 4)
    return tuple(np.concatenate(x) for x in zip(*found))


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """By prefix doubling; the last symbol is smaller than all others."""
    rank = symbols.astype(np.int64)
    width = 1
    while True:
        second = np.zeros(len(rank), np.int64)
        second[:-width] = rank[width:] + 1
        key = rank * (int(second.max()) + 1) + second
        order = np.argsort(key)
        sorted_key = key[order]
        rank = np.empty(len(rank), np.int64)
        rank[order] = np.concatenate([[0], np.cumsum(sorted_key[1:] != sorted_key[:-1])])
        if rank[order[-1]] == len(rank) - 1 or width >= len(rank):
            return order
        width *= 2


def by_symbol(symbols: np.ndarray) -> np.ndarray:
    """The stable order; 16 bits are sorted by their digits."""
    if symbols.dtype == np.uint16:
        return np.argsort(symbols, kind="stable")
    low = np.argsort(symbols.astype(np.uint16), kind="stable")
    return low[np.argsort((symbols >> 16).astype(np.uint16)[low], kind="stable")]


def merge(first: tuple[np.ndarray, np.ndarray], second: tuple[np.ndarray, np.ndarray], depth: int):
    """Merged (transform, places) of two, and which neighbours share ``depth`` symbols.

    A round sorts the interleave stably by the symbol before each suffix, as the last-to-first mapping
    does; a suffix's class is its first symbols so far, and a class is split where the round tells apart.
    """
    count = len(first[0]) + len(second[0])
    source = np.concatenate([np.zeros(len(first[0]), bool), np.ones(len(second[0]), bool)])
    classes = np.zeros(count, np.int32)
    own = [first[0], second[0]]
    at = np.empty(count, np.result_type(*own))
    for _ in range(depth):
        at[~source], at[source] = own
        order = by_symbol(at)
        lead, old = at[order], classes[order]
        new = np.empty(count, np.int32)
        new[0] = 0
        np.cumsum((lead[1:] != lead[:-1]) | (old[1:] != old[:-1]), out=new[1:])
        turned = source[order]
        # a round only splits classes
        changing = new[-1:] != classes[-1:] or not np.array_equal(turned, source)
        source, classes = turned, new
        if not changing:  # every class is as fine as it gets
            break
    merged = np.empty_like(at)
    merged[~source], merged[source] = own
    places = np.empty(count, np.int64)
    places[~source], places[source] = first[1], second[1]
    return merged, places, classes


def word_ranks(data: np.ndarray) -> np.ndarray:
    """The rank of the ``WORD`` bytes from each place on, among all of them; zeros follow the last byte."""
    half = WORD // 2
    value = np.zeros(len(data) + half, np.uint64)
    for k in range(half):
        value[: len(data) - k] |= data[k:].astype(np.uint64) << np.uint64(8 * (half - 1 - k))
    value = np.unique(value, return_inverse=True)[1]
    return np.unique((value[:-half] << 32) | value[half:], return_inverse=True)[1]


def repeated(bodies: list[bytes], shards: int = SHARDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(body, offset, class) of all windows of the bodies; equal windows have one class.

    A symbol is a word of ``WORD`` bytes: a body is ``WORD`` strings, of the words at every ``WORD``-th place
    from its first places on, so that each window is a run of ``LENGTH // WORD`` symbols of one of them.
    """
    lengths = np.array([len(b) for b in bodies])
    body = np.repeat(np.arange(len(bodies)), lengths)
    offset = np.arange(len(body)) - (np.cumsum(lengths) - lengths)[body]
    words = word_ranks(np.frombuffer(b"".join(bodies), np.uint8)) + 2
    words = words.astype(np.uint16 if len(words) and words.max() < 1 << 16 else np.uint32)
    full = offset + WORD <= lengths[body]
    body, offset, words = body[full], offset[full], words[full]
    # a string's words lie together, behind them a 1; a shard ends with a 0
    phase = np.arange(WORD)
    sizes = (lengths[:, None] - WORD - phase) // WORD + 2
    begins = np.cumsum(sizes, axis=1) - sizes
    transforms, begin = [], 0
    places = []
    for k in range(min(shards, len(bodies))):
        own = np.arange(k, len(bodies), shards)
        blocks = np.zeros(len(bodies), np.int64)
        blocks[own] = np.cumsum(sizes[own].sum(axis=1)) - sizes[own].sum(axis=1)
        mine = np.flatnonzero(body % shards == k)
        b, o = body[mine], offset[mine]
        to = blocks[b] + begins[b, o % WORD] + o // WORD
        symbols = np.ones(int(sizes[own].sum()) + 1, words.dtype)
        symbols[-1] = 0
        symbols[to] = words[mine]
        place = np.full(len(symbols), -1)
        place[to] = mine
        places.append(place)
        order = suffix_array(symbols)
        transforms.append((symbols[order - 1], order + begin))
        begin += len(symbols)
    if not transforms:
        return body, offset, np.zeros(0, np.int32)
    if len(transforms) == 1:  # one shard is merged with an empty one
        transforms.append((np.zeros(0, words.dtype), np.zeros(0, np.int64)))
    merged, found, classes = merge(transforms[0], transforms[1], LENGTH // WORD)
    for more in transforms[2:]:
        merged, found, classes = merge((merged, found), more, LENGTH // WORD)
    at = np.concatenate(places)[found]
    classes, at = classes[at >= 0], at[at >= 0]
    body, offset = body[at], offset[at]
    whole = offset + LENGTH <= lengths[body]
    return body[whole], offset[whole], classes[whole]


SEGMENT = [("doc", pa.int64()), ("gram", pa.int64()), ("at", pa.int64())]


def _segment_rows(texts: DataFrame) -> DataFrame:
    """(doc, gram, at): ``at`` holds the first window and, in its lowest bits, the number of windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, gram, start, n = segments_of(utf8(batch.column("text")))
            doc = batch.column("doc").take(pa.array(row))
            yield pa.RecordBatch.from_arrays([doc, pa.array(gram), pa.array((start << WINDOW_BITS) | n)], schema=pa.schema(SEGMENT))

    return texts.select("doc", "text").mapInArrow(run, "doc bigint, gram bigint, at bigint")


def _cut(texts: DataFrame, wanted: DataFrame, column: str, kind: pa.DataType, work: Callable[[bytes], bytes]) -> DataFrame:
    """``wanted`` (doc, gram, at) as (gram, id, doc, start, n) and ``work`` of the bytes of each segment; the
    texts stay where they are."""
    lists = wanted.groupBy("doc").agg(F.collect_list(F.struct("gram", "at")).alias("cuts"))
    schema = pa.schema([*((c, pa.int64()) for c in ("gram", "id", "doc", "start", "n")), (column, kind)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in (whole.slice(k, 500) for k in range(0, len(whole), 500)):
                row, gram, at = flat(batch.column("cuts"))
                start, n = at >> WINDOW_BITS, at & ((1 << WINDOW_BITS) - 1)
                texts = utf8(batch.column("text"))
                ends = (start + n + LENGTH - 1).tolist()
                cut = [work(texts[r][a:b]) for r, a, b in zip(row.tolist(), start.tolist(), ends)]
                own = (batch.column(c).take(pa.array(row)) for c in ("id", "doc"))
                columns = [pa.array(gram), *own, pa.array(start), pa.array(n), pa.array(cut, kind)]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    named = f"gram bigint, id bigint, doc bigint, start bigint, n bigint, {column} binary"
    return texts.select("doc", "id", "text").join(lists, "doc").mapInArrow(run, named)


def flat(lists: pa.Array) -> tuple[np.ndarray, ...]:
    """The row of each struct of a column of lists, and its fields, none of them null."""
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    fields = (f.to_numpy(zero_copy_only=False) for f in lists.flatten().flatten())
    return np.repeat(np.arange(len(lists)), sizes), *fields


def _content(segment: bytes) -> bytes:
    return hashlib.blake2b(segment, digest_size=16).digest()


def _within(cut: DataFrame) -> DataFrame:
    """(id, doc, start, end, key): runs of windows with an earlier equal one in their bucket, and for grams over
    several buckets every bucket's first window of each content, with its hash as ``key``."""
    kind = "id bigint, doc bigint, start bigint, end bigint, key binary"

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        # the segments of a text share no window, so this is the order of their windows too
        frame = frame.sort_values(["id", "doc", "start"], kind="stable", ignore_index=True)
        bodies = frame["body"].tolist()
        body, offset, classes = repeated(bodies)
        lengths = np.array([len(b) for b in bodies])
        begins = np.cumsum(lengths) - lengths
        place = begins[body] + offset
        new = np.flatnonzero(np.concatenate([[True], classes[1:] != classes[:-1]]))
        firsts = np.sort(np.minimum.reduceat(place, new))
        later = np.zeros(int(lengths.sum()), bool)
        later[place] = True
        later[firsts] = False
        # windows in a row are one span; those of two segments are never in a row
        later = np.flatnonzero(later)
        gap = later[1:] != later[:-1] + 1
        begin, last = later[np.append(True, gap)[: len(later)]], later[np.append(gap, True)[: len(later)]]
        owner = np.repeat(np.arange(len(bodies)), lengths)
        alone = firsts[frame["spread"].to_numpy()[owner[firsts]]]
        joined = b"".join(bodies) if len(alone) else b""
        keys = [_content(joined[p : p + LENGTH]) for p in alone.tolist()]
        begin, last = np.concatenate([begin, alone]), np.concatenate([last, alone])
        owner = owner[begin]
        shift = frame["start"].to_numpy()[owner] - begins[owner]
        key = pd.Series([None] * (len(begin) - len(alone)) + keys, dtype=object)
        found = {"id": frame["id"].to_numpy()[owner], "doc": frame["doc"].to_numpy()[owner]}
        return pd.DataFrame(found | {"start": begin + shift, "end": last + shift + LENGTH, "key": key})

    return cut.groupBy("bucket").applyInPandas(run, kind)


NO_ID = -(1 << 63)  # rows without an id come first


def removals(texts: DataFrame) -> DataFrame:
    """(doc, start, end) byte spans to remove, of distinct texts (doc, id, text)."""
    rows = _segment_rows(texts)
    # the grams move alone first: most are alone, and their segments are not asked for again
    shared = rows.groupBy("gram").agg(F.count("*").alias("m")).where("m > 1").select("gram")
    rows = rows.join(materialize(shared, "grams"), "gram")
    rows = materialize(_cut(texts, rows, "content", pa.binary(), _content), "shared")
    place = F.struct("id", "doc", "start")
    firsts = rows.groupBy("gram", "content").agg(F.min(place).alias("p"), F.max("n").alias("n"))
    firsts = materialize(firsts.select("gram", "content", "p.*", "n"), "firsts")
    # equal segments: all but the first go whole
    other = firsts.select("gram", "content", F.col("doc").alias("d"), F.col("start").alias("s"))
    copies = rows.join(other, ["gram", "content"]).where("doc <> d OR start <> s")
    copies = copies.select("doc", "start", (F.col("start") + F.col("n") + LENGTH - 1).alias("end"))
    # differing segments of one gram meet byte by byte
    several = firsts.groupBy("gram").agg(F.count("*").alias("m")).where("m > 1")
    at = F.shiftleft("start", WINDOW_BITS).bitwiseOR(F.col("n"))
    met = materialize(firsts.join(several, "gram").select("gram", "doc", at.alias("at"), "m"), "met")
    buckets = max(1, met.count() // BUCKET)
    cut = _cut(texts, met, "body", pa.binary(), bytes).join(several, "gram")
    spread = F.col("m") > BUCKET
    deal = F.when(spread, F.xxhash64("gram", "doc", "start")).otherwise(F.xxhash64("gram"))
    cut = cut.withColumns({"spread": spread, "bucket": F.pmod(deal, F.lit(buckets))}).drop("m", "gram", "n")
    found = materialize(_within(cut), "windows")
    over = found.where("key IS NOT NULL")
    least = over.groupBy("key").agg(F.min(F.struct("id", "doc", "start")).alias("p"), F.count("*").alias("m")).where("m > 1")
    over = over.join(least, "key").where("NOT (doc = p.doc AND start = p.start)").select("doc", "start", "end")
    return copies.unionByName(found.where("key IS NULL").select("doc", "start", "end")).unionByName(over)


def _by_doc(rows: DataFrame) -> DataFrame:
    """``rows`` written in buckets of about ``TEXT_BYTES`` by doc, so that the texts move once: what is joined to
    them later comes to them."""
    spark = rows.sparkSession
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    keys = rows.where(F.octet_length("text") >= LENGTH).select("doc", "id", "copy_key")
    heads = keys.groupBy("copy_key").agg(F.min(F.struct("id", "doc")).alias("h")).select(F.col("h.doc").alias("doc"))
    heads = materialize(heads, "heads").withColumn("head", F.lit(True))
    parts = max(spark.sparkContext.defaultParallelism, min(-(-size // TEXT_BYTES), MOST_BUCKETS))
    found = rows.drop("copy_key").repartition(parts, "doc").join(heads, "doc", "left")
    # rows that repeat id and text are one document
    turn = F.row_number().over(Window.partitionBy("doc").orderBy(F.lit(0)))
    found = found.withColumn("head", F.coalesce("head", F.lit(False))).withColumn("lead", F.col("head") & (turn == 1))
    name = f"texts_{uuid.uuid4().hex}"
    found.write.bucketBy(parts, "doc").option("path", f"{work_dir(spark)}/{name}").saveAsTable(name)
    return spark.table(name)


def deduplicate(documents: DataFrame) -> DataFrame:
    """(doc_id, text, cuts, whole): byte spans to remove, in any order; ``whole``: the text is a copy."""
    own = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    own = own.withColumns({"id": F.coalesce("doc_id", F.lit(NO_ID)), "copy_key": F.sha2("text", 256)})
    own = _by_doc(own.withColumn("doc", F.xxhash64("id", "copy_key")))
    spans = removals(own.where("lead")).groupBy("doc").agg(F.collect_list(F.struct("start", "end")).alias("cuts"))
    marked = own.join(spans, "doc", "left")
    whole = ~F.col("head") & (F.octet_length("text") >= LENGTH)
    return marked.select("doc_id", "text", F.coalesce("cuts", F.array().cast("array<struct<start:bigint,end:bigint>>")).alias("cuts"), whole.alias("whole"))


def kept(found: DataFrame) -> DataFrame:
    """The contract's columns."""

    def work(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {"n_bytes": [], "n_removed": [], "n_spans": [], "kept_sha256": []}
        row, start, end = flat(batch.column("cuts"))
        order = np.lexsort((end, start, row))
        spans = list(zip(start[order].tolist(), end[order].tolist()))
        stops = np.cumsum(np.bincount(row, minlength=len(batch))).tolist()
        for data, first, stop, whole in zip(utf8(batch.column("text")), [0, *stops], stops, batch.column("whole").to_pylist()):
            gone: list[list[int]] = [[0, len(data)]] if whole else []
            for a, b in [] if whole else spans[first:stop]:
                if gone and a <= gone[-1][1]:
                    gone[-1][1] = max(b, gone[-1][1])
                else:
                    gone.append([a, b])
            left, at = [], 0
            for a, b in gone:
                left.append(data[at:a])
                at = b
            left.append(data[at:])
            out["n_bytes"].append(len(data))
            out["n_removed"].append(sum(b - a for a, b in gone))
            out["n_spans"].append(len(gone))
            out["kept_sha256"].append(sha256(b"".join(left)))
        return out | {"doc_id": batch.column("doc_id")}

    return per_batch(found, work, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string")
