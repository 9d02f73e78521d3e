"""Ranked lexical search over bit-sliced Bloom signatures.

A document's signature holds its terms, and again each term on level p if it occurs 2^p times or more.
Documents of like size form a block whose signatures are stored by bit position: a slice is a bitmap of
documents. The slices of a term, AND-ed, name every document that may hold it and bound its occurrences
from above, so a weighted sum over a query's terms bounds each document's score from above. The best
documents by bound are scored exactly, which gives each query a score that its results must reach; every
document whose bound reaches it is then scored exactly on its whole text, and no other can be a result.

Queries are searched in blocks of bounded size against the one index, which covers every document.

Odd input: null and empty texts and texts without terms are no documents of the ranking; a null id ranks
after all others of its score; repeated rows are documents of their own; a query without terms has no
results, a repeated query has its results again. Other columns of the inputs are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lendlens.llm.common import utf8
from lendlens.llm.decontaminate import words
from lendlens.session import materialize

TOP = 10
#: Bits per key at least, and positions a key sets: a key is falsely present with less than 0.1 %.
SPREAD, HASHES = 16, 6
#: A block of signatures holds so many documents, or fewer so that it has about so many bytes.
BLOCK_DOCS, BLOCK_BYTES = 1_024, 1024 * 1024
#: Query bytes searched in one pass over the index, and terms bounded together.
QUERY_BYTES, QUERY_TERMS = 8_000_000, 4_096
#: Candidates are joined by broadcast up to so many rows and query numbers, else by a shuffle.
BROADCAST_ROWS = 200_000
CACHE = 400_000
_LAST = 2**63 - 1  # stands for a null id: after all others
_EXACT = 2.0**53


# ---- the index --------------------------------------------------------------------------------------------------


def _mixed(keys: np.ndarray) -> np.ndarray:
    """A 64-bit mix (the finalizer of SplitMix64)."""
    keys = (keys ^ (keys >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    keys = (keys ^ (keys >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return keys ^ (keys >> np.uint64(31))


def positions(hashes: np.ndarray, level: np.ndarray | int, bits: int) -> np.ndarray:
    """(keys, HASHES) bit positions of terms on levels; ``bits`` is a power of two."""
    keys = _mixed(hashes + np.asarray(level).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    first, step = keys & np.uint64(0xFFFFFFFF), (keys >> np.uint64(32)) | np.uint64(1)
    spread = first[:, None] + np.arange(HASHES, dtype=np.uint64) * step[:, None]
    return (spread & np.uint64(bits - 1)).astype(np.int64)


def term_hash(term: bytes) -> int:
    return xxhash.xxh3_64_intdigest(term)


class Block:
    """Signatures of one width, by bit position."""

    def __init__(self, bits: int):
        self.bits = bits
        self.room = max(8, min(BLOCK_DOCS, BLOCK_BYTES * 8 // bits))
        self.slices = np.zeros((bits, self.room // 8), np.uint8)
        self.about: list[tuple] = []

    def add(self, about: tuple, hashes: np.ndarray, counts: np.ndarray) -> bool:
        """True if the block is full now."""
        levels = np.frexp(counts.astype(float))[1]  # tf from 2^(l-1) to 2^l - 1
        keys = np.repeat(hashes, levels)
        starts = np.cumsum(levels) - levels
        at = positions(keys, np.arange(len(keys)) - np.repeat(starts, levels), self.bits).ravel()
        k = len(self.about)
        self.slices[at, k >> 3] |= np.uint8(1 << (k & 7))
        self.about.append(about)
        return len(self.about) == self.room

    def row(self) -> list:
        ids, keys, sizes, most = zip(*self.about)
        return [self.bits, ids, keys, sizes, most, self.slices[:, : (len(ids) + 7) // 8].tobytes()]


_INDEX = "bits bigint, ids array<bigint>, keys array<bigint>, sizes array<bigint>, most array<bigint>, slices binary"
_INDEX_TYPES = [pa.int64(), *[pa.list_(pa.int64())] * 4, pa.binary()]


def _texts(documents: DataFrame) -> DataFrame:
    """(doc_id, key, text): rows of equal ``doc_id`` and ``key`` are taken together, and scored by their own text."""
    own = documents.where("text IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return own.select("doc_id", F.xxhash64("text").alias("key"), "text")


def build(documents: DataFrame) -> DataFrame:
    """The index of all documents that have a term: one row per block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_blocks: dict[int, Block] = {}
        known: dict[bytes, int] = {}

        def out(block: Block) -> pa.RecordBatch:
            arrays = [pa.array([v], t) for v, t in zip(block.row(), _INDEX_TYPES)]
            return pa.RecordBatch.from_arrays(arrays, [c.split()[0] for c in _INDEX.split(", ")])

        for batch in batches:
            for doc, key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                found = Counter(words(text.as_py().encode()))
                if not found:
                    continue
                if len(known) > CACHE:
                    known.clear()
                for term in found:
                    if term not in known:
                        known[term] = term_hash(term)
                hashes = np.fromiter(map(known.__getitem__, found), np.uint64, len(found))
                counts = np.fromiter(found.values(), np.int64, len(found))
                size = int(np.frexp(counts.astype(float))[1].sum())
                bits = 1 << max(6, (SPREAD * size - 1).bit_length())
                block = open_blocks.setdefault(bits, Block(bits))
                if block.add((doc, key, int(counts.sum()), int(counts.max())), hashes, counts):
                    yield out(open_blocks.pop(bits))
        for block in open_blocks.values():
            yield out(block)

    return materialize(_texts(documents).mapInArrow(run, _INDEX), "signatures")


# ---- queries ----------------------------------------------------------------------------------------------------


def _blocks(queries: DataFrame) -> Iterator[list[tuple[int | None, list[bytes]]]]:
    """(item_id, distinct terms) of each query, in lists of about ``QUERY_BYTES``."""
    own = queries.where("text IS NOT NULL").select(F.col("item_id").cast("long").alias("item_id"), "text")
    total = own.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    parts = math.ceil(total / QUERY_BYTES)
    for k in range(parts):
        part = own.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == k)
        rows = part.collect()  # bounded: one block of about QUERY_BYTES
        yield [(r["item_id"], sorted(set(words(r["text"].encode())))) for r in rows]


class Queries:
    """A block of queries with the statistics of their terms."""

    def __init__(self, items: list, df: dict[bytes, int], n_docs: int, n_terms: int):
        self.items = [(i, [t for t in terms if df.get(t)]) for i, terms in items]
        self.n_docs, self.n_terms = n_docs, n_terms
        self.weights = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for t, d in df.items()}

    def length(self, n: int) -> int:
        return 10 + 90 * n * self.n_docs // self.n_terms

    def chunks(self) -> Iterator[tuple[list[int], list[bytes]]]:
        """Queries (by number) whose terms are bounded together: ``QUERY_TERMS`` terms, or one query."""
        own, terms = [], {}
        for k, (_, mine) in enumerate(self.items):
            new = [t for t in mine if t not in terms]
            if own and len(terms) + len(new) > QUERY_TERMS:
                yield own, list(terms)
                own, terms, new = [], {}, mine
            if mine:
                own.append(k)
                terms.update(dict.fromkeys(new))
        if own:
            yield own, list(terms)


def _statistics(documents: DataFrame, items: list) -> Queries:
    """Document frequencies of the queries' terms, the number of documents and of their terms."""
    spark = documents.sparkSession
    names = sorted({t for _, terms in items for t in terms})
    number = spark.sparkContext.broadcast({t: k for k, t in enumerate(names)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(len(number.value) + 2, np.int64)
        for batch in batches:
            for text in batch.column(0):
                own = words(text.as_py().encode())
                if own:
                    seen[-2] += 1
                    seen[-1] += len(own)
                    for term in number.value.keys() & set(own):
                        seen[number.value[term]] += 1
        term = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(term), pa.array(seen[term])], ["term", "n"])

    counts = documents.where("text IS NOT NULL").select("text").mapInArrow(run, "term bigint, n bigint")
    # one row per term of the block of queries
    found = {r["term"]: r["n"] for r in counts.groupBy("term").agg(F.sum("n").alias("n")).collect()}
    df = {t: found[k] for k, t in enumerate(names) if k in found}
    return Queries(items, df, found.get(len(names), 0), found.get(len(names) + 1, 0))


class Prepared:
    """A chunk of queries, ready to be bounded on blocks."""

    def __init__(self, queries: Queries, own: list[int], terms: list[bytes]):
        self.own = own
        self.hashes = np.array([term_hash(t) for t in terms], np.uint64)
        place = {t: k for k, t in enumerate(terms)}
        self.rows = [np.array([place[t] for t in queries.items[k][1]]) for k in own]
        self.weights = [np.array([queries.weights[t] for t in queries.items[k][1]], float) for k in own]
        # sums that floats cannot hold exactly are raised a little: they stay upper bounds
        self.exact = [float(w.sum()) * 1e6 < _EXACT for w in self.weights]

    def bounds(self, slices: np.ndarray, n: int, length: np.ndarray, most: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(query number, upper bounds of the scores of the block's documents)."""
        bits = len(slices)
        masks = np.bitwise_and.reduce(slices[positions(self.hashes, 0, bits)], axis=1)
        present = np.unpackbits(masks, axis=1, count=n, bitorder="little")
        levels = present.astype(np.int64)
        live, level = np.flatnonzero(masks.any(axis=1)), 1
        masks = masks[live]
        while len(live):  # levels above: occurrences are bounded by the first that is absent
            masks &= np.bitwise_and.reduce(slices[positions(self.hashes[live], level, bits)], axis=1)
            some = masks.any(axis=1)
            live, masks, level = live[some], masks[some], level + 1
            levels[live] += np.unpackbits(masks, axis=1, count=n, bitorder="little")
        term, doc = np.nonzero(present)
        tf = np.minimum((np.int64(1) << np.minimum(levels[term, doc], 62)) - 1, most[doc])
        impact = np.zeros(present.shape)
        impact[term, doc] = (1_000_000_000 * tf) // (1000 * tf + 8 * length[doc])
        for k, rows, weights, exact in zip(self.own, self.rows, self.weights, self.exact):
            bound = weights @ impact[rows]
            yield k, bound if exact else bound * (1 + 2.0**-40) + 1


def _bounded(index: DataFrame, queries: Broadcast, take, schema: str) -> DataFrame:
    """``take(ids, keys, bounds by query)`` sees each block; what it yields at the end of a task becomes rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: Queries = queries.value
        chunks = [Prepared(own, *c) for c in own.chunks()]
        keep = take()
        for batch in batches:
            for row in range(batch.num_rows):
                bits, ids, keys, sizes, most, slices = (batch.column(c)[row].as_py() for c in range(6))
                ids = np.array([_LAST if i is None else i for i in ids], np.int64)
                length = np.array([own.length(n) for n in sizes], np.int64)
                grid = np.frombuffer(slices, np.uint8).reshape(bits, -1)
                found = (b for c in chunks for b in c.bounds(grid, len(ids), length, np.array(most, np.int64)))
                yield from keep.block(ids, np.array(keys, np.int64), found)
        yield from keep.end()

    return index.mapInArrow(run, schema)


class _Best:
    """The documents of the highest bounds of each query."""

    schema = "query bigint, doc_id bigint, key bigint, bound double"

    def __init__(self, top: int):
        self.top, self.best = top, {}

    def block(self, ids, keys, found):
        for k, bound in found:
            some = np.flatnonzero(bound > 0)
            if len(some) > self.top:
                some = some[np.lexsort((ids[some], -bound[some]))[: self.top]]
            rows = [(-float(bound[d]), int(ids[d]), int(keys[d])) for d in some]
            self.best[k] = heapq.nsmallest(self.top, self.best.get(k, []) + rows)
        return ()

    def end(self):
        rows = [(k, d, key, -b) for k, best in self.best.items() for b, d, key in best]
        columns = list(zip(*rows)) or [()] * 4
        arrays = [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.float64()))]
        yield pa.RecordBatch.from_arrays(arrays, ["query", "doc_id", "key", "bound"])


class _Reaching:
    """The documents whose bound reaches a query's least result, with those queries."""

    schema = "doc_id bigint, key bigint, queries array<bigint>"

    def __init__(self, least: dict[int, tuple[int, int]]):
        self.least = least

    def block(self, ids, keys, found):
        own: dict[int, list[int]] = {}
        for k, bound in found:
            score, last = self.least.get(k, (0, _LAST))
            # an equal bound can only rank by its id
            for d in np.flatnonzero((bound > 0) & ((bound > score) | ((bound == score) & (ids <= last)))).tolist():
                own.setdefault(d, []).append(k)
        at = list(own)
        arrays = [pa.array(ids[at]), pa.array(keys[at]), pa.array(list(own.values()), pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "key", "queries"])

    def end(self):
        return ()


def _scored(documents: DataFrame, candidates: DataFrame, queries: Broadcast, top: int) -> DataFrame:
    """(query, doc_id, score): exact scores of the candidates on their whole texts, the best of each task."""
    texts = _texts(documents).withColumn("place", F.coalesce("doc_id", F.lit(_LAST)))
    wanted = candidates.select(F.col("doc_id").alias("place"), "key", "queries")
    rows = texts.join(wanted, ["place", "key"]).select("place", "text", "queries")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: Queries = queries.value
        best: dict[int, list] = {}
        for batch in batches:
            asked = batch.column(2).to_pylist()
            for doc, data, numbers in zip(batch.column(0).to_pylist(), utf8(batch.column(1)), asked):
                tokens = words(data)
                found, size = Counter(tokens), 8 * own.length(len(tokens))
                for k in numbers:
                    score = 0
                    for t in own.items[k][1]:
                        if tf := found.get(t):
                            score += own.weights[t] * (1_000_000_000 * tf // (1000 * tf + size))
                    if score:
                        kept = best.setdefault(k, [])
                        # the heap's least is the worst: lowest score, then largest id
                        (heapq.heappush if len(kept) < top else heapq.heappushpop)(kept, (score, -doc))
        rows = [(k, -d, s) for k, kept in best.items() for s, d in kept]
        columns = list(zip(*rows)) or [()] * 3
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["query", "place", "score"])

    found = rows.mapInArrow(run, "query bigint, place bigint, score bigint")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "place")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def search(documents: DataFrame, items: DataFrame, top: int = TOP, index: DataFrame | None = None) -> DataFrame:
    """(item_id, rank, doc_id, score): each query's ``top`` documents of the highest scores above 0."""
    spark = documents.sparkSession
    index = build(documents) if index is None else index
    out = spark.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    for block in _blocks(items):
        own = _statistics(documents, block)
        queries = spark.sparkContext.broadcast(own)
        # more than the results asked for, as a few of the highest bounds may be false
        best = _bounded(index, queries, lambda: _Best(3 * top), _Best.schema)
        order = Window.partitionBy("query").orderBy(F.desc("bound"), "doc_id", "key")
        best = best.withColumn("place", F.row_number().over(order)).where(F.col("place") <= 3 * top)
        first = best.groupBy("doc_id", "key").agg(F.collect_set("query").alias("queries"))
        # at most 3 * top rows a query of the block
        rows = _scored(documents, F.broadcast(first), queries, top).where(F.col("rank") == top).collect()
        least = {r["query"]: (r["score"], r["place"]) for r in rows}
        reaching = materialize(_bounded(index, queries, lambda least=least: _Reaching(least), _Reaching.schema), "candidates")
        # a document is in one block, but rows of one id and text may be in several
        reaching = reaching.groupBy("doc_id", "key").agg(F.array_distinct(F.flatten(F.collect_list("queries"))).alias("queries"))
        size = reaching.agg(F.count("*").alias("rows"), F.sum(F.size("queries")).alias("numbers")).first()
        if size["rows"] <= BROADCAST_ROWS and (size["numbers"] or 0) <= 10 * BROADCAST_ROWS:
            reaching = F.broadcast(reaching)
        ranked = _scored(documents, reaching, queries, top)
        names = spark.createDataFrame([(k, i) for k, (i, _) in enumerate(block)], "query bigint, item_id bigint")
        ranked = ranked.join(F.broadcast(names), "query").select(
            "item_id", "rank", F.when(F.col("place") < _LAST, F.col("place")).alias("doc_id"), "score"
        )
        out = out.unionByName(materialize(ranked, "ranked"))
    return out
