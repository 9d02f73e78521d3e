"""Cross-tokenizer alignment with inverted pair bitmaps.

A text is encoded by a byte-level BPE tokenizer (A) and by a sentencepiece model (B). Where tokens of both
end at one byte they are linked, and such ends cut the text into groups. Documents are taken in blocks;
a block inverts its links into postings: for each pair of ids compressed bitmaps of documents, one for
each binary digit of the number of links in a document. The planes OR-merged and counted give a pair's
documents, counted with their weight they give its links. The table of pairs is bounded by the two
vocabularies, whatever the corpus: the shorter of two tokens that end together is a suffix of the longer,
so there are at most as many pairs as the tokens have bytes. Scores of pairs go back to the documents
along the postings.

Both tokenizers cut a text before a single space between other characters, so each such word is encoded
and aligned once a task.

Odd input: null and empty texts, and texts that a tokenizer does not give back byte by byte, have no
tokens and zeros; repeated rows and rows without an id are documents of their own. Other columns are
ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lendlens.llm.common import load_tokenizer, sha256
from lendlens.session import materialize

#: Documents of a block, and postings (a pair in a document) after which it is closed.
BLOCK_DOCS, BLOCK_POSTINGS = 4_096, 1_000_000
#: Aligned words after which a task puts its cache aside; words of the one before are taken over when met again.
CACHE = 150_000
#: Documents whose unknown words are encoded together, and words of one call.
TOGETHER, CALL = 64, 5_000

_WORD = re.compile(r"(?<=\S)(?= \S)")
_SPACE = "▁"


# ---- alignment of a text ----------------------------------------------------------------------------------------


class Aligned(NamedTuple):
    n_a: int
    n_b: int
    groups: str
    pairs: bytes  # a << 32 | b of each link, 64 bits


def _byte_level() -> dict[str, int]:
    """Byte-level BPE writes printable bytes as themselves and the others as the code points from 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Aligner:
    def __init__(self, byte_level: str, pieces: str):
        import sentencepiece

        self.a = load_tokenizer(byte_level)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=pieces)
        coded = _byte_level()
        vocabulary = self.a.get_vocab()
        # a special token stands for no bytes of its own and never comes up
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for entry, i in vocabulary.items():
            self.bytes_a[i] = bytes(coded.get(c, 63) for c in entry)
        names = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(_SPACE, " ").encode() for i, p in enumerate(names)
        ]
        self.sizes_a, self.sizes_b = (np.array([len(t) for t in own]) for own in (self.bytes_a, self.bytes_b))
        # no piece goes on over a space, so words can be encoded apart
        self.apart = not any(re.search(f"[^{_SPACE}]{_SPACE}", p) for p in names)
        self.known: dict[str, Aligned | None] = {}
        self.before: dict[str, Aligned | None] = {}

    def _link(self, words: list[str]) -> list[Aligned] | None:
        """The words, which follow each other, aligned; None if one of them has no tokens of its bytes."""
        text = "".join(words)
        data = text.encode()
        a = self.a.encode_batch_fast([text], add_special_tokens=False)[0].ids
        b = self.b.encode(text[1:])  # B adds the first space
        if b"".join(map(self.bytes_a.__getitem__, a)) != data or b"".join(map(self.bytes_b.__getitem__, b)) != data:
            return None
        a, b = np.array(a, np.int64), np.array(b, np.int64)
        ends_a, ends_b = np.cumsum(self.sizes_a[a]), np.cumsum(self.sizes_b[b])
        ends = np.intersect1d(ends_a, ends_b, assume_unique=True)
        last_a, last_b = np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends)
        word_ends = np.cumsum([len(w.encode()) for w in words])
        if not np.isin(word_ends, ends, assume_unique=True).all():
            return None
        # tokens by group, those of A first; what follows a token tells if its group or its word ends
        marks_a, marks_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        marks_a[last_a], marks_b[last_b] = 1, 2
        marks_b[np.searchsorted(ends_b, word_ends)] = 3
        group = np.concatenate([2 * np.searchsorted(ends, ends_a), 2 * np.searchsorted(ends, ends_b) + 1])
        order = np.argsort(group, kind="stable")
        parts = [""] * (2 * len(order))
        parts[::2] = map(str, np.concatenate([a, b])[order].tolist())
        parts[1::2] = map(",|;\n".__getitem__, np.concatenate([marks_a, marks_b])[order].tolist())
        groups = "".join(parts).split("\n")
        pairs = (a[last_a] << 32 | b[last_b]).tobytes()
        counts = [np.diff(np.searchsorted(e, word_ends, "right"), prepend=0).tolist() for e in (ends_a, ends_b)]
        cuts = [0, *(8 * np.searchsorted(ends, word_ends, "right")).tolist()]
        return [Aligned(x, y, g, pairs[i:j]) for x, y, g, i, j in zip(*counts, groups, cuts, cuts[1:])]

    def _learn(self, words: list[str]) -> None:
        # a word that ends with white space would join the next one's
        alone = [[w] for w in words if w[-1].isspace()]
        others = [w for w in words if not w[-1].isspace()]
        for call in [others[k : k + CALL] for k in range(0, len(others), CALL)] + alone:
            found = self._link(call)
            if found is None:
                found = [(self._link([w]) or [None])[0] for w in call]
            self.known.update(zip(call, found))

    def align(self, texts: list[str]) -> list[list[Aligned] | None]:
        """Each text's words aligned, or None where it has no tokens."""
        split = []
        for text in texts:
            if not text or _SPACE in text:
                split.append([])
            else:
                split.append(_WORD.split(" " + text) if self.apart else [" " + text])
        if len(self.known) > CACHE:
            self.known, self.before = {}, self.known
        new = set(chain.from_iterable(split)).difference(self.known)
        again = {w: self.before[w] for w in new if w in self.before}
        self.known.update(again)
        self._learn(list(new.difference(again)))
        out = []
        for own in split:
            found = list(map(self.known.__getitem__, own))
            out.append(None if not found or None in found else found)
        return out


# ---- compressed bitmaps of the documents of a block -------------------------------------------------------------


def packed(places: np.ndarray) -> bytes:
    """Ascending places as a list of 16-bit numbers, or as bits where that is shorter."""
    if 2 * len(places) <= BLOCK_DOCS // 8:
        return b"\0" + places.astype("<u2").tobytes()
    bits = np.zeros(BLOCK_DOCS, np.uint8)
    bits[places] = 1
    return b"\1" + np.packbits(bits, bitorder="little").tobytes()


def places(bitmap: bytes) -> np.ndarray:
    if bitmap[0] == 0:
        return np.frombuffer(bitmap, "<u2", offset=1)
    return np.flatnonzero(np.unpackbits(np.frombuffer(bitmap, np.uint8, offset=1), bitorder="little"))


def popcount(bitmap: bytes) -> int:
    return (len(bitmap) - 1) // 2 if bitmap[0] == 0 else int.from_bytes(bitmap[1:]).bit_count()


def merged(bitmaps: list[bytes]) -> bytes:
    """Their OR."""
    if len(bitmaps) == 1:
        return bitmaps[0]
    bits = np.zeros(BLOCK_DOCS, bool)
    for b in bitmaps:
        bits[places(b)] = True
    return packed(np.flatnonzero(bits))


def planes(where: np.ndarray, times: np.ndarray) -> list[bytes]:
    """A bitmap for each binary digit of the times."""
    return [packed(where[(times >> p) & 1 == 1]) for p in range(int(times.max()).bit_length())]


# ---- the job ----------------------------------------------------------------------------------------------------

_DOCS = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string"
_INVERTED = f"block bigint, place int, {_DOCS}, a bigint, b bigint, planes array<binary>"


def invert(documents: DataFrame, byte_level: str, pieces: str) -> DataFrame:
    """A row per document, with its block and its place there, and a row per pair and block (``a`` not null)."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    kinds = _parse_datatype_string(_INVERTED)
    names = kinds.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = to_arrow_schema(kinds)
        aligner = Aligner(byte_level, pieces)
        block = TaskContext.get().partitionId() << 32
        keys, times, rows, postings = [], [], [], 0

        def out(columns: dict) -> pa.RecordBatch:
            n = len(columns["block"])
            arrays = [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in schema]
            return pa.RecordBatch.from_arrays(arrays, names)

        def close() -> Iterator[pa.RecordBatch]:
            own = dict(zip(names[2:8], zip(*rows)))
            yield out({"block": [block] * len(rows), "place": range(len(rows))} | own)
            pair, count = np.concatenate(keys), np.concatenate(times)
            where = np.repeat(np.arange(len(rows)), [len(k) for k in keys])
            order = np.argsort(pair, kind="stable")
            pair, count, where = pair[order], count[order], where[order]
            cuts = np.flatnonzero(np.diff(pair)) + 1
            starts = [0, *cuts.tolist()] if len(pair) else []
            ends = [*cuts.tolist(), len(pair)]
            for k in range(0, len(starts), 10_000):
                some = list(zip(starts[k : k + 10_000], ends[k : k + 10_000]))
                ids = pair[starts[k : k + 10_000]]
                yield out({
                    "block": [block] * len(some),
                    "a": ids >> 32,
                    "b": ids & 0xFFFFFFFF,
                    "planes": [planes(where[s:e], count[s:e]) for s, e in some],
                })

        for batch in batches:
            for start in range(0, batch.num_rows, TOGETHER):
                some = batch.slice(start, TOGETHER)
                for doc, words in zip(some.column(0).to_pylist(), aligner.align(some.column(1).to_pylist())):
                    links = np.frombuffer(b"".join(w.pairs for w in words or ()), np.int64)
                    pairs, count = np.unique(links, return_counts=True)
                    groups = sha256(";".join(w.groups for w in words)) if words else ""
                    n_a, n_b = (sum(w[k] for w in words or ()) for k in (0, 1))
                    rows.append((doc, n_a, n_b, len(links), len(links), groups))
                    keys.append(pairs)
                    times.append(count)
                    postings += len(pairs)
                    if len(rows) == BLOCK_DOCS or postings >= BLOCK_POSTINGS:
                        yield from close()
                        keys, times, rows, postings, block = [], [], [], 0, block + 1
        if rows:
            yield from close()

    own = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return materialize(own.mapInArrow(run, kinds), "postings")


def pair_counts(inverted: DataFrame) -> DataFrame:
    """(a, b, documents, links, best): counts of each pair of ids; best where no pair of its ``b`` has more links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        documents: Counter = Counter()
        links: Counter = Counter()
        for batch in batches:
            for a, b, own in zip(*(batch.column(c).to_pylist() for c in range(3))):
                documents[a, b] += popcount(merged(own))
                links[a, b] += sum(popcount(p) << k for k, p in enumerate(own))
        # at most as many rows as the vocabularies allow pairs
        ids = list(links)
        for k in range(0, len(ids), 50_000):
            some = ids[k : k + 50_000]
            columns = [[a for a, _ in some], [b for _, b in some], [documents[i] for i in some], [links[i] for i in some]]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["a", "b", "documents", "links"])

    kind = "a bigint, b bigint, documents bigint, links bigint"
    partial = inverted.where("a IS NOT NULL").select("a", "b", "planes").mapInArrow(run, kind)
    counts = partial.groupBy("a", "b").agg(F.sum("documents").alias("documents"), F.sum("links").alias("links"))
    highest = F.max("links").over(Window.partitionBy("b"))
    return counts.select("a", "b", "documents", "links", (F.col("links") == highest).alias("best"))


def scored(inverted: DataFrame, counts: DataFrame) -> DataFrame:
    """The documents with ``n_best`` and ``count_sum``: the counts of pairs handed back along the postings."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}

        def out(block: int) -> pa.RecordBatch:
            own = sums.pop(block)
            at = np.flatnonzero(own[1])
            columns = [np.full(len(at), block), at.astype(np.int32), own[0][at], own[1][at]]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["block", "place", "n_best", "count_sum"])

        for batch in batches:
            for block, links, best, own in zip(*(batch.column(c).to_pylist() for c in range(4))):
                if block not in sums:
                    for other in list(sums):  # rows of a block lie together
                        yield out(other)
                    sums[block] = np.zeros((2, BLOCK_DOCS), np.int64)
                for k, plane in enumerate(own):
                    where = places(plane)
                    sums[block][1][where] += links << k
                    if best:
                        sums[block][0][where] += 1 << k
        for block in list(sums):
            yield out(block)

    postings = inverted.where("a IS NOT NULL").select("block", "a", "b", "planes")
    # bounded by the vocabularies: at most one pair a byte of their tokens
    joined = postings.join(F.broadcast(counts), ["a", "b"]).select("block", "links", "best", "planes")
    parts = joined.mapInArrow(run, "block bigint, place int, n_best bigint, count_sum bigint")
    totals = parts.groupBy("block", "place").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    documents = inverted.where("a IS NULL").select("block", "place", *[c.split()[0] for c in _DOCS.split(", ")])
    return documents.join(totals, ["block", "place"], "left").select(
        *[c.split()[0] for c in _DOCS.split(", ")],
        F.coalesce("n_best", F.lit(0)).alias("n_best"),
        F.coalesce("count_sum", F.lit(0)).alias("count_sum"),
    )


def align(documents: DataFrame, byte_level: str, pieces: str) -> DataFrame:
    """One row per document: tokens, groups and links, and how its links fare over the corpus."""
    inverted = invert(documents, byte_level, pieces)
    return scored(inverted, materialize(pair_counts(inverted), "pairs"))
