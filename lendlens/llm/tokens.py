"""Token counts, with overlap resynchronisation for huge documents.

A text of up to ``CHUNK`` characters is counted whole. A longer one is cut into overlapping chunks that
different tasks encode with offsets. Two neighbours are spliced at a pre-token boundary that both have
inside their overlap, away from the left one's end: pre-tokens are found from left to right and never
span such a boundary, so what follows it is the same in both, and what precedes it in the left one is
the whole text's own encoding. Where neighbours share no boundary, the document is cut again with wider
chunks and overlaps, at last into one chunk, which is the library's own answer.

Odd input: null is empty and has no tokens; repeated rows are kept; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendlens.llm.common import load_tokenizer
from lendlens.session import materialize

CHUNK = 65_536
OVERLAP = 1_024
LIMIT = 512
#: Characters before a chunk's end that a boundary stays away from: longer than any special token,
#: contraction or look-ahead of the pre-tokenizer.
MARGIN = 32
CACHE = 400_000

# a byte-level pre-token never ends between a space and what follows, and always ends before such a space
_WORD_START = re.compile(r"(?<=\S) (?=\S)")


class Counter:
    """Counts by a byte-level BPE tokenizer; counts of words with their space stay in a bounded cache."""

    def __init__(self, path: str):
        from tokenizers import pre_tokenizers, processors

        self.tokenizer = load_tokenizer(path)
        if not isinstance(self.tokenizer.pre_tokenizer, pre_tokenizers.ByteLevel) or self.tokenizer.normalizer:
            raise ValueError("a byte-level tokenizer without a normalizer is needed")
        self.tokenizer.post_processor = processors.ByteLevel(trim_offsets=False)
        self.cache: dict[str, int] = {}

    def count(self, text: str) -> int:
        if not text:
            return 0
        first, *rest = _WORD_START.split(text)
        new = [w for w in set(rest) if w not in self.cache]
        if new:
            if len(self.cache) + len(new) > CACHE:
                self.cache.clear()
                new = list(set(rest))
            coded = self.tokenizer.encode_batch_fast([" " + w for w in new], add_special_tokens=False)
            self.cache.update((w, len(e.ids)) for w, e in zip(new, coded))
        own = len(self.tokenizer.encode_batch_fast([first], add_special_tokens=False)[0].ids)
        return own + sum(map(self.cache.__getitem__, rest))

    def boundaries(self, text: str, start: int, end: int) -> tuple[int, list[int], list[int]]:
        """Number of tokens, and pre-token starts in [start, end) with the tokens before each."""
        coded = self.tokenizer.encode(text, add_special_tokens=False)
        at, before, last = [], [], None
        for k, (word, (a, _)) in enumerate(zip(coded.word_ids, coded.offsets)):
            if word != last:
                last = word
                if start <= a < end:
                    at.append(a)
                    before.append(k)
        return len(coded.ids), at, before


def _cut(huge: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """(row, k, last, body): overlapping chunks of (row, text), spread over the tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["row", "k", "last", "body"]
        for batch in batches:
            for row, text in zip(batch.column("row").to_pylist(), batch.column("text")):
                text = text.as_py()
                starts = range(0, max(1, len(text) - overlap), chunk)
                for k, a in enumerate(starts):
                    values = [[row], [k], [k == len(starts) - 1], [text[a : a + chunk + overlap]]]
                    types = [pa.int64(), pa.int32(), pa.bool_(), pa.string()]
                    yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, types)], names)

    cut = huge.select("row", "text").mapInArrow(run, "row bigint, k int, last boolean, body string")
    return cut.repartition(F.xxhash64("row", "k"))


def _encoded(chunks: DataFrame, tokenizer: str, chunk: int, overlap: int) -> DataFrame:
    """(row, seam, side, n, at, before): each chunk's count, and its boundaries at either seam."""
    names = ["row", "seam", "side", "n", "at", "before"]
    types = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(tokenizer)
        for batch in batches:
            rows = []
            for row, k, last, body in zip(*(batch.column(c).to_pylist() for c in ("row", "k", "last", "body"))):
                n, at, before = counter.boundaries(body, 0, len(body))
                if k:  # right side of the seam before it; offsets count from the overlap's start
                    own = [(a, b) for a, b in zip(at, before) if a < overlap - MARGIN]
                    rows.append((row, k - 1, 1, 0, [a for a, _ in own], [b for _, b in own]))
                own = [] if last else [(a - chunk, b) for a, b in zip(at, before) if chunk <= a < chunk + overlap - MARGIN]
                rows.append((row, -1 - k if last else k, 0, n, [a for a, _ in own], [b for _, b in own]))
            columns = list(zip(*rows)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    kind = "row bigint, seam int, side int, n bigint, at array<bigint>, before array<bigint>"
    return chunks.mapInArrow(run, kind)


def _spliced(encoded: DataFrame) -> DataFrame:
    """(row, n_tokens, aligned): counts of the chunks less what each seam holds twice."""
    left, right = F.col("side") == 0, F.col("side") == 1
    seams = encoded.groupBy("row", "seam").agg(
        F.max("n").alias("n"),
        F.max(F.when(left, F.struct("at", "before"))).alias("a"),
        F.max(F.when(right, F.struct("at", "before"))).alias("b"),
    )
    place = F.array_min(F.array_intersect("a.at", "b.at"))
    inside = F.col("seam") >= 0
    before = lambda side: F.element_at(f"{side}.before", F.array_position(f"{side}.at", F.col("place")).cast("int"))
    seams = seams.withColumn("place", place)
    kept = F.when(inside & F.col("place").isNotNull(), before("a") - before("b")).otherwise(F.col("n"))
    fine = ~inside | F.col("place").isNotNull()
    return seams.groupBy("row").agg(F.sum(kept).alias("n_tokens"), F.min(fine).alias("aligned"))


def count_tokens(documents: DataFrame, tokenizer: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """(doc_id, n_bytes, n_tokens) of every row."""
    own = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    long = F.char_length("text") > chunk + overlap

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(tokenizer)
        for batch in batches:
            counts = [counter.count(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(counts, pa.int64())], NAMES)

    sized = own.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "text")
    short = sized.where(~long).mapInArrow(run, "doc_id bigint, n_bytes bigint, n_tokens bigint")
    huge = sized.where(long)
    # rows of one id and text have one count; the huge ones are told apart by a hash of both
    huge = huge.withColumn("row", F.xxhash64("doc_id", "text"))
    done = None
    todo = materialize(huge.select("row", "text").dropDuplicates(["row"]), "huge")
    while todo.limit(1).count():
        found = materialize(_spliced(_encoded(_cut(todo, chunk, overlap), tokenizer, chunk, overlap)), "spliced")
        good = found.where("aligned").select("row", "n_tokens")
        done = good if done is None else done.unionByName(good)
        todo = materialize(todo.join(found.where("NOT aligned").select("row"), "row"), "wider")
        chunk, overlap = chunk * 4, overlap * 16
    if done is None:
        return short
    return short.unionByName(huge.select("row", "doc_id", "n_bytes").join(done, "row").select(NAMES))


NAMES = ["doc_id", "n_bytes", "n_tokens"]
