"""Best-fit packing of token sequences after Martello-Toth dominance reduction.

Lengths are whole numbers up to the capacity, so the packing problem is its histogram: at most one row
per length, whatever the corpus. The reduction fixes bins that provably belong to some best packing and
shrinks the histogram; best-fit decreasing packs what is left. Both work on counts and yield bin
patterns; pieces then take their places by their rank among the pieces of their length, which every
task counts for itself and one small shuffle makes global.

Odd input: null or empty text is its end id alone; repeated rows and ids are packed each; other columns
are ignored. A piece is never longer than the capacity.
"""

from __future__ import annotations

import bisect
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lendlens.llm.common import load_tokenizer, utf8
from lendlens.session import materialize

CAPACITY = 4096
END_ID = 1
CACHE = 400_000


class _Seen(dict):
    """Ids of chunks; notes the chunks that were asked for and are not held."""

    def __init__(self):
        self.unseen: set[bytes] = set()

    def __missing__(self, chunk: bytes) -> bytes:
        self.unseen.add(chunk)
        return b""


class WordEncoder:
    """Ids of whole texts for a tokenizer that lower-cases, drops white space and never joins across a space.

    A text's ids are those of its chunks in order: words without the punctuation that follows them. An
    ASCII letter before ASCII punctuation always ends a word, so cutting there changes nothing; only the
    special strings span such a place, and texts that may hold one are cut at white space alone. The library
    encodes each chunk once while it stays in a bounded cache.
    """

    def __init__(self, path: str):
        self.tokenizer = load_tokenizer(path)
        vocabulary = self.tokenizer.get_vocab()
        mark = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        self.is_end = np.zeros(max(vocabulary.values()) + 1, bool)
        self.is_end[[i for t, i in vocabulary.items() if mark and t.endswith(mark)]] = True
        self.cache = _Seen()

    def ids(self, data: bytes) -> np.ndarray:
        chunks = data.split() if b"<|" in data else _WORD_END.sub(b" ", data.lower()).split()
        coded = list(map(self.cache.__getitem__, chunks))
        if new := self.cache.unseen:
            if len(self.cache) + len(new) > CACHE:
                self.cache.clear()
                new = set(chunks)
            self._learn(list(new))
            self.cache.unseen = set()
            coded = map(self.cache.__getitem__, chunks)
        return np.frombuffer(b"".join(coded), np.uint32)

    def _learn(self, chunks: list[bytes]) -> None:
        texts = [c.decode() for c in chunks]
        words = [k for k, t in enumerate(texts) if t.isalpha()]
        # words are encoded together; each has one end mark if there are as many marks as words
        ids = self._coded([" ".join([texts[k] for k in words])])[0]
        ends = np.flatnonzero(self.is_end[ids]) + 1
        if len(ends) == len(words):
            ends, joined = (4 * ends).tolist(), ids.tobytes()
            self.cache.update((chunks[k], joined[a:b]) for k, a, b in zip(words, [0, *ends], ends))
            rest = [k for k, t in enumerate(texts) if not t.isalpha()]
        else:
            rest = range(len(chunks))
        self.cache.update((chunks[k], x.tobytes()) for k, x in zip(rest, self._coded([texts[k] for k in rest])))

    def _coded(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


_WORD_END = re.compile(rb"(?<=[a-z])(?=[!-/:-@\[-`{-~])")


def pieces(documents: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, part, nth): ``nth`` counts pieces of a length in a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder(tokenizer)  # given up with the task: workers outlive it
        part, seen = TaskContext.get().partitionId(), Counter()
        for batch in batches:
            rows = []
            for doc, data in zip(batch.column(0).to_pylist(), utf8(batch.column(1))):
                ids = np.append(encoder.ids(data), np.uint32(END_ID)).astype("<u4")
                for k, start in enumerate(range(0, len(ids), capacity)):
                    cut = ids[start : start + capacity]
                    rows.append((doc, k, start, len(cut), zlib.crc32(cut.tobytes()), part, seen[len(cut)]))
                    seen[len(cut)] += 1
            columns = list(zip(*rows)) or [()] * 7
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], NAMES)

    kind = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, part int, nth bigint"
    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, kind)


NAMES = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth"]


def reduce_by_dominance(counts: dict[int, int], capacity: int) -> tuple[list[tuple[tuple, int]], dict[int, int]]:
    """Fixed bins as (sizes, how many), and the counts that stay.

    For a size x, y is the largest other item that fits beside it. {x} is fixed if nothing fits; {x, y}
    if it fills the bin, if no two further items fit beside x, or if no three fit and no two that fit
    are together longer than y: every bin with x can then be exchanged for {x, y}. Removing items keeps
    these conditions, so as many bins are fixed at once as the counts allow.
    """
    left = {s: n for s, n in counts.items() if n > 0}
    fixed: list[tuple[tuple, int]] = []
    changed = True
    while changed:
        changed = False
        for x in sorted(left, reverse=True):
            while left.get(x, 0) > 0:
                left[x] -= 1  # the item itself is not its own neighbour
                sizes = sorted(s for s, n in left.items() if n > 0)
                left[x] += 1
                room = capacity - x
                fit = bisect.bisect_right(sizes, room)
                if fit == 0:
                    fixed.append(((x,), left[x] if x + x > capacity else 1))
                    take = {x: fixed[-1][1]}
                else:
                    y = sizes[fit - 1]
                    if not (y == room or _pairs_dominated(x, y, sizes, left, room)):
                        break
                    times = left[x] // 2 if x == y else min(left[x], left[y])
                    fixed.append(((x, y), times))
                    take = {x: 2 * times} if x == y else {x: times, y: times}
                changed = True
                for s, n in take.items():
                    left[s] -= n
                    if not left[s]:
                        del left[s]
    return fixed, left


def _pairs_dominated(x: int, y: int, sizes: list[int], left: dict[int, int], room: int) -> bool:
    small: list[int] = []
    for s in sizes:
        small += [s] * min(3, left[s] - (s == x))
        if len(small) >= 3:
            break
    if len(small) < 2 or small[0] + small[1] > room:
        return True
    if len(small) > 2 and sum(small[:3]) <= room:
        return False
    a = np.array([s for s in sizes if s <= room])
    partner = np.searchsorted(a, room - a, side="right") - 1
    single = np.array([left[s] - (s == x) < 2 for s in a.tolist()])
    partner = np.where((partner == np.arange(len(a))) & single, partner - 1, partner)
    good = partner >= 0
    return int((a[good] + a[partner[good]]).max(initial=0)) <= y


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[tuple, int]]:
    """Best-fit decreasing on counts: bins of one content are handled together."""
    open_bins: dict[int, list[tuple[tuple, int]]] = {}
    rooms: list[int] = []

    def put(room: int, content: tuple, n: int) -> None:
        if room not in open_bins:
            bisect.insort(rooms, room)
            open_bins[room] = []
        open_bins[room].append((content, n))

    for size in sorted(counts, reverse=True):
        todo = counts[size]
        while todo:
            at = bisect.bisect_left(rooms, size)
            if at < len(rooms):
                room = rooms[at]
                content, bins = open_bins[room].pop()
                if not open_bins[room]:
                    del open_bins[room], rooms[at]
            else:
                room, content, bins = capacity, (), todo
            each = min(room // size, todo)
            full = min(bins, todo // each)
            put(room - each * size, (*content, *[size] * each), full)
            if bins > full and content:
                put(room, content, bins - full)
            todo -= each * full
    return [x for same in open_bins.values() for x in same]


def places(counts: dict[int, int], capacity: int) -> np.ndarray:
    """Rows (length, first rank, first sequence, pieces a sequence, first offset), sorted."""
    fixed, rest = reduce_by_dominance(counts, capacity)
    rows, used, sequence = [], Counter(), 0
    for content, times in fixed + best_fit(rest, capacity):
        offset = 0
        for size in sorted(set(content), reverse=True):
            each = content.count(size)
            rows.append((size, used[size], sequence, each, offset))
            used[size] += each * times
            offset += each * size
        sequence += times
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)


def pack(documents: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """Every piece with its sequence and its place there."""
    cut = materialize(pieces(documents, tokenizer, capacity), "pieces")
    per_task = materialize(cut.groupBy("part", "length").agg(F.count("*").alias("n")), "lengths")
    # at most one row per length reaches the driver
    histogram = {r["length"]: r["n"] for r in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    table = cut.sparkSession.sparkContext.broadcast(places(histogram, capacity))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_task.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    ranked = cut.join(offsets, ["part", "length"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("nth")).alias("nth")
    )
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = table.value
        first = (rows[:, 0] << 50) + rows[:, 1]
        for batch in batches:
            length, nth = (batch.column(c).to_numpy() for c in ("length", "nth"))
            size, start, sequence, each, offset = rows[np.searchsorted(first, (length << 50) + nth, side="right") - 1].T
            own = nth - start
            values = [*batch.columns[:5], pa.array(sequence + own // each), pa.array(offset + own % each * size)]
            yield pa.RecordBatch.from_arrays(values, names)

    kind = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint"
    return ranked.mapInArrow(run, kind)
