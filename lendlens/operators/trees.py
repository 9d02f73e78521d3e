"""Tree ensembles grown from sums that do not depend on how the rows are partitioned.

Each pass over the train rows walks the trees grown so far and adds up small whole numbers for the nodes
that wait for a split: hashed bag weights and labels for a forest, gradients and curvatures rounded to a
fixed step for boosting. Whole numbers give the same sum in any order, and every draw is a hash of what
it is drawn for, so the same rows give the same trees on 1 or 1,000 partitions. Tasks send the sums that
are not 0; they are added up in Spark, and the driver sees one table of sums per pass, whose size the
number of nodes, features and bins bounds.

* ``Forest``: bags drawn by a hash of (row, tree), a hashed choice of features per node, all trees grown
  side by side. With ``random_cuts`` the rows are not drawn, and the cut of a feature is drawn by a hash of
  (tree, node, feature) between the least and greatest value in the node.
* ``Boosting``: logistic loss, best-gain leaf first up to ``leaves`` leaves and ``depth``, leaf values by one
  Newton step. Of two siblings the smaller is summed, the other is its parent less that. Leaves are split
  ahead of their turn, as many as may still be needed, so that a tree takes about as many passes as it is
  deep; the tree is the one that splitting one leaf at a time gives. A node whose rows take no more than
  ``NODE_BYTES`` goes to one task that splits it as far as may be needed, from the same sums.

Rows come with a key, a label of 0 or 1 and an array of numbers. An empty table gives a model of one leaf.
"""

from __future__ import annotations

import heapq
import json
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lendlens.session import discard, materialize

#: Rows, chosen by a hash of the key, whose values give the bin limits.
SAMPLE = 20_000
#: Bytes of sums held by a task, and cells sent as one row.
SUM_BYTES, PART = 64 * 1024 * 1024, 65_536
#: With more tasks, or more bytes of sums over all tasks, sums are added up by a shuffle before the driver sees them.
DIRECT, DIRECT_BYTES = 16, 32 * 1024 * 1024
#: Rows that are summed at once, and weights and labels that share one sum: both parts stay whole.
CHUNK, SHARED = 65_536, 2.0**26
#: Bytes of a node's rows up to which one task finishes the node.
NODE_BYTES = 16 * 1024 * 1024
#: Bytes of train rows in a task at most, rows that are worth a task, and rounds after which scores are written
#: to the rows.
TASK_BYTES, TASK_ROWS, REFRESH = 64 * 1024 * 1024, 4_096, 10
#: Bytes of train rows that are one row of a table, about: a pass pays by the byte and not by the row.
BLOCK_BYTES = 16 * 1024 * 1024
#: How tables are written that every pass reads.
READ_OFTEN = {"compression": "snappy"}


def hashed(*parts: np.ndarray | int) -> np.ndarray:
    """64-bit hashes of tuples of whole numbers (SplitMix64, part by part)."""
    out = np.uint64(0)
    with np.errstate(over="ignore"):
        for part in parts:
            x = np.asarray(part).astype(np.int64).view(np.uint64) + out * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0x9E3779B97F4A7C15)
            x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            out = x ^ (x >> np.uint64(31))
    return out


def uniform(*parts: np.ndarray | int) -> np.ndarray:
    """Numbers in [0, 1)."""
    return (hashed(*parts) >> np.uint64(11)).astype(float) / 2.0**53


# the distribution of a row's weight in a bag of as many draws as rows
_POISSON = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(16)])


def bag(keys: np.ndarray, tree: int, seed: int) -> np.ndarray:
    return np.searchsorted(_POISSON, uniform(keys, tree, seed), side="right")


# ---- trees ------------------------------------------------------------------------------------------------------


@dataclass
class Tree:
    """Nodes by number; ``x[feature] <= cut`` goes left. A leaf has the feature -1."""

    feature: list[int] = field(default_factory=lambda: [-1])
    cut: list[float] = field(default_factory=lambda: [0.0])
    left: list[int] = field(default_factory=lambda: [-1])
    right: list[int] = field(default_factory=lambda: [-1])
    value: list[float] = field(default_factory=lambda: [0.0])
    depth: list[int] = field(default_factory=lambda: [0])

    def split(self, node: int, feature: int, cut: float) -> tuple[int, int]:
        new = len(self.feature)
        self.feature[node], self.cut[node], self.left[node], self.right[node] = feature, cut, new, new + 1
        for _ in range(2):
            self.feature.append(-1)
            self.cut.append(0.0)
            self.left.append(-1)
            self.right.append(-1)
            self.value.append(0.0)
            self.depth.append(self.depth[node] + 1)
        return new, new + 1

    def walker(self) -> Callable[[np.ndarray], np.ndarray]:
        """The leaf of each row of a matrix, as a function: the tree is read once."""
        feature, cut = np.array(self.feature), np.array(self.cut)
        leaf, own = feature < 0, np.arange(len(feature))
        # a leaf leads to itself
        child = np.column_stack([np.where(leaf, own, self.right), np.where(leaf, own, self.left)]).ravel()
        feature, steps = np.where(leaf, 0, feature), max(self.depth) - self.depth[0]

        def walk(x: np.ndarray) -> np.ndarray:
            nodes = np.zeros(len(x), np.int64)
            if not steps:
                return nodes
            cells = np.ascontiguousarray(x).reshape(-1)
            rows, begin, at = None, np.arange(len(x)) * x.shape[1], nodes
            for step in range(steps):
                if step and step % 4 == 0:  # rows that have come to a leaf are left out
                    rows = np.arange(len(x)) if rows is None else rows
                    nodes[rows] = at
                    inner = ~leaf[at]
                    rows, begin, at = rows[inner], begin[inner], at[inner]
                at = child[2 * at + (cells[begin + feature[at]] <= cut[at])]
            if rows is None:
                return at
            nodes[rows] = at
            return nodes

        return walk

    def walk(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row of ``x``."""
        return self.walker()(x)

    def values(self, x: np.ndarray) -> np.ndarray:
        return np.array(self.value)[self.walk(x)]


@dataclass
class TreeModel:
    """``sum``: probability from ``base`` plus the leaves' values; else their mean."""

    trees: list[Tree]
    sum: bool = False
    base: float = 0.0

    def probability(self, x: np.ndarray) -> np.ndarray:
        if self.sum:
            raw = self.base + np.sum([t.values(x) for t in self.trees], axis=0) if self.trees else np.full(len(x), self.base)
            return 1 / (1 + np.exp(-raw))
        return np.mean([t.values(x) for t in self.trees], axis=0)

    def score(self, vec: Column) -> Column:
        """Probability of class 1 for an array column."""

        @F.pandas_udf("double")
        def run(rows):
            import pandas as pd

            return pd.Series(self.probability(np.array(rows.tolist(), float).reshape(len(rows), -1)))

        return run(vec)

    def save(self, spark: SparkSession, path: str) -> None:
        names = ("feature", "cut", "left", "right", "value", "depth")
        rows = [(i, n, *(getattr(t, c)[n] for c in names)) for i, t in enumerate(self.trees) for n in range(len(t.feature))]
        kind = "tree int, node int, feature int, cut double, left int, right int, value double, depth int"
        spark.createDataFrame(rows, kind).coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")
        about = spark.createDataFrame([(json.dumps({"sum": self.sum, "base": self.base}),)], "about string")
        about.coalesce(1).write.mode("overwrite").parquet(f"{path}/ensemble")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> TreeModel:
        trees: dict[int, list] = {}
        for r in spark.read.parquet(f"{path}/nodes").orderBy("tree", "node").collect():
            trees.setdefault(r["tree"], []).append(r[2:])
        about = json.loads(spark.read.parquet(f"{path}/ensemble").first()["about"])
        return cls([Tree(*map(list, zip(*rows))) for _, rows in sorted(trees.items())], **about)


# ---- rows -------------------------------------------------------------------------------------------------------


def bin_limits(rows: DataFrame, vec: str, key: str, bins: int, sample: int = SAMPLE) -> list[np.ndarray]:
    """At most ``bins - 1`` ascending cuts of each feature, half-way between values of the sampled rows."""
    n = rows.count()
    share = min(1.0, sample / max(n, 1))
    draw = F.pmod(F.xxhash64(F.lit("bins"), key), F.lit(1 << 30)) < F.lit(math.ceil(share * (1 << 30)))

    def cuts(frame):
        import pandas as pd

        values = np.sort(frame["value"].to_numpy())
        distinct = np.unique(values)
        if len(distinct) > bins:  # limits at equal shares of the rows
            at = np.unique(values[np.arange(1, bins) * len(values) // bins])
            above = distinct[np.minimum(np.searchsorted(distinct, at, "right"), len(distinct) - 1)]
            limits = np.unique((at + above)[at < above] / 2)
        else:
            limits = (distinct[:-1] + distinct[1:]) / 2
        return pd.DataFrame({"pos": [frame["pos"].iloc[0]], "cuts": [limits.tolist()]})

    # a group is one feature of the bounded sample
    cells = rows.where(draw).select(F.posexplode(vec).alias("pos", "value")).repartition("pos")
    found = cells.groupBy("pos").applyInPandas(cuts, "pos int, cuts array<double>").collect()
    return [np.array(r["cuts"]) for r in sorted(found, key=lambda r: r["pos"])]


def _stored(
    rows: DataFrame, vec: str, key: str, label: str, limits: list[np.ndarray] | None, tasks: int, base: float = 0.0
) -> DataFrame:
    """(key, y, raw, x): ``x`` holds a row's bins, or its numbers without limits, as bytes; dealt to the tasks
    where they do not fill them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            x = batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
            if limits is not None:
                x = np.column_stack([np.searchsorted(c, x[:, j]) for j, c in enumerate(limits)]).astype(np.uint8)
            raw = pa.array(np.full(n, base))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), raw, byte_rows(x)], ["key", "y", "raw", "x"])

    own = rows.select(F.xxhash64(key).alias("key"), F.col(label).cast("int").alias("y"), F.col(vec).cast("array<double>").alias("x"))
    packed = own.mapInArrow(run, "key bigint, y int, raw double, x binary")
    # many rows that already lie in enough partitions are not moved
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return packed if tasks > cores and rows.rdd.getNumPartitions() >= 2 * cores else packed.repartition(tasks)


BLOCK = "key binary, y binary, raw binary, x binary"


def _blocks(stored: DataFrame) -> DataFrame:
    """The rows of ``_stored`` as blocks of bytes, written."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _chunks(batches):
            values = [batch.column(c).to_numpy() for c in ("key", "y", "raw")]
            yield _block(*values, matrix(batch.column("x"), np.uint8))

    return materialize(stored.mapInArrow(run, BLOCK), "train", **READ_OFTEN)


def _block(*values: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([np.ascontiguousarray(v).tobytes()], pa.binary()) for v in values], ["key", "y", "raw", "x"])


def unpacked(batches: Iterator[pa.RecordBatch], kinds: dict[str, type]) -> Iterator[list[np.ndarray]]:
    """The named columns of each block; the last one is a matrix."""
    for batch in batches:
        for i in range(batch.num_rows):
            values = [np.frombuffer(batch.column(c)[i].as_buffer(), kind) for c, kind in kinds.items()]
            yield [*values[:-1], values[-1].reshape(len(values[0]), -1)]


def _rows(batches: Iterator[pa.RecordBatch], kind: type) -> Iterator[list[np.ndarray]]:
    return unpacked(batches, {"key": np.int64, "y": np.int32, "raw": np.float64, "x": kind})


def byte_rows(x: np.ndarray) -> pa.Array:
    """The bytes of each row of a matrix."""
    data, n = np.ascontiguousarray(x), len(x)
    offsets = (np.arange(n + 1) * data.strides[0]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def matrix(column: pa.Array, kind: type) -> np.ndarray:
    """The rows' bytes as one matrix, without a copy."""
    n = len(column)
    wide = 4 if pa.types.is_binary(column.type) else 8
    offsets = np.frombuffer(column.buffers()[1], f"<i{wide}", n + 1, offset=column.offset * wide)
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data.view(kind).reshape(n, -1)


def _tasks(spark: SparkSession, n: int, width: int) -> int:
    """Tasks for ``n`` rows of ``width`` bytes: as many as the cluster has cores if the rows are worth it, more
    where a task's rows would not fit. The sums do not depend on it."""
    worth = min(spark.sparkContext.defaultParallelism, math.ceil(n / TASK_ROWS))
    return max(1, worth, math.ceil(n * (width + 20) / TASK_BYTES))


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Larger batches: the sums of a node are added up once a chunk."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
        if sum(b.num_rows for b in held) >= CHUNK or sum(b.nbytes for b in held) >= BLOCK_BYTES:
            yield pa.concat_batches(held)
            held = []
    if held:
        yield pa.concat_batches(held)


# ---- sums -------------------------------------------------------------------------------------------------------


@dataclass
class Wanted:
    """Nodes of a tree that wait for sums: node ``slots[s]`` over the features ``features[s]``."""

    number: int
    tree: Tree
    slots: list[int]
    features: np.ndarray
    cuts: np.ndarray | None = None  # of each slot and feature; None: cells are the bins
    every: bool = False  # all features in their order

    @property
    def cells(self) -> int:
        return self.features.size


def _sums(
    rows: DataFrame,
    tasks: int,
    wanted: list[Wanted],
    bins: int,
    kind: type,
    stats: Callable,
    least: bool = False,
    shared: bool = False,
) -> dict[int, np.ndarray]:
    """By tree, an array (slot, feature, bin, 3) of sums of ``stats(number, key, y, raw, x)``; with ``least``
    (slot, feature, 1, 3) of the least value, and of the least negative one. ``shared``: the stats are a small
    weight, the weighted label, and the weight again; else the first is 1 for each row."""
    per = 1 if least else bins

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = {w.number: np.full((w.cells * per, 3), np.inf if least else 0.0) for w in wanted}
        walks = [w.tree.walker() for w in wanted]
        for key, y, raw, x in _rows(batches, kind):
            cells_of, width = x.reshape(-1), x.shape[1]
            for w, walk in zip(wanted, walks):
                slot_of = np.full(len(w.tree.feature), -1)
                slot_of[w.slots] = np.arange(len(w.slots))
                slot = slot_of[walk(x)]
                own = np.flatnonzero(slot >= 0)
                if not len(own):
                    continue
                values = stats(w.number, key[own], y[own], raw[own], x if len(own) == len(x) else x[own])
                some = values[0] > 0
                if not some.all():
                    own, values = own[some], [v[some] for v in values]
                slot, offered = slot[own], w.features.shape[1]
                if w.every:
                    _add_columns(found[w.number], x if len(own) == len(x) else x[own], slot * (width * per), values, per)
                    continue
                taken = cells_of[(own * width)[:, None] + w.features[slot]]
                cells = slot[:, None] * offered + np.arange(offered)
                if least:
                    np.minimum.at(found[w.number][:, 0], cells.ravel(), taken.ravel())
                    np.minimum.at(found[w.number][:, 1], cells.ravel(), -taken.ravel())
                    continue
                cells = (cells * per + (taken if w.cuts is None else taken > w.cuts[slot])).ravel()
                total = found[w.number]
                if shared:  # weight and weighted label in one sum
                    both = np.bincount(cells, np.repeat(values[0] + SHARED * values[1], offered), len(total))
                    label = np.floor(both / SHARED)
                    weight = both - label * SHARED
                    total += np.column_stack([weight, label, weight])
                    continue
                for k, v in enumerate(values):
                    total[:, k] += np.bincount(cells, np.repeat(v, offered), len(total)) if k else np.bincount(cells, minlength=len(total))
        for number, cells in found.items():
            for part in range(0, len(cells), PART):
                own = cells[part : part + PART]
                at = np.flatnonzero(np.isfinite(own[:, 0]) if least else own[:, 0])
                if len(at):
                    yield _sent(number, part, at, own[at])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for r in batch.to_pylist():
                place = r["number"], r["part"]
                if place not in found:
                    found[place] = np.full((PART, 3), np.inf if least else 0.0)
                _add(found[place], r, least)
        for (number, part), own in found.items():
            at = np.flatnonzero(np.isfinite(own[:, 0]) if least else own[:, 0])
            yield _sent(number, part, at, own[at])

    kinds = "number int, part int, at binary, sums binary"
    sent = rows.mapInArrow(run, kinds)
    if tasks > DIRECT or tasks * sum(w.cells for w in wanted) * per * 28 > DIRECT_BYTES:
        sent = sent.repartition("number", "part").mapInArrow(add, kinds)
    total = {w.number: np.full((w.cells * per, 3), np.inf if least else 0.0) for w in wanted}
    for r in sent.collect():
        _add(total[r["number"]][r["part"] :], r, least)
    return {w.number: total[w.number].reshape(*w.features.shape, per, 3) for w in wanted}


def _add_columns(total: np.ndarray, x: np.ndarray, begin: np.ndarray, values: list[np.ndarray], bins: int) -> None:
    """Adds the sums of all columns, one at a time: little memory, and no copies of the values."""
    slots, place = total.reshape(-1, x.shape[1], bins, 3), begin // x.shape[1]
    for j, column in enumerate(np.ascontiguousarray(x.T)):
        cells = place + column
        slots[:, j, :, 0] += np.bincount(cells, minlength=len(slots) * bins).reshape(-1, bins)
        for k in (1, 2):
            slots[:, j, :, k] += np.bincount(cells, values[k], len(slots) * bins).reshape(-1, bins)


def _sent(number: int, part: int, at: np.ndarray, sums: np.ndarray) -> pa.RecordBatch:
    values = [pa.array([number], pa.int32()), pa.array([part], pa.int32()), pa.array([at.astype("<i4").tobytes()]), pa.array([sums.tobytes()])]
    return pa.RecordBatch.from_arrays(values, ["number", "part", "at", "sums"])


def _add(total: np.ndarray, row, least: bool) -> None:
    at, sums = np.frombuffer(row["at"], "<i4"), np.frombuffer(row["sums"]).reshape(-1, 3)
    total[at] = np.minimum(total[at], sums) if least else total[at] + sums


@dataclass
class Split:
    gain: float
    feature: int
    place: int  # the bin that still goes left, or 0 for a given cut
    column: int  # among the slot's features
    left: np.ndarray  # weight, gradient, curvature
    right: np.ndarray

    def plain(self) -> list:
        return [self.gain, self.feature, self.place, self.column, self.left.tolist(), self.right.tolist()]


def best_split(sums: np.ndarray, features: np.ndarray, by: int, rows: float, curvature: float) -> Split | None:
    """The split of one node's (feature, bin, 3) sums with the greatest ``G² / S`` of its sides less that of the
    node; S is the weight (``by`` 0) or the curvature (2). Each side needs ``rows`` and ``curvature``; the
    first of equal ones wins."""
    left = np.cumsum(sums, axis=1)[:, :-1]
    node = sums[0].sum(axis=0)
    right = node - left
    fine = (left[..., 0] >= rows) & (right[..., 0] >= rows) & (left[..., 2] >= curvature) & (right[..., 2] >= curvature)
    if not fine.any():
        return None
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = left[..., 1] ** 2 / left[..., by] + right[..., 1] ** 2 / right[..., by]
    gain = np.where(fine, gain, -np.inf)
    column, place = np.unravel_index(int(np.argmax(gain)), gain.shape)
    before = node[1] ** 2 / node[by]
    value = float(gain[column, place] - before)
    if not value > 1e-9 * max(1.0, abs(before)):
        return None
    return Split(value, int(features[column]), int(place), int(column), left[column, place], right[column, place])


# ---- forests ----------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Forest:
    """Mean class share of the leaves. A node is offered ``features`` (default: the root of all) features in the
    order of a hash; if none of them splits it, the next ones, until all were."""

    trees: int = 100
    depth: int = 10
    bins: int = 64
    features: int | None = None
    random_cuts: bool = False
    seed: int = 42

    def fit(self, rows: DataFrame, vec: str, key: str, label: str) -> TreeModel:
        first = rows.select(F.size(vec).alias("n")).first()
        if first is None or not first["n"]:
            share = rows.agg(F.avg(F.col(label).cast("double"))).first()[0]
            return TreeModel([Tree(value=[share or 0.0])])
        n_features = first["n"]
        limits = None if self.random_cuts else bin_limits(rows, vec, key, self.bins)
        tasks = _tasks(rows.sparkSession, rows.count(), n_features * (8 if self.random_cuts else 1))
        stored = _blocks(_stored(rows, vec, key, label, limits, tasks))
        take = self.features or max(1, math.isqrt(n_features))
        random_cuts, seed = self.random_cuts, self.seed

        def stats(number, key, y, raw, x):
            weight = np.ones(len(y)) if random_cuts else bag(key, number, seed).astype(float)
            return weight, weight * y, weight

        grown = [Tree() for _ in range(self.trees)]
        waiting = [(t, 0, 0) for t in range(self.trees)]
        while waiting:
            later: list[tuple[int, int, int]] = []
            per_node = take * (2 if random_cuts else self.bins) * 24
            for some in self._batches(waiting, max(1, SUM_BYTES // per_node)):
                wanted = self._wanted(some, grown, n_features, take)
                if random_cuts:
                    ends = _sums(stored, tasks, wanted, 1, float, stats, least=True)
                    for w in wanted:
                        self._draw(w, ends[w.number][:, :, 0])
                sums = _sums(stored, tasks, wanted, 2 if random_cuts else self.bins, float if random_cuts else np.uint8, stats, shared=True)
                tries = {(t, node): k for t, node, k in some}
                for w in wanted:
                    for s, node in enumerate(w.slots):
                        later += self._grow(w, s, sums[w.number][s], tries[w.number, node], n_features, take, limits)
            waiting = later
        if limits is not None:
            grown = [_in_values(t, limits) for t in grown]
        return TreeModel(grown)

    def _batches(self, waiting: list, size: int) -> Iterator[list]:
        waiting = sorted(waiting)
        for k in range(0, len(waiting), size):
            yield waiting[k : k + size]

    def _wanted(self, some: list, grown: list[Tree], n_features: int, take: int) -> list[Wanted]:
        out: dict[int, tuple[list, list]] = {}
        for t, node, k in some:
            order = np.argsort(hashed(self.seed, t, node, np.arange(n_features)), kind="stable")
            own = order[k * take : (k + 1) * take]
            # the last choice may be short: earlier features fill it and cannot split
            own = own if len(own) == take else order[n_features - take :]
            slots, features = out.setdefault(t, ([], []))
            slots.append(node)
            features.append(own)
        return [Wanted(t, grown[t], slots, np.array(features)) for t, (slots, features) in out.items()]

    def _draw(self, w: Wanted, ends: np.ndarray) -> None:
        low, high = ends[..., 0], -ends[..., 1]
        share = uniform(self.seed, w.number, np.array(w.slots)[:, None], w.features, 1)
        with np.errstate(invalid="ignore"):
            cut = low + share * (high - low)
        w.cuts = np.where(cut < high, cut, low)

    def _grow(self, w: Wanted, s: int, sums: np.ndarray, tried: int, n_features: int, take: int, limits) -> list:
        tree, node = w.tree, w.slots[s]
        total = sums[0].sum(axis=0)
        if not tried:
            tree.value[node] = float(total[1] / total[0]) if total[0] else 0.0
        if tree.depth[node] >= self.depth or total[0] < 2 or not 0 < total[1] < total[0]:
            return []
        found = best_split(sums, w.features[s], 0, 1, 0)
        if found is None:
            return [(w.number, node, tried + 1)] if (tried + 1) * take < n_features else []
        cut = float(w.cuts[s, found.column]) if w.cuts is not None else float(found.place)
        out = []
        for child, own in zip(tree.split(node, found.feature, cut), (found.left, found.right)):
            tree.value[child] = float(own[1] / own[0])
            if tree.depth[child] < self.depth and own[0] >= 2 and 0 < own[1] < own[0]:
                out.append((w.number, child, 0))
        return out


def _in_values(tree: Tree, limits: list[np.ndarray]) -> Tree:
    """Cuts between bins as cuts between values."""
    tree.cut = [float(limits[f][int(c)]) if f >= 0 else 0.0 for f, c in zip(tree.feature, tree.cut)]
    return tree


# ---- boosting ---------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Boosting:
    """``newton`` splits by gradients over curvatures, else by the variance of the residuals; a leaf's value is one
    Newton step in both. A side of a split needs ``min_rows`` rows and ``min_curvature``."""

    rounds: int = 100
    rate: float = 0.1
    leaves: int = 31
    depth: int = 64
    bins: int = 255
    min_rows: int = 20
    min_curvature: float = 1e-3
    newton: bool = True

    def fit(self, rows: DataFrame, vec: str, key: str, label: str) -> TreeModel:
        n, positive, size = rows.agg(F.count("*"), F.sum(F.col(label).cast("long")), F.max(F.size(vec))).first()
        if not n or not 0 < positive < n or not size:
            share = min(max((positive or 0) / n, 1e-12), 1 - 1e-12) if n else 0.5
            return TreeModel([], True, math.log(share / (1 - share)))
        base = math.log(positive / (n - positive))
        limits = bin_limits(rows, vec, key, self.bins)
        tasks = _tasks(rows.sparkSession, n, size)
        stored = _blocks(_stored(rows, vec, key, label, limits, tasks, base))
        # sums of n such numbers stay whole in a double
        step = 2.0 ** min(30, 51 - math.ceil(math.log2(n + 1)))
        trees: list[Tree] = []
        fresh: list[Tree] = []  # not yet in the rows' scores
        for number in range(self.rounds):
            tree = self._tree(stored, tasks, n, fresh, step, size)
            fresh.append(tree)
            trees.append(tree)
            if len(fresh) == REFRESH and number + 1 < self.rounds:
                stored, before, fresh = materialize(_rescored(stored, fresh), "train", **READ_OFTEN), stored, []
                discard(before)
        return TreeModel([_in_values(t, limits) for t in trees], True, base)

    def _tree(self, stored: DataFrame, tasks: int, n: int, fresh: list[Tree], step: float, n_features: int) -> Tree:
        def stats(number, key, y, raw, x):
            p = 1 / (1 + np.exp(-(raw + sum(t.values(x) for t in fresh))))
            return np.ones(len(y)), np.rint((p - y) * step), np.rint(p * (1 - p) * step)

        grown = _Grown(self, n_features, self.min_curvature * step)
        tree, every = grown.tree, np.arange(n_features)
        held: dict[int, np.ndarray] = {}  # sums of leaves, bounded by the leaves that are split ahead
        few = NODE_BYTES // n_features
        alone, wanted, sibling = ([0], [], {}) if n <= few else ([], [0], {})
        while alone or wanted:
            if alone:
                left = self.leaves - 1 if alone == [0] else self.leaves - grown.order()[1]
                for node, total, found in self._finished(stored, tree, alone, left, stats, n_features, grown.curvature):
                    grown.attach(node, total, found)
            some = max(1, SUM_BYTES // (n_features * self.bins * 24))
            for k in range(0, len(wanted), some):
                own = wanted[k : k + some]
                held |= zip(own, _sums(stored, tasks, [Wanted(0, tree, own, np.tile(every, (len(own), 1)), every=True)], self.bins, np.uint8, stats)[0])
            for node in wanted:
                if node in sibling:
                    other, parent = sibling[node]
                    held[other] = held.pop(parent) - held[node]
            for node in [n for n in held if n not in grown.splits]:
                grown.measure(node, held[node])
            leaves = grown.order()[1]
            alone, wanted, sibling = [], [], {}
            if leaves < self.leaves:
                # a leaf behind so many others of a greater gain is not split any more
                for node in grown.ahead()[: self.leaves - leaves]:
                    if grown.totals[node][0] <= few:
                        alone.append(node)
                        continue
                    pair = grown.split(node)
                    found = grown.splits[node]
                    small = int(found.right[0] < found.left[0])
                    wanted.append(pair[small])
                    sibling[pair[small]] = pair[1 - small], node
                if wanted:  # small nodes wait for the others, so that one pass finishes them all
                    alone = []
        return self._cut_back(grown)

    def _finished(
        self, stored: DataFrame, tree: Tree, nodes: list[int], splits: int, stats: Callable, n_features: int, curvature: float
    ) -> list[tuple[int, list, list]]:
        """Each of the nodes with its sums, split best gain first ``splits`` times at most: (place under it, split)."""

        def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            walk = tree.walker()
            for _, y, raw, x in _rows(batches, np.uint8):
                node = walk(x)
                for place, k in enumerate(nodes):
                    own = np.flatnonzero(node == k)
                    if len(own):
                        taken = x[own]
                        _, g, h = stats(0, None, y[own], raw[own], taken)
                        values = [pa.array([v.tobytes()], pa.binary()) for v in (g, h, taken)]
                        yield pa.RecordBatch.from_arrays([pa.array([place], pa.int32()), *values], ["place", "g", "h", "x"])

        def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            rows: dict[int, list] = {}
            for batch in batches:
                for place, own in zip(batch.column("place").to_pylist(), unpacked([batch], {"g": float, "h": float, "x": np.uint8})):
                    rows.setdefault(nodes[place], []).append(own)
            for node, parts in rows.items():
                g, h, x = (np.concatenate(p) for p in zip(*parts))
                values = np.column_stack([np.ones(len(g)), g, h])
                found = self._alone(x, values, tree.depth[node], splits, n_features, curvature)
                told = json.dumps([values.sum(axis=0).tolist(), found])
                yield pa.RecordBatch.from_arrays([pa.array([node]), pa.array([told])], ["node", "found"])

        # a task for each node
        own = stored.mapInArrow(take, "place int, g binary, h binary, x binary").repartitionById(len(nodes), F.col("place"))
        done = own.mapInArrow(finish, "node bigint, found string").collect()
        return [(r["node"], *json.loads(r["found"])) for r in sorted(done, key=lambda r: r["node"])]

    def _alone(self, x: np.ndarray, values: np.ndarray, depth: int, splits: int, n_features: int, curvature: float) -> list:
        grown = _Grown(self, n_features, curvature, depth)
        columns = np.ascontiguousarray(x.T)

        def sums(rows: np.ndarray) -> np.ndarray:
            out, own = np.empty((n_features, self.bins, 3)), np.ascontiguousarray(values[rows].T)
            for j, column in enumerate(columns):  # a feature at a time: little memory beside the rows
                cells = column[rows].astype(np.intp)
                out[j, :, 0] = np.bincount(cells, minlength=self.bins)
                for k in (1, 2):
                    out[j, :, k] = np.bincount(cells, own[k], self.bins)
            return out

        rows = {0: np.arange(len(x))}
        held = {0: sums(rows[0])}
        grown.measure(0, held[0])
        found = []
        while len(found) < splits and (ahead := grown.ahead()):
            node = ahead[0]
            split = grown.splits[node]
            found.append((grown.path[node], split.plain()))
            pair = grown.split(node)
            goes = x[rows[node], split.feature] <= split.place
            rows[pair[0]], rows[pair[1]] = rows[node][goes], rows.pop(node)[~goes]
            small = int(split.right[0] < split.left[0])
            held[pair[small]] = sums(rows[pair[small]])
            held[pair[1 - small]] = held.pop(node) - held[pair[small]]
            for child in pair:
                grown.measure(child, held[child])
        return found

    def _cut_back(self, grown: _Grown) -> Tree:
        """The tree of the splits in order, with its leaves' values."""
        tree, place = Tree(), {0: 0}
        for node in grown.order()[0]:
            pair = tree.split(place[node], grown.tree.feature[node], grown.tree.cut[node])
            place |= {grown.tree.left[node]: pair[0], grown.tree.right[node]: pair[1]}
        for node, own in place.items():
            if tree.feature[own] < 0 and grown.totals[node][2]:
                tree.value[own] = float(-self.rate * grown.totals[node][1] / grown.totals[node][2])
        return tree


class _Grown:
    """A tree that is split ahead of its turn, and what is known of its nodes."""

    def __init__(self, settings: Boosting, n_features: int, curvature: float, depth: int = 0):
        self.settings, self.every, self.curvature = settings, np.arange(n_features), curvature
        self.tree = Tree(depth=[depth])
        self.splits: dict[int, Split | None] = {}
        self.totals: dict[int, np.ndarray] = {}
        self.path = {0: 1}  # the children of p are 2p and 2p + 1

    def measure(self, node: int, sums: np.ndarray) -> None:
        self.totals[node] = sums[0].sum(axis=0)
        s = self.settings
        fine = self.tree.depth[node] < s.depth
        self.splits[node] = best_split(sums, self.every, 2 if s.newton else 0, s.min_rows, self.curvature) if fine else None

    def split(self, node: int) -> tuple[int, int]:
        found = self.splits[node]
        pair = self.tree.split(node, found.feature, float(found.place))
        self.path |= {child: 2 * self.path[node] + k for k, child in enumerate(pair)}
        return pair

    def rank(self, node: int) -> tuple[float, int]:
        return -self.splits[node].gain, self.path[node]

    def ahead(self) -> list[int]:
        """Leaves that can be split, best gain first."""
        return sorted((n for n, s in self.splits.items() if s and self.tree.feature[n] < 0), key=self.rank)

    def order(self) -> tuple[list[int], int]:
        """The nodes split one at a time, best gain first, as far as the gains are known, and the leaves then:
        all that are allowed where nothing is left to split."""
        limit = self.settings.leaves
        queue = [self.rank(0) + (0,)] if self.splits.get(0) else []
        order: list[int] = []
        while queue and len(order) + 1 < limit:
            node = heapq.heappop(queue)[-1]
            pair = (self.tree.left[node], self.tree.right[node])
            if pair[0] < 0 or any(c not in self.splits for c in pair):
                return order, len(order) + 1
            order.append(node)
            for child in pair:
                if self.splits[child]:
                    heapq.heappush(queue, self.rank(child) + (child,))
        return order, limit

    def attach(self, node: int, total: list, found: list) -> None:
        """Splits of a node and below it, by their place under the node (1: itself)."""
        at = {1: node}
        self.totals[node], self.splits[node] = np.array(total), None
        for place, plain in found:
            own = at[place]
            split = Split(*plain[:4], *map(np.array, plain[4:]))
            self.splits[own] = split
            pair = self.split(own)
            for k, child in enumerate(pair):
                at[2 * place + k] = child
                self.totals[child] = (split.left, split.right)[k]
                self.splits[child] = None  # until its own split follows


def _rescored(stored: DataFrame, fresh: list[Tree]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, y, raw, x in _rows(batches, np.uint8):
            yield _block(key, y, raw + sum(t.values(x) for t in fresh), x)

    return stored.mapInArrow(run, BLOCK)
