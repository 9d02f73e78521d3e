"""Logistic regression by stochastic gradient descent, the same at any partitioning.

Rows are dealt to shards by a hash of their key, as many as the number of rows asks for. In an epoch each
shard takes the weights of the epoch before, goes through its rows once, in the order of a hash of (key,
epoch), in small batches, and the shards' weights are averaged by their rows. The first step is the batch's size over
twice the curvature that the rows' mean square allows; it falls with the number of epochs, as
1 / (1 + epochs / 4). Where the loss rises above that of no weights at all, the descent begins
again with a quarter of the step. The answer is the running mean of the epochs' weights, each epoch counting
for its number: early ones fade out.

It stops when the mean loss has not fallen by ``tolerance`` for ``patience`` epochs, or after ``epochs``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lendlens.operators.trees import BLOCK_BYTES, READ_OFTEN, byte_rows, hashed, matrix, unpacked
from lendlens.session import materialize

#: Rows of a shard, about; and shards at least, so that small tables use several tasks too.
SHARD_ROWS, SHARDS = 250_000, 8
#: Bytes of a row group that holds a whole shard.
WHOLE = 1024 * 1024 * 1024


@dataclass
class LinearModel:
    weights: list[float]
    intercept: float
    losses: list[float]

    def score(self, vec: Column) -> Column:
        """Probability of class 1 for an array column."""
        factors = F.array(*[F.lit(w) for w in self.weights])
        margin = F.aggregate(F.zip_with(vec, factors, lambda x, w: x * w), F.lit(self.intercept), lambda s, x: s + x)
        return 1 / (1 + F.exp(-margin))

    def save(self, spark: SparkSession, path: str) -> None:
        rows = [(self.weights, self.intercept, self.losses)]
        kind = "weights array<double>, intercept double, losses array<double>"
        spark.createDataFrame(rows, kind).coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> LinearModel:
        row = spark.read.parquet(path).first()
        return cls(row["weights"], row["intercept"], row["losses"])


def ordered(draw: np.ndarray, y: np.ndarray, x: np.ndarray) -> np.ndarray:
    """The rows by their draw; rows of one draw go by their label and numbers, so equal keys have an order too."""
    order = np.argsort(draw, kind="stable")
    same = draw[order][1:] == draw[order][:-1]
    if same.any():  # only those rows are compared in full
        ties = np.flatnonzero(np.concatenate([same, [False]]) | np.concatenate([[False], same]))
        own = order[ties]
        order[ties] = own[np.lexsort((*x[own].T[::-1], y[own], draw[own]))]
    return order


def epoch(x: np.ndarray, y: np.ndarray, weight: np.ndarray, start: np.ndarray, step: float, penalty: float, batch: int) -> np.ndarray:
    """One pass over a shard's rows in their order; the last weight is the intercept, which has no penalty."""
    w = start.copy()
    for k in range(0, len(x), batch):
        own = slice(k, k + batch)
        miss = weight[own] * (1 / (1 + np.exp(-(x[own] @ w[:-1] + w[-1]))) - y[own])
        w[:-1] -= step * (miss @ x[own] / len(miss) + penalty * w[:-1])
        w[-1] -= step * miss.mean()
    return w


@dataclass(frozen=True)
class Descent:
    """``penalty`` times half the weights' square is added to the mean of the balanced log loss."""

    penalty: float = 1e-4
    epochs: int = 60
    batch: int = 16
    tolerance: float = 1e-4
    patience: int = 5
    seed: int = 42

    def fit(self, rows: DataFrame, vec: str, key: str, label: str) -> LinearModel:
        """``rows`` have a key, a label of 0 or 1, and an array of numbers; classes are balanced."""
        counts = {r[label]: r["n"] for r in rows.groupBy(label).agg(F.count("*").alias("n")).collect()}
        n, size = sum(counts.values()), rows.agg(F.max(F.size(vec))).first()[0] or 0
        if len(counts) < 2 or not size:
            share = min(max(counts.get(1, 0) / n, 1e-12), 1 - 1e-12) if n else 0.5
            return LinearModel([0.0] * size, math.log(share / (1 - share)), [])
        balance = {c: n / (2.0 * m) for c, m in counts.items()}
        shards = max(SHARDS, math.ceil(n / SHARD_ROWS))
        stored = self._stored(rows, vec, key, label, shards)
        square = stored.agg(F.sum("square")).first()[0] / n
        # a power of two: sums in another order give the same one
        step = self.batch / 2 * 2.0 ** -math.ceil(math.log2(max(1.0, max(balance.values()) * 0.25 * (square + 1))))
        while (found := self._descend(stored, size, step, balance, n)) is None:
            step /= 4
        return found

    def _descend(self, stored: DataFrame, size: int, step: float, balance: dict, n: int) -> LinearModel | None:
        w, mean = np.zeros(size + 1), np.zeros(size + 1)
        best, waited, losses = math.inf, 0, []
        for number in range(self.epochs):
            w, loss = self._epoch(stored, w, mean, number, step, balance, n)
            mean += (w - mean) * 2 / (number + 2)
            if number:  # the loss of the mean that this epoch began with
                if not loss <= math.log(2):
                    return None
                losses.append(loss)
                waited = 0 if loss < best - self.tolerance else waited + 1
                best = min(best, loss)
                if waited >= self.patience:
                    break
        return LinearModel(mean[:-1].tolist(), float(mean[-1]), losses)

    def _stored(self, rows: DataFrame, vec: str, key: str, label: str, shards: int) -> DataFrame:
        """(shard, key, y, x, square), each shard's rows in one task, as blocks of bytes; ``square`` is a block's sum."""
        own = rows.select(F.xxhash64(key).alias("key"), F.col(label).cast("int").alias("y"), F.col(vec).cast("array<double>").alias("x"))
        own = own.withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards)).cast("int"))

        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                    yield batch.set_column(batch.schema.get_field_index("x"), "x", byte_rows(x))

        def block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: dict[int, list] = {}

            def full(s: int) -> pa.RecordBatch:
                key, y, x = (np.concatenate(c) for c in zip(*held.pop(s)))
                values = [pa.array([v.tobytes()], pa.binary()) for v in (key, y, x)]
                return pa.RecordBatch.from_arrays([pa.array([s], pa.int32()), *values, pa.array([float((x * x).sum())])], ["shard", "key", "y", "x", "square"])

            for batch in batches:
                if batch.num_rows:
                    x = matrix(batch.column("x"), float)
                    shard, key, y = (batch.column(c).to_numpy() for c in ("shard", "key", "y"))
                    for s in np.unique(shard).tolist():
                        own = shard == s
                        held.setdefault(s, []).append((key[own], y[own], x[own]))
                        if sum(p[2].nbytes for p in held[s]) >= BLOCK_BYTES:
                            yield full(s)
            for s in list(held):
                yield full(s)

        dealt = own.mapInArrow(pack, "key bigint, y int, x binary, shard int").repartitionById(shards, F.col("shard"))
        blocks = dealt.mapInArrow(block, "shard int, key binary, y binary, x binary, square double")
        # a file of one row group is read by one task
        return materialize(blocks, "shards", **READ_OFTEN | {"parquet.block.size": WHOLE})

    def _epoch(self, stored: DataFrame, w: np.ndarray, mean: np.ndarray, number: int, step: float, balance: dict, n: int):
        penalty, batch, seed = self.penalty, self.batch, self.seed

        def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            parts: dict[int, list] = {}
            for f in frames:
                for s, own in zip(f.column("shard").to_pylist(), unpacked([f], {"key": np.int64, "y": np.int32, "x": float})):
                    parts.setdefault(s, []).append(own)
            for s, part in parts.items():
                key, y, x = (np.concatenate(c) for c in zip(*part))
                order = ordered(hashed(key, number, seed), y, x)
                x, y = x[order], y[order].astype(float)
                weight = np.where(y > 0, balance[1], balance[0])
                margin = x @ mean[:-1] + mean[-1]  # seen before this epoch
                loss = float(weight @ (np.logaddexp(0, margin) - y * margin))
                done = epoch(x, y, weight, w, step / (1 + number / 4), penalty, batch)
                values = [pa.array([s], pa.int32()), pa.array([len(x)], pa.int64()), pa.array([loss]), pa.array([done.tolist()])]
                yield pa.RecordBatch.from_arrays(values, ["shard", "n", "loss", "w"])

        # one row of weights a shard
        rows = sorted(stored.mapInArrow(run, "shard int, n bigint, loss double, w array<double>").collect(), key=lambda r: r["shard"])
        new = sum(np.array(r["w"]) * (r["n"] / n) for r in rows)
        return new, sum(r["loss"] for r in rows) / n + penalty / 2 * float(mean[:-1] @ mean[:-1])
