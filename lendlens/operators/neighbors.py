"""Exact k nearest neighbours of every row, as a meeting of bounded blocks.

Candidates are cut into cells around pivot rows, and neighbouring cells share a block of bounded size, one row
of bytes. By the triangle inequality a row only looks into cells that can hold one of its k nearest (the bounds
of Lu, Shen, Chen and Ooi, "Efficient processing of k nearest neighbor joins using MapReduce", 2012). Asking
rows are packed alike, into chunks; a chunk meets each block that one of its rows has to see. Both are read from
the shared folder, so the vectors move once, when they are packed, and not once for each cell a row has to see.
A meeting returns k rows per asking row and never all pairs. Copies of one vector need no special treatment on
the asking side; on the answering side only the k+1 lowest ids of a vector can ever be chosen.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lendlens.functions import hashed_order
from lendlens.session import materialize

BLOCK_BYTES = 32 * 1024 * 1024
MAX_PIVOTS = 256
ROWS_PER_PIVOT = 2_000


def _answering_rows(df: DataFrame, k: int) -> DataFrame:
    """At most k+1 rows per distinct vector; the rank filter acts before the shuffle as well."""
    same = Window.partitionBy("v").orderBy("id")
    return df.withColumn("_r", F.row_number().over(same)).filter(F.col("_r") <= k + 1).drop("_r")


def _distances(pivots: list[list[float]]):
    """A function from row vectors to their distances from every pivot, or from some. Being local, it travels to
    the workers by value."""

    def measure(x, some=slice(None)):
        import numpy as np

        centres = np.asarray(pivots, dtype="float64")[some]
        gaps = np.empty((len(x), len(centres)))
        for j, centre in enumerate(centres):
            gaps[:, j] = np.sqrt(((x - centre) ** 2).sum(axis=1))
        return gaps

    return measure


def _with_cells(df: DataFrame, pivots: list[list[float]]) -> DataFrame:
    """Adds the nearest pivot (``cell``) and the distance to it (``near``)."""
    measure = _distances(pivots)

    def assign(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            vec = batch.column("v")
            gaps = measure(np.asarray(vec.flatten()).reshape(batch.num_rows, -1))
            cell = gaps.argmin(axis=1)
            near = gaps[np.arange(len(cell)), cell]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), vec, pa.array(cell, pa.int32()), pa.array(near, pa.float64())],
                names=["id", "v", "cell", "near"],
            )

    return df.select("id", "v").mapInArrow(assign, "id bigint, v array<double>, cell int, near double")


def _cell_stats(cells: DataFrame, k: int) -> list[dict]:
    """Rows, innermost and outermost distance, and the k+1 smallest distances of each cell: at most
    MAX_PIVOTS rows."""
    order = Window.partitionBy("cell").orderBy("near", "id")
    closest = (
        cells.select("cell", "near", "id")
        .withColumn("_r", F.row_number().over(order))
        .filter(F.col("_r") <= k + 1)
        .groupBy("cell")
        .agg(F.sort_array(F.collect_list("near")).alias("closest"))
    )
    size = cells.groupBy("cell").agg(
        F.count("*").alias("n"), F.min("near").alias("inner"), F.max("near").alias("outer")
    )
    return [r.asDict() for r in size.join(closest, "cell").orderBy("cell").collect()]


def _bounds(pivots: list[list[float]], stats: list[dict], k: int):
    """A function from row vectors to an upper bound of the distance of their k-th neighbour and, for each cell of
    ``stats``, the least distance that its rows can have."""
    measure = _distances(pivots)
    tables = [(s["cell"], s["inner"], s["outer"], list(s["closest"])) for s in stats]

    def bounds(x):
        import numpy as np

        cells, inner, outer = (np.array([t[i] for t in tables]) for i in range(3))
        limit, nearest = np.empty(len(x)), np.empty((len(x), len(cells)))
        for start in range(0, len(x), 4096):
            part = slice(start, start + 4096)
            gaps = measure(x[part])[:, cells]
            # a row of cell j lies within gap_j + its distance to the pivot: the (k+1)-th smallest of
            # these sums bounds the k-th neighbour, the asking row itself being one of the rows counted
            reach = np.concatenate([gaps[:, [j]] + np.array(t[3])[None, :] for j, t in enumerate(tables)], axis=1)
            place = min(k, reach.shape[1] - 1)
            # slack for rounding; too many visits do no harm
            limit[part] = np.partition(reach, place, axis=1)[:, place] * (1 + 1e-9) + 1e-12
            nearest[part] = np.maximum(np.maximum(gaps - outer, inner - gaps), 0.0)
        return limit, nearest

    return bounds


def _layout(pivots: list[list[float]], stats: list[dict], rows_per_block: int) -> dict[int, tuple[int, int]]:
    """By cell its first block, and to how many its rows are dealt. From a pivot to the nearest one left, cells
    fill up blocks; a cell of more rows has blocks of its own."""
    import numpy as np

    left, at = {s["cell"]: s["n"] for s in stats}, stats[0]["cell"]
    gaps = _distances(pivots)(np.asarray(pivots, float))
    found, last, room = {}, -1, 0
    while True:
        n = left.pop(at)
        if n > rows_per_block:
            found[at] = last + 1, math.ceil(n / rows_per_block)
            last, room = last + found[at][1], 0
        else:
            if n > room:
                last, room = last + 1, rows_per_block
            found[at], room = (last, 1), room - n
        if not left:
            return found
        at = min(left, key=lambda c: (gaps[at, c], c))


def _hash_part(salt: str, parts: Column | int) -> Column:
    return F.pmod(F.xxhash64(F.lit(salt), "id"), F.lit(parts) if isinstance(parts, int) else parts).cast("int")


def _placed(cells: DataFrame, layout: dict[int, tuple[int, int]]) -> DataFrame:
    """Adds the row's ``block``."""
    places = [F.create_map(*[F.lit(v) for c, p in layout.items() for v in (c, p[i])])[F.col("cell")] for i in (0, 1)]
    return cells.withColumn("block", (places[0] + _hash_part("block", places[1])).cast("int"))


def _visits(
    df: DataFrame, pivots: list[list[float]], stats: list[dict], k: int, rows_per_block: int, chunks: int
) -> DataFrame:
    """Asking rows with the bound of their k-th neighbour, the blocks that may hold one, and their chunk: rows of one
    block of their own, in ``chunks`` parts."""
    layout, bounds = _layout(pivots, stats, rows_per_block), _bounds(pivots, stats, k)
    places = [layout[s["cell"]] for s in stats]

    def route(batches):
        import numpy as np
        import pyarrow as pa

        first, times = (np.array([p[i] for p in places]) for i in (0, 1))
        for batch in batches:
            limit, nearest = bounds(np.asarray(batch.column("v").flatten()).reshape(batch.num_rows, -1))
            row, at = np.nonzero(nearest <= limit[:, None])
            row, block = np.repeat(row, times[at]), np.repeat(first[at], times[at])
            block = block + np.arange(len(row)) - np.repeat(np.cumsum(times[at]) - times[at], times[at])
            seen = np.unique(np.column_stack([row, block]), axis=0)
            offsets = np.searchsorted(seen[:, 0], np.arange(batch.num_rows + 1))
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(seen[:, 1], pa.int32()))
            own = [batch.column("id"), batch.column("v"), batch.column("block"), pa.array(limit), lists]
            yield pa.RecordBatch.from_arrays(own, ["id", "v", "block", "limit", "blocks"])

    placed = _placed(_with_cells(df, pivots), layout).select("id", "v", "block")
    routed = placed.mapInArrow(route, "id bigint, v array<double>, block int, limit double, blocks array<int>")
    return routed.withColumn("chunk", F.col("block") * chunks + _hash_part("chunk", chunks))


def _packed_chunks(visits: DataFrame) -> DataFrame:
    """(a, x, limit, blocks), one row a chunk: its rows' ids, vectors and bounds as bytes, and the blocks it meets."""

    def pack(rows):
        import numpy as np
        import pyarrow as pa

        x = np.asarray(rows.column("v").combine_chunks().flatten())
        a, limit = (np.asarray(rows.column(c)) for c in ("id", "limit"))
        blocks = np.unique(np.asarray(rows.column("blocks").combine_chunks().flatten()))
        return pa.table({"a": [a.tobytes()], "x": [x.tobytes()], "limit": [limit.tobytes()], "blocks": pa.array([blocks.tolist()], pa.list_(pa.int32()))})

    packed = visits.groupBy("chunk").applyInArrow(lambda rows: pack(rows), "a binary, x binary, limit binary, blocks array<int>")
    return materialize(packed, "chunks", maxRecordsPerFile=1)


def _packed_blocks(placed: DataFrame) -> DataFrame:
    """(block, b, y, cells), one row a block: its rows' ids, vectors and cells as bytes, cell by cell."""

    def pack(rows):
        import numpy as np
        import pyarrow as pa

        order = np.lexsort((np.asarray(rows.column("id")), np.asarray(rows.column("cell"))))
        y = np.asarray(rows.column("v").combine_chunks().flatten()).reshape(len(order), -1)[order]
        b, cells = np.asarray(rows.column("id"))[order], np.asarray(rows.column("cell"))[order].astype("int32")
        block = pa.array([rows.column("block")[0].as_py()], pa.int32())
        return pa.table({"block": block, "b": [b.tobytes()], "y": [y.tobytes()], "cells": [cells.tobytes()]})

    packed = placed.groupBy("block").applyInArrow(lambda rows: pack(rows), "block int, b binary, y binary, cells binary")
    return materialize(packed, "blocks", maxRecordsPerFile=1)


def _nearest(pivots: list[list[float]], stats: list[dict], k: int):
    """A function from a chunk and a block to (a, b, distance): the k best answers of the block for each row of the
    chunk, cell by cell from the nearest."""
    measure = _distances(pivots)
    bound_of = {s["cell"]: (s["inner"], s["outer"]) for s in stats}

    def settled(x, b, y, held, waiting):
        """The k best so far by exact distance."""
        import numpy as np

        i, j = (np.concatenate(c) for c in zip(*waiting))
        exact = np.empty(len(i))
        for start in range(0, len(i), 65_536):
            part = slice(start, start + 65_536)
            exact[part] = np.sqrt(((x[i[part]] - y[j[part]]) ** 2).sum(axis=1))
        i, j, exact = (np.concatenate(c) for c in zip(held, (i, j, exact)))
        order = np.lexsort((b[j], exact, i))
        i, j, exact = i[order], j[order], exact[order]
        keep = np.arange(len(i)) - np.searchsorted(i, i, side="left") < k
        return i[keep], j[keep], exact[keep]

    def nearest(a, x, limit, b, y, cells):
        import numpy as np

        ends = np.append(np.flatnonzero(np.diff(cells)) + 1, len(cells))
        starts = np.append(0, ends[:-1])
        own = cells[starts]
        gaps = measure(x, own)
        x2, y2 = (x * x).sum(axis=1), (y * y).sum(axis=1)
        slack = 1e-10 * (x2 + y2.max()) + 1e-12
        # one product gives |y|^2 - 2xy
        left, right = np.column_stack([x, np.ones(len(x))]), np.column_stack([-2.0 * y, y2])
        best, most = np.full((len(x), k), np.inf), np.full(len(x), np.inf)
        held, waiting, n_waiting = (np.empty(0, np.int64),) * 2 + (np.empty(0),), [], 0

        for c in np.argsort(gaps.mean(axis=0), kind="stable"):
            inner, outer = bound_of[int(own[c])]
            least = np.maximum(np.maximum(gaps[:, c] - outer, inner - gaps[:, c]), 0.0)
            asking, answers = np.flatnonzero((least <= limit) & (least * least <= most + slack)), slice(starts[c], ends[c])
            step = max(1, 2_000_000 // (ends[c] - starts[c]))
            for start in range(0, len(asking), step):
                rows = asking[start : start + step]
                rough = left[rows] @ right[answers].T
                some = np.flatnonzero(rough.min(axis=1) <= most[rows] - x2[rows] + slack[rows])
                if not len(some):
                    continue
                rows, rough = rows[some], rough[some]
                rough[a[rows][:, None] == b[answers][None, :]] = np.inf
                few = np.partition(rough, k - 1, axis=1)[:, :k] if rough.shape[1] > k else rough
                known = np.concatenate([best[rows], few + x2[rows, None]], axis=1)
                best[rows] = np.partition(known, k - 1, axis=1)[:, :k]
                # the product form is rounded: keep everything that could be among the k, then measure exactly
                most[rows] = best[rows].max(axis=1)
                i, j = np.nonzero((rough <= (most[rows] - x2[rows] + slack[rows])[:, None]) & np.isfinite(rough))
                waiting.append((rows[i], j + starts[c]))
                n_waiting += len(i)
                if n_waiting > 2_000_000:
                    held, waiting, n_waiting = settled(x, b, y, held, waiting), [], 0
        if waiting:
            held = settled(x, b, y, held, waiting)
        i, j, exact = held
        return a[i], b[j], exact

    return nearest


def _meet(chunks: DataFrame, blocks: DataFrame, pivots: list[list[float]], stats: list[dict], k: int) -> DataFrame:
    """The k best answers of each block for each row of the chunks that meet it."""
    nearest = _nearest(pivots, stats, k)

    def run(batches):
        import numpy as np
        import pyarrow as pa

        kinds = {"a": "i8", "x": "f8", "limit": "f8", "b": "i8", "y": "f8", "cells": "i4"}
        for batch in batches:
            for r in range(batch.num_rows):
                a, x, limit, b, y, cells = (np.frombuffer(batch.column(c)[r].as_buffer(), kind) for c, kind in kinds.items())
                found = nearest(a, x.reshape(len(a), -1), limit, b, y.reshape(len(b), -1), cells)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in found], ["a", "b", "distance"])

    # both sides are read anew for each meeting: nothing is shuffled
    pairs = chunks.crossJoin(blocks).where(F.array_contains("blocks", F.col("block"))).select("a", "x", "limit", "b", "y", "cells")
    return pairs.mapInArrow(run, "a bigint, b bigint, distance double")


def neighbors(df: DataFrame, id_col: str, vec: str, k: int = 5, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The k nearest other rows of each row by Euclidean distance, ties by id: (a, b, distance, rank).

    ``id_col`` is a unique bigint, ``vec`` an array of equal length in every row.
    """
    rows = materialize(df.select(F.col(id_col).cast("bigint").alias("id"), F.col(vec).cast("array<double>").alias("v")))
    total, width = rows.agg(F.count("*"), F.max(F.size("v"))).first()
    if not total:
        raise ValueError("no rows to find neighbours among")
    answering = materialize(_answering_rows(rows, k), "answering")
    n_answering = answering.count()

    n_pivots = max(1, min(MAX_PIVOTS, n_answering // ROWS_PER_PIVOT))
    # a bounded number of rows, chosen by hash
    pivots = [
        list(r["v"]) for r in answering.orderBy(hashed_order(F.col("id"), "pivot"), "id").limit(n_pivots).collect()
    ]
    answering_cells = materialize(_with_cells(answering, pivots), "cells")
    stats = _cell_stats(answering_cells, k)

    # blocks of bounded size, and some meetings for every core
    share = math.ceil(n_answering / math.ceil(math.sqrt(4 * df.sparkSession.sparkContext.defaultParallelism)))
    per_block = max(1_000, min(block_bytes // (8 * width), share))
    layout = _layout(pivots, stats, per_block)
    asked = _placed(_with_cells(rows, pivots), layout).groupBy("block").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0]
    chunks = _packed_chunks(_visits(rows, pivots, stats, k, per_block, math.ceil(asked / per_block)))
    blocks = _packed_blocks(_placed(answering_cells, layout))
    best = Window.partitionBy("a").orderBy("distance", "b")
    met = _meet(chunks, blocks, pivots, stats, k)
    return met.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
