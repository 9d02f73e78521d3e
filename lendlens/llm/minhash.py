"""MinHash near-duplicates with sequential Bayesian verification.

A document's set is its distinct five-word shingles. Documents with equal sets form a class at once, and
the one with the smallest id stands for each. Bands of MinHash values bring representatives together; inside a
band's group, members are first compared with one member only, then only across what is not yet
connected: those outside the group's largest component with that component and with each other. Groups are
split into cells of bounded size; a member goes to its cells as one row, and pairs exist inside tasks only. A pair
compares its signatures in batches and is dropped as soon as the posterior probability of a similarity at the
threshold or above falls below the chosen miss probability; survivors are compared exactly on whole sets, in the
cell of the first band that they share, unless the cell has connected their components already.

Odd input: null, empty or blank text has an empty set and stands alone; fewer than five words are one
shingle; rows of a repeated id are judged each by its own text. A row with a null id takes part like any other: its
component has the smallest id that is there, NULL where no row of it has one, and it is kept in that case only.
Other columns are ignored (``keep_one`` keeps them).
"""

from __future__ import annotations

import hashlib
import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendlens.llm.common import per_batch, utf8, without
from lendlens.session import materialize

WORDS = 5
NEAR = (75, 100)  # similarity at least 75 / 100, compared in whole numbers
BANDS, ROWS = 48, 6  # a pair at 0.75 shares no band with probability 8.2e-5, one at 0.8 with 4.6e-7
MISS = 1e-6  # posterior probability at which a candidate is given up
BATCH = 32
#: Members, and shingles, that one side of a cell holds on average at most.
MEMBERS, WEIGHT = 1024, 2_000_000
#: Shingles that are hashed at a time.
COLUMNS = 512


@lru_cache(1)
def _multipliers() -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng(20)
    n = BANDS * ROWS
    return draw.integers(1, 1 << 63, n, dtype=np.uint64) | np.uint64(1), draw.integers(0, 1 << 63, n, dtype=np.uint64)


def shingles(data: bytes) -> np.ndarray:
    """Sorted distinct 64-bit shingle hashes of a text."""
    tokens = data.lower().split()  # bytes: A-Z, and ASCII white space
    codes = np.fromiter(map(xxhash.xxh3_64_intdigest, tokens), np.uint64, len(tokens))
    if not len(codes):
        return codes
    width = min(WORDS, len(codes))
    mixed = np.full(len(codes) - width + 1, np.uint64(width))
    for k in range(width):
        mixed = (mixed ^ codes[k : len(codes) - width + 1 + k]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed)


def signature(own: np.ndarray) -> np.ndarray:
    """MinHash values, the upper 31 bits of multiply-add hashes; blocks of shingles stay in the processor's cache."""
    a, b = _multipliers()
    least = np.full(len(a), np.iinfo(np.uint64).max)
    for start in range(0, len(own), COLUMNS):
        mixed = own[start : start + COLUMNS] * a[:, None]
        mixed += b[:, None]
        np.minimum(least, mixed.min(axis=1), out=least)
    return (least >> np.uint64(33)).astype(np.int32)


@lru_cache(4096)
def needed(n: int, miss: float = MISS, near: float = NEAR[0] / NEAR[1]) -> int:
    """Fewest equal values among ``n`` that keep the posterior probability of ``near`` or more at ``miss``.

    With a uniform prior the posterior of the similarity after m of n is Beta(m + 1, n - m + 1); its
    tail beyond ``near`` is the probability of at most m successes in n + 1 trials.
    """
    total = 0.0
    for m in range(n + 1):
        total += math.comb(n + 1, m) * near**m * (1 - near) ** (n + 1 - m)
        if total >= miss:
            return m
    return n


def prepared(documents: DataFrame) -> DataFrame:
    """(doc_id, text_key, n_shingles, hi, lo, sig): rows with one (hi, lo) have equal sets; an empty set has none.

    (hi, lo) is a 128-bit hash of the whole set. The signature holds 16 bits of each value: values that agree
    by chance, one in 65,536, can only add a candidate.
    """
    kind = "doc_id bigint, text_key bigint, n_shingles int, hi bigint, lo bigint, sig binary"

    def work(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {"n_shingles": [], "hi": [], "lo": [], "sig": []}
        for data in utf8(batch.column("text")):
            own = shingles(data)
            out["n_shingles"].append(len(own))
            key = hashlib.blake2b(own.tobytes(), digest_size=16).digest()
            out["hi"].append(int.from_bytes(key[:8], "little", signed=True) if len(own) else None)
            out["lo"].append(int.from_bytes(key[8:], "little", signed=True) if len(own) else None)
            out["sig"].append((signature(own) >> 15).astype(np.uint16).tobytes() if len(own) else None)
        return {"doc_id": batch.column("doc_id"), "text_key": batch.column("text_key"), **out}

    return per_batch(_keyed(documents), work, kind)


def _keyed(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text")


def _values(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Signatures, a row each."""
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, BANDS * ROWS)


def _keys(values: np.ndarray) -> np.ndarray:
    """A key for each signature and band, a hash of the band's number and values."""
    parts = values.reshape(-1, BANDS, ROWS)
    mixed = np.tile(np.arange(1, BANDS + 1, dtype=np.uint64), (len(values), 1))
    for r in range(ROWS):
        mixed = (mixed ^ parts[:, :, r].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(31)
    return mixed.view(np.int64)


def _bands(reps: DataFrame) -> DataFrame:
    """(id, n, band): a row per band."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                ids, n = (np.repeat(batch.column(c).to_numpy(), BANDS) for c in ("id", "n"))
                keys = _keys(_values(batch.column("sig")))
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(n), pa.array(keys.ravel())], ["id", "n", "band"])

    return reps.select("id", "n", "sig").mapInArrow(run, "id bigint, n int, band bigint")


CELL = ["band", "i", "j"]


def verified(cells: DataFrame, sig: DataFrame, texts: DataFrame, banded: bool) -> DataFrame:
    """Pairs (a, b) with near sets, enough to connect the components of all near pairs of each cell.

    ``cells``: (band, i, j, id, comp, n, side), side 1 is paired with side 2, side 3 is both. ``sig`` is (id, sig),
    ``texts`` (id, text). Signatures are compared in batches first, then the whole sets of what is left, each
    set once a cell. With ``banded`` a pair counts only where ``band`` is the first that it shares.
    """

    def screen(cell: pa.Table) -> pa.Table:
        ids, comp, n, side = (cell.column(c).to_numpy() for c in ("id", "comp", "n", "side"))
        values = _values(cell.column("sig"))
        keys = _keys(values) if banded else None
        n, band = n.astype(np.int64), cell.column("band")[0].as_py()
        right = np.flatnonzero(side & 2)
        out: dict[str, list] = {"a": [], "ca": [], "b": [], "cb": [], "fresh": []}
        seen = np.zeros(len(ids), bool)
        for x in np.flatnonzero(side & 1):
            alive = right[comp[right] != comp[x]]
            if side[x] == 3:
                alive = alive[(side[alive] == 2) | (ids[alive] > ids[x])]
            # sets of too different sizes cannot be near
            alive = alive[NEAR[1] * np.minimum(n[alive], n[x]) >= NEAR[0] * np.maximum(n[alive], n[x])]
            if banded:
                alive = alive[keys[x, (keys[alive] == keys[x]).argmax(axis=1)] == band]
            same = np.zeros(len(alive), int)
            for start in range(0, BANDS * ROWS, BATCH):
                end = min(start + BATCH, BANDS * ROWS)
                same += (values[alive, start:end] == values[x, start:end]).sum(axis=1)
                left = same >= needed(end)
                alive, same = alive[left], same[left]
            if len(alive):
                alive = alive[np.argsort(-same, kind="stable")]
                out["a"].append(ids[x])
                out["ca"].append(comp[x])
                out["b"].append(ids[alive])
                out["cb"].append(comp[alive])
                # a document is asked for once a cell
                met = np.append(alive, x)
                out["fresh"].append(ids[met[~seen[met]]])
                seen[met] = True
        own = {c: pa.array(np.repeat(cell.column(c)[0].as_py(), len(out["a"])), cell.schema.field(c).type) for c in CELL}
        many = pa.list_(pa.int64())
        kinds = {"a": pa.int64(), "ca": pa.int64(), "b": many, "cb": many, "fresh": many}
        return pa.table({**own, **{c: pa.array(out[c], kinds[c]) for c in kinds}})

    def confirm(hits: pa.Table, full: pa.Table) -> pa.Table:
        place = {x: k for k, x in enumerate(full.column("id").to_pylist())}
        text, sets, root = full.column("text"), {}, {}

        def own(x: int) -> np.ndarray:
            if x not in sets:
                sets[x] = shingles((text[place[x]].as_py() or "").encode())
            return sets[x]

        def find(c: int) -> int:
            while root.get(c, c) != c:
                c = root[c]
            return c

        out: dict[str, list] = {"a": [], "b": []}
        for a, ca, bs, cbs in zip(*(hits.column(c).to_pylist() for c in ("a", "ca", "b", "cb"))):
            for b, cb in zip(bs, cbs):
                x, y = find(ca), find(cb)
                if x == y:
                    continue
                s, t = own(a), own(b)
                both = len(np.intersect1d(s, t, assume_unique=True))
                if NEAR[1] * both >= NEAR[0] * (len(s) + len(t) - both):
                    root[max(x, y)] = min(x, y)
                    out["a"].append(a)
                    out["b"].append(b)
        return pa.table({c: pa.array(out[c], pa.int64()) for c in out})

    kind = "band bigint, i int, j int, a bigint, ca bigint, b array<bigint>, cb array<bigint>, fresh array<bigint>"
    hits = materialize(cells.join(sig, "id").groupBy(*CELL).applyInArrow(screen, kind), "hits")
    each = hits.select(*CELL, F.explode("fresh").alias("id"))
    full = each.join(texts, "id").toDF("id", *(f"of_{c}" for c in CELL), "text")
    return hits.drop("fresh").groupBy(*CELL).cogroup(full.groupBy(*full.columns[1:4])).applyInArrow(confirm, "a bigint, b bigint")


def components(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(id, comp): smallest id reachable, by alternating large and small stars over the links.

    Each round joins and groups narrow rows only; partial aggregation takes hubs apart.
    """
    edges = materialize(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    before = None
    while True:
        # large star: every larger neighbour goes to the smallest of the neighbourhood
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: smaller neighbours and the node itself go to the smallest of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        edges = materialize(
            joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(least.select("u", F.col("m").alias("v")))
            .where("u <> v")
            .distinct(),
            "stars",
        )
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    roots = edges.groupBy("u").agg(F.min("v").alias("comp"))
    return nodes.select("id").join(roots.withColumnRenamed("u", "id"), "id", "left").select(
        "id", F.coalesce("comp", "id").alias("comp")
    )


def _parts(members: str, weight: str) -> Column:
    return F.ceil(F.greatest(F.expr(members) / MEMBERS, F.expr(weight) / WEIGHT)).cast("int")


def _part(parts: str) -> Column:
    return F.expr(f"cast(pmod(xxhash64('part', id), {parts}) as int)")


def _stars(members: DataFrame, turn: int) -> DataFrame:
    """Cells of each group's members and one centre, chosen by a hash of the id that changes by turn.

    ``members``: (band, id, n, comp). Members that already belong with the centre are left out. The hash does
    not know the band, so documents that share many bands mostly meet the same centre in all of them. The
    members of a centre are split, and the centre goes to each part; ``band`` is the centre's id.
    """
    order = F.struct(F.xxhash64(F.lit(turn), "id").alias("h"), "id", "n", "comp")
    centre = members.groupBy("band").agg(F.min(order).alias("c"))
    met = members.join(centre, "band").where("c.comp <> comp")
    met = met.select(F.col("c.id").alias("band"), "id", "n", "comp", F.col("c.n").alias("cn"), F.col("c.comp").alias("cc")).distinct()
    sized = met.groupBy("band").agg(F.count("*").alias("m"), F.sum("n").alias("w"), F.max("cn").alias("cn"), F.max("cc").alias("cc"))
    sized = sized.select("band", _parts("m", "w").alias("parts"), "cn", "cc")
    zero, one, two = (F.lit(k).alias(c) for k, c in ((0, "j"), (1, "side"), (2, "side")))
    part = F.explode(F.expr("sequence(0, parts - 1)")).alias("i")
    centres = sized.select("band", part, zero, F.col("band").alias("id"), F.col("cc").alias("comp"), F.col("cn").alias("n"), one)
    own = met.join(sized.select("band", "parts"), "band").select("band", _part("parts").alias("i"), zero, "id", "comp", "n", two)
    return centres.unionByName(own)


def _across(members: DataFrame) -> DataFrame:
    """Cells in which all pairs of different components inside a group meet.

    The members outside the group's largest component meet that component, and each other. Both sides are split
    into parts; cell (i, j) is part i of the others and part j of the largest component, which for j = 0
    pairs the others of part i too, and from j = its number of parts on, two parts of the others.
    """
    by = members.groupBy("band", "comp").agg(F.count("*").alias("m"), F.sum("n").alias("w"))
    top = by.groupBy("band").agg(F.max(F.struct("m", "w", "comp")).alias("top"), F.sum("m").alias("m"), F.sum("w").alias("w"))
    sized = top.select(
        "band", F.col("top.comp").alias("main"), _parts("top.m", "top.w").alias("mains"), _parts("m - top.m", "w - top.w").alias("others")
    )
    own = members.join(sized, "band").withColumn("part", _part("if(comp = main, mains, others)"))
    inside = "transform(sequence(0, others - 1), x -> struct(x as i, part as j, 2 as side))"
    first = "transform(sequence(0, mains - 1), x -> struct(part as i, x as j, if(x = 0, 3, 1) as side))"
    among = """transform(filter(sequence(0, others - 1), x -> x <> part),
               x -> struct(least(x, part) as i, mains + greatest(x, part) as j, if(part < x, 1, 2) as side))"""
    cell = F.explode(F.expr(f"if(comp = main, {inside}, concat({first}, {among}))")).alias("c")
    return own.select("band", "id", "comp", "n", cell).select("band", "c.i", "c.j", "id", "comp", "n", "c.side")


TURNS = 2


def _classes(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The sets of all rows, and with them (hi, lo, component_id) for each distinct set."""
    sets = materialize(prepared(documents), "sets")
    head = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_key")).alias("head")
    classes = sets.where("hi IS NOT NULL").groupBy("hi", "lo").agg(head, F.first("n_shingles").alias("n"), F.first("sig").alias("sig"))
    # ids are fixed by being written
    heads = materialize(
        classes.select(F.monotonically_increasing_id().alias("id"), "hi", "lo", "head.doc_id", "head.text_key", "n", "sig"), "classes"
    )
    bands = _bands(heads)
    shared = bands.groupBy("band").agg(F.count("*").alias("n")).where("n > 1").select("band")
    members = materialize(bands.join(shared, "band"), "bands")
    linked = materialize(members.select("id").distinct(), "candidates")
    own = heads.join(linked, "id")
    sig = own.select("id", "sig")
    key = own.select(F.col("doc_id").alias("head_id"), F.col("text_key").alias("head_key"), "id")
    texts = materialize(
        _keyed(documents)
        .join(key, F.expr("doc_id <=> head_id AND text_key = head_key"))
        .dropDuplicates(["id"])
        .select("id", "text"),
        "texts",
    )
    links = None
    state = members.withColumn("comp", F.col("id"))
    for turn in range(TURNS + 1):
        cells = _stars(state, turn) if turn < TURNS else _across(state)
        found = verified(cells, sig, texts, turn == TURNS)
        links = materialize(found if links is None else links.unionByName(found), "near")
        comps = materialize(components(linked, links), "components")
        if turn == TURNS:
            break
        # groups that hang together are done
        state = members.join(comps, "id")
        spread = state.groupBy("band").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x <> y")
        state = materialize(state.join(spread.select("band"), "band"), "open")
        if not state.limit(1).count():
            break
    named = heads.select("id", "hi", "lo", "doc_id").join(comps, "id", "left").withColumn("comp", F.coalesce("comp", "id"))
    least = named.groupBy("comp").agg(F.min("doc_id").alias("component_id"))
    return sets, named.join(least, "comp").select("hi", "lo", "component_id")


def _judged(documents: DataFrame) -> DataFrame:
    sets, named = _classes(documents)
    out = sets.select("doc_id", "text_key", "n_shingles", "hi", "lo").join(named, ["hi", "lo"], "left")
    component = F.when(F.col("hi").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select(
        "doc_id",
        "text_key",
        F.col("n_shingles").cast("long").alias("n_shingles"),
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
    )


def groups(documents: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row."""
    return _judged(documents).drop("text_key")


def keep_one(documents: DataFrame) -> DataFrame:
    """One document of each group, with all its columns, decided by row: id and text. Rows that repeat the
    kept id in its group count as one document, as do rows without an id in a group that has none."""
    return without(documents, _judged(documents).where("NOT kept").select("doc_id", "text_key"))
