"""Trees against plain versions that look at every row and every cut, at several partitionings."""

import math

import numpy as np
import pyarrow as pa
import pytest

from lendlens.operators import trees
from lendlens.session import scratch, work_dir


def table(spark, x, y, parts=3):
    rows = [(i, int(v), [float(a) for a in r], 0) for i, (r, v) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id bigint, y int, f array<double>, gain int").repartition(parts)


def made(n, seed, features=4):
    draw = np.random.default_rng(seed)
    x = np.round(draw.normal(size=(n, features)), 2)
    p = 1 / (1 + np.exp(-(1.5 * x[:, 0] - x[:, 1] * x[:, 2])))
    return x, (draw.random(n) < p).astype(int)


def told(tree):
    return list(zip(tree.feature, np.round(tree.cut, 9), tree.left, tree.right, np.round(tree.value, 9)))


def same(model, other):
    return [told(t) for t in model.trees] == [told(t) for t in other.trees]


# ---- boosting


def plain_tree(x, g, h, settings):
    """Best gain first, one leaf at a time, every cut of every feature; {path: (feature, cut)}, {path: value}."""
    def best(rows, depth):
        if depth >= settings.depth:
            return None
        out = None
        for f in range(x.shape[1]):
            values = np.unique(x[:, f])
            for cut in (values[:-1] + values[1:]) / 2:
                left = x[rows, f] <= cut
                a, b = rows[left], rows[~left]
                if not len(a) or not len(b) or min(len(a), len(b)) < settings.min_rows or min(h[a].sum(), h[b].sum()) < settings.min_curvature:
                    continue
                size = (lambda r: h[r].sum()) if settings.newton else len
                gain = g[a].sum() ** 2 / size(a) + g[b].sum() ** 2 / size(b) - g[rows].sum() ** 2 / size(rows)
                if gain > 1e-9 and (out is None or gain > out[0] * (1 + 1e-9)):
                    out = gain, f, cut, a, b
        return out

    leaves, splits = {1: np.arange(len(x))}, {}
    found = {1: best(leaves[1], 0)}
    while len(leaves) < settings.leaves:
        open_ = [p for p in leaves if found[p]]
        if not open_:
            break
        path = min(open_, key=lambda p: (-found[p][0], p))
        _, f, cut, a, b = found[path]
        splits[path] = (f, round(float(cut), 9))
        del leaves[path]
        for k, rows in enumerate((a, b)):
            leaves[2 * path + k] = rows
            found[2 * path + k] = best(rows, (2 * path + k).bit_length() - 1)
    return splits, {p: -settings.rate * g[r].sum() / h[r].sum() for p, r in leaves.items()}


def by_path(tree):
    splits, values, todo = {}, {}, [(0, 1)]
    while todo:
        node, path = todo.pop()
        if tree.feature[node] >= 0:
            splits[path] = (tree.feature[node], round(tree.cut[node], 9))
            todo += [(tree.left[node], 2 * path), (tree.right[node], 2 * path + 1)]
        else:
            values[path] = tree.value[node]
    return splits, values


SETTINGS = [
    trees.Boosting(rounds=3, leaves=9, min_rows=5),
    trees.Boosting(rounds=3, leaves=8, depth=3, min_rows=1, min_curvature=0.0, newton=False),
]


@pytest.mark.parametrize("settings", SETTINGS)
@pytest.mark.parametrize("node_bytes", [0, 200, 10_000])
def test_boosting_like_plain(spark, monkeypatch, settings, node_bytes):
    """In passes only, with small nodes in one task, and all in one task."""
    monkeypatch.setattr(trees, "NODE_BYTES", node_bytes)
    monkeypatch.setattr(trees, "REFRESH", 2)
    x, y = made(200, 1)
    model = settings.fit(table(spark, x, y), "f", "id", "y")
    raw = np.full(len(y), math.log(y.sum() / (len(y) - y.sum())))
    assert model.base == pytest.approx(raw[0])
    for tree in model.trees:
        p = 1 / (1 + np.exp(-raw))
        splits, values = plain_tree(x, p - y, p * (1 - p), settings)
        got = by_path(tree)
        assert got[0] == splits
        assert got[1] == pytest.approx(values, abs=1e-6)  # the closed form of each leaf
        raw += tree.values(x)


def test_leaves_of_a_newton_step_lower_the_loss(spark):
    x, y = made(400, 3)
    model = trees.Boosting(rounds=12, leaves=32, depth=5, min_rows=1, min_curvature=0.0, newton=False).fit(
        table(spark, x, y), "f", "id", "y"
    )

    def loss(raw):
        return float(np.mean(np.logaddexp(0, raw) - y * raw))

    raw = np.full(len(y), model.base)
    plain = raw.copy()  # the same trees with the mean residual in each leaf
    for tree in model.trees:
        leaf = tree.walk(x)
        p = 1 / (1 + np.exp(-plain))
        sums, sizes = np.bincount(leaf, y - p), np.bincount(leaf)
        raw += tree.values(x)
        plain += 0.1 * (sums / np.maximum(sizes, 1))[leaf]
        assert loss(raw) <= loss(plain)


def test_leaf_wise_goes_deep_where_it_is_needed(spark):
    """A staircase on one side of the first cut: 31 leaves by gain follow it, 32 by level cannot."""
    draw = np.random.default_rng(4)
    n = 4_000
    x = np.column_stack([draw.random(n) * 2 - 1, draw.random(n)])
    y = np.where(x[:, 0] < 0, 0, (x[:, 1] * 48).astype(int) % 2)
    df = table(spark, x, y)
    by_gain = trees.Boosting(rounds=1, rate=1.0, leaves=31, min_rows=1, bins=255).fit(df, "f", "id", "y")
    by_level = trees.Boosting(rounds=1, rate=1.0, leaves=32, depth=5, min_rows=1, bins=255).fit(df, "f", "id", "y")
    gain_loss, level_loss = (np.mean((m.probability(x) - y) ** 2) for m in (by_gain, by_level))
    assert max(by_gain.trees[0].depth) > 5 and gain_loss < 0.9 * level_loss


# ---- forests


def plain_forest_tree(forest, number, x, y, keys, cuts_of):
    """The same draws, row by row; {path: (feature, cut)} and {path: share}."""
    n, width = x.shape
    take = forest.features or max(1, math.isqrt(width))
    weight = np.ones(n) if forest.random_cuts else trees.bag(keys, number, forest.seed).astype(float)
    tree = trees.Tree()
    todo, later = [(0, np.flatnonzero(weight > 0), 0)], []
    while todo:
        for node, rows, tried in sorted(todo, key=lambda t: t[0]):
            w, s = weight[rows].sum(), (weight * y)[rows].sum()
            tree.value[node] = s / w if w else 0.0
            if tree.depth[node] >= forest.depth or w < 2 or not 0 < s < w:
                continue
            order = np.argsort(trees.hashed(forest.seed, number, node, np.arange(width)), kind="stable")
            own = order[tried * take : (tried + 1) * take]
            best = None
            for f in own if len(own) == take else order[width - take :]:
                for cut in cuts_of(number, node, int(f), x[rows, f]):
                    a, b = rows[x[rows, f] <= cut], rows[x[rows, f] > cut]
                    if not len(a) or not len(b):
                        continue
                    gain = sum((weight * y)[r].sum() ** 2 / weight[r].sum() for r in (a, b)) - s * s / w
                    if gain > 1e-9 * max(1, s * s / w) and (best is None or gain > best[0] * (1 + 1e-12)):
                        best = gain, int(f), cut, a, b
            if best is None:
                if (tried + 1) * take < width:
                    later.append((node, rows, tried + 1))
                continue
            later += [(c, r, 0) for c, r in zip(tree.split(node, best[1], float(best[2])), best[3:])]
        todo, later = later, []
    return tree


def xx(spark, n):
    from pyspark.sql import functions as F

    return np.array([r[0] for r in spark.range(n).select(F.xxhash64("id")).collect()])


@pytest.mark.parametrize("random_cuts", [False, True])
def test_forest_like_plain_at_any_partitioning(spark, random_cuts):
    x, y = made(160, 7, 9)
    x[:, 8] = 1.0  # a constant feature never splits
    forest = trees.Forest(trees=5, depth=5, bins=255, random_cuts=random_cuts)
    models = [forest.fit(table(spark, x, y, parts), "f", "id", "y") for parts in (1, 4, 20)]
    assert same(models[0], models[1]) and same(models[0], models[2])
    values = [np.unique(x[:, f]) for f in range(9)]

    def cuts(number, node, f, own):
        if not random_cuts:
            return (values[f][:-1] + values[f][1:]) / 2
        low, high = own.min(), own.max()
        cut = low + float(trees.uniform(forest.seed, number, node, f, 1)) * (high - low)
        return [cut] if cut < high else [low]

    for number, tree in enumerate(models[0].trees):
        want = plain_forest_tree(forest, number, x, y, xx(spark, len(x)), cuts)
        assert by_path(tree)[0] == by_path(want)[0]
        assert by_path(tree)[1] == pytest.approx(by_path(want)[1])


def test_boosting_at_any_partitioning(spark, monkeypatch):
    x, y = made(500, 9)
    settings = trees.Boosting(rounds=4, leaves=7)
    once = settings.fit(table(spark, x, y, 1), "f", "id", "y")
    monkeypatch.setattr(trees, "NODE_BYTES", 600)
    monkeypatch.setattr(trees, "TASK_BYTES", 1_000)  # sums are added up by a shuffle
    monkeypatch.setattr(trees, "DIRECT", 2)
    assert same(once, settings.fit(table(spark, x, y, 16), "f", "id", "y"))


def test_bags_are_poisson():
    weight = np.concatenate([trees.bag(np.arange(20_000), t, 42) for t in range(5)])
    assert abs(weight.mean() - 1) < 0.02 and abs(weight.var() - 1) < 0.03


def test_bin_limits(spark):
    x = np.column_stack([np.arange(1000) % 3, np.arange(1000)])
    few, many = trees.bin_limits(table(spark, x, [0] * 1000, 7), "f", "id", 16)
    assert list(few) == [0.5, 1.5]
    assert len(many) == 15 and (np.bincount(np.searchsorted(many, np.arange(1000))) <= 64).all()


@pytest.mark.parametrize("grower", [trees.Forest(trees=2), trees.Forest(trees=2, random_cuts=True), trees.Boosting(rounds=2)])
def test_odd_tables(spark, tmp_path, grower):
    x, y = made(30, 2)
    empty = grower.fit(table(spark, x, y).limit(0), "f", "id", "y")
    one = grower.fit(table(spark, x, [1] * 30), "f", "id", "y")
    flat = grower.fit(table(spark, x * 0, y), "f", "id", "y")
    assert set(empty.probability(x)) <= {0.0, 0.5} and (one.probability(x) > 0.99).all()
    assert np.ptp(flat.probability(x)) == 0
    flat.save(spark, str(tmp_path / "m"))
    again = trees.TreeModel.load(spark, str(tmp_path / "m"))
    assert (again.probability(x) == flat.probability(x)).all()


# ---- tasks and walks


def test_rows_that_are_worth_it_use_every_core(spark):
    cores = spark.sparkContext.defaultParallelism
    assert trees._tasks(spark, 100, 80) == 1
    assert trees._tasks(spark, 1_000_000, 80) == cores
    assert trees._tasks(spark, 100_000_000, 80) > cores
    x, y = made(3 * trees.TASK_ROWS, 5)
    rows = table(spark, x, y, 1)
    stored = trees._stored(rows, "f", "id", "y", trees.bin_limits(rows, "f", "id", 16), 3)
    assert stored.count() == len(x) and stored.rdd.getNumPartitions() > 1


def test_walk_like_plain():
    draw = np.random.default_rng(3)
    tree = trees.Tree()
    for node in (0, 2, 4, 6, 8, 10, 1, 13):  # a chain longer than the steps between two looks, and a side branch
        tree.split(node, int(draw.integers(3)), float(draw.normal()))
    x = draw.normal(size=(500, 3))
    x[::50, 1] = np.nan  # goes right

    def plain(row):
        node = 0
        while tree.feature[node] >= 0:
            node = tree.left[node] if row[tree.feature[node]] <= tree.cut[node] else tree.right[node]
        return node

    assert tree.walk(x).tolist() == [plain(r) for r in x]
    assert trees.Tree().walk(x).tolist() == [0] * len(x)
    assert tree.walk(x[:0]).tolist() == []


# ---- blocks and passing tables


def folders(spark, name):
    import os

    return {f for f in os.listdir(work_dir(spark).removeprefix("file:")) if f.startswith(name)}


def test_train_rows_lie_in_blocks_of_bytes(spark):
    x, y = made(3000, 5)
    rows = table(spark, x, y, 4)
    stored = trees._blocks(trees._stored(rows, "f", "id", "y", None, 2))
    assert stored.count() <= 4
    names = [pa.array(c) for c in zip(*[[bytes(v) for v in r] for r in stored.collect()])]
    blocks = list(trees._rows([pa.RecordBatch.from_arrays(names, ["key", "y", "raw", "x"])], float))
    back = np.concatenate([np.column_stack([b[1], b[3]]) for b in blocks])
    assert sorted(map(tuple, back)) == sorted(map(tuple, np.column_stack([y, x])))


def test_tables_of_earlier_rounds_are_deleted(spark, monkeypatch):
    monkeypatch.setattr(trees, "REFRESH", 2)
    x, y = made(400, 4)
    before, seen = folders(spark, "train"), []

    def counting(*args, plain=trees.materialize, **options):
        seen.append(len(folders(spark, "train") - before))
        return plain(*args, **options)

    monkeypatch.setattr(trees, "materialize", counting)
    with scratch(spark):
        model = trees.Boosting(rounds=9, leaves=4, min_rows=5).fit(table(spark, x, y, 2), "f", "id", "y")
    assert len(model.trees) == 9 and len(seen) == 5 and max(seen) == 1
    assert folders(spark, "train") == before


def test_small_nodes_are_finished_in_one_pass(spark, monkeypatch):
    x, y = made(3000, 5)
    rows = table(spark, x, y, 3)
    whole = trees.Boosting(rounds=1, leaves=20, min_rows=5).fit(rows, "f", "id", "y")
    monkeypatch.setattr(trees, "NODE_BYTES", 5 * 1000)
    passes, plain = [], trees.Boosting._finished
    monkeypatch.setattr(trees.Boosting, "_finished", lambda self, *a: passes.append(list(a[2])) or plain(self, *a))
    parted = trees.Boosting(rounds=1, leaves=20, min_rows=5).fit(rows, "f", "id", "y")
    assert (parted.probability(x) == whole.probability(x)).all()
    assert len(passes) == 1 and len(passes[0]) > 2
