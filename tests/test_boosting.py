"""Boosted trees against a plain trainer, Shapley values over all coalitions, and DuckDB."""

import itertools
import math
import pickle
import random
import time

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from stayline.operators import boosting as b
from stayline.operators.boosting import Params

INPUTS = ["x0", "x1", "x2", "x3"]


@pytest.fixture(scope="module")
def made(spark):
    rng = random.Random(4)
    rows = []
    for i in range(900):
        x = [rng.randint(0, 5), rng.randint(0, 2), round(rng.random(), 2), rng.choice([None, 1.0, 2.0, 7.5])]
        risk = 0.15 + 0.5 * (x[0] > 2) * (x[1] == 1) + 0.2 * (x[3] == 7.5)
        rows.append((i, *x, int(rng.random() < risk)))
    frame = spark.createDataFrame(rows, "id long, x0 int, x1 int, x2 double, x3 double, y int").repartition(5).cache()
    return frame, rows


def values(rows):
    return np.array([[math.nan if v is None else float(v) for v in r[1:5]] for r in rows])


def plain_tree(bins, g, h, limits, p):
    """One tree, one split at a time, every sum from the rows."""
    def thresholded(s):
        return math.copysign(max(abs(s) - p.l1, 0), s)

    def score(s, t):
        return thresholded(s) ** 2 / max(t + p.l2, 1e-12)

    def splits(rows):
        out = {}
        for f, n in enumerate(limits):
            for border in range(n):
                left, right = rows[bins[rows, f] <= border], rows[bins[rows, f] > border]
                if min(len(left), len(right)) >= max(p.minInstancesPerNode, 1) and min(h[left].sum(), h[right].sum()) / 2**24 >= p.minHessian:
                    sums = [(g[r].sum() / 2**24, h[r].sum() / 2**24) for r in (left, right, rows)]
                    out[f, border] = score(*sums[0]) + score(*sums[1]) - score(*sums[2])
        return out

    def best(found):
        if not found:
            return None
        top = max(found.values())
        return None if top <= 1e-9 else next((k, v) for k, v in sorted(found.items()) if v == top)

    def value(rows):
        return -thresholded(g[rows].sum() / 2**24) / max(h[rows].sum() / 2**24 + p.l2, 1e-12) * p.stepSize if len(rows) else 0.0

    nodes = [np.arange(len(bins))]
    depths, kids = [0], {}
    if p.growth == "symmetric":
        level = [0]
        for _ in range(p.maxDepth):
            every = [splits(nodes[k]) for k in level]
            total = {}
            for found in every:
                for k, v in found.items():
                    total[k] = total.get(k, 0) + v
            if not total or max(total.values()) <= 1e-9:
                break
            top = max(total.values())
            f, border = next(k for k, v in sorted(total.items()) if v >= top - 1e-12)
            new = []
            for k in level:
                kids[k] = (f, border, len(nodes), len(nodes) + 1)
                new += [len(nodes), len(nodes) + 1]
                nodes += [nodes[k][bins[nodes[k], f] <= border], nodes[k][bins[nodes[k], f] > border]]
            level = new
    else:
        leaves = 1
        while leaves < p.maxLeaves:
            able = {k: best(splits(nodes[k])) for k in range(len(nodes)) if k not in kids and depths[k] < p.maxDepth}
            able = {k: v for k, v in able.items() if v}
            if not able:
                break
            k = max(able, key=lambda k: able[k][1]) if p.growth == "leaf" else min(able, key=lambda k: depths[k])
            (f, border), _ = able[k]
            kids[k] = (f, border, len(nodes), len(nodes) + 1)
            nodes += [nodes[k][bins[nodes[k], f] <= border], nodes[k][bins[nodes[k], f] > border]]
            depths += [depths[k] + 1] * 2
            leaves += 1
    out = {}
    for k, rows in enumerate(nodes):
        if k not in kids and len(rows):
            out[frozenset(rows.tolist())] = round(value(rows), 9)
    return out


@pytest.mark.parametrize("params", [
    Params(growth="leaf", maxLeaves=9, maxDepth=99, minInstancesPerNode=20, l1=0.1, l2=0.1),
    Params(growth="leaf", maxLeaves=127, maxDepth=99, minInstancesPerNode=40, l2=1.0, subsamplingRate=0.8),
    Params(growth="depth", maxDepth=4, minHessian=3.0, l1=0.5, l2=2.0),
    Params(growth="symmetric", maxDepth=3, l2=3.0),
])
def test_tree_equals_plain_trainer(made, params, monkeypatch):
    frame, rows = made
    borders, kinds = b.find_borders(frame, INPUTS, params.maxBins)
    assert kinds == [6, 3, None, 3] and len(borders[2]) <= 63
    bins = b.binned(values(rows), borders)
    y = np.array([r[5] for r in rows])
    base = math.log(y.mean() / (1 - y.mean()))
    p = 1 / (1 + math.exp(-base))
    drawn = b.sampled(np.array([r[0] for r in rows]), params.subsamplingRate, params.seed, 0)
    assert abs(drawn.mean() - params.subsamplingRate) < 0.05
    g, h = np.round((p - y) * 2**24), np.round(np.full(len(y), p * (1 - p)) * 2**24)
    want = plain_tree(bins[drawn], g[drawn], h[drawn], [len(x) for x in borders], params)
    for few in (32, 0):
        monkeypatch.setattr(b, "FEW_TASKS", few)
        held = b.Rows(b.encode(frame, INPUTS, borders, "y", F.col("id"), base), len(INPUTS))
        tree = b.Grower(held, borders, params, 0).grow()
        held.close()
        at = tree.leaves(bins[drawn])
        got = {frozenset(np.flatnonzero(at == leaf).tolist()): round(tree.value[leaf], 9) for leaf in np.unique(at)}
        assert got == want
        inner = tree.feature >= 0
        assert (~inner).sum() <= params.maxLeaves and tree.rows[~inner].min() >= (params.minInstancesPerNode if params.growth != "symmetric" else 0)
        assert (tree.rows[tree.left[inner]] + tree.rows[tree.right[inner]] == tree.rows[inner]).all()


def test_best_prefix_and_columns(spark, made, tmp_path):
    frame, rows = made
    train, valid = frame.where("id % 3 > 0"), frame.where("id % 3 = 0")
    params = Params(stepSize=0.3, maxIter=60, maxDepth=3, patience=8, columnRate=0.5, subsamplingRate=0.7, resampleEvery=5, l2=1.0, metrics=("auc_roc", "auc_pr"))
    model = b.fit(train, valid, INPUTS, "y", F.col("id"), params)
    history, best = model.history, model.best_round
    assert [h["round"] for h in history] == list(range(1, len(history) + 1)) and len(history) < 60
    assert best == b.stopped(history, params.metrics, params.patience)
    # a run of so many rounds gives the same trees
    again = b.fit(train, None, INPUTS, "y", F.col("id"), Params(**{**vars(params), "maxIter": best}))
    assert len(again.trees) == best
    for x, y in zip(model.trees, again.trees):
        assert np.array_equal(x.feature, y.feature) and np.array_equal(x.value, y.value)
        assert len(set(x.feature[x.feature >= 0])) <= 2  # half of the inputs per tree
    # what the history says is what the scores say
    held = [r for r in rows if r[0] % 3 == 0]
    p = 1 / (1 + np.exp(-model.margins(model.bins(values(held)))))
    label = np.array([r[5] for r in held])
    pairs = [(s > t) + 0.5 * (s == t) for s in p[label == 1] for t in p[label == 0]]
    said = history[best - 1]
    assert said["auc_roc"] == pytest.approx(np.mean(pairs), abs=1e-3)
    assert said["loss"] == pytest.approx(-np.mean(np.log(np.where(label == 1, p, 1 - p))), abs=1e-6)
    scored = {r.id: r.m for r in b.with_margin(model, valid, "m").select("id", "m").collect()}
    assert np.allclose([scored[r[0]] for r in held], np.log(p / (1 - p)))
    model.save(spark, str(tmp_path / "m"))
    loaded = b.Trees.load(spark, str(tmp_path / "m"))
    assert np.array_equal(loaded.margins(loaded.bins(values(held))), model.margins(model.bins(values(held))))
    assert loaded.history == history and loaded.inputs == INPUTS and loaded.values == model.values


def test_patience():
    def run(*aucs, other=None):
        return [{"round": k + 1, "auc_roc": a, "auc_pr": (other or aucs)[k], "loss": 0} for k, a in enumerate(aucs)]

    assert b.stopped(run(0.5, 0.7, 0.6, 0.6), ("auc_roc",), 2) == 2
    assert b.stopped(run(0.5, 0.7, 0.6, 0.8), ("auc_roc",), 2) is None
    assert b.stopped(run(0.5, 0.6, 0.7, 0.8, other=(0.9, 0.1, 0.1, 0.1)), ("auc_roc", "auc_pr"), 3) == 1
    assert b.stopped(run(0.7, 0.7, 0.7), ("auc_roc",), 2) == 1 and b.best_round(run(0.1, 0.7, 0.7), "auc_roc") == 2
    assert b.best_round([], "auc_roc") == 0


def coalition_margin(model, x, known):
    """Expected margin when only some inputs are known."""
    def walk(tree, node):
        f = tree.feature[node]
        if f < 0:
            return tree.value[node]
        if f in known:
            return walk(tree, tree.left[node] if x[f] <= tree.bin[node] else tree.right[node])
        left, right = tree.left[node], tree.right[node]
        return (tree.rows[left] * walk(tree, left) + tree.rows[right] * walk(tree, right)) / tree.rows[node]

    return model.base + sum(walk(t, 0) for t in model.trees)


def test_contributions_are_shapley_values(spark, made):
    frame, rows = made
    model = b.fit(frame, None, INPUTS, "y", F.col("id"), Params(growth="leaf", maxDepth=9, maxIter=4, maxLeaves=12, minInstancesPerNode=10, stepSize=0.3))
    bins = model.bins(values(rows))
    got = model.contributions(bins)
    assert np.allclose(got.sum(axis=1), model.margins(bins))
    n = len(INPUTS)
    for i in range(0, 900, 45):
        for f in range(n):
            others, want = [k for k in range(n) if k != f], 0.0
            for size in range(n):
                for s in itertools.combinations(others, size):
                    gain = coalition_margin(model, bins[i], {*s, f}) - coalition_margin(model, bins[i], set(s))
                    want += gain / (n * math.comb(n - 1, size))
            assert got[i, f] == pytest.approx(want, abs=1e-9)
    out = {r.id: r for r in b.with_contributions(model, frame, ["id"]).collect()}
    assert all(np.allclose(out[r[0]].contributions, got[k, :n]) and out[r[0]].base == pytest.approx(got[k, n]) for k, r in enumerate(rows))
    means = {r.feature: r.importance for r in b.mean_contributions(model, frame).collect()}
    assert np.allclose([means[x] for x in INPUTS], np.abs(got[:, :n]).mean(axis=0))
    assert {r.importance for r in b.mean_contributions(model, frame.limit(0)).collect()} == {0.0}


def test_leaf_rules_by_sql(spark, made):
    """At most 127 leaves, none with fewer than 200 rows, values between those of their rows."""
    frame, _ = made
    many = frame.crossJoin(spark.range(6).withColumnRenamed("id", "copy")).withColumn("id", F.col("id") * 10 + F.col("copy"))
    params = Params(growth="leaf", maxDepth=99, maxLeaves=127, minInstancesPerNode=200, columnRate=0.8, subsamplingRate=0.8, resampleEvery=5, l1=0.1, l2=0.1, maxIter=7)
    model = b.fit(many, None, INPUTS, "y", F.col("id"), params)
    nodes = model.node_table(spark).toPandas()  # noqa: F841
    bad = duckdb.sql("""
      SELECT count(*) FROM (SELECT tree, count(*) FILTER (feature IS NULL) AS leaves, min(rows) FILTER (feature IS NULL) AS least,
        max(rows) AS whole, sum(rows) FILTER (feature IS NULL) AS below FROM nodes GROUP BY tree)
      WHERE leaves > 127 OR leaves < 2 OR least < 200 OR whole <> below""").fetchall()[0][0]
    assert bad == 0 and nodes.tree.nunique() == 7
    whole = duckdb.sql("SELECT tree, max(rows) FROM nodes GROUP BY tree ORDER BY tree").fetchall()
    assert len({n for _, n in whole[:5]}) == 1 and whole[5][1] != whole[4][1]  # rows are drawn anew every five rounds


def test_empty_and_constant(spark, made):
    frame, _ = made
    with pytest.raises(ValueError):
        b.fit(frame.limit(0), None, INPUTS, "y", F.col("id"), Params(maxIter=2))
    one = b.fit(frame.withColumn("x0", F.lit(1)), frame.limit(0), ["x0"], "y", F.col("id"), Params(maxIter=3))
    assert all(len(t.feature) == 1 for t in one.trees)
    none = b.fit(frame, None, [], "y", F.col("id"), Params(maxIter=2))
    assert b.with_margin(none, frame, "m").select("m").distinct().count() == 1
    with pytest.raises(ValueError):
        b.find_borders(frame, INPUTS, 300)


@pytest.mark.parametrize("rows", [0, 7, 3000])
def test_cell_sums_of_few_and_many_rows(rows):
    rng = np.random.default_rng(rows)
    bins, at = rng.integers(0, 6, (rows, 4)).astype(np.uint8), rng.integers(0, 3, rows)
    gradient, hessian = rng.integers(-1 << 24, 1 << 24, rows).astype(float), rng.integers(0, 1 << 22, rows).astype(float)
    wanted = np.zeros((3, 3, 4, 6), np.int64)
    for row, place, g, h in zip(bins, at, gradient, hessian):
        for column, cell in enumerate(row):
            wanted[place, :, column, cell] += np.array([g, h, 1], np.int64)
    assert (b.cell_sums(bins, at, gradient, hessian, 3, 6) == wanted.reshape(3, 3, 24)).all()


def test_histograms_stay_off_the_driver(spark, made, monkeypatch):
    """The driver gets splits and metrics, a small part of 30 inputs x 64 bins x 24 bytes a leaf."""
    frame, _ = made
    wide = frame.select("id", "y", *(F.rand(k).alias(f"r{k}") for k in range(30))).cache()
    inputs, got, collect = [f"r{k}" for k in range(30)], [], type(frame).collect

    def counted(self):
        rows = collect(self)
        got.append(len(pickle.dumps([tuple(r) for r in rows])))
        return rows

    monkeypatch.setattr(type(frame), "collect", counted)
    sizes = []
    for few in (0, 32):
        monkeypatch.setattr(b, "FEW_TASKS", few)
        model = b.fit(wide, wide, inputs, "y", F.col("id"), Params(maxIter=3, maxDepth=3))
        assert len(model.history) == 3 and all(len(t.feature) > 3 for t in model.trees)
        sizes.append(sum(got))
        got.clear()
    assert max(sizes) < 200_000


@pytest.mark.parametrize("params", [
    Params(growth="leaf", maxDepth=1 << 30, maxLeaves=31, minInstancesPerNode=10, columnRate=0.7, subsamplingRate=0.8, resampleEvery=5, l1=0.1, l2=0.1, maxIter=11),
    Params(growth="depth", maxDepth=4, minHessian=1.0, columnRate=0.7, subsamplingRate=0.8, l1=0.1, l2=0.1, maxIter=11),
    Params(growth="symmetric", maxDepth=4, l2=3.0, maxIter=11),
])
def test_few_rows_are_boosted_in_one_task(spark, made, params, monkeypatch):
    """Ten trees a pass, not a pass or more for each of their levels, and the trees that passes give."""
    frame, _ = made
    train, valid = frame.where("id % 3 > 0"), frame.where("id % 3 = 0")
    calls, collect = [], type(frame).collect
    monkeypatch.setattr(type(frame), "collect", lambda self: calls.append(1) or collect(self))
    model = b.fit(train, valid, INPUTS, "y", F.col("id"), params)
    assert len(calls) <= 10  # mean, borders, and twice trees and held-out metrics
    monkeypatch.setattr(b, "FEW_TASKS", 0)
    again = b.fit(train, valid, INPUTS, "y", F.col("id"), params)
    assert len(model.trees) == len(again.trees) and any(len(t.feature) > 3 for t in model.trees)
    for x, y in zip(model.trees, again.trees):
        assert all(np.array_equal(getattr(x, n), getattr(y, n)) for n in ("feature", "bin", "left", "right", "value", "gain", "rows"))
    assert [h["round"] for h in model.history] == list(range(1, 12))
    assert [[h[m] for m in b.METRICS] for h in model.history] == [pytest.approx([h[m] for m in b.METRICS], abs=1e-12) for h in again.history]


def test_rows_beyond_a_task_are_passed_over(spark, made, monkeypatch):
    frame, _ = made
    rows = b.encode(frame, INPUTS, b.find_borders(frame, INPUTS, 64)[0], "y", F.col("id"), 0.0)
    for size, tasks in ((b.TASK_BYTES, 1), (900 * 4, 1), (900 * 4 - 1, 2), (900, 4)):
        monkeypatch.setattr(b, "TASK_BYTES", size)
        held = b.Rows(rows, len(INPUTS))
        assert held.tasks == tasks
        held.close()


@pytest.mark.parametrize("n", [0, 1, 300, 9000])
def test_sums_in_bundles(n):
    """Sums of a node are those of its rows, counted by input or in bundles of inputs."""
    rng = np.random.default_rng(n)
    sizes = [64, 1, 5, 64, 2, 2, 5, 7, 3]
    borders = [np.arange(s - 1.0) for s in sizes]
    bins = np.stack([rng.integers(0, s, 9500) for s in sizes], axis=1).astype(np.uint8)
    label, margin = rng.integers(0, 2, 9500), rng.normal(size=9500)
    held = b.TaskRows([(np.arange(9500)[k::2], label[k::2], margin[k::2], bins[k::2]) for k in (0, 1)], borders, [])
    assert len(held.bundles) < 4 and all(math.prod(s) <= b.BUNDLE_CELLS for _, s, _ in held.bundles)
    grower = b.TaskGrower(held, borders, Params(columnRate=0.8, growth="leaf"), 3)
    rows = np.sort(rng.choice(9500, n, replace=False))
    got = grower._sums(rows)
    for f, (first, size) in grower.place.items():
        assert size == sizes[f]
        for k in range(size):
            here = rows[held.bins[f][rows] == k]
            assert got[:, first + k].tolist() == [grower.gradient[here].sum(), grower.hessian[here].sum(), len(here)]


def long_path(n, rng):
    """A tree that is one path of ``n`` inputs."""
    size = 2 * n + 1
    inner = np.arange(size) % 2 == 0
    inner[-1] = False
    at = np.arange(size)
    rows = np.where(inner, (size - at) // 2 * 10 + 10, 10)
    return b.Tree(np.where(inner, at // 2, -1), np.zeros(size, int), np.where(inner, at + 1, -1), np.where(inner, at + 2, -1),
                  np.where(inner, 0.0, rng.normal(size=size)), np.zeros(size), rows)


def test_contributions_of_long_paths():
    """Paths of many inputs: values add up, those of two alike inputs are alike, and are found for all patterns at once."""
    rng = np.random.default_rng(2)
    for n in (11, 14, 70):
        tree = long_path(n, rng)
        model = b.Trees([f"x{k}" for k in range(n)], [np.array([0.0])] * n, 0.5, [tree])
        bins = rng.integers(0, 2, (500, n)).astype(np.uint8)
        got = model.contributions(bins)
        assert np.allclose(got.sum(axis=1), model.margins(bins))
    known = rng.integers(0, 2, (40, 9)).astype(float)
    share = rng.random(9)
    want = np.zeros_like(known)
    for k in range(9):
        others = [j for j in range(9) if j != k]
        for s in range(512):
            if not s >> k & 1:
                part = np.prod([known[:, j] if s >> j & 1 else np.full(40, share[j]) for j in others], axis=0)
                want[:, k] += (known[:, k] - share[k]) * part / (9 * math.comb(8, s.bit_count()))
    assert np.allclose(b._shapley(known, share), want, atol=1e-12)


def test_contributions_of_many_rows_are_quick():
    """Time goes by the patterns of a leaf: seconds before for these rows, tenths of a second since."""
    rng = np.random.default_rng(3)
    model = b.Trees([f"x{k}" for k in range(12)], [np.array([0.0])] * 12, 0.0, [long_path(12, rng) for _ in range(40)])
    bins = rng.integers(0, 2, (20_000, 12)).astype(np.uint8)
    start = time.process_time()
    got = model.contributions(bins)
    took = time.process_time() - start
    assert np.allclose(got.sum(axis=1), model.margins(bins))
    start = time.process_time()
    for _ in range(40):
        model.trees[0].leaves(bins)
    assert took < 25 * (time.process_time() - start)
