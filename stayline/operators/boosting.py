"""Second-order boosted trees over binned rows, grown from histograms.

Rows are binned once, a byte per input.  A pass over the rows adds, per task, their
gradients and Hessians by (node, input, bin); Spark adds the histograms of the tasks by
blocks of inputs and finds the best split of every node in them.  Only these splits, and
the held-out metrics, reach the driver.  The sums are integers (steps of 2**-24), so they
do not depend on the order of rows or tasks and a task that is run again adds the same.

A pass serves all leaves that may be split next.  Leaf-wise growth takes leaves from a
queue by gain; children computed ahead of their turn change nothing in the result.
Depth-wise growth takes them by depth, and symmetric trees split all leaves of a level
alike.

Rows of at most ``TASK_BYTES`` of bins are kept by one task, which grows ``EVERY`` trees in a
pass; the sums, and so the trees, are those that passes over many tasks give.

Sizes: a pass holds ``leaves x inputs x bins x 24`` bytes in a task and sends a row per
leaf and block of inputs to the driver; margins are written with the rows every ``EVERY``
rounds, which bounds both the trees that a pass adds up and what is lost with an executor.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field, fields, replace
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stayline.sources.shared import new_folder, remove

#: Rounds between two writings of margins and looks at the held-out rows.
EVERY = 10
#: Bytes of bins for a task.  127 leaves of 100 inputs have histograms of up to 20 MB a task, and a pass
#: moves them all, so that fewer bytes would cost more to add up than to read.
TASK_BYTES = 128 << 20
#: Tasks whose rows one task can add; histograms of more tasks are added by Spark, in blocks of inputs.
FEW_TASKS = 1
#: Cells of inputs that are counted together, and rows of a node from which that pays.
BUNDLE_CELLS = 1 << 12
BUNDLE_ROWS = 4000
BLOCKS = 8
#: Rows whose contributions are found together.
ROWS = 10_000
#: Steps of scores in the held-out metrics.
STEPS = 1 << 16
_UNIT = float(1 << 24)
_SUMS = 3  # gradient, Hessian, rows
METRICS = ("auc_roc", "auc_pr", "loss")
_TREE = "feature array<int>, bin array<int>, left array<int>, right array<int>, value array<double>, gain array<double>, rows array<long>"


@dataclass(frozen=True)
class Params:
    """``growth`` is ``leaf`` (by gain), ``depth`` or ``symmetric``; rates of 1 use everything."""

    stepSize: float = 0.05
    maxIter: int = 1000
    growth: str = "depth"
    maxDepth: int = 6
    maxLeaves: int = 1 << 30
    maxBins: int = 64
    subsamplingRate: float = 1.0
    resampleEvery: int = 1
    columnRate: float = 1.0
    minInstancesPerNode: int = 1
    minHessian: float = 1e-3
    l1: float = 0.0
    l2: float = 0.0
    patience: int = 50
    metrics: tuple[str, ...] = ("auc_roc",)
    seed: int = 42


@dataclass
class Tree:
    """Nodes as arrays; a leaf has the feature -1, and goes nowhere."""

    feature: np.ndarray
    bin: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    gain: np.ndarray
    rows: np.ndarray

    @classmethod
    def of(cls, row) -> Tree:
        """A tree from a row of arrays."""
        kinds = (np.int32,) * 4 + (np.float64,) * 2 + (np.int64,)
        return cls(*(np.array(row[f.name], k) for f, k in zip(fields(cls), kinds)))

    def leaves(self, bins: np.ndarray) -> np.ndarray:
        """The leaf of each row of a matrix of bins."""
        at, every = np.zeros(len(bins), np.int32), np.arange(len(bins))
        while True:
            feature = self.feature[at]
            if (feature < 0).all():
                return at
            down = np.where(bins[every, np.maximum(feature, 0)] <= self.bin[at], self.left[at], self.right[at])
            at = np.where(feature < 0, at, down)


@dataclass
class Trees:
    """A fitted model: ``margin = base + values of the leaves``, probability its logistic."""

    inputs: list[str]
    borders: list[np.ndarray]
    base: float
    trees: list[Tree]
    #: held-out metrics by round, of all rounds that were run
    history: list[dict] = field(default_factory=list)
    #: distinct training values of the inputs, None where there are more than bins
    values: list[int | None] = field(default_factory=list)

    def cut(self, rounds: int) -> Trees:
        """The model of its first rounds."""
        return replace(self, trees=self.trees[:rounds])

    @property
    def best_round(self) -> int:
        return len(self.trees)

    def bins(self, values: np.ndarray) -> np.ndarray:
        return binned(values, self.borders)

    def margins(self, bins: np.ndarray) -> np.ndarray:
        return added(self.trees, bins, np.full(len(bins), self.base))

    def gains(self) -> dict[str, float]:
        """Total gain per input, as shares."""
        total = np.zeros(len(self.inputs))
        for tree in self.trees:
            inner = tree.feature >= 0
            np.add.at(total, tree.feature[inner], tree.gain[inner])
        return dict(zip(self.inputs, (total / (total.sum() or 1)).tolist()))

    def contributions(self, bins: np.ndarray) -> np.ndarray:
        """Shapley values of the inputs per row, and the expected margin behind them as a last column.

        An input that is left out of a coalition follows both branches by their training
        rows.  In a leaf an input matters as one factor: 1 or 0 when it is known, else
        its share of rows; rows of one pattern of factors have the same values.
        """
        out = np.zeros((len(self.inputs) + 1, len(bins)))
        out[-1] = self.base
        columns = np.ascontiguousarray(bins.T)
        for tree in self.trees:
            below: dict[tuple[int, int], np.ndarray] = {}
            for path, value in _paths(tree):
                names = sorted({f for f, *_ in path})
                share, known = np.ones(len(names)), np.ones((len(names), len(bins)), bool)
                for f, border, left, part in path:
                    k = names.index(f)
                    share[k] *= part
                    if (f, border) not in below:
                        below[f, border] = columns[f] <= border
                    known[k] &= below[f, border] == left
                out[-1] += value * share.prod()
                if names:
                    patterns, which = _patterns(known)
                    for f, found in zip(names, (value * _shapley(patterns, share)).T):
                        out[f] += found[which]
        return out.T

    def node_table(self, spark: SparkSession) -> DataFrame:
        """One row per node: ``tree, node, feature, threshold, left, right, value, gain, rows``."""
        rows = []
        for t, tree in enumerate(self.trees):
            for n in range(len(tree.feature)):
                f = int(tree.feature[n])
                inner = f >= 0
                rows.append((t, n, self.inputs[f] if inner else None, float(self.borders[f][tree.bin[n]]) if inner else None,
                             int(tree.left[n]), int(tree.right[n]), float(tree.value[n]), float(tree.gain[n]), int(tree.rows[n])))
        return spark.createDataFrame(
            rows, "tree int, node int, feature string, threshold double, left int, right int, value double, gain double, rows long")

    def save(self, spark: SparkSession, path: str) -> None:
        """Nodes, borders, history, and last of all ``metadata``."""
        names = [f.name for f in fields(Tree)]
        nodes = [(t, *(getattr(tree, n).tolist() for n in names)) for t, tree in enumerate(self.trees)]
        real = "array<double>"
        frames = {
            "trees": (nodes, f"tree int, {_TREE}"),
            "borders": ([(i, n, b.tolist(), v) for i, (n, b, v) in enumerate(zip(self.inputs, self.borders, self.values))],
                        f"place int, input string, borders {real}, `values` int"),
            "history": ([(h["round"], h["auc_roc"], h["auc_pr"], h["loss"]) for h in self.history], "round int, auc_roc double, auc_pr double, loss double"),
            "metadata": ([(self.base, len(self.trees))], "base double, rounds int"),
        }
        for name, (rows, schema) in frames.items():
            spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(f"{path}/{name}")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Trees:
        def rows(name: str, order: str):
            return spark.read.parquet(f"{path}/{name}").orderBy(order).collect()

        trees = [Tree.of(r) for r in rows("trees", "tree")]
        borders = rows("borders", "place")
        about = rows("metadata", "base")[0]
        return cls([r.input for r in borders], [np.array(r.borders, float) for r in borders], about.base, trees,
                   [h.asDict() for h in rows("history", "round")], [r["values"] for r in borders])


def _paths(tree: Tree) -> Iterator[tuple[list[tuple[int, int, bool, float]], float]]:
    """Every leaf: ``(input, bin, whether left, share of the rows)`` of the steps to it, and its value."""
    todo: list[tuple[int, list]] = [(0, [])]
    while todo:
        node, path = todo.pop()
        f = int(tree.feature[node])
        if f < 0:
            yield path, float(tree.value[node])
            continue
        for child, left in ((int(tree.left[node]), True), (int(tree.right[node]), False)):
            part = tree.rows[child] / tree.rows[node] if tree.rows[node] else 0.5
            todo.append((child, [*path, (f, int(tree.bin[node]), left, float(part))]))


def _patterns(known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct columns of some rows of flags, as rows of numbers, and which of them each column is."""
    n = len(known)
    if n > 62:
        patterns, which = np.unique(known.T, axis=0, return_inverse=True)
        return patterns.astype(float), which.reshape(-1)
    code = np.zeros(known.shape[1], np.int64)
    for k, flags in enumerate(known):
        code |= flags.astype(np.int64) << k
    if n > 12:
        codes, which = np.unique(code, return_inverse=True)
    else:
        codes = np.flatnonzero(np.bincount(code, minlength=1 << n))
        place = np.zeros(1 << n, np.int64)
        place[codes] = np.arange(len(codes))
        which = place[code]
    return (codes[:, None] >> np.arange(n) & 1).astype(float), which


@cache
def _quadrature(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Points and weights that integrate polynomials of a degree below ``n`` over 0 to 1."""
    points, weights = np.polynomial.legendre.leggauss((n + 1) // 2)
    return (points + 1) / 2, weights / 2


def _shapley(known: np.ndarray, share: np.ndarray) -> np.ndarray:
    """Shapley values of factors whose product is the game: ``known`` in a coalition, else ``share``.

    The weight of a coalition is the integral of ``t ** size * (1 - t) ** (others - size)``, so the sum over the
    coalitions of the others is that of the product of ``share * (1 - t) + known * t``, a polynomial.
    """
    points, weights = _quadrature(len(share))
    t = points[:, None, None]
    factors = share * (1 - t) + known * t
    others = np.ones_like(factors)
    others[:, :, 1:] = np.cumprod(factors, axis=2)[:, :, :-1]
    others[:, :, :-1] *= np.cumprod(factors[:, :, ::-1], axis=2)[:, :, -2::-1]
    return (known - share) * np.tensordot(weights, others, 1)


# --- bins ------------------------------------------------------------------


def binned(values: np.ndarray, borders: Sequence[np.ndarray]) -> np.ndarray:
    """Bin of each value: the number of borders below it; a missing value is below all."""
    out = np.empty(values.shape, np.uint8)
    for k, limits in enumerate(borders):
        column = values[:, k]
        out[:, k] = np.searchsorted(limits, np.where(np.isnan(column), -np.inf, column), side="left")
    return out


def _matrix(struct: pa.Array, inputs: Sequence[str]) -> np.ndarray:
    if not len(inputs):
        return np.zeros((len(struct), 0))
    return np.column_stack([struct.field(k).cast(pa.float64()).to_numpy(zero_copy_only=False) for k in range(len(inputs))])


def input_struct(inputs: Sequence[str]) -> Column:
    return F.struct(*(F.col(x).cast("double").alias(f"x{k}") for k, x in enumerate(inputs))).alias("x")


def find_borders(rows: DataFrame, inputs: Sequence[str], bins: int) -> tuple[list[np.ndarray], list[int | None]]:
    """At most ``bins - 1`` borders per input: all distinct values but the last where these are
    few, else quantiles; a value on a border is below it.  Also the number of values, if few."""
    inputs = list(inputs)
    if not 2 <= bins <= 256:
        raise ValueError("2 to 256 bins")

    def few(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: list[np.ndarray | None] = [np.zeros(0)] * len(inputs)
        for batch in batches:
            values = _matrix(batch.column("x"), inputs)
            for k, have in enumerate(seen):
                if have is not None:
                    new = np.unique(values[:, k])
                    have = np.union1d(have, new[~np.isnan(new)])
                    seen[k] = have if len(have) <= bins else None
        name = [k for k, s in enumerate(seen) for _ in range(1 if s is None else len(s))]
        value = [x for s in seen for x in ([None] if s is None else s.tolist())]
        yield pa.RecordBatch.from_arrays([pa.array(name, pa.int32()), pa.array(value, pa.float64())], ["input", "value"])

    distinct = rows.select(input_struct(inputs)).mapInArrow(few, "input int, value double").distinct()
    # a task gives at most `bins` values of an input; so does an input that is kept
    sizes = distinct.groupBy("input").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.col("value").isNull()).alias("many"), F.slice(F.sort_array(F.collect_list("value")), 1, bins).alias("found"))
    borders: dict[int, np.ndarray] = {}
    many = []
    for r in sizes.collect():
        if r.many or r.n > bins:
            many.append(r.input)
        else:
            borders[r.input] = np.array(r.found[:-1], float)
    if many:
        steps = [i / bins for i in range(1, bins)]
        for k, limits in zip(many, rows.approxQuantile([inputs[k] for k in many], steps, 1 / (8 * bins))):
            borders[k] = np.unique(np.array(limits, float))
    every = [borders.get(k, np.zeros(0)) for k in range(len(inputs))]
    return every, [None if k in many else len(b) + 1 if k in borders else 0 for k, b in enumerate(every)]


def encode(rows: DataFrame, inputs: Sequence[str], borders: Sequence[np.ndarray], label: str, key: Column, base: float) -> DataFrame:
    """``row, label, margin, bins`` of training rows; ``key`` is a long that names a row."""
    inputs, borders = list(inputs), list(borders)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins = binned(_matrix(batch.column("x"), inputs), borders)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("label"), pa.array(np.full(len(bins), base)), pa.array([b.tobytes() for b in bins], pa.binary())],
                ["row", "label", "margin", "bins"])

    plain = rows.select(key.alias("row"), F.col(label).cast("int").alias("label"), input_struct(inputs))
    return plain.mapInArrow(run, "row long, label int, margin double, bins binary")


def _bins_of(batch: pa.RecordBatch, width: int) -> np.ndarray:
    column = batch.column("bins")
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), width)


def added(trees: Sequence[Tree], bins: np.ndarray, margins: np.ndarray) -> np.ndarray:
    for tree in trees:
        margins = margins + tree.value[tree.leaves(bins)]
    return margins


def logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def sampled(rows: np.ndarray, rate: float, seed: int, draw: int) -> np.ndarray:
    """Whether a row is drawn; depends on its key alone."""
    if rate >= 1:
        return np.ones(len(rows), bool)
    start = (seed * 0x9E3779B97F4A7C15 + draw * 0xD1B54A32D192ED03) & ((1 << 64) - 1)
    x = rows.astype(np.uint64) ^ np.uint64(start)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(float) < rate * (1 << 53)


def cell_sums(bins: np.ndarray, at: np.ndarray, gradient: np.ndarray, hessian: np.ndarray, places: int, n_bins: int) -> np.ndarray:
    """Sums ``[place, (gradient, Hessian, rows), column x bin]`` of rows; those of integers below 2**53 are exact.

    Many rows are added column by column, whose sums stay in the cache; for few rows the
    calls would cost more than the rows, so all columns are added at once.
    """
    width = bins.shape[1]
    sums = np.zeros((places, _SUMS, width, n_bins), np.int64)
    if len(bins) >= places * n_bins:
        first = at * n_bins
        for k, column in enumerate(np.ascontiguousarray(bins.T)):
            cell = first + column
            for j, values in enumerate((gradient, hessian, None)):
                sums[:, j, k] = np.bincount(cell, values, places * n_bins).astype(np.int64).reshape(places, n_bins)
    else:
        cell = (at * (width * n_bins))[:, None] + (np.arange(width) * n_bins)[None, :] + bins
        for j, values in enumerate((gradient, hessian, None)):
            weights = None if values is None else np.repeat(values, width)
            sums[:, j] = np.bincount(cell.reshape(-1), weights, sums[:, j].size).astype(np.int64).reshape(places, width, n_bins)
    return sums.reshape(places, _SUMS, width * n_bins)


# --- passes ----------------------------------------------------------------


class Rows:
    """Training or held-out rows with margins, written anew as trees are settled."""

    def __init__(self, frame: DataFrame, width: int):
        self.spark, self.width, self.path = frame.sparkSession, width, None
        self.pending: list[Tree] = []
        # narrow rows of a wide table: as many tasks as their own size asks for
        self._write(frame.hint("rebalance"))
        self.tasks = max(1, -(-self.frame.count() * width // TASK_BYTES))

    def _write(self, frame: DataFrame) -> None:
        path, old = new_folder(self.spark), self.path
        frame.write.parquet(path)
        self.frame, self.path = self.spark.read.schema("row long, label int, margin double, bins binary").parquet(path), path
        if old:
            remove(self.spark, old)

    def settle(self) -> None:
        """Write margins with all pending trees added."""
        trees, width = list(self.pending), self.width

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                margins = added(trees, _bins_of(batch, width), batch.column("margin").to_numpy())
                yield batch.set_column(2, "margin", pa.array(margins))

        self._write(self.frame.mapInArrow(run, "row long, label int, margin double, bins binary"))
        self.pending = []

    def close(self) -> None:
        remove(self.spark, self.path)

    def grown(self, borders: Sequence[np.ndarray], params: Params, first: int, count: int) -> Iterator[Tree]:
        """The next trees, which are not yet pending; where the rows are few, one task grows them all."""
        if self.tasks > FEW_TASKS:
            for number in range(first, first + count):
                tree = Grower(self, borders, params, number).grow()
                self.pending.append(tree)
                yield tree
            return
        trees, width = list(self.pending), self.width

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            parts = [(batch.column("row").to_numpy(), batch.column("label").to_numpy(), batch.column("margin").to_numpy(),
                      _bins_of(batch, width)) for batch in batches]
            if not parts:
                return
            held = TaskRows(parts, borders, trees)
            for number in range(first, first + count):
                tree = TaskGrower(held, borders, params, number).grow()
                yield pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), *(pa.array([getattr(tree, n)]) for n in names)], ["number", *names])

        names = [f.name for f in fields(Tree)]
        found = self.frame.coalesce(1).mapInArrow(run, f"number int, {_TREE}").collect()
        for row in sorted(found, key=lambda r: r["number"]):
            tree = Tree.of(row)
            self.pending.append(tree)
            yield tree

    def _adder(self, tree: Tree | None, targets: list[int], columns: np.ndarray, n_bins: int, draw: tuple[float, int, int]):
        """Sums ``[target, (gradient, Hessian, rows), column, bin]`` of a task's rows at some leaves of a tree."""
        trees, width, size = list(self.pending), self.width, len(columns) * n_bins

        def add(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
            sums = np.zeros((len(targets), _SUMS, size), np.int64)
            place = np.full(len(tree.feature) if tree else 1, -1)
            place[targets] = np.arange(len(targets))
            for batch in batches:
                keep = np.flatnonzero(sampled(batch.column("row").to_numpy(), *draw))
                bins = _bins_of(batch, width)[keep]
                at = place[tree.leaves(bins) if tree else np.zeros(len(bins), int)]
                here = at >= 0
                bins, at, keep = bins[here], at[here], keep[here]
                if not len(at):
                    continue
                p = logistic(added(trees, bins, batch.column("margin").to_numpy()[keep]))
                label = batch.column("label").to_numpy()[keep]
                sums += cell_sums(bins[:, columns], at, np.round((p - label) * _UNIT), np.round(p * (1 - p) * _UNIT), len(targets), n_bins)
            return sums.reshape(len(targets), _SUMS, len(columns), n_bins)
        return add

    def _by_block(self, add, targets: list[int], columns: np.ndarray, n_bins: int, use, schema: str) -> list:
        """Rows that ``use(first column, sums)`` gives for the sums of each block of columns."""
        cuts = np.linspace(0, len(columns), min(BLOCKS, len(columns)) + 1).astype(int).tolist()
        spans = list(zip(cuts, cuts[1:]))

        def alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            yield use(0, add(batches))

        def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            """Cells with rows and their sums, by block."""
            sums = add(batches)
            parts = [np.moveaxis(sums[:, :, a:b], 1, 0).reshape(_SUMS, -1) for a, b in spans]
            cells = [np.flatnonzero(p[2]) for p in parts]
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(spans)), pa.int32()), pa.array([c.astype("<u4").tobytes() for c in cells], pa.binary()),
                 pa.array([p[:, c].tobytes() for p, c in zip(parts, cells)], pa.binary())], ["block", "cells", "sums"])

        def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: dict[int, np.ndarray] = {}
            for batch in batches:
                for r in batch.to_pylist():
                    a, b = spans[r["block"]]
                    into = held.setdefault(r["block"], np.zeros((_SUMS, len(targets) * (b - a) * n_bins), np.int64))
                    into[:, np.frombuffer(r["cells"], "<u4")] += np.frombuffer(r["sums"], np.int64).reshape(_SUMS, -1)
            for k, sums in held.items():
                a, b = spans[k]
                yield use(a, np.moveaxis(sums.reshape(_SUMS, len(targets), b - a, n_bins), 0, 1))

        if self.tasks <= FEW_TASKS:
            return self.frame.coalesce(1).mapInArrow(alone, schema).collect()
        found = self.frame.mapInArrow(packed, "block int, cells binary, sums binary")
        return found.repartition(len(spans), "block").mapInArrow(whole, schema).collect()

    def histograms(self, columns: np.ndarray, n_bins: int, draw: tuple[float, int, int]) -> np.ndarray:
        """Sums ``[(gradient, Hessian, rows), column, bin]`` of all rows."""
        def use(first: int, sums: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([first]), pa.array([sums.tobytes()], pa.binary())], ["first", "sums"])

        found = self._by_block(self._adder(None, [0], columns, n_bins, draw), [0], columns, n_bins, use, "first long, sums binary")
        parts = [np.frombuffer(r["sums"], np.int64).reshape(_SUMS, -1, n_bins) for r in sorted(found, key=lambda r: r["first"])]
        return np.concatenate(parts, axis=1)

    def best_splits(self, tree: Tree | None, targets: list[int], columns: np.ndarray, limits: np.ndarray, n_bins: int,
                    draw: tuple[float, int, int], params: Params) -> list[tuple[float, int, int, float, np.ndarray, np.ndarray]]:
        """``strength, column, bin, gain, sums left of it, all sums`` for each of some leaves of a tree.

        A leaf's strength is its gain, the best one, first of equals; symmetric growth takes the
        split that is best for all leaves together, whose strength is the sum of gains.
        """
        def use(first: int, sums: np.ndarray) -> pa.RecordBatch:
            here = limits[first: first + sums.shape[2]]
            each = [split_gains(_scaled(s), here, params) for s in sums]
            total = joint_gains([g for g, _ in each]) if params.growth == "symmetric" else None
            rows = []
            for k, (gains, left) in enumerate(each):
                judged = gains if total is None else total
                c, b = np.unravel_index(np.argmax(judged), judged.shape)
                stats = _scaled(sums[k])[:, 0].sum(axis=1)
                rows.append((k, first + int(c), int(b), float(judged[c, b]), float(gains[c, b]), left[:, c, b].tolist(), stats.tolist()))
            kinds = (pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.list_(pa.float64()), pa.list_(pa.float64()))
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows), kinds)], names)

        names = ["target", "place", "bin", "strength", "gain", "left", "stats"]
        schema = "target int, place int, bin int, strength double, gain double, left array<double>, stats array<double>"
        add = self._adder(tree, targets, columns, n_bins, draw)
        best: dict[int, tuple] = {}
        for r in sorted(self._by_block(add, targets, columns, n_bins, use, schema), key=lambda r: r["place"]):
            if r["target"] not in best or r["strength"] > best[r["target"]][0]:
                best[r["target"]] = (r["strength"], int(columns[r["place"]]), r["bin"], r["gain"], np.array(r["left"]), np.array(r["stats"]))
        return [best[k] for k in range(len(targets))]

    def measured(self, base_round: int) -> list[dict]:
        """Held-out metrics after each pending tree, from counts per step of the score."""
        trees, width = list(self.pending), self.width

        def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
            """A tree, the steps of its scores in a batch, and ``[step, (positive, negative, loss)]``."""
            for batch in batches:
                bins, margins = _bins_of(batch, width), batch.column("margin").to_numpy()
                label = batch.column("label").to_numpy()
                for k, tree in enumerate(trees):
                    margins = added([tree], bins, margins)
                    p = logistic(margins)
                    loss = -np.where(label > 0, np.log(np.maximum(p, 1e-15)), np.log(np.maximum(1 - p, 1e-15)))
                    step, which = np.unique(np.minimum((p * STEPS).astype(np.int64), STEPS - 1), return_inverse=True)
                    yield k, step, np.stack([np.bincount(which, w, len(step)) for w in (label, 1 - label, np.round(loss * _UNIT))], axis=1).astype(np.int64)

        def judge(k: int, rows: np.ndarray) -> pa.RecordBatch:
            """Metrics from rows of ``step, pos, neg, loss``, one a step."""
            pos, neg, loss = rows[np.argsort(-rows[:, 0])][:, 1:].astype(float).T
            p, n = pos.sum(), neg.sum()
            above = np.cumsum(pos)
            auc = float((neg * (above - pos / 2)).sum() / (p * n)) if p and n else 0.5
            ap = float((pos * above / np.maximum(above + np.cumsum(neg), 1)).sum() / p) if p else 0.0
            values = (k, auc, ap, float(loss.sum() / _UNIT / max(p + n, 1)))
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, (pa.int32(), *[pa.float64()] * 3))], ["k", *METRICS])

        def alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: dict[int, np.ndarray] = {}
            for k, step, found in counts(batches):
                held.setdefault(k, np.zeros((STEPS, 3), np.int64))[step] += found
            for k, table in held.items():
                step = np.flatnonzero(table[:, 0] + table[:, 1])
                yield judge(k, np.column_stack([step, table[step]]))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for k, step, found in counts(batches):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(step), k), pa.int32()), pa.array(step), *(pa.array(c) for c in found.T)], ["k", "step", "pos", "neg", "loss"])

        def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: dict[int, list[np.ndarray]] = {}
            for batch in batches:
                table = np.stack([batch.column(c).to_numpy() for c in ("step", "pos", "neg", "loss")], axis=1)
                at = batch.column("k").to_numpy()
                for k in np.unique(at).tolist():
                    held.setdefault(k, []).append(table[at == k])
            for k, parts in held.items():
                yield judge(k, np.concatenate(parts))  # at most STEPS rows

        schema = "k int, " + ", ".join(f"{m} double" for m in METRICS)
        if self.tasks <= FEW_TASKS:
            found = self.frame.coalesce(1).mapInArrow(alone, schema)
        else:
            found = self.frame.mapInArrow(run, "k int, step long, pos long, neg long, loss long")
            found = found.groupBy("k", "step").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"), F.sum("loss").alias("loss"))
            found = found.repartition(len(trees), "k").mapInArrow(judged, schema)
        known = {r["k"]: r for r in found.collect()}
        without = dict(zip(METRICS, (0.5, 0.0, 0.0)))
        return [{"round": base_round + k + 1, **{m: known[k][m] if k in known else without[m] for m in METRICS}} for k in range(len(trees))]


# --- trees -----------------------------------------------------------------


def shrunk(g, l1: float):
    return np.sign(g) * np.maximum(np.abs(g) - l1, 0)


def strength(g, h, params: Params):
    """Twice the loss that the best value of a node takes away."""
    return shrunk(g, params.l1) ** 2 / np.maximum(h + params.l2, 1e-12)


def split_gains(sums: np.ndarray, limits: np.ndarray, params: Params) -> tuple[np.ndarray, np.ndarray]:
    """Gain of each ``[column, bin]`` as a border, -inf where it is none, and the sums left of it.

    ``limits`` is the number of borders per column.
    """
    left = np.cumsum(sums, axis=2)[:, :, :-1]
    whole = sums[:, :, :].sum(axis=2)[:, :1, None]  # every column has all rows
    gains = border_gains(left, whole, params)
    return np.where(np.arange(left.shape[2])[None, :] < limits[:, None], gains, -np.inf), left


def border_gains(left: np.ndarray, whole: np.ndarray, params: Params) -> np.ndarray:
    """Gain of borders from the sums left of them and all sums, -inf where a side has too little."""
    right = whole - left
    (gl, hl, nl), (gr, hr, nr), (g, h, _) = left, right, whole
    gains = strength(gl, hl, params) + strength(gr, hr, params) - strength(g, h, params)
    few = max(params.minInstancesPerNode, 1)
    ok = (nl >= few) & (nr >= few) & (hl >= params.minHessian) & (hr >= params.minHessian)
    return np.where(ok, gains, -np.inf)


def joint_gains(each: list[np.ndarray]) -> np.ndarray:
    """Gain of each ``[column, bin]`` as the border of all leaves, -inf where it is none in any."""
    total = 0.0
    for gains in each:
        total = total + np.where(np.isfinite(gains), gains, 0)
    return np.where(np.any([np.isfinite(g) for g in each], axis=0), total, -np.inf)


class _Node:
    def __init__(self, depth: int, stats: np.ndarray):
        self.depth, self.stats = depth, stats  # gradient, Hessian, rows
        self.split = self.left = self.right = None
        self.applied, self.gain = False, 0.0
        self.rows = self.rest = self.sums = None  # of a task that holds the rows


def _scaled(sums: np.ndarray) -> np.ndarray:
    out = sums.astype(float)
    out[:2] /= _UNIT
    return out


class Grower:
    """Grows one tree over rows."""

    def __init__(self, rows: Rows, borders: Sequence[np.ndarray], params: Params, number: int):
        self.rows, self.params = rows, params
        width = len(borders)
        chosen = np.arange(width)
        if params.columnRate < 1:
            rng = np.random.default_rng([params.seed, number])
            chosen = np.sort(rng.choice(width, max(1, round(width * params.columnRate)), replace=False))
        self.columns = chosen
        self.limits = np.array([len(borders[k]) for k in chosen], np.int64)
        self.n_bins = max(int(self.limits.max(initial=0)) + 1, 2)
        self.draw = (params.subsamplingRate, params.seed, number // max(params.resampleEvery, 1))
        self._begin()

    def _begin(self) -> None:
        found = self._found(None, [0])[0]
        self.root = _Node(0, found[-1])
        self._look(self.root, found)

    def _found(self, tree: Tree | None, targets: list[int]) -> list[tuple]:
        return self.rows.best_splits(tree, targets, self.columns, self.limits, self.n_bins, self.draw, self.params)

    def _look(self, node: _Node, found: tuple) -> None:
        """Keep a node's best split."""
        strength, column, border, gain, left, _ = found
        if strength > 1e-9:
            node.split, node.gain = (column, border, left), max(gain, 0.0)

    def _split(self, parents: list[_Node]) -> list[_Node]:
        """Children of some leaves; returns those that may be split again."""
        few, wanted = max(self.params.minInstancesPerNode, 1), []
        for p in parents:
            left = p.split[2]
            p.left, p.right = _Node(p.depth + 1, left), _Node(p.depth + 1, p.stats - left)
            if p.depth + 1 < self.params.maxDepth:
                wanted += [n for n in (p.left, p.right) if self.params.growth == "symmetric"
                           or n.stats[2] >= 2 * few and n.stats[1] >= 2 * self.params.minHessian]
        return wanted

    def _turn(self, heap: list[tuple]) -> list[_Node]:
        """The leaves to look at when the first of the queue is due: a pass serves them all."""
        return [n for *_, n in heap if n.left is None]

    def _children(self, parents: list[_Node]) -> None:
        """Children of some leaves, with their best splits where they may be split again."""
        wanted = self._split(parents)
        if not wanted:
            return
        tree, numbers = self._tree(ahead=True)
        for node, found in zip(wanted, self._found(tree, [numbers[id(n)] for n in wanted])):
            self._look(node, found)

    def grow(self) -> Tree:
        if self.params.growth == "symmetric":
            self._symmetric()
            return self._tree()[0]
        by_gain = self.params.growth == "leaf"
        heap: list[tuple] = []
        leaves, count = 1, 0

        def push(node: _Node) -> None:
            nonlocal count
            if node.split and node.depth < self.params.maxDepth:
                heapq.heappush(heap, (-node.gain if by_gain else node.depth, count, node))
                count += 1

        push(self.root)
        while heap and leaves < self.params.maxLeaves:
            node = heap[0][2]
            if node.left is None:
                self._children(self._turn(heap))
            heapq.heappop(heap)
            node.applied = True
            leaves += 1
            push(node.left)
            push(node.right)
        return self._tree()[0]

    def _symmetric(self) -> None:
        """One input and border per level, best over all leaves together."""
        level = [self.root]
        for _ in range(self.params.maxDepth):
            if any(n.split is None for n in level):
                return
            for node in level:
                node.applied = True
            self._children(level)
            level = [n for p in level for n in (p.left, p.right)]

    def _tree(self, ahead: bool = False) -> tuple[Tree, dict[int, int]]:
        """The tree so far, nodes in the order of their depth; ``ahead`` takes in children not yet applied."""
        nodes, numbers = [self.root], {}
        for node in nodes:
            numbers[id(node)] = len(numbers)
            if (node.applied or ahead) and node.left is not None:
                nodes += [node.left, node.right]
        inner = [(n.applied or ahead) and n.left is not None for n in nodes]
        value = [0.0 if i else self._value(n.stats) for n, i in zip(nodes, inner)]
        tree = Tree(
            np.array([n.split[0] if i else -1 for n, i in zip(nodes, inner)], np.int32),
            np.array([n.split[1] if i else 0 for n, i in zip(nodes, inner)], np.int32),
            np.array([numbers[id(n.left)] if i else -1 for n, i in zip(nodes, inner)], np.int32),
            np.array([numbers[id(n.right)] if i else -1 for n, i in zip(nodes, inner)], np.int32),
            np.array(value), np.array([n.gain if i else 0.0 for n, i in zip(nodes, inner)]),
            np.array([int(round(n.stats[2])) for n in nodes], np.int64))
        return tree, numbers

    def _value(self, stats: np.ndarray) -> float:
        g, h, n = stats
        if not n:
            return 0.0
        return float(-shrunk(g, self.params.l1) / max(h + self.params.l2, 1e-12) * self.params.stepSize)


class TaskRows:
    """Training rows in the memory of one task, by input, with margins.

    Inputs are counted in bundles: one count over the combined bins of several inputs gives
    the sums of each of them.
    """

    def __init__(self, parts: Sequence[tuple[np.ndarray, ...]], borders: Sequence[np.ndarray], trees: Sequence[Tree]):
        self.keys, self.label, margins = (np.concatenate([p[k] for p in parts]) for k in range(3))
        self.margins = np.empty(len(margins))
        self.sizes = np.array([len(b) + 1 for b in borders], np.int64)
        self.bins = np.empty((len(borders), len(margins)), np.uint8)
        done = 0
        for *_, margin, bins in parts:
            self.margins[done: done + len(bins)] = added(trees, bins, margin)
            self.bins[:, done: done + len(bins)] = bins.T
            done += len(bins)
        self.bundles: list[tuple[list[int], list[int], np.ndarray]] = []
        open_: list[tuple[int, list[int]]] = []
        for k in sorted(np.flatnonzero(self.sizes > 1).tolist(), key=lambda k: -self.sizes[k]):
            size = int(self.sizes[k])
            at = next((i for i, (cells, _) in enumerate(open_) if cells * size <= BUNDLE_CELLS), len(open_))
            cells, members = open_.pop(at) if at < len(open_) else (1, [])
            open_.insert(at, (cells * size, [*members, k]))
        for _, members in open_:
            sizes = [int(self.sizes[k]) for k in members]
            code = np.zeros(len(margins), np.uint16)
            for k, size in zip(members, sizes):
                code *= np.uint16(size)
                code += self.bins[k]
            self.bundles.append((members, sizes, code))


class TaskGrower(Grower):
    """Grows one tree over the rows of a task, and adds it to their margins.

    A split counts the rows of the smaller child only; the other has the rest of its
    parent's sums.  Sums lie in one row of cells: those of the first input, then the next.
    """

    def _begin(self) -> None:
        held, p = self.rows, logistic(self.rows.margins)
        self.gradient, self.hessian = np.round((p - held.label) * _UNIT), np.round(p * (1 - p) * _UNIT)
        able = self.columns[self.limits > 0]
        sizes = held.sizes[able]
        first = np.cumsum(sizes) - sizes
        self.cells = int(sizes.sum())
        self.place = dict(zip(able.tolist(), zip(first.tolist(), sizes.tolist())))
        self.able, self.first, self.bins = able, first, held.bins[able]
        # the cells that are borders, their inputs and bins
        owner = np.repeat(np.arange(len(able)), sizes)
        bin_ = np.arange(self.cells) - first[owner]
        self.border = np.flatnonzero(bin_ < sizes[owner] - 1)
        self.border_first, self.border_column, self.border_bin = first[owner][self.border], able[owner][self.border], bin_[self.border]
        drawn = sampled(held.keys, *self.draw)
        rows = np.flatnonzero(drawn)
        root = self.root = _Node(0, np.array([self.gradient[rows].sum() / _UNIT, self.hessian[rows].sum() / _UNIT, float(len(rows))]))
        root.rows, root.rest = rows, np.flatnonzero(~drawn)
        root.sums = self._sums(rows)
        self._search([root])

    def _sums(self, rows: np.ndarray) -> np.ndarray:
        """``[(gradient, Hessian, rows), cell]`` of some rows; sums of integers below 2**53 are exact."""
        out = np.zeros((_SUMS, self.cells), np.int64)
        weights = (self.gradient[rows], self.hessian[rows], None)
        if len(rows) < BUNDLE_ROWS:
            for at in range(0, len(self.able), 32):
                cell = (np.take(self.bins[at: at + 32], rows, axis=1) + self.first[at: at + 32, None]).reshape(-1)
                for j, w in enumerate(weights):
                    repeated = None if w is None else np.broadcast_to(w, (len(cell) // max(len(rows), 1), len(rows))).reshape(-1)
                    out[j] += np.bincount(cell, repeated, self.cells).astype(np.int64)
            return out
        for members, sizes, code in self.rows.bundles:
            wanted = [k for k in members if k in self.place]
            if not wanted:
                continue
            cell = code[rows].astype(np.intp)
            joint = np.stack([np.bincount(cell, w, math.prod(sizes)).astype(np.int64) for w in weights]).reshape(_SUMS, *sizes)
            for k in wanted:
                first, size = self.place[k]
                others = tuple(j + 1 for j, m in enumerate(members) if m != k)
                out[:, first: first + size] = joint.sum(axis=others)
        return out

    def _search(self, nodes: list[_Node]) -> None:
        """Keep the best splits of some nodes; symmetric growth finds one for all."""
        if not len(self.border):
            return
        total = np.cumsum(np.stack([n.sums for n in nodes]), axis=2)
        left = total[:, :, self.border] - np.where(self.border_first > 0, total[:, :, self.border_first - 1], 0)
        left = np.moveaxis(left, 1, 0).astype(float)
        left[:2] /= _UNIT
        gains = border_gains(left, np.stack([n.stats for n in nodes], axis=1)[:, :, None], self.params)
        judged = np.broadcast_to(joint_gains(list(gains)), gains.shape) if self.params.growth == "symmetric" else gains
        for k, (node, best) in enumerate(zip(nodes, np.argmax(judged, axis=1).tolist())):
            self._look(node, (float(judged[k, best]), int(self.border_column[best]), int(self.border_bin[best]),
                              float(gains[k, best]), left[:, k, best].copy(), None))

    def _turn(self, heap: list[tuple]) -> list[_Node]:
        return [heap[0][2]]

    def _children(self, parents: list[_Node]) -> None:
        wanted = self._split(parents)
        asked = {id(n) for n in wanted}
        for p in parents:
            column, border, _ = p.split
            for name in ("rows", "rest"):
                rows = getattr(p, name)
                goes = self.rows.bins[column][rows] <= border
                setattr(p.left, name, rows[goes])
                setattr(p.right, name, rows[~goes])
            if asked & {id(p.left), id(p.right)}:
                small, large = sorted((p.left, p.right), key=lambda n: len(n.rows))
                small.sums = self._sums(small.rows)
                large.sums = p.sums - small.sums
            p.rows = p.rest = p.sums = None
        if wanted:
            self._search(wanted)

    def grow(self) -> Tree:
        tree = super().grow()
        todo = [self.root]
        while todo:
            node = todo.pop()
            if node.left is not None:
                todo += [node.left, node.right]
                continue
            for rows in (node.rows, node.rest):
                self.rows.margins[rows] += self._value(node.stats)
        return tree


# --- boosting --------------------------------------------------------------


def stopped(history: Sequence[dict], metrics: Sequence[str], patience: int) -> int | None:
    """The best round by the first metric that has not risen for ``patience`` rounds, if any has not."""
    best = {m: (-math.inf, 0) for m in metrics}
    for h in history:
        for m in metrics:
            if h[m] > best[m][0]:
                best[m] = (h[m], h["round"])
            elif h["round"] - best[m][1] >= patience:
                return best[m][1]
    return None


def best_round(history: Sequence[dict], metric: str) -> int:
    return max(history, key=lambda h: (h[metric], -h["round"]))["round"] if history else 0


def fit(train: DataFrame, valid: DataFrame | None, inputs: Sequence[str], label: str, key: Column, params: Params) -> Trees:
    """Boost until no metric of the held-out rows rises, and keep the rounds up to the best one.

    ``key`` is a long column that names a row; it decides which rows a round draws.
    Without held-out rows all rounds are kept.  Rows need both labels to boost at all.
    """
    inputs = list(inputs)
    mean = train.agg(F.avg(F.col(label).cast("double"))).first()[0]
    if mean is None:
        raise ValueError("no training rows")
    mean = min(max(mean, 1e-6), 1 - 1e-6)
    base = math.log(mean / (1 - mean))
    if not inputs:
        return Trees(inputs, [], base, [])
    borders, values = find_borders(train, inputs, params.maxBins)
    rows = Rows(encode(train, inputs, borders, label, key, base), len(inputs))
    held = Rows(encode(valid, inputs, borders, label, key, base), len(inputs)) if valid is not None else None
    model, best = Trees(inputs, borders, base, [], [], values), None
    try:
        while len(model.trees) < params.maxIter and best is None:
            model.trees += rows.grown(borders, params, len(model.trees), min(EVERY, params.maxIter - len(model.trees)))
            if held is not None:
                held.pending = list(rows.pending)
                model.history += held.measured(len(model.trees) - len(held.pending))
                best = stopped(model.history, params.metrics, params.patience)
            if len(model.trees) < params.maxIter and best is None:
                rows.settle()
                if held is not None:
                    held.settle()
    finally:
        rows.close()
        if held is not None:
            held.close()
    if held is None:
        return model
    return model.cut(best or best_round(model.history, params.metrics[0]))


def root_gains(train: DataFrame, inputs: Sequence[str], label: str, key: Column, params: Params) -> DataFrame:
    """``feature, distinct_values, border, gain, rows_below``: the best first split of each input by itself.

    Inputs with more than ``maxBins`` values are split at quantiles and have no number of
    values; those that cannot be split have no border.
    """
    inputs = list(inputs)
    mean = train.agg(F.avg(F.col(label).cast("double"))).first()[0]
    borders, values = find_borders(train, inputs, params.maxBins)
    rows = Rows(encode(train, inputs, borders, label, key, math.log(mean / (1 - mean))), len(inputs))
    try:
        limits = np.array([len(b) for b in borders], np.int64)
        sums = rows.histograms(np.arange(len(inputs)), max(int(limits.max(initial=0)) + 1, 2), (params.subsamplingRate, params.seed, 0))
        gains, left = split_gains(_scaled(sums), limits, params)
    finally:
        rows.close()
    found = []
    for name, limits, n, each, below in zip(inputs, borders, values, gains, left[2]):
        rounded = np.round(each, 9)
        b = int(np.argmax(rounded)) if len(limits) else 0
        able = len(limits) and np.isfinite(rounded[b])
        found.append((name, n, float(limits[b]) if able else None,
                      float(rounded[b]) if able else None, int(below[b]) if able else None))
    return train.sparkSession.createDataFrame(found, "feature string, distinct_values int, border double, gain double, rows_below long")


# --- use -------------------------------------------------------------------


def with_margin(model: Trees, frame: DataFrame, output: str) -> DataFrame:
    """The frame with the margin of each row."""
    @F.pandas_udf("double")
    def margin(x: pd.DataFrame) -> pd.Series:
        return pd.Series(model.margins(model.bins(x.to_numpy(float))))

    return frame.withColumn(output, margin(input_struct(model.inputs)) if model.inputs else F.lit(model.base))


def with_contributions(model: Trees, frame: DataFrame, keep: Sequence[str]) -> DataFrame:
    """``keep``, ``base`` (the expected margin) and ``contributions``, one per input in order; they add up to the margin."""
    names, n = list(keep), len(model.inputs)
    plain = frame.select(*names, input_struct(model.inputs))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema if f.name != "x")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                found = model.contributions(model.bins(_matrix(part.column("x"), model.inputs)))
                values = pa.ListArray.from_arrays(pa.array(np.arange(len(found) + 1) * n, pa.int32()), pa.array(found[:, :n].reshape(-1)))
                yield pa.RecordBatch.from_arrays([part.column(c) for c in names] + [pa.array(found[:, n]), values], [*names, "base", "contributions"])

    return plain.mapInArrow(run, f"{schema + ', ' if schema else ''}base double, contributions array<double>")


def mean_contributions(model: Trees, frame: DataFrame) -> DataFrame:
    """``feature, importance``: mean absolute contribution of every input over all rows."""
    n = len(model.inputs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros(n), 0
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                values = _matrix(batch.slice(at, ROWS).column("x"), model.inputs)
                total += np.abs(model.contributions(model.bins(values))[:, :n]).sum(axis=0)
                rows += len(values)
        yield pa.RecordBatch.from_arrays(
            [pa.array(model.inputs, pa.string()), pa.array(total), pa.array(np.full(n, rows), pa.int64())], ["feature", "total", "rows"])

    sums = frame.select(input_struct(model.inputs)).mapInArrow(run, "feature string, total double, rows long")
    sums = sums.unionByName(frame.sparkSession.createDataFrame([(x, 0.0, 0) for x in model.inputs], sums.schema))
    sums = sums.groupBy("feature").agg(F.sum("total").alias("total"), F.sum("rows").alias("rows"))
    return sums.select("feature", F.expr("CASE WHEN rows > 0 THEN total / rows ELSE 0D END").alias("importance"))
