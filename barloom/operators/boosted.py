"""Expanding-window boosted trees, the blocks side by side.

A walk-forward refits on all earlier rows before each block of days. A distributed fit of boosted
trees is some 200 passes over its rows, and a walk-forward has hundreds of such fits. Here tasks
fit whole blocks on their own instead, every so many blocks one task: rows go to each task once,
in order of time, so that a block's training rows are the first so many. What leaves a task is one
small model a block, and scoring reads the rows once with all models at hand.

The model is that of Spark ML's GBTClassifier after ``models.preprocessing``: medians for missing
values, scaling, one column a category; regression trees on the log loss's residuals, of splits
between ``BINS`` bins by count. Candidates for splits come from all training rows, where Spark ML
draws 10,000 of them. Up to that number scores equal separate fits, but for ties of gains.
"""

from __future__ import annotations

import datetime as dt
import pickle
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_EPOCH = dt.date(1970, 1, 1)
#: Bins of a feature.
BINS = 32
#: Labelled rows up to which a task can hold all of them with the columns of a model.
ROWS = 500_000
#: Share of the squared residuals below which a gain is taken for rounding, and closeness of gains that count as equal.
NOISE, TIE = 1e-13, 1e-12


class Boosted(NamedTuple):
    """A fitted model; trees are full: node k has the children 2k + 1 and 2k + 2, rows above its cut go right."""

    middle: np.ndarray  # of features: for missing values
    mean: np.ndarray
    scale: np.ndarray
    values: list[list[str]]  # of each category column, those with a column of their own
    feature: np.ndarray  # trees x inner nodes
    cut: np.ndarray
    leaf: np.ndarray  # trees x leaves
    weight: np.ndarray  # of trees

    def matrix(self, x: np.ndarray, categories: Sequence[np.ndarray]) -> np.ndarray:
        x = (np.where(np.isnan(x), self.middle, x) - self.mean) * self.scale
        own = [(c == v)[:, None] for c, names in zip(categories, self.values) for v in names]
        return np.concatenate([x, *own], axis=1, dtype=float)

    def prob(self, x: np.ndarray, categories: Sequence[np.ndarray]) -> np.ndarray:
        """Probability of class 1; x has the features of each row, categories the values of each column."""
        x, trees = self.matrix(x, categories), np.arange(len(self.weight))
        at, row = np.zeros((len(x), len(trees)), np.int64), np.arange(len(x))[:, None]
        while self.feature.shape[1] > at.max(initial=0):
            at = 2 * at + 1 + (x[row, self.feature[trees, at]] > self.cut[trees, at])
        margin = self.leaf[trees, at - self.feature.shape[1]] @ self.weight
        return 1.0 / (1.0 + np.exp(-2.0 * margin))


def cuts_between(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Cuts between ordered distinct values for bins of about equal counts; all cuts if there are few values."""
    n = int(counts.sum())
    bins = min(BINS, n)
    middle = (values[:-1] + values[1:]) / 2.0
    if len(middle) < bins:
        return middle
    upto = np.cumsum(counts)
    # a cut lies before the first value with which the count is further from its target than without it
    pairs, stride, out, at = upto[:-1] + upto[1:], n / bins, [], 0
    while True:
        at = max(at, int(np.searchsorted(pairs, 2.0 * stride * (len(out) + 1), "right")))
        if at >= len(pairs):
            return middle[out]
        out.append(at)
        at += 1


class Bins(NamedTuple):
    """Training rows of a block by bin.

    Two features, and the columns of a category, are counted at a time by a number of both bins, or
    of the category.
    """

    codes: list[np.ndarray]  # of each column, the bin of each row
    cuts: list[np.ndarray]
    joint: list[tuple[np.ndarray, int, bool, tuple[int, ...]]]  # numbers of rows, how many there are, whether of two features, columns

    def histograms(self, node: np.ndarray, nodes: int, weights: np.ndarray | None = None) -> np.ndarray:
        """Sums of weights, or counts, by column, node and bin."""
        out = np.zeros((len(self.codes), nodes, BINS))
        places = {width: node * width for _, width, *_ in self.joint} if nodes > 1 else {}
        for number, width, two, columns in self.joint:
            at = number + places[width] if nodes > 1 else number
            sums = np.bincount(at, weights, nodes * width).reshape(nodes, width)
            if two:
                for c, side in zip(columns, (2, 1)):
                    out[c] = sums.reshape(nodes, BINS, BINS).sum(axis=side)
            else:
                for k, c in enumerate(columns):
                    out[c, :, 1], out[c, :, 0] = sums[:, k], sums.sum(axis=1) - sums[:, k]
        return out


def grow(bins: Bins, target: np.ndarray, depth: int, root: np.ndarray):
    """A regression tree: (features, cuts, leaf values) of its nodes, and the leaf of each row.

    ``root`` has counts of rows by column, one node and bin. A node without a gain sends its rows
    left and has its value in all leaves below.
    """
    inner = 2**depth - 1
    feature, cut = np.zeros(inner, np.int64), np.full(inner, np.inf)
    node = np.zeros(len(target), np.intp)
    value, alive = np.array([target.mean()]), np.array([True])
    least = NOISE * float(target @ target)
    for level in range(depth):
        nodes = 2**level
        left = np.cumsum(bins.histograms(node, nodes, target), axis=2)
        left_n = np.cumsum(bins.histograms(node, nodes) if level else root, axis=2)
        n, s = left_n[:, :, -1:], left[:, :, -1:]
        right_n, right = n - left_n, s - left
        with np.errstate(all="ignore"):
            gain = np.where((left_n > 0) & (right_n > 0), left**2 / left_n + right**2 / right_n - s**2 / n, 0.0)
        gain = gain.transpose(1, 0, 2).reshape(nodes, -1)
        top = gain.max(axis=1)
        best = (gain >= (1.0 - TIE) * top[:, None]).argmax(axis=1)
        alive = alive & (top > least)
        f, b = best // BINS, best % BINS
        own, below = np.arange(nodes), np.repeat(value, 2)
        with np.errstate(all="ignore"):
            for side, (m, t) in enumerate(((left_n, left), (right_n, right))):
                below[side::2] = np.where(alive, t[f, own, b] / m[f, own, b], value)
        node *= 2
        for k in own[alive]:
            feature[nodes - 1 + k], cut[nodes - 1 + k] = f[k], bins.cuts[f[k]][b[k]]
            node += (node == 2 * k) & (bins.codes[f[k]] > b[k])
        value, alive = below, np.repeat(alive, 2)
    return feature, cut, value, node


class Sample(NamedTuple):
    """Labelled rows in order of time, and the order of each feature's known values."""

    x: np.ndarray  # features x rows
    categories: list[np.ndarray]
    y: np.ndarray
    order: list[np.ndarray]

    @classmethod
    def of(cls, x: np.ndarray, categories: list[np.ndarray], y: np.ndarray) -> Sample:
        order = [np.argsort(v, kind="stable")[: int((~np.isnan(v)).sum())].astype(np.int32) for v in x]
        return cls(x, categories, y, order)


def fit(sample: Sample, n: int, depth: int, trees: int, step: float) -> Boosted:
    """The model of the first ``n`` rows."""
    codes, cuts, middle, mean, scale = [], [], [], [], []
    for v, order in zip(sample.x, sample.order):
        known = v[order[order < n]]
        if not len(known):
            raise ValueError("a feature has no known value in a block's training rows, so none can stand for missing ones")
        middle.append(known[(len(known) - 1) // 2])
        v, missing = v[:n], n - len(known)
        if missing:
            v = np.where(np.isnan(v), middle[-1], v)
        spread = v.std(ddof=1) if n > 1 else 0.0
        mean.append(v.mean())
        scale.append(1.0 / spread if spread > 0 else 0.0)
        known = (known - mean[-1]) * scale[-1]
        first = np.flatnonzero(np.append(True, known[1:] > known[:-1]))
        counts = np.diff(np.append(first, len(known)))
        if missing:
            counts[np.searchsorted(first, (len(known) - 1) // 2, "right") - 1] += missing
        cuts.append(cuts_between(known[first], counts))
        codes.append(np.searchsorted(cuts[-1], (v - mean[-1]) * scale[-1], "left").astype(np.uint8))
    joint, values = [], []
    for f in range(0, len(codes), 2):
        first = codes[f].astype(np.intp) * BINS
        joint.append((first + codes[f + 1] if f + 1 < len(codes) else first, BINS * BINS, True, (f, f + 1)[: len(codes) - f]))
    for own in sample.categories:
        names, counts = np.unique(np.array([v for v in own[:n] if v is not None], str), return_counts=True)
        values.append([str(v) for v in names[np.argsort(-counts, kind="stable")]])
        number = np.full(n, len(values[-1]), np.intp)
        for k, v in enumerate(values[-1]):
            codes.append((own[:n] == v).astype(np.uint8))
            cuts.append(np.array([0.5]))
            number[codes[-1] > 0] = k
        joint.append((number, len(values[-1]) + 1, False, tuple(range(len(codes) - len(values[-1]), len(codes)))))
    bins = Bins(codes, cuts, joint)
    root = bins.histograms(np.zeros(n, np.intp), 1)
    y = np.where(sample.y[:n] > 0, 1.0, -1.0)
    margin, out = np.zeros(n), []
    weight = np.array([1.0, *[step] * (trees - 1)])
    for w in weight:
        target = y if not out else 4.0 * y / (1.0 + np.exp(2.0 * y * margin))
        *tree, node = grow(bins, target, depth, root)
        margin += w * tree[2][node]
        out.append(tree)
    feature, cut, leaf = (np.stack(z) for z in zip(*out))
    return Boosted(np.array(middle), np.array(mean), np.array(scale), values, feature, cut, leaf, weight)


def _columns(b: pa.RecordBatch | pa.Table, features: Sequence[str], categories: Sequence[str]) -> tuple[np.ndarray, list[np.ndarray]]:
    x = np.stack([b.column(f).to_numpy(zero_copy_only=False) for f in features])
    return x.astype(float, copy=False), [np.array(b.column(c).cast(pa.string()).to_pylist(), object) for c in categories]


def _fits(features, categories, label: str, order: str, starts: np.ndarray, parts: int, depth: int, trees: int, step: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Models of every ``parts``-th block, for each part that has its rows here."""
        held: dict[int, list[pa.RecordBatch]] = {}
        for b in batches:
            part = b.column("part").to_numpy()
            for p in np.unique(part).tolist():
                held.setdefault(p, []).append(b.filter(pa.array(part == p)))
        for p in sorted(held):
            rows = pa.Table.from_batches(held.pop(p))
            rows = rows.take(pa.array(np.argsort(_days(rows, order), kind="stable")))
            days, y = _days(rows, order), rows.column(label).to_numpy()
            sample = Sample.of(*_columns(rows, features, categories), y)
            del rows
            for k in range(p, len(starts), parts):
                n = int(np.searchsorted(days, starts[k], "left"))
                if len(np.unique(y[:n])) == 2:
                    model = pickle.dumps(fit(sample, n, depth, trees, step))
                    yield pa.RecordBatch.from_arrays([pa.array([k], pa.int64()), pa.array([model], pa.binary())], ["block", "model"])

    return run


def _days(b: pa.RecordBatch | pa.Table, order: str) -> np.ndarray:
    return b.column(order).cast(pa.int32()).to_numpy(zero_copy_only=False)


def _scored(fits: dict[int, Boosted], features, categories, order: str, starts: np.ndarray, current: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows with the probability of the model fitted before their block."""
        for b in batches:
            block = np.full(b.num_rows, len(starts) - 1) if current else np.searchsorted(starts[:-1], _days(b, order), "right") - 1
            known = np.isin(block, list(fits))
            b, block = b.filter(pa.array(known)), block[known]
            x, groups = _columns(b, features, categories)
            prob = np.empty(b.num_rows)
            for k in np.unique(block).tolist():
                own = block == k
                prob[own] = fits[k].prob(x[:, own].T, [c[own] for c in groups])
            names = [pa.array([v] * b.num_rows, pa.string()) for v in ("current" if current else "eval", "boosted")]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(prob), *names], [*b.schema.names, "prob", "role", "model"])

    return run


def expanding_boosted(
    rows: DataFrame, features: Sequence[str], categories: Sequence[str], label: str, starts: Sequence[dt.date], newest: dt.date | None,
    depth: int = 3, trees: int = 60, step: float = 0.05, order: str = "date",
) -> DataFrame:
    """Rows from each of ``starts`` to the next, and of the day ``newest``, scored by fits on all earlier labelled rows.

    ``rows`` are stored ones, with doubles as features and a label of 0, 1 or null. Adds ``prob``,
    ``role`` (``eval`` for labelled rows from the first start on, ``current`` for those of the newest
    day) and ``model``. Blocks whose training rows have one class only give no rows, nor do rows
    without a day; unknown and missing categories have no column.
    """
    schema = T.StructType([*rows.schema, T.StructField("prob", T.DoubleType()), T.StructField("role", T.StringType()), T.StructField("model", T.StringType())])
    spark = rows.sparkSession
    if newest is None:
        return spark.createDataFrame([], schema)
    days = np.array([(d - _EPOCH).days for d in [*starts, newest]])
    labelled = rows.filter(F.col(label).isNotNull() & F.col(order).isNotNull())
    parts = min(len(days), 2 * spark.sparkContext.defaultParallelism)
    part = F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part")
    each = labelled.filter(F.col(order) < F.lit(newest)).select(order, label, *features, *categories, part).repartitionById(parts, F.col("part"))
    models = each.mapInArrow(_fits(features, categories, label, order, days, parts, depth, trees, step), "block bigint, model binary")
    fits = {r["block"]: pickle.loads(bytes(r["model"])) for r in models.collect()}
    evaluated = labelled.mapInArrow(_scored(fits, features, categories, order, days, False), schema)
    now = rows.filter(F.col(order) == F.lit(newest))
    return evaluated.unionByName(now.mapInArrow(_scored(fits, features, categories, order, days, True), schema))
