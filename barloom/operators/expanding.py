"""Expanding-window logistic regressions, all blocks at once.

A walk-forward refits on all earlier rows before each block of days. Here one pass gathers, by
the first block that a row trains, counts and cross products of its columns; their running sums
are every block's imputation, scaling, class weights and first Newton step. Further Newton steps
for all blocks share one pass each: a task adds up gradients and curvatures of its own rows for
the blocks they train. What leaves a task is one row a block, and what reaches the driver is
blocks times squared features numbers, whatever the rows. Scores equal separate fits.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.functions.ranks import value_bucket
from barloom.session import cut_lineage

_EPOCH = dt.date(1970, 1, 1)
#: Rows of one matrix product.
CHUNK = 2048
#: Newton steps after the first, and the largest change of a weight that ends them.
STEPS, CLOSE = 25, 1e-9


class Design(NamedTuple):
    """Columns of a model: one, features less a constant (missing: 0), whether they are missing, categories."""

    features: tuple[str, ...]
    gaps: tuple[str, ...]  # features with missing values
    categories: tuple[tuple[str, str], ...]  # (column, value)
    shift: np.ndarray
    starts: np.ndarray  # first day of each block, as day numbers; the last is the newest day

    @property
    def width(self) -> int:
        return 1 + len(self.features) + len(self.gaps) + len(self.categories)

    @property
    def terms(self) -> int:
        return 1 + len(self.features) + len(self.categories)

    def matrix(self, batch: pa.RecordBatch) -> np.ndarray:
        x = np.stack([batch.column(f).to_numpy(zero_copy_only=False).astype(float) for f in self.features], 1)
        gap = np.isnan(x)
        parts = [np.ones((len(x), 1)), np.where(gap, 0.0, x - self.shift), gap[:, [self.features.index(g) for g in self.gaps]]]
        for column in dict.fromkeys(c for c, _ in self.categories):
            own = np.array(batch.column(column).to_pylist(), object)
            parts.append(np.stack([own == v for c, v in self.categories if c == column], 1))
        return np.concatenate(parts, 1, dtype=float)

    def days(self, batch: pa.RecordBatch, order: str) -> np.ndarray:
        return batch.column(order).cast(pa.int32()).to_numpy(zero_copy_only=False)


def _packed(width: int) -> tuple[np.ndarray, np.ndarray]:
    return np.triu_indices(width)


def _square(packed: np.ndarray, width: int) -> np.ndarray:
    out = np.zeros((*packed.shape[:-1], width, width))
    i, j = _packed(width)
    out[..., i, j] = packed
    out[..., j, i] = packed
    return out


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for k in range(0, b.num_rows, CHUNK):
            yield b.slice(k, CHUNK)


def _moments(design: Design, label: str, order: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A task's cross products by the first block that a row trains and its class."""
        i, j = _packed(design.width)
        sums: dict[int, np.ndarray] = {}
        for b in _chunks(batches):
            u, y = design.matrix(b), b.column(label).to_numpy(zero_copy_only=False)
            key = np.searchsorted(design.starts, design.days(b, order), "right") * 2 + (y > 0)
            for k in np.unique(key).tolist():
                own = u[key == k]
                sums[k] = sums.get(k, 0.0) + (own.T @ own)[i, j]
        yield _rows(sums)

    return run


def _slopes(design: Design, label: str, order: str, blocks: np.ndarray, coefficients: np.ndarray, weights: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A task's losses, gradients and curvatures for the blocks that its rows train."""
        i, j = _packed(design.width)
        total = np.zeros((len(blocks), 1 + design.width + len(i)))
        for b in _chunks(batches):
            u, y = design.matrix(b), (b.column(label).to_numpy(zero_copy_only=False) > 0)[:, None]
            since = np.searchsorted(design.starts, design.days(b, order), "right")
            at = int(np.searchsorted(blocks, since.min())) if len(since) else len(blocks)  # earlier blocks have none of these rows
            if at == len(blocks):
                continue
            z = u @ coefficients[at:].T
            worth = np.where(y, weights[at:, 1], weights[at:, 0]) * (blocks[at:] >= since[:, None])
            p = 1.0 / (1.0 + np.exp(-np.clip(z, -500, 500)))
            total[at:, 0] += (worth * np.logaddexp(0.0, np.where(y, -z, z))).sum(axis=0)
            total[at:, 1 : 1 + design.width] += (worth * (y - p)).T @ u
            total[at:, 1 + design.width :] += (worth * p * (1.0 - p)).T @ (u[:, i] * u[:, j])
        yield _rows({k: t for k, t in zip(blocks.tolist(), total) if t.any()})

    return run


def _rows(sums: dict[int, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int64()), pa.array([x.tobytes() for x in sums.values()], pa.binary())], ["k", "v"])


def _add(key: tuple, rows: pa.Table) -> pa.Table:
    total = np.sum([np.frombuffer(x, float) for x in rows.column("v").to_pylist()], axis=0)
    return pa.table({"k": pa.array([key[0].as_py()], pa.int64()), "v": pa.array([total.tobytes()], pa.binary())})


def _gather(rows: DataFrame, part: Callable) -> dict[int, np.ndarray]:
    """Sums over all tasks by key; a row a key comes to the driver."""
    summed = rows.mapInArrow(part, "k bigint, v binary").groupBy("k").applyInArrow(_add, "k bigint, v binary")
    return {r["k"]: np.frombuffer(bytes(r["v"]), float) for r in summed.collect()}


def _places(blocks: int):
    def run(key: tuple, counts: pa.Table) -> pa.Table:
        """For each block the buckets and places there of a feature's two middle values."""
        bucket, q, n = (counts.column(c).to_numpy() for c in ("bucket", "q", "n"))
        names, at = np.unique(bucket, return_inverse=True)
        upto, out = np.zeros(len(names), np.int64), []
        order = np.argsort(q, kind="stable")
        edges = np.searchsorted(q[order], np.arange(blocks), "right")
        begin = 0
        for b, end in enumerate(edges.tolist()):
            own = order[begin:end]
            np.add.at(upto, at[own], n[own])
            begin, below = end, np.cumsum(upto)
            if below[-1]:
                for place in {int(below[-1] - 1) // 2, int(below[-1]) // 2}:
                    k = int(np.searchsorted(below, place, "right"))
                    out.append((key[0].as_py(), b, int(names[k]), place - int(below[k] - upto[k])))
        f, b, names, place = zip(*out) if out else ([],) * 4
        return pa.table({"feature": pa.array(f, pa.string()), "block": pa.array(b, pa.int64()), "bucket": pa.array(names, pa.int64()), "place": pa.array(place, pa.int64())})

    return run


def _pick(values: pa.Table, places: pa.Table) -> pa.Table:
    """The values at the wanted places of a bucket, among those of rows that train the block."""
    v, q, n = (values.column(c).to_numpy() for c in ("value", "q", "n"))
    order = np.argsort(v, kind="stable")
    v, q, n = v[order], q[order], n[order]
    blocks, place = places.column("block").to_numpy(), places.column("place").to_numpy()
    picked = [v[np.searchsorted(np.cumsum(n * (q <= b)), p, "right")] for b, p in zip(blocks, place)]
    return pa.table({"feature": places.column("feature"), "block": places.column("block"), "value": pa.array(picked, pa.float64())})


def expanding_medians(rows: DataFrame, features: Sequence[str], first: str, blocks: int) -> DataFrame:
    """(feature, block, median): exact medians of the known values of rows whose ``first`` is at most the block.

    Equal values of one ``first`` are counted together; bucket counts say in which bucket the middle
    lies, and only that bucket's values are put in order. A block without values has no row.
    """
    each = F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("value")) for f in features]))
    counted = rows.select(F.col(first).cast("long").alias("q"), each.alias("_e")).select("q", "_e.feature", "_e.value")
    counted = counted.filter("value is not null and not isnan(value)").groupBy("feature", "value", "q").agg(F.count(F.lit(1)).alias("n"))
    counted = cut_lineage(counted.withColumn("bucket", value_bucket(F.col("value"))))
    counts = counted.groupBy("feature", "bucket", "q").agg(F.sum("n").alias("n"))
    places = counts.groupBy("feature").applyInArrow(_places(blocks), "feature string, block bigint, bucket bigint, place bigint")
    picked = counted.groupBy("feature", "bucket").cogroup(cut_lineage(places).groupBy("feature", "bucket")).applyInArrow(
        lambda v, p: _pick(v, p), "feature string, block bigint, value double"
    )
    return picked.groupBy("feature", "block").agg(F.avg("value").alias("median"))


class Fits(NamedTuple):
    """Coefficients over a design's columns for each block that has both classes."""

    design: Design
    coefficients: np.ndarray  # nan where a block has no model


def fit_blocks(labelled: DataFrame, design: Design, label: str, order: str, balanced: bool = True, c: float = 1.0) -> Fits:
    """Ridge-penalised logistic fits for all blocks: half the squared weights plus ``c`` times the summed losses.

    Missing values take the training rows' median, features are scaled by their population
    deviation, the intercept is free. ``balanced`` weighs classes inversely to their counts.
    """
    blocks, width, p = len(design.starts), design.width, len(design.features)
    by_class = np.zeros((2, blocks + 1, width * (width + 1) // 2))
    for k, v in _gather(labelled, _moments(design, label, order)).items():
        by_class[k % 2, k // 2] += v
    sums = _square(np.cumsum(by_class, axis=1)[:, :blocks], width)  # of all rows that train a block
    counts = sums[:, :, 0, 0]
    able = np.flatnonzero((counts > 0).all(axis=0))
    coefficients = np.full((blocks, width), np.nan)
    if not len(able):
        return Fits(design, coefficients)
    n = counts.sum(axis=0)[able]
    weights = c * (n[:, None] / (2.0 * counts.T[able]) if balanced else np.ones((len(able), 2)))
    both = sums.sum(axis=0)[able]

    middle = np.zeros((len(able), p))
    if design.gaps:
        q = F.array_size(F.filter(F.array(*[F.lit(int(s)) for s in design.starts]), lambda s: s <= F.unix_date(order)))
        for r in expanding_medians(labelled.withColumn("_q", q), design.gaps, "_q", blocks).collect():
            f = design.features.index(r["feature"])
            middle[able == r["block"], f] = r["median"] - design.shift[f]
    gap = np.array([1 + p + design.gaps.index(f) if f in design.gaps else -1 for f in design.features])
    place = np.arange(1, 1 + p)
    missing = np.where(gap >= 0, both[:, gap, 0], 0.0)
    mean = (both[:, place, 0] + middle * missing) / n[:, None]
    spread = np.sqrt(np.maximum((both[:, place, place] + middle**2 * missing) / n[:, None] - mean**2, 0.0))
    spread = np.where(spread > 1e-12 * (1.0 + np.abs(mean)), spread, 1.0)
    # from weights of scaled columns to coefficients of the design's columns
    turn = np.zeros((len(able), width, design.terms))
    turn[:, 0, 0] = 1.0
    turn[:, 0, place] = -mean / spread
    turn[:, place, place] = 1.0 / spread
    for f in np.flatnonzero(gap >= 0).tolist():
        turn[:, gap[f], 1 + f] = middle[:, f] / spread[:, f]
    k = len(design.categories)
    turn[:, np.arange(width - k, width), np.arange(design.terms - k, design.terms)] = 1.0
    keep = np.ones(design.terms)
    keep[0] = 0.0

    w = np.zeros((len(able), design.terms))
    slope = np.einsum("bc,cbu->bu", weights * np.array([-0.5, 0.5]), sums[:, able, 0, :])
    curve = np.einsum("bc,cbuv->buv", weights * 0.25, sums[:, able])
    loss = (weights * counts.T[able]).sum(axis=1) * np.log(2.0)
    open_ = np.arange(len(able))
    before, best = w.copy(), loss
    for _ in range(STEPS):
        to = turn[open_]
        down = np.einsum("buf,bu->bf", to, slope) - keep * w[open_]
        bend = np.einsum("buf,buv,bvg->bfg", to, curve, to, optimize=True) + np.diag(keep) + 1e-10 * np.eye(design.terms)
        move = np.linalg.solve(bend, down[:, :, None])[:, :, 0]
        before[open_] = w[open_]
        w[open_] += move
        open_ = open_[np.abs(move).max(axis=1) > CLOSE]
        if not len(open_):
            break
        slope, curve, loss = _evaluate(labelled, design, label, order, able, open_, turn, w, weights)
        loss = loss + 0.5 * (keep * w[open_] ** 2).sum(axis=1)
        for _ in range(STEPS):  # a step that went too far is halved
            worse = loss > best[open_] + 1e-9 * np.abs(best[open_])
            if not worse.any():
                break
            far = open_[worse]
            w[far] = (w[far] + before[far]) / 2.0
            slope[worse], curve[worse], again = _evaluate(labelled, design, label, order, able, far, turn, w, weights)
            loss[worse] = again + 0.5 * (keep * w[far] ** 2).sum(axis=1)
        best[open_] = loss
    coefficients[able] = np.einsum("buf,bf->bu", turn, w)
    return Fits(design, coefficients)


def _evaluate(labelled, design, label, order, able, open_, turn, w, weights) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Gradients, curvatures and losses of some blocks at their weights: one pass over the rows."""
    coefficients = np.einsum("buf,bf->bu", turn[open_], w[open_])
    got = _gather(labelled, _slopes(design, label, order, able[open_], coefficients, weights[open_]))
    total = np.stack([got[b] for b in able[open_].tolist()])
    return total[:, 1 : 1 + design.width], _square(total[:, 1 + design.width :], design.width), total[:, 0]


def _scored(fits: Fits, order: str, model: str, current: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows with the probability of the model fitted before their block."""
        design = fits.design
        for b in batches:
            block = np.full(b.num_rows, len(design.starts) - 1)
            if not current:
                block = np.searchsorted(design.starts[:-1], design.days(b, order), "right") - 1
            known = (block >= 0) & ~np.isnan(fits.coefficients[block, 0])
            b, block = b.filter(pa.array(known)), block[known]
            z = (design.matrix(b) * fits.coefficients[block]).sum(axis=1)
            prob = 1.0 / (1.0 + np.exp(-np.clip(z, -500, 500)))
            role = pa.array(["current" if current else "eval"] * b.num_rows, pa.string())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(prob), role, pa.array([model] * b.num_rows, pa.string())], [*b.schema.names, "prob", "role", "model"])

    return run


def walk_starts(labelled: DataFrame, order: str, min_train: int, every: int) -> list:
    """First days of the blocks: every so many days from the ``min_train``-th labelled day on. Only days come to the driver."""
    days = [r[0] for r in labelled.select(order).distinct().orderBy(order).collect()]
    return days[min_train::every]


def expanding_logistic(
    rows: DataFrame, features: Sequence[str], categories: Sequence[str], label: str, min_train: int, every: int,
    balanced: bool = True, order: str = "date", model: str = "logistic",
) -> DataFrame:
    """Pooled walk-forward logistic regression: before each block of ``every`` days a fit on all earlier labelled rows.

    Adds ``prob``, ``role`` (``eval``; ``current`` for the rows of the newest day, scored by a fit on
    all earlier ones) and ``model``. Categories that the training rows do not have count as none.
    Blocks whose training rows have one class only give no rows. ``order`` is a date without nulls.
    """
    rows = cut_lineage(rows.withColumns({f: F.col(f).cast("double") for f in features}).repartitionByRange(order))
    schema = T.StructType([*rows.schema, T.StructField("prob", T.DoubleType()), T.StructField("role", T.StringType()), T.StructField("model", T.StringType())])
    labelled = rows.filter(F.col(label).isNotNull())
    starts = walk_starts(labelled, order, min_train, every)
    newest = rows.agg(F.max(order)).first()[0]
    if newest is None:
        return rows.sparkSession.createDataFrame([], schema)
    known = labelled.agg(*[F.coalesce(F.avg(F.when(~F.isnan(f), F.col(f))), F.lit(0.0)).alias(f"a_{k}") for k, f in enumerate(features)]).first()
    gaps = rows.agg(*[F.max(F.col(f).isNull() | F.isnan(f)).alias(f"g_{k}") for k, f in enumerate(features)]).first()
    values = [(c, r[0]) for c in categories for r in labelled.select(c).filter(F.col(c).isNotNull()).distinct().orderBy(c).collect()]
    design = Design(
        tuple(features), tuple(f for k, f in enumerate(features) if gaps[f"g_{k}"]), tuple(values),
        np.array([known[f"a_{k}"] for k in range(len(features))]), np.array([(d - _EPOCH).days for d in [*starts, newest]]),
    )
    fits = fit_blocks(labelled, design, label, order, balanced)
    evaluated = labelled.mapInArrow(_scored(fits, order, model, False), schema)
    return evaluated.unionByName(rows.filter(F.col(order) == F.lit(newest)).mapInArrow(_scored(fits, order, model, True), schema))

