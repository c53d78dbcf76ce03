"""Near-duplicate vectors by an inverted multi-index.

Unit vectors are cut into two halves, each with a codebook of its own; the pairs of codes form a
grid of cells, and every vector is in one. A vector looks for partners in cells near its own: the
cost of a cell is the sum of the squared distances of the vector's halves to the borders that
part them from the cell's codes, and the two sequences of codes, each by ascending distance, are
walked together so that cells come up in order of cost, until the cost exceeds the reach. Where
a partner at the threshold lies off in a random direction, it has crossed borders that far away
with a probability under one in a thousand; links within the sample may widen the reach further.
What a visited cell holds is compared exactly.

A task has some cells of one row of the grid and a share of the vectors that visit them; hot cells
and hot queries are split by the counts of a first pass. Tasks give back how many links each
vector has there and a spanning forest of the links, never the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import cut_lineage, register, table
from barloom.llm.components import components
from barloom.llm.textnum import mix

#: Distinct vectors that codebooks and reach are fitted on, about.
SAMPLE = 20_000
#: Of those, the ones whose partners in the sample are looked up to check the reach.
PROBES = 2_000
#: Share of the links in the sample that the reach has to cover.
RECALL = 0.999
#: Most codes of a half.
CODES = 1024
#: Border distances count in units of a threshold partner's standard deviation along one direction.
DEVIATIONS = 3.0
#: Bytes of members, and of visitors, in one task's matrices of doubles.
MEMBER_BYTES, VISITOR_BYTES = 4 << 20, 16 << 20
#: Cells of one block of a matrix product.
PRODUCT = 1 << 21


def _raw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """id, number of components and bytes of each vector; null bytes for those that link with nothing."""
    for b in batches:
        n, raw = [], []
        for v in b.column(1):
            x = v.values if v.is_valid else None
            if x is None or not len(x) or x.null_count:
                n.append(0)
                raw.append(None)
                continue
            x = x.to_numpy(zero_copy_only=False)
            fine = np.isfinite(x).all() and x.any()
            n.append(len(x))
            raw.append((x + 0).tobytes() if fine else None)
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int32()), pa.array(raw, pa.binary())], ["id", "dims", "x"])


def unit_rows(raw: list[bytes], kind: str) -> np.ndarray:
    """The vectors as rows of length one, in doubles."""
    x = np.frombuffer(b"".join(raw), kind).reshape(len(raw), -1).astype(float) if raw else np.zeros((0, 0))
    x = x / np.abs(x).max(axis=1, keepdims=True, initial=1e-300)  # squares neither overflow nor vanish
    return x / np.linalg.norm(x, axis=1, keepdims=True)


class Half(NamedTuple):
    """A codebook, its codes' squared lengths, and the distances between codes."""

    codes: np.ndarray
    squares: np.ndarray
    apart: np.ndarray

    def borders(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each vector's code, and its squared distance to the border between that code's region and each other's."""
        far = self.squares - 2.0 * (x @ self.codes.T)
        own = far.argmin(axis=1)
        rows = np.arange(len(x))
        gap = (far - far[rows, own][:, None]) / self.apart[own]
        gap[rows, own] = 0.0
        return own, gap * gap


def fit_half(x: np.ndarray, k: int, rounds: int = 8) -> Half:
    """Codes by Lloyd's rounds from rows spread over the sample; equal codes are merged."""
    codes = np.unique(x, axis=0)
    draw = np.random.default_rng(7)
    codes = codes[np.sort(draw.choice(len(codes), min(k, len(codes)), replace=False))]
    for _ in range(rounds):
        own = ((codes * codes).sum(axis=1) - 2.0 * (x @ codes.T)).argmin(axis=1)
        n = np.bincount(own, minlength=len(codes))
        total = np.stack([np.bincount(own, column, len(codes)) for column in x.T], axis=1) if x.shape[1] else np.zeros_like(codes)
        codes = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], codes)
    codes = np.unique(codes, axis=0)
    squares = (codes * codes).sum(axis=1)
    apart = 2.0 * np.sqrt(np.maximum(squares[:, None] + squares - 2.0 * (codes @ codes.T), 0.0))
    return Half(codes, squares, np.where(apart > 0, apart, np.inf))


class Index(NamedTuple):
    first: Half
    second: Half
    cut: int
    reach: float

    def visits(self, x: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
        """For each row its own cell (i, j) and the cells it visits, i * codes of the second half + j, cheapest first."""
        own_i, cost_i = self.first.borders(x[:, : self.cut])
        own_j, cost_j = self.second.borders(x[:, self.cut :])
        for i, j, a, b in zip(own_i.tolist(), own_j.tolist(), cost_i, cost_j):
            yield i, j, walk(a, b, self.reach)


def walk(a: np.ndarray, b: np.ndarray, reach: float) -> np.ndarray:
    """Cells (row * len(b) + column) with a[row] + b[column] <= reach, cheapest first.

    Both sequences are taken in ascending order; under each entry of the first, the columns within
    reach are a shrinking head of the second, so the walk follows the edge of that staircase.
    """
    order_a, order_b = np.argsort(a, kind="stable"), np.argsort(b, kind="stable")
    order_a = order_a[: int(np.searchsorted(a[order_a], reach, "right"))]
    heads = np.searchsorted(b[order_b], reach - a[order_a], "right")
    row = np.repeat(order_a, heads)
    column = order_b[np.arange(len(row)) - np.repeat(np.cumsum(heads) - heads, heads)]
    return (row * len(b) + column)[np.argsort(a[row] + b[column], kind="stable")]


def fit(x: np.ndarray, n: int, threshold: float) -> Index:
    """An index for ``n`` vectors from a sample of unit rows."""
    k = 1 << max(0, min(CODES.bit_length() - 1, round(np.log2(max(np.sqrt(n) / 6, 1)))))
    cut = x.shape[1] // 2
    first, second = fit_half(x[:, :cut], k), fit_half(x[:, cut:], k)
    off = 2.0 * (1.0 - threshold)  # squared distance of two unit vectors at the threshold
    reach = DEVIATIONS**2 * off / x.shape[1]
    own = first.borders(x[:, :cut])[0], second.borders(x[:, cut:])[0]
    costs = []
    for k in range(0, min(PROBES, len(x)), 500):
        probe = x[k : min(k + 500, PROBES)]
        a, b = np.nonzero(probe @ x.T >= threshold)
        other = a + k != b
        a, b = a[other], b[other]
        costs.append(first.borders(probe[:, :cut])[1][a, own[0][b]] + second.borders(probe[:, cut:])[1][a, own[1][b]])
    found = np.concatenate(costs) if costs else np.zeros(0)
    if len(found):
        reach = max(reach, float(np.quantile(found, RECALL)))
    return Index(first, second, cut, min(reach, off))  # beyond ``off`` no partner can lie


def whole(dims: int) -> Index:
    """The index of vectors of a length that the sample has none of: one cell."""
    halves = [Half(np.zeros((1, n)), np.zeros(1), np.full((1, 1), np.inf)) for n in (dims // 2, dims - dims // 2)]
    return Index(*halves, dims // 2, 0.0)


class Layout(NamedTuple):
    """Where a grid's cells are worked on: first task and number of pieces of each cell, visitors' shares of each task."""

    task: np.ndarray
    pieces: np.ndarray
    shares: np.ndarray


def lay_out(members: np.ndarray, visitors: np.ndarray, most: int, most_visitors: int, first: int) -> Layout:
    """Tasks, numbered from ``first``: cells of a grid row side by side up to ``most`` members, larger cells in pieces."""
    task, pieces = np.zeros(members.shape, np.int64), np.ones(members.shape, np.int64)
    seen: list[int] = []
    for i in range(members.shape[0]):
        room = 0
        for j in np.flatnonzero(members[i]).tolist():
            n, v = int(members[i, j]), int(visitors[i, j])
            pieces[i, j] = -(-n // most)
            if n > most:
                task[i, j] = len(seen)
                seen += [v] * int(pieces[i, j])
                room = 0
                continue
            if n > room:
                seen.append(0)
                room = most
            task[i, j] = len(seen) - 1
            seen[-1] += v
            room -= n
    return Layout(task + first, np.where(members > 0, pieces, 0), np.maximum(1, -(-np.array(seen, np.int64) // most_visitors)))


def _classes(b: pa.RecordBatch, kind: str) -> Iterator[tuple[int, np.ndarray, np.ndarray, list[bytes], np.ndarray]]:
    """By number of components: that, class ids, weights, bytes and unit rows of a batch of classes."""
    dims, raw = b.column(1).to_numpy(), b.column(3).to_pylist()
    c, w = b.column(0).to_numpy(), b.column(2).to_numpy()
    for d in np.unique(dims).tolist():
        at = np.flatnonzero(dims == d)
        for k in range(0, len(at), 2000):
            own = [raw[i] for i in at[k : k + 2000]]
            yield d, c[at[k : k + 2000]], w[at[k : k + 2000]], own, unit_rows(own, kind)


def _tally(indexes: dict[int, Index], kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Members and visitors of the cells, a row for each cell of a batch that has some."""
        for b in batches:
            sums: dict[int, np.ndarray] = {}
            for d, _, _, _, x in _classes(b, kind):
                index = indexes[d]
                wide = len(index.second.codes)
                grid = sums.setdefault(d, np.zeros((2, len(index.first.codes) * wide), np.int64))
                for i, j, cells in index.visits(x):
                    grid[0, i * wide + j] += 1
                    grid[1, cells] += 1
            rows = [(d, int(cell), int(g[0, cell]), int(g[1, cell])) for d, g in sums.items() for cell in np.flatnonzero(g.any(axis=0))]
            columns = list(zip(*rows)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], ["dims", "cell", "members", "visitors"])

    return run


def _deal(indexes: dict[int, Index], layouts: dict[int, Layout], first_task: dict[int, int], kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each vector to the task of its own cell (side 0; once a share) and to those of cells it visits (side 1)."""
        for b in batches:
            for d, c, w, raw, x in _classes(b, kind):
                index, layout = indexes[d], layouts[d]
                wide = len(index.second.codes)
                lot = mix(c.view(np.uint64))
                who, side, task, share, cells = [], [], [], [], []
                for k, (i, j, visited) in enumerate(index.visits(x)):
                    t = int(layout.task[i, j] + lot[k] % np.uint64(layout.pieces[i, j]))
                    for s in range(int(layout.shares[t - first_task[d]])):
                        who.append(k)
                        side.append(0)
                        task.append(t)
                        share.append(s)
                        cells.append(np.array([i * wide + j], np.int32).tobytes())
                    t, n = layout.task.ravel()[visited], layout.pieces.ravel()[visited]
                    visited, t, n = visited[n > 0], t[n > 0], n[n > 0]
                    t, visited = np.repeat(t, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n), np.repeat(visited, n)
                    order = np.argsort(t, kind="stable")
                    t, visited = t[order], visited[order]
                    heads = np.flatnonzero(np.diff(t, prepend=-1))
                    for a, z in zip(heads.tolist(), [*heads[1:].tolist(), len(t)]):
                        who.append(k)
                        side.append(1)
                        task.append(int(t[a]))
                        share.append(int((lot[k] >> np.uint64(20)) % np.uint64(layout.shares[t[a] - first_task[d]])))
                        cells.append(visited[a:z].astype(np.int32).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(task, pa.int64()), pa.array(share, pa.int64()), pa.array(side, pa.int32()), pa.array(c[who] if who else [], pa.int64()),
                        pa.array(w[who] if who else [], pa.int64()), pa.array(cells, pa.binary()), pa.array([raw[k] for k in who], pa.binary()),
                    ],
                    ["task", "share", "side", "c", "w", "cells", "x"],
                )

    return run


class Forest:
    """Smallest node reachable over links, links added many at a time."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        root = self.root
        while True:
            x, y = root[a], root[b]
            differ = x != y
            if not differ.any():
                return
            a, b, x, y = a[differ], b[differ], x[differ], y[differ]
            np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
            while ((above := root[root]) != root).any():
                root[:] = above


FOUND = "c bigint, n bigint, other bigint"


def _compare(threshold: float, kind: str):
    def run(rows: pa.Table) -> pa.Table:
        """Of a task's members and visitors: links of each visitor there, and a forest of the links."""
        side = rows.column("side").to_numpy()
        c, w = rows.column("c").to_numpy(), rows.column("w").to_numpy()
        nodes, node = np.unique(c, return_inverse=True)
        links, forest = np.zeros(len(nodes), np.int64), Forest(len(nodes))
        cells, raw = rows.column("cells").to_pylist(), rows.column("x").to_pylist()
        members, visitors = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        if len(members) and len(visitors):
            x = unit_rows([raw[i] for i in members], kind)
            y = unit_rows([raw[i] for i in visitors], kind)
            cell = np.frombuffer(b"".join(cells[i] for i in members), np.int32)
            each = [np.frombuffer(cells[i], np.int32) for i in visitors]
            who, visited = np.repeat(np.arange(len(visitors)), list(map(len, each))), np.concatenate(each)
            order = np.argsort(visited, kind="stable")
            who, visited = who[order], visited[order]
            for one in np.unique(cell).tolist():
                m = np.flatnonzero(cell == one)
                q = who[np.searchsorted(visited, one) : np.searchsorted(visited, one, "right")]
                step = max(1, PRODUCT // len(m))
                for k in range(0, len(q), step):
                    part = q[k : k + step]
                    a, b = np.nonzero(y[part] @ x[m].T >= threshold)
                    a, b = node[visitors[part[a]]], members[m[b]]
                    other = a != node[b]
                    a, b = a[other], b[other]
                    links += np.bincount(a, w[b], len(nodes)).astype(np.int64)
                    forest.add(a, node[b])
        return pa.table({"c": nodes, "n": links, "other": nodes[forest.root]})

    return run


def embed_dedup(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = 0.95, sample: int = SAMPLE) -> DataFrame:
    """One row per row of ``vectors``: id_col, n_links, component_id, kept.

    Vectors are linked when their cosine in double precision is ``threshold`` or more and one finds
    the other. n_links counts the other rows that a row finds; component_id is the smallest id
    reachable over links, the row's own included. Equal vectors are one class, so all rows of a
    class are linked. Vectors that are null, empty or zero or hold null or non-finite components
    link with nothing and are components of their own; vectors of different lengths never link.
    A null id is never a component_id; a row with one is kept only if its component has no other
    id. Repeated rows count as other rows. An empty table gives no rows. Other columns are not
    read. The index is fitted on about ``sample`` distinct vectors chosen by hash; all are in it.
    """
    kind = "f4" if vectors.schema[vector_col].dataType.elementType.typeName() == "float" else "f8"
    element = "float" if kind == "f4" else "double"
    given = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast(f"array<{element}>").alias("v"))
    rows = given.mapInArrow(_raw, "id bigint, dims int, x binary").withColumn("key", F.unhex(F.md5("x")))
    classes = cut_lineage(
        rows.filter("x is not null").groupBy("key").agg(
            F.min("id").alias("least_id"), F.count(F.lit(1)).alias("w"), F.any_value("dims").alias("dims"), F.any_value("x").alias("x")
        ).withColumn("c", F.monotonically_increasing_id())
    )
    totals = {r["dims"]: r["n"] for r in classes.groupBy("dims").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = min(1.0, sample / max(sum(totals.values()), 1))
    chosen = classes.filter(F.pmod(F.xxhash64("key"), F.lit(1 << 20)) < F.lit(share * (1 << 20))).select("dims", "x").toArrow()
    indexes = {d: whole(d) for d in totals}
    for d in sorted(set(chosen.column("dims").to_pylist())):
        own = chosen.filter(pc.equal(chosen.column("dims"), d)).column("x").to_pylist()
        indexes[d] = fit(unit_rows(sorted(own), kind), totals[d], threshold)
    coded = classes.select("c", "dims", "w", "x")
    tallies = coded.mapInArrow(_tally(indexes, kind), "dims bigint, cell bigint, members bigint, visitors bigint")
    tallies = tallies.groupBy("dims", "cell").agg(F.sum("members").alias("members"), F.sum("visitors").alias("visitors")).toArrow().to_pylist()
    layouts, first_task, tasks = {}, {}, 0
    for d in totals:
        index = indexes[d]
        shape = (len(index.first.codes), len(index.second.codes))
        members, visitors = np.zeros(shape, np.int64), np.zeros(shape, np.int64)
        for t in tallies:
            if t["dims"] == d:
                members.ravel()[t["cell"]], visitors.ravel()[t["cell"]] = t["members"], t["visitors"]
        layouts[d] = lay_out(members, visitors, max(64, MEMBER_BYTES // (8 * d)), max(256, VISITOR_BYTES // (8 * d)), tasks)
        first_task[d] = tasks
        tasks += len(layouts[d].shares)
    dealt = coded.mapInArrow(
        _deal(indexes, layouts, first_task, kind), "task bigint, share bigint, side int, c bigint, w bigint, cells binary, x binary"
    )
    found = cut_lineage(dealt.groupBy("task", "share").applyInArrow(_compare(threshold, kind), FOUND))
    label = components(found.filter("c <> other"), "c", "other")
    counts = found.groupBy("c").agg(F.sum("n").alias("n"))
    placed = classes.select("c", "key", "w", "least_id").join(counts, "c", "left").join(label.withColumnRenamed("node", "c"), "c", "left").select(
        "key", (F.col("w") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), F.coalesce("label", "c").alias("label"), "least_id"
    )
    placed = cut_lineage(placed)
    smallest = placed.groupBy("label").agg(F.min("least_id").alias("component_id"))
    by_key = placed.join(smallest, "label").select("key", "n_links", "component_id")
    out = rows.select("id", "key").join(by_key, "key", "left").withColumn(
        "component_id", F.when(F.col("key").isNull(), F.col("id")).otherwise(F.col("component_id"))
    )
    return out.select(
        F.col("id").alias(id_col),
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        "component_id",
        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"),
    )


@register("op12_embedding_near_dedup")
def op12_embedding_near_dedup(spark, d):
    return embed_dedup(table(spark, d, "embeddings"))
