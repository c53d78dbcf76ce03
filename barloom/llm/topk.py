"""Exact top-k search by inner product, by no-random-access aggregation over sorted lists.

Vectors become whole numbers and are dealt into blocks by id; each block of queries meets each
block of candidates in a task of its own, so a task holds at most about ``BLOCK`` candidates and
``QUERIES`` queries whatever the table. Within a block there is one list per dimension, sorted by
component. For a query the lists are read in step from their better end. A candidate's score
lies between what has been read plus the worst that its unread lists can hold, and the same plus
the values at which those lists stand. Reading stops when few candidates can still reach the
k-th best lower bound; their scores are then resolved exactly. Queries of a block go together:
each round's bounds of all of them are matrix products. The k best of each block are merged by
score, ties by smaller id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.common import cut_lineage, register, table

BLOCK = 4096
QUERIES = 1024
#: Queries whose bounds are held at once.
TOGETHER = 256
SCALE = 1024
#: Share of each list read before the bounds are looked at, round by round.
ROUNDS = (0.25, 0.5, 0.7, 0.85, 1.0)


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """id and floor(SCALE * x) as 64-bit numbers, for vectors of finite components only."""
    for b in batches:
        ids, rows = [], []
        for i, v in zip(b.column(0).to_pylist(), b.column(1), strict=True):
            if i is None or not v.is_valid or not len(v.values) or v.values.null_count:
                continue
            x = v.values.to_numpy(zero_copy_only=False).astype(float)
            if np.isfinite(x).all():
                ids.append(i)
                rows.append(np.floor(SCALE * x).astype(np.int64).tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(rows, pa.binary())], ["vec_id", "x"])


class Lists:
    """A block of candidates: one list per dimension, in ascending order of the component."""

    def __init__(self, ids: np.ndarray, x: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.x = ids[order], x[order]
        self._floats = self.x.astype(float)
        self._values = np.sort(self._floats, axis=0)

    def best(self, query_id: int, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best candidates other than query_id itself, best first."""
        return self.best_of(np.array([query_id]), q[None], k)[0]

    def best_of(self, query_ids: np.ndarray, queries: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """``best`` of each row of ``queries``.

        How far a round reads a list is the same for all queries that read it from one end, so the
        bounds of all of them are two matrix products a round.
        """
        out: list[tuple[np.ndarray, np.ndarray]] = []
        for first in range(0, len(queries), TOGETHER):
            out += self._best_of(query_ids[first : first + TOGETHER], queries[first : first + TOGETHER], k)
        return out

    def _best_of(self, query_ids: np.ndarray, queries: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        n, dims = self.x.shape
        out: list = [None] * len(queries)
        weights = np.concatenate([np.maximum(queries, 0), np.minimum(queries, 0)], axis=1).astype(float)
        bottom, top = self._values[0], self._values[-1]
        # for rounding of the bounds only
        slack = 1e-9 * (1.0 + np.abs(weights).sum(axis=1) + np.abs(weights) @ np.tile(np.maximum(np.abs(bottom), np.abs(top)), 2))
        left = np.arange(len(queries))
        for share in ROUNDS:
            done = max(int(n * share), 1) if share < 1 else n
            # where the lists stand: read downwards for positive weights, upwards for negative ones
            down, up = self._values[n - done], self._values[done - 1]
            high = weights[left] @ np.concatenate([np.maximum(self._floats, down), np.minimum(self._floats, up)], axis=1).T
            low = weights[left] @ np.concatenate([np.where(self._floats >= down, self._floats, bottom), np.where(self._floats <= up, self._floats, top)], axis=1).T
            own = query_ids[left, None] == self.ids
            high[own] = low[own] = -np.inf
            bar = np.partition(low, -k, axis=1)[:, -k] if n > k else np.full(len(left), -np.inf)
            can = (high + slack[left, None] >= bar[:, None]) & ~own
            ends = (can.sum(axis=1) <= max(4 * k, n // 32)) | (done == n)
            for at in np.flatnonzero(ends):
                open_ = np.flatnonzero(can[at])
                score = self.x[open_] @ queries[left[at]]
                order = np.lexsort((self.ids[open_], -score))[:k]
                out[left[at]] = self.ids[open_][order], score[order]
            left = left[~ends]
            if not len(left):
                break
        return out


FOUND = "query_id bigint, vec_id bigint, score bigint"


def _search(k: int):
    def run(key: tuple, group: pa.Table) -> pa.Table:
        """All queries of a group (side 1) against its candidates (side 0)."""
        side = group.column("side").to_numpy()
        ids = group.column("vec_id").to_numpy()
        raw = group.column("x").to_pylist()
        out: list[tuple[int, np.ndarray, np.ndarray]] = []
        if 0 in side and 1 in side:
            own, asked = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
            x, q = (np.frombuffer(b"".join(raw[i] for i in at), np.int64).reshape(len(at), -1) for at in (own, asked))
            out = [(i, *found) for i, found in zip(ids[asked], Lists(ids[own], x).best_of(ids[asked], q, k))]
        return pa.table(
            {
                "query_id": pa.array([q for q, v, _ in out for _ in v], pa.int64()),
                "vec_id": pa.array([int(i) for _, v, _ in out for i in v], pa.int64()),
                "score": pa.array([int(s) for _, _, x in out for s in x], pa.int64()),
            }
        )

    return run


def _each(cells: int):
    """A row for each cell number."""
    return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(cells - 1).cast("long")))


def search(vectors: DataFrame, is_query, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for each row where ``is_query`` (a condition on id_col) its k best other rows.

    Scores are inner products of the whole-number vectors and must fit into 64 bits; ranks count
    from 1, ties go to the smaller id. Rows whose id or vector is null, whose vector is empty or
    has a null or non-finite component take no part. Vectors meet only those of their own length.
    Rows with one id count once (the largest of its vectors). A query without candidates has no
    rows; an empty table gives none. Other columns are not read.
    """
    given = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("x"))
    whole = given.mapInArrow(_whole, "vec_id bigint, x binary").groupBy("vec_id").agg(F.max("x").alias("x"))
    rows = cut_lineage(whole.withColumn("dims", F.octet_length("x")))
    queries = rows.filter(is_query(F.col("vec_id")))
    n, n_queries = rows.count(), queries.count()
    cells, query_cells = -(-n // BLOCK) or 1, -(-n_queries // QUERIES) or 1
    own = F.pmod(F.xxhash64("vec_id"), F.lit(cells))
    own_query = F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(query_cells))
    candidates = rows.select(
        F.lit(0).alias("side"), own.alias("cell"), _each(query_cells).alias("query_cell"), "vec_id", "x", "dims"
    )
    asked = queries.select(
        F.lit(1).alias("side"), _each(cells).alias("cell"), own_query.alias("query_cell"), "vec_id", "x", "dims"
    )
    found = candidates.unionByName(asked).groupBy("cell", "query_cell", "dims").applyInArrow(_search(k), FOUND)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"))
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


@register(
    "op8_exact_topk",
    """
    with v as (
      select vec_id, [cast(floor(1024 * cast(x as double)) as bigint) for x in embedding] x from embeddings
      where vec_id is not null and embedding is not null and len(embedding) > 0
        and len([x for x in embedding if x is null or not isfinite(x)]) = 0
    ),
    u as (select vec_id, len(x) dims, x from v),
    p as (
      select q.vec_id query_id, c.vec_id, cast(list_sum([z[1] * z[2] for z in list_zip(q.x, c.x)]) as bigint) score
      from u q join u c on c.vec_id <> q.vec_id and c.dims = q.dims where q.vec_id % 100 = 0
    ),
    r as (select *, row_number() over (partition by query_id order by score desc, vec_id) as "rank" from p)
    select query_id, cast("rank" as integer) "rank", vec_id, score from r where "rank" <= 10
    """,
)
def op8_exact_topk(spark, d):
    return search(table(spark, d, "embeddings"), lambda i: i % 100 == 0)
