"""Near-duplicate vectors against all pairs in numpy."""

import math

import numpy as np
import pytest

from barloom.llm import embed_dedup as E

SF = "/root/testdata/sf0.1"


def brute(rows, threshold=0.95):
    """(id, n_links, component_id, kept) of (id, vector) rows, all pairs compared."""
    rows = list(rows)
    fine = [v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v) for _, v in rows]
    links = [set() for _ in rows]
    for dims in {len(v) for (_, v), f in zip(rows, fine) if f}:
        at = [k for k, f in enumerate(fine) if f and len(rows[k][1]) == dims]
        x = np.array([rows[k][1] for k in at], float)
        x /= np.linalg.norm(x, axis=1)[:, None]
        for i in range(0, len(at), 1000):
            for a, b in zip(*np.nonzero(x[i : i + 1000] @ x.T >= threshold)):
                if a + i != b:
                    links[at[a + i]].add(at[b])
    out, seen = [None] * len(rows), set()
    for k in range(len(rows)):
        if k in seen:
            continue
        group, open_ = {k}, [k]
        while open_:
            for other in links[open_.pop()] - group:
                group.add(other)
                open_.append(other)
        seen |= group
        least = min((rows[g][0] for g in group if rows[g][0] is not None), default=None)
        for g in group:
            out[g] = (rows[g][0], len(links[g]), least, rows[g][0] == least)
    return sorted(out, key=str)


def run(spark, rows, kind="float", **more):
    df = spark.createDataFrame([(i, v, 1, 2, 3, "k") for i, v in rows], f"vec_id bigint, embedding array<{kind}>, c int, w int, task int, key string")
    return sorted((tuple(r) for r in E.embed_dedup(df.repartition(4), **more).collect()), key=str)


def near(draw, center, n, noise):
    return (center + noise * draw.normal(size=(n, len(center)))).astype(np.float32).astype(float).tolist()


@pytest.mark.parametrize("kind", ["float", "double"])
def test_equals_all_pairs(spark, kind):
    draw = np.random.default_rng(2)
    vectors = []
    for g in range(40):
        vectors += near(draw, draw.normal(size=16), int(draw.integers(1, 12)), 0.12)
    vectors += [[0.0] * 16, None, [], [1.0] * 15 + [None], [float("nan")] * 16, [float("inf")] + [0.0] * 15, vectors[0], vectors[0], [2 * x for x in vectors[1]]]
    vectors += [[1.0], [2.0], [-1.0], [1.0, 1.0, 1e-3], [1.0, 1.0, 0.0], [1e-30 * x for x in vectors[3]]]
    rows = [(3 * k, v) for k, v in enumerate(vectors)] + [(None, vectors[5]), (None, [0.0]), (6, vectors[9]), (6, vectors[9])]
    assert run(spark, rows, kind) == brute(rows)


def test_hot_cells_are_split(spark, monkeypatch):
    """A third of all vectors in one group, copies and near copies, with tasks of 64 members and 256 visitors at most."""
    monkeypatch.setattr(E, "MEMBER_BYTES", 1)
    monkeypatch.setattr(E, "VISITOR_BYTES", 1)
    draw = np.random.default_rng(4)
    hot = near(draw, 3 * draw.normal(size=8), 700, 0.15)
    vectors = hot + [hot[0]] * 300 + draw.normal(size=(1000, 8)).astype(np.float32).astype(float).tolist()
    rows = list(enumerate(vectors))
    assert run(spark, rows) == brute(rows)


def test_links_lost_without_the_sample_are_few(spark):
    """Links just over the threshold, codebooks fitted on a tenth: nine in ten are found at least."""
    draw = np.random.default_rng(6)
    centers = draw.normal(size=(800, 32))
    twins = centers + 0.31 * draw.normal(size=centers.shape)
    rows = list(enumerate(np.concatenate([centers, twins]).astype(np.float32).astype(float).tolist()))
    got, want = (sum(r[1] for r in x) for x in (run(spark, rows, sample=200), brute(rows)))
    assert want > 200 and 0.9 * want <= got <= want


def test_query_on_the_whole_table(spark):
    import __spark_entry__ as entry

    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()]
    got = entry.queries()["op12_embedding_near_dedup"](spark, SF)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows)


def test_empty_table(spark):
    assert run(spark, []) == []


def test_walk_takes_all_cells_within_reach_by_cost():
    draw = np.random.default_rng(8)
    a, b = draw.random(9), draw.random(7)
    cells = E.walk(a, b, 0.8)
    cost = (a[:, None] + b).ravel()
    assert set(cells.tolist()) == set(np.flatnonzero(cost <= 0.8).tolist()) and (np.diff(cost[cells]) >= 0).all()


def test_layout_bounds_tasks():
    members = np.array([[3, 0, 200, 5], [0, 0, 0, 0], [40, 30, 1, 1]])
    layout = E.lay_out(members, members * 10, 64, 256, 100)
    assert layout.pieces.tolist() == [[1, 0, 4, 1], [0] * 4, [1] * 4]
    assert layout.task[0].tolist()[2] == 101 and layout.task[0, 0] == 100 and layout.task[0, 3] == 105
    assert layout.task[2].tolist() == [106, 107, 107, 107] and len(layout.shares) == 8
