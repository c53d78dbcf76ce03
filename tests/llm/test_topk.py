"""Top-k search against brute force."""

import math

import numpy as np
import pytest

from barloom.llm import topk as T


def brute(rows, k, every):
    ok = {i: np.floor(1024 * np.array(v, float)).astype(np.int64) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for q, x in ok.items():
        if q % every == 0:
            scored = sorted((-int(x @ y), i) for i, y in ok.items() if i != q and len(y) == len(x))[:k]
            out += [(q, r, i, -s) for r, (s, i) in enumerate(scored, 1)]
    return sorted(out)


def run(spark, rows, k=10, every=7):
    df = spark.createDataFrame([(i, v, 1, 2, "q") for i, v in rows], "vec_id bigint, embedding array<float>, score int, rank int, query_id string")
    return sorted(tuple(r) for r in T.search(df, lambda c: c % every == 0, k).collect())


@pytest.mark.parametrize("block", [50, 4096])
def test_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(T, "BLOCK", block)
    monkeypatch.setattr(T, "QUERIES", 20)
    r = np.random.default_rng(3)
    rows = [(i, [float(np.float32(x)) for x in r.normal(size=12)]) for i in range(300)]
    rows += [(1000 + i, [0.5] * 12) for i in range(60)] + [(2000, [0.0] * 12), (2100, [0.0] * 12)]
    rows += [(3001, None), (3003, []), (3500, [None] + [1.0] * 11), (3507, [float("nan")] * 12), (3514, [float("inf")] + [0.0] * 11), (None, [1.0] * 12)]
    rows += [(4900, [1.0, 2.0]), (4901, [3.0, -1.0]), (5600, [1.0])]
    assert run(spark, rows) == brute(rows, 10, 7)


def test_few_and_repeated_rows(spark):
    rows = [(0, [1.0, -1.0]), (7, [2.0, 0.5]), (8, [2.0, 0.5])]
    assert run(spark, rows) == brute(rows, 10, 7)
    assert run(spark, rows + rows) == brute(rows, 10, 7)
    assert run(spark, []) == []
    assert run(spark, [(1, [1.0])]) == []


def test_lists_stop_early_and_are_exact():
    r = np.random.default_rng(9)
    x = np.floor(1024 * np.abs(r.gamma(0.2, size=(3000, 8)))).astype(np.int64)
    lists = T.Lists(np.arange(3000), x)
    for q in (x[5], -x[9], np.zeros(8, np.int64), x[7] * np.array([1, 0, 0, -1, 0, 0, 0, 2])):
        ids, scores = lists.best(5, q, 10)
        want = sorted((-int(x[i] @ q), i) for i in range(3000) if i != 5)[:10]
        assert list(zip((-scores).tolist(), ids.tolist())) == want


def test_queries_of_a_block_share_their_bounds():
    """Many queries at once give what each gives alone, with ties, huge components, few candidates and stops in every round."""
    r = np.random.default_rng(4)
    for x in (
        r.integers(-300, 300, size=(2000, 16)),
        np.floor(1024 * np.abs(r.gamma(0.2, size=(2000, 8)))).astype(np.int64),
        r.integers(0, 2, size=(700, 6)),
        r.integers(-(2**29), 2**29, size=(400, 6)),
        r.integers(-9, 9, size=(5, 3)),
    ):
        ids = r.permutation(len(x)) * 3
        asked = np.arange(min(T.TOGETHER + 20, len(x)))
        queries = np.where(r.random((len(asked), 1)) < 0.1, 0, x[asked])
        for j, (found, scores) in enumerate(T.Lists(ids, x).best_of(ids[asked], queries, 10)):
            exact = x @ queries[j]
            order = [i for i in np.lexsort((ids, -exact)) if i != j][:10]
            assert (found.tolist(), scores.tolist()) == (ids[order].tolist(), exact[order].tolist())
