"""Exact dedup against a plain dictionary."""

import hashlib
from collections import defaultdict

import numpy as np
import pyarrow as pa

from barloom.llm import exact_dedup as X

DOCS = "doc_id bigint, text string, h bigint, word string, id int, sha string"


def brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    out = []
    for i, t in rows:
        known = [x for x in groups[t or ""] if x is not None]
        keep = max(known) if known else None
        out.append((i, keep, len(groups[t or ""]), i == keep, hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=str)


def run(spark, rows):
    df = spark.createDataFrame([(i, t, 1, "w", 2, None) for i, t in rows], DOCS).repartition(5)
    return sorted((tuple(r) for r in X.exact_dedup(df).collect()), key=str)


def test_equals_dictionary(spark):
    texts = ["a", "b", "a", None, "", "A", "a ", "x" * 300_000, "x" * 300_000, *["hot"] * 500, *[f"t{i % 700}" for i in range(1000)]]
    rows = [*enumerate(texts), (3, None), (None, "b"), (None, "only"), (None, "only"), (0, "a")]
    assert run(spark, rows) == brute(rows)


def test_empty(spark):
    assert run(spark, []) == []


def test_drop_keeps_columns(spark):
    df = spark.createDataFrame([(1, "a", 1, "w", 2, "s"), (2, "a", 1, "w", 2, "s"), (3, None, None, None, None, None)], DOCS)
    out = X.drop_copies(df)
    assert out.columns == df.columns and sorted(r.doc_id for r in out.collect()) == [2, 3]


def test_filter_never_misses_a_repeat():
    h = np.random.default_rng(5).integers(-(2**63), 2**63 - 1, 20_000)
    h = np.concatenate([h, h[:300]])
    np.random.default_rng(6).shuffle(h)
    batches = [pa.RecordBatch.from_arrays([pa.array(h[k : k + 97]), pa.array(np.zeros(len(h[k : k + 97]), bool))], ["h", "twice"]) for k in range(0, len(h), 97)]
    found = np.unique(np.concatenate([b.column(0).to_numpy() for b in X._bloom_repeated(iter(batches))]))
    values, counts = np.unique(h, return_counts=True)
    assert set(values[counts > 1]) <= set(found) and len(found) < 500
