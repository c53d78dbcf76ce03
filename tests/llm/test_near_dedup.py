"""Near dedup against all pairs."""

import re
from itertools import combinations

import pytest

from barloom.llm import near_dedup as N

DOCS = "doc_id bigint, text string, id string, key string, label string, band int"


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + 4]) for i in range(len(w) - 3)) or frozenset([tuple(w)])


def brute(rows):
    """{(id, text): (n, component)} by all pairs and repeated merging."""
    sets = [(i, shingles(t)) for i, t in rows]
    root = list(range(len(rows)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for (x, (_, a)), (y, (_, b)) in combinations(enumerate(sets), 2):
        if a and b and 100 * len(a & b) >= 80 * len(a | b):
            root[top(x)] = top(y)
    least = {}
    for x, (i, _) in enumerate(sets):
        if i is not None:
            least[top(x)] = min(least.get(top(x), i), i)
    return sorted((i, len(s), least.get(top(x)) if s else i) for x, (i, s) in enumerate(sets) if i is not None)


def run(spark, rows):
    df = spark.createDataFrame([(i, t, "x", "y", "z", 1) for i, t in rows], DOCS)
    return N.near_dedup(df).collect()


def test_equals_all_pairs(spark):
    base = " ".join(f"word{i}" for i in range(60))
    near = [" ".join(f"word{i}" if i != k else f"other{k}" for i in range(60)) for k in (0, 30, 59)]
    chain = [" ".join(f"c{i}" for i in range(k, k + 50)) for k in range(0, 40, 5)]
    long = " ".join(f"l{i % 977}x{i}" for i in range(30_000))
    texts = [base, base.upper(), *near, *chain, long, long + " end", "", None, " \t\n", "one", "ONE", "one two three", "Ünï cödé text hère ok", base, "a b c\u0085d e"]
    rows = list(enumerate(texts, 10)) + [(10, base)]
    got = run(spark, rows)
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute(rows)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_many_copies_and_noise(spark):
    texts = []
    for g in range(30):
        words = [f"g{g}w{(i * 7919 + g) % 997}" for i in range(40 + g)]
        for k in range(12):
            w = list(words)
            for j in range(k):
                w[(5 * j + k) % len(w)] = f"n{k}{j}"
            texts.append(" ".join(w))
    rows = list(enumerate(texts))
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in run(spark, rows)) == brute(rows)


def test_near_copies_at_the_threshold(spark):
    """One base text with random edits, on both sides of the threshold, and unrelated texts that share a passage."""
    import random

    r = random.Random(8)
    base = [f"w{i}" for i in range(90)]
    texts = []
    for k in range(160):
        w = list(base)
        for p in r.sample(range(90), r.randrange(0, 9)):
            w[p] = f"e{r.randrange(40) if k % 3 else k}"
        texts.append(" ".join(w[: r.choice((90, 90, 84, 78))]))
    texts += [" ".join([*base[:40], *(f"u{k}x{i}" for i in range(r.randrange(20, 60)))]) for k in range(60)]
    rows = list(enumerate(texts))
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in run(spark, rows)) == brute(rows)


def test_prefix_filter_leaves_no_pair_out(spark):
    import random

    import numpy as np

    r = random.Random(4)
    sets = [r.sample(range(30), r.randrange(4, 25)) for _ in range(150)]
    sets += [sorted(set(s) ^ {r.randrange(30)}) for s in sets[:60]]
    df = spark.createDataFrame([(k, np.array(sorted(s), np.uint64).tobytes()) for k, s in enumerate(sets)], "key bigint, members binary")
    labels = spark.createDataFrame([(k, k) for k in range(len(sets))], "key bigint, label bigint")
    got = {(p.a, p.b) for p in N._prefix_pairs(df, labels, 80).collect()}
    want = {(a, b) for a, b in combinations(range(len(sets)), 2) if 100 * len({*sets[a]} & {*sets[b]}) >= 80 * len({*sets[a]} | {*sets[b]})}
    assert want and want <= got


def test_driver_documents(spark):
    import os

    folder = "/root/testdata/sf0.001"
    if not os.path.isdir(folder):
        pytest.skip("driver tables are not here")
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    got = N.op3_near_dedup(spark, folder).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute(rows)


def test_empty_and_null_ids(spark):
    assert run(spark, []) == []
    text = "a b c d e f g"
    got = {(r.doc_id, r.component_id, r.kept) for r in run(spark, [(None, text), (4, text), (None, "p q r s t"), (None, None)])}
    assert got == {(None, 4, False), (4, 4, True), (None, None, True)}


def test_drop_keeps_columns(spark):
    df = spark.createDataFrame([(1, "a b c d e", "i", "k", "l", 1), (2, "A b c d e", None, None, None, None), (3, None, "i", "k", "l", 1)], DOCS)
    out = N.drop_near_copies(df)
    assert out.columns == df.columns and sorted(r.doc_id for r in out.collect()) == [1, 3]
