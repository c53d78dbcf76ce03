"""Merkle manifests against trees built node by node."""

import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from barloom.llm import merkle as M
from tests.compare import compare, duck

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, grp string, leaf string, pid int"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(doc_id, source, lang, n_chars, text):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][k : k + 8]) for k in range(0, len(out[-1]), 8)])
    return out


def way(tree, place):
    out = []
    for nodes in tree[:-1]:
        run = nodes[place // 8 * 8 : place // 8 * 8 + 8]
        out.append((run[: place % 8], run[place % 8 + 1 :]))
        place //= 8
    return out


def brute(rows):
    groups = {}
    for i, text, lang, source, n, *_ in rows:
        low = text and "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
        tried = low if i is not None and zlib.crc32(str(i).encode()) % 3 == 0 else text
        key = (lang is not None, (lang or "").encode())
        groups.setdefault(key, []).append(((i is not None, i or 0), leaf(i, source, lang, n, text), i, leaf(i, source, lang, n, tried)))
    order = sorted(groups)
    trees = {g: levels([x[1] for x in sorted(groups[g])]) for g in order}
    top = levels([trees[g][-1][0] for g in order])
    out = []
    for place, g in enumerate(order):
        for k, (_, own, i, tried) in enumerate(sorted(groups[g])):
            steps = way(trees[g], k) + way(top, place)
            folded = tried
            for a, b in steps:
                folded = h(*a, folded, *b)
            out.append((i, own, trees[g][-1][0], top[-1][0], h(*(x for a, b in steps for x in a + b)), folded, folded == top[-1][0]))
    return sorted(out, key=str)


def run(spark, rows):
    df = spark.createDataFrame(rows, DOCS).repartition(3)
    tampered = F.col("doc_id").isNotNull() & (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0)
    got = M.manifest(M.document_leaves(df, tampered)).drop("proof")
    return sorted((tuple(r) for r in got.collect()), key=str)


def doc(i, text, lang, source="s", n=1):
    return (i, text, lang, source, n, "g", "l", 3)


@pytest.mark.parametrize("sizes", [[1], [8, 1], [64, 65, 9], [700, 3]])
def test_equals_trees_node_by_node(spark, sizes):
    rows = [doc(100 * g + 7 * k, f"Text {k % 5} É", ["de", "en", None][g]) for g, n in enumerate(sizes) for k in range(n)]
    assert run(spark, rows) == brute(rows)


def test_nulls_ties_repeats_and_many_groups(spark):
    rows = [doc(5, "A", "x"), doc(5, "A", "x"), doc(5, "B", "x"), doc(None, "C", "x"), doc(None, None, None, None, None), doc(3, "", "", "", 0)]
    rows += [doc(k, "Long " * 50_000 if k == 9 else "T", f"l{k % 20}ä") for k in range(300)]
    assert run(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert run(spark, []) == []


def test_proofs_fold_to_the_root(spark):
    df = spark.createDataFrame([doc(k, f"t{k}", f"l{k % 3}") for k in range(100)], DOCS)
    rows = M.manifest(M.document_leaves(df), with_proofs=True).collect()
    assert len(rows) == 100 and all(r.verified and M.fold(r.leaf, M.decode_steps(bytes(r.proof))) == r.root for r in rows)


def test_missing_nodes_are_the_fewest():
    """Every node asked for is a sibling of something derived, and is not derived itself."""
    draw = np.random.default_rng(3)
    for size in (1, 2, 8, 9, 100, 513, 700):
        places = np.sort(draw.choice(size, max(1, size // 3), replace=False))
        have, n = set(places.tolist()), size
        for need in M.missing(places, size):
            parents = {k // 8 for k in have}
            assert set(need.tolist()) == {c for p in parents for c in range(8 * p, min(8 * p + 8, n))} - have
            have, n = parents, -(-n // 8)
        assert n == 1


def test_query_equals_sql(spark):
    import __spark_entry__ as entry

    sf, name = "/root/testdata/sf0.001", "op13_merkle_manifest"
    _, n, same, *_, note = compare(spark, duck(sf), name, entry.queries()[name], entry.oracle_sql()[name], sf)
    assert same and n == 200, note
