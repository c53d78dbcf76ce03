"""The pipeline against brute force over its own stages' rules."""

import os
import zlib
from collections import defaultdict

import numpy as np
import pytest

import corpus_pipeline as C
from barloom.llm import quality as Q
from tests.llm.test_near_dedup import brute as components
from tests.llm.test_packing import check_packing

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def tables(spark, folder, rows, labels):
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")


def test_equals_brute_force(spark, tmp_path):
    import random

    r = random.Random(11)
    good = [" ".join(r.choice("the of and to in that is was for with".split()) + r.choice(["", "er", "ing"]) for _ in range(r.randrange(8, 60))) for _ in range(120)]
    bad = [" ".join(x.upper() + "!!" for x in r.choice(good).split()) for _ in range(20)]
    copies = good[:10] + [good[3]] * 5
    near = [g + " tail" for g in good[:40] if len(g.split()) > 30]
    rows = list(enumerate(good + bad + copies + near)) + [(9000, None), (9001, ""), (None, good[1]), (7, good[7])]
    labels = [(i, 1, 0) for i in range(0, 120, 2)] + [(i, 0, 0) for i in range(120, 140)]
    tables(spark, str(tmp_path), rows, labels)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in C.STAGES[:3]:
        before = sorted((tuple(x) for x in docs.collect()), key=str)
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns
        got = sorted((tuple(x) for x in out.collect()), key=str)
        if name == "quality":
            want = [x for x in before if x[0] is None or not 120 <= x[0] < 140]
        elif name == "exact_dedup":
            top = defaultdict(lambda: -1)
            for x in before:
                top[x[1] or ""] = max(top[x[1] or ""], -1 if x[0] is None else x[0])
            want = [x for x in before if (-1 if x[0] is None else x[0]) == top[x[1] or ""]]
        else:
            keep = {(i, n) for i, n, c in components([x[:2] for x in before]) if i == c}
            want = [x for x in before if any(x[0] == i for i, _ in keep)]
        assert got == want
        path = str(tmp_path / name)
        out.write.parquet(path)
        docs = spark.read.parquet(path)
    kept = [(x.doc_id, x.text) for x in docs.collect()]
    packed = C.run(spark, str(tmp_path)).collect()
    check_packing(kept, packed)
    assert all(zlib.crc32(bytes(x.ids)) == x.ids_crc32 and len(x.ids) == 4 * x.length for x in packed)


def test_empty(spark, tmp_path):
    tables(spark, str(tmp_path), [], [])
    assert C.run(spark, str(tmp_path)).collect() == []


def test_driver_documents(spark):
    folder = "/root/testdata/sf0.001"
    if not os.path.isdir(folder):
        pytest.skip("driver tables are not here")
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    weights = Q.fit(docs, labels)
    assert np.isfinite(weights).all()
    texts = {x.doc_id: x.text or "" for x in docs.collect()}
    packed = C.run(spark, folder).collect()
    ids = {x.doc_id for x in packed}
    assert ids <= set(texts) and len({texts[i] for i in ids}) == len(ids)
    check_packing([(i, texts[i]) for i in ids], packed)
