"""Quality classifier: exact sums, exact top-k, accuracy on labels held out."""

import math
import os
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from barloom.llm import quality as Q

SF = "/root/testdata/sf0.01"
ALPHABET = "the of and to in that is was for with as on by at from".split()


def corpus():
    r = random.Random(2)
    good = [" ".join(r.choice(ALPHABET) + r.choice(["", "", "er", "ing"]) for _ in range(r.randrange(5, 60))) for _ in range(150)]
    bad = [" ".join(r.choice(ALPHABET).upper() + "!!" for _ in range(20)) for _ in range(15)]
    bad += ["tin " * 40 + "tor " * 30 for _ in range(5)]
    return good, bad


def frames(spark, rows, labels):
    docs = spark.createDataFrame([(i, t, 1.0, True, "x") for i, t in rows], "doc_id bigint, text string, log_weight double, kept boolean, id string")
    return docs, spark.createDataFrame(labels, "doc_id bigint, quality int, text string")


def test_sums_and_decisions(spark):
    good, bad = corpus()
    rows = list(enumerate(good + bad)) + [(1000, None), (1001, ""), (None, good[0]), (3, good[3])]
    labels = [(i, 1, "t") for i in range(0, 150, 2)] + [(i, 0, "t") for i in (*range(150, 160), 165, 166)] + [(None, 1, "t"), (7777, 1, "t"), (1, None, "t")]
    docs, marks = frames(spark, rows, labels)
    w = Q.fit(docs, marks)
    got = Q.quality(docs, marks).collect()
    assert len(got) == len(rows)
    for i, t in [*rows[:5], *rows[-12:]]:
        counts = Counter(b for part, _ in Q.features(pa.array([t])) for b in part.tolist())
        want = sum(w[b] * n for b, n in counts.items())
        assert any(r.doc_id == i and math.isclose(r.log_weight, want, abs_tol=1e-6) for r in got)
    k = sum(r.log_weight >= Q.LEAST_LOG_WEIGHT for r in got)
    least = sorted((r.noisy_weight for r in got), reverse=True)[k - 1]
    assert all(r.kept == (r.noisy_weight >= least) for r in got)
    by = {r.doc_id: r.kept for r in got}
    assert all(by[i] for i in range(150)) and not any(by[i] for i in range(150, 170)) and by[1000] and by[1001]
    out = Q.drop_low_quality(docs, marks)
    assert out.columns == docs.columns and out.count() == len(rows) - 20


def test_no_labels_and_empty(spark):
    docs, marks = frames(spark, [(1, "a b"), (2, None)], [])
    assert all(r.kept and r.log_weight == 0 for r in Q.quality(docs, marks).collect())
    assert Q.quality(docs.limit(0), marks).collect() == []


def test_features_do_not_cross_texts():
    one = [sorted(b for part, _ in Q.features(pa.array([t])) for b in part.tolist()) for t in ("ab cd", "ef")]
    both = [(b, d) for part, doc in Q.features(pa.array(["ab cd", "ef"])) for b, d in zip(part.tolist(), doc.tolist())]
    assert [sorted(b for b, d in both if d == k) for k in (0, 1)] == one


@pytest.mark.parametrize("seed", range(4))
def test_kth_highest(spark, seed):
    r = np.random.default_rng(seed)
    values = np.concatenate([r.normal(size=300) * 10.0 ** r.integers(-9, 5, 300), np.repeat(r.normal(size=5), 30)]).tolist()
    df = spark.createDataFrame([(v,) for v in values], "x double")
    ordered = sorted(values, reverse=True)
    for k in (1, 7, 200, len(values)):
        assert Q.kth_highest(df, "x", k) == ordered[k - 1]
    assert Q.kth_highest(df, "x", 0) is None and Q.kth_highest(df.limit(0), "x", 3) is None


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are not here")
def test_held_out_labels(spark):
    """Fitted on half of the labels, the decision agrees with the others."""
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    kept = {r.doc_id: r.kept for r in Q.quality(docs, labels.filter("crc32(cast(doc_id as string)) % 2 = 0")).collect()}
    odd = [(r.quality, kept[r.doc_id]) for r in labels.filter("crc32(cast(doc_id as string)) % 2 = 1").collect()]
    good = [k for q, k in odd if q == 1]
    bad = [k for q, k in odd if q == 0]
    assert sum(good) >= 0.99 * len(good) and sum(bad) <= 0.02 * len(bad)
