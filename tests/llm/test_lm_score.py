"""Kneser-Ney scores against a plain dictionary model."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from barloom.llm import lm_score as L


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) + ["</s>"]


class Plain:
    def __init__(self, texts):
        self.raw, self.pair = Counter(), Counter()
        for t in texts:
            w = tokens(t)
            self.raw.update(w)
            self.pair.update(zip(["<s>", *w], w))
        self.begun, self.follows = defaultdict(Counter), Counter()
        for (a, b), n in self.pair.items():
            self.begun[a][min(n, 3)] += 1
            self.follows[b] += 1
        self.total = Counter()
        for (a, _), n in self.pair.items():
            self.total[a] += n
        of = Counter(self.pair.values())
        self.d = L.discounts(*(of[k] for k in range(1, 5)))
        of = Counter(self.follows.values())
        self.e = L.discounts(*(of[k] for k in range(1, 5)))
        self.rest = sum(self.e[min(n, 3) - 1] for n in self.follows.values()) / len(self.pair) if self.pair else 1.0

    def word(self, w):
        n = self.follows[w]
        return (n - (self.e[min(n, 3) - 1] if n else 0)) / max(len(self.pair), 1) + self.rest / (len(self.raw) + 1)

    def p(self, v, w):
        if not self.total[v]:
            return self.word(w)
        n = self.pair[v, w]
        gamma = sum(self.d[k - 1] * m for k, m in self.begun[v].items()) / self.total[v]
        return (n - (self.d[min(n, 3) - 1] if n else 0)) / self.total[v] + gamma * self.word(w)

    def row(self, text):
        w = tokens(text)
        big_n, v = sum(self.raw.values()), len(self.raw)
        base = sum(math.log10((self.raw[x] + 1) / (big_n + v + 1)) for x in w)
        return len(w), sum(self.raw[x] > 0 for x in w), big_n, base, sum(math.log10(self.p(a, b)) for a, b in zip(["<s>", *w], w))


def held_out(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


def check(rows, got):
    plain = Plain([t for i, t in rows if not held_out(i)])
    want = sorted(((i, held_out(i), *plain.row(t)) for i, t in rows), key=lambda r: (str(r[0]), r[-1]))
    got = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got), key=lambda r: (str(r[0]), r[-1]))
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[:5] == w[:5]
        assert g[5:] == pytest.approx(w[5:], rel=1e-9, abs=1e-9)
    return plain


def test_equals_dictionary_model(spark):
    import random

    r = random.Random(1)
    vocabulary = [f"W{k}" for k in range(60)]
    rows = [(i, " ".join(r.choices(vocabulary, [1 / (k + 1) for k in range(60)], k=r.randrange(1, 40)))) for i in range(200)]
    rows += [(900, None), (901, ""), (902, " \n"), (None, "w1 w2 unseen"), (5, rows[5][1]), (903, "Never SEEN before"), (904, "w1 " * 40_000)]
    df = spark.createDataFrame([(i, t, 1, 2.0) for i, t in rows], "doc_id bigint, text string, id int, score double").repartition(4)
    plain = check(rows, L.train_and_score(df).collect())
    for v in ("w0", "w1", "<s>", "w59", "nothing"):
        assert sum(plain.p(v, w) for w in plain.raw) + plain.p(v, "unknown") == pytest.approx(1)


def test_driver_documents(spark):
    import os

    folder = "/root/testdata/sf0.001"
    if not os.path.isdir(folder):
        pytest.skip("driver tables are not here")
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    got = L.op10_lm_scoring(spark, folder).collect()
    check(rows, got)
    unseen = [r for r in got if r.held_out]
    assert sum(r.score for r in unseen) > sum(r.base_score for r in unseen)


def test_empty_and_no_training(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    assert L.train_and_score(df).collect() == []
    lone = next(i for i in range(100) if held_out(i))
    df = spark.createDataFrame([(lone, "a b")], "doc_id bigint, text string")
    (r,) = L.train_and_score(df).collect()
    assert (r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) == (3, 0, 0, 0.0, 0.0)


def test_needs_mounted_folder(spark, monkeypatch):
    monkeypatch.setattr(L, "new_path", lambda spark, name: "s3a://bucket/x")
    with pytest.raises(ValueError, match="mounted"):
        L.train(spark.createDataFrame([], "doc_id bigint, text string"))


class PlainOfOrder:
    """A dictionary model of any order: raw counts at the top and for n-grams that begin a text, else distinct words before."""

    def __init__(self, texts, order):
        self.order, self.raw = order, Counter()
        counts = [Counter() for _ in range(order + 1)]
        for t in texts:
            w = ["<s>", *tokens(t)]
            self.raw.update(w[1:])
            for k in range(2, order + 1):
                counts[k].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
        self.value = [None, Counter(g[-1:] for g in counts[2])]
        for k in range(2, order + 1):
            before = Counter(g[1:] for g in counts[k + 1]) if k < order else {}
            self.value.append({g: n if k == order or g[0] == "<s>" else before[g] for g, n in counts[k].items()})
        of = [Counter(v.values()) for v in self.value[1:]]
        self.d = [None, *(L.discounts(*(c[j] for j in range(1, 5))) for c in of)]
        self.begun, self.total = defaultdict(float), Counter()
        for k in range(1, order + 1):
            for g, n in self.value[k].items():
                self.total[k, g[:-1]] += n
                self.begun[k, g[:-1]] += self.d[k][min(n, 3) - 1]

    def p(self, history, w, k=None):
        k = min(self.order, len(history) + 1) if k is None else k
        if k == 0:
            return 1 / (len(self.raw) + 1)
        context = tuple(history[len(history) - k + 1 :])
        low, total = self.p(history, w, k - 1), self.total[k, context]
        if not total:
            return low
        n = self.value[k].get((*context, w), 0)
        return (n - (self.d[k][min(n, 3) - 1] if n else 0)) / total + self.begun[k, context] / total * low

    def score(self, text):
        w = ["<s>", *tokens(text)]
        return sum(math.log10(self.p(w[:i], w[i])) for i in range(1, len(w)))


@pytest.mark.parametrize("order", [2, 3, 4])
def test_orders_equal_dictionary_model(spark, order):
    import random

    r = random.Random(2)
    rows = [(i, " ".join(r.choices([f"w{k}" for k in range(12)], [1 / (k + 1) for k in range(12)], k=r.randrange(1, 30)))) for i in range(150)]
    rows += [(900, None), (901, ""), (None, "w1 w2 unseen w1 w2"), (5, rows[5][1]), (904, "w1 " * 500)]
    plain = PlainOfOrder([t for i, t in rows if not held_out(i)], order)
    for history in (["<s>"], ["<s>", "w1"], ["<s>", "w0", "w3", "w1"], ["w1", "nothing"]):
        assert sum(plain.p(history, w) for w in plain.raw) + plain.p(history, "unknown") == pytest.approx(1)
    got = L.train_and_score(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3), order=order).collect()
    want = sorted((str(i), plain.score(t)) for i, t in rows)
    assert [x for _, x in sorted((str(g.doc_id), g.score) for g in got)] == pytest.approx([x for _, x in want], rel=1e-9)


def test_registered_query_is_a_trigram_model(spark):
    import os

    from barloom.llm.common import QUERIES

    folder = "/root/testdata/sf0.001"
    if not os.path.isdir(folder):
        pytest.skip("driver tables are not here")
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    plain = PlainOfOrder([t for i, t in rows if not held_out(i)], 3)
    got = {r.doc_id: r.score for r in QUERIES["op10_lm_scoring"](spark, folder).collect()}
    assert [got[i] for i, _ in rows] == pytest.approx([plain.score(t) for _, t in rows], rel=1e-9)


def test_files_and_parts_hold_all_in_few_bytes():
    r = np.random.default_rng(6)
    grams = np.unique(r.zipf(1.3, size=(3, 50_000)) % 70_000, axis=1).astype(np.uint32)
    grams, n = L._distinct(grams, r.integers(1, 400, size=grams.shape[1]))
    assert sorted(map(tuple, grams.T[:, ::-1].tolist())) == list(map(tuple, grams.T[:, ::-1].tolist()))
    part = L._packed(*L._folded(grams), n)
    *arrays, got = L._unpacked(part)
    assert (L._unfolded(arrays) == grams).all() and (got == n).all()
    assert len(part) < 9 * len(n)  # three hashes and a count: 25
    for keys in (np.unique(r.integers(0, 2**40, size=100_000)), np.array([0]), np.arange(300), np.array([3, 2**62, 2**63 - 1])):
        stored = L._key_arrays(keys.astype(np.uint64))
        asked = np.unique(np.concatenate([keys, keys[keys > 0] - 1, keys[:-1] + 1])).astype(np.uint64)
        want = {int(k): i for i, k in enumerate(keys)}
        assert L._places(stored, asked).tolist() == [want.get(int(k), -1) for k in asked]
        assert sum(x.nbytes for x in stored.values()) < 5 * len(keys) + 64
    rows = np.stack([r.zipf(1.5, 5000) % 1000, r.zipf(1.5, 5000) % 1000], axis=1)
    at = r.integers(0, 5000, size=3000)
    assert (L._row(L._row_arrays(rows), at) == rows[at]).all()


@pytest.mark.parametrize("top", [50, 40_000, 2**32 - 1])
def test_ngrams_are_sorted_as_single_numbers(monkeypatch, top):
    r = np.random.default_rng(8)
    some = np.append(r.integers(0, top, size=300), top).astype(np.uint32)
    grams, n = some[r.integers(0, 301, size=(3, 5000))], r.zipf(1.4, size=5000) % 90_000
    n[:3] = 0, 1, 80_000  # a word may be there without a count
    want = Counter()
    for g, k in zip(grams.T.tolist(), n.tolist()):
        want[tuple(g)] += k
    expected = sorted(want.items(), key=lambda x: x[0][::-1])
    with monkeypatch.context() as m:
        m.setattr(L.np, "lexsort", None)  # several times as slow, only for what 64 bits can't hold
        got, total = L._distinct(grams, n)
        sums = L._distinct(grams, np.stack([n, n], axis=1))
    assert got.dtype == np.uint32
    assert list(zip(map(tuple, got.T.tolist()), total.tolist())) == expected
    assert (sums[0] == got).all() and (sums[1] == total[:, None]).all()
    context, begun = L._begun(grams[:2], n + 1)
    kinds = defaultdict(lambda: [0, 0, 0, 0])
    for g, k in zip(grams[:2].T.tolist(), (n + 1).tolist()):
        kinds[tuple(g)][min(k, 3) - 1] += 1
        kinds[tuple(g)][3] += k
    assert list(zip(map(tuple, context.T.tolist()), begun.tolist())) == sorted(kinds.items(), key=lambda x: x[0][::-1])


def test_ngrams_wider_than_64_bits():
    r = np.random.default_rng(9)
    grams = r.integers(0, 2**32, size=(4, 140_000), dtype=np.uint32)
    grams = np.concatenate([grams, grams[:, :70_000]], axis=1)
    n = r.integers(1, 9, size=210_000)
    assert L._Keys(*grams).key is None
    got, total = L._distinct(grams, n)
    order = np.lexsort(grams[:, :140_000])
    assert (got == grams[:, order]).all()
    assert (total == (n[:140_000] + np.append(n[140_000:], np.zeros(70_000, int)))[order]).all()
    context, begun = L._begun(grams, n)
    assert (context == got).all() and (begun[:, 3] == total).all() and (begun[:, :3].sum(axis=1) == 1 + (order < 70_000)).all()
