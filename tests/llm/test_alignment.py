"""Token alignment against whole-text encodings and plain loops."""

import hashlib
from bisect import bisect_left
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
from tokenizers import Tokenizer

from barloom.llm import alignment as A
from barloom.llm.word_tokens import _byte_letters

DOCS = "doc_id bigint, text string, id int, row int, pair string, n string"
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def coders():
    a = Tokenizer.from_file(P.path(A.BYTE_BPE))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=P.path(A.PIECES))


def tokens(coders, text):
    """(id, byte start, byte end) of both sides, none if the bytes differ from a blank and the text."""
    if not text:
        return [], []
    a, b = coders
    byte_of = {c: k for k, c in enumerate(_byte_letters())}
    sides = []
    pieces = [(i, bytes(byte_of[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
    sides.append(pieces)
    pieces = []
    for i in b.encode(text):
        p = b.id_to_piece(i)
        pieces.append((i, bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()))
    sides.append(pieces)
    out = []
    for pieces in sides:
        if b"".join(x for _, x in pieces) != (" " + text).encode():
            return [], []
        at, side = 0, []
        for i, x in pieces:
            side.append((i, at, at + len(x)))
            at += len(x)
        out.append(side)
    return out


def brute(coders, rows):
    each = [tokens(coders, t) for _, t in rows]
    links = [[(i, j) for i, s, e in a for j, u, v in b if s < v and u < e] for a, b in each]
    count = Counter(x for own in links for x in own)
    most = Counter()
    for (_, j), n in count.items():
        most[j] = max(most[j], n)
    out = []
    for (doc, _), (a, b), own in zip(rows, each, links):
        ends = sorted({e for *_, e in a} & {e for *_, e in b})
        groups = ["|".join(",".join(str(i) for i, _, e in side if bisect_left(ends, e) == k) for side in (a, b)) for k in range(len(ends))]
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        out.append((doc, len(a), len(b), len(ends), len(own), sum(count[x] == most[x[1]] for x in own), sum(count[x] for x in own), digest))
    return sorted(out, key=str)


ODD = [
    None, "", " ", "  ", "\n", "a", "Don't you'll  x\n\n\ty ", "\t\tindented\n  more", "café naïve 中文 \U0001f600\U0001f600", "no break 　wide",
    "a\r\nb\r\n", "x▁y", "<|endoftext|> <s> </s> <unk> <0x0A>", "\x00\x01\x1c\x0b z", "​‍ zero", "x" * 3000, "12345 6789,000.00", "a   b", "tail  ", "a\u0085\n b",
]


@pytest.mark.parametrize("sent_pairs", [A.SENT_PAIRS, 0])
def test_equals_plain_loops(spark, coders, sent_pairs):
    rows = [*enumerate(ODD), (3, "a"), (3, "a"), (None, "the cat"), *[(100 + k, "the cat sat on the mat " * (k % 3 + 1)) for k in range(40)]]
    df = spark.createDataFrame([(i, t, 1, 2, "p", "n") for i, t in rows], DOCS).repartition(4)
    got = sorted((tuple(r) for r in A.align_tokens(df, sent_pairs=sent_pairs).collect()), key=str)
    assert got == brute(coders, rows)


def test_query_on_whole_documents(spark, coders):
    import __spark_entry__ as entry

    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = {r.doc_id: r for r in entry.queries()["op11_token_alignment"](spark, SF).collect()}
    assert len(got) == len(rows)
    for doc, text in rows:
        a, b = tokens(coders, text)
        assert (got[doc].n_a, got[doc].n_b) == (len(a), len(b))
    short = [(d, t) for d, t in rows if len(t or "") < 2000]
    for doc, n_a, n_b, n_groups, n_links, _, _, digest in brute(coders, short):
        r = got[doc]
        assert (r.n_a, r.n_b, r.n_groups, r.n_links, r.groups_sha256) == (n_a, n_b, n_groups, n_links, digest)


def test_empty_table(spark):
    assert A.align_tokens(spark.createDataFrame([], DOCS)).collect() == []


def test_one_very_long_text(coders):
    text = "word é " * 200_000
    units = A._units(P.path(A.BYTE_BPE), P.path(A.PIECES))
    import pyarrow as pa

    which, first = units.of(pa.array([text, "", None]))
    assert first.tolist() == [0, 400_001, 400_001, 400_001] and units.fine[which].all()
    assert units.counts[which].sum(axis=0)[:2].tolist() == [len(x) for x in tokens(coders, text)]


def test_gallop_equals_search():
    draw = np.random.default_rng(1)
    for n, m in ((0, 0), (0, 5), (1, 1), (10, 10_000), (9_000, 9_500), (5_000, 400)):
        short, long = (np.unique(draw.integers(0, 20_000, k)) for k in (n, m))
        assert (A.gallop(short, long) == np.searchsorted(long, short)).all()


def test_vocabularies_have_no_token_into_white_space():
    b = sentencepiece.SentencePieceProcessor(model_file=P.path(A.PIECES))
    pieces = [b.id_to_piece(i) for i in range(b.get_piece_size()) if not b.is_byte(i)]
    assert not any("▁" in p.lstrip("▁") or "\n" in p or "\t" in p for p in pieces)
