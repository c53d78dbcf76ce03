"""Byte-level BPE against the tiktoken library and round trips."""

import hashlib

import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from barloom.llm import byte_bpe as B

PATH = P.path(B.RANKS)
ENC = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=B.read_ranks(PATH), special_tokens={})
CODEC = B.ByteBpe(PATH)


def check(texts, codec=CODEC):
    for text, (ids, decimal) in zip(texts, codec.encode(texts), strict=True):
        assert ids.tolist() == ENC.encode_ordinary(text)
        assert decimal == " ".join(map(str, ids.tolist()))
        assert codec.decode(ids) == text.encode()


PART = st.sampled_from(["a", "aa", "the", " ", "  ", "\n", "\t", "'", "'r", "e", "'ll", "0", "12", "é", "ß", "。", "中文", "!", "!!", " ", " ", "😀", "\r\n", "x" * 40, "ab" * 33])


@settings(max_examples=400, deadline=None)
@given(st.lists(PART, max_size=60).map("".join), st.integers(2, 20))
def test_any_leaf_size(text, leaf):
    old = B.LEAF_CHARS
    B.LEAF_CHARS = leaf
    try:
        assert CODEC.pieces(text) == CODEC._split(text)
        check([text])
    finally:
        B.LEAF_CHARS = old


@pytest.mark.parametrize(
    "text", ["", " ", "a" * 5000, "=" * 3333, " " * 20_000, "ab" * 4000, "0123456789" * 900, "don't " * 3000, "x\n" * 9000, "é" * 3001,
             "<|endoftext|>", "aaaaaaab" * 700, "-" * 64 + "=" * 65, "Donaudampfschifffahrtsgesellschaft" * 50]
)
def test_long_runs(text):
    check([text, text + " end", "start " + text])


def test_joining_halves_of_one_piece():
    import random

    r = random.Random(3)
    for _ in range(300):
        raw = "".join(r.choice("abcdeinrst") * r.choice((1, 1, 1, 2, 5)) for _ in range(r.randrange(33, 200)))
        check([raw])


def test_query(spark):
    rows = [(1, "Hello  world's end", "x", 1), (2, None, "x", 2), (3, "", None, None), (None, "über", "y", 3), (1, "Hello  world's end", "x", 1), (5, "word " * 50_000, "t", 4)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, ids string, id int")
    out = B.encode(df)
    for r in out.collect():
        text = next((t or "") for i, t, *_ in rows if i == r.doc_id)
        ids = ENC.encode_ordinary(text)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (
            len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()
        )
    back = {(r.doc_id, bytes(r.bytes).decode()) for r in B.decode(out).collect()}
    assert back == {(i, t or "") for i, t, *_ in rows}
    assert B.encode(df.limit(0)).count() == 0


def test_driver_documents(spark):
    import os

    folder = "/root/testdata/sf0.001"
    if not os.path.isdir(folder):
        pytest.skip("driver tables are not here")
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    got = B.op2_byte_bpe(spark, folder).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = ENC.encode_ordinary(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
