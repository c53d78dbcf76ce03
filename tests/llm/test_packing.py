"""Packing against the tokenizers library, and the curve against its definition."""

import random
import sys
import zlib
from collections import defaultdict
from itertools import product

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import regex
from tokenizers import Tokenizer

from barloom.llm import packing as K
from barloom.llm import word_tokens as W
from barloom.llm.word_tokens import WordTokenizer

PATH = P.path(K.VOCABULARY)
LIB = Tokenizer.from_file(PATH)
LIB.encode_special_tokens = True
TEXTS = [
    "Hello World's  end don't I'LL", "", None, " \t\n", "Ünï CÖDÉ straße ÇA Œuvre İstanbul ΣΑΣ", "中文 テスト 한국어", "é ä café",
    "x" * 3000, "ab'c''d'llx'sst 'S 'Re", "0123456789 ½ ² ٣", "😀👍🏽 ok", "<|endoftext|> <|startoftext|>x", "a b c\u0085d​e",
    "=" * 500 + "-" * 301, "\x1c\x1d \x00\x01 \x7f", "word " * 30_000, "ÿ Ā Į ǆ ß ſ ﬁ Ⅷ", "́ ́a", "Å Å", "it's 's s'",
]


def ids_of(text):
    return LIB.encode(text or "", add_special_tokens=False).ids + [K.END]


def test_ids_equal_library():
    ids, at = WordTokenizer(PATH).encode(pa.array(TEXTS), K.END)
    for k, t in enumerate(TEXTS):
        assert ids[at[k] : at[k + 1]].tolist() == ids_of(t), t and t[:50]


def odd_words(n, alphabet, seed):
    rng = random.Random(seed)
    return ["".join(rng.choices(alphabet, k=rng.randint(1, 12))) for _ in range(n)]


def test_pieces_equal_pattern():
    """Words of plain characters, in all orders of apostrophes, marks, digits and letters, also where one word meets the next."""
    alphabet = [*"'" * 4, *"sStTrReEvVmMlLdD", *"aZ09.-~!", *"¿ÀÖØÞßàöøÿĀāĮį"]
    texts = ["'", "s", "'s", "'l", "l", "'r", "e", "'" * 2 + "s", "'s's", "'S'RE'll", "'vé", "¿'s", "x'¿"] + odd_words(4_000, alphabet, 5)
    raw = [t.encode() for t in texts]
    ends = np.cumsum([len(b) for b in raw])
    data, begin = np.frombuffer(b"".join(raw), np.uint8), ends - [len(b) for b in raw]
    assert W._are_plain(data, begin, ends).all()
    low, first, last, of_word = W._pieces(data, begin, ends)
    got = [bytes(low[a:b]).decode() for a, b in zip(first, last)]
    find = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+").findall
    for k, t in enumerate(texts):
        assert got[of_word[k] : of_word[k + 1]] == find(t.lower()), t


def test_plain_characters():
    """Every character up to U+0250 and some beyond: plain or left to the library."""
    chars = [chr(c) for c in [*range(0x21, 0x250), 0x300, 0x4E2D, 0xFB01, 0x1F600]]
    raw = [f"a{c}b".encode() for c in chars]
    ends = np.cumsum([len(b) for b in raw])
    plain = W._are_plain(np.frombuffer(b"".join(raw), np.uint8), ends - [len(b) for b in raw], ends)
    assert [c for c, p in zip(chars, plain) if p] == [c for c in chars if regex.fullmatch(r"[\x21-\x7e¿-ÖØ-öø-į]", c)]


@pytest.mark.parametrize("alphabet", ["'sStrRevVmlLdaZ09.-~¿ÀÖßàÿĀį", "aé中\u0301Σς'sß½\x7f😀"])
def test_odd_words_equal_library(alphabet):
    words = odd_words(3_000, alphabet, 7)
    texts = [" ".join(words[k : k + 50]) for k in range(0, len(words), 50)]
    tok = WordTokenizer(PATH)
    for _ in range(2):  # learned, then remembered
        ids, at = tok.encode(pa.array(texts), K.END)
        for k, t in enumerate(texts):
            assert ids[at[k] : at[k + 1]].tolist() == ids_of(t), t


def test_bytes_that_are_no_text():
    for b in (b"a\xc3", b"\xa9a", b"a\xc4b", b"a\xff"):
        with pytest.raises(UnicodeDecodeError):
            WordTokenizer(PATH).encode(pa.array([b]))


def test_new_words_cost_no_python_calls():
    """New words are handled side by side: fewer calls than words (the time of a large corpus of rare words)."""
    words = sorted(set(odd_words(20_000, "abcdeéñôüß.'", 9)))
    text, tok, calls = pa.array([" ".join(words)]), WordTokenizer(PATH), 0

    def count(_, event, __):
        nonlocal calls
        calls += event in ("call", "c_call")

    sys.setprofile(count)
    try:
        tok.encode(text, K.END)
    finally:
        sys.setprofile(None)
    assert len(words) > 15_000 > 2 * calls


def check_packing(rows, got, size=K.SIZE):
    want = defaultdict(list)
    for i, t in rows:
        want[i].append(ids_of(t))
    sequences, docs = defaultdict(list), defaultdict(dict)
    for r in got:
        sequences[r.sequence_id].append(r)
        docs[r.doc_id].setdefault((r.start, r.length, r.ids_crc32), []).append(r)
    for parts in sequences.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= size
    assert sum(len(x) for v in want.values() for x in v) == sum(r.length for r in got)
    for i, pieces in docs.items():
        if len(want[i]) == 1:
            at = 0
            for start, length, crc in sorted(pieces):
                assert start == at
                assert zlib.crc32(np.array(want[i][0][start : start + length], "<u4").tobytes()) == crc
                at += length
            assert at == len(want[i][0]) and all(r.doc_tokens == at for x in pieces.values() for r in x)


def test_pack(spark):
    rows = list(enumerate(TEXTS)) + [(1, ""), (None, "no id")]
    df = spark.createDataFrame([(i, t, 1, "s") for i, t in rows], "doc_id bigint, text string, curve int, ids string")
    got = K.pack(df).collect()
    check_packing(rows, got)
    assert all(zlib.crc32(bytes(r.ids)) == r.ids_crc32 for r in got)
    check_packing(rows, K.pack(df, size=64).collect(), 64)
    assert K.pack(df.limit(0)).count() == 0


def test_driver_documents(spark):
    import os

    folder = "/root/testdata/sf0.001"
    if not os.path.isdir(folder):
        pytest.skip("driver tables are not here")
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    got = K.op9_packing(spark, folder).collect()
    check_packing(rows, got)
    total = sum(r.length for r in got)
    assert len({r.sequence_id for r in got}) * K.SIZE <= total + K.SIZE


@pytest.mark.parametrize(("dims", "depth"), [(2, 4), (3, 3), (4, 2)])
def test_curve_visits_neighbours(dims, depth):
    """Every cell has its own key, keys have no gaps, and consecutive cells touch."""
    cells = np.array(list(product(range(1 << depth), repeat=dims)))
    key = K.hilbert_key(cells, depth)
    order = np.argsort(key)
    assert sorted(key) == list(range(len(cells)))
    assert (np.abs(np.diff(cells[order], axis=0)).sum(axis=1) == 1).all()
