"""Ids of the public word tokenizer for many texts at once.

White space never lies within a piece of this vocabulary, so a text's ids are those of its words
in order. Distinct words are encoded once per worker (up to ``REMEMBERED``, then it starts anew)
and looked up by a 64-bit hash of their bytes. Words of plain and accented Latin letters, digits
and ASCII marks are lower-cased, cut into pieces and merged side by side in numpy, each distinct
piece of a step once; any other word goes through the library.
"""

from __future__ import annotations

import json
import os
from functools import cache

import numpy as np
import pyarrow as pa

from barloom.llm.bpe import Merges, spans
from barloom.llm.textnum import buffers, hash_words, word_bounds

REMEMBERED = 600_000
#: Bytes within the characters \x21-\x7e, ¿-Ö, Ø-ö and ø-į, whose case, class and composition are
#: the same in every Unicode version since 4.0; all but the first are two bytes, led by C2, C3 or C4.
_PLAIN = np.zeros(256, bool)
_PLAIN[0x21:0x7F] = _PLAIN[0x80:0xC0] = _PLAIN[0xC2:0xC5] = True
_MARK, _LETTER, _DIGIT = 0, 1, 2
_CLASS = np.full(256, _MARK, np.uint8)
_CLASS[0x30:0x3A] = _DIGIT
_CLASS[0x61:0x7B] = _CLASS[0x80:] = _LETTER
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def _are_plain(data: np.ndarray, begin: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Whether each word holds nothing but the characters above."""
    sizes = stop - begin
    raw = data[spans(begin, sizes)]
    raw.tobytes().decode()  # an error if it is no UTF-8
    bad = ~_PLAIN[raw]
    lead = np.flatnonzero(raw >= 0xC2)
    after = raw[np.minimum(lead + 1, len(raw) - 1)]
    head = raw[lead]
    bad[lead] |= ((head == 0xC2) & (after != 0xBF)) | ((head == 0xC3) & ((after == 0x97) | (after == 0xB7))) | ((head == 0xC4) & (after > 0xAF))
    plain = np.ones(len(begin), bool)
    plain[np.searchsorted(np.cumsum(sizes), np.flatnonzero(bad), "right")] = False
    return plain


def _pieces(data: np.ndarray, begin: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Plain words lower-cased one after the other, starts and ends of their pieces, and for each
    word the number of its first piece (n + 1).

    A piece is a match of 's|'t|'re|'ve|'m|'ll|'d|\\p{L}+|\\p{N}|[^\\s\\p{L}\\p{N}]+.
    """
    sizes = stop - begin
    at = np.concatenate([[0], np.cumsum(sizes)])
    low = _LOWER[data[spans(begin, sizes)]]
    c3 = np.flatnonzero(low == 0xC3) + 1
    low[c3[low[c3] < 0x9F]] += 0x20
    c4 = np.flatnonzero(low == 0xC4) + 1
    low[c4] |= 1
    kind = _CLASS[low]
    c2 = np.flatnonzero(low == 0xC2)  # of ¿
    kind[c2] = kind[c2 + 1] = _MARK
    # two places more, so that a look past the last byte finds the start of another word
    text = np.append(low, np.zeros(2, np.uint8))
    opens = np.zeros(len(text), bool)
    opens[at] = opens[-2:] = True
    starts = opens.copy()
    starts[1:-2] |= (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
    # an apostrophe that opens a piece takes these letters with it
    mark = np.flatnonzero(starts[:-2] & (low == 0x27))
    mark = mark[~opens[mark + 1]]
    one, two = text[mark + 1], text[mark + 2]
    single = mark[np.isin(one, np.frombuffer(b"stmd", np.uint8))]
    double = mark[~opens[mark + 2] & (((two == 0x65) & ((one == 0x72) | (one == 0x76))) | ((two == 0x6C) & (one == 0x6C)))]
    starts[single + 1] = starts[double + 1] = False
    starts[single + 2] = starts[double + 3] = True
    first = np.flatnonzero(starts[:-2])
    return low, first, np.append(first, len(low))[1:], np.searchsorted(first, at)


def _distinct(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct values ascending, a place of each, and for each hash the number of its value."""
    coded = pa.array(hashes).dictionary_encode()
    values, which = coded.dictionary.to_numpy(), coded.indices.to_numpy()
    order = np.argsort(values)
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    which = rank[which]
    one = np.empty(len(order), np.int64)
    one[which] = np.arange(len(which))
    return values[order], one, which


def _byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b if b in printable else next(spare)) for b in range(256)]


class WordTokenizer:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._library = Tokenizer.from_file(path)
        self._library.encode_special_tokens = True
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        ids, end = model["vocab"], model["end_of_word_suffix"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        made = [ids[a + b] for a, b in pairs]
        letters = _byte_letters()
        self._inner = np.array([ids[c] for c in letters], np.int32)
        self._last = np.array([ids[c + end] for c in letters], np.int32)
        parts = {i: (i,) for i in ids.values()}
        for (a, b), m in zip(pairs, made):
            parts[m] = parts[ids[a]] + parts[ids[b]]
        self._merges = Merges([ids[a] for a, _ in pairs], [ids[b] for _, b in pairs], range(len(pairs)), made, parts)
        self._forget()

    def _forget(self) -> None:
        self._hash = np.zeros(0, np.uint64)
        self._from = self._count = np.zeros(0, np.int64)
        self._ids = np.zeros(0, np.int32)

    def _learn(self, hashes: np.ndarray, data: np.ndarray, begin: np.ndarray, stop: np.ndarray) -> None:
        """Encode words not met before, ascending by hash. The ids of a word are those of its pieces in order."""
        plain = _are_plain(data, begin, stop)
        lower, first, last, of_word = _pieces(data, begin[plain], stop[plain])
        known, one, which = _distinct(hash_words(lower, first, last, lower=False))
        sizes = (last - first)[one]
        bytes_ = lower[spans(first[one], sizes)]
        symbols = self._inner[bytes_]
        at_end = np.cumsum(sizes) - 1
        symbols[at_end] = self._last[bytes_[at_end]]
        ids, counts = self._merges.encode(symbols, sizes)
        starts, counts = (np.cumsum(counts) - counts)[which], counts[which]
        ids = ids[spans(starts, counts)]
        ends = np.concatenate([[0], np.cumsum(counts)])
        from_, per_word = np.zeros(len(hashes), np.int64), np.zeros(len(hashes), np.int64)
        from_[plain] = ends[of_word[:-1]]
        per_word[plain] = np.diff(ends[of_word])
        odd = np.flatnonzero(~plain)
        if len(odd):
            raw = [bytes(data[a:b]).decode() for a, b in zip(begin[odd].tolist(), stop[odd].tolist())]
            extra = [e.ids for e in self._library.encode_batch(raw, add_special_tokens=False)]
            sizes = np.array([len(x) for x in extra], np.int64)
            from_[odd] = len(ids) + np.cumsum(sizes) - sizes
            per_word[odd] = sizes
            ids = np.concatenate([ids, np.array([i for x in extra for i in x], np.int32)])
        at = np.searchsorted(self._hash, hashes)
        self._from = np.insert(self._from, at, from_ + len(self._ids))
        self._count = np.insert(self._count, at, per_word)
        self._hash = np.insert(self._hash, at, hashes)
        self._ids = np.concatenate([self._ids, ids.astype(np.int32)])

    def encode(self, texts: pa.Array, end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """All ids in order, and where each text's begin (n + 1); ``end`` is put after each text."""
        data, at = buffers(texts)
        begin, stop, first = word_bounds(data, at) if len(data) else (np.zeros(0, np.int64), np.zeros(0, np.int64), at)
        hashes = hash_words(data, begin, stop, lower=False)
        if len(self._hash) > REMEMBERED:
            self._forget()
        values, one, which = _distinct(hashes)
        place = np.searchsorted(self._hash, values)
        new = np.ones(len(values), bool)
        inside = place < len(self._hash)
        new[inside] = self._hash[place[inside]] != values[inside]
        if new.any():
            self._learn(values[new], data, begin[one[new]], stop[one[new]])
            place = np.searchsorted(self._hash, values)
        starts, counts = self._from[place][which], self._count[place][which]
        ids = self._ids[spans(starts, counts)]
        upto = np.concatenate([[0], np.cumsum(counts)])[first]
        if end is None:
            return ids, upto
        return np.insert(ids, upto[1:], end), upto + np.arange(len(upto))


@cache
def tokenizer(path: str) -> WordTokenizer:
    return WordTokenizer(path)
