"""Words of whole texts as 64-bit numbers, computed on Arrow buffers with numpy.

A word is a longest run of bytes other than blank, tab, line feed, vertical tab, form feed
and carriage return; A-Z count as a-z. Null and empty texts have no words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
_GOLDEN = U64(0x9E3779B97F4A7C15)
_MIX_A = U64(0xBF58476D1CE4E5B9)
_MIX_B = U64(0x94D049BB133111EB)
#: Bytes of text that one numpy step works on; one longer text is a step of its own.
STEP_BYTES = 2_000_000
#: Bytes hashed at a time within a step.
BLOCK_BYTES = 1_000_000


def mix(x: np.ndarray) -> np.ndarray:
    """Splitmix64 finaliser: a bijection of 64-bit numbers that looks random."""
    with np.errstate(over="ignore"):
        x = (x + _GOLDEN).astype(U64, copy=False)
        x = (x ^ (x >> U64(30))) * _MIX_A
        x = (x ^ (x >> U64(27))) * _MIX_B
        return x ^ (x >> U64(31))


_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE_CODE = mix(np.arange(256, dtype=U64) + U64(0xB17E))
_LOWER_CODE = _BYTE_CODE[_LOWER]


def _place_codes(n: int, have: list[np.ndarray] = [mix(np.arange(4096, dtype=U64) + U64(0x91ACE)) | U64(1)]) -> np.ndarray:  # noqa: B006
    """A fixed odd number for each place within a word."""
    if n > len(have[0]):
        have[0] = mix(np.arange(2 * n, dtype=U64) + U64(0x91ACE)) | U64(1)
    return have[0]


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts, and where each begins and ends (n + 1 offsets); null has no bytes."""
    texts = texts.cast(pa.large_binary())
    if texts.null_count:
        texts = texts.fill_null(b"")
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1] if offsets else np.zeros(len(texts) + 1, np.int64)
    whole = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def steps(texts: pa.Array, size: int = STEP_BYTES) -> Iterator[tuple[int, int]]:
    """Slices (first, count) of the texts with about ``size`` bytes each; every text is in one."""
    _, at = buffers(texts)
    first = 0
    while first < len(texts):
        end = int(np.searchsorted(at, at[first] + size, "right")) - 1
        end = min(max(end, first + 1), len(texts))
        yield first, end - first
        first = end


def word_bounds(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of words, and for each text the number of the first of its words (n + 1)."""
    inside = ~_SEPARATOR[data]
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    cuts = at[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    starts[cuts] = inside[cuts]
    ends[cuts - 1] = inside[cuts - 1]
    begin = np.flatnonzero(starts)
    return begin, np.flatnonzero(ends) + 1, np.searchsorted(begin, at)


def hash_words(data: np.ndarray, begin: np.ndarray, end: np.ndarray, lower: bool = True) -> np.ndarray:
    """A 64-bit hash of each word: a sum of byte code times place code, mixed with the length."""
    out = np.empty(len(begin), U64)
    code = _LOWER_CODE if lower else _BYTE_CODE
    lengths = end - begin
    total = np.concatenate(([0], np.cumsum(lengths)))
    first = 0
    while first < len(begin):
        last = max(int(np.searchsorted(total, total[first] + BLOCK_BYTES, "right")) - 1, first + 1)
        n = lengths[first:last]
        heads = total[first:last] - total[first]
        place = np.arange(total[last] - total[first]) - np.repeat(heads, n)
        with np.errstate(over="ignore"):
            value = code[data[np.repeat(begin[first:last], n) + place]] * _place_codes(int(n.max()))[place]
            out[first:last] = mix(np.add.reduceat(value, heads) + n.astype(U64) * _GOLDEN)
        first = last
    return out


def words(texts: pa.Array, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts in order, and the number of the first word of each (n + 1)."""
    data, at = buffers(texts)
    if not len(data):
        return np.zeros(0, U64), np.zeros(len(texts) + 1, np.int64)
    begin, end, first = word_bounds(data, at)
    return hash_words(data, begin, end, lower), first


def chain(*parts: np.ndarray) -> np.ndarray:
    """One hash of several, in order."""
    out = np.full(parts[0].shape, len(parts), U64)
    with np.errstate(over="ignore"):
        for p in parts:
            out = mix(out * _MIX_A + p)
    return out
