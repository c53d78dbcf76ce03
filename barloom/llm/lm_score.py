"""Interpolated modified Kneser-Ney model of any order: counted in Spark, kept as sorted packed files.

A first pass counts words and numbers them in order of their hashes; further on an n-gram is a row of
numbers. Map tasks reduce their texts to distinct n-grams of the highest order with counts, as
arrays, not rows. They are dealt over a grid, one side by range of the last word and the other by
that of the word before it, so neither a frequent context nor a frequent word lands in one task; the
grid grows with the text. All n-grams that end in one pair share a cell, so each cell has what the
lower orders count too: how many words stand before an n-gram, or for one that begins a text how
often it does. Each cell writes each order's n-grams as one sorted file, an n-gram by the place of
its ending in the file of the order below and its first word. It passes on what it adds to each word
(number of contexts it follows) and to each context (the total of its n-grams' counts, how many of
them have count 1, 2 and more). A context is an n-gram too; a second deal brings those sums to the
cell that holds it, and they are kept by its place there. Files lie in the shared folder, which must
be a mounted one; scoring workers map them into memory and look n-grams up, so memory does not grow
with the model. Only sums and numbers of words over all cells come to the driver.

Sorted keys are kept as their low bytes, with the high ones once for all keys that share them; rows
of small numbers as one byte that stands for a frequent row. What moves between tasks is steps
between sorted numbers, byte by byte, compressed. N-grams are sorted as single 64-bit numbers made of
their words' numbers or, where those are too wide, of their places among the words at hand; a step of
scoring computes everything once for each distinct n-gram.

Before the first word of a text stands one begin sign; the first words have shorter contexts.
Probabilities of all known words and one class for unknown ones sum to one for every context.
"""

from __future__ import annotations

import json
import os
import uuid
from collections import OrderedDict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import filled, new_path, register, table, text_bytes
from barloom.llm.textnum import U64, chain, steps, words

BEGIN, END = U64(0xBE617), U64(0xE2D)
#: Text per cell of the grid.
CELL_BYTES = 16_000_000
FOLDS, HELD_OUT = 7, 2
#: Text that is scored at a time: the more, the fewer look-ups an n-gram that comes again takes.
SCORE_BYTES = 6_000_000
#: Files that a worker keeps mapped.
OPEN_FILES = 512
#: In a byte that stands for a row of numbers: a row that is not among the frequent ones.
RARE = 255
_WORD_COLUMNS = 5  # contexts followed, pairs begun with count 1, 2, 3 or more, total of their counts
_CONTEXT_COLUMNS = 4  # of a longer context: n-grams begun with count 1, 2, 3 or more, total of their counts


def _deal(h: np.ndarray, n: int) -> np.ndarray:
    """Which of n equal ranges of hashes each lies in; increasing in the hash."""
    return ((h >> U64(32)) * U64(n) >> U64(32)).astype(np.int64)


def _tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts, an end after each, and where each text's begin (n + 1)."""
    w, at = words(texts)
    return np.insert(w, at[1:], END), at + np.arange(len(at))


def _before(x: np.ndarray, heads: np.ndarray, first) -> np.ndarray:
    """What stands a token earlier in ``x``; ``first`` where a text begins."""
    out = np.concatenate([x[:1], x[:-1]])
    out[heads[:-1]] = first
    return out


def _starts(*columns: np.ndarray) -> np.ndarray:
    """Whether each place differs from the one before it in any column."""
    out = np.ones(len(columns[0]), bool)
    out[1:] = False
    for x in columns:
        out[1:] |= x[1:] != x[:-1]
    return out


def _ranks(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ones of some numbers from 0 in order, and the place of each number among them."""
    top = int(x.max()) + 1
    if top > 8 * len(x):
        return np.unique(x, return_inverse=True)
    there = np.zeros(top, bool)
    there[x] = True
    return np.flatnonzero(there), (np.cumsum(there) - 1)[x]


class _Keys:
    """Rows of numbers, side by side in one 64-bit number for each column: it ascends by the last row, then the one before it and so on.

    ``key`` is None if 64 bits are too few, even for the places of each row's numbers among its distinct ones.
    """

    def __init__(self, *rows: np.ndarray):
        self.kinds, self.low, self.distinct = [x.dtype for x in rows], [x.min() for x in rows], [None] * len(rows)
        rows = [x - low for x, low in zip(rows, self.low)]
        self.widths = [int(x.max()).bit_length() for x in rows]
        for k in sorted(range(len(rows)), key=lambda k: (k > 0, -self.widths[k])):  # the first row may be values: few distinct ones
            if sum(self.widths) <= 64:
                break
            self.distinct[k], rows[k] = _ranks(rows[k])
            self.widths[k] = (len(self.distinct[k]) - 1).bit_length()
        self.key = None
        if sum(self.widths) <= 64:
            self.key = rows[-1].astype(U64)
            for x, width in zip(rows[-2::-1], self.widths[-2::-1]):
                self.key <<= U64(width)
                self.key |= x.astype(U64, copy=False)

    def row(self, k: int, key: np.ndarray) -> np.ndarray:
        """The numbers of one row in some keys."""
        x = (key >> U64(min(sum(self.widths[:k]), 63))) & U64((1 << self.widths[k]) - 1)
        if self.distinct[k] is not None:
            x = self.distinct[k][x.astype(np.int64)]
        return x.astype(self.kinds[k]) + self.low[k]


def _order(grams: np.ndarray) -> np.ndarray:
    """Order of n-grams (columns) by the last word, then the one before it and so on; equal ones in any order."""
    key = _Keys(*grams).key if grams.shape[1] else None
    return np.lexsort(grams) if key is None else np.argsort(key)


def _distinct(grams: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams (columns of ``grams``) in order, and the sums of their values."""
    if not grams.shape[1]:
        return grams, values
    if values.ndim == 1 and (keys := _Keys(*grams)).key is not None:
        # to sort keys takes a fraction of what finding their order does: values are 1 but for few
        key = np.sort(keys.key)
        first = np.flatnonzero(_starts(key))
        total = np.diff(np.append(first, len(key)))
        key = key[first]
        other = np.flatnonzero(values != 1)
        np.add.at(total, np.searchsorted(key, keys.key[other]), values[other] - 1)
        return np.stack([keys.row(k, key) for k in range(len(grams))]), total
    order = _order(grams)
    grams = grams[:, order]
    first = np.flatnonzero(_starts(*grams))
    return grams[:, first], np.add.reduceat(values[order], first, axis=0)


def _smallest(x: np.ndarray) -> np.ndarray:
    return x.astype(np.min_scalar_type(int(x.max()) if x.size else 0))


# -- what moves between tasks

#: A cell; n-grams with counts (kind 0), sums of words (1) or of contexts of k - 1 words (k, from 3), sums over a cell (2).
PARTS = "cell bigint, kind int, data binary"


def _rows(parts: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([p[k] for p in parts], t) for k, t in enumerate((pa.int64(), pa.int32(), pa.binary()))], ["cell", "kind", "data"])


def _packed(*arrays: np.ndarray) -> bytes:
    """Arrays of numbers from 0, byte by byte of their numbers, compressed."""
    small = [np.ascontiguousarray(_smallest(x)) for x in arrays]
    sizes = np.array([len(small), *(k for x in small for k in (x.itemsize, len(x)))], np.int64)
    data = b"".join([sizes.tobytes(), *(x.view(np.uint8).reshape(-1, x.itemsize).T.tobytes() for x in small)])
    return len(data).to_bytes(8, "little") + pa.compress(data, "zstd", asbytes=True)


def _unpacked(data: bytes) -> list[np.ndarray]:
    data = pa.decompress(data[8:], int.from_bytes(data[:8], "little"), "zstd", asbytes=True)
    count = int(np.frombuffer(data, np.int64, 1)[0])
    at, out = 8 * (1 + 2 * count), []
    for size, n in np.frombuffer(data, np.int64, 2 * count, 8).reshape(-1, 2).tolist():
        planes = np.frombuffer(data, np.uint8, size * n, at).reshape(size, n)
        out.append(np.ascontiguousarray(planes.T).view(f"<u{size}").reshape(-1))
        at += size * n
    return out


def _folded(grams: np.ndarray) -> list[np.ndarray]:
    """Distinct n-grams in order as a tree from the last word: at each depth steps between words, and how many each node above has."""
    out = []
    above = np.zeros(grams.shape[1], bool)
    above[:1] = True
    for x in grams[::-1].astype(np.int64):
        here = above.copy()
        here[1:] |= x[1:] != x[:-1]
        at = np.flatnonzero(here)
        first = above[at]
        out += [np.where(first, x[at], np.diff(x[at], prepend=0)), np.diff(np.append(np.flatnonzero(first), len(at)))]
        above = here
    return out


def _unfolded(arrays: list[np.ndarray]) -> np.ndarray:
    columns: list[np.ndarray] = []
    for step, count in zip(arrays[::2], arrays[1::2]):
        step, count = step.astype(np.int64), count.astype(np.int64)
        total = np.cumsum(step)
        first = np.cumsum(count) - count
        columns = [np.repeat(x, count) for x in columns]
        columns.append(total - np.repeat(total[first] - step[first], count))
    return np.stack(columns[::-1])


# -- files


def _save(folder: str, name: str, **arrays: np.ndarray) -> None:
    """Write arrays as one file; a repeated task puts the same bytes in place."""
    os.makedirs(folder, exist_ok=True)
    listed, at = {}, 0
    for key, x in arrays.items():
        listed[key] = (x.dtype.str, x.shape, at)
        at += -(-x.nbytes // 16) * 16
    head = json.dumps(listed).encode()
    head += b" " * (-(len(head) + 8) % 16)
    draft = os.path.join(folder, f".{name}-{uuid.uuid4().hex}")
    with open(draft, "wb") as f:
        f.write(len(head).to_bytes(8, "little") + head)
        for x in arrays.values():
            f.write(x.tobytes() + bytes(-x.nbytes % 16))
    os.replace(draft, os.path.join(folder, name))


_MAPPED: OrderedDict[str, dict[str, np.ndarray]] = OrderedDict()


def _mapped(folder: str, name: str) -> dict[str, np.ndarray] | None:
    """The arrays in a file, mapped into memory; None if there is none."""
    path = f"{folder}/{name}"
    if path in _MAPPED:
        _MAPPED.move_to_end(path)
        return _MAPPED[path]
    if not os.path.exists(path):
        return None
    raw = np.asarray(np.memmap(path, np.uint8, "r"))
    begin = 8 + int.from_bytes(raw[:8].tobytes(), "little")
    out = {}
    for key, (kind, shape, at) in json.loads(raw[8:begin].tobytes()).items():
        size = int(np.prod(shape)) * np.dtype(kind).itemsize
        out[key] = raw[begin + at : begin + at + size].view(kind).reshape(shape)
    _MAPPED[path] = out
    if len(_MAPPED) > OPEN_FILES:
        _MAPPED.popitem(last=False)
    return out


_PLANES = (4, 2, 1)


def _key_arrays(keys: np.ndarray) -> dict[str, np.ndarray]:
    """Sorted distinct keys: low bytes in planes of 4, 2 and 1 bytes, and the distinct high parts with their first places."""
    cost = [size * len(keys) + 12 * int(_starts(keys >> U64(8 * size)).sum()) for size in range(1, 8)]
    size = 1 + int(np.argmin(cost))
    high, first = np.unique(keys >> U64(8 * size), return_index=True)
    out, shift = {"high": high, "first": _smallest(np.append(first, len(keys)))}, 0
    for width in _PLANES:
        if size & width:
            out[f"low{width}"] = ((keys >> U64(shift)) & U64((1 << 8 * width) - 1)).astype(f"<u{width}")
            shift += 8 * width
    return out


def _places(stored: dict[str, np.ndarray], keys: np.ndarray) -> np.ndarray:
    """Places of keys in a file, -1 where one is not there."""
    planes, shift = [], 0
    for width in _PLANES:
        if f"low{width}" in stored:
            planes.append((stored[f"low{width}"], shift))
            shift += 8 * width

    def low(at: np.ndarray) -> np.ndarray:
        if len(planes) == 1:
            return planes[0][0][at]
        out = planes[0][0][at].astype(U64)
        for x, by in planes[1:]:
            out |= x[at].astype(U64) << U64(by)
        return out

    high = keys >> U64(shift)
    group = np.minimum(np.searchsorted(stored["high"], high), len(stored["high"]) - 1)
    there = np.flatnonzero(stored["high"][group] == high)
    out = np.full(len(keys), -1)
    if not len(there):
        return out
    wanted = (keys[there] & U64((1 << shift) - 1)).astype(planes[0][0].dtype if len(planes) == 1 else U64)
    begin, end = (stored["first"][group[there] + k].astype(np.int64) for k in (0, 1))
    size = end - begin  # of what may hold the key, some keys at first
    while True:
        done = size == 1
        if 2 * np.count_nonzero(done) >= len(done):
            at = begin[done]
            hit = low(at) == wanted[done]
            out[there[done][hit]] = at[hit]
            left = ~done
            there, wanted, begin, size = there[left], wanted[left], begin[left], size[left]
            if not len(there):
                return out
        half = size >> 1
        middle = begin + half
        begin = np.where(low(middle) <= wanted, middle, begin)
        size -= half


def _row_arrays(rows: np.ndarray) -> dict[str, np.ndarray]:
    """Rows of numbers as distinct rows, frequent ones first, and a byte for each; rare ones aside."""
    code = _ranks(rows[:, 0] if rows.shape[1] == 1 else chain(*rows.T.astype(U64)))[1]
    times = np.bincount(code)
    first = np.empty(len(times), np.int64)  # any place of each row
    first[code] = np.arange(len(code))
    order = np.argsort(-times, kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    code = place[code]
    rare = np.flatnonzero(code >= RARE)
    return {"row": _smallest(rows[first[order]]), "code": np.minimum(code, RARE).astype(np.uint8), "rare": _smallest(rare), "rest": _smallest(code[rare])}


def _row(stored: dict[str, np.ndarray], at: np.ndarray) -> np.ndarray:
    """The rows of numbers at some places of a file."""
    code = stored["code"][at].astype(np.int64)
    rare = np.flatnonzero(code == RARE)
    code[rare] = stored["rest"][np.searchsorted(stored["rare"], at[rare].astype(stored["rare"].dtype))]
    return stored["row"][code].astype(np.int64)


# -- words


@dataclass(frozen=True)
class Numbers:
    """Numbers of words: in which folder their hashes lie, and the first number of each range of hashes.

    ``size`` is the number of words; it stands for no word (before a text's begin), size + 1 for an unknown one.
    """

    folder: str
    base: tuple[int, ...]

    @property
    def size(self) -> int:
        return self.base[-1]

    @property
    def kind(self) -> type:
        return np.uint32 if self.size + 2 < 2**32 else U64

    def of(self, hashes: np.ndarray) -> np.ndarray:
        """The numbers of hashes in ascending order."""
        out = np.full(len(hashes), self.size + 1, U64)
        ends = np.searchsorted(_deal(hashes, len(self.base) - 1), np.arange(len(self.base)))
        for k in np.flatnonzero(np.diff(ends)).tolist():
            if (stored := _mapped(self.folder, f"words-{k}")) is not None:
                own = hashes[ends[k] : ends[k + 1]]
                at = np.minimum(np.searchsorted(stored["key"], own), len(stored["key"]) - 1)
                out[ends[k] : ends[k + 1]] = np.where(stored["key"][at] == own, U64(self.base[k]) + at.astype(U64), U64(self.size + 1))
        return out

    def ranges(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For words in ascending order: the ranges they lie in, and for each the first of its words (n + 1)."""
        at = np.searchsorted(x, np.array(self.base, U64).astype(x.dtype))
        own = np.flatnonzero(np.diff(at))
        return own, np.append(at[own], at[-1] if len(own) else 0)

    def side(self, x: np.ndarray, n: int) -> np.ndarray:
        """Which of n equal ranges of numbers each lies in."""
        return (x.astype(U64) * U64(n) // U64(self.size + 2)).astype(np.int64)


def _count_words(ranges: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A task's texts to words with counts, by range of hashes."""
        held: list[tuple[np.ndarray, np.ndarray]] = []
        fresh = 0

        def settle() -> None:
            nonlocal fresh
            key, n = _distinct(np.concatenate([x for x, _ in held])[None], np.concatenate([x for _, x in held]))
            held[:] = [(key[0], n)]
            fresh = 0

        for batch in batches:
            for first, count in steps(batch.column(0)):
                held.append(np.unique(_tokens(batch.column(0).slice(first, count))[0], return_counts=True))
                fresh += len(held[-1][0])
                if fresh > max(2_000_000, len(held[0][0])):
                    settle()
        if not held:
            return
        held.append((np.array([BEGIN]), np.zeros(1, np.int64)))
        settle()
        key, n = held.pop()
        ends = np.searchsorted(_deal(key, ranges), np.arange(ranges + 1))
        for k, (a, b) in enumerate(zip(ends, ends[1:])):
            if b > a:
                yield _rows([(k, 1, _packed(np.diff(key[a:b], prepend=U64(0)), n[a:b]))])

    return run


def _merge_words(folder: str):
    def run(key: tuple, group: pa.Table) -> pa.Table:
        """One range of hashes: its words sorted and written with their counts."""
        cell = key[0].as_py()
        parts = [_unpacked(x) for x in group.column("data").to_pylist()]
        keys = np.concatenate([np.cumsum(step.astype(U64), dtype=U64) for step, _ in parts])
        keys, n = _distinct(keys[None], np.concatenate([x.astype(np.int64) for _, x in parts]))
        _save(folder, f"words-{cell}", key=keys[0], **_row_arrays(n[:, None]))
        return pa.table({"cell": [cell], "size": [len(n)], "tokens": [int(n.sum())], "words": [int((n > 0).sum())]})

    return run


# -- n-grams


def _count(side: int, order: int, numbers: Numbers):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A task's texts to n-grams per cell."""
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # numbers of words, n-grams of places among them, counts
        fresh = 0

        def settle() -> None:
            nonlocal fresh
            known = np.sort(np.concatenate([x for x, _, _ in held]))
            known = known[_starts(known)]
            grams = np.concatenate([np.searchsorted(known, x).astype(np.uint32)[g] for x, g, _ in held], axis=1)
            held[:] = [(known, *_distinct(grams, np.concatenate([n for _, _, n in held])))]
            fresh = 0

        for batch in batches:
            for first, count in steps(batch.column(0)):
                now, heads = _tokens(batch.column(0).slice(first, count))
                distinct, place = np.unique(np.append(now, BEGIN), return_inverse=True)
                known = np.append(numbers.of(distinct), U64(numbers.size)).astype(numbers.kind)  # ascending, as all words have numbers
                last = [place[:-1]]
                while len(last) < order:
                    last.append(_before(last[-1], heads, place[-1] if len(last) == 1 else len(distinct)))
                held.append((known, *_distinct(np.stack(last[::-1]).astype(np.uint32), np.ones(len(now), np.int64))))
                fresh += len(held[-1][2])
                if fresh > max(2_000_000, len(held[0][2])):
                    settle()
        if not held:
            return
        settle()
        known, grams, n = held.pop()
        grams = known[grams]
        cell = numbers.side(grams[-2], side) * side + numbers.side(grams[-1], side)
        for c, own in _by(cell):
            yield _rows([(c, 0, _packed(*_folded(grams[:, own]), n[own]))])

    return run


def _by(cell: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each cell with the places that belong to it, in order."""
    order = np.argsort(_smallest(cell), kind="stable")
    ends = np.cumsum(np.bincount(cell)) if len(cell) else np.zeros(0, np.int64)
    for c in np.flatnonzero(np.diff(ends, prepend=0)).tolist():
        yield c, order[ends[c - 1] if c else 0 : ends[c]]


def _names_of_sums(order: int) -> list[str]:
    """Sums over all cells: pairs first, then the counts 1 to 4 of each order's n-grams."""
    return ["pairs", *(f"{level}_{k}" for level in range(1, order + 1) for k in range(1, 5))]


def _begun(context: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct contexts in order: how many n-grams of count 1, 2 and more each begins, and the total of their counts."""
    out = np.zeros((0, _CONTEXT_COLUMNS), np.int64)
    if not len(value):
        return context, out
    keys = _Keys(value, *context)
    if keys.key is None:
        order = _order(context)
        context, value = context[:, order], value[order]
        first = np.flatnonzero(_starts(*context))
        context = context[:, first]
    else:
        key = np.sort(keys.key)
        first = np.flatnonzero(_starts(key >> U64(keys.widths[0])))
        context, value = np.stack([keys.row(k, key[first]) for k in range(1, 1 + len(context))]), keys.row(0, key)
    sums = [value == 1, value == 2, value > 2, value]
    return context, np.stack([np.add.reduceat(x.astype(np.int64), first) for x in sums], axis=1)


def _merge_grams(side: int, order: int, numbers: Numbers):
    def run(key: tuple, group: pa.Table) -> pa.Table:
        """One cell: the n-grams of each order sorted and written, and what they add to each word and context."""
        cell = key[0].as_py()
        (begin,) = numbers.of(np.array([BEGIN]))
        none, wide = U64(numbers.size), U64(numbers.size + 1)
        parts = [_unpacked(x) for x in group.column("data").to_pylist()]
        grams = np.concatenate([_unfolded(x[:-1]).astype(numbers.kind) for x in parts], axis=1)
        grams, n = _distinct(grams, np.concatenate([x[-1].astype(np.int64) for x in parts]))
        del parts
        # where a new n-gram of each order starts: those with equal last words lie together
        starts = {2: _starts(grams[-2], grams[-1])}
        for k in range(3, order + 1):
            starts[k] = starts[k - 1] | _starts(grams[-k])
        sums = np.zeros(len(_names_of_sums(order)), np.int64)
        out: list[tuple] = []
        place = grams[-1].astype(U64)  # of the ending in the file of the order below; for pairs the last word
        for k in range(2, order + 1):
            at = np.flatnonzero(starts[k])
            first = grams[-k][at]
            value = n
            if k < order:
                value = np.where(first == begin, np.add.reduceat(n, at), np.add.reduceat(starts[k + 1].astype(np.int64), at))
            kept = first != none
            number = np.cumsum(kept) - 1
            if kept.any():
                keys = place[at[kept]] * wide + first[kept].astype(U64)
                _save(numbers.folder, f"grams{k}-{cell}", **_key_arrays(keys), **_row_arrays(value[kept, None]))
            place = number[np.cumsum(starts[k]) - 1].astype(U64)
            at, value = at[kept], value[kept]
            sums[1 + 4 * (k - 1) : 1 + 4 * k] = [(value == j).sum() for j in range(1, 5)]
            context, begun = _begun(grams[-k:-1, at], value)
            if k > 2:
                to = numbers.side(context[-2], side) * side + numbers.side(context[-1], side)
                out += [(c, k, _packed(*_folded(context[:, own]), *begun[own].T)) for c, own in _by(to)]
                continue
            word, times = np.unique(grams[-1, at], return_counts=True)
            follows = np.zeros((len(word), _WORD_COLUMNS), np.int64)
            follows[:, 0] = times
            word, follows = _distinct(np.concatenate([word[None], context], axis=1), np.concatenate([follows, np.pad(begun, ((0, 0), (1, 0)))]))
            ranges, ends = numbers.ranges(word[0])
            for c, a, b in zip(ranges.tolist(), ends, ends[1:]):
                out.append((c, 1, _packed(*_folded(word[:, a:b]), *follows[a:b].T)))
        return pa.Table.from_batches([_rows([(-1, 2, _packed(sums)), *out])])

    return run


def _nodes(folder: str, cell: int, grams: np.ndarray, wide: U64) -> np.ndarray:
    """Places of n-grams of a cell in the file of their order."""
    place = grams[-1].astype(U64)
    for k in range(2, len(grams) + 1):
        place = _places(_mapped(folder, f"grams{k}-{cell}"), place * wide + grams[-k].astype(U64)).astype(U64)
    return place.astype(np.int64)


def _merge_sums(order: int, numbers: Numbers):
    def run(key: tuple, group: pa.Table) -> pa.Table:
        """One range of words and one cell's contexts: their rows summed and written; the sums of a cell pass through."""
        cell = key[0].as_py()
        parts: dict[int, list[list[np.ndarray]]] = {}
        for kind, data in zip(group.column("kind").to_pylist(), group.column("data").to_pylist()):
            parts.setdefault(kind, []).append(_unpacked(data))
        sums = np.zeros(len(_names_of_sums(order)), np.int64)
        for (x,) in parts.pop(2, []):
            sums += x.astype(np.int64)
        for kind, own in parts.items():
            columns = _WORD_COLUMNS if kind == 1 else _CONTEXT_COLUMNS
            if kind == 1:
                name, size = f"stats-{cell}", numbers.base[cell + 1] - numbers.base[cell]
            else:
                name, size = f"begun{kind - 1}-{cell}", len(_mapped(numbers.folder, f"grams{kind - 1}-{cell}")["code"])
            rows = np.zeros((size, columns), np.int64)
            for x in own:
                grams = _unfolded(x[:-columns])
                at = grams[0] - numbers.base[cell] if kind == 1 else _nodes(numbers.folder, cell, grams, U64(numbers.size + 1))
                rows[at] += np.stack(x[-columns:], axis=1).astype(np.int64)
            _save(numbers.folder, name, **_row_arrays(rows))
            if kind == 1:
                sums[0] += rows[:, 0].sum()
                sums[1:5] += [(rows[:, 0] == k).sum() for k in range(1, 5)]
        return pa.table({x: [int(v)] for x, v in zip(_names_of_sums(order), sums)})

    return run


@dataclass(frozen=True)
class Model:
    """The words' numbers, the grid's side, and sums over all training tokens."""

    numbers: Numbers
    side: int
    tokens: int
    words: int
    pairs: int
    discounts: tuple[tuple[float, float, float], ...]  # of words, pairs and each longer n-gram
    word_rest: float  # probability that the word level leaves to the uniform one


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts for counts 1, 2 and more; fixed ones where a count of counts is 0."""
    if not (n1 and n2 and n3 and n4):
        return 0.5, 1.0, 1.5
    y = n1 / (n1 + 2 * n2)
    raw = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
    return tuple(min(max(d, 0.05 * k), 0.95 * k) for k, d in enumerate(raw, 1))


def _mounted(spark) -> str:
    where = urlparse(new_path(spark, "lm"))
    if where.scheme not in ("", "file"):
        raise ValueError(f"the model's files are memory-mapped: spark.checkpoint.dir must be a mounted folder, not {where.scheme}:")
    return where.path


def train(docs: DataFrame, text_col: str = "text", order: int = 2) -> Model:
    """Count all texts of ``docs``; null and empty ones are one end token each."""
    folder = _mounted(docs.sparkSession)
    texts = docs.select(filled(text_col).alias("text"))
    side = max(2, int(np.ceil(np.sqrt(text_bytes(texts, "text") / CELL_BYTES))))
    cells, ranges, names = side * side, 4 * side, _names_of_sums(order)
    found = (
        texts.mapInArrow(_count_words(ranges), PARTS)
        .repartition(ranges, "cell").groupBy("cell").applyInArrow(_merge_words(folder), "cell bigint, size bigint, tokens bigint, words bigint")
        .collect()
    )
    sizes = np.zeros(ranges, np.int64)
    sizes[[r["cell"] for r in found]] = [r["size"] for r in found]
    tokens, known = (sum(r[name] for r in found) for name in ("tokens", "words"))
    numbers = Numbers(folder, (0, *np.cumsum(sizes).tolist()))
    sums = (
        texts.mapInArrow(_count(side, order, numbers), PARTS)
        .repartition(cells, "cell").groupBy("cell").applyInArrow(_merge_grams(side, order, numbers), PARTS)
        .repartition(cells, "cell").groupBy("cell").applyInArrow(_merge_sums(order, numbers), ", ".join(f"{n} bigint" for n in names))
        .agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names])
        .first()
    )
    of = tuple(discounts(*(sums[f"{level}_{k}"] for k in range(1, 5))) for level in range(1, order + 1))
    more = known - sums["1_1"] - sums["1_2"]
    left = of[0][0] * sums["1_1"] + of[0][1] * sums["1_2"] + of[0][2] * more
    return Model(numbers, side, tokens, known, sums["pairs"], of, left / sums["pairs"] if sums["pairs"] else 1.0)


def _discount(n: np.ndarray, d: tuple[float, float, float]) -> np.ndarray:
    return np.array([0.0, *d])[np.minimum(n, 3)]


def _weights(begun: np.ndarray, d: tuple[float, float, float]) -> tuple[np.ndarray, np.ndarray]:
    """For contexts: by what to divide counts, and the weight of the order below; 1 and 1 for one that was not seen, as it begins nothing."""
    seen = begun[3] > 0
    total = np.where(seen, begun[3], 1).astype(float)
    return total, np.where(seen, (begun[:3] * np.array(d)[:, None]).sum(axis=0) / total, 1.0)


def _look_up(folder: str, k: int, cell: np.ndarray, keys: np.ndarray, begun: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of n-grams of order k: places in their cells' files (-1: not there), counts, and what they begin (rows) if asked."""
    place, n = np.full(len(keys), -1), np.zeros(len(keys), np.int64)
    rows = np.zeros((_CONTEXT_COLUMNS, len(keys) if begun else 0), np.int64)
    for c, own in _by(cell):
        if (stored := _mapped(folder, f"grams{k}-{c}")) is None:
            continue
        at = _places(stored, keys[own])
        own, at = own[at >= 0], at[at >= 0]
        place[own] = at
        n[own] = _row(stored, at)[:, 0]
        if begun and (stored := _mapped(folder, f"begun{k}-{c}")) is not None:
            rows[:, own] = _row(stored, at).T
    return place, n, rows


def score_texts(model: Model, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For each text: tokens, known tokens, base score, model's log10 probability."""
    order, side, numbers = len(model.discounts), model.side, model.numbers
    now, at = _tokens(texts)
    distinct, place = np.unique(np.append(now, BEGIN), return_inverse=True)
    number = numbers.of(distinct)
    stats = np.zeros((1 + _WORD_COLUMNS, len(distinct)), np.int64)  # raw count, then sums
    known = np.flatnonzero(number < numbers.size)
    ranges, ends = numbers.ranges(number[known])
    for c, a, b in zip(ranges.tolist(), ends, ends[1:]):
        own = known[a:b]
        local = (number[own] - U64(numbers.base[c])).astype(np.int64)
        stats[0, own] = _row(_mapped(numbers.folder, f"words-{c}"), local)[:, 0]
        stats[1:, own] = _row(_mapped(numbers.folder, f"stats-{c}"), local).T
    raw, follows = stats[:2]
    p = (follows - _discount(follows, model.discounts[0])) / max(model.pairs, 1) + model.word_rest / (model.words + 1)
    base = np.log10((raw + 1) / (model.tokens + model.words + 1))

    # all is computed once for each distinct n-gram: those with equal endings lie together once the longest are in order
    none, wide = len(distinct), U64(numbers.size + 1)
    number = np.append(number, U64(numbers.size))
    last = [place[:-1]]
    while len(last) < order:
        last.append(_before(last[-1], at, place[-1] if len(last) == 1 else none))
    ordered = _order(np.stack(last[::-1]))
    last = [x[ordered] for x in last]
    group, of_token = last[0], place[:-1]  # of each n-gram of the order at hand, in order, and of each token
    begun, head = stats[2:], place[-1]  # what each n-gram of the order below begins, and the one before a text's first word
    starts = _starts(last[0])
    node, cell = None, None
    for k in range(2, order + 1):
        starts = starts | _starts(last[k - 1])
        one = np.flatnonzero(starts)
        below, before = group[one], last[k - 1][one]
        if k == 2:
            ending = number[below]
            cell = numbers.side(np.minimum(number[before], wide), side) * side + numbers.side(ending, side)
            there = ending < wide
        else:
            cell, ending = cell[below], node[below]
            there = ending >= 0
        there &= number[before] < numbers.size
        asked = np.flatnonzero(there)
        node, n, rows = np.full(len(one), -1), np.zeros(len(one), np.int64), np.zeros((_CONTEXT_COLUMNS, len(one)), np.int64)
        keys = ending[asked].astype(U64) * wide + number[before[asked]]
        node[asked], n[asked], found = _look_up(numbers.folder, k, cell[asked], keys, k < order)
        if k < order:
            rows[:, asked] = found
        d = model.discounts[k - 1]
        total, weight = (np.append(x, 1.0) for x in _weights(begun, d))  # the last one: no context
        context = _before(of_token, at, head)[ordered[one]]  # the n-gram of the order below that ends a token earlier
        p = (n - _discount(n, d)) / total[context] + weight[context] * p[below]
        begun, head = rows, -1
        group = np.cumsum(starts) - 1
        of_token = np.empty(len(group), np.int64)
        of_token[ordered] = group
    first = at[:-1]
    token = place[:-1]
    sums = [np.add.reduceat(x, first) for x in ((raw > 0).astype(np.int64)[token], base[token], np.log10(p)[of_token])]
    return np.diff(at), *sums


SCORED = "id bigint, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id_col, n_tokens, n_known, train_tokens, base_score, score.

    Null and empty texts are one end token; null ids stay null; repeated rows each get a row; an
    empty table gives none. Other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, count in steps(batch.column(1), SCORE_BYTES):
                part = batch.slice(first, count)
                n, known, base, p = score_texts(model, part.column(1))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *(pa.array(x) for x in (n, known, np.full(count, model.tokens), base, p))],
                    ["id", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
                )

    rows = docs.select(F.col(id_col).cast("long").alias("id"), filled(text_col).alias("text"))
    return rows.mapInArrow(run, SCORED).withColumnRenamed("id", id_col)


def is_held_out(id_col: str = "doc_id"):
    """Whether a document's fold is the held-out one; a null id never is."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def train_and_score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = 2) -> DataFrame:
    """``score`` of all documents by a model of those not held out, with held_out."""
    model = train(docs.filter(~is_held_out(id_col)), text_col, order)
    return score(docs, model, id_col, text_col).withColumn("held_out", is_held_out(id_col))


def op10_lm_scoring(spark, d, order: int = 2):
    return train_and_score(table(spark, d, "documents"), order=order)


#: Order of the registered query's model.
ORDER = 3
register("op10_lm_scoring")(partial(op10_lm_scoring, order=ORDER))
