"""Byte-pair merging of many pieces at once, and joining of encoded halves.

A piece is a run of symbols within which merges may happen: one match of the split pattern. The
pair of lowest rank, leftmost among equals, merges first. Short pieces are merged side by side
in numpy. Long ones are encoded by halves: a sequence of tokens is the encoding of its symbols
exactly if every two neighbours are the encoding of their own symbols, so two encoded halves are
joined by re-encoding a window round the seam that grows until its two edges pass that test.
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence
from functools import lru_cache

import numpy as np

#: Pieces of more symbols are cut in halves down to this.
LEAF = 32
_NONE = np.int64(1 << 40)


class Merges:
    """Pairs that merge: parallel arrays of left and right symbol, rank and symbol made."""

    def __init__(self, left: Sequence[int], right: Sequence[int], rank: Sequence[int], made: Sequence[int], parts: dict[int, tuple[int, ...]]):
        keys = (np.asarray(left, np.uint64) << np.uint64(32)) | np.asarray(right, np.uint64)
        self._bits = max(8, int(np.ceil(np.log2(max(len(keys), 1) * 6))))
        self._mask = (1 << self._bits) - 1
        self._keys = np.full(1 << self._bits, np.uint64(0xFFFFFFFFFFFFFFFF))
        self._rank = np.full(1 << self._bits, _NONE)
        self._made = np.zeros(1 << self._bits, np.int32)
        self._dict = {(a, b): (r, m) for a, b, r, m in zip(left, right, rank, made, strict=True)}
        self.parts = parts  # base symbols of each token
        todo, rank, made = np.arange(len(keys)), np.asarray(rank, np.int64), np.asarray(made, np.int32)
        at = self._slot(keys)
        while len(todo):
            free = self._keys[at] == np.uint64(0xFFFFFFFFFFFFFFFF)
            spot, who = np.unique(at[free], return_index=True)
            own = todo[free][who]
            self._keys[spot], self._rank[spot], self._made[spot] = keys[own], rank[own], made[own]
            rest = ~np.isin(todo, own)
            todo, at = todo[rest], (at[rest] + 1) & self._mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self._bits)).astype(np.int64)

    def look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of each pair (huge: does not merge) and symbol made."""
        keys = (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)
        at = self._slot(keys)
        found = self._keys[at]
        open_ = np.flatnonzero((found != keys) & (found != np.uint64(0xFFFFFFFFFFFFFFFF)))
        while len(open_):
            at[open_] = (at[open_] + 1) & self._mask
            found = self._keys[at[open_]]
            open_ = open_[(found != keys[open_]) & (found != np.uint64(0xFFFFFFFFFFFFFFFF))]
        return self._rank[at], self._made[at]

    def encode_short(self, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of all pieces in order, and their number for each; every length is 1 to LEAF."""
        n = len(lengths)
        out_len = np.zeros(n, np.int64)
        done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        who, size, s = np.arange(n), lengths.astype(np.int64), symbols.astype(np.int32)
        rank = np.full(len(s), _NONE)
        if len(s) > 1:
            rank[:-1] = self.look_up(s[:-1], s[1:])[0]
        rank[np.cumsum(size) - 1] = _NONE
        while len(who):
            start = np.cumsum(size) - size
            place = np.arange(len(s)) - np.repeat(start, size)
            least = np.minimum.reduceat(rank * LEAF * 2 + place, start)
            alive = least < _NONE * LEAF * 2
            if not alive.all():
                keep = np.repeat(alive, size)
                done.append((who[~alive], size[~alive], s[~keep]))
                who, size, s, rank, least = who[alive], size[alive], s[keep], rank[keep], least[alive]
                if not len(who):
                    break
                start = np.cumsum(size) - size
            i = start + (least & (LEAF * 2 - 1))
            s[i] = self.look_up(s[i], s[i + 1])[1]
            keep = np.ones(len(s), bool)
            keep[i + 1] = False
            rank[i] = rank[i + 1]  # nothing follows, or looked up anew below
            s, rank = s[keep], rank[keep]
            i -= np.arange(len(i))
            size = size - 1
            start = np.cumsum(size) - size
            after = i + 1 < start + size
            rank[i[after]] = self.look_up(s[i[after]], s[i[after] + 1])[0]
            before = i > start
            rank[i[before] - 1] = self.look_up(s[i[before] - 1], s[i[before]])[0]
        if not done:
            return np.zeros(0, np.int32), out_len
        who = np.concatenate([d[0] for d in done])
        size = np.concatenate([d[1] for d in done])
        flat = np.concatenate([d[2] for d in done])
        out_len[who] = size
        order = np.argsort(who, kind="stable")
        return flat[spans((np.cumsum(size) - size)[order], size[order])], out_len

    def encode(self, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """As encode_short, for pieces of any length over 0."""
        lengths = np.asarray(lengths, np.int64)
        if not len(lengths) or lengths.max() <= LEAF:
            return self.encode_short(symbols, lengths)
        cuts = [leaves(int(n)) for n in lengths]
        parts = np.array([x for c in cuts for x in c], np.int64)
        flat, sizes = self.encode_short(symbols, parts)
        ends = np.cumsum(sizes)
        out, counts, leaf = [], [], 0
        for c in cuts:
            if len(c) == 1:
                out.append(flat[ends[leaf] - sizes[leaf] : ends[leaf]])
            else:
                runs = [flat[ends[k] - sizes[k] : ends[k]].tolist() for k in range(leaf, leaf + len(c))]
                out.append(np.array(self._reduce(runs), np.int32))
            counts.append(len(out[-1]))
            leaf += len(c)
        return np.concatenate(out), np.array(counts, np.int64)

    def _reduce(self, runs: list[list[int]]) -> list[int]:
        """Join neighbours pairwise, up the tree."""
        while len(runs) > 1:
            runs = [self.join(runs[k], runs[k + 1]) if k + 1 < len(runs) else runs[k] for k in range(0, len(runs), 2)]
        return runs[0]

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of two encoded runs put together."""
        reach = 1
        while True:
            a, b = max(len(left) - reach, 0), min(reach, len(right))
            window = self._merge([x for t in (*left[a:], *right[:b]) for x in self.parts.get(t, (t,))])
            if (a == 0 or self._stable(left[a - 1], window[0])) and (b == len(right) or self._stable(window[-1], right[b])):
                return left[:a] + window + right[b:]
            reach *= 2

    @lru_cache(maxsize=1 << 16)  # noqa: B019  one or two tables live as long as the worker
    def _stable(self, a: int, b: int) -> bool:
        """Whether the two tokens are the encoding of their own symbols."""
        return self._merge([*self.parts.get(a, (a,)), *self.parts.get(b, (b,))]) == [a, b]

    def _merge(self, s: list[int]) -> list[int]:
        """Plain merging of a run, by a heap of pairs over a linked list."""
        n = len(s)
        s, after, before = list(s), list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []

        def offer(k: int) -> None:
            if k >= 0 and after[k] < n and (hit := self._dict.get((s[k], s[after[k]]))):
                heapq.heappush(heap, (hit[0], k, s[k], s[after[k]], hit[1]))

        for k in range(n - 1):
            offer(k)
        while heap:
            _, k, a, b, made = heapq.heappop(heap)
            if s[k] != a or after[k] >= n or s[after[k]] != b:
                continue  # one of the two has merged since
            gone = after[k]
            s[k], s[gone], after[k] = made, -1, after[gone]
            if after[k] < n:
                before[after[k]] = k
            offer(k)
            offer(before[k])
        return [t for t in s if t >= 0]


def leaves(n: int) -> list[int]:
    """Lengths of the leaves when n symbols are cut in halves until none has more than LEAF."""
    return [n] if n <= LEAF else leaves(n // 2) + leaves(n - n // 2)


def spans(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Positions of the runs start .. start + length - 1, one run after the other."""
    length = length.astype(np.int64)
    ends = np.cumsum(length)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(start - (ends - length), length)
