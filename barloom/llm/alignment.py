"""Alignment of two tokenizers over the same bytes: common ends, groups, overlapping tokens, best partners.

Each side's tokens are a list of ascending byte ends. The shorter list drives a galloping
intersection: for each of its ends a step that doubles, then a binary search, finds the place in
the longer list. Ends found there cut both lists into groups, and the differences of places are
the ranges of tokens that overlap. Neither vocabulary has a token that runs from other characters
into a blank, tab or line feed, so what is coded and aligned is a unit (such white space and what
follows it); a worker does each unit once. Texts with white space of another kind are one unit.

How often two ids are linked is counted over the whole corpus: each batch sums its links by pair
before anything is shuffled. The second pass gives every task the counts, if a check finds them
small enough; otherwise each document's distinct pairs are joined to them.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from functools import cache
from itertools import chain, compress

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.bpe import spans
from barloom.llm.common import cut_lineage, filled, register, table
from barloom.llm.textnum import buffers, hash_words, steps
from barloom.llm.word_tokens import _byte_letters

BYTE_BPE, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Ends of the shorter list that are searched side by side.
DRIVEN = 4096
#: Characters of units that the library codes as one text.
CODED_TOGETHER = 10_000
#: Token ids of units that a worker remembers; then it starts anew.
REMEMBERED = 4_000_000
#: Most distinct pairs that every task gets (16 bytes each, 64 MB).
SENT_PAIRS = 1 << 22


def gallop(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """For each of the ascending ``short`` how many of the ascending ``long`` are smaller."""
    out, low = np.empty(len(short), np.int64), 0
    for k in range(0, len(short), DRIVEN):
        s = short[k : k + DRIVEN]
        a, b = np.full(len(s), low), np.full(len(s), low)
        open_, step = np.arange(len(s)), 1
        while len(open_):  # long[a - 1] < s; double the step until long[b] >= s
            b[open_] = np.minimum(a[open_] + step - 1, len(long))
            inside = b[open_] < len(long)
            less = np.zeros(len(open_), bool)
            less[inside] = long[b[open_[inside]]] < s[open_[inside]]
            open_ = open_[less]
            a[open_] = b[open_] + 1
            step *= 2
        while (open_ := np.flatnonzero(a < b)).size:
            middle = (a[open_] + b[open_]) >> 1
            less = long[middle] < s[open_]
            a[open_[less]] = middle[less] + 1
            b[open_[~less]] = middle[~less]
        out[k : k + DRIVEN] = a
        low = int(a[-1])
    return out


def align(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of two lists of ascending ends with the same last one: the numbers of a's and of b's tokens up to
    each common end, and the links as token numbers of a and of b (tokens whose byte ranges overlap)."""
    swapped = len(ends_a) > len(ends_b)
    short, long = (ends_b, ends_a) if swapped else (ends_a, ends_b)
    less = gallop(short, long)
    common = long[np.minimum(less, len(long) - 1)] == short if len(long) else np.zeros(0, bool)
    upto = less + common
    first = np.concatenate([[0], upto[:-1]])[: len(short)]
    many = less + 1 - first
    one, other = np.repeat(np.arange(len(short)), many), spans(first, many)
    cut, cut_long = np.flatnonzero(common) + 1, upto[common]
    return (cut_long, cut, other, one) if swapped else (cut, cut_long, one, other)


def pack(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a.astype(np.int64) << 32) | b.astype(np.int64)


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A]] = True
#: First bytes of white space of another kind.
_ODD = np.zeros(256, np.uint8)
_ODD[[0x0B, 0x0C, 0x0D, 0x1C, 0x1D, 0x1E, 0x1F]] = 1
_ODD[[0xC2, 0xE1, 0xE2, 0xE3]] = 2


def _odd_places(data: np.ndarray) -> np.ndarray:
    """Where white space other than blank, tab and line feed stands."""
    kind = _ODD[data]
    sure, lead = np.flatnonzero(kind == 1), np.flatnonzero(kind == 2)
    d = np.concatenate([data, np.zeros(2, np.uint8)])
    x, y, z = d[lead], d[lead + 1], d[lead + 2]
    white = (x == 0xC2) & ((y == 0x85) | (y == 0xA0))
    white |= (x == 0xE1) & (((y == 0x9A) & (z == 0x80)) | ((y == 0xA0) & (z == 0x8E)))
    white |= (x == 0xE2) & (y == 0x80) & ((z <= 0x8D) | (z == 0xA8) | (z == 0xA9) | (z == 0xAF))
    white |= (x == 0xE2) & (y == 0x81) & ((z == 0x9F) | (z == 0xA0))
    white |= (x == 0xE3) & (y == 0x80) & (z == 0x80)
    return np.concatenate([sure, lead[white]])


class Vocabulary:
    """Bytes and sizes of a vocabulary's tokens."""

    def __init__(self, tokens: list[bytes]):
        self.size = np.fromiter(map(len, tokens), np.int64, len(tokens))
        self._start = np.cumsum(self.size) - self.size
        self._data = np.frombuffer(b"".join(tokens), np.uint8)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        return self._data[spans(self._start[ids], self.size[ids])]

    def gives(self, ids: np.ndarray, counts: np.ndarray, wanted: list[bytes]) -> np.ndarray:
        """Whether the tokens of each of several runs of ids are the wanted bytes."""
        sizes = np.fromiter(map(len, wanted), np.int64, len(wanted))
        total = np.concatenate([[0], np.cumsum(self.size[ids])])
        ends = np.cumsum(counts)
        same = total[ends] - total[ends - counts] == sizes
        differ = np.flatnonzero(self.joined(ids[np.repeat(same, counts)]) != np.frombuffer(b"".join(compress(wanted, same)), np.uint8))
        which = np.flatnonzero(same)
        same[which[np.searchsorted(np.cumsum(sizes[which]), differ, "right")]] = False
        return same


class Units:
    """Both encodings of units and their alignment, each made once.

    For a unit: whether both sides give its bytes again, the numbers of tokens, groups and links,
    its links as packed pairs, and if wanted its groups as text.
    """

    def __init__(self, path_a: str, path_b: str, with_groups: bool = True):
        self._with_groups = with_groups
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self._a = Tokenizer.from_file(path_a)
        self._a.encode_special_tokens = True
        self._b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        byte_of = {c: k for k, c in enumerate(_byte_letters())}
        vocabulary = self._a.get_vocab()
        of_id: list[bytes] = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            of_id[i] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
        self.vocabulary_a = Vocabulary(of_id)
        pieces = []
        for i in range(self._b.get_piece_size()):
            p = self._b.id_to_piece(i)
            pieces.append(bytes([int(p[3:5], 16)]) if self._b.is_byte(i) else p.replace("▁", " ").encode())
        self.vocabulary_b = Vocabulary(pieces)
        self._blank = [self._b.piece_to_id("▁")]
        self.generation = 0
        self._forget()

    def _forget(self) -> None:
        self.generation += 1
        self._hash, self._place = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.fine = np.zeros(0, bool)
        self.counts = np.zeros((0, 4), np.int64)  # tokens of a, of b, groups, links
        self._from = np.zeros(0, np.int64)
        self._links = np.zeros(0, np.int64)
        self.groups: list[str] = []

    def of(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the units of all texts (a blank before each), and where each text's begin (n + 1).

        Empty texts have no units. Numbers hold until ``generation`` changes, at the next call at the earliest.
        """
        if len(self._links) > REMEMBERED:
            self._forget()
        data, at = buffers(texts)
        sizes = np.diff(at)
        full = sizes > 0
        blank = at[:-1][full]
        data, at = np.insert(data, blank, 0x20), at + np.concatenate([[0], np.cumsum(full)])
        if not len(data):
            return np.zeros(0, np.int64), np.zeros(len(texts) + 1, np.int64)
        white = _SPACE[data]
        starts = white.copy()
        starts[1:] &= ~white[:-1]
        heads = at[:-1][full]
        for k in np.unique(np.searchsorted(at, _odd_places(data), "right") - 1).tolist():
            starts[at[k] : at[k + 1]] = False
        starts[heads] = True
        begin = np.flatnonzero(starts)
        end = np.append(begin[1:], len(data))
        hashes = hash_words(data, begin, end, lower=False)
        values, one = np.unique(hashes, return_index=True)
        place = np.searchsorted(self._hash, values)
        new = np.ones(len(values), bool)
        inside = place < len(self._hash)
        new[inside] = self._hash[place[inside]] != values[inside]
        if new.any():
            view = memoryview(data)
            self._learn(values[new], [bytes(view[a:b]) for a, b in zip(begin[one[new]].tolist(), end[one[new]].tolist())])
        return self._place[np.searchsorted(self._hash, hashes)], np.searchsorted(begin, at)

    def _encode_a(self, units: list[str], sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of units one after the other, and how many each has.

        Units go to the library as longer texts, since none of its tokens runs from other characters
        into the white space of the next unit; units that end in white space go by themselves.
        """
        texts, part, size = [], [], 0
        for u in units:
            if u[-1].isspace():
                texts += ["".join(part), u]
                part, size = [], 0
                continue
            part.append(u)
            size += len(u)
            if size > CODED_TOGETHER:
                texts.append("".join(part))
                part, size = [], 0
        texts.append("".join(part))
        ids = np.fromiter(chain.from_iterable(e.ids for e in self._a.encode_batch(texts, add_special_tokens=False)), np.int64)
        ends, wanted = np.cumsum(self.vocabulary_a.size[ids]), np.cumsum(sizes)
        upto = np.searchsorted(ends, wanted, "right")
        if (ends[upto - 1] == wanted).all() and len(ends) == upto[-1]:
            return ids, np.diff(upto, prepend=0)
        each = [e.ids for e in self._a.encode_batch(units, add_special_tokens=False)]  # tokens that are not the bytes
        return np.fromiter(chain.from_iterable(each), np.int64), np.fromiter(map(len, each), np.int64)

    def _encode_b(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        # the library puts a blank before all but empty texts; it is a piece of its own before a tab or line feed
        each = self._b.encode([u[1:] if u[0] == " " else u for u in units], num_threads=1)
        each = [self._blank if u == " " else ids if u[0] == " " else ids[1:] for u, ids in zip(units, each)]
        return np.fromiter(chain.from_iterable(each), np.int64), np.fromiter(map(len, each), np.int64)

    def _learn(self, hashes: np.ndarray, raw: list[bytes]) -> None:
        units = [r.decode() for r in raw]
        flat_a, n_a = self._encode_a(units, np.fromiter(map(len, raw), np.int64, len(raw)))
        flat_b, n_b = self._encode_b(units)
        fine = self.vocabulary_a.gives(flat_a, n_a, raw) & self.vocabulary_b.gives(flat_b, n_b, raw)
        flat_a, flat_b = flat_a[np.repeat(fine, n_a)], flat_b[np.repeat(fine, n_b)]
        n_a, n_b = n_a * fine, n_b * fine
        # all units as one text, in which each unit's last byte is an end of both
        cut_a, cut_b, link_a, link_b = align(np.cumsum(self.vocabulary_a.size[flat_a]), np.cumsum(self.vocabulary_b.size[flat_b]))
        to_a = np.cumsum(n_a)
        n_groups = np.diff(np.searchsorted(cut_a, np.concatenate([[0], to_a]), "right"))
        n_links = np.diff(np.searchsorted(link_a, np.concatenate([[0], to_a])))
        if self._with_groups:
            words_a, words_b = list(map(str, flat_a.tolist())), list(map(str, flat_b.tolist()))
            groups, i, j = [], 0, 0
            for to_i, to_j in zip(cut_a.tolist(), cut_b.tolist()):
                if to_i == i + 1 and to_j == j + 1:
                    groups.append(f"{words_a[i]}|{words_b[j]}")
                else:
                    groups.append(f"{','.join(words_a[i:to_i])}|{','.join(words_b[j:to_j])}")
                i, j = to_i, to_j
            ends = np.cumsum(n_groups)
            self.groups += [";".join(groups[e - n : e]) for e, n in zip(ends.tolist(), n_groups.tolist())]
        self._from = np.concatenate([self._from, len(self._links) + np.cumsum(n_links) - n_links])
        self._links = np.concatenate([self._links, pack(flat_a[link_a], flat_b[link_b])])
        order = np.argsort(np.concatenate([self._hash, hashes]), kind="stable")
        self._place = np.concatenate([self._place, len(self.fine) + np.arange(len(hashes))])[order]
        self._hash = np.concatenate([self._hash, hashes])[order]
        self.fine = np.concatenate([self.fine, fine])
        self.counts = np.concatenate([self.counts, np.stack([n_a, n_b, n_groups, n_links], 1)])

    def links(self, which: np.ndarray) -> np.ndarray:
        """The packed pairs of the units, one unit after the other."""
        return self._links[spans(self._from[which], self.counts[which, 3])]


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of the values of each text."""
    total = np.concatenate([np.zeros((1, *values.shape[1:]), np.int64), np.cumsum(values, axis=0)])
    return total[first[1:]] - total[first[:-1]]


@cache
def _units(path_a: str, path_b: str, with_groups: bool = True) -> Units:
    return Units(path_a, path_b, with_groups)


def _weighted(pairs: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    values, inverse = np.unique(pairs, return_inverse=True)
    return values, np.bincount(inverse, n, len(values)).astype(np.int64)


def _count(path_a: str, path_b: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A batch's links summed by pair."""
        units = _units(path_a, path_b, False)
        for batch in batches:
            pairs, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
            for begin, size in steps(batch.column(0)):
                which, first = units.of(batch.column(0).slice(begin, size))
                bad = _sums((~units.fine[which]).astype(np.int64), first) > 0
                which = which[~np.repeat(bad, np.diff(first))]
                used, n = np.unique(which, return_counts=True)
                more = _weighted(units.links(used), np.repeat(n, units.counts[used, 3]))
                pairs, counts = _weighted(np.concatenate([pairs, more[0]]), np.concatenate([counts, more[1]]))
            yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(counts)], ["pair", "n"])

    return run


class Scores:
    """Of each unit the links whose pair is their b id's most frequent, and the sum of its links' counts."""

    def __init__(self, units: Units, pairs: np.ndarray, n: np.ndarray, best: np.ndarray):
        self._units, self._pairs, self._n, self._best = units, pairs, n, best
        self._generation, self._known = -1, np.zeros((0, 2), np.int64)

    def of(self, which: np.ndarray) -> np.ndarray:
        units = self._units
        if self._generation != units.generation:
            self._generation, self._known = units.generation, np.zeros((0, 2), np.int64)
        new = np.arange(len(self._known), len(units.fine))
        if len(new):
            links = units.links(new)
            at = np.minimum(np.searchsorted(self._pairs, links), max(len(self._pairs) - 1, 0))
            # units of left-out texts may have pairs that no other text has
            there = self._pairs[at] == links if len(self._pairs) else np.zeros(len(links), bool)
            value = np.zeros((len(links), 2), np.int64)
            value[there] = np.stack([self._best[at[there]], self._n[at[there]]], 1)
            first = np.concatenate([[0], np.cumsum(units.counts[new, 3])])
            self._known = np.concatenate([self._known, _sums(value, first)])
        return self._known[which]


ALIGNED = "id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string, pairs binary, counts binary"


def _describe(path_a: str, path_b: str, sent):
    """Rows for documents: sums over their units, and without sent counts their distinct pairs."""
    made: list[Scores] = []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = _units(path_a, path_b)
        if sent is not None and not made:
            made.append(Scores(units, *sent.value))
        for batch in batches:
            for begin, size in steps(batch.column(1)):
                part = batch.slice(begin, size)
                which, first = units.of(part.column(1))
                bad = _sums((~units.fine[which]).astype(np.int64), first) > 0
                sums = _sums(units.counts[which], first)
                score = _sums(made[0].of(which), first) if made else np.zeros((size, 2), np.int64)
                sums[bad], score[bad] = 0, 0
                digests, pairs, counts = [], [], []
                for k, (a, b) in enumerate(zip(first[:-1].tolist(), first[1:].tolist())):
                    own = which[a:b] if not bad[k] else which[:0]
                    digests.append(hashlib.sha256(";".join(map(units.groups.__getitem__, own.tolist())).encode()).hexdigest() if len(own) else "")
                    if not made:
                        p, n = np.unique(units.links(own), return_counts=True)
                        pairs.append(p.tobytes())
                        counts.append(n.tobytes())
                columns = [pa.array(np.ascontiguousarray(c)) for c in (*sums.T, *score.T)]
                kept = [pa.array(x if x else [None] * size, pa.binary()) for x in (pairs, counts)]
                yield pa.RecordBatch.from_arrays([part.column(0), *columns, pa.array(digests, pa.string()), *kept], [c.split(" ")[0] for c in ALIGNED.split(", ")])

    return run


def _spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each distinct pair of a document, a document at a time."""
    for batch in batches:
        for row, p, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            p = np.frombuffer(p, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(p), row, np.int64)), pa.array(p), pa.array(np.frombuffer(n, np.int64))], ["row", "pair", "times"])


def pair_counts(docs: DataFrame, text_col: str = "text", path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """(pair, n, best): how many links of all documents hold a pair of ids (a * 2^32 + b), and whether that is the most of its b."""
    path_a, path_b = path_a or public_tokenizers.path(BYTE_BPE), path_b or public_tokenizers.path(PIECES)
    counted = docs.select(filled(text_col).alias("text")).mapInArrow(_count(path_a, path_b), "pair bigint, n bigint")
    pairs = cut_lineage(counted.groupBy("pair").agg(F.sum("n").alias("n")).withColumn("b", F.col("pair").bitwiseAND(F.lit((1 << 32) - 1))))
    return cut_lineage(pairs.join(pairs.groupBy("b").agg(F.max("n").alias("most")), "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best")))


def align_tokens(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_a: str | None = None, path_b: str | None = None,
    sent_pairs: int = SENT_PAIRS,
) -> DataFrame:
    """One row per row of ``docs``: id_col, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    Both tokenizers code a blank and the text, without special tokens. Places where tokens of
    both end cut them into groups; tokens whose bytes overlap are linked. n_best counts links
    whose pair of ids is linked most often over all rows among those of their b id (ties count);
    count_sum adds up how often each link's pair is linked. Texts that are null, empty, or not
    given back byte by byte by both have no tokens: zeros and an empty groups_sha256. Repeated
    rows each count and each get a row; null ids stay null; an empty table gives no rows. Other
    columns are not read. With more than ``sent_pairs`` distinct pairs the counts are joined.
    """
    path_a, path_b = path_a or public_tokenizers.path(BYTE_BPE), path_b or public_tokenizers.path(PIECES)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), filled(text_col).alias("text"))
    counts = pair_counts(rows, "text", path_a, path_b)
    names = ["id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    if counts.count() <= sent_pairs:
        known = counts.sort("pair").toArrow()
        sent = docs.sparkSession.sparkContext.broadcast(tuple(known.column(c).to_numpy() for c in ("pair", "n", "best")))
        return rows.mapInArrow(_describe(path_a, path_b, sent), ALIGNED).select(*names).withColumnRenamed("id", id_col)
    coded = cut_lineage(rows.mapInArrow(_describe(path_a, path_b, None), ALIGNED).withColumn("row", F.monotonically_increasing_id()))
    spread = coded.select("row", "pairs", "counts").mapInArrow(_spread, "row bigint, pair bigint, times bigint")
    summed = spread.join(counts, "pair").groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum")
    )
    joined = coded.drop("n_best", "count_sum").join(summed, "row", "left")
    return joined.fillna(0, ["n_best", "count_sum"]).select(*names).withColumnRenamed("id", id_col)


@register("op11_token_alignment")
def op11_token_alignment(spark, d):
    return align_tokens(table(spark, d, "documents"))
