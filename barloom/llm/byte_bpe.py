"""Byte-level BPE by a tree of halves.

A text is cut in halves down to leaves of at most ``LEAF_CHARS`` characters. Leaves are split by
the pattern; neighbours are joined by splitting again a window round the seam that grows until
its edges are matches that no further text can change. Each match is then merged on its own
(``bpe.Merges``, again by halves). Decoding turns runs of ids into bytes and joins them up the
tree. Texts are split one at a time and never leave their task; nothing is shuffled.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.bpe import Merges, spans
from barloom.llm.common import filled, register, table
from barloom.llm.textnum import steps

LEAF_CHARS = 8192
#: Ids decoded at a time, the leaves of the decoding tree.
LEAF_IDS = 65536
#: Pieces whose ids a worker remembers; then it starts anew.
REMEMBERED = 600_000
RANKS = "byte_bpe_50k.tiktoken"


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def rank_merges(ranks: dict[bytes, int]) -> Merges:
    """All pairs of tokens whose bytes together are a token; its rank is the pair's rank."""
    left, right, made = [], [], []
    for token, rank in ranks.items():
        for k in range(1, len(token)):
            a, b = ranks.get(token[:k]), ranks.get(token[k:])
            if a is not None and b is not None:
                left.append(a)
                right.append(b)
                made.append(rank)
    return Merges(left, right, made, made, {r: tuple(ranks[t[k : k + 1]] for k in range(len(t))) for t, r in ranks.items()})


class ByteBpe:
    """Encoder and decoder for one file of ranks that has all 256 single bytes."""

    def __init__(self, path: str, pattern: str = public_tokenizers.PATTERN):
        ranks = read_ranks(path)
        self._split = regex.compile(pattern).findall
        self._merges = rank_merges(ranks)
        self._of_byte = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        tokens = {r: t for t, r in ranks.items()}
        size = np.zeros(max(tokens) + 1, np.int64)
        for r, t in tokens.items():
            size[r] = len(t)
        self._size, self._start = size, np.cumsum(size) - size
        self._bytes = np.frombuffer(b"".join(tokens.get(r, b"") for r in range(len(size))), np.uint8)
        self._forget()

    def _forget(self) -> None:
        self._known: dict[str, int] = {}
        self._decimal: list[str] = []
        self._ids, self._from, self._count = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def pieces(self, text: str) -> list[str]:
        """The pattern's matches in the whole text, by halves."""
        if len(text) <= LEAF_CHARS:
            return self._split(text)
        half = len(text) // 2
        return self._join(self.pieces(text[:half]), self.pieces(text[half:]))

    def _join(self, left: list[str], right: list[str]) -> list[str]:
        """Matches of two neighbouring texts put together.

        A match ends where it does because of at most two characters after it, or, in a run of
        white space, of the first character after the run. So a place between matches is settled
        if two characters and one that is not white space follow it. From a place that is
        settled and also lies between matches of the right side, both go on alike.
        """
        a, tail = len(left), ""
        while a and not _settled(tail, 0):
            a -= 1
            tail = left[a] + tail
        b, reach, head = 0, 4, ""
        while True:
            take = right[b : b + reach]
            head += "".join(take)
            b, reach = b + len(take), reach * 2
            window = tail + head
            again = self._split(window)
            if b == len(right):
                return left[:a] + again
            seams, at = {}, len(tail)
            for k, piece in enumerate(right[:b]):
                at += len(piece)
                seams[at] = k + 1
            at = 0
            for k, piece in enumerate(again):
                at += len(piece)
                if at in seams and _settled(window, at):
                    return left[:a] + again[: k + 1] + right[seams[at] :]

    def encode(self, texts: list[str]) -> Iterator[tuple[np.ndarray, str]]:
        """For each whole text its ids, and the same in decimal, joined by blanks."""
        split = [self.pieces(t) for t in texts]
        if len(self._known) > REMEMBERED:
            self._forget()
        self._learn(list(set().union(*split) - self._known.keys()))
        for pieces in split:
            which = list(map(self._known.__getitem__, pieces))
            ids = self._ids[spans(self._from[which], self._count[which])] if which else self._ids[:0]
            yield ids, " ".join(map(self._decimal.__getitem__, which))

    def _learn(self, new: list[str]) -> None:
        """Encode pieces not met before, all at once."""
        raw = [p.encode() for p in new]
        symbols = self._of_byte[np.frombuffer(b"".join(raw), np.uint8)]
        ids, counts = self._merges.encode(symbols, np.fromiter(map(len, raw), np.int64, len(raw)))
        ends = np.cumsum(counts)
        self._known.update(zip(new, range(len(self._known), len(self._known) + len(new))))
        numbers = list(map(str, ids.tolist()))
        self._decimal += [" ".join(numbers[e - c : e]) for e, c in zip(ends.tolist(), counts.tolist())]
        self._from = np.concatenate([self._from, len(self._ids) + ends - counts])
        self._count = np.concatenate([self._count, counts])
        self._ids = np.concatenate([self._ids, ids])

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of the ids, halves joined up the tree."""
        if len(ids) > LEAF_IDS:
            half = len(ids) // 2
            return self.decode(ids[:half]) + self.decode(ids[half:])
        return self._bytes[spans(self._start[ids], self._size[ids])].tobytes()


def _settled(text: str, at: int) -> bool:
    return at + 2 <= len(text) and not text[at:].isspace()


@cache
def _codec(path: str) -> ByteBpe:
    return ByteBpe(path)


CODED = "id bigint, n_tokens bigint, ids binary, ids_sha256 string, decoded_sha256 string"


def _code(path: str, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(path)
        for batch in batches:
            for first, count in steps(batch.column(1)):
                part = batch.slice(first, count)
                n, kept, digest, back = [], [], [], []
                for ids, decimal in codec.encode(part.column(1).to_pylist()):
                    n.append(len(ids))
                    kept.append(ids.astype("<u4").tobytes() if with_ids else None)
                    digest.append(hashlib.sha256(decimal.encode()).hexdigest())
                    back.append(hashlib.sha256(codec.decode(ids)).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(n, pa.int64()), pa.array(kept, pa.binary()), pa.array(digest, pa.string()), pa.array(back, pa.string())],
                    ["id", "n_tokens", "ids", "ids_sha256", "decoded_sha256"],
                )

    return run


def encode(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, with_ids: bool = True
) -> DataFrame:
    """One row per row of ``docs``: id_col, n_tokens, ids (little-endian 32-bit, if with_ids), ids_sha256, decoded_sha256.

    The ids are those of the rank file at ``path`` for each match of the pattern, without special
    tokens; they are decoded again for decoded_sha256. Null and empty texts have no ids; null ids
    of documents stay null; repeated rows each get a row; an empty table gives none. Other columns
    are not read. Workers read the rank file at the same path.
    """
    path = path or public_tokenizers.path(RANKS)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), filled(text_col).alias("text"))
    coded = rows.mapInArrow(_code(path, with_ids), CODED).withColumnRenamed("id", id_col)
    return coded if with_ids else coded.drop("ids")


def decode(coded: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", path: str | None = None) -> DataFrame:
    """id_col and bytes (binary) for rows with little-endian 32-bit ids; null ids have no bytes."""
    path = path or public_tokenizers.path(RANKS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(path)
        for batch in batches:
            raw = [codec.decode(np.frombuffer(x or b"", "<u4").astype(np.int64)) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(raw, pa.binary())], ["id", "bytes"])

    rows = coded.select(F.col(id_col).cast("long").alias("id"), F.col(ids_col).alias("ids"))
    return rows.mapInArrow(run, "id bigint, bytes binary").withColumnRenamed("id", id_col)


@register("op2_byte_bpe")
def op2_byte_bpe(spark, d):
    return encode(table(spark, d, "documents"), with_ids=False)
