"""Packing along a space-filling curve.

A document's words, hashed and projected by fixed random signs, give a mean vector of ``DIMS``
numbers; its place on a Hilbert curve through that space is its key. Spark range-sorts whole
texts by key (ties by document, so a third of all rows with one text still spread evenly), and
each partition walks its stretch of the curve, tokenizes, and fills sequences of ``SIZE`` ids one
after the other, cutting a document where a sequence is full. Only the last sequence of a
partition is short; partitions are made for ``PART_BYTES`` of text, which bounds padding to one
part in some hundreds whatever the size of the corpus.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import filled, register, table, text_bytes
from barloom.llm.textnum import U64, mix, steps, words
from barloom.llm.word_tokens import tokenizer

VOCABULARY = "word_bpe_49k.json"
END = 2
SIZE = 4096
PART_BYTES = 8_000_000
DIMS, DEPTH = 4, 12


def hilbert_key(cells: np.ndarray, depth: int = DEPTH) -> np.ndarray:
    """Place on the Hilbert curve of points with whole coordinates below 2 ** depth, one row each.

    From the highest bit down, each coordinate's bit flips or swaps the lower bits of the others
    as the curve's turns demand; the Gray code of what remains, bits interleaved, is the place.
    """
    x = cells.astype(np.int64).copy()
    dims = x.shape[1]
    for bit in range(depth - 1, 0, -1):
        low = (1 << bit) - 1
        for d in range(dims):
            set_ = (x[:, d] >> bit) & 1 == 1
            x[set_, 0] ^= low
            swap = np.where(set_, 0, (x[:, 0] ^ x[:, d]) & low)
            x[:, 0] ^= swap
            x[:, d] ^= swap
    for d in range(1, dims):
        x[:, d] ^= x[:, d - 1]
    turn = np.zeros(len(x), np.int64)
    for bit in range(depth - 1, 0, -1):
        turn ^= np.where((x[:, dims - 1] >> bit) & 1 == 1, (1 << bit) - 1, 0)
    x ^= turn[:, None]
    key = np.zeros(len(x), np.int64)
    for bit in range(depth - 1, -1, -1):
        for d in range(dims):
            key = (key << 1) | ((x[:, d] >> bit) & 1)
    return key


def curve_keys(texts: pa.Array) -> np.ndarray:
    """The Hilbert key of each text; texts without words lie in the middle cell."""
    out = []
    for first, count in steps(texts):
        w, at = words(texts.slice(first, count))
        n = np.diff(at)
        cells = np.empty((count, DIMS), np.int64)
        signs = mix(w)
        for d in range(DIMS):
            total = np.concatenate([[0], np.cumsum(((signs >> U64(d)) & U64(1)).astype(np.int64) * 2 - 1)])
            mean = (total[at[1:]] - total[at[:-1]]) / np.maximum(n, 1)
            cells[:, d] = np.clip((mean * 2 + 0.5) * (1 << DEPTH), 0, (1 << DEPTH) - 1)
        out.append(hilbert_key(cells))
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(curve_keys(b.column(1)))], ["id", "text", "curve"])


PIECES = (
    "id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint, curve bigint, ids binary"
)


def _pack(path: str, size: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words_to_ids = tokenizer(path)
        base, held = TaskContext.get().partitionId() << 32, 0  # ids already put into sequences of this partition
        for batch in batches:
            for first, count in steps(batch.column(1)):
                part = batch.slice(first, count)
                ids, at = words_to_ids.encode(part.column(1), END)
                # pieces end where a document or a sequence does
                full = np.arange(size - held % size, at[-1], size)
                cuts = np.union1d(at, full)
                begin, stop = cuts[:-1], cuts[1:]
                doc = np.searchsorted(at, begin, "right") - 1
                where = held + begin
                raw = memoryview(ids.astype("<u4").tobytes())
                piece = [raw[4 * a : 4 * b] for a, b in zip(begin.tolist(), stop.tolist())]
                held += int(at[-1])
                take = pa.array(doc)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(take),
                        pa.array(begin - at[doc]),
                        pa.array(stop - begin),
                        pa.array([zlib.crc32(p) for p in piece], pa.int64()),
                        pa.array(np.diff(at)[doc]),
                        pa.array(base + where // size),
                        pa.array(where % size),
                        part.column(2).take(take),
                        pa.array([bytes(p) for p in piece] if with_ids else [None] * len(piece), pa.binary()),
                    ],
                    ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "curve", "ids"],
                )

    return run


def pack(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE, path: str | None = None, with_ids: bool = True
) -> DataFrame:
    """One row per piece: id_col, start, length, ids_crc32, doc_tokens, sequence_id, offset, curve, ids (if with_ids).

    A document is the ids of its whole text and an end id, so a null or empty text is one id.
    Every id of every row lies in exactly one piece; repeated rows are packed as often as they
    come; a null document id stays null. Sequences hold at most ``size`` ids; sequence_id is the
    partition's number times 2^32 plus the sequence's number there. An empty table gives no rows.
    Other columns are not read.
    """
    path = path or public_tokenizers.path(VOCABULARY)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), filled(text_col).alias("text"))
    parts = -(-text_bytes(rows, "text") // PART_BYTES) or 1
    keyed = rows.mapInArrow(_keyed, "id bigint, text string, curve bigint")
    tie = F.xxhash64("id", "text")
    along = keyed.repartitionByRange(parts, "curve", tie).sortWithinPartitions("curve", tie)
    out = along.mapInArrow(_pack(path, size, with_ids), PIECES).withColumnRenamed("id", id_col)
    return out if with_ids else out.drop("ids")


@register("op9_packing")
def op9_packing(spark, d):
    return pack(table(spark, d, "documents"), with_ids=False)
