"""Exact dedup: two Bloom passes find the few rows that may be copies; only those shuffle.

Pass one sees 64-bit text hashes only. Each task reduces its own rows to distinct hashes, so a
text that makes up a third of the corpus sends one row per task. Hashes are dealt by value, and
each partition streams through a Bloom filter: a hash that the filter may already hold is
possibly repeated. Pass two folds the possibly repeated hashes into a blocked Bloom filter of
at most ``FILTER_WORDS`` 64-bit words (its size is checked, the bound holds for any input; a
fuller filter only lets more rows through to the exact step). Rows outside it are unique for
certain and pass straight through. The others are grouped by SHA-256.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import cut_lineage, filled, register, table
from barloom.llm.textnum import mix

#: Most 64-bit words in the filter that all tasks get (16 MB).
FILTER_WORDS = 1 << 20
#: Bits per hash in the filters, and bits set for each.
BITS_PER_HASH = 16


def _distinct_in_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each hash of the task's rows once, with whether the task has it twice; bounded by its rows."""
    parts = [b.column(0).to_numpy() for b in batches]
    if parts:
        values, counts = np.unique(np.concatenate(parts), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(values), pa.array(counts > 1)], ["h", "twice"])


def _bloom_repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes that a Bloom filter of the earlier ones may hold, and those repeated in their own batch."""
    filters: list[np.ndarray] = []
    held = room = 0
    for b in batches:
        h = b.column(0).to_numpy().view(np.uint64)
        values, counts = np.unique(h, return_counts=True)
        again = counts > 1
        twice = np.unique(h[b.column(1).to_numpy(zero_copy_only=False)])
        mixed = mix(values)
        for bits in filters:
            again |= _in_filter(bits, mixed)
        again |= np.isin(values, twice)
        if not filters or held + len(values) > room:  # a further filter, twice as large, when this one is full
            room = max(1 << 16, 2 * room, len(values))
            filters.append(np.zeros(room * BITS_PER_HASH // 8, np.uint8))
            held = 0
        _add(filters[-1], mixed)
        held += len(values)
        yield pa.RecordBatch.from_arrays([pa.array(values[again].view(np.int64))], ["h"])


def _places(bits: np.ndarray, mixed: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    n = np.uint64(len(bits) * 8)
    for k in range(5):
        at = mix(mixed + np.uint64(k + 1)) % n
        yield (at >> np.uint64(3)).astype(np.int64), (np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))


def _in_filter(bits: np.ndarray, mixed: np.ndarray) -> np.ndarray:
    found = np.ones(len(mixed), bool)
    for byte, bit in _places(bits, mixed):
        found &= (bits[byte] & bit) != 0
    return found


def _add(bits: np.ndarray, mixed: np.ndarray) -> None:
    for byte, bit in _places(bits, mixed):
        np.bitwise_or.at(bits, byte, bit)


def possibly_repeated(hashes: DataFrame) -> DataFrame:
    """(h) for each hash that occurs twice, and few others; hashes has one column of longs."""
    own = hashes.mapInArrow(_distinct_in_task, "h bigint, twice boolean")
    return own.repartition("h").mapInArrow(_bloom_repeated, "h bigint").distinct()


def _word(h: str, words: int):
    return F.pmod(F.col(h), F.lit(words))


def _mask(h: str):
    """Four of 64 bits, taken from a second hash of the first."""
    spread = F.xxhash64(F.col(h))
    bits = [F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.shiftright(spread, 12 * k), F.lit(64)).cast("int")) for k in range(4)]
    return bits[0].bitwiseOR(bits[1]).bitwiseOR(bits[2]).bitwiseOR(bits[3])


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id_col, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical, null counting as empty. Of equal texts the row with the
    largest id stays. Repeated rows with the same id and text are one document written twice:
    each is counted in group_size, and each is kept if its id is. A null id is smaller than any
    other; in a group of null ids only, keep_id is null and the rows are kept. An empty table
    gives no rows. Other columns are not read.
    """
    rows = cut_lineage(
        docs.select(F.col(id_col).alias("id"), filled(text_col).alias("text")).select(
            "id", F.xxhash64("text").alias("h"), F.unhex(F.sha2("text", 256)).alias("sha")
        )
    )
    repeated = cut_lineage(possibly_repeated(rows.select("h")))
    count = repeated.count()
    words = 1 << max(10, min(FILTER_WORDS.bit_length() - 1, (count * BITS_PER_HASH // 64).bit_length()))
    # at most FILTER_WORDS rows of 16 bytes
    bloom = F.broadcast(repeated.groupBy(_word("h", words).alias("word")).agg(F.bit_or(_mask("h")).alias("bits")))
    marked = rows.withColumn("word", _word("h", words)).join(bloom, "word", "left").select(
        "id", "sha", (F.coalesce("bits", F.lit(0).cast("long")).bitwiseAND(_mask("h")) == _mask("h")).alias("maybe")
    )
    alone = marked.filter(~F.col("maybe")).select("id", "sha", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"))
    maybe = marked.filter("maybe")
    groups = maybe.groupBy("sha").agg(F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    together = maybe.join(groups, "sha").select("id", "sha", "keep_id", "group_size")
    return alone.union(together).select(
        F.col("id").alias(id_col),
        "keep_id",
        "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text no row with a larger id has, all columns.

    Rows with the same id and text stay all; rows with a null id stay if no other row has their text.
    """
    gone = exact_dedup(docs, id_col, text_col).filter("not kept").select(
        F.col(id_col).alias("__id"), F.col("text_sha256").alias("__sha")
    ).distinct()
    keyed = docs.withColumn("__own_sha", F.sha2(filled(text_col), 256))
    return keyed.join(
        gone, F.col(id_col).eqNullSafe(F.col("__id")) & (F.col("__own_sha") == F.col("__sha")), "left_anti"
    ).drop("__own_sha")


@register(
    "op6_exact_dedup",
    """
    with t as (select doc_id, sha256(coalesce(text, '')) text_sha256 from documents),
    g as (select text_sha256, max(doc_id) keep_id, count(*) group_size from t group by text_sha256)
    select doc_id, keep_id, group_size, doc_id = keep_id as kept, text_sha256 from t join g using (text_sha256)
    """,
)
def op6_exact_dedup(spark, d):
    return exact_dedup(table(spark, d, "documents"))
