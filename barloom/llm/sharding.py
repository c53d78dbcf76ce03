"""Sharding by vector bin packing: bytes, tokens and rows balanced jointly.

Groups of equal texts go together. A group is an item with a vector (bytes, tokens, rows); items
are taken largest first, each to the shard where the dot product of its vector with the shard's
residual capacity, both as shares of the total, is highest. So that the driver handles a bounded
number of items whatever the corpus, groups are first dealt by text hash into ``CELLS`` cells,
each one item; only a group that outweighs its cell's fair share is an item of its own, and at
most ``CELLS`` * 3 groups can. A group is split, into parts by document, only when its bytes,
tokens or rows exceed ``WHOLE`` of a shard's fair share (total / shards), whatever the table's size.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from barloom.llm.common import cut_lineage, filled, register, table

SHARDS = 24
#: Cells of small groups; with 24 shards some 170 a shard.
CELLS = 4096
#: The part of a shard's fair share up to which a group of equal texts stays whole.
WHOLE = 1.0
#: Rows in a block; a shard's share of a block is sorted at once.
SLOT_ROWS = 4_000


def assign(items: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each item (rows of bytes, tokens, rows), largest first by residual dot product.

    A dimension that is zero in total counts for nothing; among equal products the lower shard.
    """
    total = items.sum(axis=0).astype(float)
    share = items / np.where(total > 0, total, 1)
    residual = np.tile((total > 0) / shards, (shards, 1))
    out = np.zeros(len(items), np.int64)
    for i in np.lexsort((np.arange(len(items)), -share.sum(axis=1))):
        out[i] = int(np.argmax(residual @ share[i]))
        residual[out[i]] -= share[i]
    return out


def _vector(size: Column, tokens: Column) -> list[Column]:
    return [F.sum(size).alias("bytes"), F.sum(tokens).alias("tokens"), F.count(F.lit(1)).alias("rows")]


def shard(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id_col, size, text_crc32, law, shard, slot, grown_shard, tokens.

    The law is 'bytes': sums of size (UTF-8 bytes of the text plus 8) are near equal over shards,
    and tokens (words between white space) and rows too as far as texts allow. slot counts from 0
    without gaps within a shard. Null and empty texts have size 8 and are one group. Null ids and
    repeated rows are rows like any other. grown_shard is null under this law. With fewer documents
    than shards some shards stay empty; an empty table gives no rows. Other columns are not read.
    """
    text = filled(text_col)
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"),
        (F.octet_length(text).cast("long") + 8).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("group"),
        F.regexp_count(text, F.lit(r"[^ \t\n\x0B\f\r]+")).cast("long").alias("tokens"),
    )
    rows = cut_lineage(rows.withColumn("cell", F.pmod(F.col("group"), F.lit(CELLS)).cast("int")))

    groups = cut_lineage(rows.groupBy("group", "cell").agg(*_vector(F.col("size"), F.col("tokens"))))
    totals = groups.agg(F.sum("bytes").alias("bytes"), F.sum("tokens").alias("tokens"), F.sum("rows").alias("rows")).first()
    if not totals["rows"]:
        return _out(rows.withColumn("shard", F.lit(0)).withColumn("slot", F.lit(0).cast("long")), id_col)
    fair = {c: max(totals[c] / CELLS, 1.0) for c in ("bytes", "tokens", "rows")}
    large = F.greatest(*[F.col(c) / F.lit(fair[c]) for c in fair])
    parts = F.least(F.floor(large), F.col("rows")).cast("int")
    fits = F.greatest(*[F.col(c) * F.lit(float(shards)) / F.lit(float(max(totals[c], 1))) for c in fair]) <= WHOLE
    heavy = groups.withColumn("parts", parts).filter("parts > 1").select("group", F.when(fits, 1).otherwise(F.col("parts")).alias("parts"))  # at most 3 * CELLS / 2 groups
    # every row's item: a heavy group or a part of one, or else the cell (part -1)
    dealt = cut_lineage(
        rows.join(F.broadcast(heavy), "group", "left").select(
            "id", "size", "text_crc32", "tokens", "group",
            F.when(F.col("parts").isNull(), F.col("cell")).otherwise(F.col("group")).alias("item"),
            F.when(F.col("parts").isNull(), F.lit(-1)).otherwise(F.pmod(F.xxhash64("id", F.lit(7)), F.col("parts"))).cast("int").alias("part"),
        )
    )
    items = dealt.groupBy("item", "part").agg(*_vector(F.col("size"), F.col("tokens"))).orderBy("item", "part").toArrow()  # at most 4 * CELLS rows
    vectors = np.column_stack([items.column(c).to_numpy() for c in ("bytes", "tokens", "rows")]).astype(float)
    placed = items.select(["item", "part"]).append_column("shard", pa.array(assign(vectors, shards), pa.int32()))
    sharded = dealt.join(F.broadcast(docs.sparkSession.createDataFrame(placed)), ["item", "part"])
    return _out(_slots(sharded.drop("item", "part"), totals["rows"]), id_col)


def _slots(rows: DataFrame, count: int) -> DataFrame:
    """Number the rows of each shard from 0: blocks by document hash, a running count over blocks, a sort within one."""
    blocks = max(1, -(-count // SLOT_ROWS))
    tie = F.xxhash64("id", "text_crc32", "group")
    rows = cut_lineage(rows.withColumn("block", F.pmod(tie, F.lit(blocks)).cast("int")))
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        rows.groupBy("shard", "block").agg(F.count(F.lit(1)).alias("n"))
        .select("shard", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    )
    within = Window.partitionBy("shard", "block").orderBy("tie", "id", "text_crc32")
    return (
        rows.withColumn("tie", tie).withColumn("place", F.row_number().over(within)).join(starts, ["shard", "block"])
        .withColumn("slot", F.col("before") + F.col("place") - 1)
    )


def _out(rows: DataFrame, id_col: str) -> DataFrame:
    return rows.select(
        F.col("id").alias(id_col), "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"), "slot",
        F.lit(None).cast("int").alias("grown_shard"), "tokens",
    )


@register("op4_sharding")
def op4_sharding(spark, d):
    return shard(table(spark, d, "documents")).drop("tokens")
