"""Quality classifier by importance resampling.

Two generative models of hashed n-grams, one of target documents and one of all raw text, give
each document a log importance weight: the difference of its log likelihoods.
Adding Gumbel noise and keeping the k highest samples k documents without replacement in
proportion to their weights; k is the number of documents whose own weight is at least
``LEAST_LOG_WEIGHT``. Words of the target are common in both models; shouting, tables, symbol
noise and stuck words are rare in the target, so such documents lie far below zero.

Features: bytes in threes, words, and pairs of words (a word after itself is one pair whatever
the word), each family hashed into 2^16 buckets. Counting is one pass over whole texts with
arrays per task; the target is found by at most ``MOST_LABELS`` labelled documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import cut_lineage, filled, register, table
from barloom.llm.textnum import U64, buffers, chain, hash_words, mix, steps, word_bounds

BUCKETS = 1 << 16
FAMILIES = 3
#: Most labelled documents that the first model is fitted on (those of lowest hashed id).
MOST_LABELS = 20_000
LEAST_LOG_WEIGHT = -10.0
#: Strength of the target model's prior, which is the raw model, in n-grams per bucket.
PRIOR = 5.0
_REPEAT = U64(0x5A3E) << U64(48)
#: Bytes whose threes are looked at together.
_BLOCK = 1_000_000


def features(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(buckets, text numbers) of all n-grams of the texts, family by family and block by block."""
    data, at = buffers(texts)
    if not len(data):
        return
    begin, end, first = word_bounds(data, at)
    w = hash_words(data, begin, end, lower=False)
    doc = np.repeat(np.arange(len(texts)), np.diff(first))
    yield (w >> U64(48)).astype(np.int64), doc
    if len(w) > 1:
        pair = chain(w[:-1], w[1:])
        pair[w[:-1] == w[1:]] = _REPEAT
        own = doc[1:] == doc[:-1]
        yield (pair[own] >> U64(48)).astype(np.int64) + BUCKETS, doc[1:][own]
    of_byte = np.repeat(np.arange(len(texts)), np.diff(at))
    for k in range(0, len(data) - 2, _BLOCK):
        stop = min(k + _BLOCK, len(data) - 2)
        x = data[k : stop + 2].astype(U64)
        three = mix(x[:-2] | (x[1:-1] << U64(8)) | (x[2:] << U64(16))) >> U64(48)
        own = of_byte[k:stop] == of_byte[k + 2 : stop + 2]
        yield three[own].astype(np.int64) + 2 * BUCKETS, of_byte[k:stop][own]


def _counts(first: np.ndarray | None):
    """Task-wise n-gram counts over all texts (raw) and over the target's.

    Without ``first`` the second column says which texts are target; with it, those whose log
    weight by ``first`` is at least LEAST_LOG_WEIGHT are.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw = np.zeros(FAMILIES * BUCKETS, np.int64)
        target = np.zeros(FAMILIES * BUCKETS, np.int64)
        for batch in batches:
            for begin, count in steps(batch.column(0)):
                grams = list(features(batch.column(0).slice(begin, count)))
                if first is None:
                    chosen = batch.column(1).slice(begin, count).to_numpy(zero_copy_only=False).astype(bool)
                else:
                    chosen = sum((np.bincount(doc, first[bucket], minlength=count) for bucket, doc in grams), np.zeros(count)) >= LEAST_LOG_WEIGHT
                for bucket, doc in grams:
                    raw += np.bincount(bucket, minlength=len(raw))
                    target += np.bincount(bucket[chosen[doc]], minlength=len(raw))
        some = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(raw[some]), pa.array(target[some])], ["bucket", "raw", "target"])

    return run


def _model(texts: DataFrame, first: np.ndarray | None = None) -> np.ndarray:
    """Log of each bucket's share in the target over its share in all of ``texts`` (text, target)."""
    counts = (
        texts.mapInArrow(_counts(first), "bucket int, raw bigint, target bigint")
        .groupBy("bucket")
        .agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
        .toArrow()  # at most FAMILIES * BUCKETS rows
    )
    raw = np.zeros(FAMILIES * BUCKETS)
    target = np.zeros(FAMILIES * BUCKETS)
    bucket = counts.column("bucket").to_numpy()
    raw[bucket], target[bucket] = counts.column("raw").to_numpy(), counts.column("target").to_numpy()
    weights = np.zeros(FAMILIES * BUCKETS)
    for k in range(FAMILIES):
        own = slice(k * BUCKETS, (k + 1) * BUCKETS)
        if target[own].sum():
            as_raw = raw[own] * (target[own].sum() / raw[own].sum())
            weights[own] = np.log((target[own] + PRIOR) / (as_raw + PRIOR))
    return weights


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", good_col: str = "quality") -> np.ndarray:
    """Log weight of each bucket: log of its share in the target over its share in all raw text.

    The target is found in two steps, so that its languages and subjects have the corpus's shares
    and not those of the labels: first good labelled documents against all labelled ones, then
    every document of the corpus that this first model takes for good. Labels that are null, or of
    documents not in ``docs``, count for nothing; contradictory labels of a document count as
    good. Without labels of both kinds all weights are 0.
    """
    chosen = (
        labels.filter(F.col(good_col).isNotNull() & F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).cast("long").alias("id"))
        .agg(F.max(F.col(good_col) == 1).alias("target"))
        .orderBy(F.xxhash64("id"), "id")
        .limit(MOST_LABELS)  # the documented bound of the fitting sample
    )
    texts = docs.select(F.col(id_col).cast("long").alias("id"), filled(text_col).alias("text"))
    first = _model(texts.join(F.broadcast(chosen), "id").select("text", "target"))
    return _model(texts.select("text", F.lit(False).alias("target")), first)


def log_weights(docs: DataFrame, weights: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, log_weight) of each row; a text without n-grams has 0."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)  # FAMILIES * BUCKETS doubles, 1.6 MB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        for batch in batches:
            for first, count in steps(batch.column(1)):
                part = batch.slice(first, count)
                total = np.zeros(count)
                for bucket, doc in features(part.column(1)):
                    total += np.bincount(doc, w[bucket], minlength=count)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(total)], ["id", "log_weight"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), filled(text_col).alias("text"))
    return rows.mapInArrow(run, "id bigint, log_weight double")


def gumbel(id_col: str):
    """Standard Gumbel noise that depends on the id only, so that a repeated task draws it again."""
    u = (F.pmod(F.xxhash64(F.lit("gumbel"), F.col(id_col)), F.lit((1 << 52) - 1)) + F.lit(0.5)) / F.lit(float((1 << 52) - 1))
    return -F.log(-F.log(u))


#: Cells that a round of the search for the k-th highest key looks at.
_CELLS = 4096


def kth_highest(rows: DataFrame, column: str, k: int) -> float | None:
    """The k-th highest value of a column of finite doubles (None if k < 1 or there are none).

    Rounds of counting by equal cells of the range that holds it; each brings at most _CELLS
    numbers to the driver, until the range has one value.
    """
    if k < 1:
        return None
    low, high = rows.agg(F.min(column), F.max(column)).first()
    if low is None:
        return None
    left = k
    while low < high:
        step = (high - low) / _CELLS
        inside = rows.filter((F.col(column) >= low) & (F.col(column) <= high))
        cell = F.least(F.floor((F.col(column) - F.lit(low)) / F.lit(step)), F.lit(_CELLS - 1)) if step > 0 else F.lit(0)
        found = inside.groupBy(cell.alias("cell")).agg(F.count(F.lit(1)).alias("n"), F.min(column).alias("low"), F.max(column).alias("high"))
        for r in sorted(found.collect(), key=lambda r: -r["cell"]):
            if left <= r["n"]:
                if (low, high) == (r["low"], r["high"]):  # neighbouring doubles that one cell holds
                    values = inside.groupBy(column).count().orderBy(F.desc(column)).collect() if step <= 0 else []
                    for v in values:
                        if left <= v["count"]:
                            return v[column]
                        left -= v["count"]
                low, high = r["low"], r["high"]
                break
            left -= r["n"]
        else:
            return low
    return low


def quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", good_col: str = "quality") -> DataFrame:
    """One row per row of ``docs``: id_col, log_weight, noisy_weight, kept.

    kept: among the k highest log_weight + Gumbel noise, ties all kept, where k counts the rows
    with log_weight >= LEAST_LOG_WEIGHT. Null and empty texts have weight 0; null ids take part
    and share one draw of noise; repeated rows are decided alike; an empty table gives no rows;
    without labels all weights are 0 and all rows are kept. Other columns are not read.
    """
    weights = fit(docs, labels, id_col, text_col, good_col)
    rows = cut_lineage(
        log_weights(docs, weights, id_col, text_col).withColumn("noisy_weight", F.col("log_weight") + gumbel("id"))
    )
    k = rows.filter(F.col("log_weight") >= LEAST_LOG_WEIGHT).count()
    least = kth_highest(rows, "noisy_weight", k)
    kept = F.col("noisy_weight") >= F.lit(least) if least is not None else F.lit(False)
    return rows.select(F.col("id").alias(id_col), "log_weight", "noisy_weight", kept.alias("kept"))


def drop_low_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", good_col: str = "quality") -> DataFrame:
    """The rows of ``docs`` that ``quality`` keeps, all columns. Rows of one id with several texts stay if one of them is kept."""
    judged = quality(docs, labels, id_col, text_col, good_col)
    gone = judged.groupBy(F.col(id_col).alias("__id")).agg(F.max("kept").alias("__kept")).filter(~F.col("__kept")).select("__id")
    return docs.join(gone, F.col(id_col).cast("long").eqNullSafe(F.col("__id")), "left_anti")


@register("op5_quality")
def op5_quality(spark, d):
    return quality(table(spark, d, "documents"), table(spark, d, "labels"))
