"""MinHash near-dedup with circulant permutations, bands, and exact Jaccard verification.

Two permutations give all signature coordinates: the first scatters a document's shingles over
``SPACE`` bins, the second, shifted by one place per coordinate, ranks the bins; a coordinate is
the smallest rank. ``BANDS`` bands of ``ROWS`` coordinates miss a pair at similarity 0.8 with a
probability of (1 - 0.8^4)^24, 3 in a million.

Documents with the same shingle set are one class, so copies are never compared. Each band
bucket first links its members to one hub, the class that meets most others over all buckets, so
that a large group of near copies costs about one comparison per member. Classes in buckets that
still hold several components after that go through an exact prefix filter, which leaves no link
out: two sets can only be similar enough if they share one of their few rarest shingles. Pairs
within a component are left aside. Every link is confirmed on the full shingle sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import cut_lineage, register, table
from barloom.llm.components import components
from barloom.llm.textnum import U64, chain, mix, steps, words

WIDTH = 4
BANDS, ROWS = 24, 4
SPACE_BITS = 20
_SEED = 20240229


def _permutations(have: dict = {}) -> tuple[np.ndarray, np.ndarray]:  # noqa: B006
    """The scattering permutation, and all cyclic shifts of the ranking one as a view."""
    if not have:
        draw = np.random.Generator(np.random.PCG64(_SEED))
        n = 1 << SPACE_BITS
        have["scatter"] = draw.permutation(n).astype(np.int32)
        rank = draw.permutation(n).astype(np.uint32)
        have["shifts"] = np.lib.stride_tricks.sliding_window_view(np.concatenate([rank, rank[: BANDS * ROWS]]), BANDS * ROWS)
    return have["scatter"], have["shifts"]


def shingle_sets(texts: pa.Array, width: int = WIDTH) -> Iterator[np.ndarray]:
    """For each text its sorted distinct shingle hashes; fewer words than ``width`` make one shingle."""
    for first, count in steps(texts):
        w, at = words(texts.slice(first, count))
        grams = chain(*(w[k : len(w) - width + 1 + k] for k in range(width))) if len(w) >= width else np.zeros(0, U64)
        for i in range(count):
            a, b = at[i], at[i + 1]
            if b - a >= width:
                yield np.unique(grams[a : b - width + 1])
            elif b > a:
                yield chain(*(w[k : k + 1] for k in range(a, b)))
            else:
                yield np.zeros(0, U64)


def signature(shingles: np.ndarray) -> np.ndarray:
    """All coordinates for a set of shingle hashes."""
    scatter, shifts = _permutations()
    bins = scatter[(shingles >> U64(64 - SPACE_BITS)).astype(np.int64)]
    low = np.full(BANDS * ROWS, 1 << SPACE_BITS, np.uint32)
    for k in range(0, len(bins), 4096):
        np.minimum(low, shifts[bins[k : k + 4096]].min(axis=0), out=low)
    return low


def _set_key(s: np.ndarray) -> int:
    """One number for a set: the mixed sum of mixed members, and its size."""
    with np.errstate(over="ignore"):
        total = np.sum(mix(s ^ U64(0x5E7)), dtype=U64)
        return int(mix(np.array([total ^ (U64(len(s)) << U64(40))]))[0].view(np.int64))


SIGNED = "id bigint, n bigint, key bigint, bands array<bigint>, sig binary"


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, count in steps(batch.column(1)):
            part = batch.slice(first, count)
            n, keys, bands, sigs = [], [], [], []
            for s in shingle_sets(part.column(1)):
                n.append(len(s))
                if not len(s):
                    keys.append(None)
                    bands.append(None)
                    sigs.append(None)
                    continue
                low = signature(s)
                grid = low.astype(U64).reshape(BANDS, ROWS)
                keys.append(_set_key(s))
                bands.append(chain(np.arange(BANDS, dtype=U64), *grid.T).view(np.int64))
                sigs.append(low.astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(n, pa.int64()), pa.array(keys, pa.int64()), pa.array(bands, pa.list_(pa.int64())), pa.array(sigs, pa.binary())],
                ["id", "n", "key", "bands", "sig"],
            )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, count in steps(batch.column(1)):
            made = list(shingle_sets(batch.column(1).slice(first, count)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([_set_key(s) if len(s) else None for s in made], pa.int64()), pa.array([s.tobytes() for s in made], pa.binary())],
                ["key", "members"],
            )


#: Pairs whose signatures agree in a smaller share than this are not verified: at a similarity of
#: 0.8 and 96 coordinates that is over five standard deviations low.
LEAST_AGREEMENT = 0.55


def _likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs (a, b) whose signatures agree enough; columns a, b, sig_a, sig_b."""
    for batch in batches:
        n = batch.num_rows
        if n:
            sigs = [np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(n, -1) for c in (2, 3)]
            batch = batch.filter(pa.array((sigs[0] == sigs[1]).mean(axis=1) >= LEAST_AGREEMENT))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"])


def _confirmed(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = np.frombuffer(x.as_py(), U64), np.frombuffer(y.as_py(), U64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                good.append(100 * both >= percent * (len(x) + len(y) - both))
            batch = batch.filter(pa.array(good, pa.bool_()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"])

    return run


def _near_in_size(a: str, b: str, percent: int):
    """No pair can reach the similarity if one set is too small for the other."""
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 80) -> DataFrame:
    """One row per row of ``docs``: id_col, n_shingles, component_id, kept, set_key.

    Two documents are linked when 100 * shared >= percent * all shingles. component_id is the
    smallest id reachable over links. Texts that are null, empty or without words have no
    shingles and are linked with nothing: component_id is their own id. A null id never is a
    component_id; a row with one is kept only if its component has no other id (component_id
    null). Rows with the same id and text are one document. An empty table gives no rows. Other
    columns are not read.
    """
    given = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    signed = cut_lineage(given.mapInArrow(_sign, SIGNED))
    classes = cut_lineage(
        signed.filter("n > 0").groupBy("key").agg(
            F.min("id").alias("least_id"), F.max("n").alias("n"), F.any_value("bands").alias("bands"), F.any_value("sig").alias("sig")
        )
    )
    buckets = classes.select("key", "n", F.explode("bands").alias("band"))
    sizes = buckets.groupBy("band").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    shared = cut_lineage(buckets.join(sizes, "band"))
    weights = shared.groupBy("key").agg(F.sum("size").alias("weight"))
    hubs = shared.join(weights, "key").groupBy("band").agg(F.max_by(F.struct("key", "n"), F.struct("weight", "key")).alias("hub"))
    star = (
        shared.join(hubs.select("band", F.col("hub.key").alias("a"), F.col("hub.n").alias("n_a")), "band")
        .withColumnRenamed("key", "b")
        .filter((F.col("a") != F.col("b")) & _near_in_size("n_a", "n", percent))
        .select("a", "b")
        .distinct()
    )
    likely = _likely_pairs(classes, star)
    ends = likely.select(F.col("a").alias("key")).union(likely.select(F.col("b").alias("key"))).distinct()
    links = cut_lineage(_confirm(likely, _members(given, classes, ends), percent))
    label = components(links)

    # buckets with members of different components: all links between those
    labelled = shared.join(label.withColumnRenamed("node", "key"), "key", "left").withColumn("label", F.coalesce("label", "key"))
    mixed = labelled.groupBy("band").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low <> high").select("band")
    left_open = cut_lineage(labelled.join(mixed, "band").select("key", "label").distinct())
    if left_open.limit(1).count():
        sets = _members(given, classes, left_open.select("key"))
        across = cut_lineage(_prefix_pairs(sets, left_open, percent).join(star.union(star.select("b", "a")), ["a", "b"], "left_anti"))
        more = cut_lineage(_confirm(across, sets, percent))
        if more.limit(1).count():
            label = components(links.union(more))

    placed = classes.select("key", "least_id").join(label.withColumnRenamed("node", "key"), "key", "left").withColumn(
        "label", F.coalesce("label", "key")
    )
    smallest = placed.groupBy("label").agg(F.min("least_id").alias("component_id"))
    by_key = placed.select("key", "label").join(smallest, "label").select("key", "component_id")
    out = signed.select("id", "n", "key").join(by_key, "key", "left").withColumn(
        "component_id", F.when(F.col("key").isNull(), F.col("id")).otherwise(F.col("component_id"))
    )
    return out.select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        "component_id",
        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"),
        F.col("key").alias("set_key"),
    )


def _likely_pairs(classes: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (a, b) of class keys whose signatures agree enough to be verified."""
    sig = classes.select("key", "sig")
    return cut_lineage(
        pairs.join(sig.select(F.col("key").alias("a"), F.col("sig").alias("sig_a")), "a")
        .join(sig.select(F.col("key").alias("b"), F.col("sig").alias("sig_b")), "b")
        .select("a", "b", "sig_a", "sig_b")
        .mapInArrow(_likely, "a bigint, b bigint")
    )


def _members(given: DataFrame, classes: DataFrame, keys: DataFrame) -> DataFrame:
    """(key, members): the full shingle sets of classes, from the text of one document each."""
    wanted = keys.join(classes.select("key", "least_id"), "key")
    ids = wanted.filter("least_id is not null").select(F.col("least_id").alias("id")).distinct()
    texts = given.join(ids, "id", "left_semi").unionByName(given.filter("id is null"))
    made = texts.select("id", "text").mapInArrow(_sets, "key bigint, members binary")
    return cut_lineage(made.join(wanted.select("key"), "key", "left_semi").dropDuplicates(["key"]))


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of class keys whose full shingle sets are similar enough."""
    return (
        pairs.join(sets.select(F.col("key").alias("a"), F.col("members").alias("x")), "a")
        .join(sets.select(F.col("key").alias("b"), F.col("members").alias("y")), "b")
        .select("a", "b", "x", "y")
        .mapInArrow(_confirmed(percent), "a bigint, b bigint")
    )


def _spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each member of each set, a set at a time."""
    for batch in batches:
        for key, raw in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            s = np.frombuffer(raw.as_py(), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(s), key, np.int64)), pa.array(s)], ["key", "shingle"])


def _prefix_pairs(sets: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """All pairs (a, b) of different labels that may be similar enough, by prefix filter.

    Shingles are ordered rarest first. Sets x and y with |x & y| >= t share a shingle among the
    first |x| - t + 1 of x and the first |y| - t + 1 of y. Similarity fixes t by the two sizes.
    Shingles that only one set has come first and pair with nothing, so they are only counted.
    """
    rows = cut_lineage(sets.select("key", "members").mapInArrow(_spread, "key bigint, shingle bigint"))
    common = rows.groupBy("shingle").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    size = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    ordered = (
        rows.join(common, "shingle").groupBy("key").agg(F.array_sort(F.collect_list(F.struct("df", "shingle"))).alias("rest"))
        .join(size, "key")
        .join(labels, "key")
        .withColumn("alone", F.col("n") - F.size("rest"))
        # a partner has percent of n members at least
        .withColumn("prefix", F.col("n") - F.ceil(F.col("n") * percent / F.lit(100.0) - F.lit(1e-9)) + 1 - F.col("alone"))
        .filter("prefix > 0")
        .select("key", "label", "n", "alone", F.posexplode(F.slice("rest", F.lit(1), F.col("prefix").cast("int"))).alias("at", "member"))
        .select("key", "label", "n", (F.col("alone") + F.col("at")).alias("at"), F.col("member.shingle").alias("shingle"))
    )
    ordered = cut_lineage(ordered)
    left = ordered.select("shingle", *[F.col(c).alias(f"{c}_a") for c in ("key", "label", "n", "at")])
    right = ordered.select("shingle", *[F.col(c).alias(f"{c}_b") for c in ("key", "label", "n", "at")])
    least = F.ceil((F.col("n_a") + F.col("n_b")) * percent / F.lit(100.0 + percent) - F.lit(1e-9))
    near = _near_in_size("n_a", "n_b", percent) & (F.col("at_a") <= F.col("n_a") - least) & (F.col("at_b") <= F.col("n_b") - least)
    return (
        left.join(right, "shingle").filter((F.col("label_a") < F.col("label_b")) & near)
        .select(F.col("key_a").alias("a"), F.col("key_b").alias("b")).distinct()
    )


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 80) -> DataFrame:
    """The rows of ``docs`` with the smallest id of their component, all columns; see ``near_dedup``."""
    gone = near_dedup(docs, id_col, text_col, percent).filter("not kept").select(F.col(id_col).alias("__id")).distinct()
    return docs.join(gone, F.col(id_col).eqNullSafe(F.col("__id")), "left_anti")


@register("op3_near_dedup")
def op3_near_dedup(spark, d):
    return near_dedup(table(spark, d, "documents")).drop("set_key")
