"""Merkle manifest of a dataset: leaves per group, trees of runs of eight, proofs by octopus multiproof.

Leaves are range-sorted by group and order, so a group of any size lies in many partitions. Each
leaf partition looks at the coordinates (level, place) of its own leaves only: at every level the
nodes it cannot derive are the siblings of what it has, the smallest set that proves all its
leaves together. It asks for those once; interiors that several leaves share are derived once in
the partition, and each leaf's own proof is read off there. What a partition can derive whole and
others may ask for are its largest complete subtrees; the levels above them are joined level by
level with grouping by parent. So what moves between partitions is some 14 nodes a level each,
never a tree. The groups' roots, in order of their group, are the leaves of one more such tree.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.common import cut_lineage, register, table

#: Nodes of a run.
RUN = 8
#: Most leaves of a partition, about.
LEAVES = 50_000


def digest(*values: Column) -> Column:
    """SHA-256 (32 bytes) of values: ``-`` for null, else UTF-8 byte count, ``:`` and the value."""
    parts = [F.coalesce(F.concat(F.octet_length(v.cast("string")).cast("string"), F.lit(":"), v.cast("string")), F.lit("-")) for v in values]
    return F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256))


def group_key(group: str) -> Column:
    """A string that orders groups: null first, then by UTF-8 bytes."""
    return F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))


def _sorted(leaves: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The leaves with the partition ``pid`` they were sorted into and their number ``at`` there; and the
    spans (pid, grp, first, start, size): the group's first number there, its leaves before, all of them."""
    spark = leaves.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-leaves.count() // LEAVES), 1)
    order = [F.asc_nulls_first(c) for c in ("grp", "id", "name", "leaf")]
    dealt = cut_lineage(
        leaves.repartitionByRange(parts, *order).sortWithinPartitions(*order)
        .withColumn("n", F.monotonically_increasing_id())
        .select("*", F.shiftright("n", 33).alias("pid"), F.col("n").bitwiseAND(F.lit((1 << 33) - 1)).alias("at"))
        .drop("n")
    )
    own = dealt.groupBy("pid", "grp").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("here"))
    whole = Window.partitionBy("grp")
    spans = own.select(
        "pid", "grp", "first",
        (F.sum("here").over(whole.orderBy("pid").rowsBetween(Window.unboundedPreceding, 0)) - F.col("here")).alias("start"),
        F.sum("here").over(whole).alias("size"),
    )
    return dealt, cut_lineage(spans)


def missing(places: np.ndarray, size: int) -> list[np.ndarray]:
    """For each level of a tree of ``size`` leaves the places that the leaves at ``places`` need and cannot derive."""
    out = []
    while size > 1:
        parents = np.unique(places // RUN)
        children = (parents[:, None] * RUN + np.arange(RUN)).ravel()
        out.append(np.setdiff1d(children[children < size], places, assume_unique=True))
        places, size = parents, -(-size // RUN)
    return out


def _node(children: list[str]) -> str:
    return hashlib.sha256("".join(children).encode()).hexdigest()


def complete_subtrees(places: np.ndarray, leaves: list[str], size: int) -> list[tuple[int, int, str]]:
    """(level, place, hex digest) of the largest subtrees whose leaves are all there; places ascend."""
    out, level, nodes = [], 0, leaves
    while len(places):
        if size == 1:
            out.append((level, 0, nodes[0]))
            break
        parents, first, have = np.unique(places // RUN, return_index=True, return_counts=True)
        whole = have == np.minimum(RUN, size - parents * RUN)
        above = []
        for a, n, w in zip(first.tolist(), have.tolist(), whole.tolist()):
            if w:
                above.append(_node(nodes[a : a + n]))
            else:
                out += [(level, int(places[k]), nodes[k]) for k in range(a, a + n)]
        places, nodes, level, size = parents[whole], above, level + 1, -(-size // RUN)
    return out


class Steps(NamedTuple):
    """One level of the way up from a node: its siblings' hex digests on either side."""

    before: str
    after: str


def expand(places: np.ndarray, leaves: list[str], fetched: dict[tuple[int, int], str], size: int) -> tuple[list[list[Steps]], str]:
    """Each leaf's steps to the root, and the root, from the partition's leaves and what it fetched."""
    ways: list[list[Steps]] = [[] for _ in leaves]
    mine = np.arange(len(leaves))  # which of the partition's nodes of this level is above each leaf
    level, nodes = 0, leaves
    own = places
    while size > 1:
        parents, inverse = np.unique(own // RUN, return_inverse=True)
        have = dict(zip(own.tolist(), nodes))
        runs = [[have.get(k) or fetched[level, k] for k in range(p * RUN, min(p * RUN + RUN, size))] for p in parents.tolist()]
        step = []
        for place, r in zip(own.tolist(), inverse.tolist()):
            k = place % RUN
            step.append(Steps("".join(runs[r][:k]), "".join(runs[r][k + 1 :])))
        for way, k in zip(ways, mine.tolist()):
            way.append(step[k])
        own, nodes, mine = parents, [_node(r) for r in runs], inverse[mine]
        level, size = level + 1, -(-size // RUN)
    return ways, nodes[0]


def fold(leaf: str, way: list[Steps]) -> str:
    """The root that a leaf and its siblings give."""
    for before, after in way:
        leaf = hashlib.sha256((before + leaf + after).encode()).hexdigest()
    return leaf


def _parts(leaves: pa.Table, spans: pa.Table) -> Iterator[tuple[dict, pa.Table, np.ndarray]]:
    """For each group of a partition its span, its leaves in order and their places in the group's tree."""
    leaves = leaves.sort_by("at")
    at = leaves.column("at").to_numpy()
    for span in sorted(spans.to_pylist(), key=lambda s: s["first"]):
        ends = [s for s in spans.column("first").to_pylist() if s > span["first"]]
        a = int(np.searchsorted(at, span["first"]))
        b = int(np.searchsorted(at, min(ends))) if ends else len(at)
        yield span, leaves.slice(a, b - a), at[a:b] - span["first"] + span["start"]


def _hex(column: pa.ChunkedArray) -> list[str]:
    return [x.hex() for x in column.to_pylist()]


NODES = "kind int, pid bigint, grp string, level int, place bigint, size bigint, node binary"


def _ask(leaves: pa.Table, spans: pa.Table) -> pa.Table:
    """Of a leaf partition: kind 0, its largest complete subtrees; kind 1, the nodes it is missing."""
    rows = []
    for span, own, places in _parts(leaves, spans):
        head = (span["pid"], span["grp"])
        rows += [(0, *head, lv, p, span["size"], bytes.fromhex(h)) for lv, p, h in complete_subtrees(places, _hex(own.column("leaf")), span["size"])]
        for level, need in enumerate(missing(places, span["size"])):
            rows += [(1, *head, level, p, span["size"], None) for p in need.tolist()]
    columns = list(zip(*rows)) or [[]] * 7
    kinds = [pa.int32(), pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], ["kind", "pid", "grp", "level", "place", "size", "node"])


def _tree(complete: DataFrame) -> DataFrame:
    """(grp, level, place, node, size) of every node that no partition has below it: subtrees and what joins them."""
    levels = complete.agg(F.max("size").alias("n")).first()["n"] or 0
    made = complete.filter("level = 0").select("grp", "level", "place", "node", "size")
    out, level = [made], 0
    while levels > 1:
        above = (
            made.filter(F.ceil(F.col("size") / F.lit(RUN**level)) > 1)  # the root has no parent
            .groupBy("grp", "size", F.floor(F.col("place") / RUN).alias("place"))
            .agg(F.array_sort(F.collect_list(F.struct("place", "node"))).alias("run"))
            .select(
                "grp", F.lit(level + 1).alias("level"), "place",
                F.unhex(F.sha2(F.array_join(F.transform("run", lambda x: F.lower(F.hex(x["node"]))), "").cast("binary"), 256)).alias("node"),
                "size",
            )
        )
        level, levels = level + 1, -(-levels // RUN)
        made = cut_lineage(above.unionByName(complete.filter(F.col("level") == level).select("grp", "level", "place", "node", "size")))
        out.append(made)
    whole = out[0]
    for part in out[1:]:
        whole = whole.unionByName(part)
    return whole


def _encode(way: list[Steps]) -> bytes:
    return "\n".join(f"{a} {b}" for a, b in way).encode()


def decode_steps(raw: bytes | None) -> list[Steps]:
    """A proof's levels from its written form."""
    return [Steps(*line.split(" ")) for line in raw.decode().split("\n")] if raw else []


PROVED = (
    "id bigint, name string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, "
    "verified boolean, proof binary"
)


def _expand(with_proofs: bool):
    def run(leaves: pa.Table, sent: pa.Table) -> pa.Table:
        """Of a leaf partition: each leaf's proof from what was sent, and the root its ``tried`` digest folds to."""
        kind = sent.column("kind")
        spans = sent.filter(pc.equal(kind, 2)).select(["grp", "first", "start", "size", "way", "node"])
        got: dict[str, dict[tuple[int, int], str]] = {}
        for x in sent.filter(pc.equal(kind, 1)).select(["grp", "level", "place", "node"]).to_pylist():
            got.setdefault(x["grp"], {})[x["level"], x["place"]] = x["node"].hex()
        rows = []
        for span, own, places in _parts(leaves, spans):
            digests = _hex(own.column("leaf"))
            ways, subroot = expand(places, digests, got.get(span["grp"], {}), span["size"])
            above = decode_steps(span["way"])
            root = span["node"].hex() if span["node"] else subroot
            for i, name, leaf, tried, way in zip(own["id"].to_pylist(), own["name"].to_pylist(), digests, _hex(own.column("tried")), ways):
                way = way + above
                siblings = hashlib.sha256("".join(a + b for a, b in way).encode()).hexdigest()
                folded = fold(tried, way)
                rows.append((i, name, leaf, subroot, root, siblings, folded, folded == root, _encode(way) if with_proofs else None))
        columns = list(zip(*rows)) or [[]] * 9
        kinds = [pa.int64(), *[pa.string()] * 6, pa.bool_(), pa.binary()]
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], [c.split(" ")[0] for c in PROVED.split(", ")])

    return run


def _prove(leaves: DataFrame, with_proofs: bool, one_tree: bool) -> DataFrame:
    dealt, spans = _sorted(leaves)
    asked = cut_lineage(dealt.groupBy("pid").cogroup(spans.groupBy("pid")).applyInArrow(_ask, NODES))
    tree = cut_lineage(_tree(asked.filter("kind = 0")))
    fetched = asked.filter("kind = 1").drop("node", "size").join(tree.drop("size"), ["grp", "level", "place"])
    if one_tree:
        above = spans.withColumns({"way": F.lit(None).cast("binary"), "node": F.lit(None).cast("binary")})
    else:
        subroots = tree.groupBy("grp").agg(F.max_by("node", "level").alias("leaf"))
        upper = subroots.select(F.lit("").alias("grp"), F.lit(None).cast("bigint").alias("id"), F.col("grp").alias("name"), "leaf", F.col("leaf").alias("tried"))
        proved = _prove(upper, True, True)
        above = spans.join(proved.select(F.col("name").alias("grp"), F.col("proof").alias("way"), F.unhex("root").alias("node")), "grp")
    sent = fetched.select("kind", "pid", "grp", "level", "place", "node").unionByName(
        above.select(F.lit(2).alias("kind"), "pid", "grp", "first", "start", "size", "way", "node"), allowMissingColumns=True
    )
    return dealt.groupBy("pid").cogroup(sent.groupBy("pid")).applyInArrow(_expand(with_proofs), PROVED)


def manifest(leaves: DataFrame, with_proofs: bool = False) -> DataFrame:
    """(id, leaf, subroot, root, proof_sha256, folded_root, verified, proof) of leaves (grp, id, leaf, tried).

    A tree for each ``grp`` (not null, in string order) with leaves by ascending id, and one tree
    over the groups' roots. ``tried`` is the digest that folded_root starts from in the leaf's
    place; verified tells whether it gives the root. proof holds the siblings if asked for
    (``decode_steps``), else null. Null ids come first, equal ids are ordered by digest, repeated
    rows are leaves of their own. An empty table gives no rows. Other columns are not read.
    """
    rows = leaves.select("grp", "id", F.lit("").alias("name"), "leaf", "tried")
    return _prove(rows, with_proofs, False).drop("name")


def document_leaves(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """Leaves (grp, id, leaf, tried) of rows of documents; ``tampered`` (of doc_id) tells whose text is tried in lower case."""
    others = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    leaf = digest(*others, F.col("text"))
    tried = leaf if tampered is None else F.when(tampered, digest(*others, lower)).otherwise(leaf)
    return docs.select(group_key("lang").alias("grp"), F.col("doc_id").cast("long").alias("id"), leaf.alias("leaf"), tried.alias("tried"))


@register(
    "op13_merkle_manifest",
    """
    with recursive
    d as (select doc_id, source, lang, n_chars, text, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') low from documents),
    -- crc32 of the id's digits, a bit at a time
    c as (
      select doc_id, xor(4294967295, list_reduce(
        list_prepend(4294967295::bigint, [ascii(x)::bigint for x in string_split(doc_id::varchar, '')]),
        lambda c, b: list_reduce(list_prepend(xor(c, b), [k::bigint for k in range(8)]), lambda r, k: xor(r >> 1, 3988292384 * (r & 1))))) crc
      from (select distinct doc_id from documents where doc_id is not null)
    ),
    h as (
      select d.doc_id, coalesce('=' || lang, '') g,
        sha256(coalesce(strlen(d.doc_id::varchar) || ':' || d.doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
          || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::varchar) || ':' || n_chars, '-')
          || coalesce(strlen(text) || ':' || text, '-')) leaf,
        sha256(coalesce(strlen(d.doc_id::varchar) || ':' || d.doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
          || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::varchar) || ':' || n_chars, '-')
          || coalesce(strlen(text) || ':' || case when crc % 3 = 0 then low else text end, '-')) tried
      from d left join c on d.doc_id = c.doc_id
    ),
    l as (
      select *, row_number() over (partition by g order by doc_id nulls first, leaf) - 1 p, count(*) over (partition by g) n from h
    ),
    low_tree(g, lv, p, n, h) as (
      select g, 0, p, n, leaf from l
      union all
      select g, lv + 1, p // 8, (n + 7) // 8, sha256(string_agg(h, '' order by p)) from low_tree where n > 1 group by g, lv, n, p // 8
    ),
    s as (select g, h, row_number() over (order by g) - 1 p, count(*) over () n from low_tree where n = 1),
    high_tree(lv, p, n, h) as (
      select 0, p, n, h from s
      union all
      select lv + 1, p // 8, (n + 7) // 8, sha256(string_agg(h, '' order by p)) from high_tree where n > 1 group by lv, n, p // 8
    ),
    runs as (
      select g, lv, p // 8 p, list(h order by p) r from low_tree where n > 1 group by g, lv, p // 8
      union all
      select null, lv, p // 8, list(h order by p) from high_tree where n > 1 group by lv, p // 8
    ),
    low_way(id, g, lv, p, n, h, way) as (
      select (g, p), g, 0, p, n, tried, '' from l
      union all
      select w.id, w.g, w.lv + 1, w.p // 8, (w.n + 7) // 8,
        sha256(array_to_string(r[:w.p % 8], '') || h || array_to_string(r[w.p % 8 + 2:], '')),
        way || array_to_string(r[:w.p % 8], '') || array_to_string(r[w.p % 8 + 2:], '')
      from low_way w join runs on runs.g = w.g and runs.lv = w.lv and runs.p = w.p // 8 where w.n > 1
    ),
    high_way(id, lv, p, n, h, way) as (
      select w.id, 0, s.p, s.n, w.h, w.way from low_way w join s using (g) where w.n = 1
      union all
      select w.id, w.lv + 1, w.p // 8, (w.n + 7) // 8,
        sha256(array_to_string(r[:w.p % 8], '') || h || array_to_string(r[w.p % 8 + 2:], '')),
        way || array_to_string(r[:w.p % 8], '') || array_to_string(r[w.p % 8 + 2:], '')
      from high_way w join runs on runs.g is null and runs.lv = w.lv and runs.p = w.p // 8 where w.n > 1
    )
    select l.doc_id, l.leaf, s.h subroot, t.h root, sha256(f.way) proof_sha256, f.h folded_root, f.h = t.h verified
    from l join s using (g) join high_way f on f.id = (l.g, l.p) and f.n = 1
      cross join (select h from high_tree where n = 1) t
    """,
)
def op13_merkle_manifest(spark, d):
    tampered = F.col("doc_id").isNotNull() & (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0)
    leaves = document_leaves(table(spark, d, "documents"), tampered)
    return manifest(cut_lineage(leaves)).withColumnRenamed("id", "doc_id").drop("proof")
