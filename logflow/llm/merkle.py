"""Merkle dataset manifest (13): pointer-jumping proofs.

Every row is a leaf: the sha256 of its fields, each written as its length in
bytes, a colon and its value (``-`` for null).  The leaves of a source, in the
order of doc_id, make a tree: runs of ``ARITY`` consecutive nodes become the
sha256 of their digests until one node is left, the subroot.  The subroots in
the order of the sources make the last tree, whose node is the root.

Proofs come by pointer jumping.  All nodes of a run share their ancestors, so
the pointers are kept by run: a run points to the run that holds its parent,
with the parent's siblings there (left and right of it) as its segment.  In
each round a run takes over its ancestor's pointer and appends the ancestor's
segment to its own, which doubles the distance: after about log2(depth)
self-joins every run has reached the root.  A leaf's proof is its own run
without itself, followed by the run's segments.

Texts are hashed where they are read and never move.  Nodes are numbered by a
range sort of the digests with one offset for each (partition, tree), so a
source that holds a third of all rows is spread like any other.  Each round
looks up only runs that high enough above the leaves: 1/16 of the rows below,
for each level.

Nulls are fields of their own (``-``), a null doc_id comes first in its
source, a null source before all others.  Empty texts are ``0:``.  Rows that
repeat a (source, doc_id) are leaves of their own in the order of their
digests; equal rows have the same proof up to their place.  One leaf alone is
its source's subroot, one subroot alone the root; the proof of a single row is
the sha256 of nothing.  An empty table gives no row.  Very long texts are
hashed whole; columns other than the five fields are ignored.
"""

from __future__ import annotations

import string
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from logflow.llm._common import stored

ARITY = 16
HEX = 64
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TOP = "/"
RUN = ["tree", "level", "run"]


def leaf_digest(*values: Column) -> Column:
    def field(c: Column) -> Column:
        s = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))
    return F.sha2(F.concat(*map(field, values)), 256)


def _numbered(nodes: DataFrame, order: list[str]) -> DataFrame:
    """``nodes`` with their place (``idx``, from 0) and the size of their
    tree (``size``), by a range sort over all trees at once."""
    placed = stored(nodes.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
                    .withColumn("at", F.monotonically_increasing_id()), "placed")
    part = F.shiftright("at", 33).alias("part")
    pieces = placed.groupBy("tree", part).agg(F.min("at").alias("start"), F.count(F.lit(1)).alias("n"))
    # one row for each tree and partition it reaches into: at most the number
    # of trees and of partitions together
    whole = W.partitionBy("tree")
    pieces = pieces.select("tree", "part", "start", F.sum("n").over(whole).alias("size"), F.coalesce(
        F.sum("n").over(whole.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    return (placed.withColumn("part", part).join(pieces, ["tree", "part"])
            .withColumn("idx", F.col("at") - F.col("start") + F.col("before"))
            .drop("part", "at", "start", "before"))


def _runs(nodes: DataFrame, level: int) -> DataFrame:
    """tree, level, run, size (nodes of the tree at this level), digests (of
    the run's nodes, joined)."""
    in_order = F.array_sort(F.collect_list(F.struct("idx", "digest")))
    return (nodes.where("size > 1").groupBy("tree", F.expr(f"idx div {ARITY}").alias("run"))
            .agg(F.max("size").alias("size"), F.array_join(F.transform(in_order, lambda n: n["digest"]), "").alias("digests"))
            .select("tree", F.lit(level).alias("level"), "run", "size", "digests"))


def _trees(numbered: DataFrame, name: str) -> tuple[DataFrame, DataFrame, int]:
    """All runs of the trees (a lone leaf is a run of one), the node that is
    left of each tree (tree, digest), and the number of levels."""
    lone = numbered.where("size = 1").select("tree", F.lit(0).alias("level"), F.lit(0).cast("long").alias("run"),
                                             "size", F.col("digest").alias("digests"))
    levels, tops = [lone], [lone.select("tree", F.col("digests").alias("digest"))]
    nodes, largest = numbered, numbered.agg(F.max("size")).first()[0] or 0
    while largest > 1:
        levels.append(stored(_runs(nodes, len(levels) - 1), f"{name}-runs"))
        nodes = levels[-1].select("tree", F.col("run").alias("idx"), F.sha2("digests", 256).alias("digest"),
                                  F.ceil(F.col("size") / ARITY).alias("size"))
        tops.append(nodes.where("size = 1").select("tree", "digest"))
        largest = -(-largest // ARITY)
    return reduce(DataFrame.unionByName, levels), reduce(DataFrame.unionByName, tops), len(levels) - 1


def _beside(digests: Column, slot: Column) -> Column:
    """The siblings of the node at ``slot`` of a run, left and right of it."""
    return F.struct(F.substring(digests, F.lit(1), slot * HEX).alias("left"),
                    F.substring(digests, (slot + 1) * HEX + 1, F.lit(ARITY * HEX)).alias("right"))


def _slot(place: str) -> Column:
    return (F.col(place) % ARITY).cast("int")


def _up(tree: Column, level: Column, place: str) -> Column:
    return F.struct(tree.alias("tree"), level.alias("level"), F.expr(f"{place} div {ARITY}").alias("run"))


def _paths(links: DataFrame, hops: int) -> DataFrame:
    """tree, level, run, path: the segments from each run's parent to the
    root.  ``links``: run, digests, ``up`` (the run of its parent), ``slot``
    (the parent's place there) and ``height`` (most hops of a run below)."""
    links = stored(links, "links")
    above = links.select(F.struct(*RUN).alias("up"), F.col("digests").alias("siblings"))
    begun = (links.where("up is not null").join(above, "up")
             .select(*RUN, "height", "siblings", "slot", "up"))
    open_ = stored(begun.select(*RUN, "height", F.array(_beside(F.col("siblings"), F.col("slot"))).alias("path"), "up"), "paths")
    # the root's run has no segment of its own: who points to it is done next
    done = links.where("up is null").select(*RUN, "height", F.array().cast(open_.schema["path"].dataType).alias("path"))
    distance = 1
    while distance <= hops:
        # what is ``distance`` hops above some run has at least that height
        ahead = done.withColumn("next", F.lit(None).cast(open_.schema["up"].dataType)).unionByName(
            open_.withColumnRenamed("up", "next")).where(F.col("height") >= distance).select(
            F.struct(*RUN).alias("up"), "next", F.col("path").alias("more"))
        step = stored(open_.join(ahead, "up").select(*RUN, "height", F.concat("path", "more").alias("path"),
                                                     F.col("next").alias("up")), "paths")
        done = done.unionByName(step.where("up is null").drop("up"))
        open_ = step.where("up is not null")
        distance *= 2
    return done.select(*RUN, "path")


def fold(digest: Column, proof: Column) -> Column:
    """The root that a leaf's digest and its proof lead to."""
    return F.aggregate(proof, digest, lambda node, s: F.sha2(F.concat(s["left"], node, s["right"]), 256))


def proof_digest(proof: Column) -> Column:
    """sha256 of all siblings of a proof, in order."""
    return F.sha2(F.array_join(F.transform(proof, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def manifest(docs: DataFrame, carry: dict[str, Column] | None = None) -> DataFrame:
    """doc_id, source, leaf, subroot, root, proof (array of the siblings left
    and right of the path, from the leaf upwards).  ``carry``: more columns,
    computed from the row where it is read."""
    carry = carry or {}
    tree = F.when(F.col("source").isNull(), "").otherwise(F.concat(F.lit("="), "source"))
    leaves = stored(docs.select("doc_id", "source", tree.alias("tree"), leaf_digest(*map(F.col, FIELDS)).alias("digest"),
                                *[c.alias(name) for name, c in carry.items()]), "leaves")
    leaves = _numbered(leaves, ["doc_id", "digest"])
    runs, subroots, depth = _trees(leaves.select("tree", "idx", "size", "digest"), "source")
    # the subroots are the leaves of the last tree; no source gives its name
    ranked = _numbered(subroots.select(F.lit(TOP).alias("tree"), F.col("tree").alias("of"), "digest"), ["of"])
    top_runs, top, top_depth = _trees(ranked.select("tree", "idx", "size", "digest"), "top")
    root = (top.first() or [None, None])[1]
    ranked = ranked.select(F.col("of").alias("tree"), F.col("digest").alias("subroot"), F.col("idx").alias("rank"),
                           F.col("size").alias("sources"))

    inside = F.col("size") > ARITY  # the run is not the last one of its tree
    same = _up(F.col("tree"), F.col("level") + 1, "run")
    links = runs.where(inside).select(*RUN, "digests", F.col("level").alias("height"), same.alias("up"), _slot("run").alias("slot"))
    links = links.unionByName(runs.where(~inside).join(ranked, "tree").select(
        *RUN, "digests", F.col("level").alias("height"),
        F.when(F.col("sources") > 1, _up(F.lit(TOP), F.lit(0), "rank")).alias("up"), _slot("rank").alias("slot")))
    links = links.unionByName(top_runs.where("size > 1").select(
        *RUN, "digests", (F.col("level") + max(depth, 1)).alias("height"), F.when(inside, same).alias("up"),
        _slot("run").alias("slot")))
    paths = _paths(links, max(depth, 1) + top_depth)

    first = (runs.where("level = 0").join(paths.where("level = 0"), RUN).join(ranked, "tree")
             .select("tree", "run", "digests", "path", "subroot"))
    own = F.when(F.col("size") > 1, F.array(_beside(F.col("digests"), _slot("idx")))).otherwise(
        F.array().cast(paths.schema["path"].dataType))
    return (leaves.withColumn("run", F.expr(f"idx div {ARITY}")).join(first, ["tree", "run"])
            .select("doc_id", "source", F.col("digest").alias("leaf"), "subroot", F.lit(root).cast("string").alias("root"),
                    F.concat(own, "path").alias("proof"), *carry))


def tampered_leaf() -> Column:
    """Leaf of the row with A-Z of its text lower-cased, where 5 divides the
    crc32 of its doc_id in decimal; null elsewhere."""
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    lowered = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    return F.when(chosen, leaf_digest(*map(F.col, FIELDS[:-1]), lowered))


def verified(docs: DataFrame) -> DataFrame:
    """Every row with its proof, checked on a tampered copy of a fifth of the
    rows: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified."""
    rows = manifest(docs, {"tampered": tampered_leaf()})
    return rows.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("proof")).alias("proof_sha256"),
                       fold(F.coalesce("tampered", "leaf"), F.col("proof")).alias("folded_root")).withColumn(
        "verified", F.col("folded_root") == F.col("root"))


def _oracle() -> str:
    """DuckDB SQL of ``verified``'s rows, level by level: for up to ARITY ** 6
    rows of a source and ARITY ** 4 sources."""
    def field(c: str) -> str:
        return f"coalesce(strlen(cast({c} as varchar)) || ':' || cast({c} as varchar), '-')"

    low = f"translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
    leaf, lowered = (" || ".join(map(field, [*FIELDS[:-1], text])) for text in ("text", low))
    sql = [f"""with recursive
crc(k, v, c) as (
  select 0, b, b from (select unnest(range(256)) as b)
  union all
  select k + 1, v, case when c % 2 = 1 then xor(c // 2, 3988292384) else c // 2 end from crc where k < 8),
crc_table as materialized (select v, c from crc where k = 8),
digits(doc_id, rest, c) as (
  select doc_id, cast(doc_id as varchar), 4294967295 from (select distinct doc_id from documents where doc_id is not null)
  union all
  select d.doc_id, substr(d.rest, 2), xor(t.c, d.c // 256)
  from digits d join crc_table t on t.v = xor(d.c % 256, ascii(d.rest)) where d.rest <> ''),
chosen as (select doc_id from digits where rest = '' and xor(c, 4294967295) % 5 = 0),
digests as (
  select doc_id, coalesce('=' || source, '') as tree, sha256({leaf}) as leaf,
         case when doc_id in (select doc_id from chosen) then sha256({lowered}) else sha256({leaf}) end as given
  from documents),
leaves as materialized (
  select *, row_number() over (partition by tree order by doc_id nulls first, leaf) - 1 as idx from digests)"""]

    def climb(p: str, nodes: str, start: str, levels: int) -> None:
        """Nodes by level (``p``n), their siblings (``p``s) and the way up of
        the rows of ``start`` (``p``c: given, proof)."""
        sql.append(f"{p}n0 as (select tree, idx, {nodes})")
        sql.append(f"{p}c0 as ({start})")
        for k in range(levels):
            sql.append(f"""{p}s{k} as materialized (
  select *, count(*) over (partition by tree) as m,
         coalesce(string_agg(digest, '') over (partition by tree, idx // {ARITY} order by idx
                  rows between unbounded preceding and 1 preceding), '') as l,
         coalesce(string_agg(digest, '') over (partition by tree, idx // {ARITY} order by idx
                  rows between 1 following and unbounded following), '') as r
  from {p}n{k})""")
            sql.append(f"""{p}n{k + 1} as (
  select tree, idx // {ARITY} as idx,
         case when max(m) = 1 then max(digest) else sha256(string_agg(digest, '' order by idx)) end as digest
  from {p}s{k} group by tree, idx // {ARITY})""")
            sql.append(f"""{p}c{k + 1} as (
  select c.* exclude (given, proof), case when m = 1 then given else sha256(l || given || r) end as given,
         case when m = 1 then proof else proof || l || r end as proof
  from {p}c{k} c join {p}s{k} s on s.tree = c.tree and s.idx = c.idx // {ARITY ** k})""")

    climb("a", "leaf as digest from leaves", "select doc_id, tree, idx, leaf, given, '' as proof from leaves", 6)
    sql.append("ranked as (select '/' as tree, tree as of, digest, row_number() over (order by tree) - 1 as idx from an6)")
    climb("b", "digest from ranked", "select doc_id, r.tree, r.idx, leaf, r.digest as subroot, given, proof "
          "from ac6 c join ranked r on r.of = c.tree", 4)
    sql.append("root as (select digest as root from bn4)")
    return ",\n".join(sql) + """
select doc_id, leaf, subroot, root, sha256(proof) as proof_sha256, given as folded_root, given = root as verified
from bc4, root"""


ORACLE = _oracle()
