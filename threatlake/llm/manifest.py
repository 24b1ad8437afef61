"""A Merkle manifest of a table: content-addressed records, inclusion proofs, and their check.

A leaf is the digest of a row's fields, each as ``-`` if null, else its UTF-8 bytes' count, ``:``, value. Leaves of a group
stand in the order of their key; runs of ``FANOUT`` nodes become the digest of their digests until one is left, the group's
subroot; subroots, in the order of their group, become the root in the same way. A record has a digest and its children's
digests, so the store is a graph in which equal subtrees are one.

Proofs are found by descent: the requested leaves' places give, digit by digit, the nodes that have a request below; from the root
on each such node's record is looked up by its digest, and each wanted child takes its node's path and one more segment,
the digests before and after it. A path is held once for all requests below a node, so the work shrinks by
``FANOUT`` with each level. At the leaf the segments are reversed, and fold the leaf back to a root.

Every join is by digest, or by group and place, never by group alone. Each level is written to the shared folder.

Defined cases: null fields are ``-``; null keys and null groups come first; rows that are equal in group and key stand in the order of
their leaves, and rows equal in all fields are one leaf each; a group of one row has its leaf as subroot, a single group its
subroot as root; a proof without siblings is the digest of nothing; an empty table has no root and no proofs.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .numbering import places

FANOUT = 8


def digest_of(fields: Sequence[Column]) -> Column:
    """A row's leaf digest."""
    def coded(c: Column) -> Column:
        value = c.cast("string")
        return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value))

    return F.sha2(F.concat(*[coded(c) for c in fields]).cast("binary"), 256)


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@dataclass
class Manifest:
    """Stored tables: ``leaves`` (tree, rank, width, key, leaf, kept), ``groups`` (tree, subroot, width, group), ``records`` (digest, children)."""

    leaves: DataFrame
    groups: DataFrame
    records: DataFrame
    root: str | None


def _levels(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Records of all levels over ``tree, idx, digest, width``, where width is a level's number of nodes; and each tree's last node."""
    records, tops = [], [nodes.where("width = 1").select("tree", "digest")]
    while (nodes.agg(F.max("width").alias("w")).head()["w"] or 0) > 1:
        nodes = nodes.where("width > 1")
        run = nodes.groupBy("tree", F.floor(F.col("idx") / FANOUT).alias("idx"), F.ceil(F.col("width") / FANOUT).alias("width"))
        children = F.transform(F.array_sort(F.collect_list(F.struct("idx", "digest"))), lambda c: c["digest"])
        made = run.agg(children.alias("children"))
        level = _stored(made.select("tree", "idx", F.sha2(F.array_join("children", "").cast("binary"), 256).alias("digest"), "width", "children"), "nodes")
        records.append(level.select("digest", "children"))
        nodes = level.select("tree", "idx", "digest", "width")
        tops.append(nodes.where("width = 1").select("tree", "digest"))
    return records, reduce(DataFrame.unionByName, tops)


def build(docs: DataFrame, fields: Sequence[str], group: str, key: str, **kept: Column) -> Manifest:
    """The manifest of ``docs``; the columns ``kept`` stay with the leaves, so they should be small."""
    # Digests are made once: the sort below would read the texts twice. ``_tie`` deals equal rows over the sort's partitions.
    held = _stored(docs.select(
        F.col(group).alias("group"), F.col(key).alias("key"), digest_of([F.col(f) for f in fields]).alias("leaf"),
        F.struct(F.lit(0).alias("_"), *[c.alias(n) for n, c in kept.items()]).alias("kept"), F.monotonically_increasing_id().alias("_tie"),
    ), "digests")
    ranked = places(held, [F.col("group").asc_nulls_first(), F.col("key").asc_nulls_first(), F.col("leaf"), F.col("_tie")], "_place")
    sizes = _stored(ranked.groupBy("group").agg(F.min("_place").alias("_first"), F.count("*").alias("width")), "sizes")
    trees = _stored(places(sizes, [F.col("group").asc_nulls_first()], "tree").withColumnRenamed("group", "_group"), "trees")
    with_tree = ranked.join(trees, F.col("group").eqNullSafe(F.col("_group")))
    leaves = _stored(with_tree.select("tree", (F.col("_place") - F.col("_first")).alias("rank"), "width", "key", "leaf", "kept"), "leaves")
    records, subroots = _levels(leaves.select("tree", F.col("rank").alias("idx"), F.col("leaf").alias("digest"), "width"))
    groups = _stored(trees.join(subroots.withColumnRenamed("digest", "subroot"), "tree").select("tree", "subroot", "width", F.col("_group").alias("group")), "groups")
    n = groups.count()
    above, top = _levels(groups.select(F.lit(0).cast("bigint").alias("tree"), F.col("tree").alias("idx"), F.col("subroot").alias("digest"), F.lit(n).cast("bigint").alias("width")))
    root = top.head()
    none = docs.sparkSession.createDataFrame([], "digest string, children array<string>")
    every = reduce(DataFrame.unionByName, [*records, *above], none)
    return Manifest(leaves, groups, _stored(every.dropDuplicates(["digest"]), "records"), root["digest"] if root else None)


def height(width: Column) -> Column:
    """Levels above ``width`` nodes."""
    levels = F.sequence(F.lit(1), F.lit(20))
    return F.when(width <= 1, F.lit(0)).otherwise(F.array_min(F.filter(levels, lambda h: F.pow(F.lit(float(FANOUT)), h) >= width)))


def _segment(children: Column, digit: Column) -> Column:
    """The digests before and after the child that a digit chooses."""
    return F.struct(F.array_join(F.slice(children, 1, digit), "").alias("before"), F.array_join(F.slice(children, digit + 2, FANOUT), "").alias("after"))


def _step(frontier: DataFrame, records: DataFrame, wanted: DataFrame) -> DataFrame:
    """From nodes to their wanted children, a segment longer; ``wanted`` has tree and idx of the level below."""
    met = frontier.join(records, "digest")
    columns = [c for c in frontier.columns if c not in ("digest", "idx", "path", "height")]
    opened = met.select(*columns, (F.col("height") - 1).alias("height"), "idx", "path", "children", F.posexplode("children").alias("_digit", "digest"))
    below = opened.select(*columns, "height", (F.col("idx") * FANOUT + F.col("_digit")).alias("idx"), "digest", F.concat("path", F.array(_segment(F.col("children"), F.col("_digit")))).alias("path"))
    return below.join(wanted, ["tree", "idx"], "left_semi")


def _up(wanted: DataFrame, levels: int) -> list[DataFrame]:
    """The nodes that have ``wanted`` ones (tree, idx, height) below, level by level from theirs up."""
    out = [wanted]
    for _ in range(levels):
        wanted = _stored(wanted.where("height > 0").select("tree", F.floor(F.col("idx") / FANOUT).alias("idx"), (F.col("height") - 1).alias("height")).distinct(), "wanted")
        out.append(wanted)
    return out


def proofs(manifest: Manifest, requests: DataFrame | None = None) -> DataFrame:
    """The requested leaves (all, or those of ``tree, rank``) with ``subroot`` and ``path``, their segments from the leaf up."""
    leaves, records = manifest.leaves, manifest.records
    asked = leaves if requests is None else leaves.join(requests.select("tree", "rank").distinct(), ["tree", "rank"], "left_semi")
    above = F.when(F.col("width") > 1, F.floor(F.col("rank") / FANOUT)).otherwise(F.lit(0)).cast("bigint")
    asked = asked.withColumn("_above", above)
    # Wanted nodes of each height over the leaves, then of the tree of groups.
    first = asked.select("tree", F.col("_above").alias("idx"), F.greatest(height(F.col("width")) - 1, F.lit(0)).alias("height")).distinct()
    most = manifest.groups.agg(F.max(height(F.col("width"))).alias("h")).head()["h"] or 0
    inner = _up(_stored(first, "wanted"), max(most - 1, 0))
    n = manifest.groups.count()
    tall = 0
    while FANOUT**tall < n:
        tall += 1
    one = F.lit(0).cast("bigint").alias("tree")
    outer = _up(_stored(asked.select(one, F.col("tree").alias("idx"), F.lit(tall).alias("height")).distinct(), "wanted"), tall)
    start = manifest.records.sparkSession.range(1 if manifest.root else 0)
    empty = F.array().cast("array<struct<before:string,after:string>>")
    # Stored, so that the root is a row to join and no constant.
    frontier = _stored(start.select(one, F.lit(0).cast("bigint").alias("idx"), F.lit(manifest.root).cast("string").alias("digest"), F.lit(tall).alias("height"), empty.alias("path")), "frontier")
    for k in range(tall):
        frontier = _stored(_step(frontier, records, outer[tall - 1 - k]), "frontier")
    subroots = manifest.groups.select(F.col("tree").alias("_tree"), "width")
    frontier = frontier.join(subroots, F.col("idx") == F.col("_tree")).select(
        F.col("_tree").alias("tree"), F.lit(0).cast("bigint").alias("idx"), "digest", F.col("digest").alias("subroot"), height(F.col("width")).alias("height"), "path")
    for h in range(most, 1, -1):  # groups that are lower wait until the descent is at their height
        done = _step(frontier.where(F.col("height") == h), records, inner[h - 2])
        frontier = _stored(done.unionByName(frontier.where(F.col("height") < h)), "frontier")
    last = frontier.join(records, "digest", "left").select("tree", F.col("idx").alias("_above"), "subroot", "path", F.when(F.col("height") > 0, F.col("children")).alias("_children"))
    digit = (F.col("rank") % FANOUT).cast("int")
    segments = F.when(F.col("_children").isNull(), F.col("path")).otherwise(F.concat("path", F.array(_segment(F.col("_children"), digit))))
    return asked.join(last, ["tree", "_above"]).select(*leaves.columns, "subroot", F.reverse(segments).alias("path"))


def proof_digest(path: Column) -> Column:
    """One digest of all siblings on a path."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), "").cast("binary"), 256)


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf's digest and its path give."""
    return F.aggregate(path, leaf, lambda acc, s: F.sha2(F.concat(s["before"], acc, s["after"]).cast("binary"), 256))
