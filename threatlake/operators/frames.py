"""Framing: entities of one type nested with the entities they link to."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import SPREAD, cut_lineage, distinct_keys
from .mapping import TYPE
from .merge import split_large, statement_item

# Keys of a frame definition that are not properties.
FRAME_KEYS = ("@explicit", "@type", "@rows", TYPE)


@dataclass(frozen=True)
class FrameSpec:
    """A frame: the type of the entity, its listed properties and its embedded links.

    A property with a frame of its own embeds the linked entity. The tree is
    finite, so links that run in a circle end with it. Values of a property in ``rows`` are
    not listed in the entity's document: each is a document of its own, of type
    ``<document type>.<property>``. That is for lists that nothing bounds; the shape of a
    document follows from its frame alone, never from its size.
    """

    type: str
    props: Mapping[str, FrameSpec | None] = field(default_factory=dict)
    explicit: bool = True
    rows: frozenset[str] = frozenset()

    @staticmethod
    def from_dict(definition: dict) -> FrameSpec:
        props = {
            name: FrameSpec.from_dict(inner) if inner.get("@type") else None
            for name, inner in definition.items()
            if name not in FRAME_KEYS
        }
        rows = frozenset(name for name in props if definition[name].get("@rows"))
        return FrameSpec(definition["@type"], props, bool(definition.get("@explicit", True)), rows)

    def types(self) -> set[str]:
        return {self.type}.union(*[inner.types() for inner in self.props.values() if inner])


def read_frames(spark: SparkSession, folder: str) -> dict[str, FrameSpec]:
    """Frame definitions of a folder by file name; configuration, a few small files."""
    files = spark.read.text(folder, wholetext=True)
    rows = files.select(F.regexp_extract("_metadata.file_path", r"([^/]+?)(\.json)?$", 1).alias("name"), "value").collect()
    return {row["name"]: FrameSpec.from_dict(json.loads(row["value"])) for row in rows}


def of_types(statements: DataFrame, types: set[str]) -> DataFrame:
    """Only the statements of the types that some frame needs."""
    return statements.where(F.col("type").isin(*sorted(types)))


def _nodes(
    statements: DataFrame, spec: FrameSpec, cap: int | None, spill: list[DataFrame], doc_type: str, only: DataFrame | None = None
) -> DataFrame:
    """``(uri, part, parts, node)`` for the entities of the frame's type, or ``only`` some.

    Child rows, and with ``cap`` large entities of inner frames, are appended to ``spill``.
    """
    literals = [p for p, inner in spec.props.items() if inner is None]
    edges = {p: inner for p, inner in spec.props.items() if inner is not None}
    own = statements.where(F.col("type") == spec.type).select("uri", "property", "value", "object_uri")
    if spec.explicit:
        own = own.where(F.col("property").isin(TYPE, *spec.props))
    if only is not None:
        own = own.join(only, "uri", "left_semi")
    own = split_large(own, "uri", statement_item(), cap)

    for name in sorted(spec.rows - set(edges)):
        value = F.coalesce("value", "object_uri").alias(name)
        found = own.where(F.col("property") == name).select("uri", value).distinct()
        spill.append(_child_rows(found, f"{doc_type}.{name}", name))
        own = own.where(F.col("property") != name)
    is_edge = F.col("property").isin(*edges) if edges else F.lit(False)
    rows = own.where(~is_edge).select("uri", "part", "parts", "property", F.coalesce("value", "object_uri").alias("value"))
    for name, inner in edges.items():
        edge = own.where((F.col("property") == name) & F.col("object_uri").isNotNull())
        reached = None if only is None else cut_lineage(distinct_keys(edge.select("uri", "object_uri"), "object_uri").toDF("uri"))
        child = _nodes(statements, inner, cap, spill, f"{doc_type}.{name}", reached)
        if cap is not None:
            large = child.where(F.col("parts") > 1)
            spill.append(large.select(F.lit(inner.type).alias("doc_type"), "uri", "part", F.to_json("node").alias("doc")))
        # A child of several parts is linked by uri; its parts are documents of their own.
        single = child.where(F.col("parts") == 1).select(F.col("uri").alias("object_uri"), F.col("node").alias("child"))
        linked = edge.select("uri", "part", "parts", "object_uri")
        bare = F.struct(
            F.col("object_uri").alias("uri"),
            *[F.lit(None).cast(f.dataType).alias(f.name) for f in child.schema["node"].dataType.fields[1:]],
        )
        embedded = linked.join(single, "object_uri", "left").select(
            "uri", "part", "parts", F.coalesce("child", bare).alias(f"_{name}")
        )
        if name in spec.rows:
            found = embedded.select("uri", F.col(f"_{name}").alias(name)).distinct()
            spill.append(_child_rows(found, f"{doc_type}.{name}", name))
        else:
            rows = rows.unionByName(embedded, allowMissingColumns=True)

    def listed(column: Column) -> Column:
        found = F.array_sort(F.collect_set(column))
        return F.when(F.size(found) > 0, found)

    columns = [listed(F.when(F.col("property") == TYPE, F.col("value"))).alias(TYPE)]
    for name, inner in spec.props.items():
        if name in spec.rows:
            continue
        source = F.col(f"_{name}") if inner else F.when(F.col("property") == name, F.col("value"))
        columns.append(listed(source).alias(name))
    if not spec.explicit:
        other = ~F.col("property").isin(TYPE, *literals)
        columns.append(listed(F.when(other, F.struct("property", "value"))).alias("other"))
    # Dealt first: lists that start in the scan sort all rows of a split.
    nodes = rows.repartition(SPREAD, "uri", "part", "parts").groupBy("uri", "part", "parts").agg(*columns)
    fields = [c for c in nodes.columns if c not in ("uri", "part", "parts")]
    return nodes.select("uri", "part", "parts", F.struct("uri", *fields).alias("node"))


def _child_rows(found: DataFrame, doc_type: str, name: str) -> DataFrame:
    """A document for each value of an entity's property; its part is a hash of the value."""
    doc = F.to_json(F.struct("uri", name))
    return found.select(F.lit(doc_type).alias("doc_type"), "uri", F.xxhash64(doc).alias("part"), doc.alias("doc"))


def affected(statements: DataFrame, spec: FrameSpec, changed: DataFrame) -> DataFrame:
    """Entities of the frame's type whose documents a change can reach, as ``uri``.

    These are the changed ones and those that link, over the frame's embedded
    links, to a changed one. ``changed`` is a stored table of distinct uris.
    """
    own = of_types(statements, {spec.type}).select("uri", "property", "value", "object_uri")
    hit = own.join(changed, "uri", "left_semi")
    for name, inner in spec.props.items():
        # Links without a frame show only the uri, which a change of its entity leaves alone.
        if inner is not None:
            reached = affected(statements, inner, changed).withColumnRenamed("uri", "object_uri")
            edge = own.where(F.col("property") == name)
            hit = hit.unionByName(edge.join(reached, "object_uri", "left_semi"))
    return cut_lineage(distinct_keys(hit, "uri"))


def frame(
    statements: DataFrame, doc_type: str, spec: FrameSpec, cap: int | None = None, only: DataFrame | None = None
) -> DataFrame:
    """Documents ``(doc_type, uri, part, doc)`` of one frame.

    Entities of any size have one document of the shape that the frame gives, and their child
    rows. For readers that need bounded documents, with ``cap`` an entity of more
    statements comes as several parts; where it is linked from others it stays
    a uri there, and its parts are added as documents of its own type. ``only``
    limits the documents to some root entities, given as distinct ``uri``.
    """
    spill: list[DataFrame] = []
    root = _nodes(of_types(statements, spec.types()), spec, cap, spill, doc_type, only)
    docs = root.select(F.lit(doc_type).alias("doc_type"), "uri", "part", F.to_json("node").alias("doc"))
    for extra in spill:
        docs = docs.unionByName(extra)
    return docs


def typed_properties(frames: dict[str, FrameSpec]) -> list[tuple[str, str]]:
    """``(type, property)`` of all frame definitions, each once."""
    found: set[tuple[str, str]] = set()

    def walk(spec: FrameSpec) -> None:
        for name, inner in spec.props.items():
            found.add((spec.type, name))
            if inner:
                walk(inner)

    for spec in frames.values():
        walk(spec)
    return sorted(found)
