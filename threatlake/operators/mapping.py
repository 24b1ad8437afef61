"""Records to linked-entity statements, one declarative spec per model."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import STATEMENT_COLUMNS

# Models that also serve other feeds.
ALIASES = {
    "asu-twitter": ["isi-twitter"],
    "isi-company-cpe": ["isi-company-cpe-linkedin"],
}

TYPE = "a"


@dataclass(frozen=True)
class MappingSpec:
    """How one model turns a record into one entity's statements.

    Property and link columns hold one string or an array of strings; nulls give
    no statement. Links name the uri of the other entity.
    """

    model: str
    type: str
    uri: Column
    properties: Mapping[str, Column] = field(default_factory=dict)
    links: Mapping[str, Column] = field(default_factory=dict)
    publisher: Column | None = None
    recorded: Column | None = None
    observed: Column | None = None


def listed_routes(spark, rows: list[tuple[str, str]]) -> DataFrame:
    """``(source_name, model)`` from a list of the configuration, sent to the records.

    Feeds are few and their records many, so dealing records by feed would put a feed into one task. The hint is
    needed: adaptive execution keeps a sort-merge join where most partitions of the small side are empty.
    """
    return F.broadcast(spark.createDataFrame(rows, "source_name string, model string"))


def model_routes(spark, models: list[str]) -> DataFrame:
    """``(source_name, model)``: each model's own feed and its aliases."""
    return listed_routes(spark, [(source, model) for model in models for source in [model, *ALIASES.get(model, [])]])


def route(records: DataFrame, routes: DataFrame) -> DataFrame:
    """Give each record its model; a feed of two models yields the record twice."""
    return records.join(routes, "source_name")


class many:
    """Marks a mapping column that holds an array of strings."""

    def __init__(self, column: Column):
        self.column = column


def _no(kind: str) -> Column:
    return F.lit(None).cast(kind)


def _item(name: str, value: Column, link: bool) -> Column:
    value = value.cast("string")
    return F.struct(
        F.lit(name).alias("property"),
        (_no("string") if link else value).alias("value"),
        (value if link else _no("string")).alias("object_uri"),
    )


def _items(spec: MappingSpec) -> Column:
    """All property and link items of a record, as one array of plain structs."""
    single, arrays = [_item(TYPE, F.lit(spec.type), False)], []
    for link, columns in ((False, spec.properties), (True, spec.links)):
        for name, column in columns.items():
            if isinstance(column, many):
                listed = F.coalesce(column.column.cast("array<string>"), F.array().cast("array<string>"))
                arrays.append(_many_items(name, listed, link))
            else:
                single.append(_item(name, column, link))
    return F.concat(F.array(*single), *arrays) if arrays else F.array(*single)


def _many_items(name: str, listed: Column, link: bool) -> Column:
    return F.transform(listed, lambda v: _item(name, v, link))


def statements(routed: DataFrame, specs: list[MappingSpec]) -> DataFrame:
    """Statements of routed records: one scan, whatever the number of models."""

    def by_model(pick) -> Column:
        chosen = None
        for spec in specs:
            here = F.col("model") == spec.model
            chosen = F.when(here, pick(spec)) if chosen is None else chosen.when(here, pick(spec))
        return chosen

    def default(column: Column | None, nothing: Column) -> Column:
        return nothing if column is None else column

    about = routed.select(
        by_model(lambda s: s.uri).alias("uri"),
        by_model(lambda s: F.lit(s.type)).alias("type"),
        F.col("source_name").alias("source"),
        by_model(lambda s: default(s.publisher, _no("string"))).alias("publisher"),
        by_model(lambda s: default(s.recorded, _no("date")).cast("date")).alias("dateRecorded"),
        by_model(lambda s: default(s.observed, _no("date")).cast("date")).alias("observedDate"),
        by_model(_items).alias("items"),
    ).where(F.col("uri").isNotNull())
    # The outer form, since the inner one has the planner test the items' size on a second copy of them.
    rows = about.select("uri", "type", "source", "publisher", "dateRecorded", "observedDate", F.inline_outer("items"))
    return rows.where(F.col("value").isNotNull() | F.col("object_uri").isNotNull()).select(*STATEMENT_COLUMNS)
