"""What is in the records: attribute paths, schemas, properties per type."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.json import JSON_TYPE, is_array, is_object
from ..session import cut_lineage

# Fixed value: an attribute that is listed but not looked into.
LEAVES = {"affected_products"}


def attribute_paths(cdr: DataFrame) -> DataFrame:
    """Distinct attribute paths per feed: ``(source_name, path)``.

    Objects nest without a bound, so they are opened level by level until none is left:
    a level's inner objects, and the objects of its lists, are the next one's input. Each level is
    written to the shared folder, and a path is distinct before it leaves its level.
    """
    rep = F.try_parse_json("raw_content")
    level = cdr.where(F.col("content_type") == JSON_TYPE).select("source_name", F.lit("").alias("prefix"), rep.alias("object"))
    level, found = level.where(is_object(F.col("object"))), []
    while True:
        opened = _opened(level).select("source_name", F.concat("prefix", "key").alias("path"), "key", "value")
        leaf = F.col("key").isin(*sorted(LEAVES))
        inner, listed = is_object(F.col("value")), is_array(F.col("value"))
        found.append(opened.where(leaf | ~(inner | listed)).select("source_name", "path").distinct())
        below = opened.where(~leaf).select("source_name", F.concat("path", F.lit(".")).alias("prefix"), F.col("value").alias("object"))
        items = _opened(below.where(is_array(F.col("object")))).select("source_name", "prefix", F.col("value").alias("object"))
        level = cut_lineage(below.unionByName(items).where(is_object(F.col("object"))))
        if level.isEmpty():
            return reduce(DataFrame.unionByName, found).distinct()


def _opened(rows: DataFrame) -> DataFrame:
    """The entries of each row's ``object``, or the items of its list, which have no key."""
    return rows.lateralJoin(rows.sparkSession.tvf.variant_explode(F.col("object").outer()))


def observed(rows: DataFrame, name: str, **metrics: Column) -> tuple[DataFrame, Observation]:
    """Count rows, and more if asked, while another action runs over them.

    Read the numbers with ``Observation.get`` after that action; no job of its own
    is needed for them.
    """
    seen = Observation(name)
    return rows.observe(seen, F.count(F.lit(1)).alias("rows"), *[m.alias(n) for n, m in metrics.items()]), seen


def source_schemas(cdr_with_json: DataFrame) -> DataFrame:
    """The merged JSON schema of each feed."""
    return cdr_with_json.where(F.col("json_rep").isNotNull()).groupBy("source_name").agg(
        F.schema_of_variant_agg("json_rep").alias("schema")
    )


def shared_attributes(paths: DataFrame) -> DataFrame:
    """All attributes with the feeds that have them; at most one entry per feed."""
    return paths.groupBy("path").agg(
        F.count("*").alias("sources"), F.array_sort(F.collect_list("source_name")).alias("source_names")
    )


def properties_per_type(statements: DataFrame) -> DataFrame:
    """Properties of each type, made distinct before they are listed."""
    pairs = statements.where(F.col("property") != "a").select("type", "property").distinct()
    return pairs.groupBy("type").agg(
        F.array_sort(F.collect_list("property")).alias("properties"), F.count("*").alias("n_properties")
    )


def unique_properties(statements: DataFrame) -> DataFrame:
    return statements.where(F.col("property") != "a").agg(F.countDistinct("property").alias("n_properties"))
