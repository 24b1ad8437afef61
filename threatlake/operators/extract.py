"""Identifier extraction in one pass over the records."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.json import is_array, strings_at
from ..functions.text import drop_blank_lines

# The identifier patterns and, per feed, the field they read.
CVE_PATTERN = r"(?i)(cve-[0-9]{4}-[0-9]{4,7})"
MSID_PATTERN = r"(?i)(ms[0-9]{2}-[0-9]{3})"
EMAIL_PATTERN = r"([A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+)"
SOURCE_FIELDS = {"hg-blogs": "text", "isi-news": "readable_text"}
# Feeds whose text goes to entity recognition, with content type and field.
ENTITY_FIELDS = {
    "hg-blogs": ("Blog", "text"),
    "asu-twitter": ("SocialMediaPosting", "tweetContent"),
    "isi-twitter": ("SocialMediaPosting", "tweetContent"),
    "isi-news": ("NewsArticle", "readable_text"),
}


@dataclass(frozen=True)
class ExtractorSpec:
    """One extractor: what to find, where to read it, where to put it.

    ``fields`` maps a feed to the JSON path to read; other feeds read ``default``,
    a column or, with ``json:`` in front, a JSON path.
    """

    name: str
    pattern: str
    output: str
    fields: Mapping[str, str] = field(default_factory=dict)
    default: str = "raw_content"
    context: int = 20


CVE = ExtractorSpec("cve-regex", CVE_PATTERN, "cve", SOURCE_FIELDS)
MSID = ExtractorSpec("msid-regex", MSID_PATTERN, "msid", SOURCE_FIELDS)
EMAIL = ExtractorSpec("email-regex", EMAIL_PATTERN, "email", default="json:postContent")


def matches(text: Column, pattern: str) -> Column:
    """All matches of a pattern whose first group is the match."""
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(1))


def contexts(text: Column, values: Column, pattern: str, width: int) -> Column:
    """The matches ``values`` as ``ARRAY<STRUCT<value, context>>``, ``width`` characters each way.

    What follows a match is captured by looking ahead, which takes nothing from the next match. What precedes it is the end of
    the last few pieces between and of matches, as many as can be needed. So each match costs the same,
    however many there are. Text without matches is not looked at again.
    """
    if not width:
        return F.transform(values, lambda v: F.struct(v.alias("value"), v.alias("context")))
    after = F.regexp_extract_all(text, F.lit(rf"(?=((?:{pattern})(?s:.{{0,{width}}})))(?:{pattern})"), F.lit(1))
    gaps = F.transform(F.split(text, pattern, -1), lambda g: F.right(g, F.lit(width)))
    pieces = F.zip_with(F.slice(gaps, 1, F.size(values)), values, lambda g, v: F.concat(g, v))
    few = F.ceil(F.lit(width) / F.array_min(F.transform(values, F.length))).cast("int")

    # Bound to a variable: an expression inside a function of the elements would be computed for each of them.
    bound = F.array(F.struct(pieces.alias("pieces"), gaps.alias("gaps"), values.alias("values"), few.alias("few")))

    def described(held: Column) -> Column:
        def one(found: Column, i: Column) -> Column:
            earlier = F.slice(held["pieces"], F.greatest(i - held["few"], F.lit(0)) + 1, F.least(i, held["few"]))
            before = F.right(F.concat(F.array_join(earlier, ""), F.get(held["gaps"], i)), F.lit(width))
            return F.struct(F.get(held["values"], i).alias("value"), F.concat(before, found).alias("context"))

        return F.transform(after, one)

    empty = F.array().cast("array<struct<value:string,context:string>>")
    return F.when(F.size(values) > 0, F.transform(bound, described)[0]).otherwise(empty)


def _json_text(path: str) -> Column:
    """Text at a path; a list of texts is read as lines."""
    return F.array_join(strings_at(F.col("json_rep"), "$." + path), "\n")


def input_text(spec: ExtractorSpec) -> Column:
    rest = _json_text(spec.default[5:]) if spec.default.startswith("json:") else F.col(spec.default)
    chosen = None
    for source, path in spec.fields.items():
        is_source = F.col("source_name") == source
        chosen = F.when(is_source, _json_text(path)) if chosen is None else chosen.when(is_source, _json_text(path))
    return rest if chosen is None else chosen.otherwise(rest)


def _input_field(spec: ExtractorSpec) -> Column:
    chosen = F.lit(spec.default.removeprefix("json:"))
    for source, path in spec.fields.items():
        chosen = F.when(F.col("source_name") == source, F.lit("json_rep." + path)).otherwise(chosen)
    return chosen


def _described(spec: ExtractorSpec):
    """Add the extractor's name and the field read to a match."""
    where = _input_field(spec)

    def describe(hit: Column) -> Column:
        return F.struct(
            hit["value"].alias("value"), hit["context"].alias("context"), F.lit(spec.name).alias("extractor"), where.alias("field")
        )

    return describe


def extract(cdr: DataFrame, *specs: ExtractorSpec) -> DataFrame:
    """Add ``extractions``, a struct with one array per extractor.

    The route from feed to field is a column expression, so all feeds are read
    in one pass. Needs ``json_rep`` where a spec reads a JSON path.
    """
    # Input and matches get columns of their own, so that each is computed once for its many uses.
    named = cdr.withColumns({f"_in_{s.output}": input_text(s) for s in specs}).withColumns(
        {f"_hits_{s.output}": matches(F.col(f"_in_{s.output}"), s.pattern) for s in specs}
    )
    found = [
        F.transform(
            contexts(F.col(f"_in_{s.output}"), F.col(f"_hits_{s.output}"), s.pattern, s.context), _described(s)
        ).alias(s.output)
        for s in specs
    ]
    helpers = [f"_{kind}_{s.output}" for s in specs for kind in ("in", "hits")]
    return named.withColumn("extractions", F.struct(*found)).drop(*helpers)


def extraction_rows(records: DataFrame, *outputs: str) -> DataFrame:
    """One row per extracted identifier: ``(_id, source_name, kind, value, context, extractor, field)``."""
    columns = ("value", "context", "extractor", "field")

    def tagged(output: str) -> Column:
        kind = F.lit(output).alias("kind")
        return F.transform(f"extractions.{output}", lambda h: F.struct(kind, *[h[c].alias(c) for c in columns]))

    # The outer form, since the inner one has the planner test the size on a second copy of the extraction.
    rows = records.select("_id", "source_name", F.inline_outer(F.concat(*[tagged(o) for o in outputs])))
    return rows.where(F.col("value").isNotNull())


def cleaned_text(path: str) -> Column:
    """Text, or list of texts, at a JSON path without blank lines; null when empty."""
    value = F.try_variant_get("json_rep", "$." + path, "variant")
    cleaned = F.transform(strings_at(F.col("json_rep"), "$." + path), drop_blank_lines)
    return F.when(is_array(value), cleaned).otherwise(F.filter(cleaned, lambda t: F.length(t) > 0))


def entity_inputs(cdr: DataFrame) -> DataFrame:
    """Records that go to entity recognition: ``(_id, source_name, content_type, field, text)``."""
    kind, name, text = F.lit(None), F.lit(None), F.lit(None)
    for source, (content, path) in ENTITY_FIELDS.items():
        here = F.col("source_name") == source
        kind = F.when(here, F.lit(content)).otherwise(kind)
        name = F.when(here, F.lit("json_rep." + path)).otherwise(name)
        text = F.when(here, F.array_join(cleaned_text(path), "\n")).otherwise(text)
    routed = cdr.where(F.col("source_name").isin(*ENTITY_FIELDS))
    return routed.select("_id", "source_name", kind.alias("content_type"), name.alias("field"), text.alias("text")).where(
        F.length("text") > 0
    )
