"""Text columns: normalising, phrase tests, cleaning and list rendering."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


#: A letter that no phrase has: it stays when a text is normalised.
BREAK = "\ua66e"


def normalise(text: Column) -> Column:
    """Lower-case letters and digits separated by single spaces."""
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def _spaced(text: Column) -> Column:
    return F.concat(F.lit(" "), text, F.lit(" "))


def contains_phrase(normalised: Column, phrase: Column) -> Column:
    """Whole-token phrase test; both sides already normalised."""
    return F.contains(_spaced(normalised), _spaced(phrase))


def match_phrase(text: Column, phrase: str | Column) -> Column:
    phrase = F.lit(phrase) if isinstance(phrase, str) else phrase
    return contains_phrase(normalise(text), normalise(phrase))


def phrase_count(normalised: Column, phrase: Column) -> Column:
    """Occurrences of a phrase, not counting overlaps.

    Every separating space is doubled first, so that two neighbouring
    occurrences do not have to share one.
    """
    wide = _spaced(F.replace(normalised, F.lit(" "), F.lit("  ")))
    needle = _spaced(F.replace(phrase, F.lit(" "), F.lit("  ")))
    removed = F.length(wide) - F.length(F.replace(wide, needle, F.lit("")))
    return F.floor(removed / F.length(needle))


def any_field(*fields: Column) -> Column:
    """All text fields as one, with a break that no phrase can cross."""
    return F.concat_ws(f" {BREAK} ", *fields)


def drop_blank_lines(text: Column) -> Column:
    """Strip each line, drop the empty ones, join the rest with ``' \\n '``."""
    lines = F.transform(F.split(text, "\n"), lambda line: F.regexp_replace(line, r"^\s+|\s+$", ""))
    return F.array_join(F.filter(lines, lambda line: F.length(line) > 0), " \n ")


def quoted_list(items: Column) -> Column:
    """Render an array of strings as ``u'a', u'b'``."""
    return F.array_join(F.transform(items, lambda x: F.concat(F.lit("u'"), x, F.lit("'"))), ", ")


def is_email(text: Column) -> Column:
    return F.contains(text, F.lit("@"))


def table_name(source: Column) -> Column:
    """Feed name as a table name."""
    return F.translate(source, "-", "_")


def numbered_user(text: Column) -> Column:
    """The number in ``user12``; null for anything else."""
    return F.when(F.startswith(text, F.lit("user")), F.substr(text, F.lit(5)).try_cast("bigint"))
