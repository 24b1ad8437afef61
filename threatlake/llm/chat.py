"""Conversations as training text, from a declarative template, by a state machine over roles.

A template gives each role its opening and closing mark and whether its text is trained on, and the
machine's transitions. Formatting writes a row of segments for each conversation: a mark or a text, each with
its loss flag; the formatted text is their concatenation. Marks that occur inside texts are escaped by
one backslash more after their first character, which reading takes away again, so every
text comes back as it was. A conversation that breaks the turn order is formatted all the same;
``first_bad`` is the place of its first turn that the machine does not allow.

Defined cases: a null text or role is empty; turns are in order of turn, role, text, null first; equal
rows are turns of their own; rows without a conversation id are one conversation; an empty table gives an
empty result. A conversation's text is one value, so it has to fit in a row.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Role:
    opening: str
    closing: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    """Marks by role, marks for roles not listed, and the machine: (state, role) pairs by state."""

    roles: dict[str, Role] = field(default_factory=lambda: {
        "system": Role("<<SYS>>", "<</SYS>>"), "user": Role("[INST]", "[/INST]"), "assistant": Role("<s>", "</s>", loss=True),
    })
    other: tuple[str, str, str] = ("[ROLE]", "[/ROLE]", "[/TURN]")
    #: From a state, which is the last role, to the roles that may follow.
    follows: dict[str, tuple[str, ...]] = field(default_factory=lambda: {
        "": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",),
    })
    ends: tuple[str, ...] = ("assistant",)

    def marks(self) -> list[str]:
        return [m for r in self.roles.values() for m in (r.opening, r.closing)] + list(self.other)

    def check(self) -> None:
        """Refuse marks that could be mistaken: one inside another, or overlapping with one's end."""
        marks = self.marks()
        if len(set(marks)) < len(marks) or any(len(m) < 2 or "\\" in m for m in marks):
            raise ValueError("marks must differ, have two characters at least and no backslash")
        for a in marks:
            for b in marks:
                if a != b and a in b:
                    raise ValueError(f"{a!r} is part of {b!r}")
                if any(a[k:] == b[: len(a) - k] for k in range(1, len(a))):
                    raise ValueError(f"the end of {a!r} begins {b!r}")


def _quote(text: str) -> str:
    return re.sub(r"([^A-Za-z0-9_ ])", r"\\\1", text)


def _patterns(template: Template) -> tuple[str, str]:
    """Patterns of a mark with any, and with at least one, backslash after its first character."""
    firsts = "".join(sorted({_quote(m[0]) for m in template.marks()}))
    rests = "|".join(_quote(m[1:]) for m in sorted(template.marks(), key=len, reverse=True))
    return f"([{firsts}])(\\\\*)({rests})", f"([{firsts}])\\\\(\\\\*)({rests})"


def escaped(text: Column, template: Template) -> Column:
    return F.regexp_replace(text, _patterns(template)[0], "$1\\\\$2$3")


def unescaped(text: Column, template: Template) -> Column:
    return F.regexp_replace(text, _patterns(template)[1], "$1$2$3")


def turns(rows: DataFrame) -> DataFrame:
    """``conv_id, turns``: each conversation's roles and texts in order."""
    turn = F.struct(F.col("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))


def _segment(text: Column, loss: Column) -> Column:
    return F.struct(text.alias("text"), loss.alias("loss"))


def _turn_segments(turn: Column, template: Template) -> Column:
    """The segments of one turn: opening, text, closing."""
    no = F.lit(False)
    opening = F.concat(F.lit(template.other[0]), escaped(turn["role"], template), F.lit(template.other[1]))
    closing, loss = F.lit(template.other[2]), no
    for name, role in template.roles.items():
        is_it = turn["role"] == name
        opening = F.when(is_it, F.lit(role.opening)).otherwise(opening)
        closing = F.when(is_it, F.lit(role.closing)).otherwise(closing)
        loss = loss | (is_it & F.lit(role.loss))
    return F.array(_segment(opening, no), _segment(escaped(turn["text"], template), loss), _segment(closing, no))


def _machine(template: Template) -> tuple[Column, Column]:
    """The place of the first turn not allowed, from 0, and whether the last state is an end."""
    allowed = F.array(*[F.lit(f"{a}\n{b}") for a, roles in template.follows.items() for b in roles])
    start = F.struct(F.lit("").alias("state"), F.lit(0).alias("at"), F.lit(-1).alias("bad"))

    def step(state: Column, turn: Column) -> Column:
        good = F.array_contains(allowed, F.concat_ws("\n", state["state"], turn["role"]))
        bad = F.when((state["bad"] < 0) & ~good, state["at"]).otherwise(state["bad"])
        return F.struct(turn["role"].alias("state"), (state["at"] + 1).alias("at"), bad.alias("bad"))

    end = F.aggregate("turns", start, step)
    return F.when(end["bad"] >= 0, end["bad"]), end["state"].isin(*template.ends)


def formatted(rows: DataFrame, template: Template = Template()) -> DataFrame:
    """``conv_id, segments, formatted, first_bad, ended``, one row for each conversation."""
    template.check()
    whole = turns(rows)
    first_bad, ended = _machine(template)
    segments = F.flatten(F.transform("turns", lambda t: _turn_segments(t, template)))
    out = whole.select("conv_id", segments.alias("segments"), first_bad.alias("first_bad"), ended.alias("ended"))
    return out.withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), ""))


def segment_rows(conversations: DataFrame) -> DataFrame:
    """The segments of ``formatted`` as rows: ``conv_id, segment, text, loss``."""
    return conversations.select("conv_id", F.posexplode("segments").alias("segment", "_s")).select("conv_id", "segment", "_s.text", "_s.loss")


def read_turns(text: Column, template: Template = Template()) -> Column:
    """The turns written in a formatted text: an array of role and text."""
    closing = [r.closing for r in template.roles.values()] + [template.other[2]]
    parts = F.split(text, "(?<=" + "|".join(map(_quote, closing)) + ")")

    def turn(part: Column) -> Column:
        first, second, last = template.other
        name = F.substring_index(F.substr(part, F.lit(len(first) + 1)), second, 1)
        begin, end = F.lit(len(first) + len(second) + 1) + F.length(name), F.lit(len(last))
        role = unescaped(name, template)
        for known, marks in template.roles.items():
            is_it = F.startswith(part, F.lit(marks.opening))
            role = F.when(is_it, F.lit(known)).otherwise(role)
            begin = F.when(is_it, F.lit(len(marks.opening) + 1)).otherwise(begin)
            end = F.when(is_it, F.lit(len(marks.closing))).otherwise(end)
        body = F.substr(part, begin, F.length(part) - end - begin + 1)
        return F.struct(role.alias("role"), unescaped(body, template).alias("text"))

    return F.transform(F.filter(parts, lambda p: p != ""), turn)


def read_loss(segments: Column, template: Template = Template()) -> Column:
    """All text under the loss mask."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescaped(s["text"], template)), "")
