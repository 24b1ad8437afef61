"""Secrets in texts: fixed patterns, and strings of high entropy.

The entropy method takes maximal runs of a class's characters as candidates, slides a
window over each, and keeps the window's character counts and the sum of c·log2(c) by
adding one character and taking one away. Windows whose Shannon entropy reaches the
class's threshold are joined to a span, unless an allow-list pattern fits the whole candidate.
Candidates under the window's width get a shorter one with its own threshold; those of less than 16
characters are not looked at. A candidate needs a letter and a digit, in whatever case.

Spans are in code points, end exclusive. Defined cases: a null text is empty; overlapping spans of
different kinds all count; equal rows get equal results; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import add_struct, free_name

KINDS = ("assign", "access", "hex", "entropy_hex", "entropy_base64", "entropy_lower", "entropy_upper", "entropy_url")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
ASSIGN_HINTS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
LETTER_DIGIT = (r"[0-9]", r"[A-Za-z]")
#: Class: its characters, windows (width, least entropy in bits) from the widest, and what a candidate must hold besides.
#: About one random window in a hundred is under the new thresholds, and of hexadecimal ones at most one in twenty.
CLASSES = {
    "entropy_hex": (b"0123456789abcdefABCDEF", ((20, 3.0), (16, 2.8)), (r"[0-9]", r"[A-Fa-f]")),
    "entropy_base64": (b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/=", ((20, 3.7), (16, 3.35)), LETTER_DIGIT),
    "entropy_lower": (b"abcdefghijklmnopqrstuvwxyz0123456789", ((20, 3.35), (16, 3.1)), LETTER_DIGIT),
    "entropy_upper": (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", ((20, 3.3), (16, 3.05)), LETTER_DIGIT),
    "entropy_url": (b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_", ((20, 3.6), (16, 3.35)), LETTER_DIGIT),
}
#: A part of a name; a random part of mixed case does not fit.
WORD = r"(?:(?:[A-Z]?[a-z]+|[A-Z]+)[0-9]{0,4}|[0-9]{1,4})"
#: Candidates that are not secrets though their characters are mixed: among them words and short numbers joined by "-", "_" or "/".
ALLOW = (
    r"[A-Za-z]+[0-9]{1,4}", r"[A-Za-z]+", r"[0-9]+", r"(?:https?|www|ftp)[A-Za-z0-9+/=]*", r"/(?:[a-z0-9]+/)+[a-z0-9]*",
    r"(.)\1+", r"(?:0123456789abcdef|ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789\+/)+",
    rf"[-_/]*{WORD}(?:[-_/]+{WORD})+[-_/]*",
)
KIND = T.StructType([
    *[T.StructField(n, T.LongType()) for n in ("n_assign", "n_access", "n_hex")],
    T.StructField("base", T.StringType()), T.StructField("spans", T.StringType()),
])


def windows(run: str, width: int, least: float) -> list[tuple[int, int]]:
    """Joined windows of ``run`` whose entropy is at least ``least`` bits a character."""
    if len(run) < width:
        return []
    bits = [0.0] + [c * math.log2(c) for c in range(1, width + 1)]
    counts: dict[str, int] = {}
    total, spans = 0.0, []
    for i, new in enumerate(run):
        if i >= width:
            c = counts[run[i - width]]
            counts[run[i - width]] = c - 1
            total += bits[c - 1] - bits[c]
        c = counts.get(new, 0)
        counts[new] = c + 1
        total += bits[c + 1] - bits[c]
        if i >= width - 1 and math.log2(width) - total / width >= least - 1e-9:
            start = i - width + 1
            if spans and start <= spans[-1][1]:
                spans[-1] = (spans[-1][0], i + 1)
            else:
                spans.append((start, i + 1))
    return spans


class Scanner:
    """Compiled once for a task."""

    def __init__(self, classes: dict, allow: tuple[str, ...]):
        self.allow = re.compile("|".join(f"(?:{p})" for p in allow)) if allow else None
        self.classes = []
        for kind, (letters, widths, needs) in classes.items():
            table = bytes(1 if b in letters else 0 for b in range(256))
            shortest = widths[-1][0]
            run = re.compile("[" + re.escape(letters.decode()) + "]{%d,}+" % shortest)
            self.classes.append((kind, table, b"\x01" * shortest, run, widths, [re.compile(n) for n in needs]))

    def base(self, text: str, raw: bytes) -> list[tuple[int, int, int]]:
        """(start, kind, end) of the fixed patterns."""
        found = []
        low = raw.lower()
        if any(h in low for h in ASSIGN_HINTS):
            found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
        if b"AKIA" in raw:
            found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
        if b"\x01" * 24 in raw.translate(HEX_TABLE):
            found += [(m.start(), 2, m.end()) for m in HEX.finditer(text) if m.end() - m.start() >= 24]
        return sorted(found)

    def entropy(self, text: str, raw: bytes) -> list[tuple[int, int, int]]:
        found = []
        for kind, table, full, run, widths, needs in self.classes:
            if full not in raw.translate(table):
                continue
            for m in run.finditer(text):
                own = m[0]
                if all(n.search(own) for n in needs) and not (self.allow and self.allow.fullmatch(own)):
                    width, least = next(w for w in widths if w[0] <= len(own))
                    found += [(m.start() + a, KINDS.index(kind), m.start() + b) for a, b in windows(own, width, least)]
        return found

    def scan(self, text: str | None) -> tuple:
        text = text or ""
        raw = text.encode()
        base = self.base(text, raw)
        every = sorted([*base, *self.entropy(text, raw)])
        joined = [",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans) for spans in (base, every)]
        return *(sum(k == n for _, k, _ in base) for n in range(3)), *joined


HEX_TABLE = bytes(1 if b in b"0123456789abcdef" else 0 for b in range(256))


def scanned(docs: DataFrame, into: str | None = None, classes: dict = CLASSES, allow: tuple[str, ...] = ALLOW) -> DataFrame:
    """``docs`` with a struct column: counts by base kind, base spans and all spans as text."""
    return add_struct(docs, "text", into or free_name(docs, "secrets"), KIND, lambda text, scanner: scanner.scan(text), lambda: Scanner(classes, allow))
