"""Line-first quality rules.

Every line is judged by itself: navigation (a row of separators), boilerplate (a fixed
phrase), symbols (too many marks for its letters) and punctuation (many words without any
sentence mark). Lines that fail go; a document that loses more than ``max_loss`` of its
words that way is rejected, and so is one that fails the base limits.

Defined cases: a null text is judged as an empty one, which fails the base limit on words and stays null
when cleaned; lines without a word are neutral and stay; equal rows get equal results; an empty
table gives an empty result.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import add_struct, free_name

RULES = {
    "min_words": 50,  # base: fewer words fail
    "max_repeat": 50,  # base: percent of words in repeated windows
    "max_loss": 50,  # percent of the words that rejected lines may hold
    "nav_separators": 3,  # navigation: so many separators, and
    "nav_share": 20,  # so many for a hundred words
    "symbol_share": 10,  # symbols: marks among a hundred characters of words
    "min_symbols": 3,
    "unmarked_words": 12,  # punctuation: so many words without a sentence mark
}
#: Marks counted for the base column, and those that make a line noise.
BASE_SYMBOLS = b"#*$%&|<>"
NOISE = b"#*$%&|<>!^~={}\\"
SEPARATORS = re.compile("[|»›•·]|(?<= )>(?= )")
SENTENCE_MARK = re.compile("[.?!…:;,。！？،؟।]")
BOILERPLATE = re.compile(
    r"all rights reserved|terms (?:of (?:use|service)|and conditions)|privacy policy|cookie (?:policy|settings)|we use cookies"
    r"|enable javascript|skip to (?:main )?content|subscribe to our newsletter|share (?:this )?on (?:facebook|twitter)|lorem ipsum"
    r"|click here to|back to top",
    re.IGNORECASE,
)
KIND = T.StructType([
    *[T.StructField(n, T.LongType()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines_removed", "n_words_removed")],
    T.StructField("base_failed", T.BooleanType()), T.StructField("kept", T.BooleanType()), T.StructField("clean_text", T.StringType()),
])


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a window of three words found twice or more."""
    n = len(words)
    if n < 4:
        return 0
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, n)
    pairs = np.unique(ids[:-1] * len(known) + ids[1:], return_inverse=True)[1]
    _, which, counts = np.unique(pairs[:-1] * len(known) + ids[2:], return_inverse=True, return_counts=True)
    twice = counts[which] > 1
    inside = np.zeros(n, bool)
    for shift in range(3):
        inside[shift : n - 2 + shift] |= twice
    return int(inside.sum())


def failing_rule(line: str, raw: bytes, words: list[bytes], rules: dict) -> str | None:
    """The first rule that the line fails; a line has at least one word."""
    bars = len(SEPARATORS.findall(line))
    if bars >= rules["nav_separators"] and 100 * bars >= rules["nav_share"] * len(words):
        return "navigation"
    letters = sum(map(len, words))
    marks = letters - len(raw.translate(None, NOISE + b" \t\n\x0b\x0c\r"))
    if marks >= rules["min_symbols"] and 100 * marks > rules["symbol_share"] * letters:
        return "symbols"
    if BOILERPLATE.search(line):
        return "boilerplate"
    if len(words) >= rules["unmarked_words"] and not SENTENCE_MARK.search(line):
        return "punctuation"
    return None


def judge(text: str | None, rules: dict) -> tuple:
    """The fields of ``KIND`` for one text."""
    whole = (text or "").encode()
    words = whole.split()
    blanks = len(whole) - len(whole.translate(None, b" \t\n\x0b\x0c\r"))
    seen: set[str] = set()
    keep, dups, removed_lines, removed = [], 0, 0, 0
    for line in (text or "").split("\n"):
        raw = line.encode()
        own = raw.split()
        if own:
            dups += line in seen
            seen.add(line)
            if failing_rule(line, raw, own, rules):
                removed_lines += 1
                removed += len(own)
                continue
        keep.append(line)
    repeats = repeated_words(words)
    failed = len(words) < rules["min_words"] or 100 * repeats > rules["max_repeat"] * len(words)
    kept = not failed and 100 * removed <= rules["max_loss"] * len(words)
    clean = text if not removed_lines else "\n".join(keep)
    n_symbols = len(whole) - len(whole.translate(None, BASE_SYMBOLS))
    return len(words), len(text or "") - blanks, n_symbols, dups, repeats, removed_lines, removed, failed, kept, clean


def judged(docs: DataFrame, into: str | None = None, **rules) -> DataFrame:
    """``docs`` with a struct column of the counts, the verdict and the cleaned text."""
    settings = {**RULES, **rules}
    if unknown := set(settings) - set(RULES):
        raise ValueError(f"no such rule: {sorted(unknown)}")
    return add_struct(docs, "text", into or free_name(docs, "quality"), KIND, lambda text: judge(text, settings))


def cleaned(docs: DataFrame, **rules) -> DataFrame:
    """The documents that pass, without the lines that fail; ``n_chars`` follows the new text if there is one."""
    out = judged(docs, **rules)
    own = out.columns[-1]
    clean = out.where(F.col(f"{own}.kept")).withColumn("text", F.col(f"{own}.clean_text")).drop(own)
    return clean.withColumn("n_chars", F.length("text").cast("bigint")) if "n_chars" in docs.columns else clean
