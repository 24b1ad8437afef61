"""Contexts of matches against slices of the text, and their cost."""

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from threatlake.operators import extract as ex


@pytest.mark.parametrize("width", [0, 1, 20])
@pytest.mark.parametrize("pattern", [ex.CVE_PATTERN, ex.MSID_PATTERN, ex.EMAIL_PATTERN])
def test_contexts_are_slices(spark, pattern, width):
    rng = random.Random(width)
    bits = ["CVE-2014-1234", "cve-2017-0001234", "ms17-010", "a.b@c.org", "x@y", "\n", " ", "é", "\U0001f600", "(", "word", "cve-", "\\"]
    texts = ["".join(rng.choice(bits) + rng.choice(["", " "]) for _ in range(rng.randint(0, 60))) for _ in range(60)] + ["", "CVE-2014-1234", None]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    rows = df.select("i", ex.contexts(F.col("t"), ex.matches(F.col("t"), pattern), pattern, width).alias("c")).collect()
    for r in rows:
        t = texts[r["i"]] or ""
        want = [(m[1], t[max(m.start() - width, 0) : m.end() + width]) for m in re.finditer(pattern, t, re.A)]
        assert [tuple(x) for x in r["c"] or []] == want, t


def test_cost_follows_the_number_of_matches(spark):
    """Ten times the matches in one record take about ten times as long, not a hundred times."""

    def seconds(n):
        df = spark.range(1).select(F.repeat(F.lit("see CVE-2014-1234 now "), n).alias("t"))
        out = df.select(F.size(ex.contexts(F.col("t"), ex.matches(F.col("t"), ex.CVE_PATTERN), ex.CVE_PATTERN, 20)).alias("n"))
        started = time.perf_counter()
        assert out.head()["n"] == n
        return time.perf_counter() - started

    seconds(2000)
    few, many = min(seconds(20_000) for _ in range(2)), min(seconds(200_000) for _ in range(2))
    assert many < 25 * max(few, 0.1)
