"""Operators over cases that they once left out."""

import random
import re

import pytest
from pyspark.sql import functions as F

from threatlake.llm import secret_scan, url_trust

LOWER, UPPER = "abcdefghijklmnopqrstuvwxyz0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
BASE64 = LOWER + UPPER[:26]


@pytest.mark.parametrize("kind, letters, size", [
    ("entropy_lower", LOWER, 32), ("entropy_upper", UPPER, 32), ("entropy_url", BASE64 + "-_", 43),
    ("entropy_lower", LOWER, 17), ("entropy_upper", UPPER, 16), ("entropy_base64", BASE64, 18), ("entropy_url", BASE64 + "-_", 19), ("entropy_hex", LOWER[:6] + LOWER[26:], 19),
])
def test_secrets_of_each_class_and_short_ones(kind, letters, size):
    rng, scanner, missed = random.Random(size), secret_scan.Scanner(secret_scan.CLASSES, secret_scan.ALLOW), 0
    for _ in range(200):
        token = ""
        while not re.search("[0-9][A-Za-z]", token):  # others are words with a number for the allow-list
            token = "".join(rng.choices(letters, k=size))
        missed += f"{kind}:4:" not in scanner.scan("key " + token)[4]
    assert missed <= 10, missed  # windows of a random token may be under the threshold


def test_secret_split_by_url_safe_characters():
    scanner = secret_scan.Scanner(secret_scan.CLASSES, secret_scan.ALLOW)
    assert scanner.scan("key aZ3kQ9xW-7bV1nM5t_R8yP2cD6")[4] == "entropy_url:4:30"


def test_slugs_paths_and_names_are_allowed():
    scanner = secret_scan.Scanner(secret_scan.CLASSES, secret_scan.ALLOW)
    for safe in ("an-article-about-spark-4-from-2024", "snake_case_identifier_v2_final", "docs/guide/page1/section2/figure12", "2024-01-15-release-notes"):
        assert scanner.scan(safe)[4] == "", safe


def test_distrust_reaches_far_hosts(spark):
    pages = spark.createDataFrame([(i, f"http://h{i}.net/", f"<a href='http://h{i + 1}.net/'>") for i in range(13)] + [(13, "http://h13.net/x", "")], "page_id long, url string, html string")
    out = {r.page_id: r.j for r in url_trust.judged(pages, [("block", "h13.net/")], "j").collect()}
    assert [out[i].verdict for i in range(14)] == ["block"] * 14
    assert all(out[i].distrust == pytest.approx(0.2 * 0.8 ** (13 - i)) for i in range(14))


def test_propagation_that_does_not_converge_fails(spark):
    edges = spark.createDataFrame([("k", str(i), str(i + 1), 1.0) for i in range(20)], "kind string, src string, dst string, weight double")
    seeds = spark.createDataFrame([("k", "0", 1.0)], "kind string, host string, mass double")
    with pytest.raises(RuntimeError):
        url_trust.propagate(edges, seeds, rounds=None, max_rounds=6)


def test_small_scores_stay(spark):
    got = spark.createDataFrame([(0.0,), (1 / 3 * 1e-15,), (2 / 3,)], "s double").select(url_trust.significant(F.col("s")).alias("s")).collect()
    assert [r.s for r in got] == [0.0, 3.33333333333e-16, 0.666666666667]
