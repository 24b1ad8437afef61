"""Scores on convergence, against a dense solve and closed forms."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from threatlake.llm import url_trust

EDGES, SEEDS = "kind string, src string, dst string, weight double", "kind string, host string, mass double"


def solve(edges, seeds, damping=0.8):
    """Kind to host to score, by a linear system."""
    out = {}
    for kind in {k for k, *_ in edges} | {k for k, *_ in seeds}:
        names = sorted({x for k, a, b, _ in edges if k == kind for x in (a, b)} | {h for k, h, _ in seeds if k == kind})
        at = {x: i for i, x in enumerate(names)}
        step = np.zeros((len(names), len(names)))
        for k, a, b, w in edges:
            if k == kind:
                step[at[b], at[a]] += w
        step = damping * step / np.maximum(step.sum(axis=0), 1e-300)
        base = np.zeros(len(names))
        for k, h, m in seeds:
            if k == kind:
                base[at[h]] += (1 - damping) * m
        out[kind] = dict(zip(names, np.linalg.solve(np.eye(len(names)) - step, base)))
    return out


@pytest.mark.parametrize("block_hosts", [1 << 14, 6])
def test_converged_equals_a_dense_solve(spark, block_hosts):
    rng = random.Random(8)
    hosts = [f"{x}.d{i}.net" for i in range(4) for x in "abcdefg"[: 2 + i]] + [f"h{i}.hot.org" for i in range(12)]
    edges = [(k, *rng.sample(hosts, 2), float(rng.randint(1, 4))) for k in ("allow", "block") for _ in range(50)]
    edges = list({e[:3]: e for e in edges}.values())
    seeds = [("allow", hosts[0], 2.0), ("allow", hosts[9], 1.0), ("block", hosts[3], 3.0), ("block", "lonely.net", 1.0)]
    df, start = spark.createDataFrame(edges, EDGES), spark.createDataFrame(seeds, SEEDS)
    got = {(r.kind, r.host): r.score for r in url_trust.converged(df, start, tolerance=1e-4 if block_hosts == 6 else 1e-6, block_hosts=block_hosts).collect()}
    want = {(k, h): s for k, own in solve(edges, seeds).items() for h, s in own.items() if s > 1e-15}
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k], rel=2e-3 if block_hosts == 6 else 1e-6) for k in want)
    assert url_trust.converged(df, start.limit(0)).count() == 0 and url_trust.converged(df.limit(0), start).count() == 4


def test_a_chain_of_2500_hosts(spark):
    edges = spark.range(2499).select(F.lit("k").alias("kind"), F.concat(F.lit("h"), "id").alias("src"), F.concat(F.lit("h"), F.col("id") + 1).alias("dst"), F.lit(1.0).alias("weight"))
    got = {r.host: r.score for r in url_trust.converged(edges, spark.createDataFrame([("k", "h0", 1.0)], SEEDS)).collect()}
    assert len(got) == 2500 and all(got[f"h{i}"] == pytest.approx(0.2 * 0.8**i, rel=1e-9) for i in range(2500))


def test_hosts_of_a_domain_share_a_block_unless_it_is_large(spark):
    hosts = spark.createDataFrame([(f"x{i}.a.net", 1) for i in range(50)] + [(f"x{i}.b.net", 4) for i in range(50)], "host string, parts int")
    rows = hosts.select(url_trust.domain(F.col("host")).alias("d"), url_trust.block_of(F.col("host"), F.col("parts"), 1000).alias("b")).distinct().groupBy("d").count().collect()
    assert {r["d"]: r["count"] for r in rows} == {"a.net": 1, "b.net": 4}
