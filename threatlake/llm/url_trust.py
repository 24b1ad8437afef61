"""URL verdicts from rules, and from trust and distrust passed along host edges.

A rule names a host with all its subdomains and the beginning of a path; the longest that fits
a URL decides. Pages without a rule get their host's verdict. Hosts are seeds by the
count of their allowed and of their blocked pages, so both scores are on one scale. Trust follows the edges from trusted
seeds (personalised PageRank), distrust runs against them from blocked seeds: a host that
links to a distrusted one is distrusted. A host is blocked where distrust holds
more than ``threshold`` of its score. Scores are passed on until they converge; a chain of links may have any length.

Edges are links to other hosts, counted, and one each way between a host and its parent domain.

Defined cases: a URL that is null or has no ``://`` has an empty host and path, no rule and verdict
allow; a host without any score is allowed; a null html has no links; hosts over 253
characters, which no name server knows, and addresses have no parent domain; equal rows get equal
results; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, scratch_path
from .common import LOWER, UPPER, drop_path, free_name

ALLOW, BLOCK = "allow", "block"
LINK = r"""(?i)\b(?:href|src)\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s<>]+)"""
#: Copies of a host's score in the join with its edges, so that a host with most edges is no single key.
SALTS = 8
#: Hosts, about, that one task passes scores on among.
BLOCK_HOSTS = 1 << 14


def parts(url: Column) -> tuple[Column, Column]:
    """Host and path of a URL."""
    rest = F.when(F.contains(url, F.lit("://")), F.substr(url, F.instr(url, "://") + 3))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def rule_for(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; ``rules`` are (verdict, host with path)."""
    rule = verdict = F.lit(None).cast("string")
    for kind, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):  # the last to fit wins
        name, slash, rest = text.partition("/")
        own = (host == name) | F.endswith(host, F.lit("." + name))
        fits = own & F.startswith(path, F.lit(slash + rest))
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def link_edges(pages: DataFrame) -> DataFrame:
    """``src, dst, weight``: links from one host to another, counted. ``pages`` has host and html."""
    found = pages.select(F.col("host").alias("src"), F.explode_outer(F.regexp_extract_all("html", F.lit(LINK), 1)).alias("_to")).where(F.col("_to").isNotNull())
    name = F.translate(F.regexp_replace(F.regexp_replace("_to", r"^.*@", ""), r":\d*$", ""), UPPER, LOWER)
    links = found.select("src", name.alias("dst")).where("src != '' and dst != '' and src != dst")
    return links.groupBy("src", "dst").agg(F.count("*").cast("double").alias("weight"))


def parent_edges(hosts: DataFrame) -> DataFrame:
    """One edge each way between every host and its parent domain, up to two labels."""
    labels = F.split("host", r"\.")
    named = hosts.where((F.length("host") <= 253) & ~F.col("host").rlike(r"^[0-9.:\[\]]*$")).select(labels.alias("_l"))
    steps = F.sequence(F.lit(1), F.size("_l") - 2)
    ups = named.where(F.size("_l") > 2).select("_l", F.explode(steps).alias("_k"))

    def tail(k: Column) -> Column:
        return F.array_join(F.slice("_l", k, F.size("_l")), ".")

    pairs = ups.select(tail(F.col("_k")).alias("a"), tail(F.col("_k") + 1).alias("b")).distinct()
    one = F.lit(1.0).alias("weight")
    return pairs.select(F.col("a").alias("src"), F.col("b").alias("dst"), one).unionByName(pairs.select(F.col("b").alias("src"), F.col("a").alias("dst"), one))


def propagate(
    edges: DataFrame, seeds: DataFrame, damping: float = 0.8, rounds: int | None = 9, checkpoint_every: int = 3, tolerance: float = 1e-6, max_rounds: int = 2000
) -> DataFrame:
    """Scores ``kind, host, score`` from the seeds ``kind, host, mass``, after ``rounds`` steps or, with None, on convergence.

    ``edges`` are ``kind, src, dst, weight``; a host passes ``damping`` of its score on, by weight.
    Both kinds run in one pass. What later rounds would add is less than damping ** rounds. Scores only
    grow, and have converged when none grew by more than ``tolerance`` of itself since the last
    checkpoint: a host reached since then has grown by all of its score, so every host that has a path from a
    seed is reached. More than ``max_rounds`` rounds are an error.
    """
    out = edges.groupBy("kind", "src").agg(F.sum("weight").alias("_out"))
    salt = F.pmod(F.xxhash64("dst"), F.lit(SALTS)).alias("_salt")
    moves = cut_lineage(edges.join(out, ["kind", "src"]).select("kind", "src", "dst", salt, (F.col("weight") / F.col("_out") * damping).alias("_p")))
    start = cut_lineage(seeds.select("kind", "host", (F.col("mass") * (1 - damping)).alias("score")))
    score = start
    k, before = 0, start
    while k != rounds:
        salted = score.select("kind", F.col("host").alias("src"), "score", F.explode(F.expr(f"sequence(0L, {SALTS - 1}L)")).alias("_salt"))
        moved = moves.join(salted, ["kind", "src", "_salt"]).select("kind", F.col("dst").alias("host"), (F.col("score") * F.col("_p")).alias("score"))
        score = moved.unionByName(start).groupBy("kind", "host").agg(F.sum("score").alias("score"))
        k += 1
        if k % checkpoint_every == 0 or k == rounds:
            score = cut_lineage(score)
            if rounds is None:
                if growth(score, before) <= tolerance:
                    break
                if k >= max_rounds:
                    raise RuntimeError(f"host scores have not converged after {k} rounds")
                before = score
    return score


def growth(score: DataFrame, before: DataFrame) -> float:
    """The largest part of a score that came since ``before``."""
    old = before.select("kind", "host", F.col("score").alias("_old"))
    part = (F.col("score") - F.coalesce("_old", F.lit(0.0))) / F.nullif("score", F.lit(0.0))
    return score.join(old, ["kind", "host"], "left").agg(F.max(part).alias("part")).head()["part"] or 0.0


def domain(host: Column) -> Column:
    """The last two labels of a host: the edges between a host and its parents stay within."""
    return F.substring_index(host, ".", -2)


def block_of(host: Column, parts: Column, blocks: int) -> Column:
    """The block of a host: those of its domain, or of one of the parts of a domain that has more hosts than a block."""
    return F.pmod(F.xxhash64(domain(host), F.pmod(F.xxhash64(host), parts)), F.lit(blocks)).cast("int")


def _solve(rows: pd.DataFrame, least: float) -> pd.DataFrame:
    """What the hosts of one block get in all from what came in, over the block's own edges.

    Steps go on until no host gets more than ``least`` of what it has. As a step keeps less than all, and a host without any
    gets all, that is after as many steps as the longest path has, and some.
    """
    out = []
    rows = rows.sort_values(["kind", "src", "dst"], na_position="first")  # sums in one order, however the rows came
    for kind, own in rows.groupby("kind", sort=True):
        given, edges = own[own["dst"].isna()], own[own["dst"].notna()]
        names = pd.Index(pd.unique(pd.concat([own["src"], edges["dst"]])))
        a, b, p = names.get_indexer(edges["src"]), names.get_indexer(edges["dst"]), edges["value"].to_numpy()
        left = np.bincount(names.get_indexer(given["src"]), given["value"].to_numpy(), len(names))
        got = np.zeros(len(names))
        while (left > least * got).any():
            got += left
            left = np.bincount(b, left[a] * p, len(names))
        held = got > 0
        out.append(pd.DataFrame({"kind": kind, "host": names[held], "score": got[held]}))
    return pd.concat(out) if out else pd.DataFrame({"kind": [], "host": [], "score": []})


def _stored(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def converged(edges: DataFrame, seeds: DataFrame, damping: float = 0.8, tolerance: float = 1e-6, block_hosts: int = BLOCK_HOSTS) -> DataFrame:
    """Scores ``kind, host, score`` as ``propagate`` gives them after all its rounds.

    Hosts are dealt into blocks of about ``block_hosts``, domain by domain. What comes into a block is passed on within it
    to the end in one task; then what its hosts have got crosses to other blocks, over edges that Spark
    joins. The next round takes only hosts to which more than ``tolerance`` of their score is still undelivered; what
    is less is kept until it is more. So the work of a round shrinks with what is open, a host reached for the first time always counts,
    and rounds follow the blocks that a path crosses, not its hosts.
    """
    spark = edges.sparkSession
    hosts = edges.select(F.explode(F.array("src", "dst")).alias("host")).unionByName(seeds.select("host")).distinct()
    per_domain = hosts.groupBy(domain(F.col("host")).alias("domain")).agg(F.count("*").alias("n"))
    sizes, sizes_path = _stored(per_domain, "domains")
    blocks = max(1, -(-(sizes.agg(F.sum("n").alias("n")).head()["n"] or 0) // block_hosts))
    # At most one domain for each block.
    large = sizes.where(F.col("n") > block_hosts).select("domain", F.ceil(F.col("n") / block_hosts).alias("parts"))

    def dealt(df: DataFrame, host: str, name: str) -> DataFrame:
        split = large.select(F.col("domain").alias("_domain"), F.col("parts").alias("_parts"))
        met = df.join(split, domain(F.col(host)) == F.col("_domain"), "left")
        return met.withColumn(name, block_of(F.col(host), F.coalesce("_parts", F.lit(1)), blocks)).drop("_domain", "_parts")

    out = edges.groupBy("kind", "src").agg(F.sum("weight").alias("_out"))
    shares = edges.join(out, ["kind", "src"]).select("kind", "src", "dst", (F.col("weight") / F.col("_out") * damping).alias("value"))
    moves, moves_path = _stored(dealt(dealt(shares, "src", "block"), "dst", "_to"), "moves")
    inner = moves.where(F.col("block") == F.col("_to")).select("block", "kind", "src", "dst", "value")
    outer = moves.where(F.col("block") != F.col("_to")).select("kind", "src", "dst", "value")

    def solved(given: DataFrame) -> DataFrame:
        """What hosts get of ``kind, host, mass`` within their blocks; blocks that get nothing have no task."""
        come = dealt(given, "host", "block").select("block", "kind", F.col("host").alias("src"), F.lit(None).cast("string").alias("dst"), F.col("mass").alias("value"))
        own = inner.join(come.select("block").distinct(), "block", "left_semi")
        least = tolerance / 1000
        return come.unionByName(own).groupBy("block").applyInPandas(lambda rows: _solve(rows[["kind", "src", "dst", "value"]], least), "kind string, host string, score double")

    start = seeds.groupBy("kind", "host").agg((F.sum("mass") * (1 - damping)).alias("mass")).where("mass > 0")
    gained, path = _stored(solved(start), "gained")
    score, waiting, written = gained, None, [path]
    while not outer.isEmpty():
        sent = gained.withColumnRenamed("host", "src").join(outer, ["kind", "src"]).select("kind", F.col("dst").alias("host"), (F.col("score") * F.col("value")).alias("mass"))
        sent = sent if waiting is None else sent.unionByName(waiting)
        mass = sent.groupBy("kind", "host").agg(F.sum("mass").alias("mass")).where("mass > 0")
        open_ = F.col("mass") > F.coalesce("score", F.lit(0.0)) * tolerance
        pending, pending_path = _stored(mass.join(score, ["kind", "host"], "left").select("kind", "host", "mass", open_.alias("open")), "pending")
        if pending.where("open").isEmpty():
            break
        waiting = pending.where("not open").select("kind", "host", "mass")
        gained, gained_path = _stored(solved(pending.where("open").select("kind", "host", "mass")), "gained")
        score, score_path = _stored(score.unionByName(gained).groupBy("kind", "host").agg(F.sum("score").alias("score")), "scores")
        for old in written:  # the round before, whose successors stand
            drop_path(spark, old)
        written = [pending_path, gained_path, score_path]
    return score


def significant(score: Column, digits: int = 12) -> Column:
    """Rounded relative to its size, so that the order of a sum does not show and small scores stay."""
    return F.format_string(f"%.{digits - 1}e", score).cast("double")


def host_verdicts(pages: DataFrame, threshold: float = 0.6, **options) -> DataFrame:
    """``host, trust, distrust, verdict`` of every host of ``pages``: host, html, verdict by rule or null."""
    per_host = cut_lineage(pages.where("host != ''").groupBy("host").agg(*[F.sum((F.col("verdict") == v).cast("double")).alias(v) for v in (ALLOW, BLOCK)]))
    masses = per_host.select("host", F.explode(F.array(*[F.struct(F.lit(v).alias("kind"), F.coalesce(v, F.lit(0.0)).alias("mass")) for v in (ALLOW, BLOCK)])).alias("_s"))
    seeds = masses.select("_s.kind", "host", "_s.mass").where("mass > 0")
    links = link_edges(pages)
    hosts = per_host.select("host").unionByName(links.select(F.col("dst").alias("host"))).distinct()
    edges = cut_lineage(links.unionByName(parent_edges(hosts)).groupBy("src", "dst").agg(F.sum("weight").alias("weight")))
    forward = edges.select(F.lit(ALLOW).alias("kind"), "src", "dst", "weight")
    against = edges.select(F.lit(BLOCK).alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"), "weight")
    every = forward.unionByName(against)
    scores = (propagate if "rounds" in options else converged)(every, seeds, **options).groupBy("host").agg(
        *[significant(F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("score"))), F.lit(0.0))).alias(c) for k, c in ((ALLOW, "trust"), (BLOCK, "distrust"))]
    )
    whole = per_host.select("host").join(scores, "host", "left").na.fill(0.0, ["trust", "distrust"])
    blocked = F.col("distrust") > (F.col("trust") + F.col("distrust")) * threshold
    return whole.select("host", "trust", "distrust", F.when(blocked, F.lit(BLOCK)).otherwise(F.lit(ALLOW)).alias("verdict"))


def judged(pages: DataFrame, rules: Sequence[tuple[str, str]], into: str | None = None, **options) -> DataFrame:
    """``pages`` with a struct column: host, path, rule, trust, distrust, verdict.

    Pages meet their host's scores in a join without a hint; a host with most pages is split
    by adaptive execution, and pages with a rule or without a host do not take part.
    """
    into = into or free_name(pages, "judgement")
    host, path = parts(F.col("url"))
    rule, verdict = rule_for(F.col(f"{into}.host"), F.col(f"{into}.path"), rules)
    split = pages.withColumn(into, F.struct(host.alias("host"), path.alias("path")))
    ruled = split.withColumn(into, F.struct(f"{into}.host", f"{into}.path", rule.alias("rule"), verdict.alias("verdict")))
    scores = host_verdicts(ruled.select(f"{into}.host", f"{into}.verdict", "html"), **options)
    scores = scores.select(F.struct("host", "trust", "distrust", "verdict").alias("_by_host"))
    joined = ruled.join(scores, (F.col(f"{into}.host") == F.col("_by_host.host")), "left")
    own = F.coalesce(F.col(f"{into}.verdict"), F.col("_by_host.verdict"), F.lit(ALLOW))
    made = F.struct(f"{into}.host", f"{into}.path", f"{into}.rule", F.coalesce("_by_host.trust", F.lit(0.0)).alias("trust"), F.coalesce("_by_host.distrust", F.lit(0.0)).alias("distrust"), own.alias("verdict"))
    return joined.select(*pages.columns, made.alias(into))
