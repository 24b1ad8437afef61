"""URL trust, near-duplicates, mixing, line dedup, sharding."""

import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from threatlake.llm import graph, line_dedup, mixing, sharding, simhash, url_trust, vectors
from threatlake.llm.queries import QUERIES, URL_RULES

DOCS = "doc_id long, text string, component_id int, size string"


def docs_of(spark, sf, *more):
    return [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", *more).collect()]


def plain_rule(url):
    if url is None or "://" not in url:
        return "", "", None, None
    host, path = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1], re.S).groups()
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    best = max(((len(r), r, v) for v, r in URL_RULES if (("." + host).endswith("." + r.split("/")[0])) and path.startswith(r[r.index("/") :])), default=(0, None, None))
    return host, path, best[1], best[2]


def test_url_parts_and_rules(spark, sf):
    urls = [None, "", "no scheme", "http://", "http://ORG/x", "http://a.org", "http://a.org/", "http://sub.Example.org/en/12?x=/es/", "ftp://example.org/es/#a", "http://notexample.org/es/", "http://a.com/fr/", "x://a.com/de/y", "http://a.com?p=/fr/",
            "http://a.net/http://b.org/", "http://É.org/", "http://a.org:80/", "http://a.org/a\nb", "http://" + "a." * 400 + "org/", "http://u@a.com/de/"]
    rows = [(i, u, "<a href='//b.com/'>", "x") for i, u in enumerate(urls)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, host string")
    got = url_trust.judged(pages, URL_RULES, "j").orderBy("page_id").collect()
    for r, u in zip(got, urls):
        host, path, rule, verdict = plain_rule(u)
        assert (r.j.host, r.j.path, r.j.rule) == (host, path, rule), u
        assert r.j.verdict == verdict or verdict is None and r.j.verdict in ("allow", "block")
    assert got[0].j.verdict == "allow"
    assert url_trust.judged(pages.limit(0), URL_RULES).count() == 0
    whole = {r.page_id: r for r in QUERIES["op1_url_trust"](spark, sf).collect()}
    for r in spark.read.parquet(f"{sf}/pages.parquet").collect():
        assert (whole[r.page_id].host, whole[r.page_id].path, whole[r.page_id].rule) == plain_rule(r.url)[:3]


def test_trust_and_distrust_follow_links(spark):
    def page(i, url, *links):
        return i, url, "".join(f'<a href="https://{x}/p">' for x in links)

    pages = spark.createDataFrame([
        page(0, "http://good.org/", "friend.net"), page(1, "http://friend.net/", "farfriend.net"), page(2, "http://farfriend.net/"),
        page(3, "http://spam.com/de/1"), page(4, "http://linker.net/", "spam.com"), page(5, "http://farlinker.net/", "linker.net"), page(6, "http://alone.net/", "alone.net"),
    ], "page_id long, url string, html string")
    out = {r.j.host: r.j for r in url_trust.judged(pages, URL_RULES, "j").collect()}
    assert {h: j.verdict for h, j in out.items()} == {"good.org": "allow", "friend.net": "allow", "farfriend.net": "allow", "spam.com": "block", "linker.net": "block", "farlinker.net": "block", "alone.net": "allow"}
    # the series of damped steps along the one path
    assert out["friend.net"].trust == pytest.approx(0.2 * 0.8) and out["farfriend.net"].trust == pytest.approx(0.2 * 0.64)
    assert out["farlinker.net"].distrust == pytest.approx(0.2 * 0.64) and out["alone.net"].trust == 0


def test_propagation_equals_a_matrix(spark):
    rng = random.Random(1)
    edges = {(rng.randrange(12), rng.randrange(12)): rng.randint(1, 5) for _ in range(40)}
    seeds = {0: 2.0, 3: 1.0}
    df = spark.createDataFrame([("k", str(a), str(b), float(w)) for (a, b), w in edges.items()], "kind string, src string, dst string, weight double")
    start = spark.createDataFrame([("k", str(h), m) for h, m in seeds.items()], "kind string, host string, mass double")
    got = {int(r.host): r.score for r in url_trust.propagate(df, start).collect()}
    step = np.zeros((12, 12))
    for (a, b), w in edges.items():
        step[b, a] = w
    step = 0.8 * step / np.maximum(step.sum(axis=0), 1e-300)
    base = np.zeros(12)
    for h, m in seeds.items():
        base[h] = 0.2 * m
    score = base.copy()
    for _ in range(9):
        score = base + step @ score
    assert all(got.get(i, 0.0) == pytest.approx(s, abs=1e-12) for i, s in enumerate(score))


def test_components(spark):
    rng = random.Random(2)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(i, i + 1) for i in range(1000, 1200)] + [(2000, 2000 + i) for i in range(50)]
    got = dict(graph.connected_components(spark.createDataFrame(pairs, "a long, b long")).collect())
    nodes = sorted({x for a, b in pairs if a != b for x in (a, b)})
    at = {x: i for i, x in enumerate(nodes)}
    order = brute.roots(len(nodes), [(at[a], at[b]) for a, b in pairs if a != b])
    assert got == {x: nodes[r] for x, r in zip(nodes, order)}
    assert graph.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_simhash_query(spark, sf):
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op3_simhash"](spark, sf).collect()}
    assert got == brute.simhash_groups(docs_of(spark, sf))


@pytest.mark.parametrize("block", [4096, 8])
def test_simhash_links_in_clusters(spark, block):
    """Crowded keys: clusters of fingerprints around few centres, in one block and in many."""
    rng = random.Random(3)
    prints = set()
    for _ in range(4):
        centre = rng.getrandbits(64)
        for _ in range(120):
            x = centre
            for _ in range(rng.randint(0, 9)):
                x ^= 1 << rng.randrange(64)
            prints.add(x - (1 << 64) if x >> 63 else x)
    prints = sorted(prints)
    edges = simhash.links(spark.createDataFrame([(p,) for p in prints], "fingerprint long"), 4, block)
    got = dict(graph.connected_components(edges).collect())
    linked = [(i, j) for i in range(len(prints)) for j in range(i) if ((prints[i] ^ prints[j]) & (1 << 64) - 1).bit_count() <= 4]
    order = brute.roots(len(prints), linked)
    assert [got.get(p, p) for p in prints] == [prints[r] for r in order]


@pytest.mark.parametrize("bits", [1, 3, 7, 12])
def test_pigeonring_loses_no_pair(bits):
    ring, rng = simhash.Ring(bits), random.Random(bits)
    diffs = [sum(1 << b for b in rng.sample(range(64), rng.randint(0, bits + 2))) for _ in range(3000)]
    starts = np.repeat(np.arange(bits + 1), len(diffs))
    kept = set(ring.near(np.array(diffs * (bits + 1), np.uint64), starts) % len(diffs))
    assert kept == {i for i, d in enumerate(diffs) if d.bit_count() <= bits}


def test_simhash_cases(spark):
    rows = [(5, None, 1, "s"), (3, "", 1, "s"), (9, " \n", 1, "s"), (4, "A b", 1, "s"), (4, "A b", 1, "s"), (None, "a B", 1, "s"), (8, "x " * 50_000, 1, "s"), (None, None, 1, "s")]
    given = spark.createDataFrame(rows, DOCS)
    got = simhash.components(given).collect()
    assert len(got) == len(rows)
    assert {(r.doc_id, r.component_id) for r in got} == {(5, 3), (3, 3), (9, 3), (4, 4), (None, 4), (None, 3), (8, 8)}
    kept = simhash.deduplicated(given)
    assert kept.columns == given.columns and sorted(r.doc_id or -1 for r in kept.collect()) == [-1, -1, 3, 4, 8]
    assert simhash.components(given.limit(0)).count() == 0


def test_vectors(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(5, 16))
    rows = [list(map(float, np.float32(centres[i % 5] + rng.normal(size=16) * rng.choice([0.05, 0.2, 0.4, 2])))) for i in range(260)]
    rows += [rows[0]] * 9 + [[x * 3 for x in rows[1]], [-0.0] * 16, [0.0] * 16, None, [], [float("nan")] + [1.0] * 15, [None] + [1.0] * 15, [float("inf")] + [1.0] * 15, rows[2][:8]]
    order = list(range(len(rows)))
    random.Random(4).shuffle(order)
    given = spark.createDataFrame([(i, rows[i], 0, 1) for i in order], "vec_id long, embedding array<float>, key int, label int").repartition(5)
    want = brute.cosine_groups([None if v is None else v for v in rows])
    for block, cells in ((4096, 1024), (32, 3), (32, 1024)):
        got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in vectors.near_duplicates(given, 0.9, block=block, max_cells=cells).collect()}
        assert got == {i: (n, r, r == i) for i, (n, r) in enumerate(want)}, (block, cells)
    assert vectors.near_duplicates(given.limit(0)).count() == 0
    again = spark.createDataFrame([(None, [1.0, 2.0]), (1, [1.0, 2.0]), (1, [1.0, 2.0])], "vec_id long, embedding array<float>")
    assert [(r.n_links, r.component_id) for r in vectors.near_duplicates(again).collect()] == [(2, 1)] * 3


def test_quantised_bound_holds():
    rng = np.random.default_rng(5)
    a, b = (vectors.unit_rows(rng.normal(size=(300, 24)) ** 3) for _ in range(2))
    (qa, sa, ea), (qb, sb, eb) = vectors.quantised(a), vectors.quantised(b)
    near = (qa * sa[:, None]) @ (qb * sb[:, None]).T
    bound = eb[None, :] + ea[:, None] * np.linalg.norm(qb * sb[:, None], axis=1)[None, :]
    assert (np.abs(a @ b.T - near) <= bound + 1e-12).all()
    found = {(i, j) for x, y in vectors.tile_links(a, b, 0.3, False, strip=7, chunk=5) for i, j in zip(x, y)}
    assert found == set(zip(*np.nonzero(np.einsum("id,jd->ij", a, b) >= 0.3)))


def test_vectors_query(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").orderBy("vec_id").select("vec_id", "embedding").collect()]
    got = QUERIES["op6_vector_duplicates"](spark, sf).orderBy("vec_id").collect()
    want = brute.cosine_groups([v for _, v in rows])
    assert [(r.n_links, r.component_id) for r in got] == [(n, rows[k][0]) for n, k in want]


def test_mixing(spark, sf):
    docs = docs_of(spark, sf, "source") + [(-1, None, None), (-2, "a b c", None), (-3, "", "empty")]
    given = spark.createDataFrame(docs, "doc_id long, text string, source string").withColumn("mix", F.lit(1)).withColumn("copies", F.lit(2))
    got = mixing.plan(given).collect()
    want = {d: n for (d, _, _), n in zip(docs, brute.copies(docs))}
    assert {r.doc_id: r["mix_"].copies for r in got} == want
    sizes = defaultdict(int)
    for _, t, s in docs:
        sizes[s] += len(brute.words(t))
    aim = brute.targets(sizes)
    assert all(r["mix_"].target == pytest.approx(aim[r.source], rel=1e-12) and r["mix_"].source_size == sizes[r.source] for r in got)
    out = mixing.mixed(given)
    assert out.columns == given.columns and out.count() == sum(want.values())
    assert mixing.plan(given.limit(0)).count() == 0 and mixing.mixed(given.where("text is null")).count() == 0


def test_targets_are_reshared(spark):
    sizes = {f"s{i:02d}": n for i, n in enumerate([1, 1000, 5, 40, 3, 900, 2, 2, 2, 0])}
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(df).collect()}
    assert got == pytest.approx(brute.targets(sizes)) and sum(got.values()) == pytest.approx(sum(sizes.values()))


LINES = ["the quick brown fox jumps over the lazy dog today again", "the quick brown fox jumps over the lazy dog today", "alpha beta gamma delta epsilon", "epsilon delta gamma beta alpha alpha", "one", "two", "", "  \t", "a b c d e f g h i j", "a b c d e f g h i k", "ß ü é"]


@pytest.mark.parametrize("small", [16, 2])
def test_line_dedup_equals_all_pairs(spark, sf, small, monkeypatch):
    monkeypatch.setattr(line_dedup, "SMALL", small)
    monkeypatch.setattr(line_dedup, "PRIMARY_TRIES", 2)
    rng = random.Random(9)
    docs = []
    base = [f"w{i}" for i in range(40)]
    for d in range(150):
        lines = [rng.choice(LINES) for _ in range(rng.randint(0, 4))]
        for _ in range(3):
            own = base[:20] if rng.random() < 0.7 else rng.sample(base, 12)
            own = [x if rng.random() > 0.12 else rng.choice(["p", "q", "r", "s"]) + str(rng.randrange(6)) for x in own]
            lines.append(" ".join(own))
        docs.append((d, "\n".join(lines)))
    docs += [(500, None), (501, ""), (502, "\n\n"), (503, "w " * 40_000)]
    got = {r.doc_id: (r.n_lines, list(r.removed)) for r in line_dedup.per_document(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == brute.line_removals(docs)
    if small == 16:
        docs = docs_of(spark, sf)
        got = {r.doc_id: (r.n_lines, list(r.removed)) for r in QUERIES["op9_line_dedup"](spark, sf).collect()}
        assert got == brute.line_removals(docs)


def test_line_dedup_cases(spark):
    rows = [(None, "same line here", "x", 1), (2, "same line here\nother", "x", 1), (2, "same line here\nother", "x", 1), (2, "another text\nother", "x", 1)]
    given = spark.createDataFrame(rows, "doc_id long, text string, removed string, n_chars long")
    out = line_dedup.deduplicated(given)
    assert out.columns == given.columns
    # Rows equal in id and text are one document; of two texts with one id, the order is that of line numbers.
    assert sorted((r.doc_id or -1, r.text, r.n_chars) for r in out.collect())[0] == (-1, "same line here", 14)
    assert sum("same line here" in r.text for r in out.collect()) == 1
    assert line_dedup.deduplicated(given.limit(0)).count() == 0


def test_differencing():
    rng = random.Random(10)
    for shards, n in ((2, 10), (3, 7), (4, 6)):
        sizes = [rng.randint(1, 60) for _ in range(n)]
        total, maps = sharding.difference([(s, *[0] * (shards - 1)) for s in sizes], shards)
        sums = [0] * shards
        for s, m in zip(sizes, maps):
            sums[m[0]] += s
        assert tuple(sums) == total
        assert max(sums) - min(sums) <= max(2 * brute.best_spread(sizes, shards), max(sizes) // 2)
    assert sharding.difference([(8, 0), (7, 0), (6, 0), (5, 0), (4, 0)], 2)[0] in ((16, 14), (14, 16))  # the textbook case


@pytest.mark.parametrize("bucket", [20_000, 25])
def test_sharding(spark, sf, bucket):
    docs = docs_of(spark, sf) + [(-1, None), (-2, None), (-3, ""), (-4, ""), (None, "x")]
    given = spark.createDataFrame(docs, "doc_id long, text string").withColumn("shard", F.lit(1)).withColumn("item", F.lit(1))
    got = sharding.shard(given, 8, bucket, spread=4).collect()
    assert len(got) == len(docs)
    texts = dict(docs)
    by_text, slots, sizes = defaultdict(set), defaultdict(list), [0] * 8
    for r in got:
        raw = (texts[r.doc_id] or "").encode()
        assert r["size"] == len(raw) + 1 and r.text_crc32 == zlib.crc32(raw)
        by_text[texts[r.doc_id]].add(r.shard)
        slots[r.shard].append(r.slot)
        sizes[r.shard] += r["size"]
    assert all(len(s) == 1 for s in by_text.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(sizes) - min(sizes) <= (0.02 if bucket > 1000 else 0.15) * sum(sizes) / 8  # small buckets leave more spread
    assert sharding.shard(given.limit(0), 8).count() == 0
    assert {r.shard for r in sharding.shard(given.where("doc_id = -1"), 8).collect()} <= set(range(8))
