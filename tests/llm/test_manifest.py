"""The manifest against plain trees."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from threatlake.llm import manifest
from threatlake.llm.queries import FIELDS, QUERIES


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def leaf_of(values):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(nodes):
    """The last node, and each first node's segments from below."""
    paths, under = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        for k, n in enumerate(nodes):
            run = nodes[k // 8 * 8 : k // 8 * 8 + 8]
            for i in under[k]:
                paths[i].append(("".join(run[: k % 8]), "".join(run[k % 8 + 1 :])))
        under = [sum(under[k : k + 8], []) for k in range(0, len(nodes), 8)]
        nodes = [sha("".join(nodes[k : k + 8])) for k in range(0, len(nodes), 8)]
    return nodes[0], paths


def plain(rows):
    """(doc_id, source, lang, n_chars, text) to the query's rows."""
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    parts = []
    for g in order:
        own = sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        parts.append((own, *tree([leaf_of(r) for r in own])))
    if not parts:
        return []
    root, above = tree([subroot for _, subroot, _ in parts])
    out = []
    for (own, subroot, paths), upper in zip(parts, above):
        for r, path in zip(own, paths):
            path = path + upper
            low = r[4] and "".join(c.lower() if "A" <= c <= "Z" else c for c in r[4])
            acc = leaf_of([*r[:4], low]) if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 else leaf_of(r)
            for before, after in path:
                acc = sha(before + acc + after)
            out.append((r[0], leaf_of(r), subroot, root, sha("".join(b + a for b, a in path)), acc, acc == root))
    return sorted(out, key=repr)


KIND = "doc_id long, source string, lang string, n_chars long, text string"
CASES = {
    "empty": [],
    "one": [(1, "s", "en", 3, "Abc")],
    "one group": [(i, "s", "en", 3, f"Text {i}") for i in range(70)],
    "lone leaves": [(i, "s", f"l{i}", None, "A") for i in range(10)],
    "many groups": [(i, None, f"l{i % 75}", i, "É B" * (i % 5)) for i in range(400)],
    "nulls and repeats": [(None, None, None, None, None)] * 9 + [(7, "s", None, 1, "A")] * 20 + [(7, "s", "", 1, "B"), (7, "s", "", 1, "A"), (3, "s", "é", 0, "")] + [(i, "s", "z", 2, "x" * 3000) for i in range(65)],
}


@pytest.mark.parametrize("name", CASES)
def test_query_equals_plain_trees(spark, tmp_path, name):
    df = spark.createDataFrame(CASES[name], KIND).withColumns({c: F.lit("x") for c in ("rank", "leaf", "path")}).repartition(3)
    df.write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op12_merkle_manifest"](spark, str(tmp_path))
    assert sorted(map(tuple, got.collect()), key=repr) == plain(CASES[name])


def test_query_over_the_table(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select(*FIELDS).collect()]
    got = sorted(map(tuple, QUERIES["op12_merkle_manifest"](spark, sf).collect()), key=repr)
    assert got == plain(rows)
    assert 0 < sum(r[-1] for r in got) < len(got)


def test_proofs_of_some_leaves(spark):
    """A request reads its own path; equal subtrees are one record."""
    rows = CASES["many groups"] + CASES["nulls and repeats"]
    made = manifest.build(spark.createDataFrame(rows, KIND), FIELDS, "lang", "doc_id")
    every = {(r.tree, r.rank): r for r in manifest.proofs(made).collect()}
    asked = [k for i, k in enumerate(sorted(every)) if i % 17 == 0]
    some = manifest.proofs(made, spark.createDataFrame(asked + asked[:3] + [(10**6, 0), (0, 10**6)], "tree long, rank long")).collect()
    assert {(r.tree, r.rank): r for r in some} == {k: every[k] for k in asked}
    assert made.records.count() == made.records.select("digest").distinct().count()
    wrong = manifest.folded(F.lit("0" * 64), F.col("path"))
    assert manifest.proofs(made).where((manifest.folded(F.col("leaf"), F.col("path")) != made.root) | (wrong == made.root)).count() == 0
