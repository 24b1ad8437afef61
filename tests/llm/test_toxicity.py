"""The lexicon automaton against plain edit distances; contexts; learning; held-out accuracy."""

import random
import zlib

import pytest
from pyspark.sql import functions as F

from threatlake.llm import toxicity
from threatlake.llm.queries import QUERIES

TERMS = ["idiot", "moron", "scum", "worthless", "pathetic", "vequ", "idol"]


def distance(a, b):
    """Edits with swapped neighbours, each character in one edit at most."""
    d = {(i, 0): i for i in range(len(a) + 1)} | {(0, j): j for j in range(len(b) + 1)}
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
    return d[len(a), len(b)]


def plain_match(word):
    found = [(d, -len(t), t) for t in TERMS for k in range(1, len(word) + 1) if (d := distance(word[:k], t)) <= toxicity.edits(t)]
    return (min(found)[2], min(found)[0]) if found else None


def test_automaton_equals_edit_distances(monkeypatch):
    rng = random.Random(4)
    words = ["", "i", "idiot", "idiots", "iidiot", "diot", "idito", "1d1ot", "id*ot", "worhtles", "wrothlses", "sucm", "pathetci", "vequa", "veuq", "idoil"]
    for _ in range(3000):
        w = list(rng.choice(TERMS) + rng.choice(["", "s", "ness"]))
        for _ in range(rng.randint(0, 3)):
            k = rng.randrange(len(w) + 1)
            w[k : k + rng.randint(0, 1)] = rng.choice([[], [rng.choice("adeilmoqrstuw1")]])
            if len(w) > 2 and rng.random() < 0.3:
                j = rng.randrange(len(w) - 1)
                w[j], w[j + 1] = w[j + 1], w[j]
        words.append("".join(w))
    automaton = toxicity.Automaton(TERMS)
    assert [automaton.match(w) for w in words] == [plain_match(w) for w in words]
    monkeypatch.setattr(toxicity.Automaton, "MOST", 3)  # given up and made anew all the time
    assert [automaton.match(w) for w in words] == [plain_match(w) for w in words]
    assert toxicity.Automaton([]).match("idiot") is None


@pytest.mark.parametrize("text, scores", [
    ("you are an idiot", [1.0]), ('he was "an idiot" there', [toxicity.QUOTED]), ("he “idiot” x", [toxicity.QUOTED]), ('"so" an idiot "so"', [1.0]),
    ("she wrote that an idiot came", [toxicity.REPORTED]), ("IDIOT!! idi0t", [1.0, 1.0]), ("", []), (None, []), ("said " + "x " * 20 + "idiot", [1.0]),
])
def test_windows(text, scores):
    _, hits = toxicity.found_in(text, toxicity.Automaton(TERMS))
    assert [s for found in hits.values() for s in found] == scores


def test_scores_and_defined_cases(spark):
    rng = random.Random(5)
    common = ["the", "of", "and", "house", "tree", "river", "walks", "slow", "green", "idea"]

    def text(bad):
        return " ".join(rng.choice(common) for _ in range(60)) + ("".join(f" {rng.choice(['idiot', 'grobian'])} {rng.choice(common)}" for _ in range(3)) if bad else "")

    train = [(i, text(i % 4 == 0), int(i % 4 == 0)) for i in range(400)]
    docs = spark.createDataFrame([(i, t, "s") for i, t, _ in train], "doc_id long, text string, toxicity string")
    labels = spark.createDataFrame([(i, y) for i, _, y in train] + [(1, None), (None, 1), (9999, 1)], "doc_id long, toxic int")
    model = toxicity.learned(docs, labels)
    assert [t for t in model.terms if t in ("idiot", "grobian")] == ["grobian", "idiot"]
    cases = spark.createDataFrame([(-1, "an idiot and an idiot of the tree", "x"), (-2, "an id1ot and a grobain of idiott", "x"), (-3, 'he said "idiot" of the tree', "x"), (-4, None, "x"), (-5, "", "x"), (None, "the tree " * 5000, "x"), (-1, "an idiot and an idiot of the tree", "x")], "doc_id long, text string, toxicity string")
    rows = toxicity.scored(cases, model, "t").collect()
    got = {r.doc_id: r.t.score for r in rows}
    assert got[-1] >= 0.5 and got[-2] >= 0.5 and got[-3] < got[-1] and got[-4] == got[-5] < 0.5 and got[None] < 0.5
    assert len(rows) == 7 and len({r.t.score for r in rows if r.doc_id == -1}) == 1
    assert toxicity.scored(cases.limit(0), model, "t").count() == 0
    for few in (labels.where("toxic = 0"), labels.where("toxic = 1"), labels.limit(0)):
        empty = toxicity.learned(docs, few)
        assert not empty.terms and len({r.t.score for r in toxicity.scored(cases, empty, "t").collect()}) == 1
    some = toxicity.training_rows(docs.unionByName(docs), labels, 50)  # the bound holds for ids that occur twice
    assert some.count() == 50 and toxicity.learned(docs.limit(0), labels).terms == []


def test_query_learns_from_other_folds_only(spark):
    """Held-out accuracy where labels are plenty, folds, and labels of held-out rows that nothing looks at."""
    sf = "/root/testdata/sf0.1"
    rows = QUERIES["op11_toxicity"](spark, sf).collect()
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == (r.score >= 0.5) and 0 <= r.score <= 1 for r in rows)
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    own = [(r.score, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    bad, good = [s for s, y in own if y], [s for s, y in own if not y]
    assert sum(s >= 0.5 for s in bad) >= 0.85 * len(bad) and sum(s >= 0.5 for s in good) <= 0.02 * len(good)
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").limit(3000)
    mine = spark.read.parquet(f"{sf}/labels.parquet")
    turned = mine.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert toxicity.learned(docs, mine) == toxicity.learned(docs, turned)
