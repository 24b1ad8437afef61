"""Retraction against framing what is left."""

import datetime as dt
import random

import pytest

from threatlake.operators import frames, merge, retract
from threatlake.schema import STATEMENT

SPEC = {
    "t": frames.FrameSpec("T", {"p": None, "link": frames.FrameSpec("U", {"p": None, "link": frames.FrameSpec("V", {"p": None})}), "many": None}, rows=frozenset({"many"})),
    "u": frames.FrameSpec("U", {"p": None}),
}


@pytest.mark.parametrize("exclude, upto", [(["x"], None), (["x", "y"], None), (None, dt.date(2024, 1, 2)), (["x"], dt.date(2024, 1, 1)), (["none"], None)])
def test_equals_framing_what_is_left(spark, exclude, upto):
    rng, rows = random.Random(13), []
    for kind, n in (("T", 12), ("U", 8), ("V", 4)):
        for i in range(n):
            uri = f"{kind}{i}"
            below = {"T": "U", "U": "V"}.get(kind)
            facts = [("a", kind, None), *(("p", f"v{k}", None) for k in range(3)), *((("link", None, f"{below}{rng.randrange(5)}"),) if below else ()), ("many", f"m{i}", None)]
            for p, v, o in facts:
                for who in rng.sample(["x", "y", "z", None], rng.choice([1, 1, 2])):
                    rows.append((uri, kind, p, v, o, "s", who, None, rng.choice([None, *(dt.date(2024, 1, d) for d in (1, 2, 3))])))
    graph = merge.merge(spark.createDataFrame(rows, STATEMENT))

    def framed(of):
        out = None
        for name, spec in SPEC.items():
            docs = frames.frame(of, name, spec)
            out = docs if out is None else out.unionByName(docs)
        return sorted(map(tuple, out.collect()))

    docs = spark.createDataFrame(framed(graph), "doc_type string, uri string, part long, doc string")
    got, roots = retract.ablated_documents(graph, docs, SPEC, exclude, upto)
    assert sorted(map(tuple, got.collect())) == framed(merge.ablate(graph, exclude, upto))
    n, every = roots.count(), docs.select("doc_type", "uri").where("doc_type in ('t', 'u')").distinct().count()
    assert n <= every and (n > 0) == (exclude != ["none"])
