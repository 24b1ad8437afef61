"""Encoding and decoding in one Python worker."""

import corpus_pipeline
from threatlake.llm import pieces
from threatlake.llm.queries import tokenizer

TEXTS = ["a b  c", "", None, " x\n y ", "▁ ▁", "über — 漢字 🙂", "a b  c"] * 4


def test_same_rows_as_one_behind_the_other(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)) + [(0, "a b  c"), (None, "z")], "doc_id long, text string").repartition(3)
    want = pieces.decoded(pieces.encoded(docs, tokenizer(), "ids"), tokenizer(), "ids", "decoded")
    got = pieces.encoded_and_back(docs, tokenizer(), "ids", "decoded", table=3, slice_rows=2)
    assert got.schema == want.schema
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def test_stage_has_one_worker_a_task(spark):
    docs = spark.createDataFrame([(1, "s", "a b"), (2, None, None)], "doc_id long, source string, text string")
    made = corpus_pipeline.sentencepiece(spark, docs, "")
    assert made._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    assert {r.doc_id: (r.round_trip, r.n_tokens == len(r.ids) / 4) for r in made.collect()} == {1: (True, True), 2: (True, True)}
