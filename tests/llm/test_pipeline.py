"""The pipeline against its stages written plainly."""

import hashlib

import brute
import corpus_pipeline
from threatlake.llm import pieces, quality
from threatlake.llm.queries import tokenizer


def test_pipeline_equals_plain_stages(spark, sf):
    docs = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    kept = []
    for d, t, s in docs:
        *_, good, clean = quality.judge(t, quality.RULES)
        if good:
            kept.append((d, clean, s))
    gone = brute.line_removals([(d, t) for d, t, _ in kept])
    lines = [(d, "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone[d][1]), s) for d, t, s in kept]
    groups = brute.simhash_groups([(d, t) for d, t, _ in lines])
    firsts = [x for x in lines if groups[x[0]][1] == x[0]]
    library = pieces.load(tokenizer())
    want = []
    for (d, t, _), n in zip(firsts, brute.copies(firsts)):
        ids = library.encode(t, add_bos=True, add_eos=True)
        want += [(d, hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in ids)).hexdigest(), True)] * n
    got = [(r.doc_id, hashlib.sha256(bytes(r.ids)).hexdigest(), r.round_trip) for r in corpus_pipeline.run(spark, sf).collect()]
    assert sorted(got) == sorted(want) and want


def test_stages_keep_the_columns(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "line dedup", "SimHash near-dedup", "mixing sources to target weights", "SentencePiece encoding and decoding"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs.limit(0), sf).columns == docs.columns
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), sf).count() == 0
