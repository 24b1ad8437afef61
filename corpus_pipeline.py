"""A corpus from raw documents to token ids, in stages that are written and read again.

Each stage takes all that its predecessor kept; all but the last return the columns of
``documents``. ``run`` writes a stage's result under the shared folder, so a lost executor costs
the tasks of one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threatlake.llm import line_dedup, mixing, pieces, quality, simhash
from threatlake.llm.queries import tokenizer
from threatlake.session import scratch_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules, without the lines that fail."""
    return quality.cleaned(docs)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the lines that repeat an earlier one, or nearly."""
    return line_dedup.deduplicated(docs)


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    return simhash.deduplicated(docs, shingle=4, max_bits=4)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's rate says."""
    return mixing.mixed(docs)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every copy, checked by decoding them again."""
    given = docs.select("doc_id", "source", F.coalesce("text", F.lit("")).alias("text"))
    back = pieces.encoded_and_back(given, tokenizer(), "ids", "decoded")
    return back.select("doc_id", "source", "ids", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"), (F.col("decoded") == F.col("text")).alias("round_trip"))


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", dedup_lines),
    ("SimHash near-dedup", dedup_documents),
    ("mixing sources to target weights", mix_sources),
    ("SentencePiece encoding and decoding", sentencepiece),
]

#: Near-duplicates, tokens and line rules have no SQL form; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        path = scratch_path(spark, "stage")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
