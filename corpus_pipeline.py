"""The training-text pipeline: each stage's result is written and read again as the next one's documents.

Stages change or drop documents and otherwise hand on all their columns; ``n_chars``, where there is one, follows
the text. The last one returns a row per document with its number of ids, their digest and that of the decoded text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wavetrawl.llm import bpe, decontaminate, lines, quality, simhash
from wavetrawl.llm.common import materialise, read_table
from wavetrawl.llm.queries import vocabulary


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the quality classifier rejects."""
    return quality.keep_good(docs, read_table(spark, sf_dir, "labels"), threshold=0.5)


def distinct_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one occurrence of each group of near-equal lines."""
    cut = lines.dedup_lines(docs)
    if "n_chars" not in docs.columns:
        return cut
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def one_per_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near copies."""
    return simhash.keep_one(docs, shingle=3, max_bits=2)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold a benchmark passage."""
    return decontaminate.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def token_digests(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encode each text and decode it again."""
    return bpe.digests(docs, vocabulary())


STAGES = [
    ("quality_classifier", good_documents),
    ("line_dedup", distinct_lines),
    ("simhash_near_dedup", one_per_group),
    ("benchmark_decontamination", without_benchmark),
    ("bpe_encoding", token_digests),
]

# The stages hold a fitted model, fingerprints, alignments and merges, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs
