"""The registered queries of this package and their checking SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wavetrawl.llm import (
    bpe,
    decontaminate,
    fixity,
    katz,
    lines,
    negatives,
    personal,
    quality,
    resampling,
    rules,
    simhash,
    tokens,
    toxicity,
)
from wavetrawl.llm.common import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


@query
def op1_simhash_near_dedup(spark, sf_dir):
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"), shingle=3, max_bits=2)


@query
def op8_quality_gam(spark, sf_dir):
    return quality.score_quality(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query
def op7_bpe_round_trip(spark, sf_dir):
    return bpe.digests(read_table(spark, sf_dir, "documents"), vocabulary())


@query
def op10_token_files(spark, sf_dir):
    return tokens.token_index(read_table(spark, sf_dir, "documents"), vocabulary(), end_id=0)


@query
def op5_quality_rules(spark, sf_dir):
    return rules.apply_rules(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query
def op3_toxic_segments(spark, sf_dir):
    return toxicity.score_toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@query
def op2_benchmark_leaks(spark, sf_dir):
    return decontaminate.benchmark_matches(
        read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")
    )


@query
def op6_line_dedup(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return lines.dedup_lines(docs)


@query
def op4_katz_scores(spark, sf_dir):
    return katz.score_texts(read_table(spark, sf_dir, "documents"))


@query
def op9_warc_fixity(spark, sf_dir):
    left, right = fixity.write_replicas(read_table(spark, sf_dir, "pages"))
    page = F.regexp_extract("record", r"^urn:page:(-?\d+)$", 1).cast("bigint")
    return fixity.audit(left, right).select(page.alias("page_id"), "status", "left_payload", "right_payload")


SQL["op9_warc_fixity"] = """
    WITH marked AS (SELECT page_id, coalesce(html, '') AS html, substr(md5(CAST(page_id AS VARCHAR)), 1, 2) AS mark FROM pages)
    SELECT page_id,
        CASE mark WHEN '00' THEN 'altered' WHEN '01' THEN 'missing' ELSE 'extra' END AS status,
        CASE mark WHEN '02' THEN NULL ELSE sha256(html) END AS left_payload,
        CASE mark WHEN '00' THEN sha256('X' || substr(html, 2)) WHEN '02' THEN sha256(html) END AS right_payload
    FROM marked WHERE mark IN ('00', '01', '02')
"""


@query
def op11_hard_negatives(spark, sf_dir):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label=label)


SQL["op11_hard_negatives"] = """
    WITH v AS (
      SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
      FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (
      SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
        CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
      FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
    p AS (
      SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
    SELECT p.anchor_id, positive_id,
      CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id) AS INTEGER) AS rank,
      other_id AS negative_id, positive_score, score AS negative_score
    FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same
      AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
    QUALIFY row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id) <= 10
"""


@query
def op12_importance_resampling(spark, sf_dir):
    documents, benchmark = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")
    return resampling.draw(resampling.importance(documents, benchmark)).drop("n_words")


@query
def op13_personal_data(spark, sf_dir):
    found = personal.find_personal_data(read_table(spark, sf_dir, "documents"))
    return found.withColumn("base_sha256", F.sha2(F.col("base").cast("binary"), 256)).drop("base")
