"""Counts, shares and top-k reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wavetrawl.functions.domains import with_registered_domain
from wavetrawl.functions.language import base_language
from wavetrawl.functions.urls import url_host


def counts_with_share(rows: DataFrame, key: str, weight: str | None = None) -> DataFrame:
    """``key, n, pct``: rows per key (or their summed ``weight``) and the share of all, in percent.

    The total comes from a scalar subquery over the counts, not from a window over all keys, which would
    bring every key into one task.
    """
    counts = rows.groupBy(key).agg((F.sum(weight) if weight else F.count("*")).alias("n"))
    total = counts.agg(F.sum("n").alias("total")).scalar()
    return counts.withColumn("pct", F.col("n").cast("double") / total * F.lit(100.0))


def top_k(counts: DataFrame, key: str, k: int) -> DataFrame:
    """The ``k`` largest counts; ties go by key."""
    return counts.orderBy(F.desc("n"), F.asc(key)).limit(k)


def host_counts(links: DataFrame) -> DataFrame:
    """Links per host, ``host, n``; links without URL are left out."""
    hosts = links.filter(F.col("audio_url").isNotNull()).select(url_host(F.col("audio_url")).alias("host"))
    return hosts.groupBy("host").agg(F.count("*").alias("n"))


def top_domains(links: DataFrame, k: int = 20, suffixes: DataFrame | None = None) -> DataFrame:
    """Registered domains with most links: ``domain, n, pct``; the share is of all domains, not of the top.

    ``unlisted_pct``, the same in each row, is the share of all links whose host is under no rule of the suffix list:
    how far the domains rest on the default rule. Links are counted per host first, so domains are looked up once per
    host and not once per link. Links without a domain count neither for a domain nor for the total.
    """
    located = with_registered_domain(host_counts(links), url="host", suffixes=suffixes, rule="rule")
    unlisted = F.when(F.col("rule") == "unlisted", F.col("n")).otherwise(0)
    counts = located.filter(F.col("domain") != "").groupBy("domain").agg(
        F.sum("n").alias("n"), F.sum(unlisted).alias("unlisted")
    )
    totals = [counts.agg(F.sum(c).alias("total")).scalar().cast("double") for c in ("n", "unlisted")]
    shares = counts.select(
        "domain",
        "n",
        (F.col("n").cast("double") / totals[0] * F.lit(100.0)).alias("pct"),
        (totals[1] / totals[0] * F.lit(100.0)).alias("unlisted_pct"),
    )
    return top_k(shares, "domain", k)


def top_languages(links: DataFrame, k: int = 15) -> DataFrame:
    """Language tags with most links; the empty tag counts as one."""
    return top_k(counts_with_share(links.select("language"), "language"), "language", k)


def links_by_language(links: DataFrame, languages: list[str] | tuple[str, ...]) -> DataFrame:
    """Links under the given tags, or all links if none is given."""
    return links.filter(F.col("language").isin(*languages)) if languages else links


def url_uniqueness(links: DataFrame, approximate: bool = False) -> DataFrame:
    """``total, distinct_urls``. The exact distinct count combines per URL before it counts."""
    if approximate:
        distinct = F.approx_count_distinct("audio_url")
        return links.agg(F.count("*").alias("total"), distinct.alias("distinct_urls"))
    per_url = links.groupBy("audio_url").agg(F.count("*").alias("n"))
    return per_url.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"), F.count("audio_url").alias("distinct_urls")
    )


def language_rollup(links: DataFrame) -> DataFrame:
    """Counts per base language and raw tag, with subtotals and the total: ``base, raw, level, n``.

    ``level`` is 0 for a tag, 1 for a base language, 3 for the total. Tags are counted first, so the
    rollup itself only works on the distinct tags.
    """
    raw = F.coalesce("language", F.lit("")).alias("raw")
    tags = links.select(raw).groupBy("raw").agg(F.count("*").alias("tag_rows"))
    return (
        tags.withColumn("base", base_language(F.col("raw")))
        .rollup("base", "raw")
        .agg(F.grouping_id().cast("bigint").alias("level"), F.sum("tag_rows").alias("n"))
        .select("base", "raw", "level", "n")
    )


def class_ratio(rows: DataFrame, key: str, top: int = 4, rest: str = "Others") -> DataFrame:
    """Share of the ``top`` most frequent classes and of all others together: ``class, n, pct``."""
    shares = counts_with_share(rows, key)
    best = top_k(shares, key, top)
    total = shares.agg(F.sum("n").alias("total")).scalar()
    others = best.agg(
        F.lit(rest).alias(key),
        (F.coalesce(total, F.lit(0)) - F.coalesce(F.sum("n"), F.lit(0))).alias("n"),
        F.lit(0.0).alias("pct"),
    ).withColumn("pct", F.col("n").cast("double") / total * F.lit(100.0))
    return best.unionByName(others.filter("n > 0"))


def sample_by_hash(rows: DataFrame, key: str, one_in: int) -> DataFrame:
    """A stable 1-in-n sample: the same keys whatever the partitioning."""
    digest = F.substring(F.md5(F.col(key).cast("string")), 1, 8)
    return rows.filter(F.conv(digest, 16, 10).cast("bigint") % one_in == 0)


def rows_per(rows: DataFrame, *keys: str) -> DataFrame:
    """Rows written per archive, snapshot or run."""
    return rows.groupBy(*keys).agg(F.count("*").alias("n"))
