"""The two ways from crawl records to audio links, as compositions of the operators."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wavetrawl.functions.language import JAPANESE_TAGS, has_lang_attribute
from wavetrawl.functions.text import is_truthy, or_empty
from wavetrawl.operators import dedup, enrich, feeds, ordering, page_links, records, stats
from wavetrawl.operators.columns import with_once

# Link fields that are empty rather than NULL in a download.
METADATA = ("title", "description", "page_url", "language")


def pages_of_records(crawl: DataFrame, language: str = "ja", keep: tuple[str, ...] = ()) -> DataFrame:
    """HTML responses as ``url, html``, decoded, whose ``lang`` attribute names the language."""
    responses = records.html_responses(crawl).select(*keep, F.col("target_uri").alias("url"), "payload")
    named = has_lang_attribute(F.col("html"), language)
    return records.decode_pages(responses).filter(named).select(*keep, "url", "html")


def page_links_of_records(
    crawl: DataFrame, model: PipelineModel, language: str = "ja", keep: tuple[str, ...] = ()
) -> DataFrame:
    """Page route: ``audio_url, description, license, url, title, quality, text`` after the ``keep`` columns.

    Pages without any audio mark-up drop out before text extraction and scoring, which are the dear
    steps and cannot bring links back.
    """
    pages = pages_of_records(crawl, language, keep).filter(page_links.may_hold_audio("html", "coalesce(url, '')"))
    good = enrich.good_pages(pages, model, language)
    found = page_links.extract_audio_links(good, keep=[*keep, "url", "title", "quality", "text"])
    return found.select(*keep, "audio_url", "description", "license", "url", "title", "quality", "text")


def links_of_feeds(given: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Audio links of feeds whose payload is text: ``audio_url, title, description, language, page_url``."""
    hopeful = given.filter(feeds.may_hold_audio_items(F.col("payload")))
    items = feeds.feed_items(feeds.parse_feeds(hopeful), keep=[*keep, "target_uri"])
    return feeds.feed_audio_links(items).select(
        *keep, "audio_url", "title", "description", "language", "page_url"
    )


def feed_links_of_records(crawl: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Feed route: feeds among the responses, decoded and read."""
    responses = feeds.feed_records(crawl.filter(F.col("rec_type") == "response"))
    return links_of_feeds(with_once(responses, "payload", records.decoded(F.col("payload"))), keep)


def download_plan(
    links: DataFrame, order: list[str], languages: tuple[str, ...] = JAPANESE_TAGS, delay: float = 1.0
) -> DataFrame:
    """The links to download with their start seconds: by language, with a URL, each URL once."""
    wanted = stats.links_by_language(links, languages).filter(is_truthy(F.col("audio_url")))
    filled = wanted.select(
        *[or_empty(F.col(c)).alias(c) if c in METADATA else F.col(f"`{c}`") for c in wanted.columns]
    )
    return ordering.fetch_plan(dedup.first_per_url(filled, order), delay, tie=order[-1])
