"""First row per key, in a stated order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_by(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row with the lowest ``order`` of each key.

    An aggregate, not a window: each task reduces its rows to one per key before the shuffle, so a URL
    that holds a third of the table sends one row per task and never gathers in one place. ``order`` must
    tell rows of a key apart, otherwise equal ones are settled by their other columns.
    """
    others = [c for c in rows.columns if c not in keys and c not in order]
    packed = F.struct(*[F.col(f"`{c}`") for c in (*order, *others)])
    best = rows.groupBy(*keys).agg(F.min(packed).alias("__first"))
    picked = {c: F.col(f"`{c}`") if c in keys else F.col("__first")[c].alias(c) for c in rows.columns}
    return best.select(*picked.values())


def first_per_page_url(candidates: DataFrame, page: str = "page_id") -> DataFrame:
    """The first link of each URL within its page, in the order in which links count."""
    return first_by(candidates, [page, "audio_url"], ["pass", "first", "second", "rank"])


def first_per_url(links: DataFrame, order: list[str]) -> DataFrame:
    """The first link of each URL over all pages and feeds."""
    return first_by(links, ["audio_url"], order)
