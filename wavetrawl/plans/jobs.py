"""Runs over lists of archives: what is pending is read, mined and written, one output per archive.

A run works through groups of archives and notes each group when its links are written, so one that is ended
loses at most the group it was in. Damaged archives are noted under ``errors`` and not under ``done``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from wavetrawl.operators.ordering import first_in_order, number_rows
from wavetrawl.plans import routes
from wavetrawl.sources import snapshots
from wavetrawl.sources.archives import BROKEN, scan_archives

# Archives that are read and noted together.
GROUP = 1_000

_KEEP = ("archive", "pos")


def _done(spark: SparkSession, out: str) -> DataFrame:
    try:
        return spark.read.schema("archive string").json(f"{out}/done")
    except AnalysisException:
        return spark.createDataFrame([], "archive string")


def pending_paths(
    spark: SparkSession, archives: DataFrame, out: str, max_files: int | None = None, overwrite: bool = False
) -> DataFrame:
    """The archives of a list (``url``) that have no output yet, of the first ``max_files`` in order."""
    chosen = first_in_order(archives.select("url").distinct(), ["url"], max_files)
    return snapshots.pending(snapshots.with_output_names(chosen), _done(spark, out), overwrite=overwrite)


def archives_of_range(spark: SparkSession, index: str, start: str, end: str, prefix: str = snapshots.DATA_PREFIX) -> DataFrame:
    """The archives of all snapshots of a range, ``snapshot_id, url``: index, range, path lists, paths.

    ``index`` and ``prefix`` name a copy that Spark can read. One path list per snapshot, that is per week, is named on
    the driver; the archives are not.
    """
    chosen = snapshots.select_snapshots(snapshots.read_snapshot_index(spark, index), start, end)
    lists = [row.url for row in snapshots.path_list_urls(chosen, prefix).collect()]
    if not lists:
        return spark.createDataFrame([], "snapshot_id string, url string")
    return snapshots.read_path_lists(spark, lists, prefix)


def _run(
    spark: SparkSession,
    archives: DataFrame,
    out: str,
    mine: Callable[[DataFrame], DataFrame],
    max_files: int | None,
    overwrite: bool,
    group: int,
    content_type: str | None = None,
) -> DataFrame:
    """Mine the pending archives into ``out/links`` and note them in ``out/done``.

    Links are written to one folder per archive, which a run replaces as a whole. The note comes last, so
    a run that fails in between is simply repeated. A damaged archive gives the links before the damage and a
    row in ``out/errors``; it stays pending. The list of archives stays a table: the driver only counts it, and hears
    the names of a group's damaged archives.
    """
    run = uuid.uuid4().hex
    pending = pending_paths(spark, archives, out, max_files, overwrite).select("archive", "url")
    todo = number_rows(pending, ["url"], "place")
    count = todo.count()
    for at in range(0, count, group):
        some = todo.filter(F.col("place").between(at, at + group - 1)).drop("place")
        damaged = _mine_group(some, out, mine, content_type)
        is_damaged = F.col("url").isin(damaged)
        if damaged:
            some.filter(is_damaged).write.mode("append").json(f"{out}/errors")
        sound = some.filter(~is_damaged).select("archive", F.lit(run).alias("run"))
        sound.coalesce(1).write.mode("append").json(f"{out}/done")
    if not count:
        return spark.createDataFrame([], "archive string")
    noted = spark.read.schema("archive string, run string").json(f"{out}/done")
    return noted.filter(F.col("run") == run).select("archive")


def _mine_group(
    paths: DataFrame, out: str, mine: Callable[[DataFrame], DataFrame], content_type: str | None
) -> list[str]:
    """Write the links of some archives, and give those that are damaged: seen by the same scan."""
    seen = Observation()
    broken = F.when(F.col("rec_type") == BROKEN, F.col("archive"))
    crawl = scan_archives(paths, rec_type="response", content_type=content_type, damage=True)
    links = mine(crawl.observe(seen, F.collect_set(broken).alias("damaged")))
    (
        links.withColumn("archive", F.element_at(F.split("archive", "/"), -1))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("archive")
        .json(f"{out}/links")
    )
    return list(seen.get["damaged"])


def mine_feeds(
    spark: SparkSession, archives: DataFrame, out: str, max_files: int | None = None, overwrite: bool = False,
    group: int = GROUP,
) -> DataFrame:
    """Feed links of the pending archives, with ``archive`` and ``pos`` for a global order.

    Returns the archives that were mined whole. ``group`` archives are read and noted together.
    """
    return _run(spark, archives, out, lambda r: routes.feed_links_of_records(r, _KEEP), max_files, overwrite, group)


def mine_pages(
    spark: SparkSession,
    archives: DataFrame,
    out: str,
    model: PipelineModel,
    language: str = "ja",
    max_files: int | None = None,
    overwrite: bool = False,
    group: int = GROUP,
) -> DataFrame:
    """Page links of the pending archives; otherwise as :func:`mine_feeds`."""

    def mine(crawl: DataFrame) -> DataFrame:
        return routes.page_links_of_records(crawl, model, language, _KEEP)

    return _run(spark, archives, out, mine, max_files, overwrite, group, content_type="html")
