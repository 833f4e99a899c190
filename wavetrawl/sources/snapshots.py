"""Planning over crawl snapshots and their archives."""

from __future__ import annotations

import warnings
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wavetrawl import schemas

# Where the public crawl keeps its data, and the first year with weekly snapshots.
DATA_PREFIX = "https://data.commoncrawl.org"
FIRST_YEAR = 2013


def read_snapshot_index(spark: SparkSession, path: str) -> DataFrame:
    """The snapshot index: one JSON array of objects, of which only ``id`` is read."""
    return spark.read.schema(schemas.SNAPSHOTS).json(path, multiLine=True)


def _monday(snapshot: str) -> date:
    year, week = map(int, snapshot.split("-"))
    return date.fromisocalendar(year, week, 1)


def check_range(start: str, end: str) -> tuple[date, date]:
    """The Mondays of a snapshot range such as ``2020-05`` to ``2025-18``; an inverted range is an error."""
    first, last = _monday(start), _monday(end)
    if first > last:
        raise ValueError(f"snapshot {start} is later than snapshot {end}")
    if min(int(start[:4]), int(end[:4])) < FIRST_YEAR:
        warnings.warn(f"snapshots before {FIRST_YEAR} are left out", stacklevel=2)
    return first, last


def select_snapshots(snapshots: DataFrame, start: str, end: str) -> DataFrame:
    """Snapshots whose week lies in the range, both ends included: adds ``snapshot_id, monday``.

    An id counts if exactly a year and a week follow its two leading parts.
    """
    first, last = check_range(start, end)
    parts = F.split("id", "-")
    year = F.try_element_at(parts, F.lit(3)).try_cast("int")
    week = F.try_element_at(parts, F.lit(4)).try_cast("int")
    dated = (
        snapshots.filter(F.size(parts) == 4)
        .withColumn("year", year)
        .withColumn("week", week)
        .filter(F.col("year").between(FIRST_YEAR, 9999) & F.col("week").between(1, 53))
    )
    monday = F.date_add(
        F.date_trunc("week", F.make_date("year", F.lit(1), F.lit(4))).cast("date"), (F.col("week") - 1) * 7
    )
    return (
        dated.withColumn("monday", monday)
        .filter((F.weekofyear("monday") == F.col("week")) & F.col("monday").between(F.lit(first), F.lit(last)))
        .withColumn("snapshot_id", F.format_string("%d-%02d", "year", "week"))
        .drop("year", "week")
    )


def path_list_urls(selected: DataFrame, prefix: str = DATA_PREFIX) -> DataFrame:
    """The path-list URL of each selected snapshot, one row per snapshot: ``snapshot_id, url``."""
    url = F.concat(
        _below(prefix, F.lit("crawl-data/CC-MAIN")), F.lit("-"), F.col("snapshot_id"), F.lit("/warc.paths.gz")
    )
    return selected.select("snapshot_id").distinct().withColumn("url", url)


def _below(prefix: str, path: Column) -> Column:
    """A path under a prefix of any scheme, object stores included; what names its own scheme stays as it is."""
    relative = F.concat(F.lit(prefix.rstrip("/") + "/"), F.ltrim(path, F.lit("/")))
    return F.when(path.rlike("^[a-zA-Z][a-zA-Z0-9+.-]*:/"), path).otherwise(relative)


def read_path_lists(spark: SparkSession, paths: str | list[str], prefix: str = DATA_PREFIX) -> DataFrame:
    """Archive path lists (plain or gzip, one path a line) as ``snapshot_id, url``.

    Blank lines are dropped, paths are joined to the prefix. The snapshot is named by a folder
    ``snapshot_id=YYYY-WW``, else by ``CC-MAIN-YYYY-WW`` in the path, else by a file ``YYYY-WW.txt``, plain or gzip.
    Other parts of a file's name, which writers make up, are not looked at; a file that names none is an error.
    """
    named = [
        F.nullif(F.regexp_extract("file", pattern, 1), F.lit(""))
        for pattern in (
            r"/snapshot_id=([0-9]{4}-[0-9]{2})/",
            r"CC-MAIN-([0-9]{4}-[0-9]{2})(?![0-9])",
            r"/([0-9]{4}-[0-9]{2})[.]txt(?:[.]gz)?$",
        )
    ]
    unnamed = F.raise_error(F.concat(F.lit("no snapshot in the path of "), F.col("file")))
    lines = spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("file"))
    return lines.filter(F.col("value") != "").select(
        F.coalesce(*named, unnamed.cast("string")).alias("snapshot_id"),
        _below(prefix, F.col("value")).alias("url"),
    )


def split_path_lists(lists: DataFrame, prefix: str = DATA_PREFIX) -> DataFrame:
    """Path lists held as one text each (``snapshot_id, body``) to ``snapshot_id, url``."""
    return (
        lists.select("snapshot_id", F.explode(F.split("body", "\n")).alias("value"))
        .filter(F.col("value") != "")
        .select("snapshot_id", _below(prefix, F.col("value")).alias("url"))
    )


def write_path_lists(paths: DataFrame, folder: str) -> None:
    """One folder of text files per snapshot, one URL a line."""
    paths.select("snapshot_id", "url").write.mode("overwrite").partitionBy("snapshot_id").text(folder)


def with_output_names(archives: DataFrame, url: str = "url") -> DataFrame:
    """Add ``archive`` (base name), ``output_name`` and ``output_dir`` of each archive URL."""
    base = F.element_at(F.split(url, "/"), -1)
    return archives.withColumn("archive", base).select(
        "*",
        F.replace("archive", F.lit(".warc.gz"), F.lit(".jsonl")).alias("output_name"),
        F.substring_index("archive", ".", 1).alias("output_dir"),
    )


def pending(archives: DataFrame, done: DataFrame, key: str = "archive", overwrite: bool = False) -> DataFrame:
    """The archives without an output yet, or all of them to overwrite."""
    return archives if overwrite else archives.join(done.select(key).distinct(), key, "left_anti")
