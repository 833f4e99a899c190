"""Link tables: JSON lines, compaction to Parquet, publishing, language counts."""

from __future__ import annotations

import bz2
import sys
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wavetrawl import schemas
from wavetrawl.operators.ordering import materialise

FILES_PER_GROUP = 100
# Input bytes that one packed file holds at most, but for a larger single file that cannot be split.
TARGET_BYTES = 256 << 20
_PIECE = 1 << 20
# Up to so many damaged files are left out by a list in the scan's filter, more by a join.
_LISTED = 1000
_REJECT = "_corrupt_record"


def read_jsonl(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    """JSON lines with a declared schema: no inference, and texts such as "00123" stay texts."""
    return spark.read.schema(schema).json(path)


def write_jsonl(rows: DataFrame, path: str) -> None:
    """JSON lines in UTF-8, non-ASCII characters as they are, one folder of files."""
    rows.write.mode("overwrite").json(path)


def read_jsonl_with_rejects(
    spark: SparkSession, path: str, schema: T.StructType, without: DataFrame | None = None
) -> DataFrame:
    """JSON lines where a broken line becomes a row with ``_corrupt_record`` instead of an error.

    ``without`` names damaged files (``file``, as :func:`damaged_files` gives them), of which no line is read; a damaged
    file that it does not name is an error.
    """
    wide = T.StructType([*schema.fields, T.StructField(_REJECT, T.StringType())])
    reader, names = spark.read, []
    if without is not None:
        names = [row["file"] for row in without.limit(_LISTED).collect()]
        reader = reader.option("ignoreCorruptFiles", "true") if names else reader
    lines = reader.text(path).filter(F.trim("value") != "")
    if names:
        lines = lines.withColumn("file", F.col("_metadata.file_path"))
        if len(names) < _LISTED:
            lines = lines.filter(~F.col("file").isin(names))
        else:
            lines = lines.join(without.select("file"), "file", "left_anti")
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _REJECT}
    return lines.select(F.from_json("value", wide, options).alias("row")).select("row.*")


def _check(content: bytes, kind: str) -> str | None:
    """Why a compressed file cannot be read to its end, or None."""
    if kind == "gz":
        at, reader = 0, zlib.decompressobj(zlib.MAX_WBITS | 16)
        try:
            while at < len(content):
                piece = content[at : at + _PIECE]
                reader.decompress(piece)
                at += len(piece)
                while reader.eof and (rest := reader.unused_data):
                    # The next member of the file; zeros after a member are padding.
                    if not rest.strip(b"\0") and at >= len(content):
                        return None
                    reader = zlib.decompressobj(zlib.MAX_WBITS | 16)
                    reader.decompress(rest)
            return None if reader.eof else "cut"
        except zlib.error as error:
            return str(error)
    at, reader = 0, bz2.BZ2Decompressor()
    try:
        while at < len(content):
            piece = content[at : at + _PIECE]
            at += len(piece)
            while piece:
                if reader.eof:
                    reader = bz2.BZ2Decompressor()
                reader.decompress(piece)
                piece = reader.unused_data if reader.eof else b""
        return None if reader.eof else "cut"
    except OSError as error:
        return str(error)


def _damage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names = batch["file"].to_pylist()
        found = [_check(x.as_py(), name.rsplit(".", 1)[1].lower()) for x, name in zip(batch["content"], names)]
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(found, pa.string())], ["file", "reason"])


def _packing_session(spark: SparkSession, split_bytes: int) -> SparkSession:
    """A session that reads small files together, up to so many bytes a task, and hands whole files on one by one."""
    packing = spark.newSession()
    packing.conf.set("spark.sql.files.maxPartitionBytes", str(split_bytes))
    packing.conf.set("spark.sql.files.openCostInBytes", "1024")
    packing.conf.set("spark.sql.files.minPartitionNum", "1")
    packing.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")
    return packing


def damaged_files(spark: SparkSession, path: str) -> DataFrame:
    """The compressed files (gzip, bzip2) of a folder that cannot be read to their end: ``file, reason``.

    Each is unpacked once by a task, which holds the compressed bytes of one file at a time. Plain files have no end to
    miss: a cut line in one is a broken line.
    """
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    files = _packing_session(spark, TARGET_BYTES).read.format("binaryFile").load(path)
    packed = files.select(F.col("_metadata.file_path").alias("file"), "content").filter(r"file RLIKE '(?i)\\.(gz|bz2)$'")
    return packed.mapInArrow(_damage, "file string, reason string").filter("reason IS NOT NULL")


def compact_with_report(
    spark: SparkSession,
    path: str,
    out: str,
    schema: T.StructType,
    files_per_group: int = FILES_PER_GROUP,
    rejects: str | None = None,
    target_bytes: int = TARGET_BYTES,
) -> tuple[DataFrame, DataFrame]:
    """Pack JSON-lines files into Parquet files of up to ``files_per_group`` inputs and ``target_bytes`` of input each.

    First the inventory: numbers and sizes of the files, and which are damaged. A damaged file is left out whole, as
    its rows after the damage are lost and would not be missed. Then small files are read together by size, in pieces of
    an eighth of a Parquet file, and neighbouring pieces written together; no row is shuffled. Broken lines go to
    ``rejects`` if that is given, and never stop the job; the lines are parsed again for that only if there are any.

    Returns the packed table, and ``outcome, file, n``: lines ``packed`` and ``broken``, and each file ``damaged``.
    """
    sizes = spark.read.format("binaryFile").load(path).select("length")
    files = sizes.agg(F.count("*").alias("n"), F.coalesce(F.sum("length"), F.lit(0)).alias("size")).first()
    groups = max(1, -(-files["n"] // files_per_group), -(-files["size"] // target_bytes))
    damaged = materialise(damaged_files(spark, path), "damaged-files")
    packing = _packing_session(spark, max(1 << 12, files["size"] // (8 * groups)))
    read = read_jsonl_with_rejects(packing, path, schema, without=damaged)
    seen = Observation()
    broken = F.count_if(F.col(_REJECT).isNotNull())
    counted = read.observe(seen, F.count("*").alias("lines"), broken.alias("broken"))
    counted.filter(F.col(_REJECT).isNull()).select(*schema.names).coalesce(groups).write.mode("overwrite").parquet(out)
    lines = seen.get
    if rejects is not None:
        found = read if lines["broken"] else read.limit(0)
        found.filter(F.col(_REJECT).isNotNull()).select(_REJECT).write.mode("overwrite").text(rejects)
    counts = [("packed", None, lines["lines"] - lines["broken"]), ("broken", None, lines["broken"])]
    name = F.element_at(F.split("file", "/"), -1)
    report = spark.createDataFrame(counts, "outcome string, file string, n bigint").union(
        damaged.select(F.lit("damaged"), name, F.lit(1).cast("bigint"))
    )
    return spark.read.schema(schema).parquet(out), report


def compact_jsonl(spark: SparkSession, path: str, out: str, schema: T.StructType, **options) -> DataFrame:
    """The packed table of :func:`compact_with_report`."""
    return compact_with_report(spark, path, out, schema, **options)[0]


def read_published(spark: SparkSession, path: str, schema: T.StructType = schemas.FEED_LINKS) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def publish(links: DataFrame, path: str, without: tuple[str, ...] = ("license",)) -> None:
    """Write a link table without the columns that are not for publishing."""
    links.drop(*without).write.mode("overwrite").parquet(path)


def read_language_counts(spark: SparkSession, path: str) -> DataFrame:
    """Language counts from CSV. Tags are case-sensitive texts: "NO" and "no" are two languages."""
    counts = spark.read.schema(schemas.LANGUAGE_COUNTS).csv(path, header=True)
    return counts.withColumn("language", F.coalesce("language", F.lit("")))


def union_links(page_links: DataFrame, feed_links: DataFrame) -> DataFrame:
    """Page and feed links in one table, told apart by ``link_source``; columns one side lacks are NULL."""
    return page_links.withColumn("link_source", F.lit("page")).unionByName(
        feed_links.withColumn("link_source", F.lit("feed")), allowMissingColumns=True
    )
