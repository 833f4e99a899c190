"""Scan of web-crawl archives (WARC files) as a table.

A file is read by one task, as a gzip stream cannot be split. Files are read as a stream through the Arrow file
systems, so local, HDFS and object-store paths all work and no archive is ever held in memory.

:func:`scan_archives` reads the archives of a table of paths, which Spark deals to its tasks and never gathers; record
type, content type and columns are its arguments. :func:`read_archives` is the data source for a short list of paths,
with filters on type and content type pushed into it. Both spare unwanted bodies their decoding.
"""

from __future__ import annotations

import gzip
import io
import re
import sys
import zlib
from collections.abc import Iterator
from typing import BinaryIO

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, InputPartition, StringContains

from wavetrawl.session import default_store

FORMAT = "crawl_archive"
BROKEN = "broken"
COLUMNS = {
    "archive": "string", "pos": "bigint", "rec_type": "string", "target_uri": "string", "content_type": "string",
    "payload": "binary",
}
_SCHEMA = ", ".join(f"{name} {kind}" for name, kind in COLUMNS.items())
# Tasks of one scan at most; beyond that a task reads several archives.
MAX_TASKS = 100_000
_BATCH_BYTES = 16 << 20
_BATCH_ROWS = 2048
_SCHEME = re.compile("[a-zA-Z][a-zA-Z0-9+.-]*:/")


def _headers(block: bytes) -> dict[str, str]:
    pairs = (line.partition(b":") for line in block.split(b"\r\n"))
    return {k.strip().lower().decode("latin-1"): v.strip().decode("utf-8", "ignore") for k, _, v in pairs if k.strip()}


def _header_block(stream: BinaryIO) -> bytes:
    lines = []
    while True:
        line = stream.readline()
        if not line.strip():
            return b"\r\n".join(lines)
        lines.append(line.rstrip(b"\r\n"))


def _dechunk(body: bytes) -> bytes:
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        try:
            size = int(body[at:end].split(b";")[0], 16) if end > 0 else -1
        except ValueError:
            size = -1
        if size < 0:
            return body if not out else b"".join(out)
        if size == 0:
            return b"".join(out)
        out.append(body[end + 2 : end + 2 + size])
        at = end + 2 + size + 2


def _body(headers: dict[str, str], body: bytes) -> bytes:
    if headers.get("transfer-encoding", "").lower() == "chunked":
        body = _dechunk(body)
    if headers.get("content-encoding", "").lower() in ("gzip", "x-gzip", "deflate"):
        for window in (zlib.MAX_WBITS | 32, -zlib.MAX_WBITS):
            try:
                return zlib.decompress(body, window)
            except zlib.error:
                continue
    return body


def read_records(
    stream: BinaryIO,
    archive: str,
    rec_type: str | None = None,
    damage: bool = False,
    content_type: str | None = None,
    bodies: bool = True,
) -> Iterator[tuple]:
    """The records of one uncompressed archive stream; those of unwanted types are passed over.

    ``content_type`` must occur in a record's content type. Without ``bodies`` payloads are None. A stream that is cut or damaged yields the records before the damage and then one of type ``broken``,
    so that the loss can be seen; where only some types are wanted, that row comes only if ``damage`` is set.
    Input/output errors are not damage: they fail the task, which Spark then runs again.
    """
    pos = -1
    try:
        while True:
            line = stream.readline()
            while line and not line.strip():
                line = stream.readline()
            if not line:
                return
            pos += 1
            if not line.startswith(b"WARC/"):
                raise ValueError("no record header")
            fields = _headers(_header_block(stream))
            size = int(fields.get("content-length", "0"))
            block = stream.read(size)
            if len(block) < size:
                raise EOFError
            kind = fields.get("warc-type")
            if rec_type is not None and kind != rec_type:
                continue
            http, payload = {}, block
            if block.startswith(b"HTTP/"):
                head, _, payload = block.partition(b"\r\n\r\n")
                http = _headers(head.partition(b"\r\n")[2])
            if content_type is not None and content_type not in (http.get("content-type") or ""):
                continue
            payload = _body(http, payload) if bodies else None
            yield archive, pos, kind, fields.get("warc-target-uri"), http.get("content-type"), payload
    except (EOFError, ValueError, gzip.BadGzipFile, zlib.error):
        if damage or (rec_type in (None, BROKEN) and content_type is None):
            yield archive, pos, BROKEN, None, None, b"" if bodies else None


def _batches(path: str, store: str, columns: tuple[str, ...], **wanted) -> Iterator:
    """The wanted records of one archive file as Arrow batches of bounded size."""
    import pyarrow as pa
    from pyarrow import fs

    kinds = {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary()}
    schema = pa.schema([(name, kinds[COLUMNS[name]]) for name in columns])
    places = [list(COLUMNS).index(name) for name in columns]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        values = list(zip(*rows))
        return pa.RecordBatch.from_arrays([pa.array(values[i], f.type) for i, f in zip(places, schema)], schema=schema)

    files, inner = fs.FileSystem.from_uri(path if _SCHEME.match(path) else f"{store}/{path.lstrip('/')}")
    rows, size = [], 0
    with files.open_input_stream(inner, compression=None) as raw:
        stream = gzip.GzipFile(fileobj=raw) if path.endswith(".gz") else io.BufferedReader(raw)
        for row in read_records(stream, path, bodies="payload" in columns, **wanted):
            rows.append(row)
            size += len(row[-1] or b"")
            if size >= _BATCH_BYTES or len(rows) >= _BATCH_ROWS:
                yield batch(rows)
                rows, size = [], 0
    if rows:
        yield batch(rows)


class _ArchiveFile(InputPartition):
    def __init__(self, path: str):
        super().__init__(path)
        self.path = path


class _ArchiveReader(DataSourceReader):
    def __init__(self, paths: list[str], store: str, rec_type: str | None, damage: bool):
        self.paths = paths
        self.store = store
        self.rec_type = rec_type
        self.content_type: str | None = None
        self.damage = damage

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for condition in filters:
            if isinstance(condition, EqualTo) and condition.attribute == ("rec_type",) and self.rec_type is None:
                self.rec_type = condition.value
            elif (
                isinstance(condition, StringContains)
                and condition.attribute == ("content_type",)
                and self.content_type is None
                and not self.damage
            ):
                self.content_type = condition.value
            else:
                yield condition

    def partitions(self) -> list[InputPartition]:
        return [_ArchiveFile(path) for path in self.paths]

    def read(self, partition: InputPartition):
        return _batches(
            partition.path, self.store, tuple(COLUMNS), rec_type=self.rec_type, damage=self.damage,
            content_type=self.content_type,
        )


class CrawlArchives(DataSource):
    """``spark.read.format("crawl_archive")`` with options ``paths`` (one a line), ``rec_type``, ``damage``, ``store``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return _SCHEMA

    def reader(self, schema) -> DataSourceReader:
        paths = [p for p in self.options.get("paths", self.options.get("path", "")).splitlines() if p]
        return _ArchiveReader(
            paths, self.options.get("store", "file://"), self.options.get("rec_type"), self.options.get("damage") == "true"
        )


def read_archives(
    spark: SparkSession, paths: list[str], rec_type: str | None = None, damage: bool = False
) -> DataFrame:
    """A list of archive files as crawl records; ``rec_type`` keeps one type.

    Filters on the type, and on a text in the content type, are pushed down. ``damage`` adds the ``broken`` row of each
    damaged archive to the records of that type. For many archives use :func:`scan_archives`.
    """
    # Workers need not have this package installed for the reader that runs there.
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(CrawlArchives)
    reader = spark.read.format(FORMAT).option("paths", "\n".join(paths)).option("store", default_store(spark))
    if rec_type is not None:
        reader = reader.option("rec_type", rec_type).option("damage", "true" if damage else "false")
    return reader.load()


def scan_archives(
    paths: DataFrame,
    url: str = "url",
    rec_type: str | None = None,
    content_type: str | None = None,
    columns: tuple[str, ...] = tuple(COLUMNS),
    damage: bool = False,
) -> DataFrame:
    """The records of the archives named by a table of paths, each path once; null paths are left out.

    Paths are dealt to tasks by range, so that a task reads one archive (up to ``MAX_TASKS`` of them); the paths stay in
    the cluster. ``rec_type`` keeps one type, ``content_type`` the records in whose content type that text occurs, and
    only ``columns`` leave the reader: without ``payload`` no body is decoded. ``damage`` adds a ``broken`` row for each
    damaged archive, whatever else is kept.
    """
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    store = default_store(paths.sparkSession)
    names = paths.select(F.col(url).alias("path")).filter(F.col("path").isNotNull()).distinct()
    tasks = max(1, min(names.count(), MAX_TASKS))

    def read(batches: Iterator) -> Iterator:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                yield from _batches(path, store, columns, rec_type=rec_type, content_type=content_type, damage=damage)

    kinds = ", ".join(f"{name} {COLUMNS[name]}" for name in columns)
    return names.repartitionByRange(tasks, "path").mapInArrow(read, kinds)
