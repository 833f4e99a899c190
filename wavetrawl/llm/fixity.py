"""Fixity audit of WARC archive replicas by Merkle trees.

Each record is hashed; ordered runs of records (offset ranges) are hashed over their records, an archive over its runs,
and archives over the prefixes of their names' hashes up to one root per replica. Two replicas are compared from the
roots down: only children of differing nodes are looked at, to the records that differ.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wavetrawl.llm.common import materialise

# Records of one run, and the hex digits of an archive's name hash that place it below the root.
RUN = 16
PREFIX = 3
ARCHIVE_RECORDS = 256
ARCHIVE_BYTES = 4 << 20

_MAGIC = b"WARC/1.0\r\n"
_LENGTH = re.compile(rb"\r\nContent-Length: *(\d+)\r\n")
_NAME = re.compile(rb"\r\nWARC-Record-ID: *<([^>\r]*)>\r\n")

RECORD_LEVEL, RUN_LEVEL, ARCHIVE_LEVEL = 0, 1, 2
_NODE = (
    "level int, archive string, parent string, node string, digest string, begin bigint, length bigint,"
    " record string, twin bigint, payload string"
)


def record_bytes(name: str, url: str | None, payload: bytes) -> bytes:
    target = re.sub(r"[\r\n]", " ", url or "").encode("utf-8", "replace")
    head = b"WARC-Type: resource\r\nWARC-Record-ID: <%s>\r\nWARC-Target-URI: %s\r\nContent-Length: %d\r\n\r\n"
    return _MAGIC + head % (name.encode(), target, len(payload)) + payload + b"\r\n\r\n"


def records_of(content: bytes):
    """The records ``(begin, end, name, payload)`` of an archive, which cover it without gaps.

    Bytes that are no record, up to the next one, count as a record without a name.
    """
    at, size = 0, len(content)
    while at < size:
        head_end = content.find(b"\r\n\r\n", at) if content.startswith(_MAGIC, at) else -1
        head = content[at : head_end + 2] if head_end >= 0 else b""
        length, name = _LENGTH.search(head), _NAME.search(head)
        end = head_end + 8 + int(length[1]) if length else -1
        if length and end <= size and content[end - 4 : end] == b"\r\n\r\n":
            yield at, end, name[1].decode("utf-8", "replace") if name else "", content[head_end + 4 : end - 4]
        else:
            follow = content.find(b"\r\n" + _MAGIC, at + 1)
            end = follow + 2 if follow >= 0 else size
            yield at, end, "", content[at:end]
        at = end


def _sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def archive_nodes(archive: str, content: bytes) -> list[tuple]:
    """The tree of one archive: its records, its runs and itself."""
    rows, runs, seen = [], [], Counter()
    leaves = list(records_of(content))
    for first in range(0, len(leaves), RUN):
        run, digests = f"{archive}/{first // RUN}", []
        for begin, end, name, payload in leaves[first : first + RUN]:
            digest = _sha(content[begin:end])
            rows.append((RECORD_LEVEL, archive, run, f"{run}/{begin}", digest, begin, end - begin, name, seen[name], _sha(payload)))
            seen[name] += 1
            digests.append(digest)
        begin, end = leaves[first][0], leaves[min(first + RUN, len(leaves)) - 1][1]
        runs.append((RUN_LEVEL, archive, archive, run, _sha("".join(digests).encode()), begin, end - begin, None, None, None))
    top = _sha("".join(run[4] for run in runs).encode())
    parent = _sha(archive.encode())[:PREFIX]
    return [*rows, *runs, (ARCHIVE_LEVEL, archive, parent, archive, top, 0, len(content), None, None, None)]


def merkle_nodes(archives: DataFrame) -> DataFrame:
    """All nodes of a replica (``archive, content``), written once. A null content counts as empty.

    Levels above the archives hash their children's names and digests in the order of names; a node of the
    lowest of them has a ``16 ** PREFIX``-th of the archives as children, so ``PREFIX`` grows with their number.
    """
    columns = [field.split(" ")[0] for field in _NODE.split(", ")]

    def nodes(batches):
        for batch in batches:
            for archive, content in zip(batch["archive"], batch["content"]):
                yield pd.DataFrame(archive_nodes(archive, bytes(content or b"")), columns=columns)

    rows = archives.select("archive", "content").filter("archive IS NOT NULL").mapInPandas(nodes, _NODE)
    below = materialise(rows, "merkle-nodes")
    levels, level = [below], below.filter(F.col("level") == ARCHIVE_LEVEL)
    for digits in range(PREFIX, -1, -1):
        child = F.concat_ws(" ", F.array_join(F.transform(
            F.sort_array(F.collect_list(F.struct("node", "digest"))), lambda x: F.concat_ws(":", x["node"], x["digest"])
        ), ","))
        level = level.groupBy(F.col("parent").alias("node")).agg(F.sha2(child, 256).alias("digest"))
        level = materialise(level.select(
            F.lit(ARCHIVE_LEVEL + 1 + PREFIX - digits).alias("level"), F.lit(None).cast("string").alias("archive"),
            F.substring("node", 1, digits - 1).alias("parent") if digits else F.lit(None).cast("string").alias("parent"),
            "node", "digest",
        ), "merkle-level")
        levels.append(level)
    result = levels[0]
    for upper in levels[1:]:
        result = result.unionByName(upper, allowMissingColumns=True)
    return result


def audit(left: DataFrame, right: DataFrame) -> DataFrame:
    """The records that differ between two replicas, each a table ``archive, content``.

    Columns ``archive, record, status, left_offset, left_length, left_payload, right_offset, right_length,
    right_payload``, payloads as SHA-256. ``status`` is ``altered``, ``missing`` (on the right) or ``extra``. Records
    are told apart by archive, name and how many of that name came before; records that only moved do not differ.
    Equal replicas, or empty ones, give no rows. Archives are repeated in neither replica.
    """
    a, b = merkle_nodes(left), merkle_nodes(right)
    levels = range(ARCHIVE_LEVEL + 1 + PREFIX, RECORD_LEVEL, -1)
    open_nodes = None
    for level in levels:
        here = [side.filter(F.col("level") == level).select("parent", "node", "digest") for side in (a, b)]
        if open_nodes is not None:
            here = [side.join(open_nodes, side["parent"] == open_nodes["open"], "left_semi") for side in here]
        one = here[0].select("node", F.col("digest").alias("a"))
        two = here[1].select("node", F.col("digest").alias("b"))
        differing = one.join(two, "node", "full_outer").filter(~F.col("a").eqNullSafe(F.col("b")))
        open_nodes = materialise(differing.select(F.col("node").alias("open")), "differing")
    sides = []
    for name, side in (("left", a), ("right", b)):
        leaves = side.filter(F.col("level") == RECORD_LEVEL)
        leaves = leaves.join(open_nodes, leaves["parent"] == open_nodes["open"], "left_semi")
        sides.append(leaves.select(
            "archive", "record", "twin", F.col("digest").alias(f"{name}_digest"), F.col("begin").alias(f"{name}_offset"),
            F.col("length").alias(f"{name}_length"), F.col("payload").alias(f"{name}_payload"),
        ))
    found = sides[0].join(sides[1], ["archive", "record", "twin"], "full_outer")
    found = found.filter(~F.col("left_digest").eqNullSafe(F.col("right_digest")))
    status = F.when(F.col("right_digest").isNull(), "missing").when(F.col("left_digest").isNull(), "extra").otherwise("altered")
    return found.withColumn("status", status).drop("left_digest", "right_digest", "twin")


def write_replicas(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pages as archives, and a second replica with damage that the pages' ids decide, as ``archive, content``.

    By the first two hex digits of the id's MD5: 00 has its first character replaced by X, 01 is missing, 02 occurs
    twice. Archives hold neighbouring pages as they lie, up to a bound of records and bytes.
    """

    def pack(batches):
        from pyspark import TaskContext

        part, number, both, count = TaskContext.get().partitionId(), 0, [[], []], 0

        def archive():
            name = f"part-{part:06d}-{number:06d}.warc"
            return pd.DataFrame({"replica": ["a", "b"], "archive": [name, name], "content": [b"".join(x) for x in both]})

        for batch in batches:
            for page, url, html, mark in zip(batch["page"], batch["url"], batch["html"], batch["mark"]):
                payload, name = html.encode("utf-8", "replace"), f"urn:page:{page}"
                record = record_bytes(name, url, payload)
                both[0].append(record)
                if mark == "00":
                    both[1].append(record_bytes(name, url, b"X" + payload[1:]))
                elif mark != "01":
                    both[1] += [record, record] if mark == "02" else [record]
                count += len(record)
                if len(both[0]) >= ARCHIVE_RECORDS or count >= ARCHIVE_BYTES:
                    yield archive()
                    number, both, count = number + 1, [[], []], 0
        if both[0]:
            yield archive()

    page = F.coalesce(F.col("page_id").cast("string"), F.lit("none"))
    rows = pages.select(
        page.alias("page"), "url", F.coalesce("html", F.lit("")).alias("html"), F.substring(F.md5(page), 1, 2).alias("mark")
    )
    written = materialise(rows.mapInPandas(pack, "replica string, archive string, content binary"), "replicas")
    return tuple(written.filter(F.col("replica") == side).select("archive", "content") for side in ("a", "b"))
