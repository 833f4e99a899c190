"""Inputs for the registered queries, derived from the given tables.

The given tables hold no audio mark-up, feeds or archives. Each input here is one SQL text over them that
Spark and the checking engine both run, so both sides start from the same rows.
"""

from __future__ import annotations

import gzip
import sys
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wavetrawl.operators.ordering import materialise
from wavetrawl.session import qualified

TABLES = ("pages", "documents", "labels", "events", "orders", "customer", "nation")

PAGES = """
SELECT page_id, url, replace(
  CASE WHEN page_id % 5 = 0 THEN regexp_replace(html, '<html lang="[a-z]+">', '<html lang="ja">') ELSE html END,
  '</article>',
  concat(CASE page_id % 6
    WHEN 0 THEN concat('<p>Listen <audio title="Episode ', cast(page_id AS string), '" src="/ep/',
      cast(page_id AS string), '.mp3"></audio> now</p>')
    WHEN 1 THEN concat('<div title="<b>" data-license="CC-BY">Show <audio><source src="a', cast(page_id AS string),
      '.ogg"><source src="notes.txt"></audio> end</div>')
    WHEN 2 THEN concat('<p>Get <a data-note="1 > 0" href="https://cdn.example.org/f/', cast(page_id AS string),
      '.MP3?dl=1">the file</a></p>')
    WHEN 3 THEN concat('<p>Twice <a href="//cdn.example.org/x/../', cast(page_id AS string),
      '.wav">one</a> <a href="//cdn.example.org/x/../', cast(page_id AS string), '.wav">two</a></p>')
    WHEN 4 THEN concat('<object data="/no/', cast(page_id AS string), '.mp3"></object><link href="/l/',
      cast(page_id AS string), '.flac">')
    ELSE concat('<p>第', cast(page_id AS string), '回の放送です。</p><p>次回予告</p><div>お楽しみに！</div><p>短い</p>') END,
    '</article>')) AS html
FROM pages"""

LINKS = """
SELECT o_orderkey AS link_pos,
  concat('part-', lpad(cast(o_custkey % 50 AS string), 5, '0')) AS archive,
  CASE WHEN o_orderkey % 97 = 5 THEN NULL WHEN o_orderkey % 97 = 7 THEN '' ELSE concat('https://',
    CASE o_custkey % 10
      WHEN 0 THEN 'cdn.example.com' WHEN 1 THEN 'a.b.example.co.jp' WHEN 2 THEN 'media.example.co.uk'
      WHEN 3 THEN '192.0.2.1' WHEN 4 THEN 'files.example.org:8080' WHEN 5 THEN 'user@dl.podcast.com.au'
      WHEN 6 THEN 'localhost' WHEN 7 THEN 'deep.city.kawasaki.jp' WHEN 8 THEN 'shop.foo.ck'
      WHEN 9 THEN CASE WHEN o_orderkey % 2 = 0 THEN 'a.show.pod.xyz' ELSE 'cdn.example.com' END
      ELSE 'cdn.example.com' END,
    '/ep/', cast(o_orderkey % 5000 AS string), '.mp3') END AS audio_url,
  concat('注文 ', cast(o_orderkey AS string)) AS title,
  CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE o_orderpriority END AS description,
  CASE c_nationkey % 9
    WHEN 0 THEN 'ja' WHEN 1 THEN 'ja-JP' WHEN 2 THEN 'ja_JP' WHEN 3 THEN 'ja-jp' WHEN 4 THEN 'en'
    WHEN 5 THEN 'en-us' WHEN 6 THEN 'en-US' WHEN 7 THEN 'de' ELSE '' END AS language,
  concat('https://pages.example.org/', cast(o_custkey AS string)) AS page_url,
  CASE WHEN o_orderkey % 3 = 0 THEN 'CC-BY' ELSE '' END AS license
FROM orders JOIN customer ON o_custkey = c_custkey"""

_ITEM = """CASE {kind}
  WHEN 0 THEN concat('<item><title>Order ', key, ' &amp; more</title><description> ', o_orderpriority,
    ' </description><enclosure url="https://a.example.com/', key, '.mp3" length="1"/></item>')
  WHEN 1 THEN concat('<item><title>Order ', key, '</title><media:group><media:content url="https://a.example.com/',
    key, '.m4a"/></media:group></item>')
  WHEN 2 THEN concat('<item><title>Order ', key, '</title><enclosure url="https://a.example.com/', key,
    '.MP3"/></item>')
  ELSE concat('<item><enclosure url="https://a.example.com/', key, '.mp3?x=1"/></item>') END"""

# One feed per order with two items of different kinds, some feeds broken or of other dialects.
FEEDS = f"""
SELECT feed_id, target_uri, content_type, CASE shape
  WHEN 'rdf' THEN concat('<?xml version="1.0"?><rdf:RDF><channel><language>', lang, '</language></channel>',
    item_a, item_b, '</rdf:RDF>')
  WHEN 'cut' THEN concat('<rss><channel><language>', lang, '</language>', item_a, '<item><title>cut')
  WHEN 'stray' THEN concat('<rss><channel><language>', lang, '</language>',
    replace(item_a, '<title>', '<title>&nbsp;'), item_b, '</channel></rss>')
  WHEN 'deep' THEN concat('<rss xmlns:media="http://search.yahoo.com/mrss/"><channel><language>', lang,
    '</language><!-- <item> --><list><part>', replace(replace(item_a, '<enclosure', '<files><enclosure'),
    '/></item>', '/></files></item>'), item_b,
    '</part></list></channel></rss>')
  WHEN 'late' THEN concat('<rss xmlns:media="http://search.yahoo.com/mrss/"><channel><language>', lang, '</language>',
    replace(item_a, '<media:group>', '<media:group/><media:group><media:content url=""/></media:group><media:group>'), item_b,
    '</channel></rss>')
  WHEN 'junk' THEN '<rss><channel><title>no end'
  WHEN 'atom' THEN '<feed><entry><title>x</title></entry></feed>'
  ELSE concat(' <rss xmlns:media="http://search.yahoo.com/mrss/"><channel><title>', c_name,
    '</title><language> ', lang, ' </language>', item_a, item_b, '</channel></rss>') END AS payload
FROM (SELECT o_orderkey AS feed_id, concat('https://feeds.example.org/', key) AS target_uri,
  CASE WHEN o_orderkey % 2 = 0 THEN 'application/rss+xml' ELSE 'application/octet-stream' END AS content_type,
  CASE WHEN o_orderkey % 11 = 3 THEN 'rdf' WHEN o_orderkey % 13 = 4 THEN 'cut' WHEN o_orderkey % 17 = 5 THEN 'junk'
    WHEN o_orderkey % 19 = 6 THEN 'atom' WHEN o_orderkey % 23 = 7 THEN 'stray' WHEN o_orderkey % 29 = 8 THEN 'deep'
    WHEN o_orderkey % 31 = 9 THEN 'late' ELSE 'rss' END AS shape,
  lower(n_name) AS lang, c_name, {_ITEM.format(kind='o_orderkey % 4')} AS item_a,
  {_ITEM.format(kind='(o_orderkey + 1) % 4')} AS item_b
  FROM (SELECT *, cast(o_orderkey AS string) AS key FROM orders) o
  JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey) f"""

RECORDS = f"""
SELECT 'p' AS source, page_id AS record_id, CASE WHEN page_id % 7 = 0 THEN 'request' ELSE 'response' END AS rec_type,
  url AS target_uri, CASE page_id % 4 WHEN 0 THEN 'text/html; charset=utf-8' WHEN 1 THEN 'application/xhtml+xml'
    WHEN 2 THEN 'TEXT/HTML' ELSE NULL END AS content_type, html AS body
FROM ({PAGES}) p
UNION ALL
SELECT 'f', feed_id, 'response', target_uri, content_type, payload FROM ({FEEDS}) f"""

SNAPSHOTS = """
SELECT o_orderkey AS row_id, CASE o_orderkey % 20
  WHEN 0 THEN concat('CC-MAIN-', y) WHEN 1 THEN concat('CC-MAIN-', y, '-', w, '-extra')
  WHEN 2 THEN concat('CC-MAIN-', y, '-xx') ELSE concat('CC-MAIN-', y, '-', w) END AS id
FROM (SELECT o_orderkey, cast(2010 + o_custkey % 15 AS string) AS y, lpad(cast(o_orderkey % 55 AS string), 2, '0') AS w
  FROM orders) o"""

ARCHIVE_PATHS = """
SELECT o_orderkey AS row_id, o_orderstatus AS state, concat(cast(2013 + o_custkey % 8 AS string), '-18') AS snapshot_id,
  concat('crawl-data/CC-MAIN-', cast(2013 + o_custkey % 8 AS string), '-18/segments/', cast(o_custkey AS string),
    '/warc/CC-MAIN-', lpad(cast(o_orderkey AS string), 10, '0'), '.warc.gz') AS path
FROM orders"""

ITEMS = f"""
SELECT link_pos, audio_url, CASE link_pos % 9
    WHEN 0 THEN 'audio/mpeg' WHEN 1 THEN 'audio/mp3; x' WHEN 2 THEN 'audio/wav' WHEN 3 THEN 'audio/wave'
    WHEN 4 THEN 'audio/flac' WHEN 5 THEN 'application/ogg' WHEN 6 THEN 'audio/ogg' WHEN 7 THEN NULL
    ELSE 'text/html' END AS content_type,
  CASE WHEN link_pos % 31 = 3 THEN 'timeout' ELSE NULL END AS error,
  CASE WHEN link_pos % 29 = 4 THEN NULL WHEN link_pos % 29 = 5 THEN '' ELSE title END AS body
FROM (SELECT link_pos, title, CASE link_pos % 7
    WHEN 0 THEN 'https://h.example.com/A.WAV?x=1' WHEN 1 THEN 'https://h.example.com/a.m4a#t'
    WHEN 2 THEN 'https://h.example.com/a.aac' WHEN 3 THEN 'https://h.example.com/a.flac'
    WHEN 4 THEN 'https://h.example.com/x?f=a.ogg' WHEN 5 THEN 'https://h.example.com/a.ogg' ELSE audio_url END AS audio_url
  FROM ({LINKS}) l) i"""

DOCUMENTS = """
SELECT doc_id, lang, CASE WHEN doc_id % 7 = 0
  THEN translate(lower(text), 'aeioutnrsl', 'あいうえおたなりさる') ELSE text END AS text
FROM documents"""


# Charsets, and the characters that stand for fourteen frequent letters in a text of that charset.
CHARSETS = (
    ("cp1251", "оеаинтсрвлкмдп"), ("gb18030", "的一是不了在人有我他这个们中"), ("big5", "的一是不了在人有我他這個們中"),
    ("cp949", "이다는에을의가고하은를한도지"), ("shift_jis", "のにをはがとでたしテスト音声"), ("euc_jp", "のにをはがとでたしテスト音声"),
    ("utf-16", "etaoinshrdlucm"), ("utf-32", "etaoinshrdlucm"),
)

# Long texts in plain letters, every second one made a text of one of the charsets.
SCRIPTS = f"""
SELECT doc_id, charset, CASE charset {' '.join(f"WHEN '{c}' THEN translate(text, 'etaoinshrdlucm', '{to}')" for c, to in CHARSETS)}
  ELSE text END AS text
FROM (SELECT doc_id, text, CASE WHEN length(text) < 300 OR octet_length(text) <> length(text) THEN NULL
    {' '.join(f"WHEN doc_id % 16 = {i} THEN '{c}'" for i, (c, _) in enumerate(CHARSETS))} END AS charset FROM documents) s"""


def encoded(text: str, charset: str) -> Column:
    """The bytes of a text in the charset that its row names, with a byte-order mark where it has one; else null."""
    cloudpickle.register_pickle_by_value(sys.modules[__name__])

    @F.pandas_udf("binary")
    def encode(texts: pd.Series, charsets: pd.Series) -> pd.Series:
        return pd.Series([None if c is None else t.encode(c) for t, c in zip(texts, charsets)], dtype=object)

    return encode(text, charset)


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def derive(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """Run one of the texts above over the given tables."""
    used = {
        name: spread(load(spark, sf_dir, name)) if f"FROM {name}" in text else load(spark, sf_dir, name)
        for name in TABLES
        if f"FROM {name}" in text or f"JOIN {name}" in text
    }
    for name in used:
        text = text.replace(f"FROM {name}", f"FROM {{{name}}}").replace(f"JOIN {name}", f"JOIN {{{name}}} AS {name}")
    return spark.sql(text, **used)


def spread(rows: DataFrame) -> DataFrame:
    """Rows in at least as many partitions as there are cores.

    A small file with one row group is a single task, however costly its rows are. Inputs that already
    have enough partitions, as every large table has, are left as they are.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(cores) if rows.rdd.getNumPartitions() < cores else rows


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Waveform samples from events: ``recording_id, channel, t, value``; one recording is mono.

    Values are whole numbers, so that sums do not depend on their order.
    """
    second = "unix_date(cast(ts AS date)) * 86400L + hour(ts) * 3600 + minute(ts) * 60 + cast(second(ts) AS bigint)"
    channel = "CASE WHEN event_type = 'signup' THEN 0 ELSE cast(user_id % 2 AS int) END"
    return spark.sql(
        f"""SELECT event_type AS recording_id, {channel} AS channel,
              {second} - (SELECT min({second}) FROM {{events}}) AS t, round(value * 100) AS value FROM {{events}}""",
        events=load(spark, sf_dir, "events"),
    )


def _write_archive(batches: Iterator[pd.DataFrame], folder: str) -> Iterator[pd.DataFrame]:
    from pyarrow import fs

    path = f"{folder}/{uuid.uuid4().hex}.warc.gz"
    files, inner = fs.FileSystem.from_uri(path)
    files.create_dir(inner.rsplit("/", 1)[0], recursive=True)
    with files.open_output_stream(inner, compression=None) as out:
        for batch in batches:
            for row in batch.itertuples(index=False):
                block = row.body.encode()
                if row.rec_type == "response":
                    kind = f"Content-Type: {row.content_type}\r\n" if isinstance(row.content_type, str) else ""
                    block = f"HTTP/1.1 200 OK\r\n{kind}\r\n".encode() + block
                head = (
                    f"WARC/1.0\r\nWARC-Type: {row.rec_type}\r\nWARC-Target-URI: {row.target_uri}\r\n"
                    f"Content-Length: {len(block)}\r\n\r\n"
                )
                out.write(gzip.compress(head.encode() + block + b"\r\n\r\n", 1))
    yield pd.DataFrame({"url": [path]})


def write_archives(records: DataFrame, folder: str) -> DataFrame:
    """Write records to archives, one per partition, and return the table of their paths, ``url``."""
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    whole = qualified(records.sparkSession, folder)
    written = records.select("rec_type", "target_uri", "content_type", "body").mapInPandas(
        lambda batches: _write_archive(batches, whole), "url string"
    )
    return materialise(written, "archive-paths")


def _write_cut_gzip(batches: Iterator[pd.DataFrame], path: str) -> Iterator[pd.DataFrame]:
    from pyarrow import fs

    lines = [line for batch in batches for line in batch["value"]]
    content = gzip.compress("\n".join(lines).encode(), 1)
    files, inner = fs.FileSystem.from_uri(path)
    with files.open_output_stream(inner, compression=None) as out:
        out.write(content[: len(content) // 2])
    yield pd.DataFrame({"path": [path]})


def write_cut_gzip(lines: DataFrame, path: str) -> str:
    """Write a few lines (``value``) to one gzip file, and only the first half of that."""
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    whole = qualified(lines.sparkSession, path)
    lines.select("value").coalesce(1).mapInPandas(lambda b: _write_cut_gzip(b, whole), "path string").collect()
    return path
