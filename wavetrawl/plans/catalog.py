"""The registered queries: each one runs an operator over whole given tables or inputs derived from them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wavetrawl import schemas
from wavetrawl.functions.domains import with_registered_domain
from wavetrawl.functions.language import JAPANESE_TAGS
from wavetrawl.functions.text import header_text, is_truthy, or_empty, trim
from wavetrawl.functions.urls import audio_format, is_feed_audio_url, is_page_audio_url, is_valid_url, resolve_url
from wavetrawl.operators import audio, dedup, enrich, feeds, ordering, page_links, records, stats
from wavetrawl.plans import fixtures, jobs, routes
from wavetrawl.session import scratch_path
from wavetrawl.sources import archives, manifests, snapshots, tables
from wavetrawl.streaming.incremental import collect_new_links

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

PUBLISHED = ("audio_url", "title", "description", "language", "page_url")


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.derive(spark, sf_dir, fixtures.PAGES)


def _links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.derive(spark, sf_dir, fixtures.LINKS)


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fixtures.derive(spark, sf_dir, fixtures.RECORDS)
    return rows.withColumn("payload", F.encode("body", "UTF-8")).drop("body")


def _parsed_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.parse_feeds(feeds.feed_records(fixtures.derive(spark, sf_dir, fixtures.FEEDS)))


def _feed_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routes.links_of_feeds(fixtures.derive(spark, sf_dir, fixtures.FEEDS))


# Snapshots and archives


@query
def snapshot_scan(spark, sf_dir):
    """Write the distinct ids as one JSON array, as the index comes, and scan it."""
    ids = fixtures.derive(spark, sf_dir, fixtures.SNAPSHOTS).select("id").distinct()
    folder = scratch_path(spark, "snapshot-index")
    # The index is one document by nature; weeks bound its size.
    ids.agg(F.to_json(F.sort_array(F.collect_list(F.struct("id")))).alias("value")).write.text(folder)
    return snapshots.read_snapshot_index(spark, folder)


@query
def snapshot_range(spark, sf_dir):
    selected = snapshots.select_snapshots(fixtures.derive(spark, sf_dir, fixtures.SNAPSHOTS), "2013-10", "2022-30")
    return selected.select("row_id", "id", "snapshot_id", F.col("monday").cast("string").alias("monday"))


@query
def snapshot_paths(spark, sf_dir):
    selected = snapshots.select_snapshots(fixtures.derive(spark, sf_dir, fixtures.SNAPSHOTS), "2013-10", "2022-30")
    return snapshots.path_list_urls(selected)


def _written_path_lists(spark: SparkSession, sf_dir: str) -> str:
    folder = scratch_path(spark, "path-lists")
    lines = fixtures.derive(spark, sf_dir, fixtures.ARCHIVE_PATHS).select(
        "snapshot_id", F.explode(F.array("path", F.lit(""))).alias("value")
    )
    lines.write.partitionBy("snapshot_id").option("compression", "gzip").text(folder)
    return folder


@query
def path_list_scan(spark, sf_dir):
    return snapshots.read_path_lists(spark, _written_path_lists(spark, sf_dir))


@query
def path_list_roundtrip(spark, sf_dir):
    """Path lists to one text folder per snapshot, and back."""
    folder = scratch_path(spark, "url-lists")
    snapshots.write_path_lists(snapshots.read_path_lists(spark, _written_path_lists(spark, sf_dir)), folder)
    return snapshots.read_path_lists(spark, folder)


@query
def path_list_split(spark, sf_dir):
    lists = fixtures.derive(spark, sf_dir, fixtures.ARCHIVE_PATHS).select(
        "snapshot_id", F.concat("path", F.lit("\n\n"), "path", F.lit(".idx\n")).alias("body")
    )
    return snapshots.split_path_lists(lists)


@query
def archive_names(spark, sf_dir):
    paths = fixtures.derive(spark, sf_dir, fixtures.ARCHIVE_PATHS).select("row_id", F.col("path").alias("url"))
    return snapshots.with_output_names(paths).drop("url")


@query
def first_n_archives(spark, sf_dir):
    paths = fixtures.derive(spark, sf_dir, fixtures.ARCHIVE_PATHS)
    return ordering.first_in_order(paths.select("snapshot_id", "path"), ["path"], 100)


@query
def pending_archives(spark, sf_dir):
    paths = fixtures.derive(spark, sf_dir, fixtures.ARCHIVE_PATHS).withColumnRenamed("path", "url")
    named = snapshots.with_output_names(paths)
    done = named.filter(F.col("state") == "F").select("archive")
    return snapshots.pending(named, done).select("row_id", "snapshot_id", "archive")


@query
def crawl_records_scan(spark, sf_dir):
    """Write the records to gzip archives and scan the responses of that table of archives back."""
    folder = scratch_path(spark, "archives")
    paths = fixtures.write_archives(fixtures.derive(spark, sf_dir, fixtures.RECORDS), folder)
    scanned = archives.scan_archives(paths, rec_type="response")
    return scanned.select(
        "rec_type",
        "target_uri",
        or_empty(F.col("content_type")).alias("content_type"),
        F.octet_length("payload").cast("bigint").alias("n_bytes"),
        F.md5("payload").alias("digest"),
    )


@query
def html_records_scan(spark, sf_dir):
    """Type and content type are tested before a body is read, and no body leaves the reader."""
    folder = scratch_path(spark, "archives")
    paths = fixtures.write_archives(fixtures.derive(spark, sf_dir, fixtures.RECORDS), folder)
    columns = ("rec_type", "target_uri", "content_type")
    return archives.scan_archives(paths, rec_type="response", content_type="html", columns=columns)


@query
def range_archives(spark, sf_dir):
    """From a snapshot index and the path lists of its snapshots to the archives of a range."""
    root = scratch_path(spark, "mirror")
    lists = fixtures.derive(spark, sf_dir, fixtures.ARCHIVE_PATHS).select(
        F.concat(F.lit("CC-MAIN-"), "snapshot_id").alias("snapshot"), F.col("path").alias("value")
    )
    ids = lists.select(F.col("snapshot").alias("id")).distinct()
    # The index is one document by nature; weeks bound its size.
    ids.agg(F.to_json(F.sort_array(F.collect_list(F.struct("id")))).alias("value")).write.text(f"{root}/index")
    for row in ids.collect():
        own = lists.filter(F.col("snapshot") == row.id).select("value")
        own.write.option("compression", "gzip").text(f"{root}/crawl-data/{row.id}/warc.paths.gz")
    found = jobs.archives_of_range(spark, f"{root}/index", "2014-01", "2018-30", prefix=root)
    return found.select("snapshot_id", F.replace("url", F.lit(f"{root}/"), F.lit("")).alias("path"))


# Link tables in files


@query
def jsonl_roundtrip(spark, sf_dir):
    folder = scratch_path(spark, "jsonl")
    tables.write_jsonl(_links(spark, sf_dir).select(*PUBLISHED), folder)
    return tables.read_jsonl(spark, folder, schemas.FEED_LINKS)


def _compacted(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    folder, out, rejects = (scratch_path(spark, name) for name in ("loose", "packed", "rejects"))
    links = _links(spark, sf_dir)
    whole = F.to_json(F.struct(*PUBLISHED))
    broken = F.when(F.col("link_pos") % 41 == 2, F.array(whole, F.lit('{"audio_url": "cut')))
    links.select(F.explode(F.coalesce(broken, F.array(whole))).alias("value")).write.text(folder)
    some = links.filter("archive = 'part-00003'").select(whole.alias("value"))
    fixtures.write_cut_gzip(some, f"{folder}/cut.json.gz")
    return tables.compact_with_report(spark, folder, out, schemas.FEED_LINKS, rejects=rejects)


@query
def compact_links(spark, sf_dir):
    """Pack JSON-lines files, some lines of which are broken and one of which is cut, into Parquet."""
    return _compacted(spark, sf_dir)[0]


@query
def compact_report(spark, sf_dir):
    """How many lines were packed and how many are broken, and the files left out."""
    return _compacted(spark, sf_dir)[1]


@query
def publish_links(spark, sf_dir):
    folder = scratch_path(spark, "published")
    tables.publish(_links(spark, sf_dir).select(*PUBLISHED, "license"), folder)
    return tables.read_published(spark, folder)


@query
def language_counts_scan(spark, sf_dir):
    folder = scratch_path(spark, "language-counts")
    counts = _links(spark, sf_dir).groupBy("language").agg(F.count("*").alias("count"))
    counts.write.option("emptyValue", "").csv(folder, header=True)
    return tables.read_language_counts(spark, folder)


@query
def incremental_links(spark, sf_dir):
    """Two waves of files through the same stream; the table equals the first link per URL of all files."""
    folder, table, state = (scratch_path(spark, name) for name in ("wave", "collected", "stream-state"))
    links = _links(spark, sf_dir).filter(is_truthy(F.col("audio_url")))
    schema = links.schema
    for wave in (F.col("archive") < "part-00025", F.col("archive") >= "part-00025"):
        links.filter(wave).write.mode("append").json(folder)
        collected = collect_new_links(spark, folder, table, state, schema, ["archive", "link_pos"])
    return collected.drop("batch", "license")


# Records and pages


@query
def header_texts(spark, sf_dir):
    """Content-type headers as bytes, some of which are no UTF-8, as texts."""
    rows = fixtures.derive(spark, sf_dir, fixtures.RECORDS).select("source", "record_id", "content_type")
    raw = F.encode("content_type", "UTF-8")
    broken = F.concat(raw, F.unhex(F.lit("FF")))
    header = F.when(F.col("record_id") % 3 == 0, broken).otherwise(raw)
    return rows.select("source", "record_id", header_text(header).alias("content_type"))


@query
def html_responses(spark, sf_dir):
    kept = records.html_responses(_records(spark, sf_dir))
    return kept.select("source", "record_id", "target_uri", "content_type")


@query
def decode_pages(spark, sf_dir):
    """Documents as UTF-8, as declared Latin-1, with byte-order marks and in charsets that nothing names, decoded again."""
    given = fixtures.spread(fixtures.derive(spark, sf_dir, fixtures.SCRIPTS))
    latin = (F.col("doc_id") % 3 > 0) & ~F.col("text").rlike(r"[^\x00-\xff]")
    declared = F.concat(F.lit('<meta charset="iso-8859-1">'), "text")
    plain = F.when(latin, F.encode(declared, "ISO-8859-1")).otherwise(F.encode("text", "UTF-8"))
    payload = F.coalesce(fixtures.encoded("text", "charset"), plain)
    decoded = records.decode_pages(given.select("doc_id", payload.alias("payload")))
    return decoded.select("doc_id", F.md5("html").alias("digest"), F.length("html").cast("bigint").alias("n_chars"))


@query
def pages_by_lang_attr(spark, sf_dir):
    return records.pages_in_language(_pages(spark, sf_dir), "ja").select("page_id", "url")


@query
def feed_records(spark, sf_dir):
    return feeds.feed_records(_records(spark, sf_dir)).select("source", "record_id", "target_uri")


@query
def page_tokens(spark, sf_dir):
    return page_links.page_tokens(_pages(spark, sf_dir)).select("page_id", "pos", "kind", "name", "token")


@query
def page_titles(spark, sf_dir):
    return enrich.titles(_pages(spark, sf_dir)).select("page_id", "title")


@query
def page_main_text(spark, sf_dir):
    return enrich.main_text(_pages(spark, sf_dir)).select("page_id", "text")


@query
def repeated_blocks(spark, sf_dir):
    return enrich.drop_repeated_blocks(enrich.text_blocks(_pages(spark, sf_dir)), max_times=1).select(
        "page_id", F.col("pos").cast("bigint").alias("pos"), "block"
    )


@query
def detect_language(spark, sf_dir):
    docs = fixtures.derive(spark, sf_dir, fixtures.DOCUMENTS)
    return enrich.with_language(docs).select("doc_id", "detected")


# Where the model of each input was written, by application and folder.
_MODELS: dict[tuple[str, str], str] = {}


def _quality_model(spark: SparkSession, sf_dir: str):
    """The model of these documents: fitted once and loaded from then on."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _MODELS:
        labels = fixtures.load(spark, sf_dir, "labels").select("doc_id", "quality")
        labelled = fixtures.spread(fixtures.load(spark, sf_dir, "documents")).join(labels, "doc_id")
        path = scratch_path(spark, "quality-model")
        enrich.fit_quality_model(labelled, path=path)
        _MODELS[key] = path
    return enrich.load_quality_model(_MODELS[key])


@query
def quality_scores(spark, sf_dir):
    texts = enrich.main_text(_pages(spark, sf_dir)).select("page_id", "text")
    return enrich.with_quality(texts, _quality_model(spark, sf_dir)).select("page_id", "quality")


@query
def good_pages(spark, sf_dir):
    return enrich.good_pages(_pages(spark, sf_dir), _quality_model(spark, sf_dir), language="en")


@query
def good_page_texts(spark, sf_dir):
    """What :func:`good_pages` gives besides the score."""
    return good_pages(spark, sf_dir).select("page_id", "title", "url", "text")


# Whole routes


@query
def page_route(spark, sf_dir):
    """Records to links: HTML responses, decoded, in the wanted language, scored, mined."""
    found = routes.page_links_of_records(_records(spark, sf_dir), _quality_model(spark, sf_dir), "en")
    return found.select("url", "title", "quality", "audio_url", "description", "license")


@query
def page_route_links(spark, sf_dir):
    """What :func:`page_route` gives besides the score."""
    return page_route(spark, sf_dir).drop("quality")


@query
def feed_route(spark, sf_dir):
    return routes.feed_links_of_records(_records(spark, sf_dir))


# Links of pages


@query
def extract_audio_links(spark, sf_dir):
    return page_links.extract_audio_links(_pages(spark, sf_dir)).select(
        "page_id", "url", "audio_url", "description", "license"
    )


@query
def audio_tag_links(spark, sf_dir):
    found = page_links.link_candidates(_pages(spark, sf_dir))
    return found.filter(F.col("pass") == 1).select("page_id", "audio_url")


@query
def general_tag_links(spark, sf_dir):
    found = page_links.link_candidates(_pages(spark, sf_dir))
    return found.filter(F.col("pass") == 2).select("page_id", "audio_url")


@query
def page_link_dedup(spark, sf_dir):
    """The first link per URL and page by an aggregate, from all candidates."""
    found = page_links.link_candidates(_pages(spark, sf_dir), keep=["page_id"])
    return dedup.first_per_page_url(found).select("page_id", "audio_url", "description", "license")


@query
def link_context(spark, sf_dir):
    """Every candidate with the text around it, repeats included."""
    found = page_links.link_candidates(_pages(spark, sf_dir), keep=["page_id"])
    return found.select("page_id", F.col("pass").cast("bigint").alias("pass"), "audio_url", "description")


@query
def link_license(spark, sf_dir):
    found = page_links.link_candidates(_pages(spark, sf_dir), keep=["page_id"])
    return found.filter("license <> ''").select("page_id", "audio_url", "license")


# Links of feeds


@query
def feed_items(spark, sf_dir):
    return _feed_links(spark, sf_dir)


@query
def feed_rejects(spark, sf_dir):
    return _parsed_feeds(spark, sf_dir).select("feed_id", "outcome")


@query
def clean_feed_text(spark, sf_dir):
    """Trimmed and defaulted item texts of all items, audio or not."""
    items = feeds.feed_items(_parsed_feeds(spark, sf_dir), keep=["feed_id"])
    return items.select("feed_id", F.col("item_pos").cast("bigint").alias("item_pos"), "title", "description", "language")


@query
def all_links(spark, sf_dir):
    found = page_links.extract_audio_links(_pages(spark, sf_dir), keep=["url"])
    from_pages = found.select("audio_url", "description", "license", F.col("url").alias("page_url"))
    return tables.union_links(from_pages, _feed_links(spark, sf_dir)).select(
        "link_source", "audio_url", "description", "license", "title", "language", "page_url"
    )


# URLs

_REFERENCES = {
    "rooted": "concat('/ep//', n, '/../', n, '.mp3')",
    "sibling": "concat('a', n, '.ogg')",
    "up": "concat('../../../up/', n, '.mp3')",
    "inner": "concat('x//y/../', n, '.wav')",
    "host": "concat('//cdn.example.org/x/../', n, '.wav?q=1')",
    "absolute": "concat('https://cdn.example.org/a/../', n, '.MP3')",
    "query": "concat('?z=', n)",
    "fragment": "concat('#t', n)",
    "empty": "''",
    "scheme": "concat('mailto:', n, '@example.org')",
    "spaced": "concat(' \\t/sp/', n, '\\n.mp3')",
    "broken": "concat('http://[', n, '/a.mp3')",
}


def _built_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = ", ".join(f"struct('{kind}' AS kind, {ref} AS ref)" for kind, ref in _REFERENCES.items())
    pages = fixtures.spread(fixtures.load(spark, sf_dir, "pages")).selectExpr("page_id", "url", "cast(page_id AS string) AS n")
    return pages.selectExpr("page_id", "url", f"inline(array({kinds}))")


@query
def resolve_urls(spark, sf_dir):
    return _built_references(spark, sf_dir).select("page_id", "kind", resolve_url("url", "ref").alias("resolved"))


@query
def valid_urls(spark, sf_dir):
    return _built_references(spark, sf_dir).select("page_id", "kind", is_valid_url("ref").alias("valid"))


@query
def page_audio_urls(spark, sf_dir):
    items = fixtures.derive(spark, sf_dir, fixtures.ITEMS).filter(is_page_audio_url("audio_url"))
    return items.select("link_pos", "audio_url")


@query
def feed_audio_urls(spark, sf_dir):
    items = fixtures.derive(spark, sf_dir, fixtures.ITEMS).filter(is_feed_audio_url(F.col("audio_url")))
    return items.select("link_pos", "audio_url")


@query
def registered_domain(spark, sf_dir):
    links = _links(spark, sf_dir).filter(F.col("audio_url").isNotNull()).select("link_pos", "audio_url")
    return with_registered_domain(links, rule="rule")


@query
def truthy_links(spark, sf_dir):
    links = _links(spark, sf_dir)
    kept = links.filter(is_truthy(F.col("audio_url")) & is_truthy(F.col("description")))
    return kept.select("link_pos", "audio_url", F.substring(trim(F.col("title")), 1, 5).alias("short_title"))


# Statistics


@query
def top_domains(spark, sf_dir):
    return stats.top_domains(_links(spark, sf_dir))


@query
def top_domains_for_language(spark, sf_dir):
    return stats.top_domains(stats.links_by_language(_links(spark, sf_dir), JAPANESE_TAGS))


@query
def top_languages(spark, sf_dir):
    return stats.top_languages(_links(spark, sf_dir))


@query
def links_by_language(spark, sf_dir):
    return stats.links_by_language(_links(spark, sf_dir), JAPANESE_TAGS).select("link_pos", "language")


@query
def url_uniqueness(spark, sf_dir):
    return stats.url_uniqueness(_links(spark, sf_dir))


@query
def language_rollup(spark, sf_dir):
    return stats.language_rollup(_links(spark, sf_dir))


@query
def class_ratio_sampled(spark, sf_dir):
    events = fixtures.load(spark, sf_dir, "events").select("event_id", "event_type")
    return stats.class_ratio(stats.sample_by_hash(events, "event_id", 10), "event_type", top=3)


@query
def rows_per_archive(spark, sf_dir):
    return stats.rows_per(_links(spark, sf_dir), "archive")


@query
def global_link_dedup(spark, sf_dir):
    links = _links(spark, sf_dir).filter(is_truthy(F.col("audio_url")))
    return dedup.first_per_url(links, ["archive", "link_pos"]).drop("license")


@query
def fetch_plan(spark, sf_dir):
    links = _links(spark, sf_dir).filter(is_truthy(F.col("audio_url")))
    firsts = dedup.first_per_url(links.select("audio_url", "archive", "link_pos"), ["archive", "link_pos"])
    return ordering.fetch_plan(firsts).select("host", "audio_url", "slot", "lane", "start_second")


@query
def fetch_bounds(spark, sf_dir):
    links = _links(spark, sf_dir).filter(is_truthy(F.col("audio_url")))
    return ordering.host_bounds(links.select("audio_url"))


@query
def fetch_schedule(spark, sf_dir):
    links = _links(spark, sf_dir).filter(is_truthy(F.col("audio_url")))
    return ordering.schedule_bound(links.select("audio_url"))


# Audio as tables


@query
def downmix(spark, sf_dir):
    return audio.downmix(fixtures.samples(spark, sf_dir))


@query
def resample_series(spark, sf_dir):
    given = fixtures.samples(spark, sf_dir)
    by_mean = audio.resample_mean(given, 3600).withColumn("method", F.lit("mean"))
    linear = audio.resample_linear(given, 1800).withColumn("method", F.lit("linear"))
    return by_mean.unionByName(linear)


@query
def channel_ops(spark, sf_dir):
    stereo = audio.to_stereo(fixtures.samples(spark, sf_dir))
    first = audio.take_channel(stereo, 0).withColumn("taken", F.lit("first"))
    return stereo.withColumn("taken", F.lit("all")).unionByName(first)


@query
def recording_facts(spark, sf_dir):
    facts = audio.recording_facts(fixtures.samples(spark, sf_dir), 16)
    return facts.withColumn("channel_ids", F.array_join("channel_ids", ","))


def _cuts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cuts of one recording per user, with the link of the same number."""
    events = fixtures.load(spark, sf_dir, "events")
    by_user = events.select(
        F.col("user_id").cast("string").alias("recording_id"), (F.col("event_id") % 2).cast("int").alias("channel")
    )
    links = _links(spark, sf_dir).withColumn("recording_id", F.col("link_pos").cast("string"))
    return audio.build_cuts(audio.recording_facts(by_user, 16), links, 16)


def _flat_cuts(cuts: DataFrame) -> DataFrame:
    return cuts.select(
        "id",
        "duration",
        "kind",
        F.array_join("channel", ",").alias("channel"),
        F.array_join("recording.channel_ids", ",").alias("channel_ids"),
        "recording.num_samples",
        F.col("custom")["audio_url"].alias("audio_url"),
        F.col("custom")["language"].alias("language"),
    )


@query
def build_cuts(spark, sf_dir):
    return _flat_cuts(_cuts(spark, sf_dir))


def _sharded(spark: SparkSession, sf_dir: str, shard_size: int) -> DataFrame:
    """Cuts of all links in their shards. The links are numbered once; both sides of the cuts come from that."""
    links = _links(spark, sf_dir).filter(is_truthy(F.col("audio_url")))
    numbered = manifests.assign_shards(links, ["archive", "link_pos"], shard_size).withColumnRenamed("id", "recording_id")
    facts = numbered.select(
        "recording_id",
        (F.col("link_pos") * 160).alias("num_samples"),
        (F.col("link_pos") * 160 / F.lit(16000.0)).alias("duration"),
        F.array(F.lit(0)).alias("channel_ids"),
        F.lit("mono").alias("kind"),
    )
    return manifests.with_shard(audio.build_cuts(facts, numbered, 16000), shard_size)


@query
def shard_manifest(spark, sf_dir):
    folder = scratch_path(spark, "manifest")
    manifests.write_manifest(_sharded(spark, sf_dir, 2000), folder)
    cuts = manifests.read_cuts(spark, folder)
    return cuts.select("id", "shard", "duration", F.col("custom")["title"].alias("title"))


@query
def manifest_scan(spark, sf_dir):
    folder = scratch_path(spark, "manifest")
    manifests.write_manifest(_sharded(spark, sf_dir, 4000), folder)
    return _flat_cuts(manifests.read_manifest(spark, folder))


@query
def manifest_orphans(spark, sf_dir):
    links = _links(spark, sf_dir)
    named = links.select(F.format_string("audio_%08d", "link_pos").alias("id"), "link_pos")
    cuts = named.filter("link_pos % 50 <> 1").select(F.struct("id").alias("recording"))
    return manifests.orphans(cuts, named.filter("link_pos % 50 <> 2"))


@query
def first_cut(spark, sf_dir):
    return manifests.first_cut(_flat_cuts(_cuts(spark, sf_dir)))


@query
def item_outcomes(spark, sf_dir):
    items = fixtures.derive(spark, sf_dir, fixtures.ITEMS).withColumn("audio_data", F.encode("body", "UTF-8"))
    return audio.item_outcomes(items).select("link_pos", "status", "format")


@query
def item_rejects(spark, sf_dir):
    items = fixtures.derive(spark, sf_dir, fixtures.ITEMS).withColumn("audio_data", F.encode("body", "UTF-8"))
    return audio.dead_letters(audio.item_outcomes(items)).groupBy("status").agg(F.count("*").alias("n"))


@query
def audio_formats(spark, sf_dir):
    items = fixtures.derive(spark, sf_dir, fixtures.ITEMS)
    return items.select("link_pos", audio_format(F.col("content_type"), F.col("audio_url")).alias("format"))
