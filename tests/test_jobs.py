import gzip
import io

from conftest import plan_of
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, StringContains

from wavetrawl.operators.records import html_responses
from wavetrawl.plans import catalog, fixtures, jobs, routes
from wavetrawl.session import scratch_path
from wavetrawl.sources import archives as archive_source
from wavetrawl.sources.archives import CrawlArchives, read_archives, scan_archives


def _archives(spark, small):
    return fixtures.write_archives(
        fixtures.derive(spark, small, fixtures.RECORDS).repartition(3), scratch_path(spark, "job-archives")
    )


def test_feeds_are_mined_once(spark, small, tmp_path):
    archives, out = _archives(spark, small), str(tmp_path)
    assert jobs.mine_feeds(spark, archives, out, max_files=1).count() == 1
    first = spark.read.json(f"{out}/links").count()
    assert jobs.mine_feeds(spark, archives, out).count() == 2
    links = spark.read.json(f"{out}/links")
    assert links.count() > first > 0
    assert jobs.mine_feeds(spark, archives, out).count() == 0
    expected = catalog.feed_route(spark, small)
    assert links.select(*expected.columns).exceptAll(expected).count() == 0
    assert expected.exceptAll(links.select(*expected.columns)).count() == 0
    assert jobs.mine_feeds(spark, archives, out, overwrite=True).count() == 3
    assert spark.read.json(f"{out}/links").count() == expected.count()


def test_pages_are_mined(spark, small, tmp_path):
    model = catalog._quality_model(spark, small)
    jobs.mine_pages(spark, _archives(spark, small), str(tmp_path), model, "en")
    links = spark.read.json(f"{tmp_path}/links")
    expected = catalog.page_route(spark, small).select("url", "audio_url", "description", "license")
    assert sorted(links.select(*expected.columns).collect()) == sorted(expected.collect())


def test_an_archive_without_links_counts_as_done(spark, tmp_path):
    path = tmp_path / "empty.warc.gz"
    path.write_bytes(gzip.compress(b"WARC/1.0\r\nWARC-Type: warcinfo\r\nContent-Length: 1\r\n\r\nx\r\n\r\n"))
    archives = spark.createDataFrame([(str(path),)], "url string")
    assert jobs.mine_feeds(spark, archives, str(tmp_path / "out")).count() == 1
    assert jobs.mine_feeds(spark, archives, str(tmp_path / "out")).count() == 0


def test_a_damaged_archive_is_noted_and_stays_pending(spark, small, tmp_path):
    urls = [row.url for row in _archives(spark, small).collect()]
    whole = urls[0].removeprefix("file://")
    with open(whole, "rb") as file:
        content = file.read()
    cut = tmp_path / "cut.warc.gz"
    cut.write_bytes(content[: len(content) // 2])
    out = str(tmp_path / "out")
    archives = spark.createDataFrame([(str(cut),), *((url,) for url in urls[1:])], "url string")
    assert jobs.mine_feeds(spark, archives, out, group=1).count() == len(urls) - 1
    assert [row.archive for row in spark.read.json(f"{out}/errors").collect()] == ["cut.warc.gz"]
    assert [row.archive for row in jobs.pending_paths(spark, archives, out).collect()] == ["cut.warc.gz"]
    cut.write_bytes(content)
    assert [row.archive for row in jobs.mine_feeds(spark, archives, out).collect()] == ["cut.warc.gz"]
    assert jobs.pending_paths(spark, archives, out).count() == 0


def test_download_plan(spark):
    rows = [(1, "http://a/1", "ja", None), (2, "http://a/1", "ja", "t"), (3, "http://a/0", "ja_JP", "t"), (4, "http://b/1", "en", "t"), (5, "", "ja", "t"), (6, None, "ja", "t")]
    links = spark.createDataFrame(rows, "link_pos int, audio_url string, language string, title string")
    plan = routes.download_plan(links, ["link_pos"]).orderBy("slot").collect()
    assert [(r.link_pos, r.host, r.start_second, r.title) for r in plan] == [(3, "a", 0.0, "t"), (1, "a", 1.0, "")]
    assert routes.download_plan(links, ["link_pos"], languages=()).count() == 3
    assert links.filter(F.col("language") == "ja").count() == 4


def test_scan_of_a_table_of_archives(spark, small):
    archives = _archives(spark, small)
    every = scan_archives(archives)
    listed = read_archives(spark, [row.url for row in archives.collect()])
    assert every.columns == listed.columns
    assert every.exceptAll(listed).count() == listed.exceptAll(every).count() == 0
    assert every.rdd.getNumPartitions() == 3 and len({r.archive for r in every.select("archive").distinct().collect()}) == 3
    some = scan_archives(archives, rec_type="response", content_type="html", columns=("target_uri", "content_type"))
    want = every.filter("rec_type = 'response' AND content_type LIKE '%html%'").select("target_uri", "content_type")
    assert want.count() > 0 and some.exceptAll(want).count() == want.exceptAll(some).count() == 0
    twice = archives.union(archives).union(spark.createDataFrame([(None,)], "url string"))
    assert scan_archives(twice).count() == every.count()
    assert scan_archives(archives.limit(0)).count() == 0


def test_type_and_content_type_are_pushed_into_the_reader(spark, small):
    archives = [row.url for row in _archives(spark, small).collect()]
    found = html_responses(read_archives(spark, archives))
    plan = plan_of(found)
    assert "Filter" not in plan.replace("PushedFilters", "") or "Contains(content_type" not in plan
    assert found.count() == scan_archives(spark.createDataFrame([(a,) for a in archives], "url string"), rec_type="response", content_type="html").count()
    reader = CrawlArchives({"paths": "\n".join(archives)}).reader(None)
    left = list(reader.pushFilters([EqualTo(("rec_type",), "response"), StringContains(("content_type",), "html")]))
    assert left == [] and (reader.rec_type, reader.content_type) == ("response", "html")


def test_bodies_that_are_not_wanted_are_not_decoded(monkeypatch):
    record = b"WARC/1.0\r\nWARC-Type: response\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n"
    pages = [b"HTTP/1.1 200 OK\r\nContent-Type: %s\r\n\r\nbody" % kind for kind in (b"text/html", b"image/png")]
    stream = b"".join(record % (len(page), page) for page in pages)
    decoded = []
    monkeypatch.setattr(archive_source, "_body", lambda headers, body: decoded.append(body) or body)
    kept = list(archive_source.read_records(io.BytesIO(stream), "a", content_type="html"))
    assert [row[4] for row in kept] == ["text/html"] and decoded == [b"body"]
    assert [row[5] for row in archive_source.read_records(io.BytesIO(stream), "a", bodies=False)] == [None, None]
    assert decoded == [b"body"]
