"""Sources, streaming, enrichment, statistics and plans."""

import bz2
import gzip
import json
import random
import warnings
from pathlib import Path

import pytest
from conftest import plan_of
from pyspark.sql import Observation
from pyspark.sql import functions as F

from wavetrawl import schemas
from wavetrawl.functions.language import has_lang_attribute
from wavetrawl.operators import dedup, enrich, stats
from wavetrawl.operators.skew import drop_frequent
from wavetrawl.plans import catalog, fixtures, routes
from wavetrawl.session import checkpoint_root
from wavetrawl.sources import snapshots, tables
from wavetrawl.streaming.incremental import collect_new_links


def test_snapshot_range_guards(spark):
    with pytest.raises(ValueError):
        snapshots.check_range("2025-18", "2020-05")
    with pytest.warns(UserWarning):
        snapshots.check_range("2012-01", "2020-05")
    with warnings.catch_warnings():
        warnings.simplefilter("error")
        snapshots.check_range("2020-05", "2025-18")


def test_snapshot_range_is_inclusive(spark):
    ids = ["2020-05", "2020-04", "2025-18", "2025-19", "2012", "2009-2010", "2021-xx", "2021-54", "2021-10-1"]
    df = spark.createDataFrame([(f"CC-MAIN-{i}",) for i in ids], "id string")
    got = snapshots.select_snapshots(df, "2020-05", "2025-18").orderBy("id").collect()
    assert [(r.snapshot_id, str(r.monday)) for r in got] == [("2020-05", "2020-01-27"), ("2025-18", "2025-04-28")]


def test_json_lines_keep_texts_and_characters(spark, tmp_path):
    rows = [("00123", "日本", "", None, "p")]
    tables.write_jsonl(spark.createDataFrame(rows, schemas.FEED_LINKS).coalesce(1), str(tmp_path / "j"))
    assert "日本" in next((tmp_path / "j").glob("part-*")).read_text(encoding="utf-8")
    assert [tuple(r) for r in tables.read_jsonl(spark, str(tmp_path / "j"), schemas.FEED_LINKS).collect()] == rows


def test_compaction_groups_files_and_keeps_rejects(spark, tmp_path):
    links = spark.range(40).select(F.to_json(F.struct(F.col("id").cast("string").alias("audio_url"))).alias("value"))
    links.repartition(8).write.text(str(tmp_path / "in"))
    (tmp_path / "in" / "broken.json").write_text('{"audio_url": "x\n')
    args = [str(tmp_path / name) for name in ("in", "out")]
    packed = tables.compact_jsonl(spark, *args, schemas.FEED_LINKS, files_per_group=3, rejects=str(tmp_path / "bad"))
    assert packed.count() == 40
    assert len(list((tmp_path / "out").glob("*.parquet"))) <= 3
    assert [r.value for r in spark.read.text(str(tmp_path / "bad")).collect()] == ['{"audio_url": "x']


def test_damaged_files_are_left_out_whole_and_named(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    lines = [json.dumps({"audio_url": f"u{i}", "title": "日本" * 20}) for i in range(20_000)]
    content = gzip.compress("".join(line + "\n" for line in lines).encode())
    (folder / "whole.json.gz").write_bytes(content + gzip.compress(b'{"audio_url": "second member"}\n'))
    (folder / "cut.json.gz").write_bytes(content[: len(content) // 2])
    (folder / "junk.json.gz").write_bytes(b"no gzip at all")
    (folder / "altered.json.gz").write_bytes(content[:-8] + b"12345678")
    (folder / "whole.json.bz2").write_bytes(bz2.compress(b'{"audio_url": "b"}\n') + bz2.compress(b'{"audio_url": "c"}\n'))
    (folder / "cut.json.bz2").write_bytes(bz2.compress(b'{"audio_url": "b"}\n' * 1000)[:-9])
    (folder / "empty.json").write_bytes(b"")
    (folder / "plain.json").write_bytes(b'{"audio_url": "p"}\n{"audio_url": "br')
    packed, report = tables.compact_with_report(
        spark, str(folder), str(tmp_path / "out"), schemas.FEED_LINKS, rejects=str(tmp_path / "bad")
    )
    assert packed.count() == 20_000 + 4
    assert {(r.outcome, r.file): r.n for r in report.collect()} == {
        ("packed", None): 20_004, ("broken", None): 1,
        **{("damaged", f"{name}"): 1 for name in ("cut.json.gz", "junk.json.gz", "altered.json.gz", "cut.json.bz2")},
    }
    assert [r.value for r in spark.read.text(str(tmp_path / "bad")).collect()] == ['{"audio_url": "br']
    with pytest.raises(Exception):
        tables.read_jsonl_with_rejects(spark, str(folder), schemas.FEED_LINKS).count()


def test_packed_files_follow_the_bytes(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    rng = random.Random(1)
    for i in range(60):
        lines = [json.dumps({"audio_url": f"{i}-{k}-{rng.random()}"}) for k in range(10 if i % 3 else 2000)]
        (folder / f"{i:03}.json").write_text("\n".join(lines) + "\n")
    total = sum(f.stat().st_size for f in folder.iterdir())
    packed = tables.compact_jsonl(spark, str(folder), str(tmp_path / "out"), schemas.FEED_LINKS, target_bytes=total // 5)
    rows = [spark.read.parquet(str(f)).count() for f in (tmp_path / "out").glob("*.parquet")]
    assert sum(rows) == packed.count() == 20 * 2000 + 40 * 10
    assert 5 <= len(rows) <= 6 and max(rows) <= 2 * (sum(rows) / 5)


def test_language_tags_are_case_sensitive_texts(spark, tmp_path):
    (tmp_path / "c.csv").write_text('language,count\nNO,70\nno,3\n,5\n"",6\n')
    rows = tables.read_language_counts(spark, str(tmp_path / "c.csv")).collect()
    assert [tuple(r) for r in rows] == [("NO", 70), ("no", 3), ("", 5), ("", 6)]


def test_incremental_equals_batch_and_repeats_nothing(spark, tmp_path):
    schema = "audio_url string, pos bigint"
    waves = [[("a", 1), ("a", 2), ("b", 3)], [("b", 4), ("c", 5)], [("c", 6)]]
    everything = spark.createDataFrame([row for wave in waves for row in wave], schema)
    paths = [str(tmp_path / name) for name in ("in", "table", "state")]
    for wave in waves:
        spark.createDataFrame(wave, schema).coalesce(1).write.mode("append").json(paths[0])
        collect_new_links(spark, *paths, everything.schema, ["pos"])
    collected = collect_new_links(spark, *paths, everything.schema, ["pos"]).drop("batch")
    assert sorted(collected.collect()) == sorted(dedup.first_per_url(everything, ["pos"]).collect())


def test_main_text_rules(spark):
    html = (
        "<html><head><title>T</title></head><nav><p>Navigation text that is long enough to count.</p></nav>"
        "<p>First paragraph with <b>enough</b> words &amp; more.</p><p>short</p>"
        "<p><a href=x>Mostly a link with a long text</a> yes.</p><table><tr><td>A table cell with a long text inside</td></table>"
        "<p>First paragraph with <b>enough</b> words &amp; more.</p><div>Second block\n of the page, kept as well.</div>"
    )
    df = spark.createDataFrame([(html,)], "html string")
    assert enrich.main_text(df).first().text == (
        "First paragraph with enough words & more.\nSecond block of the page, kept as well."
    )


@pytest.mark.parametrize(
    "html, title",
    [
        ('<meta property="og:title" content=" O &amp; G "><title>T</title><h1>H</h1>', "O & G"),
        ("<title>T</title><h1>H <b>x</b></h1>", "H x"),
        ("<title> T\n t </title><h1>H</h1><h1>I</h1>", "T t"),
        ("<p>x</p>", ""),
    ],
)
def test_titles(spark, html, title):
    assert enrich.titles(spark.createDataFrame([(html,)], "html string")).first().title == title


def test_short_blocks(spark):
    """Sentences stay however short they are, and short blocks between blocks that stay; scripts count alike."""
    html = (
        "<p>今日は晴れです。</p><p>次回予告</p><p>お楽しみに！</p><p>目次</p><p>短い</p><p>Yes.</p><p>A heading</p>"
        "<p>A paragraph that is long enough to count by itself</p><p>tail</p><p><a href=x>もっと読む。</a></p>"
    )
    df = spark.createDataFrame([(1, html)], "page_id long, html string")
    assert enrich.main_text(df).first().text.split("\n") == [
        "今日は晴れです。", "次回予告", "お楽しみに！", "Yes.", "A heading", "A paragraph that is long enough to count by itself",
    ]
    strict = enrich.main_text(df, min_length=1000, max_link_share=1).first().text.split("\n")
    assert strict == ["今日は晴れです。", "次回予告", "お楽しみに！", "Yes.", "もっと読む。"]


def test_quoted_brackets_in_tags(spark):
    html = '<meta property="og:title" content="A > B"><p title="x > y">This is a text of &gt; 25 characters</p>'
    df = spark.createDataFrame([(html,)], "html string")
    assert enrich.titles(df).first().title == "A > B"
    assert enrich.main_text(df).first().text == "This is a text of > 25 characters"


def test_repeated_blocks_move_no_text_before_the_last_join(spark):
    rows = [(i, 0, "everywhere") for i in range(3000)] + [(i, 1, f"only {i % 1500}") for i in range(3000)]
    rows += [(i, 2, "often") for i in range(4)]
    blocks = spark.createDataFrame(rows, "page_id long, pos int, block string")
    left = enrich.drop_repeated_blocks(blocks, max_times=2)
    assert sorted(row.block for row in left.collect()) == sorted(b for _, _, b in rows if b.startswith("only"))
    hashes = max(Path(checkpoint_root(spark).removeprefix("file:"), "wavetrawl").glob("block-hashes-*"), key=lambda p: p.stat().st_mtime)
    assert spark.read.parquet(str(hashes)).columns == ["page_id", "pos", "block_hash"]


def test_a_warm_key_does_not_unbalance_the_shuffle(spark):
    """A key with 1/1,500 of the rows, without help from adaptive execution: no task gets its rows."""
    rows = spark.range(60_000).select(
        F.when(F.col("id") % 1500 == 0, F.lit("warm")).otherwise(F.md5(F.col("id").cast("string"))).alias("key"), "id"
    )
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        left = drop_frequent(rows, "key", 2)
        sizes = left.groupBy(F.spark_partition_id()).count().toPandas()["count"]
        assert left.count() == 60_000 - 40 and sizes.max() < 1.2 * sizes.mean()
        plan = plan_of(left)
        assert "BroadcastHashJoin" in plan
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def _auc(rows):
    good, bad = ([r.quality for r in rows if r.label == k] for k in (1, 0))
    return sum((a > b) + 0.5 * (a == b) for a in good for b in bad) / (len(good) * len(bad))


def test_quality_on_held_out_documents(spark, tmp_path):
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "quality")
    docs = spark.read.parquet(f"{folder}/documents.parquet").join(labels, "doc_id")
    held_out = F.conv(F.substring(F.md5(F.col("doc_id").cast("string")), 1, 4), 16, 10).cast("int") % 4 == 0
    model = enrich.fit_quality_model(docs.filter(~held_out).select("text", "quality"), path=str(tmp_path / "model"))
    # Once a session has observed anything, a model that carries its training summary can no longer score.
    seen = Observation()
    docs.observe(seen, F.count("*").alias("n")).count()
    for scorer in (model, enrich.load_quality_model(str(tmp_path / "model"))):
        scored = enrich.with_quality(docs.filter(held_out).select("text", F.col("quality").alias("label")), scorer)
        rows = scored.select("label", "quality").collect()
        assert all(0 <= r.quality <= 1 for r in rows)
        assert _auc(rows) > 0.95
    assert scored.columns == ["text", "label", "quality"]
    assert abs(_auc([r for r in scored.withColumn("quality", F.lit(0.5)).collect()]) - 0.5) < 1e-9


def test_quality_model_of_few_rows(spark):
    rows = [("good words here", 1), ("good words here", 1), (None, None), ("bad stuff there", 0), ("bad stuff there", 0), ("", 0)]
    labelled = spark.createDataFrame(rows, "text string, quality int").fillna("", ["text"])
    model = enrich.fit_quality_model(labelled)
    scored = {r.text: r.quality for r in enrich.with_quality(labelled, model).collect()}
    assert scored["good words here"] > 0.5 > scored["bad stuff there"]


@pytest.mark.parametrize(
    "html, named",
    [
        ('<html lang="ja">', True), ("<HTML class=x LANG='JA-jp'>", True), ("<html xml:lang=jam>", True),
        ('<html lang = "ja">', False), ("<html><p lang=ja>", False), ("<p lang=ja><html lang=en>", False), (None, None),
    ],
)
def test_language_attribute(spark, html, named):
    df = spark.createDataFrame([(html,)], "html string")
    assert df.select(has_lang_attribute(F.col("html"), "ja").alias("x")).first().x is named


def test_page_route_only_keeps_the_wanted_language(spark, small):
    model = catalog._quality_model(spark, small)
    found = routes.page_links_of_records(catalog._records(spark, small), model, "en")
    every = catalog.extract_audio_links(spark, small).select("url", "audio_url")
    assert found.count() > 0
    assert found.select("url", "audio_url").exceptAll(every).count() == 0


def test_class_ratio_adds_up(spark):
    df = spark.createDataFrame([(c,) for c in "aaaaabbbccde"], "c string")
    rows = stats.class_ratio(df, "c", top=2).collect()
    assert {r.c: r.n for r in rows} == {"a": 5, "b": 3, "Others": 4}
    assert sum(r.pct for r in rows) == pytest.approx(100)


def test_empty_inputs(spark):
    links = spark.createDataFrame([], "audio_url string, language string")
    assert stats.top_domains(links).count() == 0
    assert stats.top_languages(links).count() == 0
    assert tuple(stats.url_uniqueness(links).first()) == (0, 0)
    assert stats.class_ratio(links, "language").count() == 0


def test_plans(spark, small):
    links = fixtures.derive(spark, small, fixtures.LINKS)
    domains = plan_of(stats.top_domains(links))
    assert "TakeOrderedAndProject" in domains and "BroadcastHashJoin" in domains
    assert "SortMergeJoin" not in domains and "Window" not in domains
    assert "Window" not in plan_of(stats.top_languages(links))
    firsts = plan_of(dedup.first_per_url(links, ["archive", "link_pos"]))
    assert "Window" not in firsts and "partial_min" in firsts
    pages = fixtures.load(spark, small, "pages")
    for df in (enrich.main_text(pages), enrich.titles(pages), enrich.with_language(pages, "html")):
        assert "Exchange" not in plan_of(df) and "Python" not in plan_of(df)
    counted = plan_of(stats.top_languages(links))
    assert "c_name" not in counted
