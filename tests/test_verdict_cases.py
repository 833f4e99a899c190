"""Shapes that once gave wrong answers or ended a job."""

from pyspark.sql import functions as F

from wavetrawl.functions.text import decode_references
from wavetrawl.operators.records import decoded
from wavetrawl.sources.snapshots import read_path_lists


def test_snapshot_comes_from_its_folder_not_from_file_names(spark, tmp_path):
    folder = tmp_path / "snapshot_id=2019-18"
    folder.mkdir()
    (folder / "part-00000-41d09288-9288-92aa-b1c2-0123456789ab.txt").write_text("crawl-data/a.gz\n")
    plain = tmp_path / "lists" / "2020-05.txt"
    plain.parent.mkdir()
    plain.write_text("crawl-data/b.gz\n\n")
    rows = read_path_lists(spark, [str(folder), str(plain.parent)]).collect()
    assert sorted(row["snapshot_id"] for row in rows) == ["2019-18", "2020-05"]


def test_paths_are_joined_to_object_store_prefixes(spark, tmp_path):
    (tmp_path / "2020-05.txt").write_text("crawl-data/b.gz\ns3a://other/c.gz\n")
    rows = read_path_lists(spark, str(tmp_path), "s3a://bucket/").collect()
    assert sorted(row["url"] for row in rows) == ["s3a://bucket/crawl-data/b.gz", "s3a://other/c.gz"]


def test_odd_declared_charsets_do_not_end_the_job(spark):
    late = b"<html>" + b" " * 3000 + b'<meta charset="koi8-r">' + "привет".encode("koi8-r")
    rows = [
        (0, b'<meta charset="undefined">\xe9'),
        (1, b'<meta charset="unicode_escape">\xe9'),
        (2, b'<meta charset="utf-16">\xe9'),
        (3, late),
    ]
    frame = spark.createDataFrame(rows, "id int, payload binary")
    texts = dict(frame.select("id", decoded(F.col("payload"))).collect())
    assert all(texts[i].endswith("é") for i in (0, 1, 2))
    assert texts[3].endswith("привет")


def test_references_with_many_zeros_and_beyond_unicode(spark):
    cases = ["x&#0000000046;mp3", "x&#x0000002e;mp3", "x&#99999999999999999999;y", "x&#x110000;y", "&#xFFFFFFFFF;"]
    frame = spark.createDataFrame([(text,) for text in cases], "text string")
    assert [row[0] for row in frame.select(decode_references("text")).collect()] == [
        "x.mp3", "x.mp3", "x�y", "x�y", "�",
    ]
