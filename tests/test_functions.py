import html
from urllib.parse import urljoin, urlparse

import pytest
from pyspark.sql import functions as F

from wavetrawl.functions.domains import bundled_suffixes, read_suffix_list, with_registered_domain
from wavetrawl.operators.stats import top_domains
from wavetrawl.functions.language import base_language, has_lang_attribute, language_of
from wavetrawl.functions.text import decode_references, header_text, squeeze, trim
from wavetrawl.functions.urls import is_feed_audio_url, is_page_audio_url, resolve_url, url_host

BASES = ["http://h.com/d1//d2/x.html?q=1#f", "https://h.com", "https://h.com/a/b/c;p", "", "https://h.com/a/", "HTTP://H.com/z"]
REFS = [
    "a.mp3", "/r//x/../y.mp3", "//cdn/x/../1.wav", "a//b/../1.wav", "?z=1", "#top", "https:foo.mp3", "http:foo.mp3",
    " /x.mp3", "/x.mp3 ", "a\tb\n.mp3", "../../../../u.mp3", "", "./", "..", ".", "http://[bad", "http://x/[a].mp3",
    "mailto:a@b", "//[::1]/a.mp3", "//[zz]/a.mp3", "HTTP://Foo/a.mp3", "b?", "b#", "x;y", "a/b/../..", "http://h/../a.mp3",
    "javascript:void(0)", "foo:bar.mp3", "...", "/", "//", "///a.mp3", "data:audio/mp3,xx", "a b.mp3", "日本/音.mp3",
]


def _expected(base, ref):
    def sound(url):
        parts = urlparse(url)
        return url if parts.scheme or parts.netloc or parts.path else None

    try:
        if ref.startswith(("http://", "https://")) or not base:
            return sound(ref)
        return sound(urljoin(base, ref))
    except ValueError:
        return None


def test_resolve_url_agrees_with_the_standard_library(spark):
    cases = [(b, r, _expected(b, r)) for b in BASES for r in REFS]
    df = spark.createDataFrame(cases, "base string, ref string, expected string")
    wrong = df.withColumn("got", resolve_url("base", "ref")).filter(~F.col("got").eqNullSafe(F.col("expected")))
    assert wrong.collect() == []


def test_resolving_an_absolute_url_changes_nothing(spark):
    df = spark.createDataFrame([(b, f"https://x.example/{i}/../a b.mp3?{i}") for i, b in enumerate(BASES)], "b string, r string")
    assert df.filter(resolve_url("b", "r") != F.col("r")).count() == 0


@pytest.mark.parametrize(
    "url, page, feed",
    [
        ("http://h/a.mp3", True, True),
        ("http://h/a.MP3", True, False),
        ("http://h/a.mp3?x=1", True, False),
        ("http://h/a.flac#t", True, False),
        ("http://h/x?f=a.ogg", False, True),
        ("http://h/a.mp4", False, False),
        ("http://h/amp3", False, False),
        ("http://h/a.aac", True, True),
    ],
)
def test_audio_tests_differ(spark, url, page, feed):
    row = spark.createDataFrame([(url,)], "u string").select(is_page_audio_url("u"), is_feed_audio_url(F.col("u"))).first()
    assert tuple(row) == (page, feed)


def test_references_are_decoded_like_html(spark):
    texts = ["&copy; a &amp;&#39;&#x3042;&#150;", "&nope; & &lt;b&gt;&middot;", "&amp;copy;", "no", "&#0;&#xD800;", "&apos;"]
    got = spark.createDataFrame([(t,) for t in texts], "s string").select("s", decode_references("s").alias("d")).collect()
    assert [r.d for r in got] == [html.unescape(t) for t in texts]


def test_loose_references_need_no_semicolon(spark):
    df = spark.createDataFrame([("a &amp b &copy",)], "s string")
    assert df.select(decode_references("s", loose=True)).first()[0] == "a & b ©"
    assert df.select(decode_references("s")).first()[0] == "a &amp b &copy"


def test_trim_takes_all_white_space(spark):
    df = spark.createDataFrame([("　\xa0\t a \nb \x85",)], "s string")
    assert tuple(df.select(trim(F.col("s")), squeeze(F.col("s"))).first()) == ("a \nb", "a b")


def test_header_text(spark):
    df = spark.createDataFrame([(bytearray(b"audio/\xffmpeg"),), (None,)], "h binary")
    assert [r[0] for r in df.select(header_text(F.col("h"))).collect()] == ["audio/�mpeg", ""]


DOMAINS = {
    "https://a.b.example.co.jp/x": "example.co.jp",
    "http://example.com:80/": "example.com",
    "user:p@ss@dl.example.com/x": "example.com",
    "https://192.0.2.1/a": "192.0.2.1",
    "http://[::1]:8/a": "[::1]",
    "http://localhost/a": "localhost",
    "http://a.b.unknowntld/": "b.unknowntld",
    "http://co.uk/": "co.uk",
    "http://www.ck/": "www.ck",
    "http://x.y.foo.ck/": "y.foo.ck",
    "http://foo.ck/": "foo.ck",
    "http://a.city.kawasaki.jp/": "city.kawasaki.jp",
    "http://a.b.c.kawasaki.jp/": "b.c.kawasaki.jp",
    "http://example.com./": "example.com",
    "//cdn.example.org/a?u=http://x.net": "example.org",
    "": "",
}


def test_registered_domain(spark):
    df = spark.createDataFrame(list(DOMAINS.items()), "audio_url string, expected string")
    assert with_registered_domain(df).filter("NOT domain <=> expected").collect() == []


def test_registered_domain_with_own_rules(spark):
    rules = spark.createDataFrame([("example",), ("a.b.example",)], "suffix string")
    df = spark.createDataFrame([("http://x.y.a.b.example/",), ("http://q.example/",)], "audio_url string")
    assert [r.domain for r in with_registered_domain(df, suffixes=rules).collect()] == ["y.a.b.example", "q.example"]


def test_host(spark):
    df = spark.createDataFrame([("https://U@H.com:8/x",), ("h.com/x",), ("localhost:80",)], "u string")
    assert [r[0] for r in df.select(url_host(F.col("u"))).collect()] == ["H.com", "h.com", "localhost"]


@pytest.mark.parametrize(
    "page, found",
    [
        ('<html lang="ja">', True),
        ("<HTML class=x LANG=ja-JP>", True),
        ("<html xml:lang='ja'>", True),
        ("<html lang=jam>", True),
        ('<html lang = "ja">', False),
        ('<html><body lang="ja">', False),
    ],
)
def test_lang_attribute(spark, page, found):
    df = spark.createDataFrame([(page,)], "h string")
    assert df.select(has_lang_attribute(F.col("h"), "ja")).first()[0] is found


def test_base_language(spark):
    df = spark.createDataFrame([("ja_JP",), ("EN-us",), ("",), ("no",)], "l string")
    assert [r[0] for r in df.select(base_language(F.col("l"))).collect()] == ["ja", "en", "", "no"]


def test_language_of_documents(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").withColumn("got", language_of("text"))
    right, total = docs.agg(F.count_if(F.col("got") == F.col("lang")), F.count("*")).first()
    assert right / total > 0.9


def test_japanese_by_script(spark):
    texts = [("これは日本語の文章です。", "ja"), ("这是中文文章。", None), ("the end of it", "en"), ("", None)]
    df = spark.createDataFrame(texts, "t string, e string")
    assert df.filter(~language_of("t").eqNullSafe(F.col("e"))).collect() == []


def test_bundled_rules_equal_the_same_rules_given(spark):
    df = spark.createDataFrame(list(DOMAINS.items()), "audio_url string, expected string")
    given = with_registered_domain(df, suffixes=bundled_suffixes(spark))
    assert given.filter("NOT domain <=> expected").collect() == []


def test_domains_under_no_rule_keep_two_labels_and_a_flag(spark, tmp_path):
    hosts = {
        "a.b.pod.xyz": ("pod.xyz", "unlisted"), "xyz": ("xyz", "unlisted"), "a.example.co.jp": ("example.co.jp", "listed"),
        "192.0.2.1": ("192.0.2.1", "address"), "": ("", "none"), "x.www.ck": ("www.ck", "listed"),
    }
    df = spark.createDataFrame([(f"http://{host}/x" if host else "",) for host in hosts], "audio_url string")
    rows = with_registered_domain(df, rule="rule").collect()
    assert [(r.domain, r.rule) for r in rows if r.audio_url != "http://x.www.ck/x"] == [
        v for k, v in hosts.items() if k != "x.www.ck"
    ]
    (tmp_path / "list.dat").write_text(
        "// comment\n\nxyz extra words\npod.xyz\n*.ck\n!www.ck\n// ===BEGIN PRIVATE DOMAINS===\nb.pod.xyz\n"
    )
    public = read_suffix_list(spark, str(tmp_path / "list.dat"))
    assert {r.suffix for r in public.collect()} == {"xyz", "pod.xyz", "*.ck", "!www.ck"}
    assert read_suffix_list(spark, str(tmp_path / "list.dat"), private=True).count() == 5
    found = {r.audio_url: (r.domain, r.rule) for r in with_registered_domain(df, suffixes=public, rule="rule").collect()}
    assert found["http://a.b.pod.xyz/x"] == ("b.pod.xyz", "listed") and found["http://x.www.ck/x"] == ("www.ck", "listed")
    assert found["http://a.example.co.jp/x"] == ("co.jp", "unlisted")
    assert with_registered_domain(df, suffixes=public.limit(0)).columns == ["audio_url", "domain"]


def test_top_domains_state_the_unlisted_share(spark):
    links = [("http://a.pod.xyz/1",)] * 3 + [("http://b.example.com/1",)] * 5 + [("http://192.0.2.1/",)] * 2 + [("",)]
    rows = top_domains(spark.createDataFrame(links, "audio_url string"), k=2).collect()
    assert [(r.domain, r.n, r.pct, r.unlisted_pct) for r in rows] == [("example.com", 5, 50.0, 30.0), ("pod.xyz", 3, 30.0, 30.0)]
