import random
import time

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from wavetrawl.operators import page_links
from wavetrawl.operators.dedup import first_per_page_url
from wavetrawl.operators.page_links import extract_audio_links, link_candidates, page_tokens

URL = "http://h.com/p/q.html"


def links(spark, html, url=URL):
    df = spark.createDataFrame([(1, url, html)], "page_id long, url string, html string")
    rows = extract_audio_links(df).orderBy("pass", "first", "second", "rank").collect()
    return [(r.audio_url, r.description, r.license) for r in rows]


CASES = {
    "title attribute wins": ('a<audio title="T" src="x.mp3">b</audio>', [("x.mp3", "T", "")]),
    "text on both sides": ("a<audio src=x.mp3></audio>b", [("x.mp3", "a b", "")]),
    "own content is the next text": ("a<a href=x.mp3>c</a>b", [("x.mp3", "a c", "")]),
    "white space counts as text": ("<p>a</p> <audio src=x.mp3></audio><p>b</p>", [("x.mp3", "b", "")]),
    "upper-case tags and quotes": ("a<AUDIO SRC='x.MP3?y=1'>b", [("x.MP3?y=1", "a b", "")]),
    "last of repeated attributes": ('a<a href="y.mp3" href="x.mp3">', [("x.mp3", "a", "")]),
    "attribute inside another's value": ('a<a title="" data-x="href=y.mp3" href="x.mp3">', [("x.mp3", "a", "")]),
    "scripts, styles and comments are not read": (
        "a<script>'<a href=y.mp3>z</a>'</script><style>q</style><!-- <a href=y.mp3> -->b<a href=x.mp3>",
        [("x.mp3", "b", "")],
    ),
    "comment parts two texts": ("a<!-- c -->b<a href=x.mp3></a>", [("x.mp3", "b", "")]),
    "references in values": ("a<a href='x&#46;mp3?a=1&amp;b=2'>", [("x.mp3?a=1&b=2", "a", "")]),
    "references in texts": ("&copy; a &amp b<a href=x.mp3>", [("x.mp3", "© a & b", "")]),
    "stray less-than is text": ("a < b<a href=x.mp3>", [("x.mp3", "a < b", "")]),
    "tags without audio attributes": ("<object data=x.mp3></object><video src=x.mp3></video><a>.mp3</a>", []),
    "source only inside audio counts first": (
        "a<source src=y.ogg>b<audio>c<source src=x.mp3>d</audio>",
        [("x.mp3", "c d", ""), ("y.ogg", "a b", "")],
    ),
    "audio tag before earlier links": ("a<a href=y.mp3>b</a><audio src=x.mp3></audio>", [("x.mp3", "b", ""), ("y.mp3", "a b", "")]),
    "first of a repeated link": ("a<a href=x.mp3>b</a><a href=x.mp3>c</a>", [("x.mp3", "a b", "")]),
    "href before src": ("a<embed src=y.mp3 href=x.mp3>", [("x.mp3", "a", ""), ("y.mp3", "a", "")]),
    "empty source of audio is skipped": ("a<audio src=''></audio><a href=x.mp3>b", [("x.mp3", "a b", "")]),
    "inherited license": ("<div license=L>a<p><a href=x.mp3></a></p></div>", [("x.mp3", "a", "L")]),
    "nearest license": ("<div license=L>a<p data-license=M><a href=x.mp3></p></div>", [("x.mp3", "a", "M")]),
    "own license": ("<div license=L>a<a href=x.mp3 data-licence='N'></div>", [("x.mp3", "a", "N")]),
    "empty license stops the search": ("<div license=L>a<p license><a href=x.mp3></p></div>", [("x.mp3", "a", "")]),
    "license ends with its element": ("<p license=L>a</p><a href=x.mp3>b", [("x.mp3", "a b", "")]),
    "unclosed tags close with their parent": ("<div><p license=L><b>a</div><a href=x.mp3>b", [("x.mp3", "a b", "")]),
    "stray closing tag is ignored": ("<p license=L>a</i><a href=x.mp3>b", [("x.mp3", "a b", "L")]),
    "void tags hold nothing": ("<img license=L>a<a href=x.mp3>b", [("x.mp3", "a b", "")]),
    "audio closed by its parent": (
        "<div><audio>a</div>b<source src=x.mp3>c<a href=y.mp3>",
        [("x.mp3", "b c", ""), ("y.mp3", "c", "")],
    ),
    "quoted greater-than": (
        '<p>a<a title="" data-x="1 > 0" href="x.mp3">b</a><img alt=\'<a href="y.mp3">\'>',
        [("x.mp3", "a b", "")],
    ),
    "quoted brackets are kept": ('a<a title="5 > 4 &amp;gt; <3" href=x.mp3>', [("x.mp3", "5 > 4 &gt; <3", "")]),
    "comment mark in a value": ('a<a title="<!-- t" href=x.mp3>b</a><!-- <a href=y.mp3> -->', [("x.mp3", "<!-- t", "")]),
    "quote outside a value": ("a<a title=it's href=x.mp3>b don't</a>", [("x.mp3", "it's", "")]),
    "quote that is not closed": ('a<a href=x.mp3 title="t>b</a> c', [("x.mp3", '"t', "")]),
    "named references": ("a<a href='x&period;mp3' title='&lbrack;t&rsqb; &copy'>", [("x.mp3", "[t] &copy", "")]),
    "old names without semicolon": ("&copy &alpha &hearts;<a href=x.mp3>", [("x.mp3", "© &alpha ♥", "")]),
    "similar tag names": ("<abbr href=x.mp3><audiox src=x.mp3><linked href=x.mp3>", []),
}


@pytest.fixture(scope="module")
def found(spark):
    pages = [(name, URL, html) for name, (html, _) in CASES.items()]
    df = spark.createDataFrame(pages, "page_id string, url string, html string")
    rows = extract_audio_links(df).orderBy("page_id", "pass", "first", "second", "rank").collect()
    by_case = {name: [] for name in CASES}
    for row in rows:
        by_case[row.page_id].append((row.audio_url, row.description, row.license))
    return by_case


@pytest.mark.parametrize("name", CASES)
def test_page(found, name):
    assert found[name] == [(f"http://h.com/p/{u}", d, lic) for u, d, lic in CASES[name][1]]


def test_source_falls_back_to_the_text_around_its_audio(spark):
    html = "<p>a</p> <audio><source src=x.mp3> </audio>"
    assert links(spark, html) == [("http://h.com/p/x.mp3", "", "")]
    html = "<p>a</p><audio> <source src=x.mp3> </audio>"
    assert links(spark, html) == [("http://h.com/p/x.mp3", "a", "")]


def test_description_is_cut(spark):
    assert links(spark, "é" * 150 + "<a href=x.mp3>")[0][1] == "é" * 100


def test_empty_reference_on_an_audio_page(spark):
    assert links(spark, "a<a href=''>b</a><a href='#t'>", "http://h.com/s.mp3") == [
        ("http://h.com/s.mp3", "a b", ""),
        ("http://h.com/s.mp3#t", "b", ""),
    ]


def test_disguised_extensions_pass_the_page_filter(spark):
    for ref in ("x.m&#112;3", "x.m\np3", "x&#46;&#x4D;P&#51;", "x&#x2E;\t&#10;m\r\np3", "x.&#0109;p3"):
        assert [u.lower() for u, *_ in links(spark, f"<a href='{ref}'></a>")] == ["http://h.com/p/x.mp3"], ref
    assert links(spark, "<a href='x.mp&#038;3'>." + "\n" * 100_000 + "</a>") == []


def test_dedup_in_the_row_equals_the_aggregate(spark):
    html = "".join(f"t{i}<a href=x{i % 7}.mp3 src=x{i % 5}.mp3></a><audio src=x{i % 3}.mp3></audio>" for i in range(60))
    df = spark.createDataFrame([(i, URL, html * (i + 1)) for i in range(5)], "page_id long, url string, html string")
    fields = ["page_id", "audio_url", "description", "license"]
    in_row = extract_audio_links(df).select(*fields)
    assert sorted(in_row.collect()) == sorted(first_per_page_url(link_candidates(df)).select(*fields).collect())


def test_tokens_add_up_to_the_page(spark, small):
    pages = spark.read.parquet(f"{small}/pages.parquet")
    joined = page_tokens(pages).groupBy("page_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "token"))), lambda s: s["token"]), "").alias("j")
    )
    assert pages.join(joined, "page_id", "left").filter("NOT html <=> j").count() == 0


def test_long_pages_do_not_overflow(spark):
    html = "<div>" * 3000 + "x" * 200_000 + "<p>y" * 3000 + "<a href=x.mp3 license=L>" + " <b>" * 20_000
    assert links(spark, html) == [("http://h.com/p/x.mp3", "y", "L")]


def brute_licenses(tags):
    """For each link in order, the license it inherits: a plain stack."""
    stack, found = [], []
    for name, closes, own in tags:
        if closes:
            if name in [n for n, _ in stack]:
                while stack.pop()[0] != name:
                    pass
            continue
        here = own if own is not None else next((x for _, x in reversed(stack) if x is not None), None)
        if name == "a":
            found.append(here or "")
        if name != "img":
            stack.append((name, own))
    return found


@pytest.mark.parametrize("per_fold, length", [(256, 1024), (3, 4), (5, 40)])
def test_licenses_like_a_plain_stack(spark, monkeypatch, per_fold, length):
    monkeypatch.setattr(page_links, "_TAGS_PER_FOLD", per_fold)
    monkeypatch.setattr(page_links, "_OPEN_LENGTH", length)
    rng = random.Random(6)
    pages, want = [], {}
    for page in range(40):
        names = ("a", "p", "div", "b", "img") if page % 2 else ("a", "u1", "u2", "u3", "u4", "u5", "div")
        tags = [
            (rng.choice(names), rng.random() < (0.5 if page % 3 else 0.25), rng.choice([None, None, None, f"L{i}"]))
            for i in range(rng.randint(0, 120))
        ]
        html = "<p>.mp3" + "".join(
            f"</{n}>" if closes else f"<{n} href=x{i}.mp3" + (f" license={own}" if own else "") + ">"
            for i, (n, closes, own) in enumerate(tags)
        )
        pages.append((page, URL, html))
        want[page] = brute_licenses([("p", False, None), *tags])
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    rows = link_candidates(df).orderBy("page_id", "first").collect()
    got = {page: [row.license for row in rows if row.page_id == page] for page in want}
    assert got == want


def test_many_links_take_linear_time(spark):
    def seconds(n, item, end):
        html = "<div license=L>" + "".join(item.format(i=i) for i in range(n)) + end * n
        df = spark.createDataFrame([(1, URL, html)], "page_id long, url string, html string").coalesce(1)
        start = time.perf_counter()
        assert extract_audio_links(df).filter("license <> ''").count() == n
        return time.perf_counter() - start

    for item, end in (("t <a href=x{i}.mp3>y</a>", ""), ("<p license=M>t <a href=x{i}.mp3>y</a>", "</p>")):
        seconds(500, item, end)
        short, long = seconds(4_000, item, end), seconds(16_000, item, end)
        assert long < 4 * 2.3 * max(short, 1), (short, long)


def test_a_long_quoted_value_is_read_in_one_go(spark):
    html = "a<a title='" + "> < " * 250_000 + "' href=x.mp3>b</a>" + '<a title="' * 2000
    start = time.perf_counter()
    assert [u for u, *_ in links(spark, html)] == ["http://h.com/p/x.mp3"]
    assert time.perf_counter() - start < 20


def test_no_shuffle_and_no_python(spark, small):
    plan = plan_of(extract_audio_links(spark.read.parquet(f"{small}/pages.parquet")))
    assert "Exchange" not in plan and "Python" not in plan and "ArrowEval" not in plan
