from pyspark.sql import functions as F

from wavetrawl.operators.feeds import feed_audio_links, feed_items, feed_records, may_hold_audio_items, parse_feeds
from wavetrawl.plans.routes import links_of_feeds

HEAD = '<rss xmlns:media="m"><channel><language> ja </language>'
TAIL = "</channel></rss>"

# payload -> (outcome, links as (url, title, description, language))
CASES = {
    f'{HEAD}<item><title> A </title><enclosure url="u.mp3"/></item>{TAIL}': ("parsed", [("u.mp3", "A", "", "ja")]),
    f'{HEAD}<item><enclosure url="a.txt"/><enclosure url="u.mp3"/></item>{TAIL}': ("parsed", []),
    f'{HEAD}<item><enclosure/><media:content url="u.m4a"/></item>{TAIL}': ("parsed", [("u.m4a", "", "", "ja")]),
    f'{HEAD}<item><enclosure url=""/><media:group><media:content url="u.ogg"/></media:group></item>{TAIL}': (
        "parsed",
        [("u.ogg", "", "", "ja")],
    ),
    f'{HEAD}<item><enclosure url="u.MP3"/></item><item><enclosure url="u.mp3?x=1"/></item>{TAIL}': ("parsed", []),
    f'{HEAD}<item><title>a &amp; b</title><description><![CDATA[<p>x & y</p>]]></description>'
    f'<enclosure url="u.aac"/></item>{TAIL}': ("parsed", [("u.aac", "a & b", "<p>x & y</p>", "ja")]),
    f'{HEAD}<item><title>ほ</title><enclosure url="u&#46;wav"/></item>{TAIL}': ("parsed", [("u.wav", "ほ", "", "ja")]),
    '﻿ \n<?xml version="1.0"?><rdf:RDF><channel><language>en</language></channel><item><enclosure url="u.flac"/></item></rdf:RDF>': (
        "parsed",
        [("u.flac", "", "", "en")],
    ),
    '<rss><channel><item><language>xx</language><enclosure url="u.mp3"/></item></channel></rss>': (
        "parsed",
        [("u.mp3", "", "", "")],
    ),
    f'{HEAD}<item><title>&nbsp;a & b</title><enclosure url="u.mp3"/></item>{TAIL}': (
        "recovered",
        [("u.mp3", "a  b", "", "ja")],
    ),
    f'{HEAD}<item><enclosure url="u.mp3"/></item><item><title>cut': ("recovered", [("u.mp3", "", "", "ja")]),
    f"{HEAD}<item><title>cut .mp3\" ": ("rejected", []),
    f'{HEAD}<!-- <item> --><list><part><item><title>D</title><files><file><enclosure url="u.mp3"/></file></files></item></part>'
    f'<item><title>E</title><media:content url=""/><x><media:content url="v.ogg"/></x></item></list>{TAIL}': (
        "parsed",
        [("u.mp3", "D", "", "ja"), ("v.ogg", "E", "", "ja")],
    ),
    f'{HEAD}<item><media:group/><media:group><media:content url=""/></media:group><media:group><media:content url="u.aac"/>'
    f"</media:group></item>{TAIL}": ("parsed", [("u.aac", "", "", "ja")]),
    f'{HEAD}<a><item><description><![CDATA[<item><enclosure url="no.mp3"/></item>]]></description><enclosure url="u.wav"/></item></a>'
    f"{TAIL}": ("parsed", [("u.wav", "", '<item><enclosure url="no.mp3"/></item>', "ja")]),
    f'{HEAD}<item><description>&lt;enclosure&gt;<![CDATA[<enclosure url="no.mp3">]]></description></item>{TAIL}': ("parsed", []),
    '<feed><entry><link href="u.mp3"/></entry></feed>': ("no_item", []),
    "not a feed .mp3'": ("rejected", []),
}


def test_parse_and_links(spark):
    given = spark.createDataFrame([(p, p) for p in CASES], "target_uri string, payload string")
    parsed = parse_feeds(given)
    assert {r.payload: r.outcome for r in parsed.collect()} == {p: o for p, (o, _) in CASES.items()}
    got = {p: [] for p in CASES}
    for r in feed_audio_links(feed_items(parsed)).orderBy("item_pos").collect():
        got[r.page_url].append((r.audio_url, r.title, r.description, r.language))
    assert got == {p: links for p, (_, links) in CASES.items()}
    assert links_of_feeds(given).count() == sum(len(links) for _, links in CASES.values())
    hopeless = given.filter(~may_hold_audio_items(F.col("payload"))).select("payload").collect()
    assert all(not CASES[r.payload][1] for r in hopeless)


def test_feed_sniff(spark):
    rows = [
        ("application/rss+xml", "x", True),
        ("application/xhtml+xml", "x", True),
        ("text/html", " \n<?xml version", True),
        (None, "<rss>", True),
        ("", "\x0b<feed", True),
        ("text/html", "<html><rss>", False),
        (None, "", False),
        ("TEXT/XML", "x", False),
    ]
    df = spark.createDataFrame([(c, bytearray(p, "utf-8"), k) for c, p, k in rows], "content_type string, payload binary, kept boolean")
    assert [r.kept for r in feed_records(df).collect()] == [True] * 5
