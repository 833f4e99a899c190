"""Audio links of podcast feeds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wavetrawl.functions.sql_text import let, literal
from wavetrawl.functions.text import attribute_sql, is_truthy, or_empty, tag_attributes_sql, trim
from wavetrawl.functions.urls import AUDIO_EXTENSIONS, is_feed_audio_url

_MEDIA = "`media:content`: array<struct<_url: string>>"
_ITEM = (
    "title: array<string>, description: array<string>, enclosure: array<struct<_url: string>>, "
    f"{_MEDIA}, `media:group`: array<struct<{_MEDIA}>>"
)
ITEM_SCHEMA = f"struct<{_ITEM}>"
FEED_SCHEMA = (
    f"struct<channel: array<struct<language: array<string>, item: array<{ITEM_SCHEMA}>>>, "
    f"item: array<{ITEM_SCHEMA}>, _corrupt_record: string>"
)

# What only looks like tags, and that or an item as a whole; possessive, so that long items cost no stack.
_HIDDEN = r"<!--.*?-->|<!\[CDATA\[.*?\]\]>"
_WHOLE_ITEM = rf"(?s){_HIDDEN}|<item(?:\s[^>]*+)?(?<!/)>(?:[^<]++|{_HIDDEN}|<(?!/item\s*>))*+</item\s*>"

# References that are not defined in XML itself, and stray "&": a lenient reader drops them.
_STRAY_REFERENCE = r"&(?!(?:amp|lt|gt|quot|apos|#[0-9]+|#x[0-9a-fA-F]+);)(?:[A-Za-z_:][A-Za-z0-9_:.-]*;?)?"


def is_feed(content_type: Column, payload: Column) -> Column:
    """Whether a response may be a feed: an XML content type, or a body that starts like one."""
    start = r"^[ \t\n\r\f\x0b]*(<\?xml|<rss|<feed)"
    return F.contains(or_empty(content_type), F.lit("xml")) | F.coalesce(payload.rlike(start), F.lit(False))


def feed_records(records: DataFrame, payload: str = "payload") -> DataFrame:
    """The records that may be feeds. The content type is tested first; it is the cheaper test."""
    return records.filter(is_feed(F.col("content_type"), F.col(payload).cast("string")))


def may_hold_audio_items(payload: Column) -> Column:
    """Whether a feed can have audio links: it names an extension or writes characters as references.

    Most feeds of a crawl are news without audio; this spares them the XML reader.
    """
    named = payload.rlike(rf"\.(?:{'|'.join(AUDIO_EXTENSIONS)})[\"']")
    referenced = payload.rlike(r"""url\s*=\s*(?:"[^"]*&|'[^']*&)""")
    return named | referenced


def _count(text: str, tag: str) -> str:
    return f"size(regexp_extract_all({text}, {literal(rf'<{tag}(?=[\s/>])')}, 0))"


def _url_of(tags: str) -> str:
    """SQL for the first non-empty ``url`` of some tags, given as texts."""
    urls = f"transform({tags}, tag -> {attribute_sql(tag_attributes_sql('tag'), 'url')})"
    return f"get(filter({urls}, url -> coalesce(url, '') <> ''), 0)"


def _written_reference(item: str) -> str:
    """SQL for the reference of an item's text: its first enclosure's at any depth, else the first media element's."""

    def tags(text: str, name: str) -> str:
        return f"regexp_extract_all({text}, {literal(rf'(?s)<{name}(?=[\s/>])[^>]*>')}, 0)"

    first = f"slice({tags('$it', 'enclosure')}, 1, 1)"
    plain = f"regexp_replace({item}, {literal(f'(?s){_HIDDEN}')}, '')"
    return let(plain, f"coalesce({_url_of(first)}, {_url_of(tags('$it', 'media:content'))})")


def _typed_reference(item: str) -> str:
    """SQL for the reference of a typed item: its first enclosure's, else the first media element's, groups included."""
    grouped = f"flatten(transform(coalesce({item}.`media:group`, array()), g -> coalesce(g.`media:content`, array())))"
    media = f"concat(coalesce({item}.`media:content`, array()), {grouped})"
    return f"""coalesce(nullif(get({item}.enclosure, 0)._url, ''),
        get(filter({media}, m -> coalesce(m._url, '') <> ''), 0)._url)"""


def _has_more(items: str) -> str:
    """SQL for whether a feed's text holds items or references that its typed items do not: they lie deeper."""
    media = f"""greatest(coalesce(size(item.`media:content`), 0), 0) + aggregate(coalesce(item.`media:group`, array()), 0,
            (n, g) -> n + greatest(coalesce(size(g.`media:content`), 0), 0))"""
    counts = {"enclosure": "greatest(coalesce(size(item.enclosure), 0), 0)", "media:content": media}
    missing = [f"{_count('$it', 'item')} > size({items})"]
    missing += [f"{_count('$it', tag)} > aggregate({items}, 0, (sum, item) -> sum + {own})" for tag, own in counts.items()]
    return let(f"regexp_replace(__text, {literal(f'(?s){_HIDDEN}')}, '')", " OR ".join(missing))


def parse_feeds(feeds: DataFrame, payload: str = "payload") -> DataFrame:
    """Add ``outcome``, ``feed_language`` and ``items`` (``item, url``) to feeds whose payload is text.

    Outcomes: ``parsed``; ``recovered`` for broken XML from which complete items could still be read;
    ``rejected`` for broken XML without any; ``no_item`` for sound XML without items, such as Atom.
    A broken feed never fails the job.

    Items are read where feeds have them, in channels or at the root. Only where a feed's text names more items,
    enclosures or media elements than that finds are its items cut out of the text, at whatever depth.
    """
    text = trim(F.regexp_replace(F.col(payload), "^﻿", ""))
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}
    read = feeds.withColumn("__text", text).withColumn("__feed", F.from_xml("__text", FEED_SCHEMA, options))
    broken_sql = "__feed IS NULL OR __feed._corrupt_record IS NOT NULL"
    broken = F.expr(broken_sql)
    no_items = F.array().cast(f"array<{ITEM_SCHEMA}>")
    in_channels = F.flatten(F.filter(F.col("__feed.channel.item"), lambda items: items.isNotNull()))
    sound_items = F.concat(F.coalesce(in_channels, no_items), F.coalesce(F.col("__feed.item"), no_items))
    read = read.withColumn("__items", F.when(broken, no_items).otherwise(sound_items))
    read = read.withColumn("__more", F.expr(f"NOT ({broken_sql}) AND ({_has_more('__items')})"))
    # Sound XML is read as it is; of broken XML the stray references go.
    clean = f"if(__more, raw, regexp_replace(raw, {literal(_STRAY_REFERENCE)}, ''))"
    whole = f"filter(regexp_extract_all(__text, {literal(_WHOLE_ITEM)}, 0), raw -> startswith(raw, '<item'))"
    cut = f"""transform({whole}, raw -> named_struct(
        'item', from_xml({clean}, {literal(ITEM_SCHEMA)}), 'written', {_written_reference('raw')}))"""
    typed = f"transform(__items, item -> named_struct('item', item, 'url', {_typed_reference('item')}))"
    written = f"""transform({cut}, c -> named_struct('item', c.item, 'url',
        if(__more, c.written, coalesce({_typed_reference('c.item')}, c.written))))"""
    language = F.when(
        broken, F.regexp_extract("__text", r"(?s)<language(?:\s[^>]*)?>\s*([^<]*?)\s*</language", 1)
    ).otherwise(trim(F.get(F.get(F.col("__feed.channel.language"), F.lit(0)), F.lit(0))))
    items = F.expr(f"if(({broken_sql}) OR __more, {written}, {typed})")
    count = F.coalesce(F.size("items"), F.lit(0))
    return (
        read.withColumn("items", items)
        .withColumn(
            "outcome",
            F.when(broken & (count > 0), F.lit("recovered"))
            .when(broken, F.lit("rejected"))
            .when(count == 0, F.lit("no_item"))
            .otherwise(F.lit("parsed")),
        )
        .withColumn("feed_language", or_empty(language))
        .drop("__text", "__feed", "__items", "__more")
    )


def feed_items(parsed: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """One row per item of :func:`parse_feeds`, audio or not: ``audio_url`` is NULL without a reference.

    The reference is the first enclosure's if it has one, else that of the first media element with one, in groups
    or not. Texts are trimmed; what is missing is empty.
    """
    names = keep if keep is not None else ["target_uri"]
    kept = [F.col(f"`{c}`") for c in names]
    item = F.col("entry.item")
    return (
        parsed.select(*kept, "feed_language", F.posexplode_outer("items").alias("item_pos", "entry"))
        .filter(item.isNotNull())
        .select(
            *[F.col(f"`{c}`").alias("page_url" if c == "target_uri" else c) for c in names],
            "item_pos",
            F.nullif("entry.url", F.lit("")).alias("audio_url"),
            or_empty(trim(F.get(item["title"], F.lit(0)))).alias("title"),
            or_empty(trim(F.get(item["description"], F.lit(0)))).alias("description"),
            F.col("feed_language").alias("language"),
        )
    )


def feed_audio_links(items: DataFrame) -> DataFrame:
    """The items whose reference is an audio URL."""
    return items.filter(is_truthy(F.col("audio_url")) & is_feed_audio_url(F.col("audio_url")))
