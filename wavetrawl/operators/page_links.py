"""Audio links of HTML pages.

A page is one row from start to end: its mark-up is cut into tags and texts with regular expressions,
and everything that needs the order of the document (neighbouring text, inherited license, first link
per URL) is worked out on arrays inside that row. Only finished links leave it, so the whole route is a
map over pages without any shuffle, and no page's HTML ever crosses the network.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wavetrawl.functions.sql_text import bind, let, literal
from wavetrawl.functions.text import (
    TOKEN,
    attribute_sql,
    decode_references_sql,
    or_empty,
    tag_attributes_sql,
    tag_name_sql,
    trim_sql,
    with_plain_tags_sql,
)
from wavetrawl.functions.urls import AUDIO_EXTENSIONS, is_page_audio_url_sql, mentions_audio_sql, resolve_url_sql, split_url_sql

# What carries no text and no links.
_HIDDEN = r"(?is)<(?:script\b.*?</script\s*>|style\b.*?</style\s*>|!--.*?-->|[!?][^>]*>)"

# Tags that may link to audio besides "audio" itself, and tags that never enclose others.
LINKING_TAGS = ("a", "source", "embed", "iframe", "object", "track", "link")
VOID_TAGS = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr")

_LINK_TAG = rf"(?i)<(?:audio|{'|'.join(LINKING_TAGS)})(?=[\s/>])[^>]*>"

# Tags that matter for what encloses what.
_NESTING_TAG = rf"(?i)</?(?!(?:{'|'.join(t for t in VOID_TAGS if t not in LINKING_TAGS)})[\s/>])([a-z][^\s/>]*)[^>]*>"

_LINE_GAP = r"[\t\r\n]*+"
_REFERENCE_GAP = r"(?:[\t\r\n]++|&#0*+(?:9|10|13);|&#[xX]0*+[9aAdD];|&Tab;|&NewLine;)*+"


def _extension(written: Callable[[str], str], gap: str) -> str:
    endings = (gap.join(map(written, extension)) for extension in AUDIO_EXTENSIONS)
    return f"{written('.')}{gap}(?:{'|'.join(endings)})"


def _character_or_reference(char: str) -> str:
    forms = sorted({char, char.upper()})
    numeric = [f"&#0*+{ord(c)};|&#[xX]0*+(?i:{ord(c):x});" for c in forms]
    named = ["&period;"] if char == "." else []
    return f"(?:{'|'.join([*map(re.escape, forms), *numeric, *named])})"


# An extension broken by tabs or line ends, and one with character references as well: both vanish when a
# reference is read and resolved. The repeats are possessive, so long runs cost no stack.
_BROKEN_EXTENSION = "(?i)" + _extension(re.escape, _LINE_GAP)
_DISGUISED_EXTENSION = "(?=[.&])" + _extension(_character_or_reference, _REFERENCE_GAP)

DESCRIPTION_LENGTH = 100
_BREAK = "\x01"


def page_tokens(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """One row per token of a page: ``key, pos, kind, name, attrs, token``; the tokens add up to the page."""
    kind = rf"""CASE
        WHEN token RLIKE {literal(r'(?i)^<script\b')} THEN 'script'
        WHEN token RLIKE {literal(r'(?i)^<style\b')} THEN 'style'
        WHEN startswith(token, '<!--') THEN 'comment'
        WHEN token RLIKE '^<[!?]' THEN 'declaration'
        WHEN token RLIKE '^</[a-zA-Z]' THEN 'close'
        WHEN token RLIKE '^<[a-zA-Z]' THEN 'open'
        ELSE 'text' END AS kind"""
    tokens = F.regexp_extract_all("html", F.lit(TOKEN), F.lit(0))
    return (
        pages.select(key, F.posexplode_outer(tokens).alias("pos", "token"))
        .filter(F.col("token").isNotNull())
        .selectExpr(key, "bigint(pos) AS pos", kind, "token")
        .selectExpr(
            key,
            "pos",
            "kind",
            f"if(kind IN ('open', 'close'), {tag_name_sql('token')}, '') AS name",
            f"if(kind = 'open', {tag_attributes_sql('token')}, NULL) AS attrs",
            "token",
        )
    )


def _visible_markup(html: str) -> str:
    """The page with scripts, styles, comments and declarations emptied, and "<" and ">" only where tags are."""
    plain = with_plain_tags_sql(f"replace({html}, '{_BREAK}', '')")
    emptied = f"regexp_replace({plain}, {literal(_HIDDEN)}, '<!>')"
    return f"regexp_replace({emptied}, '<(?!/?[a-zA-Z]|!)', '&lt;')"


def _segments(markup: str) -> str:
    """The page cut before each text; every element but the first starts with one text."""
    return f"split(regexp_replace({markup}, '(^|>)([^<]+)', '$1{_BREAK}$2'), '{_BREAK}')"


def _linking_tags(segments: str) -> str:
    """``array<struct<tag, before, after>>`` of all tags that may link, with the nearest texts."""
    return f"""flatten(transform({segments}, (segment, i) -> transform(
        regexp_extract_all(segment, {literal(_LINK_TAG)}, 0),
        tag -> named_struct(
            'tag', tag,
            'before', if(i > 0, substring_index(segment, '<', 1), NULL),
            'after', substring_index(get({segments}, i + 1), '<', 1)))))"""


def _surroundings(before: str, after: str) -> str:
    """The nearest texts on both sides, trimmed, joined and cut."""
    parts = f"filter(array({before}, {after}), t -> length(t) > 0)"
    joined = f"array_join(transform({parts}, t -> {trim_sql(decode_references_sql('t', loose=True))}), ' ')"
    return f"substring({trim_sql(joined)}, 1, {DESCRIPTION_LENGTH})"


# Tags that one inner fold goes over, and the length at which the text of open elements is put aside.
_TAGS_PER_FOLD = 256
_OPEN_LENGTH = 1024

_MARK = "\x02"


def _struct(**fields: str) -> str:
    return f"named_struct({', '.join(f"'{name}', {value}" for name, value in fields.items())})"


def _before_last(text: str, delimiter: str) -> str:
    """The text before the last occurrence of a delimiter that it holds."""
    return f"left({text}, length({text}) - length(substring_index({text}, {delimiter}, -1)) - length({delimiter}))"


def _last_mark(open_text: str, otherwise: str) -> str:
    """What the innermost marked element of an open text says."""
    last = f"substring_index(substring_index(substring_index({open_text}, '{_MARK}', -2), '{_MARK}', 1), '{_BREAK}', -1)"
    return f"if(contains({open_text}, '{_MARK}'), {last}, {otherwise})"


def _names(open_text: str) -> str:
    return f"array_distinct(regexp_extract_all({open_text}, {literal(f'{_BREAK}([^{_BREAK}{_MARK}]+){_BREAK}')}, 1))"


def _delimited(name: str) -> str:
    return f"concat('{_BREAK}', {name}, '{_BREAK}')"


def _tag_step() -> str:
    """The inner fold's step: the state after one tag."""
    void = ", ".join(f"'{name}'" for name in VOID_TAGS)
    links = f"tag.name IN ({', '.join(f"'{name}'" for name in ('audio', *LINKING_TAGS))})"
    pushes = f"NOT tag.alone AND tag.name NOT IN ({void})"
    brings = f"{pushes} AND (tag.license IS NOT NULL OR tag.name = 'audio')"
    license_tag = "if(tag.license IS NOT NULL, string(tag.place), substring_index(state.here, ',', 1))"
    audio_link = "substring_index(state.here, ',', -1)"
    audio_link = f"if({audio_link} = '' AND tag.name = 'audio', string(state.seen), {audio_link})"

    def after(open_text: str, here: str = "state.here", seen: str = "state.seen", found: str = "state.found") -> str:
        return _struct(open=open_text, here=here, seen=seen, found=found, used="state.used + 1", stopped="false")

    def marked(says: str) -> str:
        entry = f"concat({_delimited('tag.name')}, if({brings}, concat({says}, '{_MARK}'), ''))"
        return after(
            f"if({pushes}, concat(state.open, {entry}), state.open)",
            f"if({brings}, {says}, state.here)",
            f"if({links}, state.seen + 1, state.seen)",
            f"if({links}, concat(state.found, {says}, ';'), state.found)",
        )

    plain = after(f"if({pushes}, concat(state.open, {_delimited('tag.name')}), state.open)")
    opened = f"if(NOT {links} AND tag.license IS NULL, {plain}, {bind(f"concat({license_tag}, ',', {audio_link})", marked)})"
    closed = bind(
        _before_last("state.open", _delimited("tag.name")), lambda left: after(left, _last_mark(left, "whole.base"))
    )
    stopped = _struct(
        open="state.open", here="state.here", seen="state.seen", found="state.found", used="state.used", stopped="true"
    )
    return f"""CASE WHEN state.stopped THEN state
        WHEN NOT tag.closes THEN {opened}
        WHEN contains(state.open, {_delimited("tag.name")}) THEN {closed}
        WHEN contains(whole.known, {_delimited("tag.name")}) THEN {stopped}
        ELSE {after("state.open")} END"""


def _piece_step(tags: str) -> str:
    """The outer fold's step: the state after the next few tags."""

    def after(it: str, read: str = "0", **changed: str) -> str:
        fields = {"open": f"{it}.open", "here": f"{it}.here"} | {c: f"whole.{c}" for c in ("base", "known", "aside")} | changed
        found = f"concat(whole.found, array({it}.found))"
        return _struct(**fields, seen=f"{it}.seen", at=f"whole.at + {it}.used + {read}", found=found)

    def put_aside(it: str) -> str:
        new = f"filter({_names(f'{it}.open')}, name -> NOT contains(whole.known, {_delimited('name')}))"
        return after(
            it,
            open="''",
            base=f"{it}.here",
            known=f"concat(whole.known, array_join(transform({new}, name -> {_delimited('name')}), ''))",
            aside=f"concat(whole.aside, array({_struct(open=f'{it}.open', base='whole.base')}))",
        )

    def closed_aside(it: str) -> str:
        name = _delimited(f"get({tags}, whole.at + {it}.used).name")
        nearest = f"int(array_position(transform(reverse(whole.aside), text -> contains(text.open, {name})), true))"

        def state(at: str) -> str:
            source, rest = f"element_at(whole.aside, {at})", f"slice(whole.aside, 1, {at} - 1)"
            names = f"array_distinct(flatten(transform({rest}, text -> {_names('text.open')})))"
            known = f"array_join(transform({names}, name -> {_delimited('name')}), '')"
            return bind(
                _before_last(f"{source}.open", name),
                lambda left: after(
                    it, "1", open=left, here=_last_mark(left, f"{source}.base"), base=f"{source}.base", known=known, aside=rest
                ),
            )

        return bind(f"size(whole.aside) + 1 - {nearest}", state)

    def gathered(it: str) -> str:
        return f"""CASE WHEN {it}.stopped THEN {closed_aside(it)}
            WHEN length({it}.open) > {_OPEN_LENGTH} THEN {put_aside(it)} ELSE {after(it)} END"""

    start = _struct(open="whole.open", here="whole.here", seen="whole.seen", found="''", used="0", stopped="false")
    some = f"aggregate(slice({tags}, whole.at + 1, {_TAGS_PER_FOLD}), {start}, (state, tag) -> {_tag_step()})"
    return bind(some, gathered)


def _ancestry(markup: str) -> str:
    """For each linking tag in order: the license it inherits and the outermost audio tag around it.

    A fold over the tags with the open elements as state. Their names are one text; an element that brings a license or
    is audio has a mark behind its name: the place of the tag that gives the license, and the number of the audio
    tag. A closing tag closes everything up to the nearest open tag of its name; without one it is ignored.

    The work is in proportion to the tags. Spark copies a fold's state at each step, so the inner fold, over a few tags,
    has a small one: the text of the latest open elements. The outer one keeps the results and the texts put ``aside``
    when they grow long, with the names in them (``known``) and what their last mark says (``base``). A tag that
    closes something put aside stops the inner fold; it closes all that is looked through. That happens once at most
    for each text put aside, which bounds the steps.
    """
    own_license = attribute_sql(tag_attributes_sql("pair.tag"), "license", "data-license", "data-licence")
    tags, names = (f"regexp_extract_all({markup}, {literal(_NESTING_TAG)}, {group})" for group in (0, 1))
    read = f"""named_struct(
        'place', place,
        'name', lower(pair.name),
        'closes', startswith(pair.tag, '</'),
        'alone', endswith(pair.tag, '/>'),
        'license', if(pair.tag RLIKE '(?i)licen' AND NOT startswith(pair.tag, '</'), {own_license}, NULL))"""
    pairs = f"zip_with({tags}, {names}, (tag, name) -> named_struct('tag', tag, 'name', name))"
    events = f"transform({pairs}, (pair, place) -> {read})"
    start = """from_json('{"open":"","here":",","base":",","known":"","aside":[],"seen":0,"at":0,"found":[]}',
        'open string, here string, base string, known string, aside array<struct<open:string,base:string>>,
         seen int, at int, found array<string>')"""

    def folded(it: str) -> str:
        steps = f"sequence(0, 2 * (size({it}) div {_TAGS_PER_FOLD} + 1))"
        tag = f"get({it}, int(nullif(substring_index(says, ',', 1), '')))"
        says = f"named_struct('license', {tag}.license, 'audio', int(nullif(substring_index(says, ',', -1), '')))"
        found = "filter(split(array_join(whole.found, ''), ';'), says -> says <> '')"
        return f"aggregate({steps}, {start}, (whole, step) -> {_piece_step(it)}, whole -> transform({found}, says -> {says}))"

    return bind(events, folded)


def _read_tags(tags: str, url: str) -> str:
    """The attributes that matter of each linking tag; they are read only where audio is possible."""
    disguised = f"t.tag RLIKE {literal(r'[&\t\r\n]')}"
    possible = f"({is_page_audio_url_sql(url)} OR {mentions_audio_sql('t.tag')} OR {disguised})"
    fields = f"""named_struct(
        'place', place,
        'name', {tag_name_sql('t.tag')},
        'href', {attribute_sql('$it', 'href')},
        'src', {attribute_sql('$it', 'src')},
        'label', {attribute_sql('$it', 'title')},
        'before', t.before,
        'after', t.after)"""
    read = let(f"if({possible}, {tag_attributes_sql('t.tag')}, NULL)", fields)
    return f"transform({tags}, (t, place) -> {read})"


_LINK_FIELDS = ("pass", "first", "second", "rank", "license", "label", "before", "after", "audio_before", "audio_after")


def _references(tags: str, ancestry: str) -> str:
    """Every reference of the linking tags, with ``pass, first, second, rank``: the order of counting.

    Audio tags with the sources inside them come first, then all other linking tags, ``href`` before
    ``src``. A source inside an audio tag therefore counts in both passes.
    """
    inherited = f"get({ancestry}, tag.place)"
    outer = f"{inherited}.audio"

    def entry(link_pass: int, first: str, rank: int, ref: str, audio: str | None = None) -> str:
        around = (f"{audio}.before", f"{audio}.after") if audio else ("string(NULL)", "string(NULL)")
        return f"""named_struct(
            'ref', {ref}, 'pass', {link_pass}, 'first', {first}, 'second', tag.place, 'rank', {rank},
            'license', coalesce({inherited}.license, ''), 'label', tag.label,
            'before', tag.before, 'after', tag.after, 'audio_before', {around[0]}, 'audio_after', {around[1]})"""

    return f"""flatten(transform({tags}, tag -> array_compact(array(
        if(tag.name = 'audio' AND tag.src <> '', {entry(1, 'tag.place', 0, 'tag.src')}, NULL),
        if(tag.name = 'source' AND tag.src <> '' AND {outer} IS NOT NULL,
            {entry(1, outer, 0, 'tag.src', f'get({tags}, {outer})')}, NULL),
        if(tag.name <> 'audio' AND tag.href IS NOT NULL, {entry(2, 'tag.place', 0, 'tag.href')}, NULL),
        if(tag.name <> 'audio' AND tag.src IS NOT NULL, {entry(2, 'tag.place', 1, 'tag.src')}, NULL)))))"""


def may_hold_audio(html: str = "html", url: str = "url") -> Column:
    """Whether a page can have audio links at all; never false for one that has.

    True for a page that names an audio extension, for one whose own URL is audio (an empty reference
    then points to it), and for one that writes an extension with character references or line breaks.
    """
    disguised = f"{html} RLIKE '&(?:#|period;|Tab;|NewLine;)' AND {html} RLIKE {literal(_DISGUISED_EXTENSION)}"
    plain = f"{html} RLIKE {literal(_BROKEN_EXTENSION)}"
    return F.expr(f"{plain} OR {is_page_audio_url_sql(url)} OR ({disguised})")


def link_candidates(pages: DataFrame, url: str = "url", keep: list[str] | None = None) -> DataFrame:
    """All audio links of each page, repeated ones too, with their place in the order of counting.

    Columns: ``keep`` (default: all but the HTML), ``audio_url, description, license, pass, first,
    second, rank``.
    """
    return _link_rows(pages, url, keep, firsts_only=False)


def extract_audio_links(pages: DataFrame, url: str = "url", keep: list[str] | None = None) -> DataFrame:
    """The audio links of each page, the first one of each URL; columns as :func:`link_candidates`.

    Repeats are dropped inside the page's row by sorting its links, so this needs no shuffle either.
    """
    return _link_rows(pages, url, keep, firsts_only=True)


def _link_rows(pages: DataFrame, url: str, keep: list[str] | None, firsts_only: bool) -> DataFrame:
    kept = [f"`{c}`" for c in (keep if keep is not None else [c for c in pages.columns if c != "html"])]
    cut = (
        pages.withColumn("__url", or_empty(F.col(url)))
        .filter(may_hold_audio("html", "__url"))
        .selectExpr(*kept, "__url", f"{split_url_sql('__url')} AS __base", f"{_visible_markup('html')} AS __markup")
        .selectExpr(*kept, "__url", "__base", "__markup", f"{_segments('__markup')} AS __segments")
    )
    needs_ancestry = f"__markup RLIKE {literal(r'(?i)licen|<source[ \t\r\n/>]')}"
    read = cut.selectExpr(
        *kept,
        "__url",
        "__base",
        f"if({needs_ancestry}, {_ancestry('__markup')}, NULL) AS __ancestry",
        f"{_read_tags(_linking_tags('__segments'), '__url')} AS __tags",
    )
    rest = ", ".join(f"'{name}', link.{name}" for name in _LINK_FIELDS)
    links = f"""filter(
        transform({_references('__tags', '__ancestry')}, link -> named_struct(
            'audio_url', {resolve_url_sql('__url', 'link.ref', '__base')}, {rest})),
        link -> coalesce({is_page_audio_url_sql('link.audio_url')}, false))"""
    found = read.selectExpr(*kept, f"{f'sort_array({links})' if firsts_only else links} AS __links")
    if firsts_only:
        repeats = "i > 0 AND get(__links, i - 1).audio_url = link.audio_url"
        found = found.selectExpr(*kept, f"filter(__links, (link, i) -> NOT ({repeats})) AS __links")
    texts = (
        "l.label",
        _surroundings("l.before", "l.after"),
        _surroundings("l.audio_before", "l.audio_after"),
    )
    description = ", ".join(let(text, "if($it <> '', $it, NULL)") for text in texts)
    # explode_outer plus a filter: for explode Spark would infer a size test on the array and work the
    # whole array out a second time.
    return (
        found.selectExpr(*kept, "explode_outer(__links) AS l")
        .filter("l IS NOT NULL")
        .selectExpr(
            *kept,
            "l.audio_url",
            f"coalesce({description}, '') AS description",
            "l.license",
            "l.pass",
            "l.first",
            "l.second",
            "l.rank",
        )
    )
