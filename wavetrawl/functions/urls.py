"""URL expressions: splitting, joining, validity, audio tests, host and format.

Functions named ``*_sql`` build SQL text out of SQL text, so that they can be used inside lambdas; the
others return columns.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wavetrawl.functions.sql_text import let, literal

# The file extensions that mark an audio link.
AUDIO_EXTENSIONS = ("mp3", "wav", "ogg", "flac", "m4a", "aac")

_EXTENSION = rf"\.({'|'.join(AUDIO_EXTENSIONS)})"
_SCHEME = r"^([a-zA-Z][a-zA-Z0-9+.\-]*):"
_PATH = r"^(?:[a-zA-Z][a-zA-Z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)"
_BRACKETED_HOST = (
    r"^([^\[\]]*@)?\[(v[0-9a-fA-F]+\.[^\[\]]+|[0-9a-fA-F:.]*:[0-9a-fA-F:.]*(%[^\[\]]*)?)\](:[0-9]*)?$"
)
_TAIL = r"(?d)[?#].*$"


def split_url_sql(url: str) -> str:
    """SQL for a URL as ``struct<scheme, netloc, path, query, fragment>``; absent parts are empty."""
    trimmed = f"regexp_replace({url}, {literal(r'^[\x00-\x20]+')}, '')"
    cleaned = f"regexp_replace({trimmed}, {literal(r'[\t\r\n]')}, '')"
    scheme_and_rest = f"""named_struct(
        'scheme', lower(regexp_extract($it, {literal(_SCHEME)}, 1)),
        'rest', regexp_replace($it, {literal(_SCHEME)}, ''))"""
    parts = f"""named_struct(
        'scheme', $it.scheme,
        'netloc', regexp_extract($it.rest, '^//([^/?#]*)', 1),
        'path', regexp_extract($it.rest, '^(?://[^/?#]*)?([^?#]*)', 1),
        'query', regexp_extract($it.rest, {literal(r'^[^?#]*[?]([^#]*)')}, 1),
        'fragment', regexp_extract($it.rest, '(?s)^[^#]*#(.*)$', 1))"""
    return let(let(cleaned, scheme_and_rest), parts)


def _host_is_sound(netloc: str) -> str:
    return f"({netloc} NOT RLIKE {literal(r'[\[\]]')} OR {netloc} RLIKE {literal(_BRACKETED_HOST)})"


def is_valid_url_sql(url: str) -> str:
    filled = f"NOT ($it.scheme = '' AND $it.netloc = '' AND $it.path = '') AND {_host_is_sound('$it.netloc')}"
    return f"coalesce({let(split_url_sql(url), filled)}, false)"


def is_valid_url(url: str) -> Column:
    """False for a URL without scheme, host and path, and for one with broken brackets in the host."""
    return F.expr(is_valid_url_sql(url))


def _unsplit(scheme: str, netloc: str, path: str, query: str, fragment: str) -> str:
    return f"""concat(
        if({scheme} <> '', concat({scheme}, ':'), ''),
        if({netloc} <> '', concat('//', {netloc}), ''),
        if({netloc} <> '' AND {path} <> '' AND NOT startswith({path}, '/'), concat('/', {path}), {path}),
        if({query} <> '', concat('?', {query}), ''),
        if({fragment} <> '', concat('#', {fragment}), ''))"""


def _merged_path(base_path: str, ref_path: str) -> str:
    """SQL for a path seen from another one, dot segments removed."""
    directory = let(f"split({base_path}, '/')", "if(element_at($it, -1) <> '', slice($it, 1, size($it) - 1), $it)")
    below = let(
        f"concat({directory}, split({ref_path}, '/'))",
        "filter($it, (s, i) -> i = 0 OR i = size($it) - 1 OR s <> '')",
    )
    without_dots = """aggregate($it, cast(array() AS array<string>), (kept, s) -> CASE
        WHEN s = '.' OR (s = '..' AND size(kept) = 0) THEN kept
        WHEN s = '..' THEN slice(kept, 1, size(kept) - 1)
        ELSE concat(kept, array(s)) END)"""
    closed = f"concat({without_dots}, if(element_at($it, -1) IN ('.', '..'), array(''), array()))"
    segments = f"if(startswith({ref_path}, '/'), split({ref_path}, '/'), {below})"
    return f"coalesce(nullif(array_join({let(segments, closed)}, '/'), ''), '/')"


def join_url_sql(base: str, ref: str, base_parts: str | None = None) -> str:
    """SQL for ``ref`` seen from ``base``, by the rules browsers and crawlers use for links.

    ``base_parts`` may name the base already split, where many references share it.

    A reference with its own host keeps its dot segments; empty inner segments vanish only from joined
    relative paths; surplus ``..`` is ignored. NULL where either side has a broken host.
    """
    parts = let(
        f"named_struct('b', {base_parts or split_url_sql(base)}, 'r', {split_url_sql(ref)})",
        """named_struct(
            'scheme', coalesce(nullif($it.r.scheme, ''), $it.b.scheme),
            'b', $it.b,
            'r', $it.r,
            'kind', CASE WHEN $it.r.netloc <> '' THEN 'host' WHEN $it.r.path = '' THEN 'same' ELSE 'below' END)""",
    )
    target = f"""named_struct(
        'scheme', $it.scheme,
        'netloc', if($it.kind = 'host', $it.r.netloc, $it.b.netloc),
        'path', CASE $it.kind WHEN 'host' THEN $it.r.path WHEN 'same' THEN $it.b.path
            ELSE {_merged_path('$it.b.path', '$it.r.path')} END,
        'query', if($it.kind = 'same' AND $it.r.query = '', $it.b.query, $it.r.query),
        'fragment', $it.r.fragment)"""
    written = _unsplit("$it.scheme", "$it.netloc", "$it.path", "$it.query", "$it.fragment")
    choice = f"""CASE
        WHEN NOT ({_host_is_sound('$it.b.netloc')} AND {_host_is_sound('$it.r.netloc')}) THEN NULL
        WHEN $it.scheme <> $it.b.scheme OR $it.scheme NOT IN ('http', 'https', 'ftp', 'file', '') THEN {ref}
        ELSE {let(target, written)} END"""
    return f"CASE WHEN coalesce({base}, '') = '' THEN {ref} WHEN {ref} = '' THEN {base} ELSE {let(parts, choice)} END"


def join_url(base: str, ref: str) -> Column:
    """Two columns (or SQL expressions) joined as by :func:`join_url_sql`."""
    return F.expr(join_url_sql(base, ref))


def resolve_url_sql(base: str, ref: str, base_parts: str | None = None) -> str:
    absolute = f"(startswith({ref}, 'http://') OR startswith({ref}, 'https://'))"
    candidate = f"CASE WHEN {absolute} THEN {ref} ELSE {join_url_sql(base, ref, base_parts)} END"
    return let(candidate, f"CASE WHEN {is_valid_url_sql('$it')} THEN $it END")


def resolve_url(base: str, ref: str) -> Column:
    """A link as found in a page, made absolute; NULL where the result is no usable URL."""
    return F.expr(resolve_url_sql(base, ref))


def is_page_audio_url_sql(url: str) -> str:
    return f"regexp_replace(lower({url}), {literal(_TAIL)}, '') RLIKE {literal(_EXTENSION + r'\z')}"


def is_page_audio_url(url: str) -> Column:
    """Audio test for links found in pages: letter case, query string and fragment do not matter."""
    return F.expr(is_page_audio_url_sql(url))


def is_feed_audio_url(url: Column) -> Column:
    """Audio test for links found in feeds: lower case only, and the URL must end there."""
    return url.rlike(f"(?d){_EXTENSION}$")


def mentions_audio_sql(text: str) -> str:
    """Cheap test for a text that holds an audio extension in any letter case."""
    return f"{text} RLIKE {literal('(?i)' + _EXTENSION)}"


_HOST = r"^\s*(?:(?:[a-zA-Z][a-zA-Z0-9+.\-]*:)?//)?(?:[^/?#]*@)?(\[[^\]]*\]|[^/?#:]*)"


def url_host(url: Column) -> Column:
    """Host of a URL, also of one without scheme; no user, port or trailing dots."""
    return F.rtrim(F.regexp_extract(url, _HOST, 1), F.lit(" .\u3002\uff0e\uff61"))


# Marks in the content type, then path suffixes, that tell an audio item's format.
FORMAT_BY_TYPE = (
    ("audio/mpeg", "mp3"),
    ("audio/mp3", "mp3"),
    ("audio/wav", "wav"),
    ("audio/wave", "wav"),
    ("audio/flac", "flac"),
    ("audio/ogg", "ogg"),
)
FORMAT_BY_SUFFIX = ("mp3", "wav", "flac", "ogg", "m4a")


def audio_format(content_type: Column, url: Column) -> Column:
    """Container format of an audio item: by content type, else by URL path, else mp3."""
    kind = F.coalesce(content_type, F.lit(""))
    path = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), _PATH, 1))
    by_type = F.coalesce(*[F.when(kind.contains(mark), F.lit(name)) for mark, name in FORMAT_BY_TYPE])
    suffix = F.regexp_extract(path, rf"\.({'|'.join(FORMAT_BY_SUFFIX)})\z", 1)
    return F.coalesce(by_type, F.when(suffix != "", suffix), F.lit("mp3"))
