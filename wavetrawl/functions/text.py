"""Text expressions: trimming, character references, tags and their attributes."""

from __future__ import annotations

from html.entities import html5, name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

from wavetrawl.functions.sql_text import let, literal

# The characters that count as white space when a text is trimmed: all Unicode white space.
WHITE_SPACE = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())

# A tag from "<" and its first letter on. A value in quotes may hold ">"; a quote that is not closed, or that does not
# follow "=", is a character like any other. All repeats are possessive, so a tag of any length is read in one go.
TAG = r"""</?[a-zA-Z](?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+>"""

# A page cut into tokens: script and style whole, comments, tags, declarations, runs of text, a lone "<".
TOKEN = rf"(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->|{TAG}|<[!?][^>]*>|[^<]+|<"

# A value in quotes with "<" or ">" in it, or anything that may look like one from the outside.
_QUOTED_BRACKET = r"""=\s*+(?:"[^"<>]*+[<>]|'[^'<>]*+[<>])"""
_TAG_START = "^</?[a-zA-Z]"
_WHOLE_ELEMENT = r"(?is)^<(?:script\b.*</script\s*>|style\b.*</style\s*>)$"

# Named references as "&name;<US>character<RS>...": one literal that Spark folds into a map once. All names of the
# standard library's table, with and without semicolon as the standard has them. A map is searched from its start, so
# the names in common use come first.
_COMMON = ("amp", "nbsp", "quot", "lt", "gt", "apos")
_ORDERED = sorted(html5, key=lambda n: (n.rstrip(";") not in _COMMON, n.rstrip(";") not in name2codepoint, n))
_NAMED = "\x1e".join(f"&{name}\x1f{html5[name]}" for name in _ORDERED)

# Numeric references 128 to 159 stand for windows-1252 characters.
_C1_CHARACTERS = "".join(bytes([b]).decode("cp1252", "ignore") or chr(b) for b in range(0x80, 0xA0))

# One attribute of a tag: its name, then an optional value in either kind of quotes or bare.
_ATTRIBUTE = r"""([^\s/>=]+)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s>]*))?"""
_QUOTED = r"""^(["'])(?s)(.*)\1$"""
_TAG_NAME = r"^</?([a-zA-Z][^\s/>]*)"
_TAG_FRAME = r"^<[a-zA-Z][^\s/>]*|/?>$"


def trim(text: Column) -> Column:
    """Cut white space of any kind from both ends."""
    return F.btrim(text, F.lit(WHITE_SPACE))


def trim_sql(text: str) -> str:
    return f"btrim({text}, {literal(WHITE_SPACE)})"


def squeeze(text: Column) -> Column:
    """Trim, and turn each inner run of white space into one space."""
    return trim(F.regexp_replace(text, f"[{WHITE_SPACE}]+", " "))


def or_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def is_truthy(text: Column) -> Column:
    """True for a text that is neither NULL nor empty; never NULL itself."""
    return or_empty(text) != ""


def header_text(raw: Column) -> Column:
    """Header bytes as text; bytes that are not UTF-8 become U+FFFD."""
    return or_empty(F.make_valid_utf8(raw.cast("string")))


def _code_point_text(number: str) -> str:
    return f"""CASE
        WHEN {number} BETWEEN 128 AND 159 THEN substring({literal(_C1_CHARACTERS)}, int({number}) - 127, 1)
        WHEN {number} BETWEEN 1 AND 55295 OR {number} BETWEEN 57344 AND 1114111
            THEN decode(unhex(lpad(hex({number}), 8, '0')), 'UTF-32')
        ELSE '�' END"""


def decode_references_sql(text: str, loose: bool = False) -> str:
    """SQL for ``text`` with named and numeric character references replaced by what they stand for.

    ``loose`` also accepts references without a closing semicolon, as is right in text but not in URLs: numeric ones,
    and the old names that may lack it.
    """
    pieces = f"regexp_extract_all({text}, '&#?[0-9a-zA-Z]+;?|[^&]+|&', 0)"
    hexadecimal = let("bigint(conv(regexp_extract(piece, '([0-9a-fA-F]{1,6});?$', 1), 16, 10))", _code_point_text("$it"))
    decimal = let("bigint(regexp_extract(piece, '([0-9]{1,7});?$', 1))", _code_point_text("$it"))
    separators = f"{literal(chr(0x1E))}, {literal(chr(0x1F))}"
    named = f"try_element_at(str_to_map({literal(_NAMED)}, {separators}), piece)"
    untouched = "NOT startswith(piece, '&')" + ("" if loose else " OR NOT endswith(piece, ';')")
    return f"""CASE WHEN contains({text}, '&') THEN array_join(transform({pieces}, piece -> CASE
        WHEN {untouched} THEN piece
        WHEN piece RLIKE '^&#[xX]0*[0-9a-fA-F]{{1,6}};?$' THEN {hexadecimal}
        WHEN piece RLIKE '^&#0*[0-9]{{1,7}};?$' THEN {decimal}
        WHEN piece RLIKE '^&#([xX][0-9a-fA-F]+|[0-9]+);?$' THEN '�'
        ELSE coalesce({named}, piece) END), '') ELSE {text} END"""


def decode_references(text: str, loose: bool = False) -> Column:
    """A text column (or SQL expression) with its character references decoded."""
    return F.expr(decode_references_sql(text, loose))


def with_plain_tags_sql(html: str) -> str:
    """SQL for a page whose tags hold no "<" or ">" but their own: those in attribute values become references.

    Reading the attributes decodes them again, and "<[^>]*>" is a whole tag. Pages without such a value, nearly all,
    are only searched for one.
    """
    inside = "replace(replace(substring(token, 2, length(token) - 2), '<', '&lt;'), '>', '&gt;')"
    plain = f"""array_join(transform(regexp_extract_all({html}, {literal(TOKEN)}, 0), token ->
        if(token RLIKE '{_TAG_START}' AND NOT token RLIKE {literal(_WHOLE_ELEMENT)}, concat('<', {inside}, '>'), token)), '')"""
    return f"if({html} RLIKE {literal(_QUOTED_BRACKET)}, {plain}, {html})"


def tag_name_sql(tag: str) -> str:
    return f"lower(regexp_extract({tag}, {literal(_TAG_NAME)}, 1))"


def tag_attributes_sql(tag: str) -> str:
    """SQL for the attributes of an opening tag: ``array<struct<name, value>>``, in order, values still raw."""
    attribute = literal(_ATTRIBUTE)
    pairs = f"""zip_with(
        regexp_extract_all($it, {attribute}, 1), regexp_extract_all($it, {attribute}, 2),
        (name, value) -> named_struct(
            'name', lower(name), 'value', regexp_replace(value, {literal(_QUOTED)}, '$2')))"""
    return let(f"regexp_replace({tag}, {literal(_TAG_FRAME)}, '')", pairs)


def attribute_sql(attributes: str, *names: str) -> str:
    """SQL for the decoded value of an attribute, NULL where the tag lacks it.

    Of a repeated attribute the last one counts. Of several names the first one that is there counts,
    even with an empty value.
    """
    found = [f"try_element_at(filter({attributes}, a -> a.name = '{name}'), -1).value" for name in names]
    return let(f"coalesce({', '.join(found)})", decode_references_sql("$it"))
