"""Language expressions: tag folding, script shares, stop-word votes, the page ``lang`` attribute."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from wavetrawl.functions.sql_text import let, literal

# Frequent function words that tell the languages apart.
STOP_WORDS = {
    "de": ["der", "die", "das", "und", "ist", "nicht", "ein", "eine", "mit", "von", "sich", "auf", "für", "den", "zu"],
    "en": ["the", "of", "and", "to", "in", "is", "that", "for", "it", "was", "with", "as", "this", "by", "are"],
    "es": ["el", "los", "las", "una", "que", "por", "para", "con", "del", "se", "como", "más", "pero", "no", "y"],
    "fr": ["le", "les", "des", "et", "est", "une", "dans", "pour", "pas", "qui", "sur", "au", "du", "un", "ce"],
}

# The tags under which Japanese audio is listed.
JAPANESE_TAGS = ("ja", "ja_JP", "ja-jp", "ja-JP")


def base_language(tag: Column) -> Column:
    """A language tag without region and in lower case: ``ja_JP`` and ``JA-jp`` give ``ja``."""
    return F.lower(F.substring_index(F.translate(tag, "_", "-"), "-", 1))


def has_lang_attribute(html: Column, language: str) -> Column:
    """Whether an ``html`` tag names the language: "lang=" with a value that starts with it, quoted or not.

    So ``xml:lang`` counts as well, and "ja" finds "ja-JP". Letter case does not matter, blanks around "=" are not read.
    """
    tags = F.regexp_extract_all(html, F.lit("(?i)<html[^>]*"), F.lit(0))
    values = F.flatten(F.transform(tags, lambda tag: F.slice(F.split(F.lower(tag), "lang="), 2, 1 << 30)))
    starts = [mark + language.lower() for mark in ("", '"', "'")]
    return F.exists(values, lambda value: reduce(or_, [value.startswith(start) for start in starts]))


_KANA = "ぁ-ゖァ-ヺ"


def is_japanese(text: Column, min_kana: float = 0.1) -> Column:
    """Whether at least this share of the letters is kana, which Japanese prose always mixes in.

    Texts without any kana, most of a crawl, are settled by the first test.
    """
    kana = F.length(F.regexp_replace(text, f"[^{_KANA}]+", ""))
    letters = F.length(F.regexp_replace(text, r"\P{L}+", ""))
    enough = F.when(text.rlike(f"[{_KANA}]"), kana >= letters * F.lit(min_kana))
    return F.coalesce(enough, F.lit(False))


def language_of(text: str, stop_words: dict[str, list[str]] | None = None) -> Column:
    """``ja`` by script, else the language with most stop words (ties to the first name), else NULL."""
    table = sorted((stop_words or STOP_WORDS).items())

    def listed(entries: list[str]) -> str:
        return ", ".join(map(literal, entries))

    every = sorted({word for _, words in table for word in words})
    known = f"filter(split(lower({text}), {literal(r'[^\p{L}]+')}), w -> w IN ({listed(every)}))"
    votes = [
        f"named_struct('votes', size(filter($it, w -> w IN ({listed(words)}))), 'order', {-i}, 'language', '{name}')"
        for i, (name, words) in enumerate(table)
    ]
    best = let(let(known, f"array_max(array({', '.join(votes)}))"), "if($it.votes > 0, $it.language, NULL)")
    return F.when(is_japanese(F.expr(text)), F.lit("ja")).otherwise(F.expr(best))
