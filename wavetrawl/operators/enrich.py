"""Main text, title, language and quality of pages."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, HashingTF, Normalizer, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wavetrawl.functions.language import language_of
from wavetrawl.functions.sql_text import let, literal
from wavetrawl.functions.text import (
    WHITE_SPACE,
    attribute_sql,
    decode_references_sql,
    tag_attributes_sql,
    trim_sql,
    with_plain_tags_sql,
)
from wavetrawl.operators.columns import with_once
from wavetrawl.operators.ordering import materialise
from wavetrawl.operators.skew import drop_frequent
from wavetrawl.session import scratch_path

# Elements whose content is never main text, and elements that start a new block.
BOILERPLATE_TAGS = ("script", "style", "nav", "footer", "aside", "table", "noscript", "form")
BLOCK_TAGS = (
    "address", "article", "blockquote", "body", "br", "dd", "div", "dl", "dt", "figcaption", "figure",
    "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hr", "html", "li", "main", "ol", "p", "pre",
    "section", "title", "ul",
)

# A block is long from this many letters on. A character of the scripts that write without spaces says as much as
# some three letters. A block ends as a sentence with one of these marks, also before closing quotes and brackets.
MIN_BLOCK_LENGTH = 25
WIDE_CHARACTERS, WIDE_FACTOR = "\u3040-\u30ff\u3400-\u9fff\uac00-\ud7af", 3
SENTENCE_END = r"""[.!?…。．！？][\])"'”’»」』）]*$"""
MAX_LINK_SHARE = 0.3
_BREAK = "\x01"


def _squeezed(text: str) -> str:
    return trim_sql(f"regexp_replace({text}, {literal(f'[{WHITE_SPACE}]+')}, ' ')")


def _plain(markup: str) -> str:
    return let(f"regexp_replace({markup}, '<[^>]*>', '')", _squeezed(decode_references_sql("$it", loose=True)))


def _blocks(html: str, min_length: int = MIN_BLOCK_LENGTH, max_link_share: float = MAX_LINK_SHARE) -> str:
    """SQL for the main-text blocks of a page, in order, each once: ``array<string>``.

    Boilerplate elements and the title go out; the rest is cut at block tags. No block may be mostly link text. One
    that is long or ends as a sentence counts; a short one counts between two that do.
    """
    html = with_plain_tags_sql(html)
    removed = "|".join(rf"<{tag}\b.*?</{tag}\s*>" for tag in (*BOILERPLATE_TAGS, "title"))
    kept = f"regexp_replace({html}, {literal(rf'(?is)<!--.*?-->|{removed}')}, '{_BREAK}')"
    cut = f"regexp_replace({kept}, {literal(rf'(?i)</?(?:{'|'.join(BLOCK_TAGS)})(?:[\s/][^>]*)?>')}, '{_BREAK}')"
    linked = f"array_join(regexp_extract_all(block, {literal(r'(?is)<a\b[^>]*>(.*?)</a\s*>')}, 1), '')"
    measured = f"""transform(split({cut}, '{_BREAK}'), block -> named_struct(
        'text', {_plain('block')},
        'linked', if(contains(block, '<'), length({_plain(linked)}), 0)))"""
    wide = f"length(regexp_replace(b.text, {literal(f'[^{WIDE_CHARACTERS}]+')}, ''))"
    long = f"length(b.text) + {WIDE_FACTOR - 1} * {wide} >= {min_length}"
    clean = f"b.linked <= length(b.text) * {max_link_share}D"
    judged = f"""transform(filter({measured}, b -> b.text <> ''), b -> named_struct(
        'text', b.text, 'clean', {clean}, 'counts', {clean} AND ({long} OR b.text RLIKE {literal(SENTENCE_END)})))"""
    between = "coalesce(get($it, i - 1).counts AND get($it, i + 1).counts, false)"
    good = let(judged, f"filter($it, (b, i) -> b.counts OR (b.clean AND {between}))")
    return f"array_distinct(transform({good}, b -> b.text))"


def text_blocks(
    pages: DataFrame, key: str = "page_id", min_length: int = MIN_BLOCK_LENGTH, max_link_share: float = MAX_LINK_SHARE
) -> DataFrame:
    """One row per main-text block: ``key, pos, block``."""
    blocks = f"posexplode_outer({_blocks('html', min_length, max_link_share)}) AS (pos, block)"
    return pages.selectExpr(key, blocks).filter("block IS NOT NULL")


def main_text(
    pages: DataFrame, out: str = "text", min_length: int = MIN_BLOCK_LENGTH, max_link_share: float = MAX_LINK_SHARE
) -> DataFrame:
    """Add the main text of each page, one block a line; empty if there is none. A map, no shuffle."""
    return with_once(pages, out, f"array_join({_blocks('html', min_length, max_link_share)}, '\\n')")


def drop_repeated_blocks(blocks: DataFrame, max_times: int = 2, place: tuple[str, ...] = ("page_id", "pos")) -> DataFrame:
    """Drop the blocks that occur more than ``max_times`` times in the whole corpus.

    ``place`` names a block. What is counted and told apart are hashes and places, which alone are written to scratch;
    the texts move once, to the places that stay.
    """
    hashed = materialise(blocks.select(*place, F.unhex(F.md5("block")).alias("block_hash")), "block-hashes")
    staying = drop_frequent(hashed, "block_hash", max_times).select(*place)
    return blocks.join(staying, list(place), "left_semi")


def titles(pages: DataFrame, out: str = "title") -> DataFrame:
    """Add a page's title: ``og:title``, else its only ``h1``, else ``title``; empty if it has none."""
    pages = pages.withColumn("__plain", F.expr(with_plain_tags_sql("html")))
    metas = f"regexp_extract_all(__plain, {literal(r'(?i)<meta\b[^>]*>')}, 0)"
    is_title = f"{attribute_sql(tag_attributes_sql('m'), 'property', 'name')} = 'og:title'"
    og = f"{attribute_sql(tag_attributes_sql(f'get(filter({metas}, m -> contains(m, {literal("og:title")}) AND {is_title}), 0)'), 'content')}"
    headings = f"regexp_extract_all(__plain, {literal(r'(?is)<h1\b[^>]*>(.*?)</h1\s*>')}, 1)"
    heading = let(headings, f"if(size($it) = 1, {_plain('$it[0]')}, NULL)")
    title = _plain(f"regexp_extract(__plain, {literal(r'(?is)<title\b[^>]*>(.*?)</title\s*>')}, 1)")
    choices = (f"if(contains(__plain, 'og:title'), {_squeezed(og)}, NULL)", heading, title)
    found = ", ".join(let(choice, "if($it <> '', $it, NULL)") for choice in choices)
    return with_once(pages, out, f"coalesce({found}, '')").drop("__plain")


def with_language(texts: DataFrame, text: str = "text", out: str = "detected") -> DataFrame:
    """Add the detected language of a text, NULL if none is recognised."""
    return with_once(texts, out, language_of(text))


# What counts as a word: characters of the scripts that write without spaces, else what stands between spaces, marks
# included, as they tell prose from junk.
_WORDS = rf"[{WIDE_CHARACTERS}]|[^{WIDE_CHARACTERS}\s]+"
_WORKING = ("__words", "__counts", "__rare", "__features", "__probability", "__raw", "__prediction")


def fit_quality_model(
    labelled: DataFrame, text: str = "text", label: str = "quality", path: str | None = None
) -> PipelineModel:
    """A text classifier whose score is the probability of class 1; both classes weigh the same in the fit.

    Words are weighted by rarity and texts scaled to one length, so that long texts do not decide. The model is written
    to ``path`` (default: the scratch area) and given as read from there, by :func:`load_quality_model` at any time
    again. A freshly fitted model must not be used to score: it carries its training summary and with that the session,
    which fails as soon as the session holds anything that cannot be sent to a task.
    """
    known = labelled.select(text, F.col(label).cast("double").alias(label)).filter(F.col(label).isNotNull())
    n, good = known.agg(F.count("*"), F.coalesce(F.sum(label), F.lit(0.0))).first()
    weight = F.when(F.col(label) == 1, n / (2 * max(good, 1))).otherwise(n / (2 * max(n - good, 1)))
    stages = [
        RegexTokenizer(inputCol=text, outputCol="__words", pattern=_WORDS, gaps=False, toLowercase=True),
        HashingTF(inputCol="__words", outputCol="__counts", numFeatures=1 << 14),
        IDF(inputCol="__counts", outputCol="__rare", minDocFreq=2),
        Normalizer(inputCol="__rare", outputCol="__features"),
        LogisticRegression(
            featuresCol="__features",
            labelCol=label,
            weightCol="__weight",
            regParam=0.01,
            maxIter=50,
            probabilityCol="__probability",
            rawPredictionCol="__raw",
            predictionCol="__prediction",
        ),
    ]
    path = path or scratch_path(labelled.sparkSession, "quality-model")
    Pipeline(stages=stages).fit(known.withColumn("__weight", weight)).write().overwrite().save(path)
    return load_quality_model(path)


def load_quality_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def with_quality(texts: DataFrame, model: PipelineModel, out: str = "quality") -> DataFrame:
    """Add the quality score, a probability."""
    scored = model.transform(texts)
    return scored.withColumn(out, vector_to_array("__probability")[1]).drop(*_WORKING)


def good_pages(pages: DataFrame, model: PipelineModel, language: str = "ja") -> DataFrame:
    """Pages with main text, a title and the wanted language, scored: ``title, url, quality, text, html``.

    Each filter stands before the next dearer step, and the model comes last.
    """
    with_text = main_text(pages).filter("text <> ''")
    titled = titles(with_text).filter("title <> ''")
    kept = with_language(titled).filter(F.col("detected") == language)
    return with_quality(kept, model).select(*[c for c in pages.columns if c not in ("url", "html")], "title", "url", "quality", "text", "html")
