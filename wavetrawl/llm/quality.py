"""Document quality: shape features of the whole text, scored by the additive model of :mod:`gam`."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wavetrawl.llm import gam
from wavetrawl.llm.common import ID, TEXT, fold, id_and_text, materialise, quoted

# Sample bound of the fit: labelled rows, taken in the order of their ids' hash.
MAX_TRAINING_ROWS = 20_000

FEATURES = (
    "log_words", "word_length", "upper", "symbols", "exclamations", "bars", "stops", "commas", "digits", "beyond_ascii",
    "line_words", "repeated_lines", "repeated_words", "repeated_triples", "top_word", "sentence_words",
)

_UPPER = bytes(range(65, 91))
_DIGITS = b"0123456789"
_SYMBOLS = b"#*$%&|<>"
_ASCII = bytes(range(128))


def features_of(text: str | None) -> list[float]:
    """The features in the order of ``FEATURES``; all zero for a null or empty text."""
    raw = (text or "").encode("utf-8", "replace")
    words = raw.split()
    n, size = len(words), max(len(raw), 1)
    if not n:
        return [0.0] * len(FEATURES)

    def share(marks: bytes) -> float:
        return (len(raw) - len(raw.translate(None, marks))) / size

    lines = [line for line in raw.split(b"\n") if line.strip()]
    lower = raw.lower().split()
    counts = Counter(lower)
    triples = max(n - 2, 1)
    distinct_triples = len(set(zip(lower, lower[1:], lower[2:]))) if n > 2 else 1
    return [
        float(np.log1p(n)),
        sum(map(len, words)) / n,
        share(_UPPER),
        share(_SYMBOLS),
        raw.count(b"!") / size,
        raw.count(b"|") / size,
        raw.count(b".") / n,
        raw.count(b",") / n,
        share(_DIGITS),
        len(raw.translate(None, _ASCII)) / size,
        n / len(lines),
        1 - len(set(lines)) / len(lines),
        1 - len(counts) / n,
        1 - distinct_triples / triples,
        max(counts.values()) / n,
        n / (1 + raw.count(b".")),
    ]


def _features(text: Column) -> Column:
    @F.pandas_udf("array<double>")
    def features(texts: pd.Series) -> pd.Series:
        return pd.Series([features_of(text) for text in texts], dtype=object)

    return features(text)


def scorer(model: gam.AdditiveModel):
    """A column function from the features array to the probability of label 1."""

    @F.pandas_udf("double")
    def probability(features: pd.Series) -> pd.Series:
        if not len(features):
            return pd.Series([], dtype="float64")
        return pd.Series(model.probability(np.stack(features.to_numpy())))

    return probability


def with_features(docs: DataFrame, text_col: str = "text", out: str = "features") -> DataFrame:
    return docs.withColumn(out, _features(quoted(text_col)))


def fit_quality(
    featured: DataFrame, labels: DataFrame, label: str = "quality", folds: int = 3, held_out: int = 1,
    max_rows: int = MAX_TRAINING_ROWS,
) -> gam.AdditiveModel:
    """Fit on at most ``max_rows`` labelled documents outside the held-out fold.

    ``featured`` has the id as ``ID`` and ``features``. Null ids and null labels are left out. Only the sample
    reaches the driver: a few megabytes, whatever the corpus.
    """
    marks = labels.select(F.col("doc_id").alias(ID), F.col(label).cast("double").alias("label")).dropna()
    marks = marks.filter(fold(F.col(ID), folds) != held_out)
    order = [F.xxhash64(ID), F.col(ID), F.col("label"), F.hash("features")]
    rows = featured.join(marks, ID).orderBy(*order).limit(max_rows).select("features", "label").toPandas()
    x = np.stack(rows["features"].to_numpy()) if len(rows) else np.zeros((0, len(FEATURES)))
    return gam.fit(x, rows["label"].to_numpy(dtype=float))


def score_quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Columns ``doc_id, held_out, score, predicted``, one row per input row, repeated rows included.

    The text is read once: features are written and both the fit and the scores take them from there. Empty and
    null texts have all features zero and a score like any other. Without labels the score is one half.
    """
    rows = with_features(id_and_text(docs), TEXT).select(ID, "features")
    featured = materialise(rows, "quality-features")
    score = scorer(fit_quality(featured, labels))
    scored = featured.select(F.col(ID).alias("doc_id"), (fold(F.col(ID), 3) == 1).alias("held_out"), score("features").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The documents whose score reaches ``threshold``, with their own columns.

    The features of all documents are worked out for the fit, those of the kept ones in the same pass as the
    filter: documents are not moved.
    """
    featured = materialise(with_features(id_and_text(docs), TEXT).select(ID, "features"), "quality-features")
    model = fit_quality(featured, labels)
    score = scorer(model)(_features(quoted("text")))
    return docs.filter(score >= threshold)
