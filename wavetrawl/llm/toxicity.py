"""Toxic passages as maximum-scoring segments of token log odds.

A token's score is its log odds between toxic and other documents under an informative Dirichlet prior (the
pooled rates), less a fixed price per token, so that a clean text drifts down. All maximal scoring segments of a text
are found in one linear scan (Ruzzo and Tompa). For such scores the best segment of ``n`` clean tokens follows an
extreme-value law: ``K n exp(-lambda s)`` segments reach ``s`` by chance. Segments expected less than
``max_expected`` times are reported; a document's evidence is the sum over its significant segments beyond the law's
location, turned into a probability by a logistic curve fitted on labelled documents that gave no counts.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wavetrawl.llm.common import ID, TEXT, fold, id_and_text, materialise, quoted

# Bounds of what reaches the driver: labelled documents of the fit, and scored tokens.
MAX_TRAINING_ROWS = 12_000
MAX_TERMS = 40_000

PRICE = 0.25
PRIOR_TOKENS = 50.0
LEAST_DOCUMENTS = 3
SIGNIFICANT = 3.5
LEAST_ODDS = 1.5
STEMS = (7, 6, 5, 4)
MAX_EXPECTED = 0.05

_WORD = re.compile(r"\w+")


def tokens_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def segments(scores: np.ndarray) -> list[tuple[float, int, int]]:
    """All maximal scoring segments ``(score, begin, end)``, in order, in linear time.

    Runs of positive scores are the candidates; each remembers the last one that starts lower than it.
    """
    positive = scores > 0
    if not positive.any():
        return []
    total = np.concatenate([[0.0], np.cumsum(scores)])
    edge = np.diff(np.concatenate([[0], positive.astype(np.int8), [0]]))
    begins, ends = np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()
    found: list[list] = []  # low, high, begin, end, the last one with a lower low
    for begin, end in zip(begins, ends):
        low, high = total[begin], total[end]
        while True:
            at = len(found) - 1
            while at >= 0 and found[at][0] >= low:
                at = found[at][4]
            if at < 0 or found[at][1] >= high:
                found.append([low, high, begin, end, at])
                break
            low, begin = found[at][0], found[at][2]
            del found[at:]
    return [(float(high - low), begin, end) for low, high, begin, end, _ in found]


def damped(evidence):
    """Evidence on a logarithmic scale: long toxic texts must not flatten the curve for short ones."""
    return np.log1p(np.maximum(evidence, 0.0))


@dataclass(frozen=True)
class ToxicityModel:
    words: dict[str, float]
    stems: dict[str, float]
    rate: float
    log_k: float
    slope: float
    offset: float

    def score(self, token: str) -> float:
        """The token's own score, else that of its longest scored beginning, else the price."""
        if token in self.words:
            return self.words[token]
        return next((self.stems[token[:n]] for n in STEMS if token[:n] in self.stems), -PRICE)

    def scores(self, tokens: list[str]) -> np.ndarray:
        known = {token: self.score(token) for token in set(tokens)}
        return np.array([known[token] for token in tokens], dtype=float)

    def expected(self, score: float, n: int) -> float:
        """Segments of at least this score expected by chance in ``n`` clean tokens."""
        return float(np.exp(np.clip(self.log_k + np.log(max(n, 1)) - self.rate * score, -700, 700)))

    def passages(self, text: str | None, max_expected: float = MAX_EXPECTED) -> list[tuple[float, int, int]]:
        """Significant segments as ``(score, first token, token after the last)``."""
        tokens = tokens_of(text)
        return [s for s in segments(self.scores(tokens)) if self.expected(s[0], len(tokens)) < max_expected]

    def evidence(self, text: str | None) -> float:
        """The best segment beyond the location of the extreme-value law, and all further significant ones."""
        tokens = tokens_of(text)
        found = segments(self.scores(tokens))
        if not found:
            return self._beyond(0.0, len(tokens))
        beyond = sorted((self._beyond(s, len(tokens)) for s, _, _ in found), reverse=True)
        return beyond[0] + sum(x for x in beyond[1:] if x > -np.log(MAX_EXPECTED))

    def _beyond(self, score: float, n: int) -> float:
        return self.rate * score - self.log_k - float(np.log(max(n, 1)))

    def probability(self, text: str | None) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * damped(self.evidence(text)) + self.offset, -30, 30))))


def _decay_rate(scores: np.ndarray, weights: np.ndarray) -> float:
    """The positive lambda with mean of exp(lambda s) equal to one; scores are negative in the mean."""
    weights = weights / weights.sum()
    low, high = 0.0, 1.0
    while high < 64 and (weights * np.exp(np.minimum(high * scores, 500))).sum() < 1:
        low, high = high, high * 2
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if (weights * np.exp(np.minimum(middle * scores, 500))).sum() < 1 else (low, middle)
    return max((low + high) / 2, 0.05)


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset by damped Newton steps; the damping keeps separable data finite."""
    scale = max(float(np.std(x)), 1e-6)
    center = float(np.mean(x))
    design = np.stack([(x - center) / scale, np.ones(len(x))], axis=1)
    beta, damping = np.zeros(2), np.array([0.05, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        gradient = design.T @ (y - p) - damping * beta
        weight = np.maximum(p * (1 - p), 1e-4)
        step = np.linalg.solve((design * weight[:, None]).T @ design + np.diag(damping + 1e-9), gradient)
        beta = beta + np.clip(step, -2, 2)
    return beta[0] / scale, beta[1] - beta[0] * center / scale


def _term_counts(rows: DataFrame) -> DataFrame:
    """Documents with each word and stem, ``kind, term, toxic, other``."""
    words = F.array_distinct(F.regexp_extract_all(F.lower(TEXT), F.lit(r"(?U)(\w+)"), F.lit(1)))

    def stems(words: Column, n: int) -> Column:
        long = F.filter(words, lambda word: F.length(word) > n)
        return F.array_distinct(F.transform(long, lambda word: F.substring(word, 1, n)))

    held = rows.select("label", F.explode(F.array(words)).alias("words"))
    kinds = [F.struct(F.lit("word").alias("kind"), F.col("words").alias("terms"))]
    kinds += [F.struct(F.lit("stem").alias("kind"), stems(F.col("words"), n).alias("terms")) for n in STEMS]
    terms = held.select("label", F.inline(F.array(*kinds))).select("label", "kind", F.explode("terms").alias("term"))
    return terms.groupBy("kind", "term").agg(
        F.sum("label").cast("double").alias("toxic"), F.sum(1 - F.col("label")).cast("double").alias("other")
    )


def fit_toxicity(
    rows: DataFrame, labels: DataFrame, label: str = "toxic", folds: int = 3, held_out: int = 1,
    max_rows: int = MAX_TRAINING_ROWS,
) -> ToxicityModel:
    """Fit on at most ``max_rows`` labelled documents outside the held-out fold; ``rows`` has ``ID`` and ``TEXT``.

    The distinct texts of three quarters of them give the counts, the rest the calibration. Null ids and labels are left out. Without
    labelled documents of both kinds every text gets the same low score.
    """
    marks = labels.select(F.col("doc_id").alias(ID), F.col(label).cast("int").alias("label")).dropna().distinct()
    marks = marks.filter(fold(F.col(ID), folds) != held_out).orderBy(F.xxhash64(ID), ID, "label").limit(max_rows)
    spark = rows.sparkSession
    marks = spark.createDataFrame(marks.toPandas(), f"{ID} bigint, label int")  # bounded by max_rows
    known = rows.join(F.broadcast(marks), ID)
    calibrates = F.pmod(F.xxhash64(ID, F.lit("calibration")), F.lit(4)) == 0
    counted = materialise(known.filter(~calibrates).select(TEXT, "label").distinct(), "toxicity-training")
    sizes = counted.agg(F.sum("label"), F.sum(1 - F.col("label"))).first()
    toxic, other = (float(x or 0) for x in sizes)
    if not toxic or not other:
        return ToxicityModel({}, {}, 1.0, 0.0, 0.0, -5.0)
    prior, n = PRIOR_TOKENS, toxic + other
    share = (F.col("toxic") + F.col("other")) / n
    a, b = F.col("toxic") + prior * share, F.col("other") + prior * share
    odds = F.log(a / (toxic + prior)) - F.log(b / (other + prior))
    counts = materialise(_term_counts(counted), "term-counts")
    occurrences = float(counts.filter("kind = 'word'").agg(F.sum("other")).first()[0] or 1)
    weighed = (
        counts.filter(F.col("toxic") + F.col("other") >= LEAST_DOCUMENTS)
        .withColumn("odds", odds)
        .withColumn("z", odds / F.sqrt(1 / a + 1 / b))
        .filter((F.abs("z") > SIGNIFICANT) & (F.abs("odds") > LEAST_ODDS))
    )
    top = weighed.orderBy(F.abs("z").desc(), "kind", "term").limit(MAX_TERMS).toPandas()
    top["score"] = top["odds"] - PRICE  # tokens without a significant difference cost the price alone
    table = {kind: dict(zip(part["term"], part["score"])) for kind, part in top.groupby("kind")}
    words, stems = table.get("word", {}), table.get("stem", {})
    stems = {stem: score for stem, score in stems.items() if score > 0}
    background = top[top["kind"] == "word"]
    rest = max(occurrences - float(background["other"].sum()), 1.0)
    rate = _decay_rate(
        np.append(background["score"].to_numpy(), -PRICE), np.append(background["other"].to_numpy() + 0.5, rest)
    )
    draft = ToxicityModel(words, stems, rate, 0.0, 1.0, 0.0)

    @F.pandas_udf("double")
    def evidence(texts: pd.Series) -> pd.Series:
        return pd.Series([draft.evidence(text) for text in texts], dtype=float)

    seen = known.filter(calibrates).select("label", evidence(TEXT).alias("x")).limit(4 * max_rows).toPandas()
    x, y = seen["x"].to_numpy(dtype=float), seen["label"].to_numpy(dtype=float)
    if not len(x) or y.min() == y.max():
        return ToxicityModel(words, stems, rate, 0.0, 0.5, -3.0)
    # Of the law exp(-exp(-(x - log K))), the mean is log K plus Euler's constant.
    log_k = float(np.median(x[y == 0])) + float(np.log(np.log(2)))
    slope, offset = _logistic(damped(x - log_k), y)
    return ToxicityModel(words, stems, rate, log_k, max(slope, 0.0), offset)


def toxicity(model: ToxicityModel, text: Column) -> Column:
    """The probability that a text is toxic; null and empty texts count as no tokens."""

    @F.pandas_udf("double")
    def probability(texts: pd.Series) -> pd.Series:
        return pd.Series([model.probability(t) for t in texts], dtype=float)

    return probability(text)


def toxic_passages(model: ToxicityModel, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Columns ``doc_id, passages``: score, first token and token after the last of each significant passage."""

    @F.pandas_udf("array<struct<score: double, begin: bigint, end: bigint>>")
    def found(texts: pd.Series) -> pd.Series:
        return pd.Series([model.passages(t) for t in texts], dtype=object)

    return docs.select(quoted(id_col).alias("doc_id"), found(quoted(text_col)).alias("passages"))


def score_toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """Columns ``doc_id, held_out, score, predicted``, one row per input row; texts are not moved."""
    rows = id_and_text(docs)
    model = fit_toxicity(rows, labels)
    scored = rows.select(
        F.col(ID).alias("doc_id"), (fold(F.col(ID), 3) == 1).alias("held_out"), toxicity(model, F.col(TEXT)).alias("score")
    )
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
