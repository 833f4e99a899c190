"""Target-distribution importance resampling over hashed word n-grams.

An untrained regular-expression split of the tokenizers library cuts each text, lower-cased in A-Z, into words with
their byte offsets. Windows of one to ``MAX_WORDS`` neighbouring words are hashed by crc32 into ``BUCKETS`` buckets. The
bucket counts of all documents and of all target texts give each bucket an integer gain, a document's weight is the
sum of its features' gains, and the documents to keep are drawn without replacement by the Gumbel top-k rule: each
weight gets a noise term that depends on the document's id alone, and the highest sums win.

Texts are cut up once: the bucket numbers of each document are written, two bytes a feature (a document with more
than ``MAX_LISTED`` features as its counts per bucket, so that no row grows beyond that), and both the totals and the
weights are read from there. Only the ``BUCKETS`` totals reach the driver.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import islice
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wavetrawl.llm.common import ID, TEXT, id_and_text, materialise, quoted
from wavetrawl.operators.ordering import number_rows

BUCKETS = 10_000
MAX_WORDS = 3
MIN_WORDS = 20
SEED = 42
SCALE = 1000

# A document with more features is kept as its counts per bucket, which take no more room than this many features.
MAX_LISTED = 4 * BUCKETS - 1

_PIECE = 1 << 19
_SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]"
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def _pieces(text: str) -> Iterator[str]:
    """The text in pieces of about ``_PIECE`` characters, cut after separators, so that no word is cut."""
    if len(text) <= _PIECE:
        yield text
        return
    separator = re.compile(_SEPARATOR)
    at = 0
    while at < len(text):
        found = separator.search(text, at + _PIECE)
        to = found.end() if found else len(text)
        yield text[at:to]
        at = to


class Splitter:
    """The words of a text, by the library's untrained split."""

    def __init__(self):
        from tokenizers import PreTokenizedString, Regex, pre_tokenizers

        self._text = PreTokenizedString
        self._split = pre_tokenizers.Split(Regex(_SEPARATOR + "+"), behavior="removed")

    def words(self, text: str) -> Iterator[tuple[bytes, list[tuple[int, int]]]]:
        """For each piece, its lower-cased bytes and the offsets of its words in them."""
        for piece in _pieces(text):
            lowered = piece.encode("utf-8", "replace").translate(_LOWER)
            cut = self._text(lowered.decode())
            self._split.pre_tokenize(cut)
            yield lowered, [part[1] for part in cut.get_splits(offset_referential="original", offset_type="byte")]


def feature_buckets(splitter: Splitter, text: str) -> tuple[int, int, np.ndarray]:
    """Number of words, number of features, and the features' buckets (or, if they are many, counts per bucket).

    A window's hash goes on from that of the window one word shorter. Pieces share their last words, so windows
    reach over their ends.
    """
    n_words, n_features, listed, counts = 0, 0, [], None
    tail: list[bytes] = []
    for lowered, offsets in splitter.words(text):
        if not offsets:
            continue
        known = len(tail)
        words = tail + [lowered[a:b] for a, b in offsets]
        spaced = [b" " + word for word in words]
        hashes = list(map(crc32, words))
        n_words += len(offsets)
        parts = [hashes[known:]]
        for n in range(1, MAX_WORDS):
            hashes = list(map(crc32, islice(spaced, n, None), hashes))
            parts.append(hashes[max(known - n, 0) :])
        buckets = (np.array([h for part in parts for h in part], dtype=np.uint32) % BUCKETS).astype("<u2")
        n_features += len(buckets)
        if counts is None:
            listed.append(buckets)
            if n_features > MAX_LISTED:
                counts = np.bincount(np.concatenate(listed), minlength=BUCKETS)
                listed = []
        else:
            counts += np.bincount(buckets, minlength=BUCKETS)
        tail = words[-(MAX_WORDS - 1) :]
    if counts is not None:
        return n_words, n_features, counts.astype("<i8")
    return n_words, n_features, np.concatenate(listed) if listed else np.zeros(0, "<u2")


def _read(payload: bytes, n_features: int) -> np.ndarray:
    """What :func:`feature_buckets` gave."""
    return np.frombuffer(payload, "<u2" if n_features <= MAX_LISTED else "<i8")


def with_features(rows: DataFrame, text: Column) -> DataFrame:
    """Add ``n_words``, ``n_features`` and ``buckets`` (bytes) of a text without nulls."""

    @F.pandas_udf("n_words bigint, n_features bigint, buckets binary")
    def features(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        splitter = Splitter()
        for batch in texts:
            found = [feature_buckets(splitter, text) for text in batch]
            yield pd.DataFrame(
                [(words, features, buckets.tobytes()) for words, features, buckets in found],
                columns=["n_words", "n_features", "buckets"],
            )

    return rows.withColumn("__features", features(text)).select(*[quoted(c) for c in rows.columns], "__features.*")


def bucket_totals(features: DataFrame) -> np.ndarray:
    """The counts of all features by bucket: each task sends its own counts, the driver gets one row per bucket."""

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(BUCKETS, dtype=np.int64)
        for batch in batches:
            listed = []
            for payload, n in zip(batch["buckets"].to_pylist(), batch["n_features"].to_pylist()):
                own = _read(payload, n)
                if n <= MAX_LISTED:
                    listed.append(own)
                else:
                    counts += own
            if listed:
                counts += np.bincount(np.concatenate(listed), minlength=BUCKETS)
        held = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array(counts[held])], ["bucket", "n"])

    parts = features.select("n_features", "buckets").mapInArrow(totals, "bucket int, n bigint")
    result = np.zeros(BUCKETS, dtype=np.int64)
    for row in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        result[row["bucket"]] = row["n"]
    return result


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """The scaled and floored log ratio of the smoothed bucket shares, target over source."""
    s, t = source.astype(float), target.astype(float)
    ratio = (t + 1) * (s.sum() + BUCKETS) / ((s + 1) * (t.sum() + BUCKETS))
    return np.floor(SCALE * np.log(ratio)).astype(np.int64)


def _weights(gains: np.ndarray) -> Column:
    @F.pandas_udf("bigint")
    def weight(payloads: pd.Series, counts: pd.Series) -> pd.Series:
        result = []
        for payload, n in zip(payloads, counts):
            own = _read(payload, n)
            result.append(int(gains[own].sum() if n <= MAX_LISTED else own @ gains))
        return pd.Series(result, dtype="int64")

    return weight("buckets", "n_features")


def noise(id_column: Column, seed: int = SEED) -> Column:
    """A scaled and floored Gumbel variate that depends on seed and id alone (a null id: as an empty one)."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(id_column.cast("string"), F.lit("")))
    head = F.conv(F.substring(F.sha2(named.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-SCALE * F.log(-F.log((head + 0.5) / F.lit(float(1 << 32)))))


def importance(
    docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text",
    seed: int = SEED,
) -> DataFrame:
    """Columns ``doc_id, n_words, n_features, weight, score``, one row per input row.

    Null texts, of documents and targets, are empty; texts without words have no features and weight zero. Repeated
    rows count each time and each get a row. Empty tables give bucket totals of zero.
    """
    rows = materialise(with_features(id_and_text(docs, id_col, text_col), F.col(TEXT)).drop(TEXT), "features")
    wanted = materialise(
        with_features(target.select(F.coalesce(quoted(target_col), F.lit("")).alias(TEXT)), F.col(TEXT)).drop(TEXT),
        "target-features",
    )
    gains = bucket_gains(bucket_totals(rows), bucket_totals(wanted))
    weighed = rows.select(F.col(ID).alias("doc_id"), "n_words", "n_features", _weights(gains).alias("weight"))
    return materialise(weighed.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)), "weights")


def draw(scored: DataFrame, percent: int = 5, min_words: int = MIN_WORDS) -> DataFrame:
    """Add ``rank``, from 1: of the documents with enough words, the floored share with the highest scores.

    Ties go to the smaller id (null last). Rows equal in both are told apart by their number of features and weight, and
    beyond that are alike. Ranks come from range partitions, not from one sorted task.
    """
    fit = scored.filter(F.col("n_words") >= min_words)
    drawn = fit.count() * percent // 100
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("n_features"), F.col("weight")]
    ranked = number_rows(fit, order, "place")
    rank = F.when(F.col("place") < drawn, F.col("place") + 1)
    rest = scored.filter(F.col("n_words") < min_words).withColumn("rank", F.lit(None).cast("bigint"))
    return ranked.withColumn("rank", rank.cast("bigint")).drop("place").unionByName(rest)


def resample(docs: DataFrame, target: DataFrame, percent: int = 5, id_col: str = "doc_id", **columns: str) -> DataFrame:
    """The drawn documents with all their own columns. Ids tell documents apart: rows that share one stay together."""
    ranked = draw(importance(docs, target, id_col, **columns), percent).filter("rank IS NOT NULL")
    chosen = materialise(ranked.select(F.col("doc_id").alias("__drawn")).distinct(), "drawn")
    return docs.join(chosen, quoted(id_col).eqNullSafe(chosen["__drawn"]), "left_semi")
