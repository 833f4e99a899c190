"""Near duplicates by SimHash fingerprints and covering locality-sensitive hashing.

Bit i of the fingerprint carries a non-zero vector m(i) of ``max_bits + 1`` bits. Table v (each non-zero
vector again) keeps the bits with an odd inner product <m(i), v>. Any ``max_bits`` differing bits span fewer
dimensions than the vectors have, so some v is orthogonal to all of them: in that table the two fingerprints
are equal. No pair within the radius is missed, whatever the data.
"""

from __future__ import annotations

from itertools import accumulate

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wavetrawl.llm.common import ID, TEXT, fresh, id_and_text, materialise, quoted, text_key
from wavetrawl.llm.components import connected_components

BITS = 64
_CHUNK = 1 << 16


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def covering_masks(max_bits: int) -> list[int]:
    """The tables' bit masks, unsigned."""
    vectors = (1 << (max_bits + 1)) - 1
    return [
        sum(1 << i for i in range(BITS) if ((i % vectors + 1) & v).bit_count() & 1) for v in range(1, vectors + 1)
    ]


def fingerprint_of(text: str | None, shingle: int) -> int:
    """The unsigned fingerprint of one text; 0 without words."""
    import numpy as np
    from xxhash import xxh64_intdigest

    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    starts = [0, *accumulate(len(word) + 1 for word in words)]
    if len(words) < shingle:
        spans = [(0, len(joined))]
    else:
        spans = zip(starts, (end - 1 for end in starts[shingle:]))
    hashes = np.array([xxh64_intdigest(joined[a:b], 42) for a, b in spans], dtype="<u8")
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), _CHUNK):
        octets = hashes[at : at + _CHUNK].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def with_fingerprint(docs: DataFrame, text_col: str, out: str, shingle: int = 3) -> DataFrame:
    """Add the fingerprint as a signed long; a column named ``out`` is replaced."""

    @F.pandas_udf("bigint")
    def fingerprint(texts: pd.Series) -> pd.Series:
        return pd.Series([_signed(fingerprint_of(text, shingle)) for text in texts], dtype="int64")

    return docs.withColumn(out, fingerprint(quoted(text_col)))


def fingerprint_links(prints: DataFrame, max_bits: int = 2) -> DataFrame:
    """Links ``a, b`` that connect exactly the fingerprints (distinct, column ``fp``) within ``max_bits`` of each other.

    A bucket of two is tested directly. In a larger one, pairs are not listed: each member names the centres
    one free bit away and itself. Members of one centre, at most 65 distinct ones, are pairwise within two
    bits, and any two within two bits of each other have a centre in common; so a star per centre connects them.
    The work is a constant per fingerprint and table, however many near copies there are.
    """
    if not 0 <= max_bits <= 2:
        raise ValueError("max_bits must be 0, 1 or 2")
    masks = covering_masks(max_bits)
    tables = F.array(*[
        F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key"))
        for t, m in enumerate(masks)
    ])
    rows = prints.select("fp", F.inline(tables))
    buckets = rows.groupBy("t", "key").agg(F.count("*").alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b"))
    buckets = materialise(buckets.filter("n > 1"), "buckets")
    twos = buckets.filter("n = 2").select("a", "b").filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)
    flips = F.lit([[0, *(_signed(1 << i) for i in range(BITS) if not m >> i & 1)] for m in masks])
    crowd = rows.join(buckets.filter("n > 2").select("t", "key"), ["t", "key"])
    centres = crowd.select(
        "fp", F.explode(F.transform(F.element_at(flips, F.col("t") + 1), lambda x: x.bitwiseXOR(F.col("fp")))).alias("z")
    )
    stars = centres.groupBy("z").agg(F.collect_set("fp").alias("near")).filter(F.size("near") > 1)
    if max_bits == 2:
        stars = stars.select(F.array_min("near").alias("a"), F.explode("near").alias("b"))
    else:
        stars = stars.filter(F.array_contains("near", F.col("z"))).select(F.col("z").alias("a"), F.explode("near").alias("b"))
    return twos.union(stars.filter("a <> b")).distinct()


def fingerprint_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 2
) -> DataFrame:
    """One row per document: its id, text key, fingerprint ``fp`` and the ``root`` fingerprint of its group.

    Fingerprints are worked out once and written; only distinct ones are linked, so exact copies cost one row.
    """
    rows = with_fingerprint(id_and_text(docs, id_col, text_col), TEXT, "fp", shingle)
    prints = materialise(rows.select(ID, text_key(F.col(TEXT)).alias("key"), "fp"), "fingerprints")
    distinct = materialise(prints.select("fp").distinct(), "distinct-fingerprints")
    roots = connected_components(fingerprint_links(distinct, max_bits), "a", "b")
    joined = prints.join(roots, prints["fp"] == roots["node"], "left")
    return joined.select(ID, "key", "fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 2
) -> DataFrame:
    """Columns ``doc_id, fingerprint, component_id``, one row per input row.

    Null and empty texts have fingerprint zero and are linked like any other. Repeated rows each get a row.
    A null id takes part; ``component_id`` is the smallest id that is not null, null if a group has none.
    """
    groups = materialise(fingerprint_groups(docs, id_col, text_col, shingle, max_bits), "groups")
    first = materialise(groups.groupBy("root").agg(F.min(ID).alias("component_id")), "firsts")
    return groups.join(first, "root").select(
        F.col(ID).alias("doc_id"),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id",
    )


def keep_one(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 2
) -> DataFrame:
    """All columns of one document per group: the one with the smallest id (null last, then text key).

    Rows that repeat both id and text are one document; one of them stays.
    """
    groups = fingerprint_groups(docs, id_col, text_col, shingle, max_bits)
    order = F.struct(F.col(ID).isNull().alias("none"), F.col(ID).alias("id"), F.col("key").alias("key"))
    kept = groups.groupBy("root").agg(F.min(order).alias("kept")).select("kept.id", "kept.key")
    kept_id, kept_key, own_key = fresh(docs, "kept_id", "kept_key", "own_key")
    kept = materialise(kept.select(F.col("id").alias(kept_id), F.col("key").alias(kept_key)), "kept")
    keyed = docs.withColumn(own_key, text_key(quoted(text_col)))
    same = quoted(id_col).eqNullSafe(F.col(kept_id)) & (F.col(own_key) == F.col(kept_key))
    left = keyed.join(kept, same, "left_semi")
    return left.dropDuplicates([id_col, own_key]).drop(own_key)
