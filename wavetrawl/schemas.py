"""Declared schemas of the tables that pass between stages."""

from __future__ import annotations

from pyspark.sql import types as T


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


SNAPSHOTS = _strings("id")

FEED_LINKS = _strings("audio_url", "title", "description", "language", "page_url")

LANGUAGE_COUNTS = T.StructType(
    [T.StructField("language", T.StringType()), T.StructField("count", T.LongType())]
)

RECORDING = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("sampling_rate", T.IntegerType()),
        T.StructField("num_samples", T.LongType()),
        T.StructField("channel_ids", T.ArrayType(T.IntegerType())),
    ]
)

CUTS = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("start", T.DoubleType()),
        T.StructField("duration", T.DoubleType()),
        T.StructField("kind", T.StringType()),
        T.StructField("channel", T.ArrayType(T.IntegerType())),
        T.StructField("recording", RECORDING),
        T.StructField("custom", T.MapType(T.StringType(), T.StringType())),
    ]
)
