"""Sharded manifests of cuts and their recordings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pyspark.sql import types as T

from wavetrawl import schemas
from wavetrawl.operators.ordering import number_rows

SHARD_SIZE = 5000

_SHARD = T.StructField("shard", T.LongType())


def assign_shards(rows: DataFrame, order: list[str], shard_size: int = SHARD_SIZE) -> DataFrame:
    """Number rows in order and give each its ``id`` (``audio_00000042``) and ``shard``."""
    numbered = number_rows(rows, order)
    return numbered.withColumn("id", F.format_string("audio_%08d", "idx")).withColumn(
        "shard", F.floor(F.col("idx") / shard_size)
    )


def with_shard(cuts: DataFrame, shard_size: int = SHARD_SIZE) -> DataFrame:
    """Add the ``shard`` that a cut's id, as :func:`assign_shards` gives it, belongs to."""
    number = F.regexp_extract("id", r"^audio_(\d+)$", 1).cast("bigint")
    return cuts.withColumn("shard", F.floor(number / shard_size))


def write_manifest(cuts: DataFrame, folder: str) -> None:
    """Write cuts with a ``shard`` column as gzip JSON lines, one sub-folder per table and shard.

    Cuts and recordings go to two tables, which :func:`read_manifest` brings together. Both come out of one write: a
    cut is two lines of it, so the cuts are worked out once. Rows are dealt by shard, so a shard is one file.
    """
    cut = F.struct(*[_light_column(name) for name in cuts.columns if name != "shard"])
    lines = [
        F.struct(F.lit("cuts").alias("table"), F.to_json(cut).alias("value")),
        F.struct(F.lit("recordings").alias("table"), F.to_json("recording").alias("value")),
    ]
    dealt = cuts.repartition("shard").select("shard", F.inline(F.array(*lines)))
    dealt.write.mode("overwrite").partitionBy("table", "shard").option("compression", "gzip").text(folder)


def _light_column(name: str) -> Column:
    """A cut's column, of the recording only the id."""
    return F.struct(F.col("recording.id").alias("id")).alias("recording") if name == "recording" else F.col(f"`{name}`")


def read_cuts(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(T.StructType([*schemas.CUTS, _SHARD])).json(f"{folder}/table=cuts")


def read_recordings(spark: SparkSession, folder: str) -> DataFrame:
    recordings = spark.read.schema(T.StructType([*schemas.RECORDING, _SHARD])).json(f"{folder}/table=recordings")
    return recordings.drop("shard")


def attach_recordings(cuts: DataFrame, recordings: DataFrame) -> DataFrame:
    """Cuts with their recordings; both sides are unique by id."""
    full = recordings.select(F.col("id").alias("__id"), F.struct(*schemas.RECORDING.names).alias("__recording"))
    return (
        cuts.join(full, F.col("recording.id") == F.col("__id"))
        .withColumn("recording", F.col("__recording"))
        .drop("__id", "__recording")
    )


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return attach_recordings(read_cuts(spark, folder), read_recordings(spark, folder))


def orphans(cuts: DataFrame, recordings: DataFrame) -> DataFrame:
    """Ids that only one side has: ``id, missing``."""
    left = cuts.select(F.col("recording.id").alias("id"), F.lit(True).alias("in_cuts"))
    right = recordings.select("id", F.lit(True).alias("in_recordings"))
    missing = F.when(F.col("in_recordings").isNull(), F.lit("recording")).when(
        F.col("in_cuts").isNull(), F.lit("cut")
    )
    return (
        left.join(right, "id", "full_outer").select("id", missing.alias("missing")).filter(F.col("missing").isNotNull())
    )


def first_cut(cuts: DataFrame, n: int = 1) -> DataFrame:
    """A look at the first cuts by id."""
    return cuts.orderBy("id").limit(n)
