"""Incremental link collection: only files that no earlier run has seen."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wavetrawl.operators.dedup import first_per_url


def _stored(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema, T.StructField("batch", T.LongType())])


def _merge_batch(table: str, order: list[str], schema: T.StructType):
    def merge(batch: DataFrame, batch_id: int) -> None:
        fresh = first_per_url(batch, order)
        stored = batch.sparkSession.read.schema(_stored(schema)).parquet(table)
        known = stored.filter(F.col("batch") != batch_id).select("audio_url")
        fresh.join(known, "audio_url", "left_anti").write.mode("overwrite").parquet(f"{table}/batch={batch_id}")

    return merge


def collect_new_links(
    spark: SparkSession,
    folder: str,
    table: str,
    checkpoint: str,
    schema: T.StructType,
    order: list[str],
    files_per_batch: int | None = None,
) -> DataFrame:
    """Read the JSON-lines files that arrived since the last run and add their new links to a table.

    Within a batch the first link per URL wins, against earlier batches the stored one. Each batch owns a
    partition of the table and writes it whole, so a batch that is run again after a failure replaces its
    own output. URLs are unique on both sides of the anti join, so no key can unbalance it. The stored
    side reads the URL column only.
    """
    spark.createDataFrame([], schema).write.mode("ignore").parquet(f"{table}/batch=-1")
    reader = spark.readStream.schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    query = (
        reader.json(folder)
        .writeStream.foreachBatch(_merge_batch(table, order, schema))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(_stored(schema)).parquet(table)
