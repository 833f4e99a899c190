"""Audio as tables: waveform samples, recordings, cuts and item outcomes.

A waveform is a table ``recording_id, channel, t, value`` with ``t`` in whole ticks. One recording may
hold most of the samples, so nothing here gathers a recording in one task: work is split by tick or by
chunks of ticks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wavetrawl.functions.text import or_empty
from wavetrawl.functions.urls import audio_format

CHUNK_TICKS = 1 << 16

# The link fields a cut carries along.
CUSTOM_FIELDS = ("audio_url", "title", "description", "page_url", "language")


def downmix(samples: DataFrame) -> DataFrame:
    """All channels averaged into one: ``recording_id, t, value``."""
    return samples.groupBy("recording_id", "t").agg(F.avg("value").alias("value"))


def take_channel(samples: DataFrame, channel: int = 0) -> DataFrame:
    return samples.filter(F.col("channel") == channel)


def _chunk(chunk_ticks: int) -> Column:
    return F.floor(F.col("t") / chunk_ticks)


def to_stereo(samples: DataFrame, chunk_ticks: int = CHUNK_TICKS) -> DataFrame:
    """Copy the channel of one-channel recordings to channels 0 and 1; leave the others alone.

    The lookup of one-channel recordings is keyed by chunk as well, so a long recording is spread over
    its chunks.
    """
    per_channel = samples.groupBy("recording_id", "channel").agg(F.min("t").alias("low"), F.max("t").alias("high"))
    mono = (
        per_channel.groupBy("recording_id")
        .agg(F.count("*").alias("channels"), F.min("low").alias("low"), F.max("high").alias("high"))
        .filter("channels = 1")
        .select(
            "recording_id",
            F.explode(F.sequence(F.floor(F.col("low") / chunk_ticks), F.floor(F.col("high") / chunk_ticks))).alias(
                "__chunk"
            ),
            F.lit(True).alias("__mono"),
        )
    )
    channels = F.when(F.col("__mono"), F.array(F.lit(0), F.lit(1))).otherwise(F.array("channel"))
    return (
        samples.withColumn("__chunk", _chunk(chunk_ticks))
        .join(mono, ["recording_id", "__chunk"], "left")
        .select("recording_id", F.explode(channels).alias("channel"), "t", "value")
    )


def resample_mean(samples: DataFrame, step: int) -> DataFrame:
    """Down to one sample per ``step`` ticks, the mean of each span. Not band-limited."""
    start = (F.floor(F.col("t") / step) * step).alias("t")
    return samples.groupBy("recording_id", "channel", start).agg(F.avg("value").alias("value"))


def resample_linear(samples: DataFrame, step: int, chunk_ticks: int = CHUNK_TICKS) -> DataFrame:
    """Values on a regular grid of ``step`` ticks by linear interpolation between neighbours.

    Grid points lie at multiples of ``step`` from the first sample of a recording's channel to its last.
    Samples of one tick count as their mean. Neighbours are found by windows over chunks of ticks; for
    the points near the ends of a chunk the nearest samples outside come from a small table with one row
    per chunk, so the window over a whole recording runs on chunks, not on samples.
    """
    track = ["recording_id", "channel"]
    points = (
        samples.groupBy(*track, "t")
        .agg(F.avg("value").alias("value"))
        .withColumn("__chunk", F.floor(F.col("t") / chunk_ticks))
    )
    sample = F.struct("t", "value")
    filled = points.groupBy(*track, "__chunk").agg(F.min(sample).alias("first"), F.max(sample).alias("last"))
    by_track = Window.partitionBy(*track).orderBy("__chunk")
    following = F.lead("__chunk").over(by_track)
    # One row per chunk that has samples or lies between two that have.
    chunks = (
        filled.withColumn("__until", F.coalesce(following - 1, F.col("__chunk")))
        .withColumn("__next", F.lead("first").over(by_track))
        .withColumn("__prior", F.lag("last").over(by_track))
        .withColumn("__first_t", F.min("first.t").over(Window.partitionBy(*track)))
        .withColumn("__last_t", F.max("last.t").over(Window.partitionBy(*track)))
        .withColumn("chunk", F.explode(F.sequence("__chunk", "__until")))
        .select(
            *track,
            F.col("chunk").alias("__chunk"),
            F.when(F.col("chunk") == F.col("__chunk"), F.col("__prior")).otherwise(F.col("last")).alias("left_edge"),
            F.col("__next").alias("right_edge"),
            F.greatest(F.col("chunk") * chunk_ticks, F.col("__first_t")).alias("low"),
            F.least((F.col("chunk") + 1) * chunk_ticks - 1, F.col("__last_t")).alias("high"),
        )
    )
    first_point = F.ceil(F.col("low") / step) * step
    last_point = F.floor(F.col("high") / step) * step
    no_sample = F.lit(None).cast("struct<t:bigint,value:double>")
    grid = chunks.filter(first_point <= last_point).select(
        *track,
        "__chunk",
        F.explode(F.sequence(first_point, last_point, F.lit(step).cast("bigint"))).alias("t"),
        no_sample.alias("sample"),
        "left_edge",
        "right_edge",
    )
    known = points.select(
        *track,
        "__chunk",
        "t",
        F.struct(F.col("t").cast("bigint").alias("t"), "value").alias("sample"),
        no_sample.alias("left_edge"),
        no_sample.alias("right_edge"),
    )
    in_chunk = Window.partitionBy(*track, "__chunk")
    upto = in_chunk.orderBy("t").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    onward = in_chunk.orderBy(F.desc("t")).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    around = (
        known.unionByName(grid)
        .withColumn("a", F.last("sample", ignorenulls=True).over(upto))
        .withColumn("b", F.last("sample", ignorenulls=True).over(onward))
        .filter("sample IS NULL")
        .withColumn("a", F.coalesce("a", "left_edge"))
        .withColumn("b", F.coalesce("b", "right_edge"))
    )
    slope = (F.col("b.value") - F.col("a.value")) * (F.col("t") - F.col("a.t")) / (F.col("b.t") - F.col("a.t"))
    value = F.when(F.col("a.t") == F.col("b.t"), F.col("a.value")).otherwise(F.col("a.value") + slope)
    return around.select(*track, "t", value.alias("value"))


def recording_facts(samples: DataFrame, sampling_rate: int = 1) -> DataFrame:
    """``recording_id, num_samples, duration, channel_ids, kind`` of each recording.

    Counted per channel first, so the second step only sees one row per channel.
    """
    per_channel = samples.groupBy("recording_id", "channel").agg(F.count("*").alias("n"))
    facts = per_channel.groupBy("recording_id").agg(
        F.max("n").alias("num_samples"), F.array_sort(F.collect_set("channel")).alias("channel_ids")
    )
    return facts.select(
        "recording_id",
        "num_samples",
        (F.col("num_samples") / F.lit(float(sampling_rate))).alias("duration"),
        "channel_ids",
        F.when(F.size("channel_ids") == 1, F.lit("mono")).otherwise(F.lit("multi")).alias("kind"),
    )


def build_cuts(facts: DataFrame, links: DataFrame, sampling_rate: int = 1) -> DataFrame:
    """One cut per recording that has a link: both sides keyed by a unique ``recording_id``."""
    custom = F.map_from_arrays(
        F.array(*map(F.lit, CUSTOM_FIELDS)), F.array(*[or_empty(F.col(name)) for name in CUSTOM_FIELDS])
    )
    recording = F.struct(
        F.col("recording_id").alias("id"),
        F.lit(int(sampling_rate)).alias("sampling_rate"),
        F.col("num_samples"),
        F.col("channel_ids"),
    )
    return facts.join(links.select("recording_id", *CUSTOM_FIELDS), "recording_id").select(
        F.col("recording_id").alias("id"),
        F.lit(0.0).alias("start"),
        "duration",
        "kind",
        F.when(F.col("kind") == "mono", F.array(F.lit(0))).otherwise(F.col("channel_ids")).alias("channel"),
        recording.alias("recording"),
        custom.alias("custom"),
    )


def item_outcomes(items: DataFrame) -> DataFrame:
    """Add ``status`` and ``format`` to downloaded items; nothing is dropped and nothing raises.

    ``failed`` for a download error, ``empty`` for an item without bytes, else ``ok``.
    """
    status = (
        F.when(or_empty(F.col("error")) != "", F.lit("failed"))
        .when(F.coalesce(F.octet_length("audio_data"), F.lit(0)) == 0, F.lit("empty"))
        .otherwise(F.lit("ok"))
    )
    return items.withColumn("status", status).withColumn(
        "format", audio_format(F.col("content_type"), F.col("audio_url"))
    )


def usable_items(outcomes: DataFrame) -> DataFrame:
    return outcomes.filter(F.col("status") == "ok")


def dead_letters(outcomes: DataFrame) -> DataFrame:
    return outcomes.filter(F.col("status") != "ok")
