"""Global row numbers and ranks within groups, without a single-task window."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wavetrawl.functions.urls import url_host
from wavetrawl.session import scratch_path

_PART = "__part"
_PLACE = "__place"
_IN_PART = (1 << 33) - 1


def materialise(rows: DataFrame, label: str) -> DataFrame:
    """Write rows once to the shared scratch area and read them back.

    Later steps that depend on where each row landed see the same placement even if executors are lost
    and tasks run again.
    """
    path = scratch_path(rows.sparkSession, label)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _placed(rows: DataFrame, order: list[str], label: str) -> DataFrame:
    """Rows range-partitioned and sorted by ``order``, with their partition and place in it, written out."""
    place = F.monotonically_increasing_id()
    spread = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(_PLACE, place)
    split = spread.withColumn(_PART, F.shiftright(_PLACE, 33)).withColumn(
        _PLACE, F.col(_PLACE).bitwiseAND(F.lit(_IN_PART))
    )
    return materialise(split, label)


def number_rows(rows: DataFrame, order: list[str], out: str = "idx") -> DataFrame:
    """Number all rows from 0 in the given order, which must be total.

    A row's number is its place in its range partition plus the sizes of the partitions before it. Only
    one size per partition reaches the driver.
    """
    return _numbered(_placed(rows, order, "numbered"), out).drop(_PART, _PLACE)


def _numbered(placed: DataFrame, out: str) -> DataFrame:
    sizes = sorted(placed.groupBy(_PART).agg(F.count("*").alias("n")).collect())
    starts = accumulate((row["n"] for row in sizes), initial=0)
    offsets = placed.sparkSession.createDataFrame(
        [(row[_PART], start) for row, start in zip(sizes, starts)], f"{_PART} bigint, __start bigint"
    )
    joined = placed.join(F.broadcast(offsets), _PART)
    return joined.withColumn(out, F.col(_PLACE) + F.col("__start")).drop("__start")


def rank_within(
    rows: DataFrame, group: str, order: list[str], out: str = "rank", number: str | None = None
) -> DataFrame:
    """Number the rows of each group from 1 in the given order; ``number`` also numbers all rows, by group and order.

    A window by group would put a hot group into one task. Here rows are range-partitioned by group and
    order, so a large group spreads over many partitions; ranks are counted inside each piece and shifted
    by the sizes of the group's earlier pieces. Only the first group of a partition can go on from an
    earlier one, so there is at most one shift per partition and the broadcast stays that small.
    """
    placed = _placed(rows.filter(F.col(group).isNotNull()), [group, *order], "ranked")
    if number is not None:
        placed = _numbered(placed, number)
    by_piece = Window.partitionBy(group).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    shifts = (
        placed.groupBy(_PART, group)
        .agg(F.count("*").alias("n"))
        .withColumn("__before", F.sum("n").over(by_piece))
        .filter("__before IS NOT NULL")
        .drop("n")
    )
    within = F.row_number().over(Window.partitionBy(_PART, group).orderBy(_PLACE))
    return (
        placed.withColumn("__within", within.cast("bigint"))
        .join(F.broadcast(shifts), [_PART, group], "left")
        .withColumn(out, F.col("__within") + F.coalesce("__before", F.lit(0)))
        .select(*[f"`{c}`" for c in rows.columns], out, *([number] if number else []))
    )


def _with_host(links: DataFrame) -> DataFrame:
    return links.withColumn("host", F.lower(url_host(F.col("audio_url")))).filter("host <> ''")


# Requests at a time, over all hosts together.
TOTAL_REQUESTS = 16


def _span(requests: int | None, longest: int | None, total: int) -> int:
    return max(longest or 0, -(-(requests or 0) // total), 1)


def schedule_bound(links: DataFrame, delay: float = 1.0, total: int = TOTAL_REQUESTS) -> DataFrame:
    """One row: ``requests, hosts, longest`` (requests of one host) and ``finish_second``.

    No plan can finish sooner than the host with most requests, or than all requests over ``total`` lanes.
    """
    counts = _with_host(links).groupBy("host").agg(F.count("*").alias("n"))
    sums = counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("requests"),
        F.count("*").alias("hosts"),
        F.coalesce(F.max("n"), F.lit(0)).alias("longest"),
    )
    lanes = F.ceil(F.col("requests") / F.lit(total))
    return sums.withColumn("finish_second", F.greatest("longest", lanes) * F.lit(float(delay)))


def fetch_plan(links: DataFrame, delay: float = 1.0, tie: str = "link_pos", total: int = TOTAL_REQUESTS) -> DataFrame:
    """A start second for each download: one request per host and ``total`` in all within each ``delay`` seconds.

    Adds ``host``, ``slot`` (the request's number within its host), ``lane`` and ``start_second``. The requests are laid
    out host after host, and that line is cut into lanes as long as the bound of :func:`schedule_bound`. No host is longer
    than a lane, so its requests all have times of their own, also where it goes on in the next lane; and there are
    no more than ``total`` lanes. So the plan ends at the bound: none is shorter.
    """
    ranked = rank_within(_with_host(links), "host", ["audio_url", tie], "slot", number="__number")
    counts = ranked.groupBy("host").agg(F.count("*").alias("n"))
    span = _span(*counts.agg(F.sum("n"), F.max("n")).first(), total)
    return (
        ranked.withColumn("lane", F.expr(f"__number div {span}"))
        .withColumn("start_second", (F.col("__number") % span) * F.lit(float(delay)))
        .drop("__number")
    )


def host_bounds(links: DataFrame, delay: float = 1.0) -> DataFrame:
    """Requests and finish bound per host: a count, as the bound does not depend on the order of the requests."""
    counts = _with_host(links).groupBy("host").agg(F.count("*").alias("requests"))
    return counts.withColumn("finish_second", F.col("requests") * F.lit(float(delay)))


def first_in_order(rows: DataFrame, order: list[str], n: int | None) -> DataFrame:
    """The first ``n`` rows in order, or all of them."""
    ordered = rows.orderBy(*order)
    return ordered if n is None else ordered.limit(n)
