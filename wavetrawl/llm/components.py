"""Connected components of a link table, by alternating large-star and small-star steps.

Every step is a grouped minimum and a join back to it. The minima are written before the join, so that both
sides of it are plain exchanges and adaptive execution can split a node with very many links. Each round's
links are written as well: lineage stays short and a lost executor costs one step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wavetrawl.llm.common import compact, materialise

MAX_ROUNDS = 64


def _mark(links: DataFrame) -> tuple[int, int]:
    row = links.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("v", "u")).alias("x")).first()
    return row["n"], row["x"] or 0


def connected_components(links: DataFrame, left: str, right: str) -> DataFrame:
    """Columns ``node, root``: each linked node and the smallest node of its component, itself excluded as a row.

    Only nodes that have a link to another one appear, and the smallest of a component does not; a missing
    node is its own root. Null ends and links to oneself are ignored; an empty table gives an empty result.
    """
    ends = links.select(F.col(left).alias("a"), F.col(right).alias("b")).filter("a <> b")
    now = materialise(ends.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).distinct(), "links")
    before = _mark(now)
    for _ in range(MAX_ROUNDS):
        size = before[0]
        if not size:
            break
        both = now.select("v", "u").union(now.select("u", "v"))
        low = compact(both.groupBy("v").agg(F.least("v", F.min("u")).alias("low")), 2 * size)
        low = materialise(low, "low")
        large = both.join(low, "v").filter("u > v").select(F.col("u").alias("v"), F.col("low").alias("u"))
        large = materialise(compact(large, size), "large")
        root = materialise(compact(large.groupBy("v").agg(F.min("u").alias("low")), size), "root")
        rest = large.join(root, "v").filter("u <> low").select(F.col("u").alias("v"), F.col("low").alias("u"))
        now = compact(rest.union(root.select("v", F.col("low").alias("u"))).distinct(), 2 * size)
        now = materialise(now, "links")
        after = _mark(now)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("v").alias("node"), F.col("u").alias("root"))
