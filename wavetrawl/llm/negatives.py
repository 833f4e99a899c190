"""Hard negatives of anchor vectors, by Fagin's threshold algorithm.

Rows are dealt at random into parts of bounded size, anchors into groups of bounded size, and each pair of a part and a
group is one cell of a co-group, so that every anchor meets every row in bounded memory. A cell holds its rows as one list
per dimension, sorted by component. An anchor reads all its lists from the end that its component's sign makes best
(sorted access), scores each new row by its integer inner product (random access), and stops as soon as the threshold,
the score of an imaginary row made of the components last read, is strictly below the score of the last wanted row of
every window, or below the window itself. "Strictly", because a row with an equal score may win by its smaller id.

Two passes are made: the first finds each anchor's positives, the second its negatives within the score windows that
the positives' scores span. Each cell gives its own best rows, of which a ranked window keeps the best.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wavetrawl.llm.common import materialise, quoted

SCALE = 256
POSITIVES, NEGATIVES = 5, 10
# A negative's score lies between these percentages of the positive's.
LEAST_PERCENT, MOST_PERCENT = 30, 90

# Rows of a part: a 64th of all within these bounds. Anchors of a group.
PART_ROWS = (2_048, 65_536)
GROUP_ROWS = 16_384

_FIRST_DEPTH, _GROWTH = 4, 4
# Whole numbers below this are exact in doubles, sums included.
_EXACT = 1 << 53
_LONG = (-(1 << 63), (1 << 63) - 1)

_FOUND = "anchor_id bigint, place int, other_id bigint, score bigint"


class SortedLists:
    """Rows of one cell with a sorted list per dimension. ``ids`` must ascend."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids = ids
        self.vectors = vectors
        self.order = np.argsort(vectors, axis=0, kind="stable").T  # (dimensions, rows), best first for negative signs
        self.values = np.take_along_axis(vectors.T, self.order, axis=1)

    def accesses(self, anchor: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
        """Rounds of sorted access: the rows seen for the first time, their scores, and the threshold for all others.

        Each round reads deeper into the lists. When a round would read as many entries as there are rows, it takes
        all that are left, and the threshold falls below any score.
        """
        n = len(self.ids)
        used = np.flatnonzero(anchor != 0)
        part = anchor[used]
        rising = part < 0
        seen = np.zeros(n, dtype=bool)
        depth, to = 0, _FIRST_DEPTH
        while depth < n:
            if len(used) * to >= n:
                yield (rest := np.flatnonzero(~seen)), self._scores(rest, anchor), -np.inf
                return
            low, high = self.order[used, depth:to], self.order[used, n - to : n - depth]
            fresh = np.zeros(n, dtype=bool)
            fresh[np.where(rising[:, None], low, high)] = True
            new = np.flatnonzero(fresh & ~seen)
            seen |= fresh
            last = np.where(rising, self.values[used, to - 1], self.values[used, n - to])
            yield new, self._scores(new, anchor), part @ last
            depth, to = to, to * _GROWTH

    def _scores(self, rows: np.ndarray, anchor: np.ndarray) -> np.ndarray:
        if 2 * len(rows) > len(self.ids):
            return (self.vectors @ anchor)[rows]
        return self.vectors[rows] @ anchor


@dataclass
class _Best:
    """The best rows so far of one score window, by score and then by place."""

    low: float
    high: float
    k: int

    def __post_init__(self):
        self.rows, self.scores = np.zeros(0, dtype=np.int64), np.zeros(0)

    def add(self, rows: np.ndarray, scores: np.ndarray) -> None:
        fits = (scores >= self.low) & (scores <= self.high)
        rows, scores = rows[fits], scores[fits]
        if len(rows) > self.k:
            # Rows ascend, so of equal scores the first ones are the ones to keep; none of the k best falls out.
            least = -np.partition(-scores, self.k - 1)[self.k - 1]
            rows, scores = rows[scores >= least], scores[scores >= least]
        rows, scores = np.concatenate([self.rows, rows]), np.concatenate([self.scores, scores])
        best = np.lexsort((rows, -scores))[: self.k]
        self.rows, self.scores = rows[best], scores[best]

    def settled(self, threshold: float) -> bool:
        full = len(self.rows) >= self.k
        return threshold < self.low or (full and threshold < self.scores[-1])


def threshold_search(
    lists: SortedLists, anchor: np.ndarray, windows: Sequence[tuple[float, float]], k: int, allowed: np.ndarray
) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each score window (both ends included), the ids and scores of its ``k`` best allowed rows."""
    best = [_Best(low, high, k) for low, high in windows]
    for rows, scores, threshold in lists.accesses(anchor):
        kept = allowed[rows]
        rows, scores = rows[kept], scores[kept]
        for window in best:
            window.add(rows, scores)
        if all(window.settled(threshold) for window in best):
            break
    return [(lists.ids[window.rows], window.scores) for window in best]


def score_window(positive: int) -> tuple[float, float]:
    """The whole scores that are at least and at most the stated percentages of a positive's."""
    return -(-LEAST_PERCENT * positive // 100), MOST_PERCENT * positive // 100


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Vectors as rows of whole numbers; shorter ones end in zeros."""
    lists = column.combine_chunks()
    offsets = lists.offsets.to_numpy()
    sizes, flat = np.diff(offsets), lists.values.to_numpy()[offsets[0] : offsets[-1]]
    result = np.zeros((len(sizes), width), dtype=np.int64)
    result[np.arange(width) < sizes[:, None]] = flat
    return result


def _cell(rows: pa.Table, anchors: pa.Table) -> tuple[np.ndarray, ...]:
    width = max((max(t["width"].to_pylist(), default=0) for t in (rows, anchors)), default=0)
    rows, anchors = rows.sort_by("vec_id"), anchors.sort_by("vec_id")
    x, a = _matrix(rows["vector"], width), _matrix(anchors["vector"], width)
    largest = int(np.abs(x.astype(float)).sum(axis=1).max(initial=0)) * int(np.abs(a.astype(float)).max(initial=0))
    kind = float if largest < _EXACT else object
    return rows["vec_id"].to_numpy(), rows["label"].to_numpy(), x.astype(kind), a.astype(kind), anchors


def _table(found: list[tuple[int, int, np.ndarray, np.ndarray]]) -> pa.Table:
    columns = [[], [], [], []]
    for anchor, place, ids, scores in found:
        for values, new in zip(columns, ([anchor] * len(ids), [place] * len(ids), ids.tolist(), scores.tolist())):
            values += new
    columns[3] = [min(max(int(score), _LONG[0]), _LONG[1]) for score in columns[3]]
    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64())
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], ["anchor_id", "place", "other_id", "score"])


def _positives(k: int):
    def cell(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        ids, labels, x, a, anchors = _cell(rows, anchors)
        found, lists = [], {}
        for i, (anchor, label) in enumerate(zip(anchors["vec_id"].to_pylist(), anchors["label"].to_pylist())):
            if label not in lists:
                own = np.flatnonzero(labels == label)
                lists[label] = SortedLists(ids[own], x[own])
            others = lists[label].ids != anchor
            (best,) = threshold_search(lists[label], a[i], [(-np.inf, np.inf)], k, others)
            found.append((anchor, 0, *best))
        return _table(found)

    return cell


def _negatives(k: int):
    def cell(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        ids, labels, x, a, anchors = _cell(rows, anchors)
        lists, found = SortedLists(ids, x), []
        for i, (anchor, label, scores) in enumerate(
            zip(anchors["vec_id"].to_pylist(), anchors["label"].to_pylist(), anchors["scores"].to_pylist())
        ):
            best = threshold_search(lists, a[i], [score_window(score) for score in scores], k, labels != label)
            found += [(anchor, place, *window) for place, window in enumerate(best)]
        return _table(found)

    return cell


def whole_vectors(
    rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label: Column | None = None
) -> DataFrame:
    """Columns ``vec_id, label, vector, width``: scaled and floored components of the rows that take part.

    Left out are rows with a null id, label or vector, or with a null or non-finite component. Components beyond the
    64-bit range stay at its ends.
    """
    vector = F.transform(quoted(vector_col), lambda x: x.cast("double"))
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    taken = rows.select(
        quoted(id_col).cast("bigint").alias("vec_id"),
        (F.col("label") if label is None else label).cast("bigint").alias("label"),
        vector.alias("raw"),
        sound.alias("sound"),
    ).filter("vec_id IS NOT NULL AND label IS NOT NULL AND raw IS NOT NULL AND sound")
    whole = F.transform("raw", lambda x: F.floor(x * F.lit(float(SCALE))))
    return taken.select("vec_id", "label", whole.alias("vector"), F.size("raw").alias("width"))


def _cells(rows: DataFrame, parts: int, groups: int, anchors: bool) -> DataFrame:
    """Rows in the cells of all groups or, for anchors, of all parts, with the cell's number."""
    if anchors:
        own, every = F.pmod(F.xxhash64("vec_id", F.lit(2)), F.lit(groups)), parts
    else:
        own, every = F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(parts)), groups
    dealt = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(every - 1))))
    cell = F.col("other") * groups + own if anchors else own * groups + F.col("other")
    return dealt.withColumn("cell", cell).drop("other")


def _search(spread: DataFrame, asking: DataFrame, cell, k: int) -> DataFrame:
    found = spread.groupBy("cell").cogroup(asking.groupBy("cell")).applyInArrow(cell, _FOUND)
    order = Window.partitionBy("anchor_id", "place").orderBy(F.col("score").desc(), "other_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def hard_negatives(
    rows: DataFrame,
    is_anchor: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label: Column | None = None,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
) -> DataFrame:
    """Columns ``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``is_anchor`` is a condition on ``vec_id``, ``label`` an expression over the given rows (default: the column of
    that name). Which rows take part: see :func:`whole_vectors`. Rows that share an id count as one: the one with the
    smallest label, then vector. Vectors of differing lengths are compared as if the shorter ones ended in zeros. Scores
    are exact within 64 bits; beyond, they stay at the ends of that range and tie. Anchors without positives, and
    positives without negatives in their window, give no rows; so does an empty table.
    """
    whole = whole_vectors(rows, id_col, vector_col, label)
    first = whole.groupBy("vec_id").agg(F.min(F.struct("label", "vector", "width")).alias("row")).select("vec_id", "row.*")
    first = materialise(first, "vectors")
    anchors = materialise(first.filter(is_anchor), "anchors")
    count = first.count()
    parts = count // min(max(count // 64, PART_ROWS[0]), PART_ROWS[1]) + 1
    groups = anchors.count() // GROUP_ROWS + 1
    spread = _cells(first, parts, groups, anchors=False)
    found = _search(spread, _cells(anchors, parts, groups, anchors=True), _positives(positives), positives)
    found = materialise(found, "positives")
    near = F.sort_array(F.collect_list(F.struct("rank", "score")))
    scored = anchors.join(
        found.groupBy("anchor_id").agg(near.alias("near")).withColumnRenamed("anchor_id", "vec_id"), "vec_id"
    ).select(*first.columns, F.col("near.score").alias("scores"))
    mined = _search(spread, _cells(scored, parts, groups, anchors=True), _negatives(negatives), negatives)
    named = found.select(
        "anchor_id", (F.col("rank") - 1).alias("place"), F.col("other_id").alias("positive_id"),
        F.col("score").alias("positive_score"),
    )
    return mined.join(named, ["anchor_id", "place"]).select(
        "anchor_id", "positive_id", "rank", F.col("other_id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"),
    )
