"""Benchmark passages in documents, with edits, by the q-gram lemma.

Texts are compared in lower case with runs of white space as one space. Each benchmark item is cut into
overlapping windows. If a window of ``L`` characters occurs with at most ``e`` edits, the occurrence shares at least
``L + 1 - q - q e`` of its q-grams, all on at most ``e + 1`` neighbouring diagonals (place in the text less place in
the window). So shared q-grams are counted in bands of ``2 (e + 1)`` diagonals that overlap by half; bands that reach
the bound are verified by an alignment limited to the band. No window within the edit budget is missed, so no passage
of ``LEAST_PASSAGE`` characters (some 13 words) or more is, if one of its windows is copied within that budget.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wavetrawl.llm.common import ID, TEXT, id_and_text, quoted

Q = 8
WINDOW = 56
STEP = 24
# Any stretch of an item that is this long holds a whole window, wherever it begins.
LEAST_PASSAGE = WINDOW + STEP - 1
EDITS_PER_CHAR = 0.1
# A benchmark with more characters than this is searched for in blocks of about this size.
BLOCK_CHARS = 4_000_000

_GROUP_CHARS = 1 << 20
_BITS = 22
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)

MATCHES = "array<struct<item_id: bigint, windows: bigint, edits: bigint, begin: bigint, end: bigint>>"


def normalise(text: str | None) -> str:
    return " ".join((text or "").lower().replace("\0", " ").split())


def windows_of(text: str) -> list[str]:
    """Windows of at most ``WINDOW`` characters that cover a normalised text; the last one ends with it."""
    if len(text) <= WINDOW:
        return [text] if text else []
    starts = [*range(0, len(text) - WINDOW, STEP), len(text) - WINDOW]
    return [text[at : at + WINDOW] for at in starts]


def budget(length: int) -> tuple[int, int, int]:
    """Edits, q and the least number of shared q-grams for a window; q shrinks where the bound would say nothing."""
    edits = int(length * EDITS_PER_CHAR)
    q = min(Q, length)
    while length + 1 - q - q * edits < 1:
        q -= 1
    return edits, q, length + 1 - q - q * edits


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "replace"), dtype="<u4")


def _grams(codes: np.ndarray, q: int) -> np.ndarray:
    """A 64-bit hash per q-gram."""
    n = len(codes) - q + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    wide = codes.astype(np.uint64)
    value = wide[:n].copy()
    for i in range(1, q):
        value *= _BASE
        value += wide[i : i + n]
    value ^= value >> np.uint64(31)
    value *= _MIX
    return value


@dataclass
class _Grams:
    """The q-grams of all windows with this q: distinct hashes, and where each one occurs."""

    keys: np.ndarray
    starts: np.ndarray
    window: np.ndarray
    offset: np.ndarray
    held: np.ndarray

    @classmethod
    def of(cls, windows: list[tuple[int, str]], q: int) -> _Grams:
        parts = [(number, _grams(_codes(text), q)) for number, text in windows]
        values = np.concatenate([g for _, g in parts])
        window = np.concatenate([np.full(len(g), number) for number, g in parts])
        offset = np.concatenate([np.arange(len(g)) for _, g in parts])
        order = np.argsort(values, kind="stable")
        keys, starts = np.unique(values[order], return_index=True)
        held = np.zeros(1 << _BITS, dtype=bool)
        held[keys >> np.uint64(64 - _BITS)] = True
        return cls(keys, np.append(starts, len(values)), window[order], offset[order], held)

    def hits(self, codes: np.ndarray, q: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Place in the text, window and place in the window of each shared q-gram."""
        grams = _grams(codes, q)
        place = np.flatnonzero(self.held[grams >> np.uint64(64 - _BITS)])
        found = grams[place]
        key = np.minimum(np.searchsorted(self.keys, found), len(self.keys) - 1)
        same = self.keys[key] == found
        place, key = place[same], key[same]
        times = self.starts[key + 1] - self.starts[key]
        first = np.repeat(self.starts[key] - np.cumsum(times) + times, times)
        entry = first + np.arange(len(first))
        return np.repeat(place, times), self.window[entry], self.offset[entry]


def band_distance(pattern: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least edits between a pattern and any stretch of each text that stays within the band; and where it ends.

    ``texts`` has one row per candidate, as wide as pattern and band together; place ``i + d`` of a row lies on
    diagonal ``d``. All rows are aligned at once.
    """
    length = len(pattern)
    width = texts.shape[1] - length + 1
    ramp = np.arange(width)
    cost = np.zeros((len(texts), width), dtype=np.int64)
    for i in range(length):
        nxt = cost + (texts[:, i : i + width] != pattern[i])
        nxt[:, :-1] = np.minimum(nxt[:, :-1], cost[:, 1:] + 1)
        cost = np.minimum.accumulate(nxt - ramp, axis=1) + ramp
    best = cost.argmin(axis=1)
    return cost[np.arange(len(texts)), best], best + length


class BenchmarkIndex:
    """The windows of a block of benchmark items, and the search for them."""

    def __init__(self, items: list[tuple[int, str]]):
        self.items, self.windows, by_q = [], [], defaultdict(list)
        for item, text in items:
            for window in windows_of(normalise(text)):
                by_q[budget(len(window))[1]].append((len(self.windows), window))
                self.items.append(item)
                self.windows.append(window)
        bounds = [budget(len(window)) for window in self.windows]
        self._edits = np.array([e for e, _, _ in bounds], dtype=np.int64)
        self._least = np.array([t for _, _, t in bounds], dtype=np.int64)
        self._codes = [_codes(window) for window in self.windows]
        self._by_q = {q: _Grams.of(windows, q) for q, windows in by_q.items()}

    def search(self, texts: list[str | None]) -> list[list[tuple[int, int, int, int, int]]]:
        """For each text, its ``(item, windows found, least edits, begin, end)``; places count normalised characters."""
        plain = [normalise(text) for text in texts]
        found: list[list] = []
        group: list[str] = []
        size = 0
        for text in plain:
            group.append(text)
            size += len(text) + 1
            if size >= _GROUP_CHARS:
                found += self._search_group(group)
                group, size = [], 0
        return found + (self._search_group(group) if group else [])

    def _candidates(self, codes: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """Rows ``text, window, lowest diagonal`` of the bands that reach their bound."""
        rows = [np.zeros((0, 3), dtype=np.int64)]
        for q, grams in self._by_q.items():
            place, window, offset = grams.hits(codes, q)
            text = np.searchsorted(begins, place, side="right") - 1
            step = self._edits[window] + 1
            band = (place - offset + WINDOW) // step
            bands = int(band.max()) + 2 if len(band) else 2
            key = (text * len(self.windows) + window) * bands + band
            keys, counts = np.unique(np.concatenate([key, key - 1]), return_counts=True)
            owner = keys // bands
            keep = counts >= self._least[owner % len(self.windows)]
            owner, band = owner[keep], keys[keep] % bands
            window = owner % len(self.windows)
            rows.append(np.stack([owner // len(self.windows), window, band * (self._edits[window] + 1) - WINDOW], axis=1))
        return np.concatenate(rows)

    def _search_group(self, texts: list[str]) -> list[list[tuple[int, int, int, int, int]]]:
        joined = _codes("\0".join(texts) + "\0")
        begins = np.cumsum([0, *(len(text) + 1 for text in texts[:-1])])
        todo = defaultdict(list)
        for text, window, low in self._candidates(joined, begins).tolist():
            todo[window].append((text, low))
        best: dict[tuple[int, int], list[int]] = {}
        outside = 2 * WINDOW
        padded = np.concatenate([np.zeros(outside, joined.dtype), joined, np.zeros(2 * outside, joined.dtype)])
        for window, places in todo.items():
            edits, pattern = int(self._edits[window]), self._codes[window]
            span = len(pattern) + 2 * (edits + 1) - 1
            lows = np.array([low for _, low in places])
            regions = padded[lows[:, None] + outside + np.arange(span)]
            distance, end = band_distance(pattern, regions)
            matched: dict[int, tuple[int, int]] = {}
            for (text, low), d, e in zip(places, distance.tolist(), (lows + end).tolist()):
                if d <= edits:
                    stop = min(e - int(begins[text]), len(texts[text]))
                    matched[text] = min(matched.get(text, (d, stop)), (d, stop))
            for text, (d, stop) in matched.items():
                start = max(0, stop - len(pattern))
                row = best.setdefault((text, self.items[window]), [0, d, start, stop])
                row[:] = row[0] + 1, min(row[1], d), min(row[2], start), max(row[3], stop)
        result: list[list] = [[] for _ in texts]
        for (text, item), row in sorted(best.items()):
            result[text].append((item, *row))
        return result


def benchmark_blocks(benchmark: DataFrame) -> list[BenchmarkIndex]:
    """Indexes of the benchmark, each over at most about ``BLOCK_CHARS`` characters. Null ids and texts are no items."""
    items = benchmark.select(F.col("item_id").alias(ID), F.col("text").alias(TEXT)).dropna()
    chars = items.agg(F.sum(F.length(TEXT))).first()[0] or 0
    blocks = -(-chars // BLOCK_CHARS)
    part = F.pmod(F.xxhash64(ID, TEXT), F.lit(max(blocks, 1)))
    return [
        BenchmarkIndex([tuple(row) for row in items.filter(part == block).distinct().orderBy(ID, TEXT).collect()])
        for block in range(blocks)
    ]


def _matches(index: BenchmarkIndex, text: Column) -> Column:
    @F.pandas_udf(MATCHES)
    def found(texts: pd.Series) -> pd.Series:
        names = ("item_id", "windows", "edits", "begin", "end")
        return pd.Series([[dict(zip(names, m)) for m in row] for row in index.search(list(texts))], dtype=object)

    return found(text)


def benchmark_matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document and benchmark item found in it: ``doc_id, item_id, windows, edits, begin, end``.

    ``windows`` is how many of the item's windows occur, ``edits`` the least edits of one. Null and empty texts hold
    nothing; repeated rows are each searched; an empty benchmark gives no rows. Texts are not moved.
    """
    rows = id_and_text(docs, id_col, text_col)
    parts = [
        rows.select(F.col(ID).alias("doc_id"), F.inline(_matches(index, F.col(TEXT))))
        for index in benchmark_blocks(benchmark)
    ]
    if parts:
        return reduce(DataFrame.unionAll, parts)
    return docs.sparkSession.createDataFrame(
        [], "doc_id bigint, item_id bigint, windows bigint, edits bigint, begin bigint, end bigint"
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents in which no benchmark item was found, with their own columns."""
    for index in benchmark_blocks(benchmark):
        docs = docs.filter(F.size(_matches(index, quoted(text_col))) == 0)
    return docs
