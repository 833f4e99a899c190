"""Katz backoff language model with Good-Turing discounts, counted and evaluated by exchanged blocks of n-grams.

Documents are gathered into chunks of ``CHUNK_TOKENS`` tokens (a longer document is one by itself). A chunk sends each distinct n-gram that it holds once, as a
64-bit hash with its count in training documents, to the table partition of that hash; the partition adds up the
counts of all chunks and answers each one in the order it asked. So a frequent word or word pair costs one entry
per chunk, partitions are even by hash, and what is moved grows with the distinct n-grams of chunks, not with
tokens. A second exchange does the same for contexts and brings back their backoff weights.

``P(w | h)`` is the discounted share ``d c(hw) / c(h)`` if ``hw`` was seen in training, else ``alpha(h) P(w | h')`` with the
shortened history; an unseen history has weight one. ``alpha(h)`` makes the sum over all words, the unknown one
included, exactly one. Where nothing would be left for unseen words (all counts above the discounted ones), one
extra count is set aside and the shares are scaled down to match.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wavetrawl.llm.common import ID, TEXT, fold, id_and_text, materialise

CHUNK_TOKENS = 1_500_000
# Entries of a table partition: all its n-grams are in memory at once.
PARTITION_ENTRIES = 1_000_000
# Counts up to this one are discounted.
LARGEST_DISCOUNTED = 5

_END = b"\n"  # no word holds white space
_ODD = np.uint64(0x9E3779B97F4A7C15)

_CHUNKS = "chunk bigint, n_tokens bigint, ids array<bigint>, held_out array<boolean>, lengths binary, tokens binary, words binary"
_ASKED = "level int, part bigint, chunk bigint, keys binary, counts binary"
_ANSWERED = "level int, part bigint, chunk bigint, counts binary, owned binary, facts array<bigint>"
_PENDING = "kind int, chunk bigint, part bigint, ids array<bigint>, held_out array<boolean>, a binary, b binary, c binary"


def _packed(values: np.ndarray) -> bytes:
    """Numbers byte position by byte position, compressed by the frequency of bytes: the high bytes of small ones and
    rare larger counts take next to nothing, in tables as well as in exchanges."""
    import zstandard

    octets = values.view(np.uint8).reshape(-1, values.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(octets.tobytes())


def _unpacked(raw: bytes, kind: str) -> np.ndarray:
    import zstandard

    width = np.dtype(kind).itemsize
    octets = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), dtype=np.uint8).reshape(width, -1)
    return np.ascontiguousarray(octets.T).view(kind).ravel()


def _steps(values: np.ndarray) -> bytes:
    """Sorted numbers as differences, so that they have leading zeros."""
    return _packed(np.diff(values, prepend=np.zeros(1, values.dtype)))


def _from_steps(raw: bytes) -> np.ndarray:
    return np.cumsum(_unpacked(raw, "<u8"), dtype=np.uint64)


def _mixed(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """A hash per pair of hashes."""
    value = (left ^ (left >> np.uint64(29))) * _ODD + right
    value ^= value >> np.uint64(32)
    value *= np.uint64(0xD6E8FEB86659FD93)
    return value ^ (value >> np.uint64(32))


def _read_chunks(docs: DataFrame, folds: int, held_out: int) -> DataFrame:
    """Documents as token numbers into each chunk's own sorted word hashes."""

    def cut(batches):
        from pyspark import TaskContext
        from xxhash import xxh64_intdigest

        number = TaskContext.get().partitionId() << 32
        ids, held, lengths, tokens, index, size = [], [], [], [], {}, 0

        def chunk():
            hashes = np.array([xxh64_intdigest(word, 0) for word in index], dtype=np.uint64)
            order = np.argsort(hashes)
            place = np.empty(len(order), dtype=np.uint32)
            place[order] = np.arange(len(order), dtype=np.uint32)
            return pd.DataFrame({
                "chunk": [number], "n_tokens": [size], "ids": [list(ids)], "held_out": [list(held)],
                "lengths": [_packed(np.array(lengths, dtype=np.int64))],
                "tokens": [_packed(place[np.concatenate(tokens)])], "words": [_steps(hashes[order])],
            })

        for batch in batches:
            for doc, out, text in zip(batch[ID], batch["held_out"], batch[TEXT]):
                words = text.encode("utf-8", "replace").lower().split()
                words.append(_END)
                tokens.append(np.array([index.setdefault(word, len(index)) for word in words], dtype=np.uint32))
                ids.append(None if pd.isna(doc) else int(doc))
                held.append(bool(out))
                lengths.append(len(words))
                size += len(words)
                if size >= CHUNK_TOKENS:
                    yield chunk()
                    number += 1
                    ids, held, lengths, tokens, index, size = [], [], [], [], {}, 0
        if ids:
            yield chunk()

    rows = docs.select(ID, TEXT, (fold(F.col(ID), folds) == held_out).alias("held_out"))
    return materialise(rows.mapInPandas(cut, _CHUNKS), "katz-chunks")


@dataclass
class _Chunk:
    """A chunk's documents, its distinct words and word pairs."""

    ids: list
    held_out: np.ndarray
    lengths: np.ndarray
    tokens: np.ndarray
    words: np.ndarray

    @classmethod
    def of(cls, row) -> _Chunk:
        return cls(
            list(row["ids"]), np.array(row["held_out"], dtype=bool), _unpacked(row["lengths"], "<i8"),
            _unpacked(row["tokens"], "<u4").astype(np.int64), _from_steps(row["words"]),
        )

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.lengths)), self.lengths)

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct pairs in the order of their hashes: hash and number; and each later token's place among them.

        The first token of a document has no history.
        """
        follows = np.ones(len(self.tokens), dtype=bool)
        follows[np.cumsum(self.lengths) - self.lengths] = False
        at = np.flatnonzero(follows)
        numbers, inverse = np.unique(self.tokens[at - 1] * len(self.words) + self.tokens[at], return_inverse=True)
        hashes = _mixed(self.words[numbers // len(self.words)], self.words[numbers % len(self.words)])
        order = np.argsort(hashes)
        place = np.empty(len(order), dtype=np.int64)
        place[order] = np.arange(len(order))
        return hashes[order], numbers[order], place[inverse]


def _asked(chunk: int, level: int, hashes: np.ndarray, counts: np.ndarray, parts: int):
    """Sorted n-grams and their counts, by the table partition of their hash range."""
    bounds = _bounds(hashes, parts)
    for part, (a, b) in enumerate(zip(bounds[:-1], bounds[1:])):
        if a < b:
            yield level, part, chunk, _steps(hashes[a:b]), _packed(counts[a:b].astype(np.int64))


def _bounds(hashes: np.ndarray, parts: int) -> np.ndarray:
    """Where the even hash ranges of the table partitions begin and end among sorted hashes."""
    begins = np.array([(i << 64) // parts for i in range(parts)], dtype=np.uint64)
    return np.append(np.searchsorted(hashes, begins), len(hashes))


def _count_tables(chunks: DataFrame, parts: int) -> DataFrame:
    def ask(batches):
        names = ["level", "part", "chunk", "keys", "counts"]
        for batch in batches:
            for at in range(len(batch)):
                row = batch.iloc[at]
                chunk = _Chunk.of(row)
                trains = ~chunk.held_out[chunk.doc]
                words = np.bincount(chunk.tokens[trains], minlength=len(chunk.words))
                yield pd.DataFrame(list(_asked(row["chunk"], 1, chunk.words, words, parts)), columns=names)
                hashes, _, place = chunk.pairs()
                later = np.ones(len(chunk.tokens), dtype=bool)
                later[np.cumsum(chunk.lengths) - chunk.lengths] = False
                counts = np.bincount(place[trains[later]], minlength=len(hashes))
                del place, later, trains
                yield pd.DataFrame(list(_asked(row["chunk"], 2, hashes, counts, parts)), columns=names)

    def answer(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("chunk")
        keys = [_from_steps(raw) for raw in group["keys"]]
        counts = np.concatenate([_unpacked(raw, "<i8") for raw in group["counts"]])
        every = np.concatenate(keys)
        distinct, first, inverse = np.unique(every, return_index=True, return_inverse=True)
        total = np.zeros(len(distinct), dtype=np.int64)
        np.add.at(total, inverse, counts)
        owned = np.zeros(len(every), dtype=bool)
        owned[first] = True
        seen = total[total > 0]
        facts = [len(seen), int(seen.sum()), *np.bincount(np.minimum(seen, LARGEST_DISCOUNTED + 2), minlength=LARGEST_DISCOUNTED + 3)[1:-1].tolist()]
        rows, at = [], 0
        for chunk, own in zip(group["chunk"], keys):
            to = at + len(own)
            rows.append((chunk, _packed(total[inverse[at:to]]), np.packbits(owned[at:to]).tobytes(), [] if at else facts))
            at = to
        result = pd.DataFrame(rows, columns=["chunk", "counts", "owned", "facts"])
        result.insert(0, "part", group["part"].iloc[0])
        result.insert(0, "level", group["level"].iloc[0])
        return result

    asked = chunks.mapInPandas(ask, _ASKED)
    return materialise(asked.groupBy("level", "part").applyInPandas(answer, _ANSWERED), "katz-counts")


@dataclass(frozen=True)
class Level:
    """Of one order: types, tokens, and the discount factor of each count from 0 to ``LARGEST_DISCOUNTED``."""

    types: int
    tokens: int
    factors: tuple[float, ...]

    @classmethod
    def of(cls, facts: list[int]) -> Level:
        types, tokens, *n = facts
        return cls(types, tokens, tuple(good_turing(n)))

    def discounted(self, counts: np.ndarray) -> np.ndarray:
        factors = np.array([*self.factors, 1.0])
        return counts * factors[np.minimum(counts, LARGEST_DISCOUNTED + 1)]


def good_turing(n: list[int]) -> list[float]:
    """Discount factors of the counts 0 to ``LARGEST_DISCOUNTED`` from the numbers of types seen 1, 2, ... times.

    Katz's form, so that the discounts of seen types together equal the mass of those seen once. A factor outside
    (0, 1], as with few data, is replaced by one.
    """
    top = LARGEST_DISCOUNTED
    if not n[0]:
        return [1.0] * (top + 1)
    cut = (top + 1) * n[top] / n[0]
    factors = [1.0]
    for r in range(1, top + 1):
        factor = ((r + 1) * n[r] / (r * n[r - 1]) - cut) / (1 - cut) if n[r - 1] and cut != 1 else 1.0
        factors.append(factor if 0 < factor <= 1 else 1.0)
    return factors


def _levels(answers: DataFrame) -> dict[int, Level]:
    """A few sums per order reach the driver."""
    width = LARGEST_DISCOUNTED + 3
    sums = [F.sum(F.element_at("facts", i + 1)).alias(f"f{i}") for i in range(width)]
    rows = answers.filter(F.size("facts") > 0).groupBy("level").agg(*sums).collect()
    found = {row["level"]: Level.of([int(row[f"f{i}"]) for i in range(width)]) for row in rows}
    return {level: found.get(level, Level.of([0] * width)) for level in (1, 2)}


@dataclass(frozen=True)
class _Words:
    """The lowest order: discounted shares, the rest for the unknown word."""

    level: Level
    unknown: float
    scale: float

    @classmethod
    def of(cls, level: Level, facts: list[int]) -> _Words:
        if not level.tokens:
            return cls(level, 1.0, 1.0)
        counts = np.arange(1, LARGEST_DISCOUNTED + 1)
        small = np.array(facts[:LARGEST_DISCOUNTED], dtype=float)
        kept = 1 - float((small * (counts - level.discounted(counts))).sum()) / level.tokens
        unknown = max(1 - kept, 1 / (level.tokens + 1))
        return cls(level, unknown, (1 - unknown) / kept)

    def share(self, counts: np.ndarray) -> np.ndarray:
        seen = self.scale * self.level.discounted(counts) / max(self.level.tokens, 1)
        return np.where(counts > 0, seen, self.unknown)


def _answers_of(rows: pd.DataFrame, level: int) -> tuple[np.ndarray, np.ndarray]:
    """A chunk's counts of one order in its own order, and which of them it answers for."""
    rows = rows[rows["level"] == level].sort_values("part")
    counts = [_unpacked(raw, "<i8") for raw in rows["counts"]]
    owned = [np.unpackbits(np.frombuffer(raw, dtype=np.uint8), count=len(c)) for raw, c in zip(rows["owned"], counts)]
    empty = [np.zeros(0, dtype=np.int64)]
    return np.concatenate(counts or empty), np.concatenate(owned or empty).astype(bool)


def _first_scores(chunks: DataFrame, answers: DataFrame, words: _Words, pairs: Level, parts: int) -> DataFrame:
    """Per chunk: what is known of its documents' scores without backoff weights, what waits for them, and what it
    adds to them as the owner of word pairs."""
    n, v = words.level.tokens, words.level.types

    def work(key, chunk_rows: pd.DataFrame, answer_rows: pd.DataFrame) -> pd.DataFrame:
        row = chunk_rows.iloc[0]
        chunk = _Chunk.of(row)
        word_count, _ = _answers_of(answer_rows, 1)
        pair_count, owned = _answers_of(answer_rows, 2)
        _, numbers, place = chunk.pairs()
        docs, doc, size = len(chunk.lengths), chunk.doc, len(chunk.words)
        share = words.share(word_count)
        known = np.bincount(doc, word_count[chunk.tokens] > 0, docs)
        base = np.bincount(doc, np.log10((word_count[chunk.tokens] + 0.5) / (n + 0.5 * (v + 1))), docs)
        first = np.cumsum(chunk.lengths) - chunk.lengths
        later = np.ones(len(doc), dtype=bool)
        later[first] = False
        before, word, count = numbers // size, numbers % size, pair_count
        seen = count > 0
        part_score = np.where(
            seen, np.log10(np.maximum(pairs.discounted(count), 1e-300) / np.maximum(word_count[before], 1)), np.log10(share[word])
        )
        score = np.log10(share[chunk.tokens[first]]) + np.bincount(doc[later], part_score[place], docs)
        mine = owned & seen
        kept = np.bincount(before[mine], pairs.discounted(count)[mine] / word_count[before[mine]], size)
        lower = np.bincount(before[mine], share[word[mine]], size)
        # Where the discounts seen here alone leave at least one extra count's share, the scale is one.
        loss = np.bincount(before[seen], (count - pairs.discounted(count))[seen], size)
        open_scale = loss < word_count / (word_count + 1)
        # What waits: a known history's weight of unseen pairs (odd numbers), its scale of seen ones (even numbers).
        waits = (word_count[before] > 0) & (~seen | open_scale[before])
        asked = np.flatnonzero((kept > 0) | (np.bincount(before[waits], minlength=size) > 0))
        number = np.zeros(size, dtype=np.int64)
        number[asked] = np.arange(len(asked))
        at = waits[place]
        codes = doc[later][at] * (2 * len(asked)) + 2 * number[before[place[at]]] + ~seen[place[at]]
        waiting, times = np.unique(codes, return_counts=True)
        facts = np.stack([chunk.lengths.astype(float), known, base, score], axis=1)
        rows = [(0, row["chunk"], -1, chunk.ids, chunk.held_out.tolist(), facts.tobytes(), _steps(waiting.astype(np.uint64)), _packed(times.astype(np.int32)))]
        words_asked = chunk.words[asked]
        bounds = _bounds(words_asked, parts)
        for part, (a, b) in enumerate(zip(bounds[:-1], bounds[1:])):
            if a < b:
                sums = np.stack([x[asked[a:b]] for x in (kept, lower, word_count.astype(float))])
                rows.append((1, row["chunk"], part, [], [], _steps(words_asked[a:b]), _packed(sums), b""))
        return pd.DataFrame(rows, columns=["kind", "chunk", "part", "ids", "held_out", "a", "b", "c"])

    answers = answers.select("level", "part", "chunk", "counts", "owned")
    both = chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInPandas(work, _PENDING)
    return materialise(both, "katz-first")


def backoff_weights(kept: np.ndarray, lower: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weight of unseen continuations and scale of seen ones, from the sums over a history's seen continuations."""
    rest = np.maximum(1 - kept, 1 / (count + 1))
    some = kept > 0
    weight = np.where(some, rest / np.maximum(1 - lower, 1e-12), 1.0)
    return weight, np.where(some, (1 - rest) / np.where(some, kept, 1.0), 1.0)


def _context_tables(pending: DataFrame) -> DataFrame:
    def answer(group: pd.DataFrame) -> pd.DataFrame:
        keys = [_from_steps(raw) for raw in group["a"]]
        sums = np.concatenate([_unpacked(raw, "<f8").reshape(3, -1).T for raw in group["b"]])
        distinct, first, inverse = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)
        kept, lower = (np.bincount(inverse, sums[:, i], len(distinct)) for i in (0, 1))
        weight, scale = backoff_weights(kept, lower, sums[first, 2])
        logs = np.stack([np.log10(scale), np.log10(weight)], axis=1)
        ends = np.cumsum([len(k) for k in keys])
        payload = [_packed(logs[inverse[a:b]]) for a, b in zip([0, *ends], ends)]
        return pd.DataFrame({"chunk": group["chunk"], "part": group["part"], "logs": payload})

    asked = pending.filter("kind = 1").select("part", "chunk", "a", "b")
    answered = asked.groupBy("part").applyInPandas(answer, "chunk bigint, part bigint, logs binary")
    return materialise(answered, "katz-weights")


def score_texts(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 5, held_out: int = 1
) -> DataFrame:
    """Columns ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``, one row per input row.

    The model learns from all documents outside the held-out fold, repeated rows as often as they occur. Null and
    empty texts are their end token. Without training documents every token is the unknown word, with
    probability one. An empty table gives an empty one.
    """
    chunks = _read_chunks(id_and_text(docs, id_col, text_col), folds, held_out)
    tokens = chunks.agg(F.sum("n_tokens")).first()[0] or 0
    parts = max(16, int(tokens // PARTITION_ENTRIES) + 1)
    answers = _count_tables(chunks, parts)
    levels = _levels(answers)
    row = answers.filter("level = 1 AND size(facts) > 0").agg(
        *[F.sum(F.element_at("facts", i + 3)).alias(f"n{i}") for i in range(LARGEST_DISCOUNTED)]
    ).first()
    small = [int(row[f"n{i}"] or 0) for i in range(LARGEST_DISCOUNTED)]
    pending = _first_scores(chunks, answers, _Words.of(levels[1], small), levels[2], parts)
    weights = _context_tables(pending)
    total = levels[1].tokens

    def finish(key, first: pd.DataFrame, logs: pd.DataFrame) -> pd.DataFrame:
        row = first.iloc[0]
        facts = np.frombuffer(row["a"], dtype=float).reshape(-1, 4)
        waiting, times = _from_steps(row["b"]).astype(np.int64), _unpacked(row["c"], "<i4")
        parts = [_unpacked(raw, "<f8") for raw in logs.sort_values("part")["logs"]]
        table = np.concatenate(parts or [np.zeros(1)])
        score = facts[:, 3] + np.bincount(waiting // len(table), times * table[waiting % len(table)], len(facts))
        return pd.DataFrame({
            "doc_id": pd.array([None if i is None or pd.isna(i) else int(i) for i in row["ids"]], dtype="Int64"),
            "held_out": row["held_out"], "n_tokens": facts[:, 0].astype(np.int64), "n_known": facts[:, 1].astype(np.int64),
            "train_tokens": total, "base_score": facts[:, 2], "score": score,
        })

    kind = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    first = pending.filter("kind = 0").select("chunk", "ids", "held_out", "a", "b", "c")
    return first.groupBy("chunk").cogroup(weights.groupBy("chunk")).applyInPandas(finish, kind)
