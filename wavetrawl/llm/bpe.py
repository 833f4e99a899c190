"""Byte-level BPE by a pair occurrence index, and its inverse.

All new words of a batch are one array of symbols. The index maps each mergeable pair, by its rank, to all its
positions there. Ranks are applied in ascending order, each to all its positions at once, and the pairs that a
merge makes or ends are entered under their own ranks. As a pair made by a merge always ranks after it, this
gives each word the merges that it would get by itself.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wavetrawl.llm.chunks import ID_TYPE, ChunkEncoder, slices
from wavetrawl.llm.common import quoted

# The word pattern of this kind of tokenizer: a fixed value.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# Documents whose new words are merged together.
BATCH = 4_096

_END = -1
_NO_RANK = np.iinfo(np.int32).max


def byte_letters() -> list[str]:
    """The letter that stands for each byte in the vocabulary: printable ones for themselves, the rest from 256 up."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(256, 512))
    return [chr(byte if byte in plain else next(others)) for byte in range(256)]


def _distinct(places: np.ndarray) -> np.ndarray:
    places = np.sort(places)
    return places[np.r_[True, places[1:] != places[:-1]]] if len(places) else places


class PairIndexBpe:
    """A vocabulary file of the tokenizers library, byte-level BPE with the usual pattern."""

    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as file:
            given = json.load(file)
        model, step = given["model"], given["pre_tokenizer"]
        if model["type"] != "BPE" or step["type"] != "ByteLevel" or step.get("add_prefix_space") or given["normalizer"]:
            raise ValueError("not a plain byte-level BPE file")
        vocab = model["vocab"]
        letters = byte_letters()
        of_letter = {letter: byte for byte, letter in enumerate(letters)}
        self.special = {token["content"]: token["id"] for token in given["added_tokens"]}
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.token_bytes = [b""] * size
        for token, i in vocab.items():
            self.token_bytes[i] = bytes(of_letter[letter] for letter in token)
        for token, i in self.special.items():
            self.token_bytes[i] = token.encode()
        self._byte_id = np.array([vocab[letter] for letter in letters], dtype=np.int32)
        merges = [merge if isinstance(merge, list) else merge.split(" ") for merge in model["merges"]]
        self._left = np.array([vocab[a] for a, _ in merges], dtype=np.int32)
        self._right = np.array([vocab[b] for _, b in merges], dtype=np.int32)
        self._made = np.array([vocab[a + b] for a, b in merges], dtype=np.int32)
        keys = self._left.astype(np.int64) << 32 | self._right
        order = np.argsort(keys)
        self._keys, self._ranks = keys[order], order.astype(np.int32)
        self._words = regex.compile(WORD_PATTERN)
        self._special_at = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self._encoder = ChunkEncoder(self._encode_chunks, self.special)
        self._digits = [str(i) for i in range(size)]

    def encode(self, texts) -> Iterator[np.ndarray]:
        return self._encoder.encode(texts)

    def decode(self, ids) -> str:
        """The text of ids, special tokens written out; bytes that are no UTF-8 become U+FFFD."""
        table = self.token_bytes
        return b"".join([table[i] for i in ids]).decode("utf-8", "replace")

    def digits(self, ids) -> str:
        names = self._digits
        return ",".join([names[i] for i in ids])

    def _words_of(self, chunk: str) -> list[str | int]:
        """The words of a chunk, and the ids of special tokens between them."""
        letters = chunk[1:] if chunk[:1] == " " else chunk
        if letters.isalpha():
            return [chunk]
        if letters[:-1].isalpha() and letters[-1] in ".,":
            return [chunk[:-1], chunk[-1]]
        if not any(mark in chunk for mark in self.special):
            return self._words.findall(chunk)
        words: list[str | int] = []
        for part in self._special_at.split(chunk):
            words += [self.special[part]] if part in self.special else self._words.findall(part)
        return words

    def _encode_chunks(self, chunks: list[str]) -> list[bytes]:
        split = [self._words_of(chunk) for chunk in chunks]
        distinct = list({word for words in split for word in words if isinstance(word, str)})
        ids = dict(zip(distinct, self._merge_words(distinct)))
        ids |= {i: np.array([i], dtype=ID_TYPE).tobytes() for i in self.special.values()}
        return [ids[words[0]] if len(words) == 1 else b"".join(map(ids.__getitem__, words)) for words in split]

    def _rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self._keys, keys), len(self._keys) - 1)
        return np.where(self._keys[at] == keys, self._ranks[at], _NO_RANK)

    def _merge_words(self, words: list[str]) -> list[bytes]:
        if not words:
            return []
        raw = [word.encode("utf-8", "replace") for word in words]
        sizes = np.array([len(word) for word in raw])
        symbol = self._byte_id[np.frombuffer(b"".join(raw), dtype=np.uint8)]
        ends = np.cumsum(sizes)
        after = np.arange(1, len(symbol) + 1, dtype=np.int32)
        after[ends - 1] = _END
        before = np.arange(-1, len(symbol) - 1, dtype=np.int32)
        before[ends - sizes] = _END
        alive = np.ones(len(symbol), dtype=bool)

        places: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def enter(at: np.ndarray) -> None:
            ranks = self._rank_of(symbol[at], symbol[after[at]])
            order = np.argsort(ranks, kind="stable")
            ranks, at = ranks[order], at[order]
            last = np.searchsorted(ranks, _NO_RANK)
            cuts = np.flatnonzero(np.diff(ranks[:last])) + 1
            for part, rank in zip(np.split(at[:last], cuts), ranks[np.r_[0, cuts]].tolist() if last else ()):
                if rank not in places:
                    places[rank] = []
                    heapq.heappush(active, rank)
                places[rank].append(part)

        enter(np.flatnonzero(after != _END))
        while active:
            rank = heapq.heappop(active)
            lists = places.pop(rank)
            at = _distinct(np.concatenate(lists)) if len(lists) > 1 else lists[0]
            left, right = self._left[rank], self._right[rank]
            at = at[alive[at] & (symbol[at] == left)]
            follow = after[at]
            at = at[(follow != _END) & (symbol[follow] == right)]
            if left == right and len(at) > 1:
                at = self._every_other(np.sort(at), after)
            if not len(at):
                continue
            gone = after[at]
            alive[gone] = False
            symbol[at] = self._made[rank]
            beyond = after[gone]
            after[at] = beyond
            inner = beyond != _END
            before[beyond[inner]] = at[inner]
            ahead = before[at]
            enter(_distinct(np.concatenate([ahead[ahead != _END], at[inner]])))
        left_over = np.flatnonzero(alive)
        counts = np.bincount(np.searchsorted(ends, left_over, side="right"), minlength=len(words))
        return slices(symbol[left_over], counts)

    @staticmethod
    def _every_other(at: np.ndarray, after: np.ndarray) -> np.ndarray:
        """Of runs of overlapping places (aaa), the first, third and so on."""
        goes_on = np.zeros(len(at), dtype=bool)
        goes_on[1:] = after[at[:-1]] == at[1:]
        index = np.arange(len(at))
        start = np.maximum.accumulate(np.where(goes_on, 0, index))
        return at[(index - start) % 2 == 0]


@lru_cache(maxsize=2)
def _bpe(path: str) -> PairIndexBpe:
    return PairIndexBpe(path)


def encode(text: Column, path: str) -> Column:
    """The ids of a text as ``array<int>``; null and empty texts have none."""

    @F.pandas_udf("array<int>")
    def ids(texts: pd.Series) -> pd.Series:
        return pd.Series([x.astype(np.int32) for x in _bpe(path).encode(texts.fillna("").tolist())], dtype=object)

    return ids(text)


def decode(ids: Column, path: str) -> Column:
    """The text of ``array<int>`` ids; null ids give an empty text."""

    @F.pandas_udf("string")
    def text(rows: pd.Series) -> pd.Series:
        return pd.Series(["" if row is None else _bpe(path).decode(list(row)) for row in rows], dtype=object)

    return text(ids)


def digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Columns ``doc_id, n_tokens, ids_sha256, decoded_sha256``: encode each text, decode the ids, hash both.

    One row per input row; a null text counts as empty. It runs in one pass without moving a row.
    """

    @F.pandas_udf("n_tokens bigint, ids_sha256 string, decoded_sha256 string")
    def both(texts: pd.Series) -> pd.DataFrame:
        bpe, rows = _bpe(path), []
        for at in range(0, len(texts), BATCH):
            for array in bpe.encode(texts.iloc[at : at + BATCH].fillna("").tolist()):
                ids = array.tolist()
                decoded = bpe.decode(ids).encode("utf-8")
                digits = bpe.digits(ids).encode()
                rows.append((len(ids), hashlib.sha256(digits).hexdigest(), hashlib.sha256(decoded).hexdigest()))
        return pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    rows = docs.select(quoted(id_col).alias("doc_id"), both(quoted(text_col)).alias("found"))
    return rows.select("doc_id", "found.n_tokens", "found.ids_sha256", "found.decoded_sha256")
