"""Encode texts through their distinct chunks.

A byte-level BPE with the usual word pattern always starts a new word at a space that stands before a character
other than white space. So a text may be cut before such spaces, each distinct chunk be encoded once, and the
ids be put together again. Texts with a space before white space, or that hold a special token, are one chunk.

Arrow cuts the texts and numbers their distinct chunks, so that only those are looked up. Of a chunk not seen lately that is
letters and a stop, only the letters are encoded: the stop is a word of its own for such a tokenizer.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Chunks remembered between batches, half of them in the newer of two tables. When that one is full it becomes the
# older one, whose chunks are forgotten unless they occur again.
MAX_REMEMBERED = 800_000
# Longer chunks are not remembered.
_LONG = 256

# Characters of the texts worked on at once.
_GROUP = 4_000_000
# Chunks of a text put together at once.
_SLAB = 1 << 18

_DOUBTFUL = re.compile(r" (?=\s|\Z)")
# Latin letters, which are letters by any version of Unicode, and a stop.
_STOPS = (",", ".")
_STOPPED = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+[,.]")

ID_TYPE = np.dtype("<u4")


class ChunkEncoder:
    """Encodes batches of texts. ``encode_new`` gives the ids, as bytes of ``ID_TYPE``, of chunks not seen lately."""

    def __init__(self, encode_new: Callable[[list[str]], list[bytes]], special: Sequence[str]):
        self._encode_new = encode_new
        self._special = tuple(special)
        self._known: dict[str, bytes] = {}  # by the chunk without its leading space
        self._older: dict[str, bytes] = {}

    def _whole(self, text: str) -> bool:
        """Whether the text is one chunk."""
        return " " not in text or _DOUBTFUL.search(text) is not None or any(mark in text for mark in self._special)

    def encode(self, texts: Sequence[str]) -> Iterator[np.ndarray]:
        """The ids of each text. Texts are worked on in groups of at most ``_GROUP`` characters, or one text."""
        group, size = [], 0
        for text in texts:
            if group and size + len(text) > _GROUP:
                yield from self._encode_group(group)
                group, size = [], 0
            group.append(text)
            size += len(text)
        if group:
            yield from self._encode_group(group)

    def _encode_group(self, texts: list[str]) -> Iterator[np.ndarray]:
        cuts = [None if self._whole(text) else text.index(" ") for text in texts]
        try:
            chunks, codes, ends = self._distinct(texts, cuts)
        except UnicodeEncodeError:
            # Arrow takes no single surrogates.
            cuts = [cut if text.isascii() else None for text, cut in zip(texts, cuts)]
            chunks, codes, ends = self._distinct(texts, cuts)
        starts = [text if cut is None else text[:cut] for text, cut in zip(texts, cuts)]
        first, parts = self._ids(list(dict.fromkeys(starts)), chunks)
        ids = np.frombuffer(b"".join(parts), dtype=ID_TYPE)
        sizes = np.fromiter(map(len, parts), np.int64, len(parts)) // ID_TYPE.itemsize
        begins = np.cumsum(sizes) - sizes
        del chunks, parts
        end = 0
        for start, cut in zip(starts, cuts):
            found = [np.frombuffer(first[start], dtype=ID_TYPE)]
            if cut is not None:
                at, end = end, next(ends)
                for low in range(at, end, _SLAB):
                    own = codes[low : min(low + _SLAB, end)]
                    counts = sizes[own]
                    places = np.repeat(begins[own] - np.cumsum(counts) + counts, counts)
                    found.append(ids[places + np.arange(len(places))])
            yield np.concatenate(found)

    @staticmethod
    def _distinct(texts: list[str], cuts: list[int | None]) -> tuple[list[str], np.ndarray, Iterator[int]]:
        """The distinct chunks after the first of texts with a cut; of each text the numbers of its own, and their end."""
        rests = pa.array([text[cut + 1 :] for text, cut in zip(texts, cuts) if cut is not None], pa.large_string())
        split = pc.split_pattern(rests, " ")
        found = split.flatten().dictionary_encode()
        chunks = found.dictionary.to_numpy(zero_copy_only=False).tolist()
        return chunks, found.indices.to_numpy(), iter(split.offsets.to_numpy()[1:].tolist())

    def _ids(self, starts: list[str], chunks: list[str]) -> tuple[dict[str, bytes], list[bytes]]:
        """The ids of beginnings of texts, and of the distinct chunks after them, which are remembered."""
        known, older = self._known, self._older
        parts = list(map(known.get, chunks))
        gaps = [i for i, part in enumerate(parts) if part is None]
        new, stopped = {}, []
        for i in gaps:
            chunk = chunks[i]
            if (part := older.get(chunk)) is not None:
                known[chunk] = part
            elif _STOPPED.fullmatch(chunk):
                stopped.append(chunk)
            else:
                new[chunk] = None
        for word in {chunk[:-1] for chunk in stopped}:
            if word not in known:
                if (part := older.get(word)) is not None:
                    known[word] = part
                else:
                    new[word] = None
        ids = self._encode_new([*map(" ".__add__, new), *_STOPS, *starts])
        known.update(zip(new, ids))
        stops = dict(zip(_STOPS, ids[len(new) :]))
        for chunk in stopped:
            known[chunk] = known[chunk[:-1]] + stops[chunk[-1]]
        for i in gaps:
            parts[i] = known[chunks[i]]
        if len(known) > MAX_REMEMBERED // 2:
            self._older = {chunk: part for chunk, part in known.items() if len(chunk) < _LONG}
            self._known = {}
        return dict(zip(starts, ids[len(new) + len(_STOPS) :])), parts


def slices(ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
    """Consecutive runs of ids as bytes."""
    buffer = ids.astype(ID_TYPE).tobytes()
    ends = (np.cumsum(counts) * ID_TYPE.itemsize).tolist()
    return [buffer[a:b] for a, b in zip([0, *ends], ends)]
