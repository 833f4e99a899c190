"""Near-duplicate lines across all documents: one occurrence per connected group stays.

Lines are normalised (lower case, digits as 0, marks dropped, single spaces). Lines equal then are one node. Distinct
lines are linked if they agree in a block of their SimHash fingerprints and their normalised texts are similar enough by
edit distance.

A fingerprint has ``MIN_BLOCKS`` to ``MAX_BLOCKS`` blocks, by the length of the line. The line's features (words; runs of one script
where there are no spaces; for short lines pairs of letters, or letters of scripts without spaces) are dealt to the blocks
by hash, and each block is the SimHash of its own features. So an edit that replaces one feature changes two blocks
at most, wherever it is, and by the pigeonhole principle lines that differ in fewer features than half the blocks agree
in one. One fingerprint of all features has no such property: a changed word flips bits in all its blocks. A line whose
length is near that of another number of blocks has fingerprints of both.

A feature that comes again in a line is another feature (the word and how often it came before), so that blocks are not
ruled by frequent words: replacing one occurrence still takes away one feature and adds one.

Every pair of lines that agree in two blocks is tried, unless other links connect it already. Buckets of at most ``SMALL``
lines with an equal block name all their pairs; a pair stays if it has two such buckets, or one and a larger one.
Pairs that have larger buckets alone meet in the bucket of two blocks at once. Those of at most ``SMALL`` lines name
all their pairs. In the others each member first meets the lowest one, and in those of more than ``TILE``
also two others chosen by a hash that changes from round to round, as long as a round adds ``SETTLED`` of the links. That saves
work only: afterwards, in each bucket whose members are not all connected, all pairs of members that are not are tried,
in tiles of ``TILE`` by ``TILE`` lines.

Whether texts are similar is mostly seen from bounds: words that differ show that the edits are few enough, and pieces of one
text that are far from every stretch of the other that they are not. The others take their edit distance.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate, islice

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wavetrawl.llm.common import ID, TEXT, compact, discard, fresh, id_and_text, materialise, quoted, text_key
from wavetrawl.llm.components import connected_components

SIMILARITY = 0.8
# Fewest blocks; for words and for letters, the most, and the features that a block is meant to have. An edit in a short
# line is a large part of it, so its blocks are smaller.
MIN_BLOCKS = 6
MAX_BLOCKS = (12, 12)
FEATURES_PER_BLOCK = (3, 2)
SMALL = 8
TILE = 256
SETTLED = 0.01

# Lines of up to so many words (letters, in scripts without spaces) have blocks of letters, from so many on, of words.
_SHORT_WORDS, _LONG_WORDS, _SHORT_LETTERS, _LONG_LETTERS = 8, 7, 60, 40

_WORD, _DIGIT = re.compile(r"[^\W_]+"), re.compile(r"\d")
_WIDE = re.compile("[\u3040-\u30ff\u3400-\u9fff]")
_RUN = re.compile("[\u3040-\u309f]+|[\u30a0-\u30ff]+|[\u3400-\u9fff]|[^\\s\u3040-\u30ff\u3400-\u9fff]+")
_MAX_SEEN = 1_000_000
# In tables of letters: not met yet.
_UNMET = 0xFFFFFFFF
# Parts that keys are dealt to by their first bits, and keys that are dealt or sorted at once.
_PART_BITS, _MAX_KEYS = 12, 1 << 19
# Rows of a batch that a task gives out.
_MAX_ROWS = 10_000
_PIECES = "part int, rows binary"
# Features, and fingerprints, that are worked on at once; so few fingerprints have group numbers of 16 bits.
_MAX_FEATURES, _MAX_VIEWS = 1 << 15, 4096
# Classes that pairs of neighbouring letters fall in.
_CLASSES = 512
# Classes of letters, and letters and members of tiles that are worked on at once, when distances are found from below.
_LETTER_CLASSES, _MAX_LETTERS, _MAX_MEMBERS = 64, 1 << 18, 2048
# How many words are passed over in two texts to come to equal ones again.
_WORD_STEPS = ((1, 1), (0, 1), (1, 0), (2, 2), (1, 2), (2, 1), (0, 2), (2, 0), (3, 3), (0, 3), (3, 0))


class _Letters(dict):
    """For ``str.translate``: digits become 0, other characters that are no letters of words a space."""

    def __missing__(self, point: int) -> str:
        letter = chr(point)
        self[point] = "0" if _DIGIT.match(letter) else letter if _WORD.match(letter) else " "
        return self[point]


_LETTERS = _Letters()


def normalise_line(line: str) -> str:
    """Empty if the line has no letter, digit or other word character."""
    return " ".join(line.lower().translate(_LETTERS).split())


class _Points:
    """What :func:`normalise_line` makes of each letter, as a table of code points that is filled as they are met."""

    def __init__(self):
        self.table = np.full(0x110000, _UNMET, dtype="<u4")
        self.table[10] = 10

    def of(self, points: np.ndarray) -> np.ndarray:
        found = self.table[points]
        if (unmet := found == _UNMET).any():
            for point in np.unique(points[unmet]).tolist():
                self.table[point] = ord(_LETTERS[point])
            found = self.table[points]
        return found


@lru_cache(maxsize=1)
def _points() -> _Points:
    return _Points()


def normalised_lines(texts: list[str]) -> list[str]:
    """The lines of all texts one after the other, each as by :func:`normalise_line`."""
    if not texts:
        return []
    points = np.frombuffer("\n".join(texts).lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")
    letters = _points().of(points)
    # A space stays after a letter only, and before one.
    blank = (letters == 32) | (letters == 10)
    letters = letters[(letters != 32) | ~np.concatenate([[True], blank[:-1]])[: len(letters)]]
    letters = letters[(letters != 32) | (np.concatenate([letters[1:], [10]])[: len(letters)] != 10)]
    return letters.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass").split("\n")


def numbered(features: list[str]) -> list[str]:
    """The features, those that occurred before with the number of times they did."""
    if len(set(features)) == len(features):
        return features
    times: dict[str, int] = {}
    result = list(features)
    for i, feature in enumerate(features):
        if feature in times:
            before = times[feature]
            result[i] = f"{feature} {before}"
            times[feature] = before + 1
        else:
            times[feature] = 1
    return result


def feature_lists(line: str) -> list[list[str]]:
    """The features of a normalised line: words, letters, or both where it is neither short nor long; each once."""
    if line.isascii() or not (wide := len(_WIDE.findall(line))):
        words, wide = line.split(" "), 0
    else:
        words = _RUN.findall(line)
    mostly_wide = 2 * wide >= len(line)
    size, long, short = (
        (len(line), _LONG_LETTERS, _SHORT_LETTERS) if mostly_wide else (len(words), _LONG_WORDS, _SHORT_WORDS)
    )
    result = [numbered(words)] if size >= long else [[]]
    if size <= short:
        letters = line.replace(" ", "") if mostly_wide else [line[i : i + 2] for i in range(max(1, len(line) - 1))]
        result.append(numbered(list(letters)))
    return result


@lru_cache(maxsize=10_000)
def block_numbers(n: int, kind: int = 0) -> list[int]:
    """How many blocks a fingerprint of ``n`` words (kind 0) or letters has; two numbers near the length where it changes."""
    steps = {math.floor(math.log2(n / FEATURES_PER_BLOCK[kind]) + shift) for shift in (-0.3, 0, 0.3)}
    return sorted({min(max(2 ** max(step, 0), MIN_BLOCKS), MAX_BLOCKS[kind]) for step in steps})


class BlockPrints:
    """Block fingerprints of lines. The features of a call are hashed once each; nothing is kept between calls."""

    def of(self, lines: list[str]) -> list[list[int]]:
        """For each normalised line its blocks as signed keys; keys of different blocks or numbers of blocks differ."""
        keys, ends = self.flat(lines)
        ends = ends.tolist()
        return [keys[a:b].tolist() for a, b in zip([0, *ends], ends)]

    def flat(self, lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The blocks of all lines one after the other, and where those of each line end."""
        worded, others = [], []
        for i, line in enumerate(lines):
            plain = line.count(" ") >= _SHORT_WORDS and (line.isascii() or not _WIDE.search(line))
            (worded if plain else others).append(i)
        features, sizes, names = self._words_of([lines[i] for i in worded])
        found = [(i, 0, size) for i, size in zip(worded, sizes.tolist())]
        index: dict[str, int] = {}
        numbers: list[int] = []
        for i in others:
            for kind, listed in enumerate(feature_lists(lines[i])):
                if listed:
                    numbers += [index.setdefault(feature, len(index)) for feature in listed]
                    found.append((i, kind, len(listed)))
        features = np.concatenate([features, np.array(numbers, dtype=np.int64) + len(names)])
        hashes, bits = self._hashed(names + [name.encode("utf-8", "replace") for name in index])
        begins = accumulate((size for _, _, size in found), initial=0)
        views = [  # line, kind, blocks, begin, size
            (i, kind, blocks, begin, size)
            for (i, kind, size), begin in zip(found, begins)
            for blocks in block_numbers(size, kind)
        ]
        owners, keys = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
        while views:
            most = bisect_right(list(accumulate(view[4] for view in views[:_MAX_VIEWS])), _MAX_FEATURES)
            some, views = views[: max(most, 1)], views[max(most, 1) :]
            for parts, part in zip((owners, keys), self._prints(hashes, bits, features, some)):
                parts.append(part)
        owner, key = np.concatenate(owners), np.concatenate(keys)
        return key[np.argsort(owner, kind="stable")], np.cumsum(np.bincount(owner, minlength=len(lines)))

    @staticmethod
    def _hashed(names: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The hashes of features, and their bits as one byte each."""
        from xxhash import xxh64_intdigest

        hashes = np.array([xxh64_intdigest(name, 7) for name in names], dtype="<u8")
        octets = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        return hashes, octets.view("<u8")

    @staticmethod
    def _words_of(lines: list[str]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """Of lines whose words are their only features: the numbers of all, how many each line has, and the names."""
        split = pc.split_pattern(pa.array(lines, pa.large_string()), " ")
        sizes = np.diff(split.offsets.to_numpy())
        words = split.flatten().dictionary_encode()
        code, known = words.indices.to_numpy().astype(np.int64), words.dictionary
        _, places, letters = known.buffers()
        places = np.frombuffer(places, dtype=np.int64)[: len(known) + 1].tolist() if len(known) else []
        letters = letters.to_pybytes() if letters else b""
        names = [letters[a:b] for a, b in zip(places, places[1:])]
        # How often the same word came before in the line.
        of = np.repeat(np.arange(len(lines)), sizes) * max(len(names), 1) + code
        order = np.argsort(of, kind="stable")
        starts = np.diff(of[order], prepend=-1) != 0
        index = np.arange(len(of))
        before = np.empty(len(of), dtype=np.int64)
        before[order] = index - np.maximum.accumulate(np.where(starts, index, 0))
        again = np.flatnonzero(before)
        repeats, place = np.unique(code[again] << 32 | before[again], return_inverse=True)
        code[again] = len(names) + place
        names += [b"%b %d" % (names[x >> 32], x & 0xFFFFFFFF) for x in repeats.tolist()]
        return code, sizes, names

    @staticmethod
    def _prints(
        hashes: np.ndarray, bits: np.ndarray, features: np.ndarray, views: list[tuple[int, int, int, int, int]]
    ) -> tuple[np.ndarray, np.ndarray]:
        """Lines and keys of the blocks of some views."""
        line, kind, blocks, begin, size = np.array(views, dtype=np.int64).T
        view = np.repeat(np.arange(len(views)), size)
        feature = features[np.arange(len(view)) + np.repeat(begin - (np.cumsum(size) - size), size)]
        group = view * 16 + (hashes[feature] >> np.uint64(40)).astype(np.int64) % blocks[view]
        # So few groups are sorted digit by digit.
        order = np.argsort(group.astype(np.uint16), kind="stable")
        group, feature = group[order], feature[order]
        starts = np.flatnonzero(np.diff(group, prepend=-1))
        counts = np.diff(starts, append=len(group))
        ones = np.add.reduceat(bits[feature], starts, axis=0).view(np.uint8)
        prints = np.packbits(2 * ones.astype(np.int16) > counts[:, None], axis=1, bitorder="little").view("<u8").ravel()
        for i in np.flatnonzero(counts > 255):
            # A byte does not hold the sums of so many features.
            own = bits[feature[starts[i] : starts[i] + counts[i]]].view(np.uint8)
            prints[i] = np.packbits(2 * own.sum(axis=0, dtype=np.int64) > counts[i], bitorder="little").view("<u8")[0]
        first = group[starts]
        of = first // 16
        salt = (kind[of] << 16 | blocks[of] << 8 | first % 16).astype(np.uint64)
        keys = (prints ^ (salt * np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xD6E8FEB86659FD93)
        keys ^= keys >> np.uint64(32)
        return line[of], keys.view("<i8")


def edit_distance(a: str, b: str, most: int | None = None) -> int:
    """Levenshtein distance by bit vectors (Myers, Hyyro): one step per character of ``b``, all of ``a`` at once.

    Common ends are cut off first. Beyond ``most`` the count stops, and some number above it is given.
    """
    limit = max(len(a), len(b)) if most is None else most
    if abs(len(a) - len(b)) > limit:
        return limit + 1
    for back in (True, False):
        while a and b and (a[-1] == b[-1] if back else a[0] == b[0]):
            sizes = (4096, 256, 16)
            if back:
                same = next((n for n in sizes if len(a) > n < len(b) and a[-n:] == b[-n:]), 1)
                a, b = a[:-same], b[:-same]
            else:
                same = next((n for n in sizes if len(a) > n < len(b) and a[:n] == b[:n]), 1)
                a, b = a[same:], b[same:]
    if not a or not b:
        return max(len(a), len(b))
    place: dict[str, int] = {}
    for i, letter in enumerate(a):
        place[letter] = place.get(letter, 0) | 1 << i
    full, top = (1 << len(a)) - 1, 1 << (len(a) - 1)
    up, down, distance, spare = full, 0, len(a), limit + len(b)
    for letter in b:
        match = place.get(letter, 0)
        diagonal = (((match & up) + up) ^ up) | match | down
        right = down | ~(diagonal | up) & full
        left = up & diagonal
        distance += 1 if right & top else -1 if left & top else 0
        # Each letter that is left can take one off at most.
        spare -= 1
        if distance > spare:
            return limit + 1
        right = (right << 1 | 1) & full
        up = (left << 1) & full | ~(diagonal | right) & full
        down = right & diagonal
    return distance


def _line_rows(docs: DataFrame, packed: bool = False) -> DataFrame:
    """A row ``id, key, no, line, blocks`` per line with a word character; a task gives the blocks of a line once.

    With ``packed``, blocks are bytes, eight a block, which are faster to write and to read.
    """
    given = docs.select(F.col(ID).alias("id"), "key", TEXT)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh64_intdigest

        def bits(flags: np.ndarray) -> pa.Buffer:
            return pa.py_buffer(np.packbits(flags, bitorder="little"))

        prints, seen = BlockPrints(), set()
        for batch in batches:
            # Texts and rows are held in small numbers.
            for at in range(0, batch.num_rows, 512):
                some = batch.slice(at, 512)
                owners, numbers, names, fresh_at, plain = [], [], [], [], []
                texts = some.column(2).to_pylist()
                all_lines = iter(normalised_lines(texts))
                for i, text in enumerate(texts):
                    for no, line in enumerate(islice(all_lines, text.count("\n") + 1)):
                        if line:
                            name = xxh64_intdigest(line.encode("utf-8", "replace"), 0)
                            if name not in seen:
                                seen.add(name)
                                fresh_at.append(len(names))
                                plain.append(line)
                            owners.append(i)
                            numbers.append(no)
                            names.append(name)
                keys, ends = prints.flat(plain)
                sizes, known = np.zeros(len(names), dtype=np.int32), np.zeros(len(names), dtype=bool)
                sizes[fresh_at], known[fresh_at] = np.diff(ends, prepend=0), True
                offsets = np.append(0, np.cumsum(sizes)).astype(np.int32)
                if packed:
                    blocks = pa.Array.from_buffers(pa.binary(), len(known), [bits(known), pa.py_buffer(8 * offsets), pa.py_buffer(keys)])
                else:
                    blocks = pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys), mask=pa.array(~known))
                owner, line = pa.array(owners, pa.int64()), pa.array(np.array(names, dtype=np.uint64).view(np.int64))
                columns = [some.column(0).take(owner), some.column(1).take(owner), pa.array(numbers, pa.int64()), line, blocks]
                yield pa.RecordBatch.from_arrays(columns, ["id", "key", "no", "line", "blocks"])
            if len(seen) > _MAX_SEEN:
                seen.clear()

    kinds = ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in given.schema.fields[:2])
    return given.mapInArrow(rows, f"{kinds}, no bigint, line bigint, blocks {'binary' if packed else 'array<bigint>'}")


def pairs_of_letters(texts: list[str]) -> np.ndarray:
    """For each text, how many of its pairs of neighbouring letters fall in each of ``_CLASSES`` classes.

    An edit makes and ends two such pairs at most, so the counts of texts differ by at most four for each edit.
    """
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int32)
    owner = np.repeat(np.arange(len(texts)), sizes)
    inside = owner[1:] == owner[:-1]
    place = owner[1:] * _CLASSES + ((points[:-1] * 27 + points[1:]) & (_CLASSES - 1))
    counts = np.bincount(place[inside], minlength=len(texts) * _CLASSES).reshape(-1, _CLASSES)
    return np.minimum(counts, 30_000).astype(np.int16)


def least_edits(left: list[str], right: list[str], most: np.ndarray) -> np.ndarray:
    """For each two texts a number that their edit distance, where it is at most ``most``, is not below.

    The left text is cut into pieces of 64 letters, and each piece takes at least its distance to the nearest stretch of
    the right one that begins and ends at most ``most`` letters from its place. All pieces go through the bit vectors
    of :func:`edit_distance` side by side. Letters are told apart by class only, which makes no distance greater.
    """
    sizes, others = (np.fromiter(map(len, texts), np.int64, len(texts)) for texts in (left, right))
    counts = -(-sizes // 64)
    pair = np.repeat(np.arange(len(left)), counts)
    at = 64 * (np.arange(len(pair)) - np.repeat(np.cumsum(counts) - counts, counts))
    size = np.minimum(sizes[pair] - at, 64)
    begin = np.maximum(at - most[pair], 0)
    width = np.maximum(np.minimum(at + size + most[pair], others[pair]) - begin, 0)
    order = np.argsort(-width, kind="stable")
    pair, at, size, begin, width = (values[order] for values in (pair, at, size, begin, width))
    one, two = (
        np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64) % _LETTER_CLASSES
        for texts in (left, right)
    )
    row = np.arange(len(pair)) * _LETTER_CLASSES
    # The letters of a piece stand at bits of their own, so sums set them.
    bit = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    place = np.repeat(np.cumsum(sizes)[pair] - sizes[pair] + at, size) + bit
    matches = np.zeros(len(pair) * _LETTER_CLASSES, dtype=np.uint64)
    np.add.at(matches, np.repeat(row, size) + one[place], np.uint64(1) << bit.astype(np.uint64))
    start = np.cumsum(others)[pair] - others[pair] + begin
    top = np.uint64(1) << (size - 1).astype(np.uint64)
    up, down = np.full(len(pair), ~np.uint64(0)), np.zeros(len(pair), dtype=np.uint64)
    distance, least, unit = size.copy(), size.copy(), np.uint64(1)
    # Pieces with more letters to go through stand before those with fewer.
    for step, n in enumerate(np.searchsorted(-width, -np.arange(width[0] if len(width) else 0), "left").tolist()):
        match = matches[row[:n] + two[start[:n] + step]]
        vertical, below = up[:n], down[:n]
        diagonal = (((match & vertical) + vertical) ^ vertical) | match
        rise, fall = below | ~(diagonal | vertical), vertical & diagonal
        now = distance[:n]
        now += (rise & top[:n]) != 0
        now -= (fall & top[:n]) != 0
        np.minimum(least[:n], now, out=least[:n])
        rise, match = rise << unit, match | below
        up[:n] = fall << unit | ~(match | rise)
        down[:n] = rise & match
    return np.bincount(pair, weights=least, minlength=len(left)).astype(np.int64)


def words_apart(a: str, b: str, most: int) -> int:
    """A number that the edit distance of two texts is not above: what it takes to turn words into words.

    Words are gone through in order, and where they differ the nearest equal ones within three go on. Beyond
    ``most`` the count stops.
    """
    one, two = a.split(" "), b.split(" ")
    i = j = count = 0
    while i < len(one) and j < len(two):
        if one[i] == two[j]:
            i, j = i + 1, j + 1
            continue
        for p, q in _WORD_STEPS:
            if i + p < len(one) and j + q < len(two) and one[i + p] == two[j + q]:
                break
        else:
            p = q = 1
        gone, come = sum(map(len, one[i : i + p])) + p, sum(map(len, two[j : j + q])) + q
        count += max(gone, come) - (1 if p and q else 0)
        if count > most:
            return count
        i, j = i + p, j + q
    return count + sum(map(len, one[i:])) + len(one) - i + sum(map(len, two[j:])) + len(two) - j


def within(a: str, b: str, most: int) -> bool:
    """Whether the edit distance is at most ``most``; it is only worked out where words do not show it."""
    return words_apart(a, b, most) <= most or edit_distance(a, b, most) <= most


def similar_pairs(left: list[str], right: list[str], similarity: float) -> np.ndarray:
    """Whether the edit distance of each two texts is at most their greater length's share beyond ``similarity``."""
    sizes = np.array([(len(a), len(b)) for a, b in zip(left, right)], dtype=np.int64).reshape(-1, 2)
    most = ((1 - similarity) * sizes.max(axis=1) + 1e-9).astype(np.int64)
    result = np.abs(sizes[:, 0] - sizes[:, 1]) <= most
    part = np.arange(len(left)) // 512 + np.cumsum(sizes.sum(axis=1)) // (1 << 20) * len(left)
    for places in np.split(np.arange(len(left)), np.flatnonzero(np.diff(part)) + 1):
        places = places[result[places]]
        one, two = (pairs_of_letters([texts[i] for i in places]) for texts in (left, right))
        result[places] = np.abs(one - two).sum(axis=1, dtype=np.int64) <= 4 * most[places]
    unsure = [i for i in np.flatnonzero(result).tolist() if words_apart(left[i], right[i], int(most[i])) > most[i]]
    unsure = np.array(unsure, dtype=np.int64)
    part = np.cumsum(sizes[unsure].sum(axis=1)) // (2 * _MAX_LETTERS)
    for places in np.split(unsure, np.flatnonzero(np.diff(part)) + 1):
        result[places] = least_edits([left[i] for i in places], [right[i] for i in places], most[places]) <= most[places]
        for i in places[result[places]].tolist():
            result[i] = edit_distance(left[i], right[i], int(most[i])) <= most[i]
    return result


def _similar(left: str, right: str, similarity: float) -> Column:
    @F.pandas_udf("boolean")
    def similar(one: pd.Series, two: pd.Series) -> pd.Series:
        return pd.Series(similar_pairs(one.tolist(), two.tolist(), similarity), dtype=bool)

    return similar(F.col(left), F.col(right))


def _texts_of(wanted: DataFrame, count: int, lines: DataFrame, docs: DataFrame) -> DataFrame:
    """The normalised ``text`` of each ``line`` of ``wanted``, at most ``count``, taken from its first document.

    Texts of documents that hold no line in question stay where they are.
    """
    first = lines.join(wanted, "line").groupBy("line").agg(F.min(F.struct("id", "key", "no")).alias("at"))
    by_doc = first.groupBy("at.id", "at.key").agg(F.collect_list(F.struct(F.col("at.no").alias("no"), "line")).alias("lines"))

    @F.pandas_udf("array<string>")
    def texts_of(texts: pd.Series, numbers: pd.Series) -> pd.Series:
        result = []
        for text, nos in zip(texts, numbers):
            split = text.split("\n")
            result.append([normalise_line(split[no]) for no in nos])
        return pd.Series(result, dtype=object)

    by_doc = materialise(compact(by_doc, count), "wanted-documents")
    held = docs.join(by_doc, docs[ID].eqNullSafe(by_doc["id"]) & (docs["key"] == by_doc["key"]))
    held = held.select(docs["key"], by_doc["id"], "lines", texts_of(TEXT, F.col("lines.no")).alias("texts"))
    zipped = held.select(F.inline(F.arrays_zip(F.col("lines.line").alias("line"), F.col("texts").alias("text"))))
    return materialise(zipped.groupBy("line").agg(F.min("text").alias("text")), "line-texts")


def _among(members: str, fields: str) -> Column:
    """A row ``x, y`` and further ``fields`` of it per pair of an array's members."""
    pairs = f"transform({members}, x -> transform(filter({members}, y -> y.line < x.line), y -> struct({fields})))"
    return F.inline(F.expr(f"flatten({pairs})"))


def _ordered(rows: DataFrame) -> DataFrame:
    """The pairs ``x, y`` of different lines as ``a < b``."""
    return rows.filter("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), *rows.columns[2:])


class _Tile:
    """Members of a tile by length, with what rules pairs out: letters, pairs of letters, slots and known groups.

    With ``across``, only members of different slots are held against each other.
    """

    def __init__(self, roots: list[int], texts: list[str], slots: list[int], across: bool, similarity: float):
        lengths = np.array([len(text) for text in texts])
        self.order = np.argsort(lengths, kind="stable")
        self.texts = [texts[i] for i in self.order.tolist()]
        self.lengths, self.slots, self.across = lengths[self.order], np.array(slots)[self.order], across
        self.group = np.unique(np.array(roots)[self.order], return_inverse=True)[1]
        self.most = ((1 - similarity) * self.lengths + 1e-9).astype(np.int64)
        self.letters = np.zeros((len(texts), 64), dtype=np.int32)
        for i, text in enumerate(self.texts):
            points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
            self.letters[i] = np.bincount(points & 63, minlength=64)
        self.pairs = pairs_of_letters(self.texts)
        # The shortest line that a line can be similar to stands at this place.
        self.begins = np.searchsorted(self.lengths, self.lengths - self.most)

    def candidates(self, i: int) -> np.ndarray:
        """The members before ``i`` that may be similar to it and are not connected to it yet."""
        others = np.arange(self.begins[i], i)
        others = others[(self.group[others] != self.group[i]) & ((self.slots[others] != self.slots[i]) | (not self.across))]
        if len(others):
            apart = np.abs(self.letters[others] - self.letters[i]).sum(axis=1) + self.lengths[i] - self.lengths[others]
            others = others[apart <= 2 * self.most[i]]
            apart = np.abs(self.pairs[others] - self.pairs[i]).sum(axis=1, dtype=np.int64)
            others = others[apart <= 4 * self.most[i]]
        return others

    def link(self, i: int, j: int) -> tuple[int, int] | None:
        """The two members' places if they are similar and not connected; they are from then on."""
        if self.group[j] == self.group[i] or not within(self.texts[i], self.texts[j], int(self.most[i])):
            return None
        self.group[self.group == self.group[j]] = self.group[i]
        return int(self.order[i]), int(self.order[j])


def similar_in_tiles(tiles: Iterator[_Tile]) -> Iterator[tuple[int, int, int]]:
    """Numbers of tiles, and pairs of places in them with similar texts, enough to connect all that are similar or have one root.

    Pairs are ruled out by their lengths, by the letters that one has more often than the other, each of which takes an
    edit, by pairs of letters, and, many pairs of one or several tiles at once, by :func:`least_edits`.
    """

    def links(met: list[tuple[int, _Tile, int, int]]) -> Iterator[tuple[int, int, int]]:
        least = least_edits(
            [tile.texts[i] for _, tile, i, _ in met],
            [tile.texts[j] for _, tile, _, j in met],
            np.array([tile.most[i] for _, tile, i, _ in met], dtype=np.int64),
        )
        for (no, tile, i, j), edits in zip(met, least.tolist()):
            if edits <= tile.most[i] and (found := tile.link(i, j)):
                yield no, *found

    met, letters = [], 0
    for no, tile in enumerate(tiles):
        for i in range(len(tile.texts)):
            others = tile.candidates(i).tolist()
            met += [(no, tile, i, j) for j in others]
            letters += len(others) * len(tile.texts[i])
            if letters > _MAX_LETTERS:
                yield from links(met)
                met, letters = [], 0
    yield from links(met)


def similar_in_tile(
    roots: list[int], texts: list[str], slots: list[int], across: bool, similarity: float
) -> Iterator[tuple[int, int]]:
    """The pairs of places of :func:`similar_in_tiles` for one tile."""
    for _, i, j in similar_in_tiles([_Tile(roots, texts, slots, across, similarity)]):
        yield i, j


def _tile_links(crowd: DataFrame, roots: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """Links ``a, b`` that connect all similar members of a bucket (``key, line, n``) that ``roots`` does not."""
    marked = crowd.join(roots, crowd["line"] == roots["node"], "left").select(
        "key", "line", "n", F.coalesce("root", "line").alias("root")
    )
    marked = materialise(marked, "marked-members")
    mixed = marked.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low < high")
    marked = marked.join(mixed.select("key"), "key")
    tiles = F.ceil(F.col("n") / TILE).cast("int")
    marked = marked.withColumn("slot", F.pmod(F.xxhash64("line", F.lit(0)), tiles).cast("int"))
    places = F.transform(F.sequence(F.lit(0), tiles - 1), lambda q: F.struct(F.least("slot", q), F.greatest("slot", q)))
    placed = marked.join(texts, "line").select("key", "line", "root", "text", "slot", F.explode(places).alias("tile"))
    placed = placed.select("key", F.col("tile.col1").alias("one"), F.col("tile.col2").alias("two"), "line", "root", "text", "slot")

    def links(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def found(held):
            names, tiles = zip(*held)
            return pd.DataFrame([(names[no][i], names[no][j]) for no, i, j in similar_in_tiles(tiles)], columns=["a", "b"], dtype="int64")

        def tile_of(tile, rows):
            names, *given = zip(*rows)
            return names, _Tile(*given, tile[1] != tile[2], similarity)

        now, rows, held, members = None, [], [], 0
        for batch in batches:
            for key, one, two, *row in batch.itertuples(index=False, name=None):
                if (key, one, two) != now:
                    if len(rows) > 1:
                        held.append(tile_of(now, rows))
                        members += len(rows)
                    now, rows = (key, one, two), []
                    if members > _MAX_MEMBERS:
                        yield found(held)
                        held, members = [], 0
                rows.append(row)
        if len(rows) > 1:
            held.append(tile_of(now, rows))
        if held:
            yield found(held)

    by = ["key", "one", "two"]
    dealt = placed.repartition(*by).sortWithinPartitions(*by)
    return materialise(dealt.mapInPandas(links, "a bigint, b bigint"), "tile-links")


def _dealt(rows: np.ndarray, by: int) -> pa.RecordBatch:
    """Rows of numbers as bytes, a row ``part, rows`` for each part by the first bits of column ``by``.

    So few rows are moved, and the bytes as they are.
    """
    part = (rows[:, by].view(np.uint64) >> np.uint64(64 - _PART_BITS)).astype(np.uint16)
    rows, counts = rows[np.argsort(part, kind="stable")], np.bincount(part, minlength=1 << _PART_BITS)
    parts, ends = np.flatnonzero(counts), np.cumsum(counts)
    pieces = [rows[end - n : end].tobytes() for n, end in zip(counts[parts].tolist(), ends[parts].tolist())]
    return pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), pa.array(pieces, pa.binary())], ["part", "rows"])


def _whole_parts(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[np.ndarray]:
    """The rows of numbers of one or several parts at a time, from all batches of :func:`_dealt`."""
    parts: dict[int, list[bytes]] = {}
    for batch in batches:
        for part, rows in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            parts.setdefault(part, []).append(rows)
    while parts:
        pieces, size = [], 0
        while parts and size < 8 * _MAX_KEYS:
            some = parts.popitem()[1]
            pieces += some
            size += sum(map(len, some))
        yield np.frombuffer(b"".join(pieces), dtype=np.int64).reshape(-1, width)


def _places(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The places ``start, start + 1, ...`` of stretches of so many, one after the other."""
    return np.arange(counts.sum()) + np.repeat(starts - (np.cumsum(counts) - counts), counts)


def _starts(*columns: np.ndarray) -> np.ndarray:
    """Whether a row differs from the one before it."""
    first = np.zeros(len(columns[0]), dtype=bool)
    first[:1] = True
    for column in columns:
        first[1:] |= column[1:] != column[:-1]
    return first


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all lists, or of bytes that hold eight for each, and how many each one has."""
    if pa.types.is_binary(column.type):
        return np.frombuffer(b"".join(column.to_pylist()), dtype=np.int64), pc.binary_length(column).to_numpy() // 8
    return column.flatten().to_numpy(), pc.list_value_length(column).to_numpy()


def _dealt_portions(portions: Iterator[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Rows ``line, key`` dealt by key, many at once."""
    held, count = [], 0
    for rows in portions:
        held.append(rows)
        count += len(rows)
        if count > _MAX_KEYS:
            yield _dealt(np.concatenate(held), 1)
            held, count = [], 0
    if count:
        yield _dealt(np.concatenate(held), 1)


def dealt_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``line, keys`` as lines and keys side by side, dealt by key."""

    def rows() -> Iterator[np.ndarray]:
        for batch in batches:
            keys, sizes = _lists(batch.column(1))
            yield np.stack([np.repeat(batch.column(0).to_numpy(), sizes), keys], axis=1)

    return _dealt_portions(rows())


def dealt_twice(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``line, keys`` as lines and hashes of each two of their keys, dealt by hash."""

    def rows() -> Iterator[np.ndarray]:
        for batch in batches:
            keys, sizes = _lists(batch.column(1))
            place = np.arange(len(keys))
            later = np.repeat(np.cumsum(sizes), sizes) - 1 - place
            line = np.repeat(np.repeat(batch.column(0).to_numpy(), sizes), later)
            one, two = np.repeat(keys, later).view(np.uint64), keys[_places(place + 1, later)].view(np.uint64)
            both = (one ^ one >> np.uint64(32)) * np.uint64(0x9E3779B97F4A7C15) + two
            both = (both ^ both >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
            both = (both ^ both >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
            yield np.stack([line, both.view(np.int64)], axis=1)

    return _dealt_portions(rows())


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """Of lines and keys dealt by key: rows ``line, key, n, end`` of keys that ``n > 1`` lines have, ``end`` the lowest.

    What a line gives more than once counts once.
    """
    for rows in _whole_parts(batches, 2):
        line, key = rows.T
        order = np.argsort(key)
        line, key = line[order], key[order]
        first = _starts(key)
        several = ~(first & np.append(first[1:], True))
        line, key = line[several], key[several]
        order = np.lexsort((line, key))
        line, key = line[order], key[order]
        once = _starts(line, key)
        line, key = line[once], key[once]
        starts = np.flatnonzero(_starts(key))
        counts = np.diff(starts, append=len(key))
        n, end = np.repeat(counts, counts), np.repeat(line[starts], counts)
        yield np.stack([line, key, n, end], axis=1)[n > 1]


def shared_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of :func:`_shared`."""
    for rows in _shared(batches):
        for at in range(0, len(rows), _MAX_ROWS):
            columns = [pa.array(np.ascontiguousarray(column)) for column in rows[at : at + _MAX_ROWS].T]
            yield pa.RecordBatch.from_arrays(columns, ["line", "key", "n", "end"])


def shared_by_line(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of :func:`_shared`, dealt by line."""
    for rows in _shared(batches):
        if len(rows):
            yield _dealt(rows[:, :3], 0)


def keys_by_line(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of :func:`shared_by_line`: each line's keys of at most ``SMALL`` lines, and its others in order.

    Lines with one key alone are left out.
    """
    for rows in _whole_parts(batches, 3):
        line, key, n = rows.T
        order = np.lexsort((key, line))
        line, key, large = line[order], key[order], n[order] > SMALL
        starts = np.flatnonzero(_starts(line))
        counts = np.diff(starts, append=len(line))
        stays = np.repeat(counts > 1, counts)
        key, large, starts, counts = key[stays], large[stays], starts[counts > 1], counts[counts > 1]
        lists = []
        for chosen in (~large, large):
            ends = np.append(0, np.cumsum(chosen))[np.append(0, np.cumsum(counts))]
            lists.append(pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(key[chosen])))
        yield from pa.table([pa.array(line[starts]), *lists], ["line", "small", "large"]).to_batches(_MAX_ROWS)


def dealt_small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of :func:`keys_by_line`: rows of numbers ``key, line, count`` of small keys, dealt by key, and ``count`` large keys for each."""


    def portions() -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for batch in batches:
            held.append(batch)
            count += batch.num_rows
            if count > _MAX_KEYS // 8:
                yield pa.concat_batches(held)
                held, count = [], 0
        if held:
            yield pa.concat_batches(held)

    for batch in portions():
        (key, sizes), (large, counts) = map(_lists, batch.columns[1:])
        of = np.repeat(np.arange(len(sizes)), sizes)
        order = np.argsort((key.view(np.uint64) >> np.uint64(64 - _PART_BITS)).astype(np.uint16), kind="stable")
        key, of = key[order], of[order]
        dealt = _dealt(np.stack([key, batch.column(0).to_numpy()[of], counts[of]], axis=1), 0)
        others = large[_places((np.cumsum(counts) - counts)[of], counts[of])]
        held = [np.frombuffer(rows, dtype=np.int64).reshape(-1, 3)[:, 2].sum() for rows in dealt.column(1).to_pylist()]
        pieces = [piece.tobytes() for piece in np.split(others, np.cumsum(held)[:-1])] if held else []
        yield dealt.append_column("large", pa.array(pieces, pa.binary()))


def small_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``a, b, weight`` of the pairs of lines of each small key: weight 2 if they share a large key too, or else 1."""
    parts: dict[int, list[tuple[bytes, bytes]]] = {}
    for batch in batches:
        for part, *pieces in zip(*(column.to_pylist() for column in batch.columns)):
            parts.setdefault(part, []).append(tuple(pieces))
    while parts:
        pieces, size = [], 0
        while parts and size < 2 * _MAX_KEYS:
            some = parts.popitem()[1]
            pieces += some
            size += sum(len(rows) + len(large) for rows, large in some)
        rows, large = (np.frombuffer(b"".join(column), dtype=np.int64) for column in zip(*pieces))
        key, line, count = rows.reshape(-1, 3).T
        order = np.lexsort((line, key))
        key, line, start, count = key[order], line[order], (np.cumsum(count) - count)[order], count[order]
        met = [np.flatnonzero(key[apart:] == key[: len(key) - apart]) for apart in range(1, min(SMALL, len(key)))]
        one = np.concatenate([np.zeros(0, dtype=np.int64), *met])
        two = np.concatenate([np.zeros(0, dtype=np.int64), *(places + apart for apart, places in enumerate(met, 1))])
        # A large key that comes twice for a pair is one of both lines.
        pair = np.concatenate([np.repeat(np.arange(len(one)), count[side]) for side in (one, two)])
        other = np.concatenate([large[_places(start[side], count[side])] for side in (one, two)])
        order = np.lexsort((other, pair))
        pair, other = pair[order], other[order]
        weight = np.ones(len(one), dtype=np.int32)
        weight[pair[~_starts(pair, other)]] = 2
        for at in range(0, len(one), _MAX_ROWS):
            part = slice(at, at + _MAX_ROWS)
            columns = [pa.array(line[one[part]]), pa.array(line[two[part]]), pa.array(weight[part])]
            yield pa.RecordBatch.from_arrays(columns, ["a", "b", "weight"])


def _met_lines(nodes: DataFrame) -> DataFrame:
    """From rows ``line, blocks``, of which some come repeatedly, the columns of :func:`keys_by_line`.

    A task sorts its share of the keys as plain numbers, part by part, and then its share of the lines.
    """
    dealt = nodes.mapInArrow(dealt_keys, _PIECES).repartition("part")
    return dealt.mapInArrow(shared_by_line, _PIECES).repartition("part").mapInArrow(
        keys_by_line, "line bigint, small array<bigint>, large array<bigint>"
    )


def line_roots(nodes: DataFrame, lines: DataFrame, docs: DataFrame, similarity: float) -> DataFrame:
    """The components ``node, root`` of all links between lines (``line, blocks``), of which some may come repeatedly.

    ``lines`` has the place ``id, key, no`` of each one at least once.
    """
    met = materialise(_met_lines(nodes), "met-lines")
    small = F.col("n") <= SMALL
    few = met.mapInArrow(dealt_small, f"{_PIECES}, large binary").repartition("part")
    few = few.mapInArrow(small_pairs, "a bigint, b bigint, weight int")

    both = met.filter("size(large) > 1").select("line", "large").mapInArrow(dealt_twice, _PIECES)
    both = both.repartition("part").mapInArrow(shared_keys, "line bigint, key bigint, n bigint, end bigint")
    crowd = materialise(both, "crowd")
    members = crowd.filter(small & (F.col("n") > 2)).groupBy("key").agg(F.collect_list(F.struct("line")).alias("all"))
    several = members.select(_among("all", "x.line AS x, y.line AS y, 2 AS weight"))
    spokes = crowd.filter(~small | (F.col("n") == 2)).select(F.col("line").alias("x"), F.col("end").alias("y"), F.lit(2).alias("weight"))
    large = crowd.filter(~small).select("key", "line", "n")

    # A bucket of one block counts once, with a larger one too, or of two blocks, twice.
    pairs = few.union(_ordered(several)).union(_ordered(spokes)).groupBy("a", "b").agg(F.sum("weight").alias("weight"))
    tested = materialise(pairs.filter("weight > 1").select("a", "b"), "tried")
    discard(met)
    wanted = tested.select(F.explode(F.array("a", "b")).alias("line")).union(large.select("line")).distinct()
    wanted = materialise(wanted, "wanted-lines")
    texts = _texts_of(wanted, wanted.count(), lines, docs)

    def linked(pairs: DataFrame, label: str) -> DataFrame:
        known = pairs.join(texts.select(F.col("line").alias("a"), F.col("text").alias("ta")), "a")
        known = known.join(texts.select(F.col("line").alias("b"), F.col("text").alias("tb")), "b")
        sizes = F.length("ta"), F.length("tb")
        known = known.filter(F.abs(sizes[0] - sizes[1]) <= (1 - similarity) * F.greatest(*sizes) + 1e-9)
        return materialise(known.filter(_similar("ta", "tb", similarity)).select("a", "b"), label)

    links = linked(tested, "line-links")
    count, turn, huge = links.count(), 0, large.filter(F.col("n") > TILE)
    roots = connected_components(links, "a", "b")
    while True:
        turn += 1
        marked = huge.join(roots, huge["line"] == roots["node"], "left").select(
            "key", "line", F.coalesce("root", "line").alias("root")
        )
        marked = materialise(marked, "marked-lines")
        order = F.struct(F.xxhash64("line", F.lit(turn)).alias("order"), "line", "root")
        # In a bucket whose members are all connected nothing remains to be tried.
        chosen = marked.groupBy("key").agg(
            F.min("root").alias("low"), F.max("root").alias("high"), F.min(order).alias("one"), F.max(order).alias("other")
        ).filter("low < high")
        chosen = materialise(chosen.select("key", F.explode(F.array("one", "other")).alias("pick")), "chosen-lines")
        met = marked.join(chosen, "key").filter(F.col("root") != F.col("pick.root"))
        pairs = _ordered(met.select(F.col("line").alias("x"), F.col("pick.line").alias("y"))).distinct()
        tried = materialise(pairs.join(tested, ["a", "b"], "left_anti"), "tried-more")
        if tried.isEmpty():
            break
        more = linked(tried, "line-links-more")
        new = more.count()
        if new:
            tested = tested.union(tried)
            roots = connected_components(roots.select(F.col("root").alias("a"), F.col("node").alias("b")).union(more), "a", "b")
        if new < max(1, SETTLED * count):
            break
        count += new
    rest = _tile_links(large, roots, texts, similarity)
    discard(crowd, wanted, texts, tested)
    if rest.isEmpty():
        return roots
    # Roots connect the same lines as all links before, and are fewer.
    return connected_components(roots.select(F.col("root").alias("a"), F.col("node").alias("b")).union(rest), "a", "b")


def _dropped_lines(docs: DataFrame, similarity: float) -> DataFrame:
    """Columns ``id, key, drop``: the numbers of the lines to drop, for documents that have any.

    It is written; the tables that lead to it, which hold more than the documents, are deleted.
    """
    # Rows that repeat id and text are one document, so their lines are one occurrence.
    lines = materialise(_line_rows(docs, packed=True), "lines")
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "key", "no")).alias("first")
    groups = materialise(lines.groupBy("line").agg(first, F.count("*").alias("times")), "line-groups")
    places = groups.select("line", "first.id", "first.key", "first.no")
    # The blocks, most of the bytes, stay where they were written.
    roots = line_roots(lines.select("line", "blocks").filter("blocks IS NOT NULL"), places, docs, similarity)
    rooted = materialise(
        groups.join(roots, groups["line"] == roots["node"], "left").select(
            "line", "first", "times", F.coalesce("root", "line").alias("root")
        ),
        "rooted-lines",
    )
    discard(groups)
    # A line that comes once and has no other like it stays without being looked at again.
    kept = rooted.groupBy("root").agg(F.min("first").alias("kept"), F.sum("times").alias("times")).filter("times > 1")
    kept = materialise(kept.select("root", "kept"), "kept-lines")
    decided = materialise(rooted.join(kept, "root").select("line", "kept"), "decided-lines")
    discard(rooted, kept)
    here = F.struct(F.col("id").isNull().alias("none"), "id", "key", "no")
    judged = lines.join(decided, "line").filter(~here.eqNullSafe(F.col("kept")))
    drops = materialise(judged.groupBy("id", "key").agg(F.collect_set("no").alias("drop")), "dropped-lines")
    discard(lines, decided)
    return drops


def _without(text: Column, drop: Column) -> Column:
    """The text without the lines of these numbers; null: with all."""
    left = F.filter(F.split(text, "\n", -1), lambda line, no: ~F.array_contains(drop, no.cast("bigint")))
    return F.when(drop.isNull(), text).otherwise(F.array_join(left, "\n"))


def dedup_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY
) -> DataFrame:
    """The documents with their own columns, and of each group of near-equal lines only the first occurrence.

    First is by id (null last), then text key, then place in the text. Lines without a word character are never
    dropped. A document may end up empty; it stays. Null texts become empty. Rows that repeat id and text count as
    one document and are treated alike. An empty table gives an empty one.
    """
    plain = id_and_text(docs, id_col, text_col).withColumn("key", text_key(F.col(TEXT)))
    own_key, drop_id, drop_key, drop = fresh(docs, "own_key", "drop_id", "drop_key", "drop")
    drops = _dropped_lines(plain, similarity).select(
        F.col("id").alias(drop_id), F.col("key").alias(drop_key), F.col("drop").alias(drop)
    )
    keyed = docs.withColumn(own_key, text_key(quoted(text_col)))
    same = quoted(id_col).eqNullSafe(F.col(drop_id)) & (F.col(own_key) == F.col(drop_key))
    joined = keyed.join(drops, same, "left")
    text = _without(F.coalesce(quoted(text_col), F.lit("")), F.col(drop))
    return joined.withColumn(text_col, text).select(*[quoted(name) for name in docs.columns])
