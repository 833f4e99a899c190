"""Token-id files: each document's ids compressed by themselves with one shared zstandard dictionary.

A shard is a table row with three parts: the compressed documents one after the other (``frames``), and the
index arrays that say where each one begins, how many ids it holds and which document it is. It names the
dictionary by its SHA-256; the dictionary is stored once beside the shards. So a short document is read by
unpacking its own few bytes only.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wavetrawl.llm.chunks import ID_TYPE, ChunkEncoder, slices
from wavetrawl.llm.common import ID, TEXT, id_and_text
from wavetrawl.session import scratch_path

# Fixed bounds of the dictionary's training sample: documents, and bytes of each piece of their ids.
SAMPLE_DOCS = 512
PIECE_BYTES = 1 << 14
MAX_PIECES = 2_048
DICTIONARY_BYTES = 1 << 16
LEVEL = 3
# A shard ends with the document that brings it to this many compressed bytes or documents.
SHARD_BYTES = 4 << 20
SHARD_DOCS = 20_000

# Documents encoded together.
BATCH = 4_096

_JOINED, _AT_ONCE = 1 << 16, 1 << 19


class LibraryEncoder:
    """The tokenizers library's ids, each distinct chunk encoded once.

    Chunks that begin with a space are joined to long texts, as calls cost more than words; the ids are dealt
    back to the chunks by the number of bytes that each id stands for.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self._library = Tokenizer.from_file(path)
        self._library.no_truncation()
        self._library.no_padding()
        self._special = [t.content for t in self._library.get_added_tokens_decoder().values()]
        vocab = self._library.get_vocab()
        # In a byte-level vocabulary each letter of a token stands for one byte.
        self._bytes = np.zeros(max(vocab.values()) + 1, dtype=np.int64)
        for token, i in vocab.items():
            self._bytes[i] = len(token)
        self._chunks = ChunkEncoder(self._encode_chunks, self._special)

    def encode(self, texts) -> Iterator[np.ndarray]:
        return self._chunks.encode(texts)

    def _ids(self, texts: list[str]) -> Iterator[np.ndarray]:
        """The ids of each text. As the library holds much more than the ids, it gets ``_AT_ONCE`` characters at once."""
        places = np.cumsum([len(text) for text in texts]) // _AT_ONCE
        cuts = np.flatnonzero(np.diff(places)) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(texts)]):
            for found in self._library.encode_batch_fast(texts[a:b], add_special_tokens=False):
                yield np.array(found.ids, dtype=ID_TYPE)

    def _encode_chunks(self, chunks: list[str]) -> list[bytes]:
        spaced = [i for i, chunk in enumerate(chunks) if chunk[:1] == " " and len(chunk) < _JOINED and not chunk[1:2].isspace()]
        every = "\n".join(chunks)
        marks = [mark for mark in self._special if mark in every]
        if marks:
            spaced = [i for i in spaced if not any(mark in chunks[i] for mark in marks)]
        del every
        result: list[bytes | None] = [None] * len(chunks)
        sizes = np.array([len(chunks[i].encode()) for i in spaced], dtype=np.int64)
        places = (np.cumsum(sizes) - sizes) // _JOINED
        cuts = np.flatnonzero(np.diff(places)) + 1
        bounds = [0, *cuts.tolist(), len(spaced)] if spaced else [0]
        groups = [spaced[a:b] for a, b in zip(bounds, bounds[1:])]
        for group, ids, first in zip(groups, self._ids(["".join([chunks[i] for i in g]) for g in groups]), bounds):
            ends = np.cumsum(sizes[first : first + len(group)])
            owner = np.searchsorted(ends, np.cumsum(self._bytes[ids]))
            for i, part in zip(group, slices(ids, np.bincount(owner, minlength=len(group)))):
                result[i] = part
        others = [i for i, part in enumerate(result) if part is None]
        for i, ids in zip(others, self._ids([chunks[i] for i in others])):
            result[i] = ids.tobytes()
        return result


@lru_cache(maxsize=2)
def _encoder(path: str) -> LibraryEncoder:
    return LibraryEncoder(path)


def _serialized(path: str, texts: pd.Series, end_id: int):
    """Each text's ids and the end id."""
    end = np.array([end_id], dtype=ID_TYPE)
    for at in range(0, len(texts), BATCH):
        for ids in _encoder(path).encode(texts.iloc[at : at + BATCH].tolist()):
            yield np.concatenate([ids, end])


@dataclass(frozen=True)
class Dictionary:
    """Bytes of a zstandard dictionary, possibly none, and their SHA-256."""

    content: bytes

    @property
    def sha256(self) -> str:
        return hashlib.sha256(self.content).hexdigest()

    def _loaded(self):
        import zstandard

        return zstandard.ZstdCompressionDict(self.content) if self.content else None

    def compressor(self):
        import zstandard

        return zstandard.ZstdCompressor(level=LEVEL, dict_data=self._loaded(), write_content_size=True)

    def decompressor(self):
        import zstandard

        return zstandard.ZstdDecompressor(dict_data=self._loaded())


def train_dictionary(docs: DataFrame, vocabulary: str, end_id: int) -> Dictionary:
    """Train on the ids of a bounded sample: the documents whose ids hash lowest, in pieces.

    A corpus too small to train on gives its pieces as they are; an empty one gives no dictionary.
    """
    import zstandard

    sample = docs.select(ID).filter(F.col(ID).isNotNull()).orderBy(F.xxhash64(ID), ID).limit(SAMPLE_DOCS)
    ids = [row[0] for row in sample.collect()]

    def pieces(batches):
        for batch in batches:
            for array in _serialized(vocabulary, batch[TEXT], end_id):
                raw = array.tobytes()
                yield pd.DataFrame({"piece": [raw[i : i + PIECE_BYTES] for i in range(0, len(raw), PIECE_BYTES)]})

    rows = docs.filter(F.col(ID).isin(ids)).limit(4 * SAMPLE_DOCS).mapInPandas(pieces, "piece binary")
    found = [bytes(row[0]) for row in rows.orderBy(F.xxhash64("piece"), "piece").limit(MAX_PIECES).collect()]
    try:
        return Dictionary(zstandard.train_dictionary(DICTIONARY_BYTES, found).as_bytes())
    except (zstandard.ZstdError, ValueError):
        return Dictionary(b"".join(found)[-DICTIONARY_BYTES:])


def write_tokens(docs: DataFrame, path: str, vocabulary: str, end_id: int = 0) -> None:
    """Write ``shards`` and ``dictionary`` below ``path``, documents in ascending order of their ids.

    ``docs`` has ``ID`` and ``TEXT``. Null ids come first; documents of one id follow each other in the order
    of their compressed bytes. Texts are encoded and compressed where they lie; only frames are moved.
    """
    spark = docs.sparkSession
    dictionary = train_dictionary(docs, vocabulary, end_id)
    spark.createDataFrame([(dictionary.sha256, dictionary.content)], "sha256 string, content binary").coalesce(
        1
    ).write.parquet(f"{path}/dictionary")

    def compress(batches):
        compressor = dictionary.compressor()
        for batch in batches:
            counts, frames = [], []
            for array in _serialized(vocabulary, batch[TEXT], end_id):
                counts.append(len(array))
                frames.append(compressor.compress(array.tobytes()))
            yield pd.DataFrame({"id": batch[ID].astype("Int64"), "n_tokens": counts, "frame": frames})

    docs.mapInPandas(compress, "id bigint, n_tokens bigint, frame binary").write.parquet(f"{path}/frames")
    frames = spark.read.parquet(f"{path}/frames")
    order = ["id", F.xxhash64("frame"), "row"]
    placed = frames.withColumn("row", F.monotonically_increasing_id()).repartitionByRange(*order)

    def pack(batches):
        from pyspark import TaskContext

        part, before, held, size = TaskContext.get().partitionId(), 0, [], 0

        def shard():
            ids, counts, frames = zip(*held)
            return pd.DataFrame({
                "part": [part], "start_in_part": [before], "sha256": [dictionary.sha256],
                "doc_ids": [list(ids)], "n_tokens": [list(counts)],
                "offsets": [[0, *accumulate(map(len, frames))]], "frames": [b"".join(frames)],
            })

        for batch in batches:
            ids = [None if pd.isna(i) else int(i) for i in batch["id"]]
            for row in zip(ids, batch["n_tokens"].tolist(), batch["frame"]):
                held.append(row)
                size += len(row[2])
                if size >= SHARD_BYTES or len(held) >= SHARD_DOCS:
                    yield shard()
                    before, held, size = before + sum(row[1] for row in held), [], 0
        if held:
            yield shard()

    kind = (
        "part int, start_in_part bigint, sha256 string, doc_ids array<bigint>, n_tokens array<bigint>,"
        " offsets array<bigint>, frames binary"
    )
    sorted_rows = placed.sortWithinPartitions(*order).select("id", "n_tokens", "frame")
    sorted_rows.mapInPandas(pack, kind).write.parquet(f"{path}/shards")


def read_dictionary(spark: SparkSession, path: str) -> Dictionary:
    row = spark.read.parquet(f"{path}/dictionary").first()
    dictionary = Dictionary(bytes(row["content"]))
    if dictionary.sha256 != row["sha256"]:
        raise ValueError("the dictionary's hash does not match")
    return dictionary


def _unpacked(shard, decompressor, dictionary: Dictionary, wanted=None):
    """Place in the shard and ids of its documents; only those of ``wanted`` ids if given."""
    if shard["sha256"] != dictionary.sha256:
        raise ValueError("a shard names another dictionary")
    frames, offsets = memoryview(shard["frames"]), shard["offsets"]
    for i, doc_id in enumerate(shard["doc_ids"]):
        if wanted is None or doc_id in wanted:
            ids = np.frombuffer(decompressor.decompress(frames[offsets[i] : offsets[i + 1]]), dtype=ID_TYPE)
            if len(ids) != shard["n_tokens"][i]:
                raise ValueError("a document's ids are damaged")
            yield i, ids


def _shards(spark: SparkSession, path: str) -> DataFrame:
    """The shards with the number of ids in all partitions before theirs: one number per partition is collected."""
    shards = spark.read.parquet(f"{path}/shards")
    totals = shards.groupBy("part").agg(F.sum(F.aggregate("n_tokens", F.lit(0).cast("bigint"), lambda a, x: a + x)).alias("n"))
    rows = sorted(totals.collect())
    starts = accumulate((row["n"] for row in rows), initial=0)
    before = spark.createDataFrame([(row["part"], start) for row, start in zip(rows, starts)], "part int, before bigint")
    return shards.join(F.broadcast(before), "part")


def read_tokens(
    spark: SparkSession, path: str, wanted: list[int] | None = None, with_ids: bool = True
) -> DataFrame:
    """Columns ``doc_id, start, n_tokens, ids_crc32`` and ``ids``.

    Of ``wanted`` documents only their own bytes are unpacked.
    """
    dictionary, chosen = read_dictionary(spark, path), None if wanted is None else set(wanted)

    def unpack(batches):
        decompressor = dictionary.decompressor()
        for batch in batches:
            for shard in batch.to_pylist():
                counts = shard["n_tokens"]
                starts = [0, *accumulate(counts)]
                first, docs = shard["before"] + shard["start_in_part"], shard["doc_ids"]
                found = list(_unpacked(shard, decompressor, dictionary, chosen))
                for at in range(0, len(found), 1024):
                    some = found[at : at + 1024]
                    columns = {
                        "doc_id": pa.array([docs[i] for i, _ in some], pa.int64()),
                        "start": pa.array([first + starts[i] for i, _ in some], pa.int64()),
                        "n_tokens": pa.array([counts[i] for i, _ in some], pa.int64()),
                        "ids_crc32": pa.array([zlib.crc32(ids.tobytes()) for _, ids in some], pa.int64()),
                    }
                    if with_ids:
                        columns["ids"] = pa.array([ids.astype(np.int32) for _, ids in some], pa.list_(pa.int32()))
                    yield pa.RecordBatch.from_pydict(columns)

    kind = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + ", ids array<int>" * with_ids
    shards = _shards(spark, path)
    if chosen is not None:
        shards = shards.filter(F.arrays_overlap("doc_ids", F.array(*[F.lit(i).cast("bigint") for i in chosen])))
    return shards.mapInArrow(unpack, kind)


def token_index(
    docs: DataFrame, vocabulary: str, end_id: int = 0, path: str | None = None,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Write the token files of ``docs`` and give, read back from them, each document's place and checksum.

    Null and empty texts hold the end id only. Repeated rows are written as often as they occur.
    """
    rows = id_and_text(docs, id_col, text_col)
    path = path or scratch_path(rows.sparkSession, "tokens")
    write_tokens(rows, path, vocabulary, end_id)
    return read_tokens(rows.sparkSession, path, with_ids=False)
