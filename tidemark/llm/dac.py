"""Token-id files of directly addressable codes.

A shard holds the ids of consecutive documents. Ids are cut into chunks of
``CHUNK_BITS`` bits, the low chunk first. Level 0 holds the low chunk of every id;
a bitmap says which ids go on, and level 1 holds the next chunk of those alone, and so
on. A rank directory beside each bitmap counts the set bits before every block, so
the place of token i on the next level is one look-up and one short count: any token
can be read without decoding others.

Files are Parquet tables with one row per shard: its place in the order, the ids and
lengths of its documents, and the codes as one binary value laid out as

    uint32 levels, uint32 0; per level: uint64 chunks;
    per level: the chunks, 1 byte each, padded to 8; the bitmap, 1 bit each, padded
    to 8 bytes; the rank directory, uint32 per ``BLOCK`` bits, padded to 8

all little-endian. The last level has no bitmap and directory. So files are written,
committed, listed and pruned by Spark on any store that it reads.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles, TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    IntegerType,
    LongType,
    StructField,
    StructType,
)
from tokenizers import Tokenizer

from tidemark.llm import words
from tidemark.llm.common import shipped, slices, texts_of
from tidemark.sources import stored

CHUNK_BITS = 8
BLOCK = 512
END_ID = 2
# Ids after which a shard is closed; a longer document is whole in a shard of its own.
SHARD_TOKENS = 1 << 18
# Pieces whose ids a worker remembers.
REMEMBERED = 1 << 19


def _padded(data: np.ndarray) -> bytes:
    raw = data.tobytes()
    return raw + bytes(-len(raw) % 8)


def pack(ids: np.ndarray) -> bytes:
    """The codes of non-negative ids below 2^32."""
    rest, levels = np.asarray(ids, np.uint32), []
    while True:
        chunk, more = (rest & 0xFF).astype(np.uint8), rest >> CHUNK_BITS
        on = more > 0
        levels.append((chunk, on))
        if not on.any():
            break
        rest = more[on]
    parts = [np.array([len(levels), 0], np.uint32).tobytes(), np.array([len(c) for c, _ in levels], np.uint64).tobytes()]
    for depth, (chunk, on) in enumerate(levels):
        parts.append(_padded(chunk))
        if depth + 1 < len(levels):
            blocks = np.add.reduceat(on, np.arange(0, len(on), BLOCK), dtype=np.int64)
            parts.append(_padded(np.packbits(on, bitorder="little")))
            parts.append(_padded((np.cumsum(blocks) - blocks).astype(np.uint32)))
    return b"".join(parts)


@dataclass
class Codes:
    """Views into packed codes; nothing is decoded on opening."""

    chunks: list[np.ndarray]
    bitmaps: list[np.ndarray]
    ranks: list[np.ndarray]

    @classmethod
    def over(cls, data: bytes) -> Codes:
        block = np.frombuffer(data, np.uint8)
        levels = int(block[:4].view(np.uint32)[0])
        sizes = block[8 : 8 + 8 * levels].view(np.uint64).astype(np.int64).tolist()
        at, found = 8 + 8 * levels, cls([], [], [])
        for depth, size in enumerate(sizes):
            found.chunks.append(block[at : at + size])
            at += size + -size % 8
            if depth + 1 < levels:
                octets, blocks = -(-size // 8), -(-size // BLOCK)
                found.bitmaps.append(block[at : at + octets])
                at += octets + -octets % 8
                found.ranks.append(block[at : at + 4 * blocks].view(np.uint32))
                at += 4 * blocks + -(4 * blocks) % 8
        return found

    def __len__(self) -> int:
        return len(self.chunks[0])

    def token(self, at: int) -> int:
        """The id at one position, by one rank per level."""
        value = 0
        for depth, chunk in enumerate(self.chunks):
            value |= int(chunk[at]) << CHUNK_BITS * depth
            if depth == len(self.bitmaps) or not self.bitmaps[depth][at >> 3] >> (at & 7) & 1:
                return value
            block = at // BLOCK
            inside = self.bitmaps[depth][block * BLOCK // 8 : (at >> 3) + 1].copy()
            inside[-1] &= (1 << (at & 7)) - 1
            at = int(self.ranks[depth][block]) + int(np.bitwise_count(inside).sum())
        return value

    def all(self) -> np.ndarray:
        """Every id, level by level."""
        values = self.chunks[0].astype(np.uint32)
        on = np.arange(len(values))
        for depth, bitmap in enumerate(self.bitmaps):
            on = on[np.unpackbits(bitmap, count=len(on), bitorder="little").view(bool)]
            values[on] |= self.chunks[depth + 1].astype(np.uint32) << np.uint32(CHUNK_BITS * (depth + 1))
        return values


def _grown(array: np.ndarray, size: int) -> np.ndarray:
    """The array, or a copy with room for ``size`` values and as many again."""
    if size <= len(array):
        return array
    wider = np.empty(2 * size, array.dtype)
    wider[: len(array)] = array
    return wider


class LibraryEncoder:
    """The ``tokenizers`` library over many texts, each distinct piece encoded once.

    Pieces are encoded by the library as it would inside their text. The ids of all
    known pieces lie in one array; a piece's number leads to where its ids begin and
    how many there are. The first ``REMEMBERED`` pieces stay known, further ones are
    dropped after the texts that brought them.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.specials = tuple(token.content for token in added)
        self.known: dict[bytes, int] = {}
        self.size = 0
        self.pool = np.empty(1 << 16, np.uint32)
        self.begin = np.zeros(1 << 14, np.int64)

    def _add(self, words: list[bytes]) -> None:
        """Encode new pieces and put their ids behind the known ones."""
        encoded = self.tokenizer.encode_batch_fast([word.decode() for word in words], add_special_tokens=False)
        fresh = [encoding.ids for encoding in encoded]
        size, start = self.size, int(self.begin[self.size])
        ends = start + np.cumsum([len(ids) for ids in fresh])
        self.begin = _grown(self.begin, size + len(words) + 1)
        self.begin[size + 1 : size + len(words) + 1] = ends
        self.pool = _grown(self.pool, int(ends[-1]))
        self.pool[start : ends[-1]] = np.fromiter(chain.from_iterable(fresh), np.uint32, int(ends[-1]) - start)
        self.known.update(zip(words, range(size, size + len(words)), strict=True))
        self.size += len(words)

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, bounds): text i has ``ids[bounds[i]:bounds[i + 1]]``."""
        pieces = words.split(texts, self.specials)
        missing = [word for word in pieces.words if word not in self.known]
        if missing:
            self._add(missing)
        numbers = np.fromiter(map(self.known.__getitem__, pieces.words), np.int64, len(pieces.words))
        if self.size > REMEMBERED:
            for word in missing[REMEMBERED - self.size :]:
                del self.known[word]
            self.size = REMEMBERED
        begin = self.begin[numbers][pieces.codes]
        lengths = self.begin[numbers + 1][pieces.codes] - begin
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.pool[np.repeat(begin - (ends - lengths), lengths) + np.arange(total)]
        return ids, np.concatenate(([0], ends))[pieces.at]


@lru_cache(maxsize=2)
def library_encoder(path: str) -> LibraryEncoder:
    return LibraryEncoder(path)


def _id_type(docs: DataFrame):
    return docs.schema["doc_id"].dataType


def write(docs: DataFrame, path: str, end_id: int = END_ID) -> DataFrame:
    """Encode all documents and store them as shards in ascending doc_id order; the stored table.

    Columns: part, shard (place in the order), doc_ids, n_tokens (per document, with
    the end id), codes. Null texts count as empty, so every document has at least its
    end id. No id comes first; rows that share an id stand in text order, rows that
    repeat one after another. An empty table gives no shards. Other columns aren't read.
    Executors get the file at ``path`` from the driver.
    """
    tokenizer = shipped(docs.sparkSession, path)
    ordered = docs.select("doc_id", "text").repartitionByRange(F.col("doc_id").asc_nulls_first())
    ordered = ordered.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
    kind = _id_type(docs)
    arrow_kind = pa.int64() if kind == LongType() else None

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, shard = TaskContext.get().partitionId(), 0
        held: list[tuple[list, np.ndarray, np.ndarray]] = []

        def close() -> pa.RecordBatch:
            names = [name for ids, _, _ in held for name in ids]
            sizes = np.concatenate([size for _, size, _ in held])
            codes = pack(np.concatenate([ids for _, _, ids in held]))
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([part], pa.int32()),
                    pa.array([shard], pa.int32()),
                    pa.array([names], pa.list_(arrow_kind) if arrow_kind else None),
                    pa.array([sizes.tolist()], pa.list_(pa.int64())),
                    pa.array([codes], pa.binary()),
                ],
                ["part", "shard", "doc_ids", "n_tokens", "codes"],
            )

        for batch in slices(batches):
            ids, bounds = library_encoder(SparkFiles.get(tokenizer))(texts_of(batch))
            sizes = np.diff(bounds) + 1
            with_end = np.insert(ids, bounds[1:], end_id)
            held.append((batch.column("doc_id").to_pylist(), sizes, with_end))
            if sum(len(ids) for _, _, ids in held) >= SHARD_TOKENS:
                yield close()
                held, shard = [], shard + 1
        if held:
            yield close()

    schema = StructType(
        [
            StructField("part", IntegerType()),
            StructField("shard", IntegerType()),
            StructField("doc_ids", ArrayType(kind)),
            StructField("n_tokens", ArrayType(LongType())),
            StructField("codes", BinaryType()),
        ]
    )
    return stored(ordered.mapInArrow(run, schema), "token-files")


def read(files: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files.

    ``start`` is the number of ids before the document. Sums run per part, a short
    row each, then inside the part; the codes themselves are not shuffled. Rows that
    repeat have places of their own; no shards give no rows.
    """
    kind = files.schema["doc_ids"].dataType.elementType

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1)
                ids = Codes.over(row.column("codes")[0].as_buffer().to_pybytes()).all().astype("<u4")
                names, sizes = row.column("doc_ids").flatten(), row.column("n_tokens").flatten()
                ends = np.cumsum(sizes.to_numpy())
                starts = ends - sizes.to_numpy()
                crc = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                same = [pa.array([row.column(name)[0].as_py()] * len(crc), pa.int32()) for name in ("part", "shard")]
                yield pa.RecordBatch.from_arrays(
                    [*same, names, pa.array(starts), sizes, pa.array(crc, pa.int64())],
                    ["part", "shard", "doc_id", "inside", "n_tokens", "ids_crc32"],
                )

    schema = StructType(
        [
            StructField("part", IntegerType()),
            StructField("shard", IntegerType()),
            StructField("doc_id", kind),
            StructField("inside", LongType()),
            StructField("n_tokens", LongType()),
            StructField("ids_crc32", LongType()),
        ]
    )
    rows = files.mapInArrow(run, schema)
    total = F.aggregate("n_tokens", F.lit(0).cast("bigint"), lambda a, b: a + b)
    shards = files.select("part", "shard", total.alias("words"))
    parts = shards.groupBy("part").agg(F.sum("words").alias("words"))
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("words").over(ahead), F.lit(0)).alias("part_start"))
    inside = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = shards.withColumn("shard_start", F.coalesce(F.sum("words").over(inside), F.lit(0))).join(parts, "part")
    offsets = offsets.select("part", "shard", (F.col("part_start") + F.col("shard_start")).alias("before"))
    return rows.join(offsets, ["part", "shard"]).select(
        "doc_id", (F.col("before") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32"
    )
