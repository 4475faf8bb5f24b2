"""Token ids of a corpus as wavelet matrices, one per shard, in compressed files.

``write_shards`` encodes whole texts in ascending doc_id order and writes each run of documents
as one row of a Parquet file: the matrix's bit planes, the rank directory of each plane and the
documents' lengths. ``read_documents`` decodes the files, ``occurrences`` looks a token up in the
planes without decoding, and ``WaveletMatrix`` answers access, rank and select.

Defined results. Null text: empty (the end id only). Null doc_id: before all others. Repeated
doc_ids: each row is a document, ordered by text. Empty table: no shard, no row. Further columns
are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemart.llm.common import slices
from tidemart.llm.encoding import encoder
from tidemart.session import scratch_dir

#: Tokens after which a shard is closed (at the end of a document). A bound on memory.
SHARD_TOKENS = 1 << 19
#: Bits per entry of the rank directory.
BLOCK = 512
#: Places looked up together by select; each unpacks one block.
SELECT_ROWS = 4096
END_ID = 2

SHARD = pa.schema([
    ("part", pa.int32()), ("shard", pa.int32()), ("start", pa.int64()), ("n_tokens", pa.int64()),
    ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())),
    ("planes", pa.list_(pa.binary())), ("ranks", pa.list_(pa.binary())), ("zeros", pa.list_(pa.int64())),
])
SHARD_DDL = (
    "part int, shard int, start long, n_tokens long, doc_ids array<long>, lengths array<long>, "
    "planes array<binary>, ranks array<binary>, zeros array<long>"
)


class WaveletMatrix:
    """Bit planes from the highest bit down. After each plane the sequence is parted: values
    with a 0 first, then those with a 1, each in their old order."""

    def __init__(self, n: int, planes: list[np.ndarray], ranks: list[np.ndarray], zeros: list[int]):
        self.n, self.planes, self.ranks, self.zeros = n, planes, ranks, zeros

    @classmethod
    def build(cls, ids: np.ndarray, bits: int) -> WaveletMatrix:
        planes, ranks, zeros = [], [], []
        rest = ids.astype(np.uint16 if bits <= 16 else np.uint32)
        for level in range(bits - 1, -1, -1):
            ones = (rest >> level) & 1 != 0
            packed = np.packbits(ones)
            pad = -len(packed) % (BLOCK // 8)
            counts = np.bitwise_count(np.pad(packed, (0, pad)).reshape(-1, BLOCK // 8)).sum(1, dtype=np.int64)
            planes.append(packed)
            ranks.append(np.concatenate([[0], np.cumsum(counts)]).astype("<u4"))
            rest = np.concatenate([rest.compress(~ones), rest.compress(ones)])
            zeros.append(int(len(ones) - counts.sum()))
        return cls(len(ids), planes, ranks, zeros)

    def rank1(self, level: int, at: np.ndarray) -> np.ndarray:
        """Ones of a plane before each position."""
        at = np.asarray(at, np.int64)
        plane, block = self.planes[level], at // BLOCK
        out = self.ranks[level][block].astype(np.int64)
        first = block * (BLOCK // 8)
        last = at // 8
        for step in range(BLOCK // 8):  # whole bytes between the block's start and the position
            inside = first + step < last
            if not inside.any():
                break
            out[inside] += np.bitwise_count(plane[first[inside] + step])
        tail = (at % 8).astype(np.uint8)
        some = tail > 0
        out[some] += np.bitwise_count(plane[last[some]] >> (8 - tail[some]).astype(np.uint8))
        return out

    def _bit(self, level: int, at: np.ndarray) -> np.ndarray:
        return (self.planes[level][at // 8] >> (7 - at % 8).astype(np.uint8)) & 1 != 0

    def access(self, at) -> np.ndarray:
        """The ids at the given positions."""
        at = np.atleast_1d(np.asarray(at, np.int64))
        out = np.zeros(len(at), np.int64)
        for level, zeros in enumerate(self.zeros):
            bit, ones = self._bit(level, at), self.rank1(level, at)
            at = np.where(bit, zeros + ones, at - ones)
            out = out * 2 + bit
        return out

    def _interval(self, token: int, start: int, end: int) -> tuple[int, int]:
        """Where the token's occurrences within [start, end) lie below the last plane."""
        for level, zeros in enumerate(self.zeros):
            ones = self.rank1(level, np.array([start, end]))
            if token >> (len(self.zeros) - 1 - level) & 1:
                start, end = zeros + int(ones[0]), zeros + int(ones[1])
            else:
                start, end = start - int(ones[0]), end - int(ones[1])
        return start, end

    def count(self, token: int, start: int = 0, end: int | None = None) -> int:
        """Occurrences of a token within [start, end)."""
        if not 0 <= token < 1 << len(self.zeros):
            return 0
        a, b = self._interval(token, start, self.n if end is None else end)
        return b - a

    def _select(self, level: int, ones: bool, k: np.ndarray) -> np.ndarray:
        """Position of the k-th (from 0) one or zero of a plane."""
        ranks = self.ranks[level].astype(np.int64)
        before = ranks if ones else np.arange(len(ranks)) * BLOCK - ranks
        block = np.searchsorted(before, k, side="right") - 1  # the last block with at most k before it
        rest = k - before[block]
        plane = np.pad(self.planes[level], (0, -len(self.planes[level]) % (BLOCK // 8))).reshape(-1, BLOCK // 8)
        out = np.empty(len(k), np.int64)
        for a, b in slices(len(k), SELECT_ROWS):
            bits = np.unpackbits(plane[block[a:b]], axis=1) == ones
            place = (np.cumsum(bits, axis=1, dtype=np.int16) > rest[a:b, None]).argmax(axis=1)
            out[a:b] = block[a:b] * BLOCK + place
        return out

    def select(self, token: int, start: int = 0, end: int | None = None) -> np.ndarray:
        """Positions of all occurrences of a token within [start, end), ascending."""
        if not 0 <= token < 1 << len(self.zeros):
            return np.zeros(0, np.int64)
        at = np.arange(*self._interval(token, start, self.n if end is None else end))
        for level in range(len(self.zeros) - 1, -1, -1):
            if not len(at):
                break
            one = bool(token >> (len(self.zeros) - 1 - level) & 1)
            at = self._select(level, one, at - self.zeros[level] * one)
        return at

    def decode(self) -> np.ndarray:
        """All ids in order: undo the parting plane by plane, from the last."""
        ids = np.zeros(self.n, np.uint16 if len(self.zeros) <= 16 else np.uint32)
        for level in range(len(self.zeros) - 1, -1, -1):
            ones = np.unpackbits(self.planes[level], count=self.n).view(bool)
            out = np.empty_like(ids)
            out[~ones] = ids[: self.zeros[level]]
            out[ones] = ids[self.zeros[level] :] | ids.dtype.type(1 << (len(self.zeros) - 1 - level))
            ids = out
        return ids.astype("<u4")


def _shard(part: int, number: int, start: int, doc_ids: list, lengths: list[np.ndarray], parts: list[np.ndarray], bits: int) -> pa.RecordBatch:
    matrix = WaveletMatrix.build(np.concatenate(parts), bits)
    return pa.RecordBatch.from_pylist([{
        "part": part, "shard": number, "start": start, "n_tokens": matrix.n, "doc_ids": doc_ids,
        "lengths": np.concatenate(lengths), "planes": [p.tobytes() for p in matrix.planes],
        "ranks": [r.tobytes() for r in matrix.ranks], "zeros": matrix.zeros,
    }], schema=SHARD)


def matrix_of(row: dict) -> WaveletMatrix:
    return WaveletMatrix(
        row["n_tokens"], [np.frombuffer(p, np.uint8) for p in row["planes"]],
        [np.frombuffer(r, "<u4") for r in row["ranks"]], row["zeros"],
    )


def write_shards(docs: DataFrame, tokenizer: str, path: str, end_id: int = END_ID, shard_tokens: int = SHARD_TOKENS) -> None:
    """Encode ``docs(doc_id, text)`` and write the shards, in ascending doc_id order, to ``path``."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer, joined=True)
        bits = max(1, int(max(end_id, enc.tokenizer.get_vocab_size() - 1)).bit_length())
        part, number, start, held = TaskContext.get().partitionId(), 0, 0, 0
        doc_ids, lengths, parts = [], [], []
        for batch in batches:
            names, a = batch.column(0).to_pylist(), 0
            for ids, sizes in enc.encode_column(batch.column(1), end_id):
                ends, b, at = np.cumsum(sizes), 0, 0
                while b < len(ends):  # as far as the document that fills the shard
                    c = int(np.searchsorted(ends, at + shard_tokens - held)) + 1
                    to, full = int(ends[min(c, len(ends)) - 1]), c <= len(ends)
                    doc_ids += names[a + b : a + min(c, len(ends))]
                    lengths.append(sizes[b:c])
                    parts.append(ids[at:to])
                    held += to - at
                    b, at = c, to
                    if full:
                        yield _shard(part, number, start, doc_ids, lengths, parts, bits)
                        number, start, held, doc_ids, lengths, parts = number + 1, start + held, 0, [], [], []
                a += len(ends)
        if parts:
            yield _shard(part, number, start, doc_ids, lengths, parts, bits)

    ordered = docs.select(F.col("doc_id").cast("long"), "text").repartitionByRange(F.col("doc_id")).sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(build, SHARD_DDL).write.option("compression", "zstd").parquet(path)


def part_starts(shards: DataFrame) -> DataFrame:
    """Tokens before each range partition: one row per partition, so one task can add them up."""
    totals = shards.groupBy("part").agg(F.sum("n_tokens").alias("part_tokens"))
    before = F.sum("part_tokens").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    return totals.select("part", F.coalesce(before, F.lit(0)).alias("part_start"))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Decode all shards: doc_id, start, n_tokens and the crc32 of each document's ids."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                ids = matrix_of(row).decode()
                ends = np.cumsum(row["lengths"])
                starts = ends - np.array(row["lengths"], np.int64)
                crcs = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["part"]] * len(ends), pa.int32()), pa.array(row["doc_ids"], pa.int64()),
                     pa.array(starts + row["start"]), pa.array(row["lengths"], pa.int64()), pa.array(crcs, pa.int64())],
                    ["part", "doc_id", "at", "n_tokens", "ids_crc32"],
                )

    shards = spark.read.schema(SHARD_DDL).parquet(path)
    docs = shards.mapInArrow(decode, "part int, doc_id long, at long, n_tokens long, ids_crc32 long")
    return docs.join(part_starts(shards), "part").select(
        "doc_id", (F.col("at") + F.col("part_start")).alias("start"), "n_tokens", "ids_crc32"
    )


def occurrences(spark: SparkSession, path: str, tokens: list[int]) -> DataFrame:
    """Every place of the given tokens, by select on the planes: token, doc_id, position."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                matrix, ends = matrix_of(row), np.cumsum(row["lengths"])
                starts, ids = ends - np.array(row["lengths"], np.int64), np.array(row["doc_ids"], object)
                for token in tokens:
                    at = matrix.select(token)
                    which = np.searchsorted(ends, at, side="right")
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([token] * len(at), pa.int64()), pa.array(ids[which].tolist(), pa.int64()),
                         pa.array(at - starts[which], pa.int64())], ["token", "doc_id", "position"],
                    )

    return spark.read.schema(SHARD_DDL).parquet(path).mapInArrow(find, "token long, doc_id long, position long")


def token_index(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Write the corpus as wavelet shards below the shared folder and read it back."""
    path = scratch_dir(docs.sparkSession, "wavelet")
    write_shards(docs, tokenizer, path)
    return read_documents(docs.sparkSession, path)
