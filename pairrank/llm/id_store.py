"""Token ids in files: concatenated ids with Elias-Fano coded document boundaries.

Documents are dealt by ranges of doc_id and sorted, so files hold ascending
doc_ids.  A file has one row per segment; a segment is a self-contained image
of at most ``SEGMENT_IDS`` ids (or one longer document):

    header | doc_ids (Elias-Fano) | boundaries (Elias-Fano) | ids (16 or 32 bit)

An Elias-Fano list of n ascending numbers below u keeps the low
``log2(u / n)`` bits of each packed, the high bits in unary, and the place of
every 64th set bit, so ``select(i)`` scans at most a few bytes: about
``2 + log2(u / n)`` bits a number instead of 64.

Defined results: a null text is empty and holds the end id alone; rows with a
null doc_id come first; rows that repeat a doc_id follow each other, ordered by
text; an empty table gives no segments and no rows; extra columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import batch_of, shuffle_parts, texts
from .tokens import encoder

SEGMENT_IDS = 1 << 18
SEGMENT_DOCS = 1 << 16
END_ID = 1
SAMPLE = 64
_HEAD = struct.Struct("<4sBQQQq")


class EliasFano:
    """A non-decreasing list of non-negative integers."""

    def __init__(self, n: int, low_bits: int, low: bytes, high: bytes, samples: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.samples = n, low_bits, low, high, samples

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = values.astype(np.uint64)
        n = len(values)
        if not n:
            return cls(0, 0, b"", b"", np.zeros(0, "<u4"))
        bits = max(0, ((int(values[-1]) + 1) // n).bit_length() - 1)
        low = b""
        if bits:
            grid = (values[:, None] >> np.arange(bits, dtype=np.uint64)[None, :]) & np.uint64(1)
            low = np.packbits(grid.astype(np.uint8).ravel(), bitorder="little").tobytes()
        places = (values >> np.uint64(bits)).astype(np.int64) + np.arange(n)
        unary = np.zeros(int(places[-1]) + 1, np.uint8)
        unary[places] = 1
        return cls(n, bits, low, np.packbits(unary, bitorder="little").tobytes(), places[::SAMPLE].astype("<u4"))

    def _low_of(self, i: int) -> int:
        first = i * self.low_bits
        chunk = int.from_bytes(self.low[first >> 3:(first + self.low_bits + 7) >> 3], "little")
        return (chunk >> (first & 7)) & ((1 << self.low_bits) - 1)

    def select(self, i: int) -> int:
        """The i-th number: from the nearest sample, scan to its set bit."""
        place, left = int(self.samples[i // SAMPLE]), i % SAMPLE
        byte, word = place >> 3, self.high[place >> 3] >> (place & 7) << (place & 7)
        while word.bit_count() <= left:
            left -= word.bit_count()
            byte += 1
            word = self.high[byte]
        for _ in range(left):
            word &= word - 1
        at = (byte << 3) + (word & -word).bit_length() - 1
        return (at - i) << self.low_bits | (self._low_of(i) if self.low_bits else 0)

    def all(self) -> np.ndarray:
        if not self.n:
            return np.zeros(0, np.int64)
        places = np.flatnonzero(np.unpackbits(np.frombuffer(self.high, np.uint8), bitorder="little"))[:self.n]
        out = (places - np.arange(self.n)).astype(np.int64) << self.low_bits
        if self.low_bits:
            grid = np.unpackbits(np.frombuffer(self.low, np.uint8), bitorder="little")
            grid = grid[:self.n * self.low_bits].reshape(self.n, self.low_bits).astype(np.int64)
            out |= grid @ (1 << np.arange(self.low_bits, dtype=np.int64))
        return out

    def to_bytes(self) -> bytes:
        return struct.pack("<QBQQ", self.n, self.low_bits, len(self.low), len(self.high)) + self.low + self.high \
            + self.samples.tobytes()

    @classmethod
    def read(cls, blob: bytes, at: int) -> tuple[EliasFano, int]:
        n, bits, lows, highs = struct.unpack_from("<QBQQ", blob, at)
        at += 25
        low, high = blob[at:at + lows], blob[at + lows:at + lows + highs]
        at += lows + highs
        size = -(-n // SAMPLE)
        return cls(n, bits, low, high, np.frombuffer(blob, "<u4", size, at)), at + 4 * size


def write_segment(doc_ids: list[int | None], ids: list[bytes]) -> bytes:
    """The image of one segment; ``ids`` are unsigned 32-bit ids per document."""
    nulls = sum(d is None for d in doc_ids)
    known = np.array(doc_ids[nulls:], np.int64)
    first = int(known[0]) if len(known) else 0
    flat = np.frombuffer(b"".join(ids), "<u4")
    width = 2 if not len(flat) or int(flat.max()) < 1 << 16 else 4
    bounds = np.concatenate([[0], np.cumsum([len(x) // 4 for x in ids])])
    return _HEAD.pack(b"EFT1", width, len(doc_ids), len(flat), nulls, first) \
        + EliasFano.of((known - first).astype(np.uint64)).to_bytes() + EliasFano.of(bounds).to_bytes() \
        + flat.astype(f"<u{width}").tobytes()


class Segment:
    """Random access to the documents of a segment image."""

    def __init__(self, blob: bytes):
        magic, width, self.n_docs, self.n_ids, self.nulls, self.first = _HEAD.unpack_from(blob)
        if magic != b"EFT1":
            raise ValueError("not a token segment")
        self.docs, at = EliasFano.read(blob, _HEAD.size)
        self.bounds, at = EliasFano.read(blob, at)
        self.flat = np.frombuffer(blob, f"<u{width}", self.n_ids, at)

    def doc_id(self, i: int) -> int | None:
        return None if i < self.nulls else self.first + self.docs.select(i - self.nulls)

    def ids(self, i: int) -> np.ndarray:
        return self.flat[self.bounds.select(i):self.bounds.select(i + 1)].astype("<u4")


def segment_rows(image: bytes) -> dict[str, pa.Array]:
    """The columns doc_id, _at, n_tokens and ids_crc32 of a segment's documents, by selection."""
    s = Segment(image)
    starts = [s.bounds.select(i) for i in range(s.n_docs + 1)]
    return {"doc_id": pa.array([s.doc_id(i) for i in range(s.n_docs)], pa.int64()),
            "_at": pa.array(starts[:-1], pa.int64()),
            "n_tokens": pa.array([b - a for a, b in zip(starts[:-1], starts[1:])], pa.int64()),
            "ids_crc32": pa.array([zlib.crc32(s.flat[a:b].astype("<u4").tobytes())
                                   for a, b in zip(starts[:-1], starts[1:])], pa.int64())}


_SEGMENTS = "part int, seq int, n_docs bigint, n_ids bigint, image binary"


def write_ids(docs: DataFrame, tokenizer: str, path: str, end_id: int = END_ID,
              segment_ids: int = SEGMENT_IDS, segment_docs: int = SEGMENT_DOCS) -> None:
    """Write the ids of every whole text, and ``end_id`` after each, below ``path``."""
    end = struct.pack("<I", end_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part, seq = encoder(tokenizer), TaskContext.get().partitionId(), 0
        doc_ids, ids, size = [], [], 0

        def flush():
            return batch_of(part=pa.array([part], pa.int32()), seq=pa.array([seq], pa.int32()),
                            n_docs=pa.array([len(ids)], pa.int64()), n_ids=pa.array([size], pa.int64()),
                            image=pa.array([write_segment(doc_ids, ids)], pa.binary()))
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text")):
                coded = enc.ids(text.as_py()) + end
                if ids and (size + len(coded) // 4 > segment_ids or len(ids) >= segment_docs):
                    yield flush()
                    doc_ids, ids, size, seq = [], [], 0, seq + 1
                doc_ids.append(doc_id.as_py())
                ids.append(coded)
                size += len(coded) // 4
        if ids:
            yield flush()

    (texts(docs).repartitionByRange(shuffle_parts(docs.sparkSession), "doc_id")
     .sortWithinPartitions("doc_id", "text").mapInArrow(run, _SEGMENTS).write.mode("overwrite").parquet(path))


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files.

    Segment bases are prefix sums of segment sizes: within a range partition by
    a window of its own, over partitions from one row each.
    """
    segments = spark.read.schema(_SEGMENTS).parquet(path)
    sizes = segments.select("part", "seq", "n_ids")
    before = sizes.groupBy("part").agg(F.sum("n_ids").alias("_n")).select(
        "part", F.coalesce(F.sum("_n").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)),
                           F.lit(0)).alias("_before"))
    inside = F.coalesce(F.sum("n_ids").over(W.partitionBy("part").orderBy("seq")
                                            .rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    bases = sizes.withColumn("_inside", inside).join(before, "part").select(
        "part", "seq", (F.col("_inside") + F.col("_before")).cast("bigint").alias("_base"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                found = segment_rows(batch.column("image")[row].as_py())
                n = len(found["doc_id"])
                yield batch_of(part=pa.array([batch.column("part")[row].as_py()] * n, pa.int32()),
                               seq=pa.array([batch.column("seq")[row].as_py()] * n, pa.int32()), **found)
    docs = segments.select("part", "seq", "image").mapInArrow(
        run, "part int, seq int, doc_id bigint, _at bigint, n_tokens bigint, ids_crc32 bigint")
    return docs.join(bases, ["part", "seq"]).select(
        "doc_id", (F.col("_base") + F.col("_at")).alias("start"), "n_tokens", "ids_crc32")


def read_token_arrays(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, ids array<bigint>) of every document in the files."""
    def run(batches):
        for batch in batches:
            for image in batch.column("image"):
                s = Segment(image.as_py())
                bounds = s.bounds.all()
                yield batch_of(doc_id=pa.array([None] * s.nulls + (s.docs.all() + s.first).tolist(), pa.int64()),
                               ids=pa.ListArray.from_arrays(pa.array(bounds, pa.int32()),
                                                            pa.array(s.flat.astype(np.int64))))
    return spark.read.schema(_SEGMENTS).parquet(path).select("image").mapInArrow(run, "doc_id bigint, ids array<bigint>")
