"""Helpers the operators share: inputs, Arrow mapping, packed arrays."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The only characters that separate words.
SPACES = "[\\x20\\x09-\\x0D]"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def texts(docs: DataFrame) -> DataFrame:
    """(doc_id bigint, text string) with a null text as the empty one."""
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def words(text: str) -> list[bytes]:
    """Lower-cased (A-Z only) words between the fixed separators, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").lower().split()


SLICE_BYTES = 2_000_000


def _slices(batch: pa.RecordBatch, slice_rows: int) -> Iterator[pa.RecordBatch]:
    """Parts of at most ``slice_rows`` rows and about ``SLICE_BYTES`` of text (or one longer row)."""
    if "text" not in batch.schema.names:
        for at in range(0, batch.num_rows, slice_rows):
            yield batch.slice(at, slice_rows)
        return
    size = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        before = size[at - 1] if at else 0
        end = min(at + slice_rows, max(at + 1, int(np.searchsorted(size, before + SLICE_BYTES, "right"))))
        yield batch.slice(at, end - at)
        at = end


def map_rows(df: DataFrame, schema: str, make: Callable[[], Callable], slice_rows: int = 512) -> DataFrame:
    """``mapInArrow`` over small slices: ``make()`` runs once per task and returns
    a function from a slice to an Arrow batch (or None).  A task's memory is
    bounded by one slice."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in batches:
            for part in _slices(batch, slice_rows):
                out = step(part)
                if out is not None and out.num_rows:
                    yield out
    return df.mapInArrow(run, schema)


def batch_of(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def parts_for(rows: int, per_part: int) -> int:
    """Partitions of at most about ``per_part`` rows each."""
    return max(1, math.ceil(rows / per_part))


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


_HELD: dict = {}


def held(key, make: Callable):
    """A worker's large table, kept between tasks until another key asks: a worker
    that serves several operators in turn holds one of them at a time."""
    if key not in _HELD:
        _HELD.clear()
        _HELD[key] = make()
    return _HELD[key]


def text_key():
    """A 64-bit key of a row's own text (null: empty); with the doc_id it names the row."""
    return F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))


def without_rows(docs: DataFrame, decided: DataFrame) -> DataFrame:
    """``docs`` without the rows decided on, all columns unchanged.

    ``decided`` is a stored table (doc_id, text_key, fold): rows of these keys go,
    but with ``fold`` one of the rows that repeat the key stays.  The columns of
    ``docs`` travel as one struct, so none can clash with a key.  Texts move once
    at most; a second time only where repeated rows have to be folded and their
    keys are too many to broadcast.
    """
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("bigint").alias("doc_id"),
                       text_key().alias("text_key"))
    theirs = decided.select(F.col("doc_id").alias("their_id"), F.col("text_key").alias("their_key"), "fold")
    same = F.col("doc_id").eqNullSafe(F.col("their_id")) & (F.col("text_key") == F.col("their_key"))
    out = rows.join(theirs, same, "left_anti").select("row.*")
    fold = theirs.where("fold")
    if fold.isEmpty():
        return out
    return out.unionByName(rows.join(fold, same).dropDuplicates(["doc_id", "text_key"]).select("row.*"))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (multiply and xor-shift), vectorised."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


class WordHashes(dict):
    """Word -> 64-bit hash, remembered; emptied when it holds ``limit`` words
    (a cache bound: results do not depend on it)."""

    def __init__(self, limit: int = 400_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        import xxhash
        if len(self) >= self.limit:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h

    def array(self, ws: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, ws), np.uint64, len(ws))
