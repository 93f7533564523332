"""Exact duplicates through a sharded cuckoo-filter index of live digests.

A text's key is the SHA-256 of the text without the six ASCII separators.
Keys are dealt to shards by hash; a shard holds a cuckoo filter (four 16-bit
fingerprints a bucket) over its live keys and the keys themselves in content
buckets.  A filter miss proves that a key is new; a hit is verified against
the content bucket, so a false positive changes nothing.  A filter that
overflows is rebuilt at twice the size from the stored keys, and a deletion
removes a fingerprint only after its key was found.

Copies are folded within each Arrow batch before the shuffle, so a text that
makes up a third of all rows reaches its shard as one row per batch.

Defined results: a null text is the empty text; of equal texts the row with
the most code points, then the smallest doc_id stays (rows with a null doc_id
come last); rows that repeat a doc_id are one document and share its decision;
an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import array
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import intermediate_tables, materialise
from .common import SPACES, batch_of, parts_for, shuffle_parts, text_key, without_rows

SLOTS = 4
KEYS_PER_SHARD = 200_000


class CuckooFilter:
    """Partial-key cuckoo hashing over 32-byte digests."""

    MAX_KICKS = 256

    def __init__(self, buckets: int = 64, table: bytes | None = None):
        self.mask = buckets - 1
        self.table = array.array("H", table if table is not None else bytes(2 * SLOTS * buckets))
        self.turn = 0

    @staticmethod
    def fingerprint(digest: bytes) -> int:
        return (digest[0] << 8 | digest[1]) or 1

    def first(self, digest: bytes) -> int:
        return int.from_bytes(digest[2:10], "little") & self.mask

    def other(self, bucket: int, mark: int) -> int:
        return (bucket ^ (mark * 0x5BD1E995 >> 3)) & self.mask

    def _slot(self, bucket: int, mark: int) -> int:
        for s in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
            if self.table[s] == mark:
                return s
        return -1

    def __contains__(self, digest: bytes) -> bool:
        mark, at = self.fingerprint(digest), self.first(digest)
        return self._slot(at, mark) >= 0 or self._slot(self.other(at, mark), mark) >= 0

    def insert(self, digest: bytes) -> bool:
        """False when the filter overflows; it must then be rebuilt."""
        mark, at = self.fingerprint(digest), self.first(digest)
        for bucket in (at, self.other(at, mark)):
            if (s := self._slot(bucket, 0)) >= 0:
                self.table[s] = mark
                return True
        at = self.other(at, mark)
        for _ in range(self.MAX_KICKS):
            self.turn += 1
            s = at * SLOTS + self.turn % SLOTS
            mark, self.table[s] = self.table[s], mark
            at = self.other(at, mark)
            if (free := self._slot(at, 0)) >= 0:
                self.table[free] = mark
                return True
        return False

    def delete(self, digest: bytes) -> None:
        mark, at = self.fingerprint(digest), self.first(digest)
        for bucket in (at, self.other(at, mark)):
            if (s := self._slot(bucket, mark)) >= 0:
                self.table[s] = 0
                return


class ShardIndex:
    """A cuckoo filter over the live keys of one shard and their bucketed content."""

    def __init__(self, buckets: int = 64):
        self.filter = CuckooFilter(buckets)
        self.content: dict[int, dict[bytes, object]] = {}
        self.size = self.false_hits = self.resizes = 0

    def _bucket(self, digest: bytes) -> dict[bytes, object]:
        return self.content.setdefault(digest[10] << 8 | digest[11], {})

    def find(self, digest: bytes):
        """The stored value, or None; the content is read only on a filter hit."""
        if digest not in self.filter:
            return None
        value = self._bucket(digest).get(digest)
        self.false_hits += value is None
        return value

    def insert(self, digest: bytes, value) -> None:
        """Add a key that ``find`` did not return."""
        self._bucket(digest)[digest] = value
        self.size += 1
        if not self.filter.insert(digest):
            self._resize()

    def delete(self, digest: bytes) -> bool:
        if self.find(digest) is None:
            return False
        self.filter.delete(digest)
        del self._bucket(digest)[digest]
        self.size -= 1
        return True

    def keys(self) -> Iterator[bytes]:
        for bucket in self.content.values():
            yield from bucket

    def _resize(self) -> None:
        buckets = self.filter.mask + 1
        while True:
            buckets *= 2
            self.resizes += 1
            self.filter = CuckooFilter(buckets)
            if all(self.filter.insert(k) for k in self.keys()):
                return

    def to_bytes(self) -> bytes:
        keys = sorted(self.keys())
        return struct.pack("<QQ", len(keys), self.filter.mask + 1) + self.filter.table.tobytes() + b"".join(keys)

    @classmethod
    def from_bytes(cls, blob: bytes) -> ShardIndex:
        n, buckets = struct.unpack_from("<QQ", blob)
        out, at = cls(1), 16 + 2 * SLOTS * buckets
        out.filter = CuckooFilter(buckets, blob[16:at])
        for k in range(n):
            key = blob[at + 32 * k:at + 32 * k + 32]
            out._bucket(key)[key] = True
        out.size = n
        return out


def digests(docs: DataFrame, *more) -> DataFrame:
    """(doc_id, digest binary(32), n_cp, *more) of every row, by built-in functions."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                       F.unhex(F.sha2(F.regexp_replace(text, SPACES + "+", ""), 256)).alias("digest"),
                       F.length(text).cast("bigint").alias("n_cp"), *more)


def _better(a, b):
    """The (code points, doc_id) that stays."""
    if a[0] != b[0]:
        return a if a[0] > b[0] else b
    if a[1] is None or b[1] is None:
        return b if a[1] is None else a
    return a if a[1] <= b[1] else b


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Copies within a batch as one row."""
    for batch in batches:
        found: dict[bytes, tuple] = {}
        for doc_id, digest, n_cp in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "digest", "n_cp"))):
            old = found.get(digest)
            found[digest] = (n_cp, doc_id, 1) if old is None else (*_better(old[:2], (n_cp, doc_id)), old[2] + 1)
        if found:
            yield _groups_batch(found)


def _groups_batch(found: dict) -> pa.RecordBatch:
    cps, ids, sizes = zip(*found.values())
    return batch_of(digest=pa.array(list(found), pa.binary()), n_cp=pa.array(cps, pa.int64()),
                    keep_id=pa.array(ids, pa.int64()), group_size=pa.array(sizes, pa.int64()))


_GROUPS = "digest binary, n_cp bigint, keep_id bigint, group_size bigint"


def _index_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One shard's groups: each row is looked up in the filter; only a verified hit joins a group."""
    index = ShardIndex()
    for batch in batches:
        for digest, n_cp, doc_id, size in zip(*(c.to_pylist() for c in batch.columns)):
            group = index.find(digest)
            if group is None:
                index.insert(digest, [n_cp, doc_id, size])
            else:
                group[:2] = _better(group[:2], (n_cp, doc_id))
                group[2] += size
    for bucket in index.content.values():
        if bucket:
            yield _groups_batch(bucket)


def duplicate_groups(rows: DataFrame, keys_per_shard: int = KEYS_PER_SHARD) -> DataFrame:
    """(digest, n_cp, keep_id, group_size), one row per distinct digest of ``digests``."""
    folded = rows.select("doc_id", "digest", "n_cp").mapInArrow(_fold, _GROUPS)
    shards = max(shuffle_parts(rows.sparkSession), parts_for(rows.count(), keys_per_shard))
    return folded.repartition(shards, "digest").mapInArrow(_index_groups, _GROUPS)


def exact_duplicates(docs: DataFrame, keys_per_shard: int = KEYS_PER_SHARD) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) for every row of ``docs``."""
    with intermediate_tables(docs.sparkSession) as keep:
        rows = materialise(digests(docs), "dedup-digests")
        groups = duplicate_groups(rows, keys_per_shard).drop("n_cp")
        # a hot digest is many narrow rows on one side and one on the other; AQE splits it
        out = materialise(
            rows.join(groups, "digest").select(
                "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
                F.lower(F.hex("digest")).alias("text_sha256")), "dedup")
        keep.append(out)
    return out


def drop_duplicates(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` for each group of copies, all columns unchanged.

    A row goes by its own text, not by its doc_id: the row of ``keep_id`` with
    the most code points stays, one of them if it repeats (by the text's key).
    """
    best = (F.col("n_cp") == F.col("most")) & F.col("doc_id").eqNullSafe(F.col("keep_id"))
    with intermediate_tables(docs.sparkSession) as keep:
        rows = materialise(digests(docs, text_key().alias("text_key")), "dedup-digests")
        groups = duplicate_groups(rows).where("group_size > 1").select("digest", F.col("n_cp").alias("most"), "keep_id")
        # a hot digest is many narrow rows on one side and one on the other; AQE splits it
        same = rows.groupBy("digest", "doc_id", "text_key", "n_cp").agg(F.count(F.lit(1)).alias("n"))
        copies = materialise(same.join(groups, "digest").withColumn("best", best), "dedup-copies")
        head = copies.where("best").groupBy("digest").agg(F.min("text_key").alias("head"))
        stays = F.col("best") & (F.col("text_key") == F.col("head"))
        decided = materialise(copies.join(head, "digest").where(~stays | (F.col("n") > 1))
                              .select("doc_id", "text_key", stays.alias("fold")), "dedup-decided")
        keep.append(decided)
    return without_rows(docs, decided)


# --- the index as a table -------------------------------------------------------------------

_SHARDS = "shard int, n_keys bigint, index binary"


def _shard_of(digest, shards: int):
    return F.pmod(F.xxhash64(digest), F.lit(shards)).cast("int")


def _change(key, old, changes):
    """One shard after its changes, in the order of ``seq``; inserting a live key
    or deleting an absent one changes nothing."""
    index = ShardIndex.from_bytes(old.column("index")[0].as_py()) if old.num_rows else ShardIndex()
    rows = sorted(zip(*(changes.column(c).to_pylist() for c in ("seq", "digest", "op"))))
    for _, digest, op in rows:
        if op == "delete":
            index.delete(digest)
        elif index.find(digest) is None:
            index.insert(digest, True)
    return pa.table({"shard": pa.array([key[0].as_py()], pa.int32()), "n_keys": pa.array([index.size], pa.int64()),
                     "index": pa.array([index.to_bytes()], pa.binary())})


def change_index(index: DataFrame | None, changes: DataFrame, shards: int) -> DataFrame:
    """The index table (shard, n_keys, index) after ``changes`` (seq, op, digest).

    ``op`` is ``insert`` or ``delete``.  ``shards`` must be the number the index
    was made with; choose it so that a shard's keys (32 bytes each) fit a task.
    Rows with a null digest or op are ignored.  Repeated insertions of a key are
    folded before the shuffle to the last change of each key.
    """
    spark = changes.sparkSession
    old = index if index is not None else spark.createDataFrame([], _SHARDS)
    last = (changes.where("digest IS NOT NULL AND op IS NOT NULL").groupBy("digest")
            .agg(F.max(F.struct("seq", "op")).alias("_last"))
            .select(F.col("_last.seq").alias("seq"), F.col("_last.op").alias("op"), "digest",
                    _shard_of(F.col("digest"), shards).alias("shard")))
    return old.groupBy("shard").cogroup(last.groupBy("shard")).applyInArrow(_change, _SHARDS)


def _look(key, old, asked):
    index = ShardIndex.from_bytes(old.column("index")[0].as_py()) if old.num_rows else ShardIndex()
    digest = asked.column("digest").to_pylist()
    return pa.table({"digest": pa.array(digest, pa.binary()),
                     "live": pa.array([index.find(d) is not None for d in digest], pa.bool_())})


def probe_index(index: DataFrame, keys: DataFrame, shards: int) -> DataFrame:
    """(digest, live) for each distinct non-null digest of ``keys``."""
    asked = (keys.select("digest").where("digest IS NOT NULL").distinct()
             .withColumn("shard", _shard_of(F.col("digest"), shards)))
    return (index.groupBy("shard").cogroup(asked.groupBy("shard"))
            .applyInArrow(_look, "digest binary, live boolean"))


ORACLE = """
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n_cp,
         sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g')) AS text_sha256
  FROM documents),
g AS (
  SELECT *, count(*) OVER (PARTITION BY text_sha256) AS group_size,
         first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n_cp DESC, doc_id) AS keep_id
  FROM d)
SELECT doc_id, keep_id, CAST(group_size AS BIGINT) AS group_size, doc_id = keep_id AS kept, text_sha256 FROM g
"""
