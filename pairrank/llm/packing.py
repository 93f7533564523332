"""Packing documents into training sequences by minimum bin slack.

A document's ids (and an end id) are cut into pieces of the sequence length;
what is left over at its end is one shorter piece.  Pieces are dealt evenly
into groups of about ``GROUP_PIECES``; a group holds only (document, start,
length) rows and is packed on its counts per length.  Each sequence is opened
with the longest piece left; a bitset subset-sum over the remaining lengths,
longest first and with their multiplicities, finds the multiset that fills the
rest most closely, the choice is traced back to counts per length, and the
pattern is repeated as often as the counts allow.

Defined results: a null text is empty and is its end id alone; rows that repeat
a doc_id are packed each by itself; a null doc_id stays null; an empty table
gives no pieces; extra columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import intermediate_tables, materialise
from .common import batch_of, map_rows, parts_for, texts
from .tokens import encoder

SEQUENCE = 2048
END_ID = 1
GROUP_PIECES = 16_384

_PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"


def token_pieces(docs: DataFrame, tokenizer: str, sequence: int = SEQUENCE, end_id: int = END_ID,
                 with_ids: bool = False) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens[, ids]) of every whole text,
    cut at multiples of ``sequence``; ``ids`` are unsigned 32-bit little-endian."""
    end, step_bytes = struct.pack("<I", end_id), 4 * sequence

    def make():
        enc = encoder(tokenizer)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows, blobs = [], []
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text")):
                doc_id, ids = doc_id.as_py(), enc.ids(text.as_py()) + end
                for at in range(0, len(ids), step_bytes):
                    piece = ids[at:at + step_bytes]
                    rows.append((doc_id, at // 4, len(piece) // 4, zlib.crc32(piece), len(ids) // 4))
                    if with_ids:
                        blobs.append(piece)
            columns = [pa.array(c, pa.int64()) for c in zip(*rows)]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            out = dict(zip(names, columns))
            return batch_of(**out, **({"ids": pa.array(blobs, pa.binary())} if with_ids else {}))
        return step
    return map_rows(texts(docs), _PIECES + ", ids binary" * with_ids, make)


def closest_fill(lengths: list[int], counts: dict[int, int], room: int) -> dict[int, int]:
    """Length -> how many, with the largest sum up to ``room``.

    ``lengths`` ascend.  Bit s of ``sums`` says that sum s can be reached; a
    multiplicity is added in powers of two and a rest, and the search ends as
    soon as the room can be filled exactly.
    """
    sums, full, taken = 1, (2 << room) - 1, []
    for k in range(bisect_right(lengths, room) - 1, -1, -1):
        length = lengths[k]
        left, times = min(counts[length], room // length), 1
        while left:
            times = min(times, left)
            taken.append((length, times, sums))
            sums |= (sums << (length * times)) & full
            left -= times
            times *= 2
        if sums >> room & 1:
            break
    target, chosen = sums.bit_length() - 1, {}
    for length, times, before in reversed(taken):
        if not before >> target & 1:
            chosen[length] = chosen.get(length, 0) + times
            target -= length * times
    return chosen


def pack_lengths(counts: dict[int, int], sequence: int = SEQUENCE) -> list[tuple[list[int], int]]:
    """Patterns (lengths, times) that use up ``counts`` (of lengths up to ``sequence``)."""
    counts = {length: n for length, n in counts.items() if n}
    lengths, patterns = sorted(counts), []
    while lengths:
        longest = lengths[-1]
        counts[longest] -= 1
        if not counts[longest]:
            lengths.pop()
        chosen = closest_fill(lengths, counts, sequence - longest) if longest < sequence else {}
        counts[longest] = counts.get(longest, 0) + 1
        need = dict(chosen)
        need[longest] = need.get(longest, 0) + 1
        times = min(counts[length] // n for length, n in need.items())
        patterns.append(([length for length, n in sorted(need.items(), reverse=True) for _ in range(n)], times))
        for length, n in need.items():
            counts[length] -= n * times
            at = bisect_left(lengths, length)
            held = at < len(lengths) and lengths[at] == length
            if counts[length] and not held:
                lengths.insert(at, length)
            elif not counts[length] and held:
                lengths.pop(at)
    return patterns


def _pack_group(sequence: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = [b for b in batches if b.num_rows]
        if not table:
            return
        group = pa.Table.from_batches(table)
        length = group.column("length").to_numpy()
        order = np.argsort(length, kind="stable")
        found, first, n = np.unique(length[order], return_index=True, return_counts=True)
        next_of = {int(a): int(b) for a, b in zip(found, first)}
        rows, ids, offsets, sid = [], [], [], TaskContext.get().partitionId() << 32
        for pattern, times in pack_lengths({int(a): int(b) for a, b in zip(found, n)}, sequence):
            for _ in range(times):
                at = 0
                for size in pattern:
                    rows.append(order[next_of[size]])
                    next_of[size] += 1
                    ids.append(sid)
                    offsets.append(at)
                    at += size
                sid += 1
        out = group.take(pa.array(rows)).combine_chunks()
        out = out.append_column("sequence_id", pa.array(ids, pa.int64()))
        yield from out.append_column("offset", pa.array(offsets, pa.int64())).to_batches()
    return run


def pack_pieces(pieces: DataFrame, sequence: int = SEQUENCE, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """``token_pieces`` rows (without ids) with ``sequence_id`` and ``offset``.

    Pieces are dealt round robin, so every group has the same size whatever
    their documents; a group leaves at most its last few sequences short.
    """
    rows = pieces.select("doc_id", "start", "length", "ids_crc32", "doc_tokens")
    groups = parts_for(rows.count(), group_pieces)
    return rows.repartition(groups).mapInArrow(_pack_group(sequence),
                                               _PIECES + ", sequence_id bigint, offset bigint")


def pack_documents(docs: DataFrame, tokenizer: str, sequence: int = SEQUENCE) -> DataFrame:
    """Where each piece of each document goes: (doc_id, start, length, ids_crc32,
    doc_tokens, sequence_id, offset)."""
    with intermediate_tables(docs.sparkSession) as keep:
        pieces = materialise(token_pieces(docs, tokenizer, sequence), "pack-pieces")
        out = materialise(pack_pieces(pieces, sequence), "packed")
        keep.append(out)
    return out


def sequences(packed: DataFrame, pieces: DataFrame, sequence: int = SEQUENCE) -> DataFrame:
    """(sequence_id, n_tokens, padded, ids array<bigint>): the filled sequences.

    ``pieces`` has ids (``with_ids=True``) and unique (doc_id, start).  A
    sequence of a power of two stays as it is, others are padded with 0 to
    ``sequence``.  A group is one sequence, so at most ``sequence`` ids.
    """
    @F.pandas_udf("array<bigint>")
    def widen(blobs):
        return blobs.map(lambda b: np.frombuffer(b, "<u4").astype(np.int64))
    whole = (packed.join(pieces.select("doc_id", "start", widen("ids").alias("_ids")), ["doc_id", "start"])
             .groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "_ids"))).alias("_p"))
             .select("sequence_id", F.flatten("_p._ids").alias("_ids")))
    n = F.size("_ids")
    even = F.bit_count(n) == 1
    return whole.select(
        "sequence_id", n.alias("n_tokens"), (~even).alias("padded"),
        F.when(even, F.col("_ids")).otherwise(
            F.concat("_ids", F.array_repeat(F.lit(0).cast("bigint"), F.lit(sequence) - n))).alias("ids"))
