"""Benchmark items inside documents, by the q-gram lemma and banded alignment.

Texts are compared lower-cased with every run of separators as one space.  An
item of m characters may occur with k = ``BUDGET`` x m edits.  By the q-gram
lemma such an occurrence shares at least m - q + 1 - k q q-grams with the item,
all on diagonals within k of each other.  A document's q-grams are looked up in
the item index, hits are counted in diagonal bands of width 2 (k + 1) that
overlap by half, so any k + 1 neighbouring diagonals lie within one band, and
only bands that reach the bound are verified by an alignment restricted to the
band.  No occurrence within the budget is lost.

The index of one block of items (``BLOCK_CHARS`` characters at most, or one
longer item) is sent to the executors; more items mean more blocks, each held
against all documents in turn and then released.

Defined results: a null or empty text or item matches nothing; items shorter
than q are matched exactly, at every place (of overlapping ones the first); for items so short that the bound would not be
positive the budget shrinks until it is; rows that repeat an item_id or doc_id
each count; null ids stay null; empty tables give no rows; extra columns are
ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import delete_path, materialise
from .common import batch_of, held, map_rows, parts_for, texts

Q = 8
BUDGET = 0.08
BLOCK_CHARS = 8_000_000
_TABLE_BITS = 22
_BASE = np.uint64(0x9E3779B97F4A7C15)


def normal(text: str) -> str:
    return b" ".join(text.encode("utf-8", "surrogatepass").split()).decode("utf-8", "surrogatepass").lower()


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def qgrams(c: np.ndarray) -> np.ndarray:
    """64-bit hashes of the q-grams, one per position."""
    n = len(c) - Q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = c[:n].astype(np.uint64)
    for k in range(1, Q):
        out = out * _BASE + c[k:n + k]
    return out ^ (out >> np.uint64(29))


def align(item: np.ndarray, text: np.ndarray, first: int, last: int, anchored: bool = False) -> tuple[int, int]:
    """Least edit distance of ``item`` to a part of ``text`` over the diagonals
    ``first``..``last`` (text position minus item position), and where it ends.
    ``anchored``: the part begins at position 0."""
    big = len(item) + len(text) + 1
    diagonals = np.arange(first, last + 1)
    inside = (diagonals >= 0) & (diagonals <= len(text))
    row = np.where(inside, np.abs(diagonals) if anchored else 0, big)
    padded = np.full(len(item) + len(text) + 2 * (last - first) + 4, 0xFFFFFFFF, np.uint32)
    shift = max(0, -first)
    padded[shift:shift + len(text)] = text
    steps = np.arange(len(row))
    for i, ch in enumerate(item):
        at = first + i + shift
        same = padded[at:at + len(row)] == ch
        up = np.append(row[1:], big) + 1
        row = np.minimum(row + ~same, up)
        place = diagonals + i + 1
        row = np.where((place >= 0) & (place <= len(text)), row, big)
        if anchored and first <= -(i + 1) <= last:
            row[-(i + 1) - first] = min(row[-(i + 1) - first], i + 1)
        row = np.minimum(np.minimum.accumulate(row - steps) + steps, big)
    best = int(row.argmin())
    return int(row[best]), int(diagonals[best]) + len(item)


class ItemIndex:
    """The q-grams of a block of items."""

    def __init__(self, items: list[tuple[int | None, str]]):
        known = [(i, t) for i, t in ((i, normal(t or "")) for i, t in items) if t]
        self.short = [(i, t) for i, t in known if len(t) < Q]
        known = [(i, t) for i, t in known if len(t) >= Q]
        self.ids, self.texts = [i for i, _ in known], [t for _, t in known]
        self.codes = [codes(t) for t in self.texts]
        size = np.array([len(c) for c in self.codes], np.int64)
        self.edits = np.minimum((size * BUDGET).astype(np.int64), (size - Q) // Q)
        self.bound = size - Q + 1 - self.edits * Q
        grams = [qgrams(c) for c in self.codes]
        flat = np.concatenate([np.zeros(0, np.uint64), *grams])
        item = np.repeat(np.arange(len(grams)), [len(g) for g in grams])
        place = np.concatenate([np.zeros(0, np.int64), *(np.arange(len(g)) for g in grams)])
        order = np.argsort(flat, kind="stable")
        self.item, self.place = item[order], place[order]
        self.grams, self.first = np.unique(flat[order], return_index=True)
        self.count = np.diff(np.append(self.first, len(flat)))
        self.seen = np.zeros(1 << _TABLE_BITS, bool)
        self.seen[self.grams >> np.uint64(64 - _TABLE_BITS)] = True

    def hits(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(item, diagonal) of every shared q-gram."""
        at = np.flatnonzero(self.seen[grams >> np.uint64(64 - _TABLE_BITS)])
        if not len(at) or not len(self.grams):
            return at[:0], at[:0]
        where = np.minimum(np.searchsorted(self.grams, grams[at]), len(self.grams) - 1)
        real = self.grams[where] == grams[at]
        at, where = at[real], where[real]
        n = self.count[where]
        rows = np.repeat(self.first[where], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        return self.item[rows], np.repeat(at, n) - self.place[rows]

    def bands(self, grams: np.ndarray) -> list[tuple[int, int, int, int]]:
        """(item, first diagonal, last diagonal, shared) of the bands that reach the bound."""
        item, diagonal = self.hits(grams)
        if not len(item):
            return []
        half = self.edits[item] + 1
        low = 1 << 40
        keys, n = np.unique(item.astype(np.int64) * (low << 1) + diagonal // half + low, return_counts=True)
        nxt = np.searchsorted(keys, keys + 1)
        with_next = n + np.where((nxt < len(keys)) & (keys[np.minimum(nxt, len(keys) - 1)] == keys + 1),
                                 n[np.minimum(nxt, len(keys) - 1)], 0)
        enough = with_next >= self.bound[keys // (low << 1)]
        out = []
        for key, shared in zip(keys[enough].tolist(), with_next[enough].tolist()):
            k, band = key // (low << 1), key % (low << 1) - low
            half = int(self.edits[k]) + 1
            out.append((k, band * half, (band + 2) * half - 1, shared))
        return out

    def occurrences(self, text: str) -> list[tuple[int | None, int, int, int, int]]:
        """(item_id, start, end, distance, shared) in the normalised text, overlapping finds
        of an item reduced to the closest, then first."""
        text = normal(text)
        found: list[tuple[int, int, int, int, int]] = []
        c = codes(text) if len(text) >= Q else None
        for k, first, last, shared in self.bands(qgrams(c)) if c is not None else []:
            item, edits = self.codes[k], int(self.edits[k])
            a = max(0, first - edits)
            b = max(a, last + len(item) + edits + 1)
            at = text.find(self.texts[k], a, b)  # one diagonal without an edit needs no alignment
            if at >= 0:
                found.append((k, at, at + len(item), 0, shared))
                continue
            window = c[a:b]
            distance, end = align(item, window, first - a - edits, last - a + edits)
            if distance <= edits:
                back, size = align(item[::-1], window[:end][::-1], -edits, edits, anchored=True)
                found.append((k, a + end - size, a + end, distance, shared))
        out, ends = [], {}
        for k, start, end, distance, shared in sorted(found, key=lambda f: (f[0], f[3], f[1], f[2])):
            if all(end <= s or start >= e for s, e in ends.get(k, [])):
                ends.setdefault(k, []).append((start, end))
                out.append((self.ids[k], start, end, distance, shared))
        for i, t in self.short:
            at = text.find(t)
            while at >= 0:
                out.append((i, at, at + len(t), 0, 0))
                at = text.find(t, at + len(t))
        return out


def item_blocks(benchmark: DataFrame) -> Iterator[tuple]:
    """(block, whether it is the last): broadcast blocks of items, one after another;
    each is of bounded size, and the driver and executors hold one at a time."""
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text"))
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = parts_for(chars, BLOCK_CHARS)
    for b in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).collect()
        rows.sort(key=lambda r: (r["item_id"] is None, r["item_id"] or 0, r["text"] or ""))
        sent = benchmark.sparkSession.sparkContext.broadcast([(r["item_id"], r["text"]) for r in rows])
        last = b == blocks - 1
        yield (uuid.uuid4().hex, sent), last
        if not last:
            sent.destroy()


def _index(block) -> ItemIndex:
    """The worker's index of a block, kept between tasks."""
    name, sent = block
    return held(("items", name), lambda: ItemIndex(sent.value))


def find_items(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, start, end, distance, shared) of every occurrence; positions
    are characters of the normalised text."""
    def using(block):
        def make():
            index = _index(block)

            def step(batch):
                rows = [(d, *f) for d, t in zip(batch.column("doc_id").to_pylist(), batch.column("text"))
                        for f in index.occurrences(t.as_py())]
                names = ["doc_id", "item_id", "start", "end", "distance", "shared"]
                return batch_of(**{n: pa.array(v, pa.int64()) for n, v in zip(names, zip(*rows))}) if rows else None
            return step
        return make
    schema = "doc_id bigint, item_id bigint, start bigint, end bigint, distance bigint, shared bigint"
    out = None
    for block, last in item_blocks(benchmark):
        part = map_rows(texts(docs), schema, using(block))
        part = part if last else materialise(part, "item-finds")
        out = part if out is None else out.unionByName(part)
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows in which an item occurs, all columns unchanged."""
    def using(block):
        def make():
            index = _index(block)

            def step(batch):
                return batch.filter(pa.array([not index.occurrences(t.as_py() or "") for t in batch.column("text")]))
            return step
        return make
    before = None
    for block, last in item_blocks(benchmark):
        docs = map_rows(docs, docs.schema, using(block))
        if not last:
            docs = materialise(docs, "item-clean")
            if before is not None:
                delete_path(docs.sparkSession, before)
            before = docs._scratch_path
    return docs
