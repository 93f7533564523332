"""Spelling variants: near words by a trie over letter-group counts.

Words are arranged by how many of their letters fall into each of ``GROUPS``
letter groups.  One inserted, deleted or replaced letter raises at most one of
these counts by one (the surplus) and lowers at most one (the deficit), so a
depth-first search of the trie of successive counts that may spend one surplus
and one deficit reaches every near word; what stands at the leaves it reaches is
verified letter by letter.

How it runs.  The vocabulary is a table of (word, n), counted with partial sums
per task.  The trie is cut into subtrees: a node of depth ``TOP`` with at most
``SUBTREE`` words is one, a larger node is opened a level further, until depth
``GROUPS``, where words of equal counts that are still too many are dealt into
parts.  A word is sent to its own subtree and to those its search enters with a
surplus first (the search is symmetric, so each pair is found once, from the
lower of its two subtrees); the branches followed are a join per level, and no
list of subtrees is collected.  Within a subtree the search runs on all its words
at a time from a stack of bounded pieces.  A subtree returns one row per word
with its number of near words there and the best of them, never the pairs.
A word's root follows forms, whose counts grow tenfold each, by pointer doubling.

Defined results: a null or empty text has no words; a null doc_id is written
``null`` in the crc; rows that repeat a doc_id each count; a run that loses its
only letter is no word; words of any length are whole; an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import delete_path, intermediate_tables, materialise
from .common import batch_of, texts

LEAST_LETTERS = 7
LEAST_N = 2
RATIO = 10
DROPPED_OF = 31     # one of this many (document, word) pairs loses a letter
GROUPS = 12
TOP = 3
SUBTREE = 20_000
HELD_WORDS = 200_000    # distinct words a counting task holds before it sends them
_SHORT = 64         # longer words are verified one pair at a time
_PIECE = 100_000    # rows of one step of the search
_RUN = re.compile("[A-Za-zÀ-ÿ]+")


# --- vocabulary -----------------------------------------------------------------------------

def misspelt(doc_id, word: str, before: int | None = None) -> str:
    """The word as it counts in a document: one letter less where the crc of the pair says so."""
    if before is None:
        before = zlib.crc32(f"{'null' if doc_id is None else doc_id}:".encode())
    h = zlib.crc32(word.encode(), before)
    if h % DROPPED_OF:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1:]


def _word_rows(batches):
    held: Counter = Counter()

    def rows():
        out = batch_of(word=pa.array(list(held), pa.string()), n=pa.array(list(held.values()), pa.int64()))
        held.clear()
        return out
    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
            low = text.as_py().encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")  # A-Z only
            before = zlib.crc32(f"{'null' if doc_id is None else doc_id}:".encode())
            for word, n in Counter(_RUN.findall(low)).items():
                if len(word) >= LEAST_LETTERS:
                    word = misspelt(doc_id, word, before)
                    if len(word) >= LEAST_LETTERS:
                        held[word] += n
            if len(held) >= HELD_WORDS:
                yield rows()
    if held:
        yield rows()


def vocabulary(docs: DataFrame) -> DataFrame:
    """(word, n) of the words of ``LEAST_LETTERS`` letters and ``LEAST_N`` occurrences."""
    return (texts(docs).mapInArrow(_word_rows, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
            .where(F.col("n") >= LEAST_N))


# --- letters --------------------------------------------------------------------------------

def _letters(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All letters of the words as Latin-1 codes, and the words' lengths."""
    ws = [w.encode("latin-1") for w in column.to_pylist()]
    return np.frombuffer(b"".join(ws), np.uint8), np.array([len(w) for w in ws], np.int64)


def letter_groups(words: DataFrame, groups: int = GROUPS) -> np.ndarray:
    """Letter code -> group, so that each group has about as many letters of the vocabulary."""
    def run(batches):
        seen = np.zeros(256, np.int64)
        for batch in batches:
            seen += np.bincount(_letters(batch.column("word"))[0], minlength=256)
        at = np.flatnonzero(seen)
        yield batch_of(letter=pa.array(at, pa.int32()), n=pa.array(seen[at], pa.int64()))
    rows = words.select("word").mapInArrow(run, "letter int, n bigint").groupBy("letter").agg(F.sum("n").alias("n")).collect()
    of, load = np.arange(256) % groups, [0] * groups  # at most 256 rows
    for r in sorted(rows, key=lambda r: (-r["n"], r["letter"])):
        g = load.index(min(load))
        of[r["letter"]] = g
        load[g] += r["n"]
    return of


def count_vectors(column: pa.Array, of: np.ndarray, groups: int) -> np.ndarray:
    """Letters per group of each word, 255 at most (that never widens a difference)."""
    flat, size = _letters(column)
    row = np.repeat(np.arange(len(size)), size)
    return np.minimum(np.bincount(row * groups + of[flat], minlength=len(size) * groups), 255).reshape(-1, groups).astype(np.uint8)


def _binary(rows: np.ndarray) -> pa.Array:
    """Rows of bytes as a binary column."""
    n, width = rows.shape
    ends = pa.py_buffer((np.arange(n + 1, dtype=np.int32) * width).tobytes())
    return pa.Array.from_buffers(pa.binary(), n, [None, ends, pa.py_buffer(np.ascontiguousarray(rows).tobytes())])


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, width)


# --- the cut trie ---------------------------------------------------------------------------

_FRONTIER = "word string, n bigint, v binary, node binary, up int, down int"


def _top_paths(of: np.ndarray, groups: int, top: int):
    """Each word with the nodes of depth ``top`` its search enters: its own, and those
    of a surplus before any deficit."""
    moves = [(np.zeros(top, np.int64), 1, 1)]
    for a in range(top):
        one = np.zeros(top, np.int64)
        one[a] = 1
        moves.append((one, 0, 1))
        for b in range(a + 1, top):
            two = one.copy()
            two[b] = -1
            moves.append((two, 0, 0))

    def run(batches):
        for batch in batches:
            v = count_vectors(batch.column("word"), of, groups)
            held = _binary(v)
            for move, up, down in moves:
                node = v[:, :top].astype(np.int64) + move
                at = np.flatnonzero(((node >= 0) & (node <= 255)).all(axis=1))
                if len(at):
                    own, n = batch.take(pa.array(at)), len(at)
                    yield batch_of(word=own.column("word"), n=own.column("n"), v=held.take(pa.array(at)),
                                   node=_binary(node[at].astype(np.uint8)), up=pa.array(np.full(n, up), pa.int32()),
                                   down=pa.array(np.full(n, down), pa.int32()))
    return run


def _deeper(groups: int, depth: int):
    """The children (of depth ``depth`` + 1) that a word's search enters below its node."""
    def run(batches):
        for batch in batches:
            v, node = _matrix(batch.column("v"), groups), _matrix(batch.column("node"), depth)
            up, down = batch.column("up").to_numpy(), batch.column("down").to_numpy()
            fresh = (node == v[:, :depth]).all(axis=1)  # still on its own path: a surplus comes first
            want = v[:, depth].astype(np.int64)
            for move in (0, 1, -1):
                may = (want + move >= 0) & (want + move <= 255)
                may &= up > 0 if move == 1 else (down > 0) & ~fresh if move == -1 else True
                at = np.flatnonzero(may)
                if len(at):
                    own = batch.take(pa.array(at))
                    child = np.column_stack([node[at], (want[at] + move).astype(np.uint8)])
                    yield batch_of(word=own.column("word"), n=own.column("n"), v=own.column("v"), node=_binary(child),
                                   up=pa.array(up[at] - (move == 1), pa.int32()), down=pa.array(down[at] - (move == -1), pa.int32()))
    return run


def _subtrees(words: DataFrame, of: np.ndarray, groups: int, top: int, subtree: int) -> DataFrame:
    """(word, n, v, node, part, own): every word in its subtree (own) and in those its search enters."""
    frontier, depth, out = words.mapInArrow(_top_paths(of, groups, top), _FRONTIER), top, None
    own = F.col("node") == F.substring("v", 1, F.length("node"))
    while True:
        frontier = materialise(frontier, "spelling-frontier")
        size = materialise(frontier.where(own).groupBy("node").agg(F.count(F.lit(1)).alias("size")), "spelling-nodes")
        big = F.col("size") > subtree
        closed = size if depth == groups else size.where(~big)
        parts = F.ceil(F.col("size") / subtree)  # 1 but at full depth
        mine = F.pmod(F.xxhash64("word"), "parts")
        here = (frontier.join(closed.select("node", parts.alias("parts")), "node")
                .withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)))
                .select("word", "n", "v", "node", "part", (own & (F.col("part") == mine)).alias("own")))
        out = here if out is None else out.unionByName(here)
        if depth == groups or size.where(big).isEmpty():
            return out
        # only the paths below open nodes go on
        frontier = (frontier.join(size.where(big).select("node"), "node", "left_semi")
                    .select("word", "n", "v", "node", "up", "down").mapInArrow(_deeper(groups, depth), _FRONTIER))
        depth += 1


# --- the search within a subtree ------------------------------------------------------------

class Trie:
    """Words by successive counts: per level the (parent, count) keys of its nodes, in order."""

    def __init__(self, v: np.ndarray):
        self.order = np.lexsort(v.T[::-1]) if v.shape[1] else np.arange(len(v))
        rows = v[self.order]
        self.keys, node = [], np.zeros(len(rows), np.int64)  # without levels the root is the one leaf
        for level in range(v.shape[1]):
            key, node = np.unique(node << 8 | rows[:, level].astype(np.int64), return_inverse=True)
            self.keys.append(key)
        self.first = np.searchsorted(node, np.arange(len(self.keys[-1]) + 1 if self.keys else 2))

    def search(self, v: np.ndarray, up: np.ndarray, down: np.ndarray):
        """(query, word) places at the leaves reached by depth-first search with these
        budgets, in pieces."""
        stack = [(0, np.arange(len(v)), np.zeros(len(v), np.int64), up, down)]
        while stack:
            level, q, node, up, down = stack.pop()
            if len(q) > _PIECE:
                half = len(q) // 2
                stack += [(level, *(a[s] for a in (q, node, up, down))) for s in (slice(half, None), slice(None, half))]
                continue
            if level == v.shape[1]:
                yield from self._leaves(q, node)
                continue
            keys, want, found = self.keys[level], v[q, level].astype(np.int64), []
            for move, may in ((0, None), (1, up > 0), (-1, down > 0)):
                at = np.arange(len(q)) if may is None else np.flatnonzero(may)
                at = at[(want[at] + move >= 0) & (want[at] + move <= 255)]
                key = node[at] << 8 | want[at] + move
                place = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
                real = keys[place] == key
                at = at[real]
                found.append((q[at], place[real], up[at] - (move == 1), down[at] - (move == -1)))
            parts = [np.concatenate(column) for column in zip(*found)]
            if len(parts[0]):
                stack.append((level + 1, *parts))

    def _leaves(self, q: np.ndarray, node: np.ndarray):
        begin, n = self.first[node], self.first[node + 1] - self.first[node]
        total = np.cumsum(n)
        at = 0
        while at < len(q):
            end = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + _PIECE, "right")))
            some = n[at:end]
            place = np.repeat(begin[at:end] - (np.cumsum(some) - some), some) + np.arange(some.sum())
            yield np.repeat(q[at:end], some), self.order[place]
            at = end


class Spelled:
    """Words as rows of letters, aligned left and right."""

    def __init__(self, words: list[bytes]):
        self.words = words
        self.size = np.array([len(w) for w in words], np.int64)
        short = self.size <= _SHORT
        width = int(self.size[short].max(initial=0)) + 1
        self.left, self.right = (np.zeros((len(words), width), np.uint8) for _ in range(2))
        for k in np.flatnonzero(short).tolist():
            row = np.frombuffer(words[k], np.uint8)
            self.left[k, :len(row)] = row
            self.right[k, :len(row)] = row[::-1]
        self.short = short

    def near(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the words at a and b differ by exactly one inserted, deleted or replaced letter."""
        la, lb = self.size[a], self.size[b]
        out = np.abs(la - lb) <= 1
        both = np.flatnonzero(out & self.short[a] & self.short[b])
        x, y = a[both], b[both]
        # the zero behind each word ends its common part, unless the words are equal
        head = (self.left[x] != self.left[y]).argmax(axis=1)
        tail = (self.right[x] != self.right[y]).argmax(axis=1)
        longer = np.maximum(la[both], lb[both])
        out[both] = (head + tail >= longer - 1) & ((la[both] != lb[both]) | (self.left[x] != self.left[y]).any(axis=1))
        for k in np.flatnonzero(out & ~(self.short[a] & self.short[b])).tolist():
            out[k] = one_edit(self.words[a[k]], self.words[b[k]])
        return out


def one_edit(a, b) -> bool:
    """Whether one inserted, deleted or replaced letter turns a into b, in the plain way."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    k = 0
    while k < len(a) and a[k] == b[k]:
        k += 1
    return a[k + (len(a) == len(b)):] == b[k + 1:]


_FOUND = "word string, n_near bigint, best struct<less: bigint, word: string>"
_BEST = pa.struct([("less", pa.int64()), ("word", pa.string())])


def _near_in_subtree(key, table):
    """One subtree's near words: per word their number here and the best of them."""
    node, n = key[0].as_py(), table.num_rows
    order = pc.sort_indices(table, sort_keys=[("n", "descending"), ("word", "ascending")])
    table = table.take(order).combine_chunks()  # a row's place is its rank as a form
    words, own = table.column("word").to_pylist(), table.column("own").to_numpy()
    v = np.frombuffer(b"".join(table.column("v").to_pylist()), np.uint8).reshape(n, -1)
    depth = len(node)
    used = np.frombuffer(node, np.uint8).astype(np.int64) - v[:, :depth]
    up, down = 1 - np.maximum(used, 0).sum(axis=1), 1 + np.minimum(used, 0).sum(axis=1)
    spelled = Spelled([w.encode("latin-1") for w in words])
    members = np.flatnonzero(own)
    counted, best = np.zeros(n, np.int64), np.full(n, n, np.int64)
    trie = Trie(v[members][:, depth:]) if len(members) else None
    home = (used == 0).all(axis=1)  # of this subtree, though perhaps of another part
    for q, m in trie.search(v[:, depth:], up, down) if trie else ():
        m = members[m]
        # two words of one subtree meet from both sides (and in each other's parts): they count once
        once = ~home[q] | (q < m)
        q, m = q[once], m[once]
        real = spelled.near(q, m)
        q, m = q[real], m[real]
        counted += np.bincount(q, minlength=n) + np.bincount(m, minlength=n)
        np.minimum.at(best, q, m)
        np.minimum.at(best, m, q)
    at = np.flatnonzero(counted)
    by = best[at]
    number = table.column("n").to_numpy()
    found = pa.StructArray.from_arrays([pa.array(-number[by], pa.int64()), pa.array([words[k] for k in by.tolist()], pa.string())],
                                       fields=list(_BEST))
    return pa.table({"word": pa.array([words[k] for k in at.tolist()], pa.string()),
                     "n_near": pa.array(counted[at], pa.int64()), "best": found})


# --- results --------------------------------------------------------------------------------

def near_words(words: DataFrame, groups: int = GROUPS, top: int = TOP, subtree: int = SUBTREE) -> DataFrame:
    """(word, n, n_near, best) of the stored vocabulary (word, n); ``best`` is (-n, word) or null."""
    of = letter_groups(words, groups)
    found = (_subtrees(words, of, groups, top, subtree).groupBy("node", "part")
             .applyInArrow(_near_in_subtree, _FOUND))
    none = words.select("word", "n", F.lit(0).cast("bigint").alias("n_near"),
                        F.lit(None).cast("struct<less: bigint, word: string>").alias("best"))
    return (none.unionByName(found.withColumn("n", F.lit(None).cast("bigint")))
            .groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), F.min("best").alias("best")))


def _roots(links: DataFrame) -> DataFrame:
    """(word, root) of every word of ``links`` (word, root): the end of its chain, by doubling.

    Counts grow ``RATIO``-fold along a chain, so it is shorter than a count has digits.
    """
    links = materialise(links, "spelling-links")
    while True:
        on = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = materialise(links.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"),
                                                                 F.col("next").isNotNull().alias("moved")), "spelling-links")
        delete_path(links.sparkSession, links._scratch_path)
        links = step.select("word", "root")
        links._scratch_path = step._scratch_path
        if step.where("moved").isEmpty():
            return links


def spelling_variants(docs: DataFrame, groups: int = GROUPS, top: int = TOP, subtree: int = SUBTREE) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of the vocabulary."""
    with intermediate_tables(docs.sparkSession) as keep:
        words = materialise(vocabulary(docs), "spelling-words")
        form_n = -F.col("best.less")
        # a null best and one too small give no form
        is_form = F.coalesce(form_n >= RATIO * F.col("n"), F.lit(False))
        rows = materialise(near_words(words, groups, top, subtree).select(
            "word", "n", "n_near", F.when(is_form, F.col("best.word")).alias("form"),
            F.when(is_form, form_n).alias("form_n")), "spelling-forms")
        roots = _roots(rows.where("form IS NOT NULL").select("word", F.col("form").alias("root")))
        out = materialise(rows.join(roots, "word", "left").select(
            "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"), "spelling")
        keep.append(out)
    return out
