"""Exact token counts at every prefix of a text, by dynamic programming.

For a BPE whose white space only separates words, the ids of a prefix are the
ids of its finished words plus those of the cut word, so one pass over a word
answers all its prefixes.  Within a word let ``last[j]`` be the last token of
the encoding of the first ``j`` symbols and ``count[j]`` its token count.  A
token ``t`` ending at ``j`` is that last token exactly when the pair
``(last[j - len(t)], t)`` survives merging as two tokens, hence
``count[j] = count[j - len(t)] + 1``; the word end is a marked last symbol.
That is linear in the word's length times the longest token.

The prefixes are those of the text as the tokenizer normalises it; for text of
ASCII and common Latin letters these are the code points of the text itself.

Defined results: a null text is empty and has 0 tokens; repeated rows give
repeated results; a null doc_id stays null; an empty table gives an empty one;
special strings count as the one token the library makes of them.
"""

from __future__ import annotations

import array
import json
import operator
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch_of, held, map_rows, texts
from .tokens import _PLAIN, ALPHABET, WORD_PATTERN, kind_of, open_library

LIMIT = 2048

# Symbols by which the longest token that may end at a place is looked up.
REACH = 3


class PrefixCounter:
    """Token counts of all prefixes; ``limit`` bounds the remembered pieces."""

    def __init__(self, path: str, limit: int = 400_000):
        import regex
        from tokenizers.models import BPE
        self.library = open_library(path)
        if kind_of(self.library) != "word":
            raise ValueError("prefix counts need a tokenizer whose white space only separates words")
        spec = json.loads(self.library.to_str())
        self.end = spec["model"]["end_of_word_suffix"] or ""
        merges = [tuple(m) if not isinstance(m, str) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
        self.rank = {m: k for k, m in enumerate(merges)}
        self.forms: dict[str, int] = {}  # token text -> 1: within a word, 2: at its end, 3: both
        for t in spec["model"]["vocab"]:
            ends = t.endswith(self.end)
            t = t[:-len(self.end)] if ends else t
            self.forms[t] = self.forms.get(t, 0) | (2 if ends else 1)
        # the last REACH symbols -> length of the longest token that ends with them
        self.reach: dict[str, int] = {}
        for t in self.forms:
            self.reach[t[-REACH:]] = max(len(t), self.reach.get(t[-REACH:], 0))
        # the same merges on symbols that no word end follows
        self.within = BPE(vocab=spec["model"]["vocab"], merges=merges, unk_token=spec["model"].get("unk_token"))
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        self.split = regex.compile(WORD_PATTERN)
        self.limit, self.pieces, self.chunks, self.pairs = limit, {}, {"": b""}, {}
        self.path, self.last, self.count, self.closed = "", [""], [0], [0]

    def _fits(self, before: str, token: str) -> int:
        """In which forms BPE leaves ``before`` then ``token`` as these two (1, 2 or both)."""
        head, fits = [before] if before else [], 0
        for form, mark, model in ((1, "", self.within), (2, self.end, self.library.model)):
            # two tokens that merge never stay two
            if self.forms[token] & form and (before, token + mark) not in self.rank:
                if [t.value for t in model.tokenize(before + token)] == head + [token + mark]:
                    fits |= form
        if len(self.pairs) >= 4 * self.limit:
            self.pairs.clear()
        self.pairs[before, token] = fits
        return fits

    def word_counts(self, symbols: str) -> list[int]:
        """Token counts of the word's prefixes, one per symbol.  The table of the
        previous word is kept up to the prefix the two share."""
        path, last, count, closed = self.path, self.last, self.count, self.closed
        shared = 0
        for x, y in zip(path, symbols):
            if x != y:
                break
            shared += 1
        del last[shared + 1:], count[shared + 1:], closed[shared + 1:]
        form_of, pair_of, longest_at = self.forms.get, self.pairs.get, self.reach.get
        for j in range(shared + 1, len(symbols) + 1):
            want = 3
            open_at = end_at = 0
            # a token no longer than REACH may end here too; it needs no entry
            longest = longest_at(symbols[j - REACH:j], REACH) if j > REACH else j
            for at in range(j - longest if j > longest else 0, j):
                token = symbols[at:j]
                form = form_of(token)
                if form and form & want:
                    before = last[at]
                    fits = pair_of((before, token))
                    if fits is None:
                        fits = self._fits(before, token)
                    fits &= want
                    if fits:
                        if fits & 1:
                            open_at, open_token = at, token
                        if fits & 2:
                            end_at = at
                        want &= ~fits
                        if not want:
                            break
            last.append(open_token)
            count.append(count[open_at] + 1)
            closed.append(count[end_at] + 1)
        self.path = symbols
        return closed[1:]

    def _piece(self, piece: str) -> list[int]:
        """Counts at every code point of one pre-token."""
        if piece[0] == "'" and len(piece) > 1 and piece[1].isalpha():  # a contraction: its prefixes split otherwise
            return [sum(self._piece(x)[-1] if len(x) == 1 else self.word_counts(x)[-1]
                        for x in self.split.findall(piece[:k])) for k in range(1, len(piece) + 1)]
        if piece.isascii():
            return self.word_counts(piece)
        every = self.word_counts(piece.encode().decode("latin-1").translate(ALPHABET))
        out, at = [], -1
        for ch in piece:
            at += len(ch.encode())
            out.append(every[at])
        return out

    def _steps(self, piece: str) -> bytes:
        """Differences of the counts at a pre-token's code points, 32-bit each."""
        steps = self.pieces.get(piece)
        if steps is None:
            counts = self._piece(piece)
            steps = array.array("i", map(operator.sub, counts, [0, *counts])).tobytes()
            if len(piece) <= 64:
                if len(self.pieces) >= self.limit:
                    self.pieces.clear()
                self.pieces[piece] = steps
        return steps

    def _split(self, run: str) -> list[tuple[str, int]]:
        """Pre-tokens of text without special strings, each with the dropped characters before it."""
        if _PLAIN.fullmatch(run):
            low = run.lower()
            if len(low) == len(run):
                return [(low, 0)] if low.isalpha() else [(p, 0) for p in self.split.findall(low)]
        run = self.library.normalizer.normalize_str(run)
        out, at = [], 0
        for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(run):
            out.append((run[a:b], a - at))
            at = b
        return [*out, ("", len(run) - at)]

    def _joined(self, parts: list[tuple[str, int]]) -> bytes:
        return b"".join([b"\0\0\0\0" * gap + (self._steps(p) if p else b"") for p, gap in parts])

    def _run(self, run: str) -> bytes:
        return self._joined(self._split(run))

    def chunk(self, chunk: str) -> bytes:
        """Differences of the counts at the code points of text between separators."""
        if "<|" not in chunk:
            return self._run(chunk)
        out, run = [], ""  # run: the ordinary text since the last special string
        for part in self.cut.split(chunk):
            if part in self.special:
                # a cut special string is ordinary text and may join what stands before it
                before = sum(array.array("i", self._run(run)))
                cut = np.cumsum(np.frombuffer(self._run(run + part), "<i4"))[-len(part):-1]
                out.append(np.diff(np.append(cut, before + 1), prepend=before).astype("<i4").tobytes())
                run = ""
            elif part:
                run = part
                out.append(self._run(part))
        return b"".join(out)

    def differences(self, texts: list[str]) -> Iterator[np.ndarray]:
        """By how much the count changes at each code point; the cumulative sum has
        the exact token count of every prefix."""
        cut = [t.replace("\n", " ").split(" ") for t in texts]
        known = self.chunks
        new = {c for chunks in cut for c in chunks if c not in known}
        if len(known) + len(new) > self.limit:
            known = self.chunks = {"": b""}
            new = {c for chunks in cut for c in chunks if c}
        plain = {c: self._split(c) for c in new if "<|" not in c and len(c) <= 64}
        # in order, so that neighbouring words share most of their tables
        for piece in sorted({p for parts in plain.values() for p, _ in parts if p}):
            self._steps(piece)
        for c in new:
            known[c] = self._joined(plain[c]) if c in plain else self.chunk(c)
        for chunks in cut:
            yield np.frombuffer(b"\0\0\0\0".join([known[c] for c in chunks]), "<i4")


def counter(path: str) -> PrefixCounter:
    """The worker's counter for a tokenizer file, kept between tasks."""
    return held(("counter", path), lambda: PrefixCounter(path))


_ENCODE, _DECODE = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def pack(differences: np.ndarray) -> bytes:
    """One byte a code point where that holds all differences, else four; compressed."""
    small = differences.astype(np.int8)
    if (small == differences).all():
        return b"\0" + _ENCODE.compress(small.tobytes())
    return b"\1" + _ENCODE.compress(differences.astype("<i4").tobytes())


def unpack(blob: bytes) -> np.ndarray:
    """Token count after each code point."""
    return np.cumsum(np.frombuffer(_DECODE.decompress(blob[1:]), np.int8 if blob[0] == 0 else "<i4"), dtype=np.int64)


def prefix_counts(docs: DataFrame, path: str, keep_prefixes: bool = True) -> DataFrame:
    """(doc_id, n_bytes, n_tokens[, prefixes]) of every whole text.

    ``prefixes`` is the packed table of counts at every prefix, to be stored
    and asked by ``tokens_at`` and ``truncated``; ``n_tokens`` is its last entry.
    """
    def make():
        count = counter(path)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            n_tokens, packed = [], []
            for d in count.differences(batch.column("text").to_pylist()):
                n_tokens.append(int(d.sum(dtype=np.int64)))
                if keep_prefixes:
                    packed.append(pack(d))
            out = {"doc_id": batch.column("doc_id"), "n_bytes": batch.column("n_bytes"),
                   "n_tokens": pa.array(n_tokens, pa.int64())}
            return batch_of(**out, **({"prefixes": pa.array(packed, pa.binary())} if keep_prefixes else {}))
        return step

    rows = texts(docs).withColumn("n_bytes", F.octet_length("text").cast("bigint"))
    return map_rows(rows, "doc_id bigint, n_bytes bigint, n_tokens bigint" + ", prefixes binary" * keep_prefixes, make)


def whole_counts(table: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_tokens) from a stored table of counts: each text's last entry."""
    def make():
        def step(batch):
            n = [int(counts[-1]) if len(counts) else 0 for counts in map(unpack, batch.column("prefixes").to_pylist())]
            return batch_of(doc_id=batch.column("doc_id"), n_bytes=batch.column("n_bytes"), n_tokens=pa.array(n, pa.int64()))
        return step
    return map_rows(table.select("doc_id", "n_bytes", "prefixes"), "doc_id bigint, n_bytes bigint, n_tokens bigint", make)


def tokens_at(table: DataFrame, position: str) -> DataFrame:
    """Adds ``tokens``: the count of the first ``position`` (a column) code points;
    positions are held within the text; a null position gives null."""
    @F.pandas_udf("bigint")
    def ask(blobs, at):
        import pandas as pd
        out = []
        for blob, k in zip(blobs, at):
            counts = unpack(blob)
            k = None if pd.isna(k) else min(max(int(k), 0), len(counts))
            out.append(None if k is None else int(counts[k - 1]) if k else 0)
        return pd.Series(out, dtype="Int64")
    return table.withColumn("tokens", ask("prefixes", F.col(position).cast("double")))


def truncated(table: DataFrame, budget: int) -> DataFrame:
    """(doc_id, n_keep, tokens): the longest prefix, in code points, of at most ``budget`` tokens."""
    def make():
        def step(batch):
            keep, tokens = [], []
            for blob in batch.column("prefixes").to_pylist():
                counts = unpack(blob)
                fits = np.flatnonzero(counts <= budget)
                keep.append(int(fits[-1]) + 1 if len(fits) else 0)
                tokens.append(int(counts[fits[-1]]) if len(fits) else 0)
            return batch_of(doc_id=batch.column("doc_id"), n_keep=pa.array(keep, pa.int64()),
                            tokens=pa.array(tokens, pa.int64()))
        return step
    return map_rows(table.select("doc_id", "prefixes"), "doc_id bigint, n_keep bigint, tokens bigint", make)
