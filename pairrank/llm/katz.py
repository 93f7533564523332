"""Language-model scores by Katz back-off from Good-Turing discounted bigrams.

A text's tokens are its words and one end.  With r the count of (h, w) among
training texts and c(h) that of h,

    P(w | h) = d_r r / (c(h) + 1)          if r > 0
             = alpha(h) P(w)               otherwise
    P(w)     = d_c c / (N + 1)             if c > 0, and the rest for any unknown word

d is Katz's Good-Turing discount up to ``CUT`` (where the counts of counts give
no value in (0, 1], the absolute discount they suggest), and alpha makes every
context sum to exactly 1.  The one extra event in each denominator keeps some
mass for back-off in contexts whose counts are all above the cut.

How it runs.  Texts become chunks of about ``CHUNK_CHARS`` characters: their
distinct word hashes and the tokens as places among them.  Words are dealt by
hash to buckets that count them over all chunks and number them; the counts go
back to the chunks, which send each distinct (h, w) once, with the documents it
occurs in, to the bucket of its context.  A frequent context is dealt over
1 + c(h) / ``SPLIT`` buckets by its next word, so no context is one task's work.
A bucket sums the counts and returns, per chunk, what each document gains; only
contexts that somewhere back off return their parts of alpha, which are added
up and joined to the tokens that need them.  Buckets and chunks are packed
arrays of bounded size; the model (word counts, bigram counts, context parts)
is stored as tables partitioned by bucket.

Defined results: a null text is its end alone; a null doc_id is a training row;
rows that repeat a doc_id are scored by their own texts; without training rows
every word is unknown with probability 1; an empty table gives an empty result;
extra columns are ignored.  Words are told apart by 64-bit hashes.
"""

from __future__ import annotations

import struct
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import intermediate_tables, materialise
from .common import WordHashes, batch_of, mix64, parts_for, shuffle_parts, texts, words

CUT = 5
CHUNK_CHARS = 12_000_000
BUCKET_ROWS = 1_000_000
FIXED_POINT = float(1 << 26)  # a document's gain in a bucket is kept to this fraction
SPLIT = 1_000_000
FOLDS, FOLD = 7, 2
_END = 0x656E64206F662074  # the end token's hash: one more word
_ROWS = "bucket int, chunk bigint, kind string, body binary, stat array<bigint>"


# --- packed arrays --------------------------------------------------------------------------

def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as bytes, split into byte planes and compressed."""
    import zstandard
    code, out = zstandard.ZstdCompressor(level=1), []
    for a in arrays:
        a = np.ascontiguousarray(a)
        planes = code.compress(a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes())
        out.append(struct.pack("<3sQQ", a.dtype.str.encode()[-2:].rjust(3), len(a), len(planes)) + planes)
    return b"".join(out)


def unpack(body: bytes) -> list[np.ndarray]:
    import zstandard
    code, out, at = zstandard.ZstdDecompressor(), [], 0
    while at < len(body):
        kind, n, size = struct.unpack_from("<3sQQ", body, at)
        at += 19
        dtype = np.dtype("<" + kind.decode().strip())
        planes = np.frombuffer(code.decompress(body[at:at + size]), np.uint8)
        out.append(np.ascontiguousarray(planes.reshape(dtype.itemsize, n).T).view(dtype).ravel())
        at += size
    return out


def _row(bucket: int, chunk: int | None, kind: str, body: bytes = b"", stat=()) -> tuple:
    return bucket, chunk, kind, body, [int(x) for x in stat]


def _table(rows: list[tuple]) -> pa.Table:
    types = (pa.int32(), pa.int64(), pa.string(), pa.binary(), pa.list_(pa.int64()))
    columns = list(zip(*rows)) or [()] * len(types)
    return pa.table([pa.array(list(c), t) for c, t in zip(columns, types)],
                    names=["bucket", "chunk", "kind", "body", "stat"])


# --- the model's numbers --------------------------------------------------------------------

def discounts(n: np.ndarray) -> np.ndarray:
    """d_1..d_CUT from the counts of counts n_1..n_(CUT + 1)."""
    n = np.asarray(n, float)
    r = np.arange(1, CUT + 1)
    fall = n[0] / (n[0] + 2 * n[1]) if n[0] and n[1] else 0.5
    out = (r - fall) / r
    if n[0]:
        rest = (CUT + 1) * n[CUT] / n[0]
        with np.errstate(divide="ignore", invalid="ignore"):
            katz = ((r + 1) * n[1:] / (r * n[:-1]) - rest) / (1 - rest)
        good = np.isfinite(katz) & (katz > 0) & (katz <= 1)
        out[good] = katz[good]
    return out


@dataclass(frozen=True)
class Unigrams:
    """Totals of the training tokens and the discounted word probabilities."""

    tokens: int
    types: int
    d: np.ndarray
    unknown: float

    @classmethod
    def of(cls, tokens: int, types: int, n: np.ndarray) -> Unigrams:
        d, r = discounts(n), np.arange(1, CUT + 1)
        lost = float((n[:CUT] * r * (1 - d)).sum()) + 1
        return cls(tokens, types, d, lost / (tokens + 1))

    def probability(self, count: np.ndarray) -> np.ndarray:
        d = np.append(self.d, 1.0)[np.clip(count, 1, CUT + 1) - 1]
        return np.where(count > 0, d * count / (self.tokens + 1), self.unknown)


def _counts_of_counts(count: np.ndarray) -> np.ndarray:
    return np.bincount(np.minimum(count, CUT + 2), minlength=CUT + 3)[1:CUT + 2]


# --- chunks ---------------------------------------------------------------------------------

def _is_held(doc_id) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % FOLDS == FOLD


def _chunk_rows(batches):
    """Chunks of documents: ids, folds, sizes, tokens as places, and the word hashes by falling frequency."""
    known, part, seq, docs, chars = WordHashes(), TaskContext.get().partitionId(), 0, [], 0

    def flush():
        ids = np.array([d if d is not None else 0 for d, _ in docs], np.int64)
        null = np.array([d is None for d, _ in docs], np.uint8)
        held = np.array([_is_held(d) for d, _ in docs], np.uint8)
        size = np.array([len(h) for _, h in docs], np.uint32)
        word, place, n = np.unique(np.concatenate([h for _, h in docs]), return_inverse=True, return_counts=True)
        order = np.argsort(-n, kind="stable")
        rank = np.empty(len(order), np.uint32)
        rank[order] = np.arange(len(order))
        body = pack(ids, null, held, size, rank[place], word[order])
        return _table([_row(0, part << 32 | seq, "chunk", body, (len(word), int(size.sum()), int((held == 0).sum())))]).to_batches()[0]
    end = np.array([_END], np.uint64)
    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id"), batch.column("text")):
            text = text.as_py()
            docs.append((doc_id.as_py(), np.concatenate([known.array(words(text)), end])))
            chars += len(text) + 200
            if chars >= CHUNK_CHARS:
                yield flush()
                docs, chars, seq = [], 0, seq + 1
    if docs:
        yield flush()


def _in_buckets(bucket: np.ndarray):
    """(bucket, places) of each bucket that has some."""
    order = np.argsort(bucket, kind="stable")
    found, first = np.unique(bucket[order], return_index=True)
    return zip(found.tolist(), np.split(order, first[1:]))


def _word_rows(buckets: int):
    """Each chunk's distinct words and training counts, to the buckets of their hashes."""
    def run(batches):
        for batch in batches:
            for chunk, body in zip(batch.column("chunk").to_pylist(), batch.column("body")):
                _, _, held, size, place, word = unpack(body.as_py())
                train = np.bincount(place[~np.repeat(held.astype(bool), size)], minlength=len(word))
                for b, at in _in_buckets(word % np.uint64(buckets)):
                    yield from _table([_row(b, chunk, "words", pack(word[at], train[at].astype(np.uint32)))]).to_batches()
    return run


def _count_words(buckets: int):
    """One bucket of words: totals and numbers for every chunk, and the bucket's statistics."""
    def run(key, table):
        own = key[0].as_py()
        chunks = table.column("chunk").to_pylist()
        parts = [unpack(body.as_py()) for body in table.column("body")]
        word, place = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        count = np.bincount(place, weights=np.concatenate([p[1] for p in parts]), minlength=len(word)).astype(np.int64)
        rows, at = [], 0
        for chunk, (mine, _) in zip(chunks, parts):
            p = place[at:at + len(mine)]
            at += len(mine)
            rows.append(_row(own, chunk, "counts", pack((p * buckets + own + 1).astype(np.uint64), count[p].astype(np.uint64))))
        rows.append(_row(own, None, "stat", b"", (count.sum(), (count > 0).sum(), *_counts_of_counts(count))))
        rows.append(_row(own, None, "unigrams", pack(word, count.astype(np.uint64))))
        return _table(rows)
    return run


# --- bigrams --------------------------------------------------------------------------------

def _pair_rows(uni: Unigrams, word_buckets: int, buckets: int, starts: int):
    """A chunk's distinct (h, w) with the documents they occur in, to the buckets of their contexts.

    ``starts`` is the number of training documents: the count of the start context.
    """
    def run(key, chunk_table, count_table):
        chunk = key[0].as_py()
        ids, null, held, size, place, word = unpack(chunk_table.column("body")[0].as_py())
        number, count = np.zeros(len(word), np.int64), np.zeros(len(word), np.int64)
        got = dict(zip(count_table.column("bucket").to_pylist(), count_table.column("body")))
        for b, at in _in_buckets(word % np.uint64(word_buckets)):
            number[at], count[at] = unpack(got[b].as_py())
        doc = np.repeat(np.arange(len(size), dtype=np.int32), size)
        known = np.bincount(doc, weights=count[place] > 0, minlength=len(size)).astype(np.uint32)
        base = np.bincount(doc, weights=np.log10((count + 1) / (uni.tokens + uni.types + 1))[place], minlength=len(size))
        rows = [_row(chunk % buckets, chunk, "meta", pack(ids, null, held, size, known, base))]
        # by (h, w), documents in order within: every (h, w, document) once, every (h, w) once
        pair = np.empty(len(place), np.int64)
        pair[1:] = place[:-1]
        pair += 1
        pair[np.cumsum(size, dtype=np.int64) - size] = 0  # the start context
        pair *= len(word)
        pair += place
        order = np.argsort(pair, kind="stable")
        pair, doc = pair[order], doc[order]
        del order
        fresh = np.append(True, pair[1:] != pair[:-1])
        use = np.flatnonzero(fresh | np.append(True, doc[1:] != doc[:-1]))
        times, where, cell = np.diff(np.append(use, len(doc))), doc[use], (np.cumsum(fresh, dtype=np.int32) - 1)[use]
        pair = pair[fresh]
        del doc, fresh, use
        train = np.bincount(cell, weights=times * (held[where] == 0), minlength=len(pair)).astype(np.uint32)
        h, w = pair // len(word), pair % len(word)
        h_number, h_count = np.append(0, number)[h], np.append(starts, count)[h]
        salt = number[w] % (1 + h_count // SPLIT)
        bucket = mix64((h_number * 1_000_003 + salt).astype(np.uint64)) % np.uint64(buckets)
        postings = np.bincount(cell, minlength=len(pair))
        begin = np.cumsum(postings) - postings
        for b, at in _in_buckets(bucket):
            at = at[np.lexsort((number[w[at]], h_number[at]))]
            n = postings[at]
            post = np.repeat(begin[at] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            rows.append(_row(b, chunk, "pairs", pack(
                np.diff(h_number[at], prepend=0).astype(np.uint64), number[w[at]].astype(np.uint64), train[at],
                h_count[at].astype(np.uint64), count[w[at]].astype(np.uint64), n.astype(np.uint32),
                where[post].astype(np.uint32), times[post].astype(np.uint32)), (len(size),)))
        return _table(rows)
    return run


def _count_pairs(uni: Unigrams):
    """One bucket of bigrams: what each chunk's documents gain, and the parts of alpha."""
    def run(key, table):
        own, out, parts, cells = key[0].as_py(), [], [], [[], [], [], [], []]
        chunks, kinds = table.column("chunk").to_pylist(), table.column("kind").to_pylist()
        for k, (chunk, kind) in enumerate(zip(chunks, kinds)):
            body = table.column("body")[k].as_py()
            if kind == "meta":
                out.append(_row(own, chunk, kind, body))
                continue
            h, *rest, n_docs_of, docs_of, times_of = unpack(body)
            parts.append((chunk, table.column("stat")[k].as_py()[0], n_docs_of, docs_of, times_of))
            for held, array in zip(cells, (np.cumsum(h, dtype=np.int64), *rest)):
                held.append(array)
        del table
        if not parts:
            return _table(out)

        def joined(k: int) -> np.ndarray:
            whole = np.concatenate(cells[k])
            cells[k].clear()
            return whole
        h, w, train, h_count = joined(0), joined(1), joined(2), joined(3)
        lower = uni.probability(joined(4))
        order = np.lexsort((w, h))
        new = np.append(True, (np.diff(h[order]) != 0) | (np.diff(w[order]) != 0))
        first = np.flatnonzero(new)
        of = order[first]  # one cell of each type
        r_type = np.add.reduceat(train[order], first, dtype=np.int64)
        del train
        r = np.empty(len(order), np.int64)
        r[order] = np.repeat(r_type, np.diff(np.append(first, len(order))))
        del order, new, first
        seen = r > 0
        gain = np.where(seen, np.log10(np.maximum(r, 1)) - np.log10(h_count + 1.0), np.log10(lower))
        backs = ~seen & (h_count > 0)
        at = 0
        for chunk, n_docs, n_docs_of, docs_of, times_of in parts:
            cell = np.repeat(np.arange(at, at + len(n_docs_of)), n_docs_of)
            at += len(n_docs_of)
            doc, times = docs_of.astype(np.int64), times_of.astype(np.int64)
            level = np.minimum(r[cell], CUT + 1)
            by = np.bincount(doc * (CUT + 2) + level, weights=times, minlength=n_docs * (CUT + 2)).reshape(n_docs, CUT + 2)
            out.append(_row(own, chunk, "gains", pack(
                np.round(np.bincount(doc, weights=times * gain[cell], minlength=n_docs) * -FIXED_POINT).astype(np.int64),
                by[:, 1:CUT + 1].astype(np.uint32).ravel())))
            need = backs[cell]
            if need.any():
                out.append(_row(own, chunk, "backs", pack(h[cell[need]].astype(np.uint64), doc[need].astype(np.uint32),
                                                          times[need].astype(np.uint32))))
        # one row a type: its context's parts of alpha
        out.append(_row(own, None, "stat", b"", _counts_of_counts(r_type)))
        have = r_type > 0
        out.append(_row(own, None, "bigrams", pack(np.diff(h[of][have], prepend=0).astype(np.uint64),
                                                   w[of][have].astype(np.uint64), r_type[have].astype(np.uint64))))
        ctx, group = np.unique(h[of], return_inverse=True)
        level = np.minimum(r_type, CUT + 1)
        types = np.bincount(group * (CUT + 2) + level, minlength=len(ctx) * (CUT + 2)).reshape(len(ctx), CUT + 2)
        above = np.bincount(group, weights=np.where(r_type > CUT, r_type, 0), minlength=len(ctx)).astype(np.int64)
        low = np.bincount(group, weights=np.where(r_type > 0, lower[of], 0.0), minlength=len(ctx))
        total = np.zeros(len(ctx), np.int64)
        total[group] = h_count[of]
        asked = np.zeros(len(ctx), bool)
        asked[np.searchsorted(ctx, np.unique(h[backs]))] = True
        keep = asked | (total >= SPLIT)  # a dealt context may be asked for in another bucket
        out.append(_row(own, None, "contexts", pack(
            ctx[keep].astype(np.uint64), total[keep].astype(np.uint64), above[keep].astype(np.uint64), low[keep],
            types[keep, 1:CUT + 1].astype(np.uint32).ravel())))
        return _table(out)
    return run


# --- scores ---------------------------------------------------------------------------------

def _document_rows(log_d: np.ndarray):
    def run(key, table):
        meta, gains = None, []
        for kind, body in zip(table.column("kind").to_pylist(), table.column("body")):
            if kind == "meta":
                meta = unpack(body.as_py())
            else:
                gains.append(unpack(body.as_py()))
        ids, null, held, size, known, base = meta
        part = sum(g[0] for g in gains) / -FIXED_POINT + sum(g[1].reshape(len(ids), CUT).astype(float) for g in gains) @ log_d
        n = len(ids)
        return pa.table({
            "chunk": pa.array([key[0].as_py()] * n, pa.int64()), "doc": pa.array(np.arange(n), pa.int64()),
            "doc_id": pa.array(ids, pa.int64(), mask=null.astype(bool)), "held_out": pa.array(held.astype(bool)),
            "n_tokens": pa.array(size.astype(np.int64)), "n_known": pa.array(known.astype(np.int64)),
            "base_score": pa.array(base), "part": pa.array(part)})
    return run


def _context_rows(d: np.ndarray):
    def run(batches):
        for batch in batches:
            for body in batch.column("body"):
                ctx, total, above, low, types = unpack(body.as_py())
                kept = above + types.reshape(len(ctx), CUT) @ (d * np.arange(1, CUT + 1))
                yield batch_of(ctx=pa.array(ctx.astype(np.int64)), total=pa.array(total.astype(np.int64)),
                               kept=pa.array(kept), low=pa.array(low))
    return run


def _back_rows(batches):
    for batch in batches:
        for chunk, body in zip(batch.column("chunk").to_pylist(), batch.column("body")):
            ctx, doc, times = unpack(body.as_py())
            yield batch_of(ctx=pa.array(ctx.astype(np.int64)), chunk=pa.array(np.full(len(ctx), chunk, np.int64)),
                           doc=pa.array(doc.astype(np.int64)), times=pa.array(times.astype(np.int64)))


def _stat(rows: DataFrame, width: int) -> list[int]:
    sums = rows.where("kind = 'stat'").agg(*[F.sum(F.col("stat")[k]) for k in range(width)]).first()
    return [int(x or 0) for x in sums]


@dataclass
class KatzTables:
    """The stored model: packed word counts and bigram counts by bucket, and context weights."""

    words: DataFrame       # bucket, body: word hashes, training counts
    bigrams: DataFrame     # bucket, body: context and word numbers, training counts
    weights: DataFrame     # ctx, total, log_alpha: of the contexts that back off


def score_documents(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row.
    The model's tables are deleted; ``train_and_score`` keeps them."""
    with intermediate_tables(docs.sparkSession) as keep:
        scores, _ = train_and_score(docs)
        keep.append(scores)
    return scores


def train_and_score(docs: DataFrame) -> tuple[DataFrame, KatzTables]:
    """The scores, and the model as stored tables."""
    spark = docs.sparkSession
    with intermediate_tables(spark) as keep:
        chunks = materialise(texts(docs).mapInArrow(_chunk_rows, _ROWS), "katz-chunks")
        size = chunks.agg(*[F.sum(F.col("stat")[k]) for k in range(3)]).first()
        word_buckets = max(shuffle_parts(spark), parts_for(size[0] or 0, BUCKET_ROWS))
        buckets = max(shuffle_parts(spark), parts_for(size[1] or 0, BUCKET_ROWS))
        counts = materialise(chunks.mapInArrow(_word_rows(word_buckets), _ROWS).groupBy("bucket")
                             .applyInArrow(_count_words(word_buckets), _ROWS), "katz-words")
        tokens, types, *n = _stat(counts, CUT + 3)
        uni = Unigrams.of(tokens, types, np.array(n, float))
        pairs = (chunks.groupBy("chunk").cogroup(counts.where("kind = 'counts'").groupBy("chunk"))
                 .applyInArrow(_pair_rows(uni, word_buckets, buckets, size[2] or 0), _ROWS))
        found = materialise(pairs.groupBy("bucket").applyInArrow(_count_pairs(uni), _ROWS), "katz-pairs")
        d = discounts(np.array(_stat(found, CUT + 1), float))
        weights = (found.where("kind = 'contexts'").select("body")
                   .mapInArrow(_context_rows(d), "ctx bigint, total bigint, kept double, low double")
                   .groupBy("ctx").agg(F.max("total").alias("total"), F.sum("kept").alias("kept"), F.sum("low").alias("low"))
                   .select("ctx", "total", F.log10((1 - F.col("kept") / (F.col("total") + 1)) / (1 - F.col("low")))
                           .alias("log_alpha")))
        backs = (found.where("kind = 'backs'").select("chunk", "body")
                 .mapInArrow(_back_rows, "ctx bigint, chunk bigint, doc bigint, times bigint")
                 .join(weights.select("ctx", "log_alpha"), "ctx")
                 .groupBy("chunk", "doc").agg(F.sum(F.col("times") * F.col("log_alpha")).alias("back")))
        rows = (found.where("kind IN ('meta', 'gains')").select("chunk", "kind", "body").groupBy("chunk")
                .applyInArrow(_document_rows(np.log10(d)),
                              "chunk bigint, doc bigint, doc_id bigint, held_out boolean, n_tokens bigint, "
                              "n_known bigint, base_score double, part double"))
        out = materialise(rows.join(backs, ["chunk", "doc"], "left").select(
            "doc_id", "held_out", "n_tokens", "n_known", F.lit(tokens).cast("bigint").alias("train_tokens"), "base_score",
            (F.col("part") + F.coalesce("back", F.lit(0.0))).alias("score")), "katz-scores")
        keep += [out, counts, found]
    return out, KatzTables(counts.where("kind = 'unigrams'").select("bucket", "body"),
                           found.where("kind = 'bigrams'").select("bucket", "body"), weights)
