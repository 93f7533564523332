"""The numbers of ``hashing`` over NumPy columns, for tasks that make them by the million.

A key's digest is the md5 of ``prefix|key1|key2|...`` as in ``hashing``; all keys of
one length are worked on together, so a digest costs a fraction of its expression.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np

_SHIFTS = [7, 12, 17, 22] * 4 + [5, 9, 14, 20] * 4 + [4, 11, 16, 23] * 4 + [6, 10, 15, 21] * 4
_ADDED = [np.uint32(int(abs(math.sin(t + 1)) * 2 ** 32)) for t in range(64)]
_START = (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)
# Bytes of a key that fit one md5 block; rows worked on at a time, so that their words stay in the cache.
_ONE_BLOCK = 55
_ROWS = 8192


def _md5_words(words: np.ndarray) -> list[np.ndarray]:
    """The four 32-bit words of the md5 of one-block messages, given as 16 rows of words."""
    a, b, c, d = (np.full(words.shape[1], s, np.uint32) for s in _START)
    start = a, b, c, d
    for t in range(64):
        if t < 16:
            mixed, at = d ^ (b & (c ^ d)), t
        elif t < 32:
            mixed, at = c ^ (d & (b ^ c)), (5 * t + 1) % 16
        elif t < 48:
            mixed, at = b ^ c ^ d, (3 * t + 5) % 16
        else:
            mixed, at = c ^ (b | ~d), 7 * t % 16
        turned = a + mixed + words[at] + _ADDED[t]
        turned = (turned << np.uint32(_SHIFTS[t])) | (turned >> np.uint32(32 - _SHIFTS[t]))
        a, b, c, d = d, b + turned, b, c
    return [x + y for x, y in zip(start, (a, b, c, d))]


def _digests(prefixes: list[bytes], keys: list[np.ndarray], sizes: tuple[int, ...]) -> list[np.ndarray]:
    """For each of the prefixes, which are of one length, the digests of keys whose columns have
    ``sizes`` digits, as two big-endian halves a row."""
    n, length = len(keys[0]), len(prefixes[0]) + sum(sizes) + len(sizes)
    if length > _ONE_BLOCK:
        rows = [b"".join(b"|%d" % v for v in row) for row in zip(*(k.tolist() for k in keys))]
        return [np.frombuffer(b"".join(hashlib.md5(prefix + row).digest() for row in rows), ">u8").reshape(n, 2)
                .astype(np.uint64) for prefix in prefixes]
    block, at = np.zeros((n, 64), np.uint8), len(prefixes[0])
    for key, size in zip(keys, sizes):
        block[:, at] = ord("|")
        at += size + 1
        left = key.astype(np.uint32) if size < 10 else key
        for place in range(at - 1, at - 1 - size, -1):
            rest = left // 10
            block[:, place] = left - rest * 10 + ord("0")
            left = rest
    block[:, at] = 0x80
    block[:, 56:58] = np.array([8 * length], "<u2").view(np.uint8)
    out = []
    for prefix in prefixes:
        block[:, :len(prefix)] = np.frombuffer(prefix, np.uint8)
        words = np.ascontiguousarray(block.view("<u4").T).astype(np.uint32, copy=False)
        a, b, c, d = (w.byteswap().astype(np.uint64) for w in _md5_words(words))
        out.append(np.column_stack([a << np.uint64(32) | b, c << np.uint64(32) | d]))
    return out


def number_pairs(seed: int, purposes: list[str], *keys: np.ndarray | int) -> list[tuple[np.ndarray, np.ndarray]]:
    """``hashing.hash52_pair`` of integer columns for each of the purposes.

    At least one key is a column; plain integers stand for every row.
    """
    n = next(len(k) for k in keys if isinstance(k, np.ndarray))
    columns = [np.asarray(np.broadcast_to(k, n), np.int64) for k in keys]
    if any((k < 0).any() for k in columns):
        raise ValueError("keys must not be negative")
    if len({len(p) for p in purposes}) > 1:
        return [pair for p in purposes for pair in number_pairs(seed, [p], *keys)]
    prefixes, out = [f"{seed}|{p}".encode() for p in purposes], [np.empty((n, 2), np.uint64) for _ in purposes]
    tens = 10 ** np.arange(1, 19, dtype=np.int64)
    for at in range(0, n, _ROWS):
        part = [k[at:at + _ROWS] for k in columns]
        sizes = [np.searchsorted(tens, k, "right") + 1 for k in part]
        kind = sum(s * 20 ** c for c, s in enumerate(sizes))  # sizes are below 20
        for same in np.unique(kind):
            rows = np.flatnonzero(kind == same)
            digests = _digests(prefixes, [k[rows] for k in part], tuple(int(s[rows[0]]) for s in sizes))
            for whole, some in zip(out, digests):
                whole[at + rows] = some
    return [((high >> np.uint64(12)).astype(np.int64),
             ((high & np.uint64(0xFFF)) << np.uint64(40) | low >> np.uint64(24)).astype(np.int64))
            for high, low in (halves.T for halves in out)]


def number_pair(seed: int, purpose: str, *keys: np.ndarray | int) -> tuple[np.ndarray, np.ndarray]:
    """``number_pairs`` of one purpose."""
    return number_pairs(seed, [purpose], *keys)[0]
