import array
import itertools
import random
import zlib

import public_tokenizers
from tokenizers import Tokenizer

from pairrank.llm import packing as P

from .conftest import pairs_of

PATH = public_tokenizers.path("byte_bpe_50k.json")


def check(docs, **options):
    tok = Tokenizer.from_file(PATH)
    want = {}
    for d, t in pairs_of(docs):
        want.setdefault(d, []).append(tok.encode(t, add_special_tokens=False).ids + [1])
    rows = P.pack_documents(docs, PATH, **options).collect()
    size = options.get("sequence", 2048)
    cut = []
    for d, lists in want.items():
        for ids in lists:
            for at in range(0, len(ids), size):
                part = ids[at:at + size]
                cut.append((d, at, len(part), zlib.crc32(array.array("I", part).tobytes()), len(ids)))
    assert sorted([(r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows], key=repr) == sorted(cut, key=repr)
    for _, group in itertools.groupby(sorted(rows, key=lambda r: (r.sequence_id, r.offset)), key=lambda r: r.sequence_id):
        at = 0
        for r in group:
            assert r.offset == at
            at += r.length
        assert at <= size
    return rows


def test_edge_cases(edge_docs, no_docs):
    check(edge_docs)
    assert P.pack_documents(no_docs, PATH).count() == 0


def test_small_table_has_little_padding(small_docs):
    rows = check(small_docs)
    n = len({r.sequence_id for r in rows})
    assert sum(r.length for r in rows) > 0.98 * 2048 * n


def test_closest_fill_against_all_subsets():
    rnd = random.Random(4)
    for _ in range(300):
        items = [rnd.randrange(1, 40) for _ in range(rnd.randrange(1, 9))]
        room = rnd.randrange(1, 90)
        counts = {x: items.count(x) for x in items}
        got = P.closest_fill(sorted(counts), counts, room)
        best = max(sum(c) for k in range(len(items) + 1) for c in itertools.combinations(items, k) if sum(c) <= room)
        assert sum(x * n for x, n in got.items()) == best
        assert all(n <= counts[x] for x, n in got.items())


def test_patterns_use_every_piece():
    rnd = random.Random(5)
    counts = {rnd.randrange(1, 101): rnd.randrange(1, 30) for _ in range(40)}
    used = {}
    for lengths, times in P.pack_lengths(counts, 100):
        assert sum(lengths) <= 100
        for x in lengths:
            used[x] = used.get(x, 0) + times
    assert used == counts


def test_sequences_round_trip(small_docs):
    docs = small_docs.limit(40)
    pieces = P.token_pieces(docs, PATH, sequence=256, with_ids=True).cache()
    packed = P.pack_pieces(pieces, sequence=256).cache()
    by_id = {r.sequence_id: r for r in P.sequences(packed, pieces, 256).collect()}
    for r in packed.join(pieces.select("doc_id", "start", "ids"), ["doc_id", "start"]).collect():
        s = by_id[r.sequence_id]
        assert array.array("I", s.ids[r.offset:r.offset + r.length]).tobytes() == bytes(r.ids)
    for s in by_id.values():
        power = s.n_tokens & (s.n_tokens - 1) == 0
        assert s.padded != power and len(s.ids) == (s.n_tokens if power else 256)
        assert not any(s.ids[s.n_tokens:])
