import array
import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from pairrank.llm import id_store as S

from .conftest import pairs_of

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_elias_fano_select():
    rnd = random.Random(2)
    for n in (0, 1, 2, 63, 64, 65, 700):
        for top in (0, 1, 5, 1000, 10**9):
            values = sorted(rnd.randrange(top + 1) for _ in range(n))
            code, end = S.EliasFano.read(b"xx" + S.EliasFano.of(np.array(values, np.int64)).to_bytes(), 2)
            assert code.all().tolist() == values and [code.select(i) for i in range(n)] == values
            if n == 700 and top == 10**9:
                assert end < 700 * 4  # well under 64 bits a number


def test_segment_round_trip():
    ids = [array.array("I", [7, 70_000, 1]).tobytes(), b"\1\0\0\0", array.array("I", range(500)).tobytes()]
    s = S.Segment(S.write_segment([None, -5, 90], ids))
    assert [s.doc_id(i) for i in range(3)] == [None, -5, 90]
    assert [s.ids(i).tobytes() for i in range(3)] == ids


def test_rows_are_selected(monkeypatch):
    """The rows come from select(); no list is expanded whole."""
    ids = [array.array("I", range(k)).tobytes() for k in range(1, 200)]
    image = S.write_segment([None, *range(-5, 193)], ids)
    monkeypatch.setattr(S.EliasFano, "all", None)
    got = S.segment_rows(image)
    assert got["doc_id"].to_pylist() == [None, *range(-5, 193)] and got["n_tokens"].to_pylist() == list(range(1, 200))
    assert got["_at"].to_pylist() == [k * (k - 1) // 2 for k in range(1, 200)]
    assert got["ids_crc32"].to_pylist() == [zlib.crc32(b) for b in ids]


def check(spark, docs, path, **options):
    tok, at, want = Tokenizer.from_file(PATH), 0, []
    for d, t in sorted(pairs_of(docs), key=lambda r: (r[0] is not None, r[0] or 0, r[1])):
        ids = tok.encode(t, add_special_tokens=False).ids + [1]
        want.append((d, at, len(ids), zlib.crc32(array.array("I", ids).tobytes())))
        at += len(ids)
    S.write_ids(docs, PATH, path, **options)
    assert sorted((tuple(r) for r in S.read_ids(spark, path).collect()), key=lambda r: r[1]) == want


def test_edge_cases(spark, edge_docs, no_docs, tmp_path):
    check(spark, edge_docs, f"{tmp_path}/a")
    check(spark, edge_docs, f"{tmp_path}/b", segment_ids=10, segment_docs=2)
    check(spark, no_docs, f"{tmp_path}/c")


def test_small_table(spark, small_docs, tmp_path):
    check(spark, small_docs, f"{tmp_path}/d", segment_ids=5000)
    arrays = {r.doc_id: r.ids for r in S.read_token_arrays(spark, f"{tmp_path}/d").collect()}
    tok = Tokenizer.from_file(PATH)
    for d, t in pairs_of(small_docs.limit(20)):
        assert arrays[d] == tok.encode(t, add_special_tokens=False).ids + [1]
