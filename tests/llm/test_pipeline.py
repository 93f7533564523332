import public_tokenizers

import corpus_pipeline as C
from pairrank.llm import decontaminate, exact_dedup, near_dedup, packing, toxicity

from .conftest import INTERNAL, SF, pairs_of
from .test_exact_dedup import brute as brute_exact
from .test_near_dedup import brute as brute_near


def test_run_against_brute_force(spark, small_docs):
    labels, items = spark.read.parquet(f"{SF}/labels.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet").collect()
    scores = toxicity.score(small_docs, toxicity.fit(small_docs, labels)).collect()
    clean = {r.doc_id for r in scores if not r.predicted}
    rows = [r for r in pairs_of(small_docs) if r[0] in clean]
    stay = {r[0] for r in brute_exact(rows) if r[3]}
    rows = [r for r in rows if r[0] in stay]
    stay = {r[0] for r in brute_near(rows, 5) if r[3]}
    rows = [r for r in rows if r[0] in stay]
    rows = [r for r in rows if not any(decontaminate.normal(i.text) in decontaminate.normal(r[1]) for i in items)]
    got = C.run(spark, SF).collect()
    assert {r.doc_id for r in got} == {d for d, _ in rows}
    wanted = packing.token_pieces(small_docs, public_tokenizers.path("byte_bpe_50k.json")).collect()
    key = lambda r: (r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens)
    assert sorted(map(key, got)) == sorted(key(r) for r in wanted if r.doc_id in {d for d, _ in rows})


def test_stages_on_edge_cases(spark, edge_docs, no_docs):
    for docs in (edge_docs, no_docs):
        for name, stage in C.STAGES:
            out = stage(spark, docs, SF)
            if name != "packing":
                assert out.dtypes == docs.dtypes
            assert (out.count() == 0) == (docs is no_docs)
    assert [n for n, _ in C.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "decontamination", "packing"]
    assert exact_dedup and near_dedup


def test_users_columns_come_back_untouched(spark):
    """Columns with the names the stages use inside keep their values, and rows go as without them."""
    long = {k: " ".join(f"{k}{j}" for j in range(40)) for k in "abcd"}
    texts = [(1, long["a"]), (1, long["a"]), (2, long["a"] + " "), (3, long["b"]), (4, long["b"] + " more"), (5, long["c"]),
             (None, long["d"]), (None, long["d"]), (6, None), (6, None), (7, ""), (8, "  ")]
    schema = "doc_id bigint, text string, " + ", ".join(f"`{c}` string" for c in INTERNAL)
    docs = spark.createDataFrame([(*t, *[f"{c}!" for c in INTERNAL]) for t in texts], schema)
    plain = docs.select("doc_id", "text")
    for name, stage in C.STAGES[:-1]:
        got = stage(spark, docs, SF)
        assert got.dtypes == docs.dtypes
        rows = got.collect()
        assert all(tuple(r)[2:] == tuple(f"{c}!" for c in INTERNAL) for r in rows)
        assert sorted((tuple(r)[:2] for r in rows), key=repr) == sorted(map(tuple, stage(spark, plain, SF).collect()), key=repr), name
    kept = sorted(map(tuple, C.exact_dedup_stage(spark, docs, SF).select("doc_id", "text").collect()), key=repr)
    assert kept == sorted([(2, long["a"] + " "), (3, long["b"]), (4, long["b"] + " more"), (5, long["c"]),
                           (None, long["d"]), (8, "  ")], key=repr)
    kept = sorted(map(tuple, C.near_dedup_stage(spark, docs, SF).select("doc_id", "text").collect()), key=repr)
    assert [r[0] for r in kept] == [1, 3, 5, 6, 6, 7, 8, None]
