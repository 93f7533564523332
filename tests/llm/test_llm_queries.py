import duckdb
import pytest

import __spark_entry__ as entry
from pairrank.llm import queries as Q

from .conftest import SF


def test_registered():
    names = entry.queries()
    assert {f"op{n}" for n in range(1, 14)} == {k.split("_")[0] for k in Q.queries()}
    assert set(Q.queries()) | {"pipeline"} <= set(names) and set(Q.oracle_sql()) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "labels", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got, want = Q.queries()[name](spark, SF).toPandas(), con.execute(Q.oracle_sql()[name]).df()
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    rows = [sorted((tuple(None if v is None or v != v else v for v in r) for r in df[columns].itertuples(index=False)), key=repr)
            for df in (got, want)]
    assert rows[0] == rows[1]


def test_query_columns(spark):
    want = {
        "op1_packing": ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
        "op8_id_store": ["doc_id", "start", "n_tokens", "ids_crc32"],
        "op10_prefix_counts": ["doc_id", "n_bytes", "n_tokens", "over_limit"],
        "op13_quality_rules": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                               "kept", "rule"],
    }
    n = spark.read.parquet(f"{SF}/documents.parquet").count()
    for name, columns in want.items():
        df = Q.queries()[name](spark, SF)
        assert df.columns == columns and df.select("doc_id").distinct().count() == n
