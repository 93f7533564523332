import random

import pytest

SF = "/root/testdata/sf0.001"
CLASHING = ["start", "length", "score", "digest", "size", "key", "region", "chunk", "kind", "n", "part", "value"]


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Null ids and texts, empty, blank and very long texts, ties, repeated rows, clashing columns."""
    rnd = random.Random(11)
    prose = [" ".join(rnd.choice(["alpha", "beta", "gamma", "delta", "eps", "zeta"]) for _ in range(60)) for _ in range(4)]
    rows = [(1, prose[0]), (1, prose[0]), (2, prose[0] + " "), (3, "  " + prose[0]), (4, None), (5, ""), (6, " \n\t "),
            (7, prose[1]), (None, prose[1]), (8, prose[2]), (8, prose[3]), (9, "word"), (10, "WORD"), (None, None),
            (11, "x" * 30_000), (12, "long text " * 8_000), (13, "Ünïcödé 你好 🙂 <|endoftext|> a  b\n\n c"),
            (14, "mail a.b@c.example now 4111111111111111 or +1 (743) 555-3824 at 10.0.0.1")]
    schema = "doc_id bigint, text string, " + ", ".join(f"{c} string" for c in CLASHING)
    return spark.createDataFrame([(*r, *["clash"] * len(CLASHING)) for r in rows], schema)


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.where("false")


@pytest.fixture(scope="session")
def small_docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def pairs_of(docs):
    return [(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()]


# Names the operators use inside, in both cases: none of them may disturb a user's column.
INTERNAL = ["row", "text_key", "their_id", "their_key", "fold", "_key", "_digest", "_d", "_t", "_n", "_stays", "_most",
            "_keep", "most", "best", "head", "digest", "set_key", "rep", "sig", "toxic", "vote", "ids", "region_", "N_", "Score",
            "Digest_", "KEEP_ID"]
