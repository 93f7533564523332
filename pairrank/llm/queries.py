"""The named queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialise, scratch_path, ship_package
from . import (collocations, decontaminate, exact_dedup, id_store, katz, near_dedup, packing, pii, prefix_counts, quality_rules,
               spelling, toxicity, url_rules)
from .common import load


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return load(spark, sf_dir, "documents")


def op1_packing(spark, sf_dir):
    """Pieces of all documents in sequences of 2048 ids."""
    return packing.pack_documents(_documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def op2_pii(spark, sf_dir):
    """Personal data in all documents."""
    return pii.find_personal_data(_documents(spark, sf_dir))


def op3_near_dedup(spark, sf_dir):
    """Components of documents with similar two-word shingle sets."""
    return near_dedup.near_duplicates(_documents(spark, sf_dir), width=2)


def op4_exact_dedup(spark, sf_dir):
    """Copies among all documents."""
    return exact_dedup.exact_duplicates(_documents(spark, sf_dir))


def op5_decontaminate(spark, sf_dir):
    """Every place where a document repeats a benchmark item within the edit budget."""
    return decontaminate.find_items(_documents(spark, sf_dir), load(spark, sf_dir, "benchmark"))


def op6_katz(spark, sf_dir):
    """Katz back-off scores of all documents."""
    return katz.score_documents(_documents(spark, sf_dir))


def op7_toxicity(spark, sf_dir):
    """Toxicity scores of all documents, learnt from the labelled rows that are not held out."""
    docs = _documents(spark, sf_dir)
    return toxicity.score(docs, toxicity.fit(docs, load(spark, sf_dir, "labels")))


def op8_id_store(spark, sf_dir):
    """All documents' ids written to files and read back."""
    docs, path = _documents(spark, sf_dir), scratch_path(spark, "token-ids")
    id_store.write_ids(docs, public_tokenizers.path("word_bpe_49k.json"), path)
    return id_store.read_ids(spark, path)


def op9_url_rules(spark, sf_dir):
    """Every page's url under the fixed rules."""
    return url_rules.judge_urls(load(spark, sf_dir, "pages"), url_rules.rules_table(spark))


def op10_prefix_counts(spark, sf_dir):
    """The table of token counts at every prefix of all documents, stored; whole counts are read back from it."""
    table = materialise(prefix_counts.prefix_counts(_documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json")),
                        "prefix-counts")
    return prefix_counts.whole_counts(table).withColumn("over_limit", F.col("n_tokens") > prefix_counts.LIMIT)


def op11_spelling(spark, sf_dir):
    """Near words, forms and roots of all words of all documents."""
    return spelling.spelling_variants(_documents(spark, sf_dir))


def op12_collocations(spark, sf_dir):
    """Each language's first 2000 collocations over all documents."""
    return collocations.collocations(_documents(spark, sf_dir))


def op13_quality_rules(spark, sf_dir):
    """All documents under the decision list learnt from the quality labels."""
    return quality_rules.judge_documents(_documents(spark, sf_dir), load(spark, sf_dir, "labels"))


QUERIES = {f.__name__: f for f in (op1_packing, op2_pii, op3_near_dedup, op4_exact_dedup, op5_decontaminate, op6_katz,
                                     op7_toxicity, op8_id_store, op9_url_rules, op10_prefix_counts, op11_spelling,
                                     op12_collocations, op13_quality_rules)}
ORACLES = {"op4_exact_dedup": exact_dedup.ORACLE, "op9_url_rules": url_rules.ORACLE, "op12_collocations": collocations.ORACLE}


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
