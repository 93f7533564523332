"""The corpus pipeline: five stages over ``documents``, each on all its predecessor kept.

1. toxicity         documents scored toxic go
2. exact dedup      one document of each group of equal texts stays
3. near dedup       one document of each component (five-word shingles, 0.8) stays
4. decontamination  documents in which a benchmark item occurs go
5. packing          pieces of the remaining documents in sequences of 2048 ids

``STAGES`` has (name, function); each function takes (spark, docs, sf_dir).
Every result is written as Parquet to the shared folder and read again as the
next stage's ``docs``.  Rows with a null text, repeated rows and empty tables
follow the rules each operator states; extra columns pass through.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from pairrank.llm import decontaminate, exact_dedup, near_dedup, packing, toxicity
from pairrank.llm.common import load
from pairrank.session import delete_path, materialise, ship_package


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return toxicity.drop_toxic(docs, load(spark, sf_dir, "labels"))


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return exact_dedup.drop_duplicates(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return near_dedup.drop_near_duplicates(docs, width=5)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return decontaminate.drop_contaminated(docs, load(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("toxicity", toxicity_stage), ("exact_dedup", exact_dedup_stage), ("near_dedup", near_dedup_stage),
          ("decontamination", decontamination_stage), ("packing", packing_stage)]

# Near duplicates, edit distances and token ids are beyond SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over ``documents``."""
    docs, before = load(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if before is not None:
            delete_path(spark, before)
        before = docs._scratch_path
    return docs
