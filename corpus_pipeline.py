"""A training-corpus pipeline over ``documents``: toxic documents go, then exact
copies, near copies and documents that hold a benchmark item; what stays is
encoded with a SentencePiece vocabulary and decoded again.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next stage's ``docs``.  All stages but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from inspecta.llm import decontaminate, exact_dedup, sentencepiece_bpe, simhash_dedup, toxicity
from inspecta.llm.base import stored, table
from inspecta.llm.registry import piece_model
from inspecta.session import ship_package

ORACLE_SQL = None       # fingerprints, learned weights and encodings can't be written in SQL


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: learn from the labelled rows, drop documents predicted toxic."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.drop_toxic(docs, model)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: of equal texts the row with the largest doc_id stays."""
    return exact_dedup.keep(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: of each group of linked fingerprints one document stays."""
    ship_package(spark)
    return simhash_dedup.keep_one(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: drop documents that hold a benchmark item."""
    return decontaminate.drop_leaked(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: token counts and digests of the ids and of the decoded text."""
    ship_package(spark)
    return sentencepiece_bpe.stored_digests(docs, piece_model())


STAGES = [("toxicity", drop_toxic), ("exact_dedup", drop_copies), ("near_dedup", drop_near_copies),
          ("decontaminate", drop_leaks), ("sentencepiece", encode)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
