"""Corpus pipeline: quality, near-duplicates, substrings, personal data, packing.

Each stage takes what its predecessor kept, as a table with the columns of
``documents``, and its decisions take effect; the last returns packed pieces.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.llm.common import table
from ledgerflow.llm.fpe_pii import pseudonym_column
from ledgerflow.llm.minmax_dedup import minmax_dedup
from ledgerflow.llm.packing import pack
from ledgerflow.llm.quality_gam import scorer, train
from ledgerflow.llm.queries import tokenizer
from ledgerflow.llm.suffix_dedup import substring_dedup
from ledgerflow.session import ensure_checkpoint_dir

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
KEEP = 0.3


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents of score 0.3 or more (operator 2); the model is learnt from the labelled ones among ``docs``."""
    score = scorer(docs, train(docs, table(spark, sf_dir, "labels", "doc_id", "quality")))
    return docs.where(score("text") >= KEEP)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of the smallest id of each group (operator 7). Rows that share an id are one document."""
    found = minmax_dedup(docs.select("doc_id", "text"))
    name = "gone"
    while name.lower() in [c.lower() for c in docs.columns]:
        name += "_"
    gone = found.where("not kept").select(F.col("doc_id").alias(name)).distinct()
    return docs.join(gone, F.col("doc_id").eqNullSafe(F.col(name)), "left_anti")


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes out repeated passages (operator 9); documents of which no word is left go."""
    return _with_length(substring_dedup(docs).where(F.col("text").rlike(r"[^\x20\x09-\x0D]")))


def personal_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by pseudonyms (operator 10)."""
    return _with_length(docs.withColumn("text", pseudonym_column()("text")))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left into sequences of 1024 tokens (operator 8)."""
    return pack(docs, tokenizer("byte_bpe_50k.json"))


def _with_length(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("substrings", substring_stage),
    ("personal_data", personal_data_stage),
    ("packing", packing_stage),
]

#: SQL can't train the classifier of the first stage; the tests hold the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/ledgerflow-pipeline/{uuid.uuid4().hex}"
    for name, stage in STAGES:
        out = stage(spark, docs, sf_dir)
        out.write.parquet(f"{folder}/{name}")
        docs = spark.read.schema(out.schema).parquet(f"{folder}/{name}")
    return docs
