"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that the next one reads
back from Parquet; all but the last keep the columns of `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corpusloom.llm.common import written
from corpusloom.llm.exact_dedup import drop_copies
from corpusloom.llm.jaccard_join import keep_one_of_each
from corpusloom.llm.packing import pack
from corpusloom.llm.quality_rules import keep_good
from corpusloom.llm.secret_scan import redact


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule or the learned decision list rejects go."""
    return keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (but for white space) the smallest id stays."""
    return drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles at 0.75 the smallest id stays."""
    return keep_one_of_each(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret found becomes a mark; all documents stay."""
    return redact(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 4,096 tokens in sequences of about equal cost."""
    import public_tokenizers

    return pack(docs, public_tokenizers.path("word_bpe_49k.json"), keeps_space=False, plain_specials=False)


STAGES = [("quality", quality), ("exact_dedup", copies), ("near_dedup", near_copies), ("secrets", secrets), ("packing", packing)]

#: Token ids and learned verdicts have no counterpart in SQL; the tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
