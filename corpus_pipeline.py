"""A corpus from raw documents to packed sequences, stage by stage.

Each stage takes what the stage before kept, reread from Parquet, and the folder of the input
tables. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from courtledger.llm.decontamination import drop_leaks
from courtledger.llm.lines import drop_repeated_lines
from courtledger.llm.minhash import drop_near_duplicates
from courtledger.llm.packing import pack
from courtledger.llm.quality import keep_good
from courtledger.llm.subwords import vocabulary
from courtledger.session import scratch_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go."""
    return keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated chunks of lines go from the texts but for their first occurrence."""
    return drop_repeated_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by similar texts (five words, 0.8) the one with the smallest id stays."""
    return drop_near_duplicates(docs, shingle_words=5, threshold=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their sequence and place."""
    return pack(docs, vocabulary("byte_bpe_50k.json"), end_id=2, capacity=1024)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


QUERIES = {"pipeline": run}
#: Subword ids and similarity of sets are beyond SQL; tests hold each stage against brute force.
ORACLE_SQL = None
ORACLE: dict[str, str] = {}
