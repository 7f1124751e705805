"""From raw documents to tokens: five corpus operators in a row.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read again
as the next stage's docs. All stages but the last keep the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablebridge.llm import bpe_codec, decontam, language_id, minhash, queries, secret_scan
from tablebridge.llm.common import cut, ensure_checkpoint_dir


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without a letter and those that are likelier no learned language at all (other languages, shuffled
    or random letters) than some; texts that mix learned languages stay."""
    return language_id.keep_identified(docs, queries.language_model(docs.where(queries._fold("doc_id", 4) != 2)))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest id of each group of near copies: shingles of five words, similarity 0.8."""
    return minhash.drop_near_duplicates(docs, minhash.Settings(words=5, percent=80))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that hold at least 0.8 of a benchmark item, in any order."""
    return decontam.remove_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks secrets; no document goes."""
    redacted = secret_scan.redact(docs, path_col="source", count_col="__tb_secrets")
    changed = F.when(F.col("__tb_secrets") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return redacted.withColumn("n_chars", changed).select(*docs.columns)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and digests of the token ids and of the text they decode to."""
    return bpe_codec.round_trip(docs, queries._vocabulary())


STAGES = [
    ("language_id", identify_language),
    ("near_dedup", near_dedup),
    ("decontamination", decontaminate),
    ("secret_scan", mask_secrets),
    ("bpe", tokenize),
]

#: A trained network and a tokenizer aren't SQL: the pipeline is tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``. Stages meet in Parquet files in the shared checkpoint folder, which go when they are used."""
    ensure_checkpoint_dir(spark)
    folder = f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/pipeline-{uuid.uuid4().hex}"
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    try:
        docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
        for k, (_, stage) in enumerate(STAGES[:-1]):
            stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
            docs = spark.read.parquet(f"{folder}/{k}")
        return cut(STAGES[-1][1](spark, docs, sf_dir))
    finally:
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
