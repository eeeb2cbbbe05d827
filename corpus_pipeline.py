"""A corpus pipeline over ``documents``: five stages of the operators, each written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm.bpe_chunks import round_trip
from basketry.llm.common import crc_mod, staged
from basketry.llm.minhash_bayes import keep_one
from basketry.llm.mixing import mix
from basketry.llm.quality_qda import keep_good
from basketry.llm.suffix_dedup import remove_repeats


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality discriminant accepts; it learns from labels whose crc32 mod 3 is not 1."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", F.col("quality").alias("label"))
    return keep_good(docs, labels, crc_mod(3) != 1)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five-word shingles that are alike by 0.8 or more."""
    return keep_one(docs, threshold_pct=80)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the 50-byte passages that a document with a smaller id has too."""
    return remove_repeats(docs).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources mixed to square-root weights; a document may come twice."""
    return mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the digests of their token ids and of the decoded text."""
    return round_trip(docs)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("mixture", mixture),
    ("tokens", tokens),
]

#: A discriminant's fit and byte-pair merges are not expressible in SQL; the stages have brute-force tests.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
