"""The registered queries of the operators: thin contracts over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm.bpe_chunks import encode_decode
from basketry.llm.common import crc_mod
from basketry.llm.kd_topk import top_k
from basketry.llm.minhash_bayes import near_duplicates
from basketry.llm.mixing import copies
from basketry.llm.periodic_runs import run_digests
from basketry.llm.pfor_files import token_files
from basketry.llm.ppm import ppm_scores
from basketry.llm.quality_qda import quality_scores
from basketry.llm.rabitq import near_vectors
from basketry.llm.suffix_dedup import repeats
from basketry.llm.toxicity_weak import toxicity_scores
from basketry.llm.url_filter import judge_urls
from basketry.llm.whitening import whiten

#: The rules of ``op11``, and what each does.
URL_RULES = (
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_qda(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    scored = quality_scores(table(spark, sf_dir, "documents"), labels, crc_mod(3) != 1)
    return scored.select("doc_id", (~F.col("learn")).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return copies(table(spark, sf_dir, "documents"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats(table(spark, sf_dir, "documents"))


def op4_rabitq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


def op5_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = ppm_scores(table(spark, sf_dir, "documents"), crc_mod(5) != 1)
    return scored.select("doc_id", (~F.col("learn")).alias("held_out"), "n_tokens", "n_known", "train_tokens",
                         "base_score", "score")


def op6_pfor_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files(table(spark, sf_dir, "documents"))


def op7_toxicity_weak(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("label"))
    scored = toxicity_scores(table(spark, sf_dir, "documents"), labels, crc_mod(5) != 0)
    return scored.select("doc_id", (~F.col("learn")).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op8_bpe_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_decode(table(spark, sf_dir, "documents"))


def op9_kd_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op10_minhash_bayes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op11_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_digests(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_qda": op1_quality_qda,
    "op2_mixing": op2_mixing,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_rabitq": op4_rabitq,
    "op5_ppm": op5_ppm,
    "op6_pfor_files": op6_pfor_files,
    "op7_toxicity_weak": op7_toxicity_weak,
    "op8_bpe_chunks": op8_bpe_chunks,
    "op9_kd_topk": op9_kd_topk,
    "op10_minhash_bayes": op10_minhash_bayes,
    "op11_url_filter": op11_url_filter,
    "op12_whitening": op12_whitening,
    "op13_periodic_runs": op13_periodic_runs,
}
