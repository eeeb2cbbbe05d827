"""Interaction relations derived from the test tables.

Each function returns distinct ``(basket, item)`` rows (long form) read from
the Parquet tables, so its size grows with the data.  Column names are the
generic ``basket`` / ``item`` the operators take by default.

=============  =========================  ==============================
relation       basket                     item
=============  =========================  ==============================
order_type     ``lineitem.l_orderkey``    ``part.p_type``
order_brand    ``lineitem.l_orderkey``    ``part.p_brand``
user_k         ``events.user_id``         ``events.props`` ``$.k``
cust_part      ``orders.o_custkey``       ``lineitem.l_partkey``
doc_word       ``documents.doc_id``       lower-case word of ``text``
=============  =========================  ==============================
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.functions.text import words
from basketry.sources.readers import read_table


def order_part_attr(spark: SparkSession, sf_dir: str, attr: str) -> DataFrame:
    """Part attributes per order, laid out by order: what follows per basket needs no further shuffle, and an order is a few rows."""
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    part = read_table(spark, sf_dir, "part").select("p_partkey", F.col(attr).alias("item"))
    return (li.join(part, li.l_partkey == part.p_partkey)
            .select(F.col("l_orderkey").alias("basket"), "item")
            .where(F.col("item").isNotNull())
            .repartition("basket").distinct())


def order_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_part_attr(spark, sf_dir, "p_type")


def order_brand(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_part_attr(spark, sf_dir, "p_brand")


def user_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events").select("user_id", "props")
    return (ev.select(F.col("user_id").alias("basket"),
                      F.get_json_object("props", "$.k").alias("item"))
            .where(F.col("basket").isNotNull() & F.col("item").isNotNull())
            .distinct())


#: Line items of a task of ``cust_part``: as many tasks as they ask for, so that none grows with the tables.
TASK_ROWS = 1_000_000


def cust_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    parts = max(1, -(-li.count() // TASK_ROWS))
    return (li.repartition(parts, "l_orderkey").join(orders.repartition(parts, "o_orderkey"), li.l_orderkey == orders.o_orderkey)
            .select(F.col("o_custkey").alias("basket"), F.col("l_partkey").alias("item"))
            .repartition(parts, "basket", "item").distinct())


def doc_word(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words per document, laid out by document: what follows per set needs no further shuffle, and a document is one row's text."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text").where(F.col("doc_id").isNotNull())
    return (docs.select(F.col("doc_id").alias("basket"), F.explode(words("text")).alias("item"))
            .repartition("basket").distinct())


def doc_word_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_word`` with the rows of a document together in one task, as its text gives them.

    Texts are laid out, not words, and only where their files alone give fewer
    tasks than cores; no task compares or sorts words, save those of documents
    that share an id, which are one set.
    """
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text").where(F.col("doc_id").isNotNull())
    again = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc_id")

    def rows(some: DataFrame) -> DataFrame:
        return some.select(F.col("doc_id").alias("basket"), F.explode(words("text")).alias("item"))

    if again.isEmpty():
        few = docs.rdd.getNumPartitions() < spark.sparkContext.defaultParallelism
        return rows(docs.repartition("doc_id") if few else docs)
    shared = rows(docs.join(again, "doc_id", "left_semi")).repartition("basket").distinct().sortWithinPartitions("basket")
    return rows(docs.join(again, "doc_id", "left_anti")).unionByName(shared)
