"""Partition layout profile: rows per partition of the layout as read, of Spark's hash layout, and of a custom one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rows_per_partition(df: DataFrame, layout: str, n: int) -> DataFrame:
    """``(layout, partition, n_items)``: one row per partition ``0..n-1``, empty ones included."""
    counted = df.select(F.spark_partition_id().alias("partition")).groupBy("partition").agg(F.count(F.lit(1)).alias("n_items"))
    every = df.sparkSession.range(n).select(F.col("id").cast("int").alias("partition"))
    return every.join(counted, "partition", "left").select(
        F.lit(layout).alias("layout"), "partition", F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"))


def hash_layout(df: DataFrame, n: int, key: str) -> DataFrame:
    """``repartition(n, key)``: Spark's Murmur3 hash partitioning on ``key``."""
    return df.repartition(n, key)


def key_placement(df: DataFrame, n: int, key: str) -> DataFrame:
    """``(key, n_partitions, n_items)`` in the real hash layout: a key lies in one partition."""
    return (hash_layout(df.select(key), n, key).withColumn("_p", F.spark_partition_id())
            .groupBy(key).agg(F.count_distinct("_p").alias("n_partitions"), F.count(F.lit(1)).alias("n_items")))


def custom_layout(df: DataFrame, n: int, place: Column) -> DataFrame:
    """Each row in the partition that ``place`` (an integer expression of its key) names, modulo ``n``; null in 0."""
    return df.repartitionById(n, place.cast("int"))


def partition_profile(df: DataFrame, n: int, key: str, place: Column | None = None) -> DataFrame:
    """Rows per partition as read (``default``), of ``repartition(n, key)`` (``hash``) and, given ``place``, of ``custom_layout``."""
    out = rows_per_partition(df, "default", df.rdd.getNumPartitions()).unionByName(
        rows_per_partition(hash_layout(df, n, key), "hash", n))
    return out if place is None else out.unionByName(rows_per_partition(custom_layout(df, n, place), "custom", n))


def profile_summary(profile: DataFrame) -> DataFrame:
    """Per layout: partition count, total, largest and smallest partition, skew (null without rows)."""
    return (profile.groupBy("layout")
            .agg(F.count(F.lit(1)).alias("n_partition"),
                 F.sum("n_items").alias("n_rows"),
                 F.max("n_items").alias("max_items"),
                 F.min("n_items").alias("min_items"))
            .withColumn("skew", F.when(F.col("n_rows") > 0, F.col("max_items") / (F.col("n_rows") / F.col("n_partition")))))
