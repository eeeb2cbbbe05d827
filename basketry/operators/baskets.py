"""Baskets in long form, their sizes, orientation, and dense ids.

A basket table is distinct ``(basket, item)`` rows.  Nothing here gathers a
basket into one array: sizes are aggregates, filters are semi joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry.session import Scope, cut_lineage


def baskets(df: DataFrame, basket: str, item: str) -> DataFrame:
    """Distinct ``(basket, item)`` rows; a repeated interaction counts once."""
    return (df.select(F.col(basket).alias("basket"), F.col(item).alias("item"))
            .where(F.col("basket").isNotNull() & F.col("item").isNotNull())
            .distinct())


def transpose(inc: DataFrame) -> DataFrame:
    """Swap orientation: items become baskets (item -> its users)."""
    return inc.select(F.col("item").alias("basket"), F.col("basket").alias("item"))


def basket_sizes(inc: DataFrame) -> DataFrame:
    """``(basket, size)`` with partial aggregation (no basket is gathered)."""
    return inc.groupBy("basket").agg(F.count(F.lit(1)).alias("size"))


def with_min_size(inc: DataFrame, thre: int) -> DataFrame:
    """Keep baskets whose size is strictly greater than ``thre``."""
    big = basket_sizes(inc).where(F.col("size") > thre).select("basket")
    return inc.join(big, "basket", "left_semi")


def dense_index(df: DataFrame, order_cols: list[str], name: str = "idx",
                partitions: int | None = None) -> DataFrame:
    """0-based position of each row in the order of ``order_cols`` (keys unique).

    Distributed: the rows are range-partitioned and sorted within partitions,
    each row takes its local position, and each partition's offset is the
    running total of the partition sizes before it.  Only one row per
    partition (the sizes) is combined in a single place, never the data.
    """
    with Scope() as scope:
        ranged = df.repartitionByRange(partitions, *order_cols) if partitions else df.repartitionByRange(*order_cols)
        # The layout is written once; sizes and rows are read from that table,
        # so both see the same partitions whatever is recomputed.
        laid = scope.table(ranged.sortWithinPartitions(*order_cols)
                           .withColumn("_pid", F.spark_partition_id())
                           .withColumn("_pos", F.monotonically_increasing_id())
                           .withColumn("_pos", F.col("_pos") - F.shiftleft(F.col("_pid").cast("long"), 33)))
        sizes = laid.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
        offsets = sizes.select("_pid", F.coalesce(F.sum("_n").over(
            Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
        out = (laid.join(offsets, "_pid")  # one row per partition
               .withColumn(name, F.col("_off") + F.col("_pos")).drop("_pid", "_pos", "_off"))
        return cut_lineage(out)


def dense_ids(inc: DataFrame, col: str = "item", name: str = "idx") -> DataFrame:
    """Dense id of each distinct value of ``col`` in ascending order."""
    return dense_index(inc.select(col).distinct(), [col], name)


def rank_within(df: DataFrame, keys: list[str], order: str | list[str], name: str = "_r",
                size_name: str = "_m") -> DataFrame:
    """0-based rank by ``order`` inside each ``keys`` group, plus the group size.

    One range-partitioned dense index over ``keys + order`` (unique), less the
    group's first index: a group that holds a large share of all rows is
    ranked by many tasks.
    """
    order = [order] if isinstance(order, str) else list(order)
    ranked = dense_index(df, keys + order, "_i")
    if not keys:
        return ranked.withColumn(size_name, F.lit(ranked.count())).withColumnRenamed("_i", name)
    starts = ranked.groupBy(*keys).agg(F.min("_i").alias("_s"), F.count(F.lit(1)).alias(size_name))
    return ranked.join(starts, keys).withColumn(name, F.col("_i") - F.col("_s")).drop("_i", "_s")
