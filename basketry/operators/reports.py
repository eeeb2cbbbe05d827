"""Activity report, top-k and average-by-group ranking.

All of these are single-pass aggregates with map-side (partial) aggregation;
no operator here collects a group or a table to the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.session import cut_lineage


def counts_by(df: DataFrame, key: str, alias: str = "n") -> DataFrame:
    """Rows per key (``reduceByKey(+)`` shape): partial + final aggregate."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias(alias))


def top_k(counts: DataFrame, key: str, k: int = 10, value: str = "n") -> DataFrame:
    """The ``k`` largest counts, ties broken by key ascending.

    ``orderBy(...).limit(k)`` plans as ``TakeOrderedAndProject``: every task
    keeps only its own k best rows, so nothing but k rows per task moves.
    Returns ``(rank, key, value)`` with ``rank`` 1..k.
    """
    best = counts.orderBy(F.col(value).desc(), F.col(key).asc()).limit(k)
    ranked = best.select(
        F.row_number().over(_rank_window(value, key)).alias("rank"), key, value)
    return ranked


def _rank_window(value: str, key: str):
    from pyspark.sql import Window

    # Over at most k rows (after the limit), so one small window is fine.
    return Window.orderBy(F.col(value).desc(), F.col(key).asc())


def top_k_list(counts: DataFrame, key: str, k: int = 10, value: str = "n") -> Column:
    """Scalar subquery: the top-k as ``array<struct<id string, n long>>``, best first."""
    best = counts.orderBy(F.col(value).desc(), F.col(key).asc()).limit(k)
    # At most k rows reach this collect; the struct leads with (-n, key) so
    # that sorting the array restores the ranking order.
    packed = best.agg(F.sort_array(F.collect_list(
        F.struct((-F.col(value)).alias("neg"), F.col(key).alias("key"),
                 F.col(key).cast("string").alias("id"), F.col(value).alias("n")))).alias("l"))
    return packed.select(F.transform("l", lambda s: F.struct(s["id"].alias("id"), s["n"].alias("n")))).scalar()


def kpi_report(df: DataFrame, user: str, item: str, ts: str, year: int, k: int = 10) -> DataFrame:
    """One-row activity report over an interaction table.

    Columns: ``n_review`` (rows), ``n_review_year`` (rows whose ``ts`` falls in
    ``year``), ``n_user`` / ``n_business`` (distinct users / items),
    ``top10_user`` / ``top10_business`` (top-k arrays of ``struct<id, n>``).

    Plan: three aggregates over one scan each of the columns they need, all
    with partial aggregation: the totals (one row even for an empty table),
    and the counts per user and per item, each written once (as many rows as
    there are users or items) for its distinct count and its top k.
    """
    in_year = (F.col(ts) >= F.lit(f"{year}-01-01").cast("timestamp_ntz")) & (
        F.col(ts) < F.lit(f"{year + 1}-01-01").cast("timestamp_ntz"))
    totals = df.agg(F.count(F.lit(1)).alias("n_review"), F.count_if(in_year).alias("n_review_year"))
    per_user, per_item = cut_lineage(counts_by(df, user)), cut_lineage(counts_by(df, item))
    return totals.select(
        "n_review", "n_review_year",
        per_user.agg(F.count(F.lit(1))).scalar().alias("n_user"),
        top_k_list(per_user, user, k).alias("top10_user"),
        per_item.agg(F.count(F.lit(1))).scalar().alias("n_business"),
        top_k_list(per_item, item, k).alias("top10_business"),
    )


def render_top(col: str | Column) -> Column:
    """``array<struct<id,n>>`` -> ``'id:n,id:n,...'`` (order kept)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.array_join(F.transform(c, lambda s: F.concat(s["id"], F.lit(":"), s["n"].cast("string"))), ",")


def report_json(report: DataFrame) -> DataFrame:
    """The report as one JSON object per row (``to_json(struct(*))``)."""
    return report.select(F.to_json(F.struct(*report.columns)).alias("json"))


def avg_by_group(facts: DataFrame, key: str, value: str, dim: DataFrame, dim_key: str,
                 group: str, avg_alias: str = "avg_value", preaggregate: bool = True) -> DataFrame:
    """Average of ``facts.value`` per ``dim.group`` over ``facts ⋈ dim`` on the key.

    Inner-join semantics: facts without a dimension row and groups without
    facts are absent; a duplicated dimension key counts its facts twice.

    With ``preaggregate`` the facts are first reduced to ``(key, sum, count)``
    (partial aggregation, so a hot key costs one row per task), and only that
    goes through the join; the result is identical because sums and counts
    distribute over the join.  Output ``(group, avg_alias, n)``.
    """
    if preaggregate:
        reduced = (facts.where(F.col(key).isNotNull())
                   .groupBy(key).agg(F.sum(value).alias("_s"), F.count(value).alias("_c")))
    else:
        reduced = facts.select(key, F.col(value).alias("_s"),
                               F.when(F.col(value).isNotNull(), F.lit(1)).otherwise(F.lit(0)).alias("_c"))
    joined = reduced.join(dim.select(F.col(dim_key).alias(key), group), key)
    return (joined.groupBy(group)
            .agg((F.sum("_s") / F.sum("_c")).alias(avg_alias), F.sum("_c").alias("n"))
            .where(F.col("n") > 0))


def rank_desc(df: DataFrame, value: str, name: str, k: int | None = None) -> DataFrame:
    """Order by ``value`` descending then ``name`` ascending; optional top-k."""
    out = df.orderBy(F.col(value).desc(), F.col(name).asc())
    return out.limit(k) if k is not None else out


def ties_by_value(df: DataFrame, value: str, member: str) -> DataFrame:
    """Members that share a value (``(avg, [cities])`` in long form).

    One row per member, ``(value, member, n_members)``; the tie's size is a
    partial/final aggregate joined back on the value, so no tie is gathered
    into one row.
    """
    sizes = df.groupBy(value).agg(F.count(F.lit(1)).alias("n_members"))
    return df.select(value, member).join(sizes, value).select(value, member, "n_members")
