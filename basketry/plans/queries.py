"""Named queries over the test tables.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame whose columns
match the DuckDB SQL of the same name in ``basketry.plans.oracle``.  Every
query reads the given tables in full.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.operators import layout, reports
from basketry.operators.baskets import rank_within
from basketry.session import cut_lineage
from basketry.sources.readers import read_table

Query = Callable[[SparkSession, str], DataFrame]

#: Parameters of the registered queries (fixed so that SQL and Spark agree).
KPI_YEAR = 1998
TOP_K = 10
LAYOUT_PARTITIONS = 7


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, sf_dir, name)


# --- reports -----------------------------------------------------------------

def _avg_by_nation(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem").select("l_suppkey", "l_quantity")
    supp = _t(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nation = _t(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    dim = supp.join(nation, supp.s_nationkey == nation.n_nationkey).select("s_suppkey", "n_name")
    return reports.avg_by_group(li, "l_suppkey", "l_quantity", dim, "s_suppkey", "n_name", avg_alias="avg_quantity")


def _rounded(df):
    return df.select("n_name", F.round("avg_quantity", 6).alias("avg_quantity"), "n")


def avg_by_nation(spark, sf_dir):
    return _rounded(_avg_by_nation(spark, sf_dir))


def ranked_nations(spark, sf_dir):
    # The full ranking, with its places; ordered by the exact average, rounded for show.
    ranked = rank_within(_avg_by_nation(spark, sf_dir).withColumn("neg", -F.col("avg_quantity")), [], ["neg", "n_name"])
    return ranked.select((F.col("_r") + 1).alias("place"), "n_name", F.round("avg_quantity", 6).alias("avg_quantity"), "n")


def top_avg_nation(spark, sf_dir):
    return _rounded(reports.rank_desc(_avg_by_nation(spark, sf_dir), "avg_quantity", "n_name", TOP_K))


def ties_by_avg(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem").select("l_suppkey", "l_quantity")
    per_supp = li.groupBy("l_suppkey").agg(F.avg("l_quantity").alias("a"))
    bucketed = per_supp.select(F.floor(F.col("a") * 10).cast("long").alias("avg_bucket"), "l_suppkey")
    return reports.ties_by_value(bucketed, "avg_bucket", "l_suppkey")


def kpi_report(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem").select("l_suppkey", "l_partkey", "l_shipdate")
    rep = reports.kpi_report(li, "l_suppkey", "l_partkey", "l_shipdate", KPI_YEAR, TOP_K)
    return rep.select("n_review", "n_review_year", "n_user", "n_business",
                      reports.render_top("top10_user").alias("top10_user"),
                      reports.render_top("top10_business").alias("top10_business"))


def kpi_report_json(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem").select("l_suppkey", "l_partkey", "l_shipdate")
    rep = reports.kpi_report(li, "l_suppkey", "l_partkey", "l_shipdate", KPI_YEAR, TOP_K)
    return reports.report_json(rep)


def top_users(spark, sf_dir):
    orders = _t(spark, sf_dir, "orders").select("o_custkey")
    return reports.top_k(reports.counts_by(orders, "o_custkey"), "o_custkey", TOP_K)


def top_items(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem").select("l_partkey")
    return reports.top_k(reports.counts_by(li, "l_partkey"), "l_partkey", TOP_K)


def json_fields(spark, sf_dir):
    ev = _t(spark, sf_dir, "events").select("event_id", "props")
    return ev.select(
        "event_id",
        F.get_json_object("props", "$.k").cast("long").alias("k_path"),
        F.regexp_extract("props", r'"k": *([0-9]+)', 1).cast("long").alias("k_regex"),
        F.from_json("props", "k long")["k"].alias("k_parsed"),
    )


# --- layout ------------------------------------------------------------------

def key_placement(spark, sf_dir):
    return layout.key_placement(_t(spark, sf_dir, "lineitem"), LAYOUT_PARTITIONS, "l_suppkey")


def partition_profile(spark, sf_dir):
    # as read, by Spark's hash of the key, and by the key's own remainder
    li = _t(spark, sf_dir, "lineitem").select("l_suppkey")
    return layout.partition_profile(li, LAYOUT_PARTITIONS, "l_suppkey", F.pmod("l_suppkey", F.lit(LAYOUT_PARTITIONS)))


def partition_summary(spark, sf_dir):
    summary = layout.profile_summary(partition_profile(spark, sf_dir)).where("layout = 'hash'")
    return summary.select("layout", "n_partition", "n_rows")


QUERIES: dict[str, Query] = {
    "avg_by_nation": avg_by_nation,
    "ranked_nations": ranked_nations,
    "top_avg_nation": top_avg_nation,
    "ties_by_avg": ties_by_avg,
    "kpi_report": kpi_report,
    "kpi_report_json": kpi_report_json,
    "top_users": top_users,
    "top_items": top_items,
    "json_fields": json_fields,
    "key_placement": key_placement,
    "partition_profile": partition_profile,
    "partition_summary": partition_summary,
}


# --- baskets and itemsets ----------------------------------------------------
from basketry.functions.formatting import itemset_key  # noqa: E402
from basketry.operators import baskets as bk  # noqa: E402
from basketry.operators import itemsets as fi  # noqa: E402
from basketry.sources import relations as rel  # noqa: E402

#: Fixed values.  Support thresholds as integer shares of the basket count
#: (numerator, denominator): sup = n_baskets * num // den, so the queries
#: keep their meaning at every scale factor.
SUP_ORDER_TYPE = (12, 100)
SUP_ORDER_BRAND = (27, 1000)
SUP_USER_K = (3, 10)
SUP_K_USERS = (3, 10)
SUP_MIN_BASKET = (177, 1000)
SUP_SON = (24, 100)
MIN_BASKET_SIZE = 3
SON_CHUNKS = 4
TEST_BUCKETS = 101


def _levels_out(levels: DataFrame) -> DataFrame:
    return levels.select(F.col("k").cast("int").alias("k"), itemset_key("items").alias("itemset"),
                         F.col("support").cast("long").alias("support"))


def baskets_user(spark, sf_dir):
    return bk.basket_sizes(rel.user_k(spark, sf_dir))


def baskets_item(spark, sf_dir):
    return bk.basket_sizes(bk.transpose(rel.user_k(spark, sf_dir)))


def baskets_min_size(spark, sf_dir):
    inc = bk.with_min_size(rel.order_type(spark, sf_dir), MIN_BASKET_SIZE)
    return bk.basket_sizes(inc)


def dense_ids(spark, sf_dir):
    part = _t(spark, sf_dir, "part")
    out = None
    for attr in ("p_type", "p_brand"):
        ids = bk.dense_ids(part.select(F.col(attr).alias("item")).where(F.col("item").isNotNull()))
        ids = ids.select(F.lit(attr).alias("attr"), F.col("item").alias("value"), "idx")
        out = ids if out is None else out.unionByName(ids)
    return out


def freq_itemsets(spark, sf_dir):
    inc = rel.order_type(spark, sf_dir)
    return _levels_out(fi.frequent_itemsets(inc, SUP_ORDER_TYPE))


def freq_itemsets_brand(spark, sf_dir):
    inc = rel.order_brand(spark, sf_dir)
    return _levels_out(fi.frequent_itemsets(inc, SUP_ORDER_BRAND))


def freq_itemsets_transposed(spark, sf_dir):
    inc = bk.transpose(rel.user_k(spark, sf_dir))
    return _levels_out(fi.frequent_itemsets(inc, SUP_K_USERS))


def freq_itemsets_min_basket(spark, sf_dir):
    inc = bk.with_min_size(rel.order_type(spark, sf_dir), MIN_BASKET_SIZE)
    return _levels_out(fi.frequent_itemsets(inc, SUP_MIN_BASKET, prefilter="bucket"))


def bucket_counts(spark, sf_dir):
    inc = fi.prepare(rel.user_k(spark, sf_dir))
    ids = bk.dense_ids(inc, "item", "_id")
    tagged = inc.join(ids, "item").select("basket", "_id")
    return fi.bucket_counts(tagged, "_id", TEST_BUCKETS)


def bucket_pairs(spark, sf_dir):
    inc = fi.prepare(rel.user_k(spark, sf_dir))
    sup = fi.threshold(inc, SUP_USER_K)
    ids = bk.dense_ids(inc, "item", "_id")
    pairs = fi.pairs_in_frequent_buckets(inc.join(ids, "item").select("basket", "_id"), "_id", sup, TEST_BUCKETS)
    l1 = fi.frequent_items(inc, sup).select(F.element_at("items", 1).alias("item")).join(ids, "item")
    name = lambda c: l1.select(F.col("_id").alias(c), F.col("item").alias(f"_{c}"))
    frequent = pairs.select("a", "b").distinct().join(name("a"), "a").join(name("b"), "b")
    return frequent.select(F.col("_a").alias("a"), F.col("_b").alias("b"))


def _son_inputs(spark, sf_dir):
    return rel.order_type(spark, sf_dir), SUP_SON


def son_candidates(spark, sf_dir):
    inc, sup = _son_inputs(spark, sf_dir)
    cands = fi.son_candidates(inc, sup, SON_CHUNKS, chunk=F.pmod(F.col("basket"), F.lit(SON_CHUNKS)))
    return cands.select(F.col("k").cast("int").alias("k"), itemset_key("items").alias("itemset"))


def son_frequent(spark, sf_dir):
    inc, sup = _son_inputs(spark, sf_dir)
    _, freq = fi.son(inc, sup, SON_CHUNKS, chunk=F.pmod(F.col("basket"), F.lit(SON_CHUNKS)))
    return _levels_out(freq)


def son_bucket(spark, sf_dir):
    # SON in two default (hashed) chunks with the bucket filter, on baskets above the size floor.
    inc = bk.with_min_size(rel.order_type(spark, sf_dir), MIN_BASKET_SIZE)
    _, freq = fi.son(inc, SUP_MIN_BASKET, 2, prefilter="bucket")
    return _levels_out(freq)


def apriori_gen(spark, sf_dir):
    inc = fi.prepare(rel.user_k(spark, sf_dir))
    sup = SUP_USER_K
    levels = fi.frequent_itemsets(inc, sup, max_k=2)
    l2 = levels.where(F.col("k") == 2).select("items", "support")
    return fi.apriori_gen(l2, 3).select(itemset_key("items").alias("itemset"))


QUERIES.update({
    "baskets_user": baskets_user,
    "baskets_item": baskets_item,
    "baskets_min_size": baskets_min_size,
    "dense_ids": dense_ids,
    "freq_itemsets": freq_itemsets,
    "freq_itemsets_brand": freq_itemsets_brand,
    "freq_itemsets_transposed": freq_itemsets_transposed,
    "freq_itemsets_min_basket": freq_itemsets_min_basket,
    "bucket_counts": bucket_counts,
    "bucket_pairs": bucket_pairs,
    "son_candidates": son_candidates,
    "son_frequent": son_frequent,
    "son_bucket": son_bucket,
    "apriori_gen": apriori_gen,
})


# --- similarity --------------------------------------------------------------
from basketry.operators import similarity as sim  # noqa: E402

#: Fixed values.  Jaccard threshold, signature length and rows per band of
#: the registered similarity queries.
JACCARD_T = 0.5
N_HASHES = 240
BAND_ROWS = 4


def _doc_sets(spark, sf_dir):
    return sim.prepare(rel.doc_word(spark, sf_dir))


def _doc_set_rows(spark, sf_dir):
    """The same rows, those of a set together."""
    return sim.prepare(rel.doc_word_rows(spark, sf_dir), distinct=True)


def jaccard_exact(spark, sf_dir):
    return sim.jaccard_exact(_doc_set_rows(spark, sf_dir), JACCARD_T, together=True)


def minhash_signatures(spark, sf_dir):
    sigs = sim.signatures(_doc_set_rows(spark, sf_dir), N_HASHES, together=True)
    return sigs.select(F.col("set_id").alias("doc_id"),
                       F.array_join(F.transform("sig", lambda v: v.cast("string")), ",").alias("sig"))


def lsh_candidates(spark, sf_dir):
    sigs = sim.signatures(_doc_set_rows(spark, sf_dir), N_HASHES, together=True)
    return sim.lsh_candidates(sim.bands(sigs, BAND_ROWS, N_HASHES), together=True)


def similar_pairs(spark, sf_dir):
    return sim.similar_pairs(_doc_set_rows(spark, sf_dir), JACCARD_T, N_HASHES, BAND_ROWS, together=True)


QUERIES.update({
    "jaccard_exact": jaccard_exact,
    "minhash_signatures": minhash_signatures,
    "lsh_candidates": lsh_candidates,
    "similar_pairs": similar_pairs,
})


# --- graph -------------------------------------------------------------------
from basketry.operators import graph as gr  # noqa: E402

#: The customer graph takes the largest number of shared parts that gives an edge per so many customers.
USERS_PER_EDGE = 40


def _cust_graph(spark, sf_dir):
    return gr.shared_item_graph(rel.cust_part(spark, sf_dir), USERS_PER_EDGE)


def shared_item_edges(spark, sf_dir):
    return _cust_graph(spark, sf_dir)


def components(spark, sf_dir):
    return gr.connected_components(_cust_graph(spark, sf_dir).select("src", "dst"))


def edge_betweenness(spark, sf_dir):
    eb = gr.edge_betweenness(_cust_graph(spark, sf_dir).select("src", "dst"))
    return eb.select("src", "dst", F.round("betweenness", 4).alias("betweenness"))


def split_round(spark, sf_dir):
    _, labels = gr.split_round(_cust_graph(spark, sf_dir).select("src", "dst"))
    return labels


def modularity(spark, sf_dir):
    edges = _cust_graph(spark, sf_dir).select("src", "dst")
    q = gr.modularity(edges, gr.connected_components(edges))
    return q.select(F.round("modularity", 9).alias("modularity"))


def communities(spark, sf_dir):
    # The full Girvan-Newman sequence: edges are removed until none is left.
    return gr.communities(_cust_graph(spark, sf_dir).select("src", "dst"))


QUERIES.update({
    "shared_item_edges": shared_item_edges,
    "components": components,
    "edge_betweenness": edge_betweenness,
    "split_round": split_round,
    "modularity": modularity,
    "communities": communities,
})


# --- reports (sinks) -----------------------------------------------------------
from basketry.sources import sinks  # noqa: E402


def itemset_report(spark, sf_dir):
    inc, sup = _son_inputs(spark, sf_dir)
    cands, freq = fi.son(inc, sup, SON_CHUNKS, chunk=F.pmod(F.col("basket"), F.lit(SON_CHUNKS)))
    return sinks.itemset_report(cands, freq)


def pair_report(spark, sf_dir):
    return sinks.pair_lines(similar_pairs(spark, sf_dir)).select("id1", "id2", "line")


def edge_report(spark, sf_dir):
    return sinks.edge_lines(edge_betweenness(spark, sf_dir))


def community_report(spark, sf_dir):
    labels = components(spark, sf_dir)
    return sinks.community_lines(labels, "component")


QUERIES.update({
    "itemset_report": itemset_report,
    "pair_report": pair_report,
    "edge_report": edge_report,
    "community_report": community_report,
})


# --- files: tables written in the interaction formats and read back ---------------
from basketry.session import scratch_folder  # noqa: E402
from basketry.sources.readers import read_interactions_csv, read_reviews  # noqa: E402


def json_review_averages(spark, sf_dir):
    # line items as review lines, written as JSON, read by the review reader, averaged per business
    li = _t(spark, sf_dir, "lineitem")
    with scratch_folder(spark) as path:
        li.select(F.col("l_suppkey").cast("string").alias("user_id"), F.col("l_partkey").cast("string").alias("business_id"),
                  F.col("l_quantity").alias("stars"), F.col("l_shipdate").cast("timestamp").alias("date")).write.json(path)
        reviews = read_reviews(spark, path)
        return cut_lineage(reviews.groupBy("business_id").agg(
            F.count(F.lit(1)).alias("n"), F.count_distinct("user_id").alias("n_user"), F.round(F.avg("stars"), 6).alias("stars"),
            F.max(F.year("date")).alias("last_year")))


def csv_interactions(spark, sf_dir):
    # order-type pairs written as CSV with a header and an extra column, read back by name
    inc = rel.order_type(spark, sf_dir).select(F.col("basket").cast("string").alias("user_id"), F.lit("x").alias("extra"), F.col("item").alias("business_id"))
    with scratch_folder(spark) as path:
        inc.write.option("header", True).csv(path)
        return cut_lineage(read_interactions_csv(spark, path, header=["user_id", "extra", "business_id"]))


def ranking_csv(spark, sf_dir):
    with scratch_folder(spark) as path:
        sinks.write_ranking_csv(_rounded(_avg_by_nation(spark, sf_dir)), "avg_quantity", "n_name", path)
        return cut_lineage(spark.read.schema("n_name string, avg_quantity double").option("header", True).option("enforceSchema", False).csv(path))


QUERIES.update({
    "json_review_averages": json_review_averages,
    "csv_interactions": csv_interactions,
    "ranking_csv": ranking_csv,
})
