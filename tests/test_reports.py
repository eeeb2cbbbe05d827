"""Activity report, top-k, average by group, layout, readers and writers."""

import json
import os

import pytest
from pyspark.sql import functions as F

from basketry.operators import layout, reports
from basketry.sources import read_businesses, read_interactions_csv, read_reviews
from basketry.sources import sinks


def _reviews(spark):
    rows = [
        ("u1", "b1", 4.0, "2018-03-01 10:00:00"),
        ("u1", "b2", 3.0, "2017-03-01 10:00:00"),
        ("u2", "b1", 5.0, "2018-12-31 23:59:59"),
        ("u3", "b3", 2.0, "2019-01-01 00:00:00"),
        ("u2", "b2", 1.0, "2016-05-05 00:00:00"),
        ("u4", "b1", 4.5, "2018-06-01 00:00:00"),
    ]
    return spark.createDataFrame(rows, "user_id string, business_id string, stars double, d string") \
        .withColumn("date", F.to_timestamp("d").cast("timestamp_ntz")).drop("d")


def test_kpi_report_counts_and_ties(spark):
    rep = reports.kpi_report(_reviews(spark), "user_id", "business_id", "date", 2018, k=2).first()
    assert rep["n_review"] == 6
    assert rep["n_review_year"] == 3  # 2018-12-31 23:59:59 included, 2019-01-01 not
    assert rep["n_user"] == 4
    assert rep["n_business"] == 3
    # u1 and u2 tie at 2: key ascending
    assert [(r["id"], r["n"]) for r in rep["top10_user"]] == [("u1", 2), ("u2", 2)]
    assert [(r["id"], r["n"]) for r in rep["top10_business"]] == [("b1", 3), ("b2", 2)]


def test_report_json_round_trip(spark, scratch):
    rep = reports.kpi_report(_reviews(spark), "user_id", "business_id", "date", 2018, k=3)
    out = os.path.join(scratch, "rep")
    sinks.write_json_report(rep, out)
    text = spark.read.text(out).first()[0]
    obj = json.loads(text)
    assert obj["n_review"] == 6 and obj["top10_business"][0] == {"id": "b1", "n": 3}


def test_avg_by_group_inner_join_semantics(spark):
    facts = spark.createDataFrame([("b1", 4.0), ("b1", 2.0), ("b2", 5.0), ("bX", 1.0)], "bid string, stars double")
    dim = spark.createDataFrame([("b1", "Phoenix, AZ"), ("b2", "Montréal"), ("b3", "Nowhere")],
                                "bid string, city string")
    for pre in (True, False):
        out = {r["city"]: (r["avg_value"], r["n"]) for r in
               reports.avg_by_group(facts, "bid", "stars", dim, "bid", "city", preaggregate=pre).collect()}
        assert out == {"Phoenix, AZ": (3.0, 2), "Montréal": (5.0, 1)}  # bX and Nowhere absent
    # a duplicated dimension key counts its facts twice
    dim2 = dim.unionByName(spark.createDataFrame([("b2", "Montréal")], "bid string, city string"))
    out = {r["city"]: r["n"] for r in reports.avg_by_group(facts, "bid", "stars", dim2, "bid", "city").collect()}
    assert out["Montréal"] == 2


def test_rank_desc_and_ties(spark):
    df = spark.createDataFrame([("b", 4.0), ("a", 4.0), ("c", 5.0), ("d", 1.0)], "city string, stars double")
    assert [r["city"] for r in reports.rank_desc(df, "stars", "city").collect()] == ["c", "a", "b", "d"]
    assert [r["city"] for r in reports.rank_desc(df, "stars", "city", k=2).collect()] == ["c", "a"]
    ties = {(r["stars"], r["city"]): r["n_members"] for r in reports.ties_by_value(df, "stars", "city").collect()}
    assert ties == {(4.0, "a"): 2, (4.0, "b"): 2, (5.0, "c"): 1, (1.0, "d"): 1}


def test_empty_activity_report(spark):
    rep = reports.kpi_report(_reviews(spark).limit(0), "user_id", "business_id", "date", 2018).collect()
    assert len(rep) == 1 and rep[0]["n_review"] == 0 and rep[0]["n_user"] == 0 and rep[0]["top10_user"] == []
    assert json.loads(reports.report_json(reports.kpi_report(
        _reviews(spark).limit(0), "user_id", "business_id", "date", 2018)).first()[0])["n_review_year"] == 0


def test_partition_profile_sums(spark):
    df = spark.range(1000).withColumn("key", F.col("id") % 17)
    prof = layout.partition_profile(df, 5, "key")
    sums = {r["layout"]: r["s"] for r in prof.groupBy("layout").agg(F.sum("n_items").alias("s")).collect()}
    assert sums == {"default": 1000, "hash": 1000}
    assert prof.where("layout = 'hash'").count() == 5
    summ = {r["layout"]: r for r in layout.profile_summary(prof).collect()}
    assert summ["hash"]["n_rows"] == 1000


def test_empty_partitions_count(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "key long")
    summ = {r["layout"]: r for r in layout.profile_summary(layout.partition_profile(df, 7, "key")).collect()}
    assert (summ["hash"]["n_partition"], summ["hash"]["min_items"], summ["hash"]["n_rows"]) == (7, 0, 3)
    assert {r["key"]: (r["n_partitions"], r["n_items"]) for r in layout.key_placement(df, 7, "key").collect()} == {1: (1, 2), 2: (1, 1)}
    empty = {r["layout"]: r for r in layout.profile_summary(layout.partition_profile(df.limit(0), 3, "key")).collect()}
    assert (empty["hash"]["n_partition"], empty["hash"]["n_rows"], empty["hash"]["skew"]) == (3, 0, None)


def test_json_lines_reader(spark, scratch):
    path = os.path.join(scratch, "business.json")
    with open(path, "w") as f:
        f.write('{"business_id":"b1","city":"Phoenix, AZ","state":"AZ"}\n')
        f.write('{"business_id":"b2","city":"Montr\\u00e9al","state":"QC"}\n')
    rows = {r["business_id"]: r["city"] for r in read_businesses(spark, path).collect()}
    assert rows == {"b1": "Phoenix, AZ", "b2": "Montréal"}
    bad = os.path.join(scratch, "reviews.json")
    with open(bad, "w") as f:
        f.write('{"user_id":"u1","business_id":"b1","stars":4.0,"date":"2018-01-02 10:00:00"}\n')
        f.write('not json at all\n')
    with pytest.raises(Exception):
        read_reviews(spark, bad).collect()
    perm = read_reviews(spark, bad, mode="PERMISSIVE").collect()
    assert len(perm) == 2 and sum(r["_corrupt_record"] is not None for r in perm) == 1


def test_a_line_without_an_id_fails(spark, scratch):
    path = os.path.join(scratch, "reviews.json")
    with open(path, "w") as f:
        f.write('{"user_id":"u1","business_id":"b1","stars":4.0,"date":"2018-01-02 10:00:00"}\n{"business_id":"b1","stars":1.0}\n')
    with pytest.raises(Exception, match="no user_id"):
        read_reviews(spark, path).collect()


def test_csv_reader_header_and_nulls(spark, scratch):
    path = os.path.join(scratch, "ub.csv")
    with open(path, "w") as f:
        f.write("user_id,extra,business_id\nu1,x,b1\nu1,y,b2\nu2,w,b1\n")
    names = ["user_id", "extra", "business_id"]
    rows = read_interactions_csv(spark, path, header=names).collect()
    assert sorted((r["user_id"], r["business_id"]) for r in rows) == [("u1", "b1"), ("u1", "b2"), ("u2", "b1")]
    with pytest.raises(Exception):  # the header is not what the caller says
        read_interactions_csv(spark, path).collect()
    with open(path, "a") as f:
        f.write(",z,b3\n")
    with pytest.raises(Exception, match="no user_id"):
        read_interactions_csv(spark, path, header=names).collect()


def test_report_writers(spark, scratch):
    pairs = spark.createDataFrame([("b", "c", 0.5), ("a", "b", 1.0)], "id1 string, id2 string, similarity double")
    out = os.path.join(scratch, "pairs")
    sinks.write_lines(sinks.pair_lines(pairs), ["id1", "id2"], out, header="business_id_1, business_id_2, similarity")
    text = [r[0] for r in spark.read.text(out).coalesce(1).collect()]
    assert sorted(text) == sorted(["business_id_1, business_id_2, similarity", "a,b,1.0", "b,c,0.5"])


def written(path):
    """The bytes of a report: its part files in name order, then its tail."""
    out = b""
    for folder in (path, os.path.join(path, "tail")):
        if os.path.isdir(folder):
            for f in sorted(x for x in os.listdir(folder) if x.startswith("part-")):
                with open(os.path.join(folder, f), "rb") as handle:
                    out += handle.read()
    return out.decode()


def expected_itemsets(candidates, frequent):
    """The report as one program would print it: a line of tuples per size, sizes an empty line apart."""
    def lines(levels):
        by = {}
        for k, items in levels:
            by.setdefault(k, []).append(tuple(sorted(items)))
        return "\n\n".join(",".join(str(t).replace(",)", ")") for t in sorted(by[k])) for k in sorted(by))
    return "Candidates:" + ("\n" + lines(candidates) if candidates else "") + "\n\nFrequent Itemsets:" + ("\n" + lines(frequent) if frequent else "")


@pytest.mark.parametrize("what", ["both", "no frequent", "no candidates", "nothing"])
def test_itemset_report_bytes(spark, scratch, what):
    sets = [(1, [f"i{k:02d}"]) for k in range(30)] + [(2, [f"i{k:02d}", f"i{k + 1:02d}"]) for k in range(9)] + [(3, ["i01", "i02", "é ü"])]
    cands = sets if what in ("both", "no frequent") else []
    freq = sets[3:35] if what in ("both", "no candidates") else []
    frames = [spark.createDataFrame(x, "k int, items array<string>").repartition(3) for x in (cands, freq)]
    out = os.path.join(scratch, "sets")
    sinks.write_itemset_report(sinks.itemset_report(*frames), out)
    assert written(out) == expected_itemsets(cands, freq)


def test_long_lines_are_written_by_many_tasks(spark, scratch):
    rows = spark.range(5000).select(F.lit(1).alias("k"), F.array(F.format_string("i%05d", "id")).alias("items"))
    out = os.path.join(scratch, "sets")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small as it is, let the sort keep its parts
    try:
        sinks.write_itemset_report(sinks.itemset_report(rows, rows.where("items[0] < 'i00100'")), out)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sum(f.startswith("part-") for f in os.listdir(out)) > 1
    assert written(out) == expected_itemsets([(1, [f"i{k:05d}"]) for k in range(5000)], [(1, [f"i{k:05d}"]) for k in range(100)])


def test_community_report_bytes(spark, scratch):
    members = {"b": ["b", "c"], "a": ["a", "x"], "d": ["d", "e", "f"], "z": ["z"]}
    labels = spark.createDataFrame([(v, k) for k, vs in members.items() for v in vs], "node string, community string").repartition(3)
    out = os.path.join(scratch, "communities")
    sinks.write_community_report(sinks.community_lines(labels), out)
    want = sorted(members.values(), key=lambda v: (len(v), v[0]))
    assert written(out) == "".join(", ".join(f"'{x}'" for x in v) + "\n" for v in want)
    sinks.write_community_report(sinks.community_lines(labels.limit(0)), os.path.join(scratch, "none"))
    assert written(os.path.join(scratch, "none")) == ""


def test_custom_layout_places_rows_by_an_expression(spark):
    df = spark.range(100).select(F.when(F.col("id") % 10 > 0, F.col("id") % 17).alias("key"))
    prof = {(r["layout"], r["partition"]): r["n_items"] for r in layout.partition_profile(df, 5, "key", F.col("key") * 2).collect()}
    want = [0] * 5
    for r in df.collect():
        want[0 if r["key"] is None else r["key"] * 2 % 5] += 1
    assert [prof["custom", k] for k in range(5)] == want
    assert sum(prof["hash", k] for k in range(5)) == 100


def test_ranking_csv_quotes_commas(spark, scratch):
    df = spark.createDataFrame([("Phoenix, AZ", 4.0), ("Tempe", 5.0)], "city string, stars double")
    out = os.path.join(scratch, "rank")
    sinks.write_ranking_csv(df, "stars", "city", out)
    back = spark.read.option("header", True).csv(out).collect()
    assert [(r["city"], float(r["stars"])) for r in back] == [("Tempe", 5.0), ("Phoenix, AZ", 4.0)]
