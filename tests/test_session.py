"""Session helpers: lineage cuts, scopes, the checkpoint folder."""

import os

import pytest
from pyspark.sql import functions as F

from basketry.session import Scope, cut_lineage, cut_lineage_counted, delete_tables, ensure_checkpoint_dir


def _path(df):
    return os.path.dirname(df.inputFiles()[0].removeprefix("file://"))


def test_cut_lineage_counted_observes_metrics(spark):
    df = spark.range(10).withColumn("odd", F.col("id") % 2 == 1)
    out, stats = cut_lineage_counted(df, columns=["id"], odd=F.count_if("odd"), mx=F.max("id"))
    assert out.columns == ["id"]
    assert stats["n"] == 10 and stats["odd"] == 5 and stats["mx"] == 9
    assert sorted(r["id"] for r in out.collect()) == list(range(10))


def test_scope_leaves_the_callers_cache_alone(spark):
    df = spark.range(50).persist()
    own = spark.range(60)
    with Scope() as scope:
        assert scope.keep(df) is df
        kept = scope.keep(own)
        assert kept.storageLevel.useMemory
    assert df.storageLevel.useMemory
    assert not kept.storageLevel.useMemory
    df.unpersist()


def test_nested_scopes_keep_the_outer_cache(spark):
    with Scope() as outer:
        df = outer.keep(spark.range(7))
        with Scope() as inner:
            inner.keep(df)
        assert df.storageLevel.useMemory


def test_scope_deletes_its_tables_and_returned_ones_stay(spark):
    with Scope() as scope:
        a, b = scope.table(spark.range(5)), scope.table(spark.range(6))
        out = cut_lineage(a.join(b, "id"))
        scope.drop(a)
        assert not os.path.exists(_path(a)) and os.path.exists(_path(b))
    assert not os.path.exists(_path(b))
    assert out.count() == 5


def test_only_own_tables_are_deleted(spark, scratch):
    with pytest.raises(ValueError):
        delete_tables(spark, [scratch])


def test_a_cluster_without_a_shared_folder_is_an_error():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(ValueError):
        ensure_checkpoint_dir(Session())
