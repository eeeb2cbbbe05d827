"""Session helpers: a local session for tests/bench and lineage cutting.

Library code never creates a session; callers pass theirs.  The only
session-level state the library relies on is a reliable checkpoint folder,
which a cluster names in ``spark.checkpoint.dir``.  ``ensure_checkpoint_dir``
reads that setting; in local mode (tests, the bench) it sets a scratch folder
when none is named, on a cluster that is an error.
"""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def build_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "basketry") -> SparkSession:
    """Local session used by tests and bench.py (UI off, AQE on)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting one only if none is set.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used
    as is.  Only in local mode (tests, the bench) an unset folder is replaced
    by a fresh scratch folder; elsewhere that would be a different folder on
    every machine, so it is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="basketry-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def _write_table(df: DataFrame) -> str:
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/basketry-tables/{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(path)
    return path


def _observed(df: DataFrame, columns: list[str] | None, metrics: dict) -> tuple[DataFrame, Observation]:
    obs = Observation()
    aggs = [F.count(F.lit(1)).alias("n")] + [c.alias(k) for k, c in metrics.items()]
    seen = df.observe(obs, *aggs)
    return (seen.select(*columns) if columns else seen), obs


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` as a Parquet table under the checkpoint folder; read it back.

    Used for results of iterative operators so that plans and lineage do not
    grow with the number of rounds, and so that a lost executor never forces
    a replay of earlier rounds.  Unlike ``Dataset.checkpoint`` (which runs
    the plan once for the action and again to write the files), the plan
    runs exactly once; the table is columnar and carries row counts.
    """
    return df.sparkSession.read.parquet(_write_table(df))


def cut_lineage_counted(df: DataFrame, columns: list[str] | None = None, **metrics) -> tuple[DataFrame, dict]:
    """``cut_lineage`` that also returns aggregates observed during the write.

    ``metrics`` maps names to aggregate columns (``n`` = row count is always
    included); ``columns`` (optional) are the columns written, taken after
    the metrics are observed.  The numbers come from ``DataFrame.observe`` on
    the same job that writes the table, so a loop learns "empty?" or
    "changed?" without running a second job.
    """
    seen, obs = _observed(df, columns, metrics)
    out = cut_lineage(seen)
    return out, obs.get


def keep(df: DataFrame) -> DataFrame:
    """Persist a result that is read more than once (memory, spill to disk)."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)


def delete_tables(spark: SparkSession, paths: list[str]) -> None:
    """Delete tables that this library wrote under the checkpoint folder."""
    for path in paths:
        if "/basketry-tables/" not in path:
            raise ValueError(f"not a table of this library: {path}")
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


@contextlib.contextmanager
def scratch_folder(spark: SparkSession):
    """A folder under the checkpoint folder for files of one call (text, CSV, JSON), deleted when it ends."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/basketry-tables/{uuid.uuid4().hex}"
    try:
        yield path
    finally:
        delete_tables(spark, [path])


@contextlib.contextmanager
def arrow_batches(spark: SparkSession, rows: int):
    """What is run inside gets Arrow batches of at most ``rows`` rows: for rows that are large."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    was = spark.conf.get(name)
    spark.conf.set(name, str(min(rows, int(was)) if int(was) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(name, was)


class Scope:
    """Intermediates of one operator call, released when it ends.

    ``keep`` persists a frame that is read several times, unless its owner
    has persisted it already; such a frame stays as it is.  ``table`` writes
    a frame and reads it back; the tables are deleted at the end (``drop``
    does so earlier).  What a call returns is written with ``cut_lineage``
    inside the scope, so it depends on neither.
    """

    def __init__(self) -> None:
        self._frames: list[DataFrame] = []
        self._tables: list[tuple[DataFrame, str]] = []
        self._spark: SparkSession | None = None

    def keep(self, df: DataFrame) -> DataFrame:
        if df.storageLevel.useMemory or df.storageLevel.useDisk:
            return df
        kept = keep(df)
        self._frames.append(kept)
        return kept

    def table(self, df: DataFrame) -> DataFrame:
        self._spark = df.sparkSession
        path = _write_table(df)
        out = self._spark.read.parquet(path)
        self._tables.append((out, path))
        return out

    def adopt(self, df: DataFrame) -> DataFrame:
        """Take over a table that another call returned; it is deleted like those of ``table``."""
        self._spark = df.sparkSession
        self._tables.append((df, df.inputFiles()[0].rsplit("/", 1)[0]))
        return df

    def counted(self, df: DataFrame, columns: list[str] | None = None, **metrics) -> tuple[DataFrame, dict]:
        seen, obs = _observed(df, columns, metrics)
        out = self.table(seen)
        return out, obs.get

    def drop(self, *tables: DataFrame) -> None:
        """Delete tables of this scope that nothing reads any more."""
        gone = [p for t, p in self._tables if any(t is x for x in tables)]
        self._tables = [(t, p) for t, p in self._tables if p not in gone]
        if gone:
            delete_tables(self._spark, gone)

    def forget(self, df: DataFrame) -> None:
        """Unpersist a frame of this scope that nothing reads any more; one that its owner has persisted stays."""
        if any(f is df for f in self._frames):
            self._frames = [f for f in self._frames if f is not df]
            df.unpersist(blocking=False)

    def release(self, *tables: DataFrame) -> None:
        """Leave tables of this scope to the caller: they stay when it ends."""
        self._tables = [(t, p) for t, p in self._tables if not any(t is x for x in tables)]

    def __enter__(self) -> "Scope":
        return self

    def __exit__(self, *exc) -> None:
        for f in self._frames:
            f.unpersist(blocking=False)
        self._frames.clear()
        self.drop(*[t for t, _ in self._tables])
