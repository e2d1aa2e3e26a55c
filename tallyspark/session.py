"""Session helpers: a tuned local session, the shared folder, and lineage cuts through written tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """Session for tests and the bench; a cluster passes its own settings through spark-submit."""
    builder = (
        SparkSession.builder.master(master)
        .appName("tallyspark")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local session may go without the setting; it then gets a fresh folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="tallyspark-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def scratch(spark: SparkSession, label: str) -> str:
    """A new, not yet existing path below the shared folder."""
    return f"{shared_dir(spark)}/tallyspark/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str, rows: int = 0) -> DataFrame:
    """Cut the lineage: write to the shared folder and read back.

    Survives executor loss, stays columnar, and gives the optimizer true sizes for its broadcast choice. With ``rows``, the
    most that a shuffle of it moves, the job shuffles into as many partitions as those are worth.
    """
    spark = df.sparkSession
    path = scratch(spark, label)
    with shuffled_into(spark, rows):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


ROWS_PER_TASK = 1_000_000  # rows of a shuffle that one task sorts or aggregates


def tasks_for(spark: SparkSession, rows: int) -> int:
    """Shuffle partitions for so many rows: the session's number, more where its tasks would grow too large."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // ROWS_PER_TASK))


@contextmanager
def shuffled_into(spark: SparkSession, rows: int) -> Iterator[None]:
    """Jobs started inside shuffle into partitions for so many rows.

    Adaptive merging would leave one partition per core or 64 MB, whatever the session's number; where that is more than
    ``ROWS_PER_TASK`` rows a task it is off.
    """
    names = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")
    before = [spark.conf.get(n) for n in names]
    if _few(spark, rows):
        yield
        return
    for name, value in zip(names, (str(tasks_for(spark, rows)), "false")):
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in zip(names, before):
            spark.conf.set(name, value)


@contextmanager
def partitions(spark: SparkSession, n: int) -> Iterator[None]:
    """Jobs started inside shuffle into ``n`` partitions."""
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    spark.conf.set(name, str(n))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def spread(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """Rows dealt by their keys to tasks of ``ROWS_PER_TASK`` or less, if adaptive merging would leave too many in one."""
    return df if _few(df.sparkSession, rows) else df.repartition(tasks_for(df.sparkSession, rows), *keys)


def _few(spark: SparkSession, rows: int) -> bool:
    """One partition per core and the session's number of partitions both do for so many rows."""
    return rows <= ROWS_PER_TASK * min(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
