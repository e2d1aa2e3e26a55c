"""Incremental file loads: every source file is loaded at most once, whatever is rerun."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def file_stream(spark: SparkSession, source: str, fmt: str, schema: T.StructType | str, files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.format(fmt).schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(source)


def copy_into(spark: SparkSession, source: str, target: str, ledger: str, fmt: str, schema: T.StructType | str, files_per_trigger: int | None = None) -> int:
    """Load files of ``source`` that ``ledger`` has not seen, append them to ``target``; return rows loaded.

    The ledger is a stream checkpoint: the file source records what it has read and the Parquet sink commits
    each batch once, so a crashed or repeated call neither loses nor doubles a file.
    """
    kept = "spark.sql.streaming.numRecentProgressUpdates"  # 100 unless set, and the rows of every batch count
    before = spark.conf.get(kept, None)
    spark.conf.set(kept, str(1 << 30))
    try:
        query = (
            file_stream(spark, source, fmt, schema, files_per_trigger)
            .writeStream.format("parquet")
            .option("checkpointLocation", ledger)
            .trigger(availableNow=True)
            .start(target)
        )
        query.awaitTermination()
    finally:
        spark.conf.unset(kept) if before is None else spark.conf.set(kept, before)
    return sum(p.numInputRows for p in query.recentProgress)
