"""Bronze to gold on Structured Streaming: append, parse, window, upsert, join.

Upserts go to a change log: every micro-batch writes its own folder, named after the batch id and overwritten on a
replay, so a batch counts once whatever fails. Readers take the last change per key (``mutate.as_of``). Now and then the log is
folded: a base with the last change of every key lets readers leave out all versions before it. No batch rewrites the table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from ..operators.mutate import as_of
from ..operators.relational import keep_one


def drain(writer: DataStreamWriter, path: str | None = None) -> StreamingQuery:
    """Process what is there now and stop; the checkpoint lets the next call go on from here."""
    query = writer.trigger(availableNow=True).start(path) if path else writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def append_sink(stream: DataFrame, checkpoint: str, partition_by: Sequence[str] = ()) -> DataStreamWriter:
    writer = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    return writer.partitionBy(*partition_by) if partition_by else writer


def raw_to_bronze(stream: DataFrame, payload: str, arrived: str) -> DataFrame:
    """Payload as text with its arrival time and the arrival date to partition by."""
    return stream.withColumns({"jsonData": F.col(payload).cast("string"), "arrivalTimestamp": F.col(arrived), "arrivalDate": F.to_date(arrived)}).drop(payload, arrived)


def bronze_to_silver(bronze: DataFrame, schema: str, lower: Sequence[str] = ()) -> DataFrame:
    """Parse the payload, flatten it, add lower-case copies of the named columns."""
    parsed = bronze.withColumn("fields", F.from_json("jsonData", schema))
    flat = parsed.select(*[c for c in bronze.columns if c != "jsonData"], "fields.*")
    return flat.withColumns({f"{c}Cleaned": F.lower(c) for c in lower})


def split_by(stream: DataFrame, predicate: Column) -> tuple[DataFrame, DataFrame]:
    """Rows where the predicate holds, and the others; each side gets its own sink."""
    known = F.coalesce(predicate, F.lit(False))
    return stream.where(known), stream.where(~known)


def event_time(stream: DataFrame, column: str, late: str | None = None) -> DataFrame:
    """Column as a zoned timestamp, with an optional bound on lateness so that old state can go."""
    typed = stream.withColumn(column, F.col(column).cast("timestamp"))
    return typed.withWatermark(column, late) if late else typed


def windowed(stream: DataFrame, column: str, width: str, keys: Sequence[str], **measures: Column) -> DataFrame:
    """Tumbling windows per key: (window start, keys…, measures…)."""
    grouped = stream.groupBy(F.window(column, width).alias("_w"), *keys)
    return grouped.agg(*[m.alias(name) for name, m in measures.items()]).select(F.col("_w.start").alias("window"), *keys, *measures)


def upsert_sink(stream: DataFrame, log: str, checkpoint: str, keys: Sequence[str], order: Sequence[Column], mode: str = "append", fold_every: int | None = None) -> DataStreamWriter:
    """Keep one row per key of each micro-batch (the last by ``order``) and add it to the change log.

    With ``fold_every`` each so manyth batch also folds the log, so readers start from a base and read few batches beside it.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        rows = keep_one(batch, list(keys), list(order))
        rows.withColumn("op", F.lit("U")).write.mode("overwrite").parquet(f"{log}/version={batch_id}")
        if fold_every and batch_id % fold_every == fold_every - 1:
            fold_log(batch.sparkSession, log, keys, batch_id)

    return stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(merge)


def read_log(spark: SparkSession, log: str) -> DataFrame:
    return spark.read.parquet(log)


def fold_log(spark: SparkSession, log: str, keys: Sequence[str], version: int) -> None:
    """Write the rows as of a version as a base beside the log, and then that it is complete.

    A base holds the last change of every key, deletions included, so later folds and readers need nothing older. A fold that
    fails half way, or is repeated, is overwritten; the log itself is left as it is.
    """
    seen = folded_log(spark, log, version, version - 1)
    rest = [c for c in seen.columns if c not in keys]
    last = seen.groupBy(*keys).agg(F.max_by(F.struct(*rest), "version").alias("_r")).select(*keys, "_r.*")
    last.withColumnRenamed("version", "changed").write.mode("overwrite").parquet(f"{log}-bases/upto={version}")
    spark.range(1).write.mode("overwrite").parquet(f"{log}-folds/upto={version}")


def latest_fold(spark: SparkSession, log: str, version: int | None = None) -> int | None:
    """The last version, up to the one asked for, that has a complete base."""
    try:
        folds = spark.read.schema("id LONG, upto INT").parquet(f"{log}-folds")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None  # nothing has been folded
    return (folds if version is None else folds.where(F.col("upto") <= version)).agg(F.max("upto")).first()[0]


def folded_log(spark: SparkSession, log: str, version: int | None = None, newest_base: int | None = None) -> DataFrame:
    """The change log as readers need it: the latest base and the versions after it; older folders are pruned."""
    changes = read_log(spark, log) if version is None else read_log(spark, log).where(F.col("version") <= version)
    base = latest_fold(spark, log, version if newest_base is None else newest_base)
    if base is None:
        return changes
    start = spark.read.parquet(f"{log}-bases/upto={base}").withColumnRenamed("changed", "version")
    return start.select(*changes.columns).unionByName(changes.where(F.col("version") > base))


def current_rows(spark: SparkSession, log: str, keys: Sequence[str], version: int | None = None) -> DataFrame:
    return as_of(folded_log(spark, log, version), list(keys))


def replace_sink(stream: DataFrame, path: str, checkpoint: str, sort_by: Sequence[Column] = ()) -> DataStreamWriter:
    """Complete mode: each batch writes the whole small result into a folder of its own; ``replaced`` reads the newest."""

    def replace(batch: DataFrame, batch_id: int) -> None:
        (batch.orderBy(*sort_by) if sort_by else batch).write.mode("overwrite").parquet(f"{path}/version={batch_id}")

    return stream.writeStream.outputMode("complete").option("checkpointLocation", checkpoint).foreachBatch(replace)


def replaced(spark: SparkSession, path: str) -> DataFrame:
    """The last result a ``replace_sink`` has written; a batch that failed half way leaves the one before in place."""
    versions = spark.read.parquet(path)
    return versions.where(F.col("version") == versions.agg(F.max("version")).scalar()).drop("version")
