"""File sources and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """CSV with a header line and a fixed schema: no inference pass over the data."""
    return spark.read.csv(path, header=True, schema=schema)


def read_csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    """CSV with types inferred from a full pass; meant for exploration, pin the schema afterwards."""
    return spark.read.csv(path, header=True, inferSchema=True)


def read_commented_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """CSV whose lines starting with '#' are remarks. The JVM reader skips them while splitting the file."""
    return spark.read.csv(path, header=True, comment="#", schema=schema, inferSchema=schema is None)


def read_json(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def query_files(spark: SparkSession, fmt: str, path: str, select: str = "*") -> DataFrame:
    """SQL straight on files, without a catalog entry."""
    return spark.sql(f"SELECT {select} FROM {fmt}.`{path}`")


def write_table(df: DataFrame, path: str, mode: str = "errorifexists", partition_by: list[str] | None = None) -> DataFrame:
    """Write as Parquet and return a reader of the result.

    With partition columns the rows are rebalanced by them: the adaptive planner splits a hot value over as many tasks
    as its bytes ask for and does not scatter a small one.
    """
    writer = df.write.mode(mode)
    if partition_by:
        writer = df.hint("rebalance", *partition_by).write.mode(mode).partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.parquet(path)


def empty_like(df: DataFrame) -> DataFrame:
    """Zero rows, same schema; Catalyst folds this into an empty relation without a scan."""
    return df.where(F.lit(False))


def write_empty_like(df: DataFrame, path: str) -> DataFrame:
    empty_like(df).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def pinned_schema(spark: SparkSession, path: str, fmt: str = "json", sample_file: str | None = None) -> T.StructType:
    """Infer a schema once, from one file if given, to pin it for later stream reads."""
    return spark.read.format(fmt).option("inferSchema", True).option("header", True).load(sample_file or path).schema


def export_staged(df: DataFrame, path: str, max_rows_per_file: int = 5_000_000) -> DataFrame:
    """Stage a table as compressed Parquet files of limited size for a warehouse bulk load."""
    df.write.option("maxRecordsPerFile", max_rows_per_file).option("compression", "gzip").parquet(path)
    return df.sparkSession.read.parquet(path)


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """Data files of a table with their row counts; no data column is read, only footers."""
    return (
        spark.read.parquet(path)
        .select(F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_size").alias("file_size"))
        .groupBy("file_path", "file_size")
        .agg(F.count(F.lit(1)).alias("row_count"))
    )


def export_manifest(spark: SparkSession, path: str, out: str) -> DataFrame:
    """Write the file list as text, one path per line, for readers outside Spark."""
    manifest(spark, path).select(F.col("file_path").alias("value")).write.text(out)
    return spark.read.text(out)


def create_table_as(spark: SparkSession, name: str, path: str, select_sql: str) -> DataFrame:
    spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{path}' AS {select_sql}")
    return spark.table(name)


def insert_into(spark: SparkSession, name: str, select_sql: str) -> DataFrame:
    spark.sql(f"INSERT INTO {name} {select_sql}")
    return spark.table(name)
