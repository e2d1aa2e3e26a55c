"""The given tables, and the views of them that the domain jobs start from."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import spread


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stream_table(spark: SparkSession, sf_dir: str, name: str, files_per_trigger: int | None = None) -> DataFrame:
    """The same table as an unbounded source. The glob lets one file and a folder of parts work alike."""
    reader = spark.readStream.schema(table(spark, sf_dir, name).schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name[:-1]}[{name[-1]}].parquet")


def invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders as retail invoices: CustomerID, InvoiceNo, InvoiceDate, SalesAmount."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("CustomerID"),
        F.col("o_orderkey").alias("InvoiceNo"),
        F.col("o_orderdate").alias("InvoiceDate"),
        F.col("o_totalprice").alias("SalesAmount"),
    )


def news(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as mentions of organisations in articles: url, organisation, publishDate, theme, tone."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("url"),
        F.col("l_suppkey").alias("organisation"),
        F.to_date("l_shipdate").alias("publishDate"),
        F.col("l_returnflag").alias("theme"),
        F.col("l_discount").alias("tone"),
    )


def prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Average line price per supplier and day as a close price: symbol, date, close."""
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("symbol"), F.to_date("l_shipdate").alias("date"), "l_extendedprice")
    return spread(lines, lines.count(), "symbol", "date").groupBy("symbol", "date").agg(F.avg("l_extendedprice").alias("close"))
