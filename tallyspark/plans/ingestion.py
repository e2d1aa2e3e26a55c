"""Sources and sinks over the given tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..session import scratch
from ..sources import files, incremental
from ..sources.tables import table
from .registry import query, rnd

CUSTOMER_DDL = "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING"
EVENT_JSON_DDL = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"


@query("a1_parquet_scan", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'")
def a1(spark, sf):
    return (
        files.read_parquet(spark, f"{sf}/orders.parquet")
        .where(F.col("o_orderstatus") == "F")
        .select("o_orderkey", "o_totalprice")
    )


@query("a2_csv_fixed_schema", "SELECT * FROM customer")
def a2(spark, sf):
    path = scratch(spark, "csv")
    table(spark, sf, "customer").write.csv(path, header=True)
    return files.read_csv(spark, path, CUSTOMER_DDL)


@query("a3_csv_inferred_schema", "SELECT CAST(s_suppkey AS INTEGER) AS s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def a3(spark, sf):
    path = scratch(spark, "csv")
    table(spark, sf, "supplier").write.csv(path, header=True)
    return files.read_csv_inferred(spark, path)


@query("a4_csv_with_comment_lines", "SELECT p_partkey, p_name, p_size FROM part")
def a4(spark, sf):
    path = scratch(spark, "commented")
    # each part brings a remark line after its row; every file starts with its header and a remark
    part = table(spark, sf, "part")
    body = part.select(
        F.explode(F.array(
            F.concat_ws(",", F.col("p_partkey"), "p_name", F.col("p_size")),
            F.concat(F.lit("# remark on "), "p_name"),
        )).alias("p_partkey,p_name,p_size")
    )
    # a text column written as CSV with a separator that never occurs keeps whole lines and writes the header
    body.write.option("comment", "\u0002").csv(path, header=True, sep="\u0001", quote="")
    return files.read_commented_csv(spark, path, "p_partkey BIGINT, p_name STRING, p_size INT")


@query("a5_json_scan", "SELECT event_id, ts, user_id, event_type, value, props FROM events")
def a5(spark, sf):
    path = scratch(spark, "json")
    table(spark, sf, "events").write.option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").json(path)
    return files.read_json(spark, path, EVENT_JSON_DDL)


@query("a6_direct_file_query", "SELECT n_name, CAST(count(*) AS BIGINT) AS customers FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name")
def a6(spark, sf):
    customers = files.query_files(spark, "parquet", f"{sf}/customer.parquet", "c_nationkey")
    nations = files.query_files(spark, "parquet", f"{sf}/nation.parquet", "n_nationkey, n_name")
    return (
        customers.groupBy("c_nationkey").agg(F.count("*").alias("customers"))
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .select("n_name", "customers")
    )


@query("a7_literal_lookup_table", """
    SELECT l.label, CAST(count(*) AS BIGINT) AS n
    FROM orders JOIN (VALUES ('F', 'finished'), ('O', 'open'), ('P', 'pending')) AS l(code, label) ON o_orderstatus = l.code
    GROUP BY l.label""")
def a7(spark, sf):
    lookup = spark.createDataFrame([("F", "finished"), ("O", "open"), ("P", "pending")], "code STRING, label STRING")
    counts = table(spark, sf, "orders").groupBy(F.col("o_orderstatus").alias("code")).agg(F.count("*").alias("n"))
    return counts.join(lookup, "code").select("label", "n")


@query("a8_partitioned_overwrite", "SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders")
def a8_overwrite(spark, sf):
    path = scratch(spark, "table")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    files.write_table(orders.where("o_orderstatus = 'F'"), path)
    return files.write_table(orders, path, "overwrite", ["o_orderstatus"])


@query("a8_append", """
    SELECT o_orderstatus, CAST(count(*) * 2 AS BIGINT) AS n FROM orders GROUP BY o_orderstatus""")
def a8_append(spark, sf):
    path = scratch(spark, "table")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    files.write_table(orders, path)
    files.write_table(orders, path, "append")
    return spark.read.parquet(path).groupBy("o_orderstatus").agg(F.count("*").alias("n"))


@query("a9_ctas_insert_select", """
    SELECT o_orderkey AS loan_id, o_totalprice AS paid_amnt, o_orderstatus AS addr_state FROM orders""")
def a9(spark, sf):
    name, path = f"loans_{uuid.uuid4().hex}", scratch(spark, "ctas")
    source = f"parquet.`{sf}/orders.parquet`"
    files.create_table_as(
        spark, name, path,
        f"SELECT o_orderkey AS loan_id, o_totalprice AS paid_amnt, o_orderstatus AS addr_state FROM {source} WHERE o_orderstatus = 'F'",
    )
    files.insert_into(spark, name, f"SELECT o_orderkey, o_totalprice, o_orderstatus FROM {source} WHERE o_orderstatus <> 'F'")
    schema = spark.table(name).schema
    spark.sql(f"DROP TABLE {name}")  # external: the files stay, the name goes
    return spark.read.schema(schema).parquet(path)


@query("a10_zero_row_table", "SELECT * FROM lineitem WHERE 2 = 1")
def a10(spark, sf):
    return files.write_empty_like(table(spark, sf, "lineitem"), scratch(spark, "empty"))


@query("a11_copy_into_twice", "SELECT event_type, CAST(count(*) AS BIGINT) AS n, CAST(0 AS BIGINT) AS loaded_again FROM events GROUP BY event_type")
def a11(spark, sf):
    source, target, ledger = scratch(spark, "landing"), scratch(spark, "target"), scratch(spark, "ledger")
    table(spark, sf, "events").repartition(4, "event_id").write.json(source)
    incremental.copy_into(spark, source, target, ledger, "json", EVENT_JSON_DDL)
    again = incremental.copy_into(spark, source, target, ledger, "json", EVENT_JSON_DDL)
    return (
        spark.read.parquet(target).groupBy("event_type")
        .agg(F.count("*").alias("n"), F.lit(again).cast("bigint").alias("loaded_again"))
    )


@query("a12_staged_export", "SELECT c_custkey, c_acctbal, c_mktsegment FROM customer")
def a12(spark, sf):
    gold = table(spark, sf, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    return files.export_staged(gold, scratch(spark, "staged"))


@query("a13_file_manifest", "SELECT CAST(count(*) AS BIGINT) AS row_count, TRUE AS all_listed FROM lineitem")
def a13(spark, sf):
    path = scratch(spark, "listed")
    files.write_table(table(spark, sf, "lineitem").select("l_orderkey", "l_returnflag"), path, partition_by=["l_returnflag"])
    listed = files.export_manifest(spark, path, scratch(spark, "manifest"))
    return (
        files.manifest(spark, path)
        .join(listed.select(F.col("value").alias("file_path"), F.lit(1).alias("seen")), "file_path", "left")
        .agg(F.sum("row_count").alias("row_count"), F.every(F.col("seen").isNotNull()).alias("all_listed"))
    )


@query("a15_folder_stream", "SELECT event_type, CAST(count(*) AS BIGINT) AS n, round(sum(value), 2) + 0.0 AS total FROM events GROUP BY event_type")
def a15(spark, sf):
    source, target = scratch(spark, "landing"), scratch(spark, "target")
    table(spark, sf, "events").repartition(3, "event_id").write.json(source)
    stream = incremental.file_stream(spark, source, "json", EVENT_JSON_DDL, files_per_trigger=1)
    stream.writeStream.option("checkpointLocation", scratch(spark, "progress")).trigger(availableNow=True).start(target).awaitTermination()
    return spark.read.parquet(target).groupBy("event_type").agg(F.count("*").alias("n"), rnd(F.sum("value"), 2).alias("total"))
