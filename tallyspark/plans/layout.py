"""Table mutation, versions and layout over the given tables."""

from __future__ import annotations

import uuid

from pyspark import StorageLevel
from pyspark.sql import functions as F

from ..operators import mutate as M
from ..operators import relational as R
from ..session import scratch
from ..sources import files
from ..sources.tables import table
from .registry import query, rnd


def loans(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")


LOANS = "(SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders)"


@query("l1_merge_upsert", f"""
    SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus = 'F' THEN 'F' ELSE 'merged' END AS o_orderstatus, o_totalprice FROM {LOANS}""")
def l1(spark, sf):
    target = loans(spark, sf).where("o_orderstatus <> 'P'")
    source = loans(spark, sf).where("o_orderstatus <> 'F'").withColumn("o_orderstatus", F.lit("merged"))
    return M.merge_upsert(target, source, ["o_orderkey"])


@query("l1_merge_deduplicated_source", f"""
    SELECT c_custkey, coalesce(arg_max(o_orderstatus, o_orderkey), 'none') AS state FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey""")
def l1_dedupe(spark, sf):
    target = table(spark, sf, "customer").select("c_custkey", F.lit("none").alias("state"))
    source = loans(spark, sf).select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderstatus").alias("state"), "o_orderkey")
    return M.merge_upsert(target, R.keep_one(source, ["c_custkey"], [F.col("o_orderkey")]).drop("o_orderkey"), ["c_custkey"])


@query("l2_merge_update", """
    SELECT c_custkey, coalesce(n_name, 'unknown') AS city, n_regionkey AS state_id FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_regionkey < 3) ON c_nationkey = n_nationkey""")
def l2(spark, sf):
    target = table(spark, sf, "customer").select("c_custkey", "c_nationkey", F.lit("unknown").alias("city"), F.lit(None).cast("int").alias("state_id"))
    source = table(spark, sf, "nation").where("n_regionkey < 3").withColumnRenamed("n_nationkey", "c_nationkey")
    return M.merge_update(target, source, ["c_nationkey"], {"city": "n_name", "state_id": "n_regionkey"}).drop("c_nationkey")


@query("l3_delete_where", """
    SELECT user_id, day, click FROM (SELECT user_id, CAST(ts AS DATE) AS day, max(value) FILTER (event_type = 'click') AS click FROM events GROUP BY 1, 2)
    WHERE click IS NULL OR click <= 50""")
def l3(spark, sf):
    daily = table(spark, sf, "events").groupBy("user_id", F.to_date("ts").alias("day")).agg(F.max(F.when(F.col("event_type") == "click", F.col("value"))).alias("click"))
    return M.delete_where(daily, F.col("click") > 50)


@query("l4_update_where", f"SELECT o_orderkey, o_custkey, o_orderstatus, CASE WHEN o_orderstatus = 'P' THEN 0.0::DOUBLE ELSE o_totalprice END AS o_totalprice FROM {LOANS}")
def l4(spark, sf):
    return M.update_where(loans(spark, sf), F.col("o_orderstatus") == "P", {"o_totalprice": F.lit(0.0)})


def change_log(spark, sf):
    """Version 0 inserts all, 1 reprices 'O', 2 deletes 'F', 3 re-adds urgent 'F' at half price."""
    base = loans(spark, sf)
    urgent = table(spark, sf, "orders").where("o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'").select(*base.columns)
    half = urgent.withColumn("o_totalprice", F.col("o_totalprice") / 2)
    doubled = base.where("o_orderstatus = 'O'").withColumn("o_totalprice", F.col("o_totalprice") * 2)
    steps = [M.changes(base, 0), M.changes(doubled, 1), M.changes(base.where("o_orderstatus = 'F'"), 2, "D"), M.changes(half, 3)]
    log = steps[0]
    for step in steps[1:]:
        log = log.unionByName(step)
    return log


V1 = "(SELECT o_orderkey, o_custkey, o_orderstatus, CASE WHEN o_orderstatus = 'O' THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice FROM orders)"
V3 = """(SELECT o_orderkey, o_custkey, o_orderstatus, CASE o_orderstatus WHEN 'O' THEN o_totalprice * 2 WHEN 'F' THEN o_totalprice / 2 ELSE o_totalprice END AS o_totalprice
      FROM orders WHERE o_orderstatus <> 'F' OR o_orderpriority = '1-URGENT')"""


@query("l5_as_of_version", f"SELECT * FROM {V1}")
def l5(spark, sf):
    return M.as_of(change_log(spark, sf), ["o_orderkey"], 1)


@query("l5_as_of_deleted", f"SELECT * FROM {V1} WHERE o_orderstatus <> 'F'")
def l5_deleted(spark, sf):
    return M.as_of(change_log(spark, sf), ["o_orderkey"], 2)


@query("l6_restore", f"SELECT * FROM {LOANS}")
def l6(spark, sf):
    restored = M.restore(change_log(spark, sf), ["o_orderkey"], 0, 4)
    return files.write_table(M.as_of(restored, ["o_orderkey"]), scratch(spark, "restored"))


@query("l7_reinsert", f"SELECT * FROM {V1}")
def l7(spark, sf):
    log = change_log(spark, sf)
    return M.reinsert(M.as_of(log, ["o_orderkey"], 2), log, ["o_orderkey"], 1, F.col("o_orderstatus") == "F")


@query("l8_history", """
    SELECT 0 AS version, 'U' AS op, CAST(count(*) AS BIGINT) AS "rows" FROM orders UNION ALL SELECT 1, 'U', count(*) FROM orders WHERE o_orderstatus = 'O'
    UNION ALL SELECT 2, 'D', count(*) FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT 3, 'U', count(*) FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'""")
def l8(spark, sf):
    return M.history(change_log(spark, sf))


@query("l9_schema_enforcement", """
    SELECT o_orderstatus, CAST(count(*) AS BIGINT) AS "rows", difference FROM orders, (VALUES ('missing column o_custkey'), ('extra column credit_score'), ('column o_totalprice is string, not double')) t(difference) GROUP BY ALL""")
def l9(spark, sf):
    path = scratch(spark, "enforced")
    old = files.write_table(loans(spark, sf).where("o_orderstatus <> 'F'"), path)
    M.append_enforced(old, loans(spark, sf).where("o_orderstatus = 'F'"), path)
    new = loans(spark, sf).withColumn("credit_score", F.col("o_custkey").cast("int")).withColumn("o_totalprice", F.col("o_totalprice").cast("string")).drop("o_custkey")
    try:
        M.append_enforced(old, new, path)
    except M.SchemaMismatch as refused:
        differences = refused.differences
    # what was refused left nothing in the table
    return spark.read.parquet(path).groupBy("o_orderstatus").agg(F.count("*").alias("rows")).withColumn("difference", F.explode(F.array(*[F.lit(d) for d in differences])))


@query("l10_schema_evolution", """
    SELECT o_orderkey, o_totalprice, CASE WHEN o_orderstatus <> 'F' THEN CAST(o_custkey AS INTEGER) END AS credit_score FROM orders""")
def l10(spark, sf):
    path = scratch(spark, "evolving")
    all_loans = loans(spark, sf)
    all_loans.where("o_orderstatus = 'F'").select("o_orderkey", "o_totalprice").write.parquet(path)
    new = all_loans.where("o_orderstatus <> 'F'").select("o_orderkey", "o_totalprice", F.col("o_custkey").cast("int").alias("credit_score"))
    return M.append_evolving(new, path)


@query("l11_register_files_as_table", "SELECT o_orderstatus, CAST(count(*) AS BIGINT) AS n FROM orders GROUP BY 1")
def l11(spark, sf):
    name, path = f"converted_{uuid.uuid4().hex}", scratch(spark, "plain")
    files.write_table(loans(spark, sf), path)
    spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{path}'")
    out = spark.sql(f"SELECT o_orderstatus, count(*) AS n FROM {name} GROUP BY 1")
    spark.sql(f"DROP TABLE {name}")  # external: the plan above keeps its files
    return out


@query("l12_compaction", f"SELECT *, CAST(1 AS BIGINT) AS files FROM {LOANS}")
def l12(spark, sf):
    path = scratch(spark, "scattered")
    loans(spark, sf).repartition(12).write.parquet(path)
    compacted = M.compacted_files(spark, path, scratch(spark, "compacted"))
    return R.with_scalars(M.read_files(compacted), files=compacted.agg(F.count("*")))


@query("l12_compaction_keeps_large_files", f"SELECT *, CAST(2 AS BIGINT) AS large, true AS fewer FROM {LOANS}")
def l12_mixed(spark, sf):
    path = scratch(spark, "mixed")
    rows, share = loans(spark, sf), F.pmod(F.xxhash64("o_orderkey"), F.lit(100))
    for low, high in ((0, 40), (40, 80)):
        rows.where((share >= low) & (share < high)).coalesce(1).write.mode("append").parquet(path)
    large = files.manifest(spark, path)
    most = large.agg(F.min("file_size")).first()[0]
    rows.where(share >= 80).repartition(9).write.mode("append").parquet(path)
    before = files.manifest(spark, path).count()
    compacted = M.compacted_files(spark, path, scratch(spark, "compacted"), target_bytes=most)
    kept = compacted.join(large.select("file_path"), "file_path", "left_semi").agg(F.count("*"))
    return R.with_scalars(M.read_files(compacted), large=kept, fewer=compacted.agg(F.count("*") < before))


@query("l13_cluster_by_two_columns", f"SELECT * FROM {LOANS}")
def l13(spark, sf):
    return M.write_clustered(loans(spark, sf), scratch(spark, "clustered"), ["o_custkey", "o_totalprice"], 4)


@query("l13_cluster_by_text_and_date", "SELECT o_orderkey, o_orderpriority, CAST(o_orderdate AS DATE) AS day FROM orders")
def l13_text(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", F.to_date("o_orderdate").alias("day"))
    return M.write_clustered(rows, scratch(spark, "clustered"), ["o_orderpriority", "day"], 8)


@query("l14_drop_superseded_versions", f"SELECT 3 AS version, * FROM {V3} UNION ALL SELECT 2, * FROM {V1} WHERE o_orderstatus <> 'F'")
def l14(spark, sf):
    log = M.drop_superseded(change_log(spark, sf), ["o_orderkey"], 2)
    parts = [M.as_of(log, ["o_orderkey"], v).select(F.lit(v).alias("version"), "*") for v in (3, 2)]
    return parts[0].unionByName(parts[1])


@query("l15_cached_result", "SELECT o_custkey, round(sum(o_totalprice), 2) + 0.0 AS spend FROM orders GROUP BY 1")
def l15(spark, sf):
    cached = loans(spark, sf).groupBy("o_custkey").agg(rnd(F.sum("o_totalprice"), 2).alias("spend")).persist(StorageLevel.MEMORY_AND_DISK)
    return cached


@query("l16_repartition_by_key", "SELECT l_suppkey, l_linenumber, CAST(count(*) AS BIGINT) AS n FROM lineitem GROUP BY 1, 2")
def l16(spark, sf):
    return M.by_key(table(spark, sf, "lineitem").select("l_suppkey", "l_linenumber"), "l_suppkey", "l_linenumber").groupBy("l_suppkey", "l_linenumber").agg(F.count("*").alias("n"))


@query("l17_catalog", """SELECT column_name AS col_name, lower(data_type) AS data_type FROM (DESCRIBE SELECT o_orderkey, o_totalprice FROM orders) t(column_name, data_type, a, b, c, d)""")
def l17(spark, sf):
    db, path = f"demo_{uuid.uuid4().hex}", scratch(spark, "catalogued")
    files.write_table(loans(spark, sf).select("o_orderkey", "o_totalprice"), path)
    spark.sql(f"CREATE DATABASE {db}")
    spark.sql(f"CREATE TABLE {db}.loans USING parquet LOCATION '{path}'")
    listed = spark.sql(f"SHOW TABLES IN {db}").where("NOT isTemporary")  # session views are listed in every database
    if [r["tableName"] for r in listed.collect()] != ["loans"]:
        raise RuntimeError(f"{db} should hold one table")
    described = spark.sql(f"DESCRIBE {db}.loans").select("col_name", "data_type")
    spark.sql(f"DROP TABLE {db}.loans")
    spark.sql(f"DROP DATABASE {db}")
    return described
