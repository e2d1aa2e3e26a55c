"""Joins over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import relational as R
from ..operators import timeseries as TS
from ..sources.tables import invoices, table
from .registry import query, rnd


@query("c1_inner_join", """
    SELECT o_orderkey, l_linenumber, l_partkey, c_mktsegment FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN customer ON o_custkey = c_custkey
    WHERE o_orderstatus = 'F'""")
def c1(spark, sf):
    orders = table(spark, sf, "orders").where("o_orderstatus = 'F'").select("o_orderkey", "o_custkey")
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    customers = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return (
        orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
        .select("o_orderkey", "l_linenumber", "l_partkey", "c_mktsegment")
    )


@query("c1_two_key_join", """
    SELECT a.l_suppkey, a.day, a.n AS shipped, b.n AS returned FROM
      (SELECT l_suppkey, CAST(l_shipdate AS DATE) AS day, CAST(count(*) AS BIGINT) AS n FROM lineitem GROUP BY 1, 2) a JOIN
      (SELECT l_suppkey, CAST(l_shipdate AS DATE) AS day, CAST(count(*) AS BIGINT) AS n FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1, 2) b
      ON a.l_suppkey = b.l_suppkey AND a.day = b.day""")
def c1_two(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_suppkey", F.to_date("l_shipdate").alias("day"), "l_returnflag")
    a = lines.groupBy("l_suppkey", "day").agg(F.count("*").alias("shipped")).alias("a")
    b = lines.where("l_returnflag = 'R'").groupBy("l_suppkey", "day").agg(F.count("*").alias("returned")).alias("b")
    both = (F.col("a.l_suppkey") == F.col("b.l_suppkey")) & (F.col("a.day") == F.col("b.day"))
    return a.join(b, both).select("a.l_suppkey", "a.day", "shipped", "returned")


@query("c2_join_using", """
    SELECT n_nationkey, n_name, customers FROM (SELECT c_nationkey AS n_nationkey, CAST(count(*) AS BIGINT) AS customers FROM customer GROUP BY 1) JOIN nation USING (n_nationkey)""")
def c2(spark, sf):
    counts = table(spark, sf, "customer").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count("*").alias("customers"))
    return counts.join(table(spark, sf, "nation").select("n_nationkey", "n_name"), ["n_nationkey"])


@query("c3_left_join_default", """
    SELECT c_custkey, round(coalesce(s.v, 0.0), 2) + 0.0 AS urgent_spend FROM customer
    LEFT JOIN (SELECT o_custkey, sum(o_totalprice) AS v FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1) s ON c_custkey = o_custkey""")
def c3(spark, sf):
    spend = table(spark, sf, "orders").where("o_orderpriority = '1-URGENT'").groupBy("o_custkey").agg(F.sum("o_totalprice").alias("v"))
    return (
        table(spark, sf, "customer").select("c_custkey")
        .join(spend, F.col("c_custkey") == F.col("o_custkey"), "left")
        .select("c_custkey", rnd(F.coalesce("v", F.lit(0.0)), 2).alias("urgent_spend"))
    )


NATION_YEAR = "FROM orders JOIN customer ON o_custkey = c_custkey"


@query("c4_chained_left_joins", f"""
    WITH b AS (SELECT c_nationkey AS country, CAST(year(o_orderdate) AS INTEGER) AS year, * {NATION_YEAR}),
      f AS (SELECT country, year, CAST(count(*) AS BIGINT) AS orders_n FROM b GROUP BY 1, 2),
      u AS (SELECT country, year, CAST(count(*) AS BIGINT) AS urgent_n FROM b WHERE o_orderpriority = '1-URGENT' AND year < 2000 GROUP BY 1, 2),
      m AS (SELECT country, year, max(o_totalprice) AS top FROM b WHERE c_mktsegment = 'BUILDING' AND year > 1996 GROUP BY 1, 2)
    SELECT country, year, orders_n, urgent_n, top FROM f LEFT JOIN u USING (country, year) LEFT JOIN m USING (country, year)""")
def c4(spark, sf):
    base = _nation_year(spark, sf)
    keys = ["country", "year"]
    f = base.groupBy(*keys).agg(F.count("*").alias("orders_n"))
    u = base.where("o_orderpriority = '1-URGENT' AND year < 2000").groupBy(*keys).agg(F.count("*").alias("urgent_n"))
    m = base.where("c_mktsegment = 'BUILDING' AND year > 1996").groupBy(*keys).agg(F.max("o_totalprice").alias("top"))
    return f.join(u, on=keys, how="left").join(m, on=keys, how="left")


def _nation_year(spark, sf):
    customers = table(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").alias("country"), "c_mktsegment")
    orders = table(spark, sf, "orders").select("o_custkey", F.year("o_orderdate").alias("year"), "o_orderpriority", "o_totalprice")
    return orders.join(customers, orders["o_custkey"] == customers["c_custkey"])


@query("c5_dataset_end_date", """
    SELECT o_orderkey, CAST(datediff('day', CAST(o_orderdate AS DATE), (SELECT CAST(max(o_orderdate) AS DATE) FROM orders)) AS INTEGER) AS age_days FROM orders""")
def c5(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    dated = R.with_scalars(orders, end=orders.agg(F.max(F.to_date("o_orderdate"))))
    return dated.select("o_orderkey", F.datediff("end", F.to_date("o_orderdate")).alias("age_days"))


NEXT_EVENT = """
    WITH d AS (SELECT DISTINCT o_custkey, CAST(o_orderdate AS DATE) AS day FROM orders)
    SELECT x.o_custkey, x.day, min(y.day) AS next_day FROM d x JOIN d y ON x.o_custkey = y.o_custkey AND x.day < y.day GROUP BY 1, 2"""


@query("c6_next_event_self_join", NEXT_EVENT)
def c6(spark, sf):
    days = table(spark, sf, "orders").select("o_custkey", F.to_date("o_orderdate").alias("day")).distinct()
    return TS.next_event(days, "o_custkey", "day", "next_day")


@query("c9_code_lookup", """
    SELECT c_custkey, coalesce(n_name, '') AS iso FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> 2) ON c_nationkey = n_nationkey""")
def c9(spark, sf):
    codes = table(spark, sf, "nation").where("n_regionkey <> 2")
    customers = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    return R.lookup(customers, "c_nationkey", codes, "n_nationkey", "n_name", "iso", F.lit("")).select("c_custkey", "iso")


@query("c10_prefix_match", """
    WITH a(alias, canonical) AS (VALUES ('small', 'tiny'), ('small r', 'ring maker'), ('red wid', 'widget co'), ('hot', 'heat'), ('blue bolt', 'bolts'))
    SELECT p_partkey, coalesce((SELECT min(canonical) FROM a WHERE starts_with(p_name, alias)), p_name) AS canonical FROM part""")
def c10(spark, sf):
    aliases = spark.createDataFrame(
        [("small", "tiny"), ("small r", "ring maker"), ("red wid", "widget co"), ("hot", "heat"), ("blue bolt", "bolts")],
        "alias STRING, canonical STRING",
    )
    parts = table(spark, sf, "part").select("p_partkey", "p_name")
    return parts.join(R.canonical_names(parts, "p_name", aliases), "p_name").select("p_partkey", "canonical")


@query("c11_description_lookup", """
    SELECT l.p_type, coalesce(d.text, l.p_type) AS description, l.n FROM (SELECT p_type, CAST(count(*) AS BIGINT) AS n FROM part GROUP BY 1) l
    LEFT JOIN (VALUES ('ECONOMY', 'low cost'), ('SMALL', 'small size')) d(code, text) ON l.p_type = d.code""")
def c11(spark, sf):
    texts = spark.createDataFrame([("ECONOMY", "low cost"), ("SMALL", "small size")], "code STRING, text STRING")
    counts = table(spark, sf, "part").groupBy("p_type").agg(F.count("*").alias("n"))
    return R.lookup(counts, "p_type", texts, "code", "text", "description").select("p_type", "description", "n")


@query("c12_align_two_series", """
    WITH o AS (SELECT CAST(o_orderdate AS DATE) AS day, CAST(count(*) AS BIGINT) AS ordered FROM orders GROUP BY 1),
      l AS (SELECT CAST(l_shipdate AS DATE) AS day, CAST(count(*) AS BIGINT) AS shipped FROM lineitem GROUP BY 1)
    SELECT day, ordered, shipped FROM o LEFT JOIN l USING (day)""")
def c12(spark, sf):
    o = table(spark, sf, "orders").groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count("*").alias("ordered"))
    s = table(spark, sf, "lineitem").groupBy(F.to_date("l_shipdate").alias("day")).agg(F.count("*").alias("shipped"))
    return TS.reindex(s, o.select("day", "ordered"), "day").select("day", "ordered", "shipped")


@query("c13_parameter_sweep", """
    SELECT s_suppkey, g.discount, round(s_acctbal * (1 - g.discount), 4) + 0.0 AS bal FROM supplier, (VALUES (0.0::DOUBLE), (0.1::DOUBLE), (0.25::DOUBLE)) g(discount)""")
def c13(spark, sf):
    swept = R.sweep(table(spark, sf, "supplier").select("s_suppkey", "s_acctbal"), "discount", [0.0, 0.1, 0.25])
    return swept.select("s_suppkey", "discount", rnd(F.col("s_acctbal") * (1 - F.col("discount"))).alias("bal"))
