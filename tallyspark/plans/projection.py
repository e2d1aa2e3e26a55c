"""Projections, filters, predicates, sorting, set operations."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions import scalars as S
from ..operators import relational as R
from ..sources.tables import invoices, table
from .registry import query, rnd


@query("b1_select_rename_drop", "SELECT o_orderkey AS loan_id, o_totalprice AS amount, o_orderstatus AS state FROM orders")
def b1(spark, sf):
    return (
        table(spark, sf, "orders").drop("o_custkey", "o_orderpriority", "o_orderdate")
        .withColumnRenamed("o_totalprice", "amount")
        .select(F.col("o_orderkey").alias("loan_id"), "o_orderstatus", "amount")
        .toDF("loan_id", "state", "amount")
    )


@query("b2_expression_strings", """
    SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) - l_linenumber AS earlier, CAST(l_quantity AS INTEGER) AS qty FROM lineitem""")
def b2(spark, sf):
    return table(spark, sf, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "date_sub(to_date(l_shipdate), l_linenumber) AS earlier", "cast(l_quantity AS INT) AS qty"
    )


@query("b3_computed_column", "SELECT l_orderkey, l_linenumber, l_partkey, round(l_extendedprice * (1 - l_discount), 4) + 0.0 AS sales_amount FROM lineitem")
def b3(spark, sf):
    return (
        table(spark, sf, "lineitem").withColumn("sales_amount", rnd(F.col("l_extendedprice") * (1 - F.col("l_discount"))))
        .select("l_orderkey", "l_linenumber", "l_partkey", "sales_amount")
    )


@query("b4_quoted_identifiers", """
    SELECT n_name AS "NY.GDP.PCAP.CD", round(sum(c_acctbal), 2) + 0.0 AS "GHO (CODE)" FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name""")
def b4(spark, sf):
    odd = table(spark, sf, "customer").select("c_nationkey", F.col("c_acctbal").alias("NY.ACCT.BAL"))
    sums = odd.groupBy("c_nationkey").agg(rnd(F.sum("`NY.ACCT.BAL`"), 2).alias("GHO (CODE)"))
    nation = table(spark, sf, "nation").select("n_nationkey", F.col("n_name").alias("NY.GDP.PCAP.CD"))
    return sums.join(nation, sums["c_nationkey"] == nation["n_nationkey"]).select("`NY.GDP.PCAP.CD`", "`GHO (CODE)`")


@query("b5_filters", """
    SELECT o_orderkey FROM orders
    WHERE (o_totalprice >= 1000 AND o_totalprice < 200000 AND o_orderstatus <> 'F') OR o_orderpriority = '1-URGENT'""")
def b5(spark, sf):
    price = F.col("o_totalprice")
    in_band = (price >= 1000) & (price < 200000) & (F.col("o_orderstatus") != "F")
    return table(spark, sf, "orders").where(in_band | (F.col("o_orderpriority") == "1-URGENT")).select("o_orderkey")


PIVOTED_EVENTS = """
    SELECT user_id, CAST(ts AS DATE) AS day, avg(value) FILTER (event_type = 'click') AS click, avg(value) FILTER (event_type = 'view') AS "view"
    FROM events GROUP BY user_id, CAST(ts AS DATE)"""


def pivoted_events(spark, sf):
    return (
        table(spark, sf, "events").groupBy("user_id", F.to_date("ts").alias("day"))
        .pivot("event_type", ["click", "view"]).agg(F.avg("value"))
    )


@query("b6_null_routing", f"""
    SELECT user_id, day, CASE WHEN click IS NULL THEN 'no_click' ELSE 'clicked' END AS route FROM ({PIVOTED_EVENTS})""")
def b6(spark, sf):
    wide = pivoted_events(spark, sf)
    none = wide.where(F.col("click").isNull()).select("user_id", "day", F.lit("no_click").alias("route"))
    some = wide.where(F.col("click").isNotNull()).select("user_id", "day", F.lit("clicked").alias("route"))
    return none.union(some)


@query("b7_in_list", "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (12, 34, 56, 78) AND o_orderstatus IN ('F', 'O')")
def b7(spark, sf):
    return (
        table(spark, sf, "orders").where(F.col("o_custkey").isin(12, 34, 56, 78) & F.col("o_orderstatus").isin("F", "O"))
        .select("o_orderkey", "o_custkey")
    )


@query("b8_between_after_aggregation", """
    SELECT o_custkey, CAST(o_orderdate AS DATE) AS day, round(sum(o_totalprice), 2) + 0.0 AS spend FROM orders
    GROUP BY ALL HAVING sum(o_totalprice) BETWEEN 0 AND 250000""")
def b8(spark, sf):
    spend = table(spark, sf, "orders").groupBy("o_custkey", F.to_date("o_orderdate").alias("day")).agg(F.sum("o_totalprice").alias("spend"))
    return spend.where(F.col("spend").between(0, 250000)).withColumn("spend", rnd("spend", 2))


@query("b9_string_predicates", """
    SELECT p_partkey, p_name FROM part
    WHERE NOT starts_with(p_name, 'small') AND NOT starts_with(p_name, 'hot') AND NOT ends_with(p_name, 'bolt')
      AND NOT contains(p_name, 'e w') AND contains(p_brand, '#2')""")
def b9(spark, sf):
    name = F.col("p_name")
    return (
        table(spark, sf, "part")
        .where(~name.startswith("small") & ~name.startswith("hot") & ~name.endswith("bolt"))
        .where(~name.contains("e w") & F.col("p_brand").contains("#2"))
        .select("p_partkey", "p_name")
    )


@query("b10_length_threshold", "SELECT doc_id, CAST(length(text) AS INTEGER) AS len FROM documents WHERE length(text) > 50")
def b10(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.length("text").alias("len")).where("len > 50")


@query("b11_content_split", """
    SELECT 'measure' AS kind, event_id, value, NULL AS event_type FROM events WHERE event_type IN ('purchase', 'view')
    UNION ALL SELECT 'signal', event_id, NULL, event_type FROM events WHERE event_type NOT IN ('purchase', 'view')""")
def b11(spark, sf):
    events = table(spark, sf, "events")
    measures = events.where(F.col("event_type").isin("purchase", "view")).select(F.lit("measure").alias("kind"), "event_id", "value")
    signals = events.where(~F.col("event_type").isin("purchase", "view")).select(F.lit("signal").alias("kind"), "event_id", "event_type")
    return R.append_by_name(measures, signals)


@query("b12_one_hot_flags", """
    SELECT c_custkey, c_mktsegment = 'AUTOMOBILE' AS c_mktsegment_AUTOMOBILE, c_mktsegment = 'BUILDING' AS c_mktsegment_BUILDING,
      c_mktsegment = 'FURNITURE' AS c_mktsegment_FURNITURE, c_mktsegment = 'HOUSEHOLD' AS c_mktsegment_HOUSEHOLD,
      c_mktsegment = 'MACHINERY' AS c_mktsegment_MACHINERY
    FROM customer""")
def b12(spark, sf):
    return R.one_hot_flags(table(spark, sf, "customer").select("c_custkey", "c_mktsegment"), "c_mktsegment")


@query("b13_reverse_one_hot", "SELECT o_orderkey, CASE WHEN o_orderstatus IN ('F', 'O') THEN 's_' || o_orderstatus END AS label FROM orders")
def b13(spark, sf):
    flags = R.one_hot_flags(table(spark, sf, "orders").select("o_orderkey", F.col("o_orderstatus").alias("status")), "status", ["F", "O"])
    return flags.select("o_orderkey", R.flag_to_label(["status_F", "status_O"]).alias("label"))


@query("b14_weekday_mapping", "SELECT o_orderkey, CAST(dayofweek(o_orderdate) AS INTEGER) AS weekday FROM orders")
def b14(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", S.weekday_sunday_zero("o_orderdate").alias("weekday"))


@query("b15_value_fallback", """
    SELECT event_id, CAST(CASE WHEN event_type = 'error' THEN TRY_CAST(json_extract_string(props, '$.k') AS FLOAT)
      WHEN event_type = 'signup' THEN NULL ELSE value END AS FLOAT) AS v FROM events""")
def b15(spark, sf):
    e = table(spark, sf, "events")
    numeric = F.when(~F.col("event_type").isin("error", "signup"), F.col("value"))
    display = F.when(F.col("event_type") == "error", F.get_json_object("props", "$.k")).otherwise("[no data]")
    return e.select("event_id", S.value_or_display(numeric, display).alias("v"))


@query("b16_named_arguments", """
    SELECT o_custkey, CAST(count(*) AS BIGINT) AS n FROM orders
    WHERE CAST(o_orderdate AS DATE) >= (SELECT CAST(max(o_orderdate) AS DATE) - 90 FROM orders) GROUP BY o_custkey""")
def b16(spark, sf):
    return spark.sql(
        """SELECT o_custkey, count(*) AS n FROM {orders}
           WHERE to_date(o_orderdate) >= (SELECT date_sub(max(to_date(o_orderdate)), :holdout_days) FROM {orders}) GROUP BY o_custkey""",
        args={"holdout_days": 90}, orders=table(spark, sf, "orders"),
    )


@query("b17_trim_every_string", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def b17(spark, sf):
    padded = table(spark, sf, "customer").select(
        "c_custkey", F.concat(F.lit("  "), "c_name", F.lit(" ")).alias("c_name"), F.rpad("c_mktsegment", 20, " ").alias("c_mktsegment")
    )
    return R.trim_strings(padded)


@query("f1_order_by", """
    SELECT o_orderstatus, o_orderpriority, CAST(count(*) AS BIGINT) AS n FROM orders GROUP BY ALL ORDER BY o_orderstatus, n DESC, o_orderpriority""")
def f1(spark, sf):
    return (
        table(spark, sf, "orders").groupBy("o_orderstatus", "o_orderpriority").agg(F.count("*").alias("n"))
        .orderBy("o_orderstatus", F.desc("n"), "o_orderpriority")
    )


@query("f2_peek", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def f2(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(10)


@query("f3_top_customers", "SELECT o_custkey, CAST(count(DISTINCT o_orderkey) AS BIGINT) AS n FROM orders GROUP BY o_custkey ORDER BY n DESC, o_custkey LIMIT 5")
def f3_top(spark, sf):
    return (
        table(spark, sf, "orders").groupBy("o_custkey").agg(F.count_distinct("o_orderkey").alias("n"))
        .orderBy(F.desc("n"), "o_custkey").limit(5)
    )


@query("f3_largest_magnitude", "SELECT s_suppkey, s_acctbal FROM supplier ORDER BY abs(s_acctbal) DESC, s_suppkey LIMIT 10")
def f3_abs(spark, sf):
    return table(spark, sf, "supplier").select("s_suppkey", "s_acctbal").orderBy(F.desc(F.abs("s_acctbal")), "s_suppkey").limit(10)


WORDS = r"""SELECT lang, unnest(regexp_split_to_array(lower(text), '[^\p{L}]+')) AS term FROM documents"""


def words(spark, sf):
    """(lang, term) for every run of plain letters in every document."""
    docs = table(spark, sf, "documents")
    return docs.select("lang", F.explode_outer(F.split(F.lower("text"), r"[^\p{L}]+")).alias("term")).where("length(term) > 0")


@query("f4_top_terms_per_group", f"""
    SELECT lang, term, n FROM (
      SELECT lang, term, n, row_number() OVER (PARTITION BY lang ORDER BY n DESC, term) AS rk
      FROM (SELECT lang, term, CAST(count(*) AS BIGINT) AS n FROM ({WORDS}) WHERE length(term) > 0 GROUP BY lang, term))
    WHERE rk <= 200""")
def f4(spark, sf):
    from ..operators.topics import top_n_per_group

    counts = words(spark, sf).groupBy("lang", "term").agg(F.count("*").alias("n"))
    return top_n_per_group(counts, ["lang"], [F.desc("n"), F.asc("term")], 200)


@query("f5_self_excluding_ranking", """
    SELECT l2.l_suppkey AS connection, CAST(count(*) AS BIGINT) AS n
    FROM (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_suppkey = 7) l1 JOIN lineitem l2 USING (l_orderkey)
    WHERE l2.l_suppkey <> 7 GROUP BY 1 ORDER BY n DESC, connection LIMIT 20""")
def f5(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_suppkey")
    shared = lines.join(lines.where("l_suppkey = 7").select("l_orderkey"), "l_orderkey", "left_semi").where("l_suppkey <> 7")
    return (
        shared.groupBy(F.col("l_suppkey").alias("connection")).agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), "connection").limit(20)
    )


@query("g1_union_all", """
    SELECT s_suppkey AS id, s_name AS name, s_acctbal AS bal FROM supplier UNION ALL SELECT c_custkey, c_name, c_acctbal FROM customer""")
def g1(spark, sf):
    s = table(spark, sf, "supplier").drop("s_nationkey").toDF("id", "name", "bal")
    c = table(spark, sf, "customer").drop("c_nationkey", "c_mktsegment").toDF("id", "name", "bal")
    return R.union_checked(s, c)


@query("g2_union_distinct", "SELECT c_nationkey AS nationkey FROM customer UNION SELECT s_nationkey FROM supplier")
def g2(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_nationkey").alias("nationkey"))
    return c.union(table(spark, sf, "supplier").select("s_nationkey")).distinct()


@query("g3_append_by_name", """
    SELECT o_orderkey AS loan_id, o_totalprice AS amount, NULL AS credit_score FROM orders WHERE o_orderstatus = 'F'
    UNION ALL SELECT o_orderkey, o_totalprice, CAST(o_custkey AS INTEGER) FROM orders WHERE o_orderstatus <> 'F'""")
def g3(spark, sf):
    loans = table(spark, sf, "orders").select(F.col("o_orderkey").alias("loan_id"), F.col("o_totalprice").alias("amount"), "o_custkey", "o_orderstatus")
    old = loans.where("o_orderstatus = 'F'").select("loan_id", "amount")
    new = loans.where("o_orderstatus <> 'F'").select("loan_id", F.col("o_custkey").cast("int").alias("credit_score"), "amount")
    return R.append_by_name(old, new)
