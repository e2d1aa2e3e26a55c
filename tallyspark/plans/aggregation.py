"""Aggregations over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregates as A
from ..operators import quantiles as Q
from ..operators import relational as R
from ..sources.tables import invoices, news, table
from .registry import query, rnd


@query("d1_global_aggregate", "SELECT CAST(count(*) AS BIGINT) AS n, min(o_orderdate) AS first_at, max(o_orderdate) AS last_at, max(o_totalprice) AS top FROM orders")
def d1(spark, sf):
    return table(spark, sf, "orders").agg(
        F.count("*").alias("n"), F.min("o_orderdate").alias("first_at"), F.max("o_orderdate").alias("last_at"), F.max("o_totalprice").alias("top")
    )


@query("d2_grouped_aggregate", """
    SELECT l_returnflag, l_linestatus, CAST(count(*) AS BIGINT) AS n, round(sum(l_quantity), 2) + 0.0 AS qty,
      round(avg(l_extendedprice), 4) + 0.0 AS mean_price, min(l_discount) AS lo, max(l_discount) AS hi
    FROM lineitem GROUP BY l_returnflag, l_linestatus""")
def d2(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.count("*").alias("n"), rnd(F.sum("l_quantity"), 2).alias("qty"), rnd(F.avg("l_extendedprice")).alias("mean_price"),
        F.min("l_discount").alias("lo"), F.max("l_discount").alias("hi"),
    )


@query("d3_count_distinct", """
    SELECT l_returnflag, CAST(count(DISTINCT l_orderkey) AS BIGINT) AS orders, CAST(count(DISTINCT l_suppkey) AS BIGINT) AS suppliers,
      CAST(count(DISTINCT year(l_shipdate)) AS BIGINT) AS years FROM lineitem GROUP BY l_returnflag""")
def d3(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_returnflag").agg(
        F.count_distinct("l_orderkey").alias("orders"), F.count_distinct("l_suppkey").alias("suppliers"),
        F.count_distinct(F.year("l_shipdate")).alias("years"),
    )


@query("d4_derived_keys", """
    SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(count(*) AS BIGINT) AS n
    FROM orders GROUP BY 1, 2""")
def d4(spark, sf):
    return table(spark, sf, "orders").groupBy(
        F.trunc("o_orderdate", "month").alias("month"), F.year("o_orderdate").alias("year")
    ).agg(F.count("*").alias("n"))


@query("d5_histogram_of_counts", """
    SELECT per_key, CAST(count(*) AS BIGINT) AS keys FROM (SELECT CAST(count(*) AS BIGINT) AS per_key FROM orders GROUP BY o_custkey) GROUP BY per_key""")
def d5(spark, sf):
    return A.histogram_of_counts(table(spark, sf, "orders"), ["o_custkey"])


@query("d6_having_aliases", """
    SELECT l_suppkey, CAST(count(*) AS BIGINT) AS total, CAST(count(DISTINCT CAST(l_shipdate AS DATE)) AS BIGINT) AS days FROM lineitem
    GROUP BY l_suppkey HAVING count(*) > 560 AND count(DISTINCT CAST(l_shipdate AS DATE)) > 530""")
def d6(spark, sf):
    per = table(spark, sf, "lineitem").groupBy("l_suppkey").agg(F.count("*").alias("total"), F.count_distinct(F.to_date("l_shipdate")).alias("days"))
    return per.where("total > 560 AND days > 530")


@query("d7_conditional_mean", """
    WITH d AS (SELECT o_custkey AS c, CAST(o_orderdate AS DATE) AS day, sum(o_totalprice) AS amt FROM orders GROUP BY 1, 2),
      f AS (SELECT c, min(day) AS first_day, count(*) AS days FROM d GROUP BY c)
    SELECT d.c AS customer, CAST(CASE WHEN any_value(days) = 1 THEN 0 ELSE round(sum(amt) FILTER (day > first_day) / (any_value(days) - 1), 6) END AS DOUBLE) + 0.0 AS mean_repeat
    FROM d JOIN f ON d.c = f.c GROUP BY d.c""")
def d7(spark, sf):
    daily = invoices(spark, sf).groupBy("CustomerID", F.to_date("InvoiceDate").alias("day")).agg(F.sum("SalesAmount").alias("amt"))
    # the first day's amount comes along as min_by, so no join back to a first-purchase table is needed
    per = daily.groupBy(F.col("CustomerID").alias("customer")).agg(
        F.sum("amt").alias("s"), F.min_by("amt", "day").alias("first_amt"), F.count("*").alias("days")
    )
    mean = F.when(F.col("days") == 1, 0.0).otherwise((F.col("s") - F.col("first_amt")) / (F.col("days") - 1))
    return per.select("customer", rnd(mean, 6).alias("mean_repeat"))


@query("d8_additive_rollup", """
    SELECT CAST(l_shipdate AS DATE) AS "publishDate", l_returnflag AS theme, round(sum(l_discount) / count(*), 6) + 0.0 AS tone, CAST(count(*) AS BIGINT) AS total
    FROM lineitem GROUP BY 1, 2""")
def d8(spark, sf):
    store = A.rollup_store(news(spark, sf), ["publishDate", "organisation", "theme"], "tone")
    return A.rollup_average(store, ["publishDate", "theme"], "tone").withColumn("tone", rnd("tone", 6))


@query("d9_weighted_average", "SELECT l_suppkey, round(sum(l_extendedprice * l_quantity) / sum(l_quantity), 4) + 0.0 AS price FROM lineitem GROUP BY l_suppkey")
def d9(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_suppkey").agg(rnd(A.weighted_average("l_extendedprice", "l_quantity")).alias("price"))


@query("d10_group_multiset", "SELECT l_orderkey AS url, l_suppkey AS organisation, CAST(count(*) AS BIGINT) AS copies FROM lineitem GROUP BY 1, 2")
def d10(spark, sf):
    return A.group_multiset(news(spark, sf), "url", "organisation")


@query("d11_edge_counting", "SELECT l_suppkey AS src, l_partkey AS dst, CAST(sum(1) AS BIGINT) AS relationship FROM lineitem GROUP BY 1, 2")
def d11(spark, sf):
    return table(spark, sf, "lineitem").groupBy(F.col("l_suppkey").alias("src"), F.col("l_partkey").alias("dst")).agg(F.sum(F.lit(1)).alias("relationship"))


@query("d12_last_value_by_time", """
    SELECT user_id, date_trunc('hour', ts) AS hour, arg_max(event_type, ts) AS last_type FROM events GROUP BY 1, 2""")
def d12(spark, sf):
    return table(spark, sf, "events").groupBy("user_id", F.window("ts", "1 hour")["start"].alias("hour")).agg(F.max_by("event_type", "ts").alias("last_type"))


EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


@query("d13_pivot_average", "SELECT user_id, " + ", ".join(f"round(avg(value) FILTER (event_type = '{t}'), 9) + 0.0 AS \"{t}\"" for t in EVENT_TYPES) + " FROM events GROUP BY user_id")
def d13(spark, sf):
    wide = table(spark, sf, "events").groupBy("user_id").pivot("event_type", EVENT_TYPES).agg(F.avg("value"))
    return wide.select("user_id", *[rnd(t, 9).alias(t) for t in EVENT_TYPES])


@query("d14_cross_tab", "SELECT user_id, " + ", ".join(f"CAST(count(*) FILTER (event_type = '{t}') AS BIGINT) AS \"{t}\"" for t in EVENT_TYPES) + " FROM events GROUP BY user_id")
def d14(spark, sf):
    return A.cross_tab(table(spark, sf, "events"), "user_id", "event_type", EVENT_TYPES)


@query("d15_distinct", "SELECT DISTINCT l_suppkey, l_returnflag, l_linestatus FROM lineitem")
def d15(spark, sf):
    return table(spark, sf, "lineitem").select("l_suppkey", "l_returnflag", "l_linestatus").distinct()


@query("d16_keep_latest", """
    SELECT o_custkey, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS o_orderkey, arg_max(o_totalprice, (o_orderdate, o_orderkey)) AS o_totalprice
    FROM orders GROUP BY o_custkey""")
def d16(spark, sf):
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate")
    return R.keep_one(orders, ["o_custkey"], [F.col("o_orderdate"), F.col("o_orderkey")]).drop("o_orderdate")


def _summary_sql(c):
    return f"""SELECT '{c}' AS "column", CAST(count({c}) AS BIGINT) AS "count", round(avg({c}), 4) + 0.0 AS mean, round(stddev_samp({c}), 4) + 0.0 AS stddev,
      CAST(min({c}) AS DOUBLE) AS "min", CAST(max({c}) AS DOUBLE) AS "max", round(quantile_cont({c}, 0.25), 4) + 0.0 AS p25,
      round(quantile_cont({c}, 0.5), 4) + 0.0 AS p50, round(quantile_cont({c}, 0.75), 4) + 0.0 AS p75 FROM lineitem"""


@query("d17_summary", " UNION ALL ".join(_summary_sql(c) for c in ("l_quantity", "l_extendedprice", "l_discount")))
def d17(spark, sf):
    s = A.summary(table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"])
    return s.withColumns({c: rnd(c) for c in ("mean", "stddev", "p25", "p50", "p75")})


@query("d18_correlation", "SELECT round(corr(l_quantity, l_extendedprice), 6) + 0.0 AS r FROM lineitem")
def d18(spark, sf):
    return table(spark, sf, "lineitem").agg(rnd(F.corr("l_quantity", "l_extendedprice"), 6).alias("r"))


@query("d19_pairwise_correlation", """
    SELECT 'l_quantity' AS x, 'l_extendedprice' AS y, round(corr(l_quantity, l_extendedprice), 6) + 0.0 AS corr FROM lineitem
    UNION ALL SELECT 'l_quantity', 'l_discount', round(corr(l_quantity, l_discount), 6) + 0.0 FROM lineitem
    UNION ALL SELECT 'l_extendedprice', 'l_discount', round(corr(l_extendedprice, l_discount), 6) + 0.0 FROM lineitem""")
def d19(spark, sf):
    return A.pairwise_correlation(table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"]).withColumn("corr", rnd("corr", 6))


DECILES = [round(0.1 * i, 1) for i in range(1, 10)]


@query("d20_exact_deciles", " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", CAST({p} AS DOUBLE) AS prob, round(quantile_cont({c}, {p}), 4) + 0.0 AS value FROM orders, lineitem WHERE o_orderkey = l_orderkey"""
    for c in ("o_totalprice", "l_extendedprice") for p in DECILES))
def d20(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_extendedprice")
    both = orders.join(lines, orders["o_orderkey"] == lines["l_orderkey"])
    return Q.exact_quantiles(both, ["o_totalprice", "l_extendedprice"], DECILES).withColumn("value", rnd("value"))


@query("d20_exact_deciles_per_group", " UNION ALL ".join(
    f"SELECT l_suppkey, CAST({p} AS DOUBLE) AS prob, round(quantile_cont(l_extendedprice, {p}), 4) + 0.0 AS value FROM lineitem GROUP BY l_suppkey" for p in DECILES))
def d20_group(spark, sf):
    q = Q.exact_quantiles(table(spark, sf, "lineitem").select("l_suppkey", "l_extendedprice"), ["l_extendedprice"], DECILES, keys=["l_suppkey"])
    return q.select("l_suppkey", "prob", rnd("value").alias("value"))


# rating classes from worst to best (fixed values)
RATINGS = ["BBB", "BB", "A", "AA", "AAA"]


@query("d21_quantile_labels", """
    WITH e AS (SELECT quantile_cont(s_acctbal, 0.2) AS a, quantile_cont(s_acctbal, 0.4) AS b, quantile_cont(s_acctbal, 0.6) AS c, quantile_cont(s_acctbal, 0.8) AS d FROM supplier)
    SELECT s_suppkey, CASE WHEN s_acctbal <= a THEN 'BBB' WHEN s_acctbal <= b THEN 'BB' WHEN s_acctbal <= c THEN 'A' WHEN s_acctbal <= d THEN 'AA' ELSE 'AAA' END AS rating
    FROM supplier, e""")
def d21(spark, sf):
    return Q.quantile_labels(table(spark, sf, "supplier").select("s_suppkey", "s_acctbal"), "s_acctbal", RATINGS, "rating").select("s_suppkey", "rating")


def _histogram_sql(bins):
    return f"""
    WITH e AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders)
    SELECT CAST(least(floor((o_totalprice - lo) / ((hi - lo) / {bins})), {bins - 1}) AS INTEGER) AS bin, CAST(count(*) AS BIGINT) AS n FROM orders, e GROUP BY 1"""


for _bins in (10, 40, 200):
    query(f"d22_histogram_{_bins}", _histogram_sql(_bins))(
        lambda spark, sf, bins=_bins: Q.histogram(table(spark, sf, "orders").select("o_totalprice"), "o_totalprice", bins)
    )


@query("d23_regression_metrics", """
    WITH p AS (SELECT l_returnflag, l_extendedprice AS y, l_quantity * 1500 AS yhat FROM lineitem)
    SELECT l_returnflag, round(avg(abs(y - yhat)), 3) + 0.0 AS mae, round(sqrt(avg((y - yhat) * (y - yhat))), 3) + 0.0 AS rmse FROM p GROUP BY l_returnflag""")
def d23(spark, sf):
    p = table(spark, sf, "lineitem").select("l_returnflag", F.col("l_extendedprice").alias("y"), (F.col("l_quantity") * 1500).alias("yhat"))
    m = A.regression_metrics(p, "y", "yhat", ["l_returnflag"])
    return m.select("l_returnflag", rnd("mae", 3).alias("mae"), rnd("rmse", 3).alias("rmse"))


@query("d23_regression_metrics_global", """
    SELECT round(avg(abs(l_extendedprice - l_quantity * 1500)), 3) + 0.0 AS mae,
      round(sqrt(avg((l_extendedprice - l_quantity * 1500) ** 2)), 3) + 0.0 AS rmse FROM lineitem""")
def d23_global(spark, sf):
    p = table(spark, sf, "lineitem").select(F.col("l_extendedprice").alias("y"), (F.col("l_quantity") * 1500).alias("yhat"))
    return A.regression_metrics(p, "y", "yhat").select(rnd("mae", 3).alias("mae"), rnd("rmse", 3).alias("rmse"))


@query("d24_min_max_scaling", """
    SELECT c_custkey, round((c_acctbal - min(c_acctbal) OVER ()) / (max(c_acctbal) OVER () - min(c_acctbal) OVER ()), 6) + 0.0 AS c_acctbal,
      round((c_nationkey - min(c_nationkey) OVER ()) / CAST(max(c_nationkey) OVER () - min(c_nationkey) OVER () AS DOUBLE), 6) + 0.0 AS c_nationkey, 0.0::DOUBLE AS flat
    FROM customer""")
def d24(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_acctbal", "c_nationkey", F.lit(3.0).alias("flat"))
    s = Q.min_max_scale(c, ["c_acctbal", "c_nationkey", "flat"])
    return s.withColumns({x: rnd(x, 6) for x in ("c_acctbal", "c_nationkey")})


@query("d25_table_counts", """
    SELECT 'orders' AS table_name, CAST(count(*) AS BIGINT) AS "rows" FROM orders UNION SELECT 'lineitem', count(*) FROM lineitem UNION SELECT 'customer', count(*) FROM customer""")
def d25(spark, sf):
    return A.table_counts(**{t: table(spark, sf, t) for t in ("orders", "lineitem", "customer")})


@query("d26_extremes", """
    SELECT 'lowest' AS which, s_suppkey, s_acctbal FROM (SELECT * FROM supplier ORDER BY s_acctbal, s_suppkey LIMIT 1)
    UNION ALL SELECT 'highest', s_suppkey, s_acctbal FROM (SELECT * FROM supplier ORDER BY s_acctbal DESC, s_suppkey LIMIT 1)""")
def d26(spark, sf):
    return A.extremes(table(spark, sf, "supplier").select("s_suppkey", "s_acctbal"), "s_acctbal", "s_suppkey")
