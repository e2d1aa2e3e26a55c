"""Ready-made exploration queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import aggregates as A
from ..operators import timeseries as TS
from ..sources.tables import invoices, news, table
from .registry import query, rnd


@query("k1_transactions_per_day", """
    SELECT CAST(o_orderdate AS DATE) AS day, CAST(count(DISTINCT o_orderkey) AS BIGINT) AS transactions FROM orders GROUP BY 1""")
def k1_day(spark, sf):
    return invoices(spark, sf).groupBy(F.to_date("InvoiceDate").alias("day")).agg(F.count_distinct("InvoiceNo").alias("transactions"))


@query("k1_transactions_per_month", """
    SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, CAST(count(DISTINCT o_orderkey) AS BIGINT) AS transactions FROM orders GROUP BY 1""")
def k1_month(spark, sf):
    return invoices(spark, sf).groupBy(F.trunc("InvoiceDate", "month").alias("month")).agg(F.count_distinct("InvoiceNo").alias("transactions"))


@query("k2_customers_and_transactions", """
    SELECT CAST(count(DISTINCT o_custkey) AS BIGINT) AS customers, CAST(count(DISTINCT o_orderkey) AS BIGINT) AS transactions FROM orders WHERE o_custkey IS NOT NULL""")
def k2(spark, sf):
    return invoices(spark, sf).where("CustomerID IS NOT NULL").agg(
        F.count_distinct("CustomerID").alias("customers"), F.count_distinct("InvoiceNo").alias("transactions")
    )


@query("k3_transactions_per_customer", """
    SELECT per_key, CAST(count(*) AS BIGINT) AS keys FROM (SELECT CAST(count(DISTINCT o_orderkey) AS BIGINT) AS per_key FROM orders WHERE o_custkey IS NOT NULL GROUP BY o_custkey) GROUP BY 1""")
def k3(spark, sf):
    return A.histogram_of_counts(invoices(spark, sf).where("CustomerID IS NOT NULL"), ["CustomerID"], "InvoiceNo")


@query("k3_purchase_days_per_customer", """
    SELECT per_key, CAST(count(*) AS BIGINT) AS keys FROM (SELECT CAST(count(DISTINCT CAST(o_orderdate AS DATE)) AS BIGINT) AS per_key FROM orders GROUP BY o_custkey) GROUP BY 1""")
def k3_days(spark, sf):
    return A.histogram_of_counts(invoices(spark, sf).where("CustomerID IS NOT NULL"), ["CustomerID"], F.to_date("InvoiceDate"))


@query("k4_gap_distribution", """
    WITH d AS (SELECT DISTINCT o_custkey, CAST(o_orderdate AS DATE) AS day FROM orders),
      g AS (SELECT o_custkey, day, lead(day) OVER (PARTITION BY o_custkey ORDER BY day) AS nxt FROM d),
      a AS (SELECT o_custkey, avg(nxt - day) AS gap FROM g WHERE nxt IS NOT NULL GROUP BY 1)
    SELECT CAST(floor(gap / 30) * 30 AS BIGINT) AS gap_from, CAST(count(*) AS BIGINT) AS customers FROM a GROUP BY 1""")
def k4(spark, sf):
    gaps = TS.average_gap(invoices(spark, sf).where("CustomerID IS NOT NULL"), "CustomerID", F.to_date("InvoiceDate"))
    return gaps.groupBy((F.floor(F.col("avg_gap") / 30) * 30).alias("gap_from")).agg(F.count("*").alias("customers"))


DAILY = "(SELECT o_custkey AS customer, CAST(o_orderdate AS DATE) AS day, sum(o_totalprice) AS spend FROM orders GROUP BY 1, 2)"


def daily_spend(spark, sf):
    """Spend per customer and day; a NULL customer is a group like any other here."""
    return invoices(spark, sf).groupBy(F.col("CustomerID").alias("customer"), F.to_date("InvoiceDate").alias("day")).agg(F.sum("SalesAmount").alias("spend"))


@query("k5_daily_spend", f"SELECT customer, day, round(spend, 2) + 0.0 AS spend FROM {DAILY}")
def k5(spark, sf):
    return daily_spend(spark, sf).withColumn("spend", rnd("spend", 2))


@query("k5_daily_spend_band", f"SELECT customer, day, round(spend, 2) + 0.0 AS spend FROM {DAILY} WHERE spend BETWEEN 0 AND 2500")
def k5_band(spark, sf):
    return daily_spend(spark, sf).where(F.col("spend").between(0, 2500)).withColumn("spend", rnd("spend", 2))


@query("k5_daily_spend_of_top_customers", f"""
    SELECT customer, day, round(spend, 2) + 0.0 AS spend FROM {DAILY}
    WHERE customer IN (SELECT o_custkey FROM orders GROUP BY 1 ORDER BY count(DISTINCT o_orderkey) DESC, o_custkey LIMIT 5)""")
def k5_top(spark, sf):
    top = (
        invoices(spark, sf).groupBy(F.col("CustomerID").alias("customer")).agg(F.count_distinct("InvoiceNo").alias("n"))
        .orderBy(F.desc("n"), "customer").limit(5).select("customer")
    )
    # the filter comes before the aggregate: five keys, so the semi join is a broadcast with a fixed bound
    chosen = invoices(spark, sf).withColumnRenamed("CustomerID", "customer").join(F.broadcast(top), "customer", "left_semi")
    return chosen.groupBy("customer", F.to_date("InvoiceDate").alias("day")).agg(rnd(F.sum("SalesAmount"), 2).alias("spend"))


@query("k6_yearly_trend", "SELECT CAST(year(l_shipdate) AS INTEGER) AS year, round(sum(l_quantity), 2) + 0.0 AS sales FROM lineitem GROUP BY 1")
def k6_year(spark, sf):
    return table(spark, sf, "lineitem").groupBy(F.year("l_shipdate").alias("year")).agg(rnd(F.sum("l_quantity"), 2).alias("sales"))


@query("k6_monthly_trend", "SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS month, round(sum(l_quantity), 2) + 0.0 AS sales FROM lineitem GROUP BY 1")
def k6_month(spark, sf):
    return table(spark, sf, "lineitem").groupBy(F.trunc("l_shipdate", "month").alias("month")).agg(rnd(F.sum("l_quantity"), 2).alias("sales"))


@query("k6_weekday_trend", """
    SELECT CAST(year(day) AS INTEGER) AS year, CAST(dayofweek(day) AS INTEGER) AS weekday, round(avg(q), 6) + 0.0 AS sales
    FROM (SELECT CAST(l_shipdate AS DATE) AS day, sum(l_quantity) AS q FROM lineitem GROUP BY 1) GROUP BY 1, 2""")
def k6_weekday(spark, sf):
    daily = table(spark, sf, "lineitem").groupBy(F.to_date("l_shipdate").alias("day")).agg(F.sum("l_quantity").alias("q"))
    return daily.groupBy(F.year("day").alias("year"), S.weekday_sunday_zero("day").alias("weekday")).agg(rnd(F.avg("q"), 6).alias("sales"))


@query("k7_revenue_by_geo", """
    SELECT n_name AS geo, round(sum(o_totalprice), 2) + 0.0 AS revenue FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1""")
def k7_geo(spark, sf):
    spend = table(spark, sf, "orders").groupBy("o_custkey").agg(F.sum("o_totalprice").alias("v"))
    return (
        spend.join(table(spark, sf, "customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("c_nationkey").agg(F.sum("v").alias("v"))
        .join(table(spark, sf, "nation").select("n_nationkey", "n_name"), F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy(F.col("n_name").alias("geo")).agg(rnd(F.sum("v"), 2).alias("revenue"))
    )


@query("k7_publisher_counts", "SELECT event_type AS publisher, CAST(count(*) AS BIGINT) AS n FROM events GROUP BY 1")
def k7_publisher(spark, sf):
    return table(spark, sf, "events").groupBy(F.col("event_type").alias("publisher")).agg(F.count("*").alias("n"))


@query("k7_state_by_browser", """
    SELECT c_nationkey AS state, event_type AS browser, CAST(count(*) AS BIGINT) AS n FROM events JOIN customer ON user_id = c_custkey GROUP BY 1, 2""")
def k7_state(spark, sf):
    counts = table(spark, sf, "events").groupBy("user_id", F.col("event_type").alias("browser")).agg(F.count("*").alias("n"))
    users = table(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").alias("state"))
    return counts.join(users, F.col("user_id") == F.col("c_custkey")).groupBy("state", "browser").agg(F.sum("n").alias("n"))


@query("k8_news_volume_per_month", "SELECT strftime(l_shipdate, '%Y-%m') AS month, CAST(count(*) AS BIGINT) AS articles FROM lineitem GROUP BY 1")
def k8(spark, sf):
    return news(spark, sf).groupBy(S.year_month("publishDate").alias("month")).agg(F.count("*").alias("articles"))
