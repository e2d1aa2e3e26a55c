"""Windows and daily series over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import relational as R
from ..operators import timeseries as TS
from ..sources.tables import news, prices, table
from .registry import query, rnd

PRICES = "(SELECT l_suppkey AS symbol, CAST(l_shipdate AS DATE) AS date, avg(l_extendedprice) AS close FROM lineitem GROUP BY 1, 2)"


@query("e1_previous_or_self", f"""
    SELECT symbol, date, round(coalesce(lag(close) OVER (PARTITION BY symbol ORDER BY date), close), 5) + 0.0 AS "first" FROM {PRICES}""")
def e1(spark, sf):
    return TS.previous_or_self(prices(spark, sf), "symbol", "date", "close", "first").select("symbol", "date", rnd("first", 5).alias("first"))


@query("e2_log_return", f"""
    SELECT symbol, date, round(ln(close / coalesce(lag(close) OVER (PARTITION BY symbol ORDER BY date), close)), 8) + 0.0 AS "return" FROM {PRICES}""")
def e2(spark, sf):
    return TS.log_returns(prices(spark, sf), "symbol", "date", "close").select("symbol", "date", rnd("return", 8).alias("return"))


def _rolling_sql(rows):
    return f"""
    SELECT symbol, date, CASE WHEN count(close) OVER w = {rows} THEN round(avg(close) OVER w, 5) + 0.0 END AS smooth FROM {PRICES}
    WINDOW w AS (PARTITION BY symbol ORDER BY date ROWS BETWEEN {rows - 1} PRECEDING AND CURRENT ROW)"""


for _rows in (7, 30):
    query(f"e3_rolling_mean_{_rows}", _rolling_sql(_rows))(
        lambda spark, sf, rows=_rows: TS.rolling_mean(prices(spark, sf), "symbol", "date", "close", rows, "smooth")
        .select("symbol", "date", rnd("smooth", 5).alias("smooth"))
    )


def _pad_sql(weekdays):
    return f"""
    WITH s AS (SELECT l_suppkey AS symbol, CAST(l_shipdate AS DATE) AS date, avg(CASE WHEN l_returnflag <> 'N' THEN l_quantity END) AS q FROM lineitem GROUP BY 1, 2),
      c AS (SELECT symbol, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date FROM (SELECT symbol, min(date) AS lo, max(date) AS hi FROM s GROUP BY 1))
    SELECT c.symbol, c.date, round(s.q, 6) + 0.0 AS q FROM c ASOF JOIN s ON c.symbol = s.symbol AND c.date >= s.date {'WHERE isodow(c.date) < 6' if weekdays else ''}"""


for _weekdays, _name in ((False, "days"), (True, "weekdays")):
    query(f"e4_densify_pad_{_name}", _pad_sql(_weekdays))(
        lambda spark, sf, weekdays=_weekdays: TS.densify_pad(_quantities(spark, sf), ["symbol"], "date", weekdays)
        .select("symbol", "date", rnd("q", 6).alias("q"))
    )


def _quantities(spark, sf):
    """Mean quantity per supplier and day, NULL on days with only unreturned lines."""
    return table(spark, sf, "lineitem").groupBy(F.col("l_suppkey").alias("symbol"), F.to_date("l_shipdate").alias("date")).agg(
        F.avg(F.when(F.col("l_returnflag") != "N", F.col("l_quantity"))).alias("q")
    )


NATION_YEAR_WIDE = """(SELECT c_nationkey AS country, CAST(year(o_orderdate) AS INTEGER) AS year,
      max(o_totalprice) FILTER (o_totalprice > 490000 AND o_orderstatus = 'F') AS f, max(o_totalprice) FILTER (o_totalprice > 480000 AND o_orderstatus = 'O') AS o
      FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)"""


def _fill_sql(c):
    return f"""coalesce(last_value({c} IGNORE NULLS) OVER (PARTITION BY country ORDER BY year ROWS UNBOUNDED PRECEDING),
      first_value({c} IGNORE NULLS) OVER (PARTITION BY country ORDER BY year ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS {c}"""


@query("e5_fill_forward_back", f"SELECT country, year, {_fill_sql('f')}, {_fill_sql('o')} FROM {NATION_YEAR_WIDE}")
def e5(spark, sf):
    customers = table(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").alias("country"))
    orders = table(spark, sf, "orders").select("o_custkey", F.year("o_orderdate").alias("year"), "o_orderstatus", "o_totalprice")
    price, status = F.col("o_totalprice"), F.col("o_orderstatus")
    wide = orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).groupBy("country", "year").agg(
        F.max(F.when((price > 490000) & (status == "F"), price)).alias("f"), F.max(F.when((price > 480000) & (status == "O"), price)).alias("o")
    )
    return TS.fill_forward_back(wide, "country", "year")


@query("e6_rebase", f"""
    SELECT symbol, date, round(100 * close / first_value(close) OVER (PARTITION BY symbol ORDER BY date), 6) + 0.0 AS close FROM {PRICES}""")
def e6(spark, sf):
    return TS.rebase(prices(spark, sf), "symbol", "date", "close").withColumn("close", rnd("close", 6))


@query("e7_average_gap", """
    WITH d AS (SELECT DISTINCT o_custkey, CAST(o_orderdate AS DATE) AS day FROM orders),
      g AS (SELECT o_custkey, day, lead(day) OVER (PARTITION BY o_custkey ORDER BY day) AS nxt FROM d)
    SELECT o_custkey, round(avg(nxt - day), 8) + 0.0 AS avg_gap FROM g WHERE nxt IS NOT NULL GROUP BY o_custkey""")
def e7(spark, sf):
    return TS.average_gap(table(spark, sf, "orders"), "o_custkey", F.to_date("o_orderdate")).withColumn("avg_gap", rnd("avg_gap", 8))


@query("e8_difference_to_benchmark", """
    WITH o AS (SELECT l_suppkey AS organisation, CAST(l_shipdate AS DATE) AS date, avg(l_discount) AS tone FROM lineitem GROUP BY 1, 2),
      i AS (SELECT CAST(l_shipdate AS DATE) AS date, avg(l_discount) AS tone FROM lineitem GROUP BY 1)
    SELECT organisation, date, round(o.tone - i.tone, 8) + 0.0 AS diff FROM o JOIN i USING (date)""")
def e8(spark, sf):
    mentions = news(spark, sf).withColumnRenamed("publishDate", "date")
    # the benchmark comes from the per-organisation sums, so the raw rows are read once per rollup level
    per = mentions.groupBy("organisation", "date").agg(F.sum("tone").alias("s"), F.count("*").alias("n"))
    industry = per.groupBy("date").agg((F.sum("s") / F.sum("n")).alias("tone"))
    diff = TS.to_benchmark(per.select("organisation", "date", (F.col("s") / F.col("n")).alias("tone")), industry, ["date"], "tone")
    return diff.select("organisation", "date", rnd("diff", 8).alias("diff"))


@query("e9_year_range_rows", """
    SELECT o_orderkey, CAST(unnest(CASE WHEN o_orderpriority = '5-LOW' THEN range(year(o_orderdate), year(o_orderdate) + 4) ELSE [year(o_orderdate)] END) AS INTEGER) AS year FROM orders""")
def e9(spark, sf):
    year = F.year("o_orderdate")
    text = F.when(F.col("o_orderpriority") == "5-LOW", F.concat(year, F.lit("-"), year + 3)).otherwise(year.cast("string"))
    return table(spark, sf, "orders").select("o_orderkey", F.explode(S.year_range(text)).alias("year"))


@query("e10_time_split", """
    SELECT CASE WHEN year(o_orderdate) <= 1999 THEN 'train' ELSE 'test' END AS part, CAST(count(*) AS BIGINT) AS n FROM orders GROUP BY 1""")
def e10(spark, sf):
    train, test = TS.split_at(table(spark, sf, "orders").select("o_orderdate"), "o_orderdate", F.lit("2000-01-01").cast("timestamp_ntz"))
    return train.agg(F.lit("train").alias("part"), F.count("*").alias("n")).union(test.agg(F.lit("test").alias("part"), F.count("*").alias("n")))


@query("e10_calibration_split", """
    SELECT o_custkey, CAST(count(*) FILTER (CAST(o_orderdate AS DATE) < e - 90) AS BIGINT) AS cal, CAST(count(*) FILTER (CAST(o_orderdate AS DATE) >= e - 90) AS BIGINT) AS holdout
    FROM orders, (SELECT CAST(max(o_orderdate) AS DATE) AS e FROM orders) GROUP BY o_custkey""")
def e10_calibration(spark, sf):
    orders = table(spark, sf, "orders").select("o_custkey", F.to_date("o_orderdate").alias("day"))
    cut = F.date_sub("end", 90)
    return R.with_scalars(orders, end=orders.agg(F.max("day"))).groupBy("o_custkey").agg(
        F.count_if(F.col("day") < cut).alias("cal"), F.count_if(F.col("day") >= cut).alias("holdout")
    )
