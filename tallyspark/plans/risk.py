"""Market risk queries: suppliers are symbols, their nation key names the organisation held."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import risk as K
from ..operators import news as N
from ..sources.tables import news, prices, table
from .news import GOLD, SCORES, scores
from .registry import query, rnd
from .timeseries import PRICES


def portfolio(spark, sf):
    return table(spark, sf, "supplier").select(F.col("s_suppkey").alias("symbol"), F.col("s_nationkey").cast("long").alias("organisation"))


PORTFOLIO = "(SELECT s_suppkey AS symbol, CAST(s_nationkey AS BIGINT) AS organisation FROM supplier)"


@query("p1_portfolio_scores", f"SELECT symbol, organisation, theme, round(esg, 9) + 0.0 AS esg FROM {PORTFOLIO} JOIN {SCORES} USING (organisation)")
def p1(spark, sf):
    return K.portfolio_scores(portfolio(spark, sf), scores(spark, sf)).withColumn("esg", rnd("esg", 9))


RATED = f"""m AS (SELECT symbol, organisation, esg FROM (SELECT organisation, avg(esg) AS esg FROM {SCORES} GROUP BY 1) JOIN {PORTFOLIO} USING (organisation)),
      q AS (SELECT quantile_cont(esg, 0.2) AS a, quantile_cont(esg, 0.4) AS b, quantile_cont(esg, 0.6) AS c, quantile_cont(esg, 0.8) AS d FROM m),
      rated AS (SELECT symbol, organisation, esg, CASE WHEN esg <= a THEN 'BBB' WHEN esg <= b THEN 'BB' WHEN esg <= c THEN 'A' WHEN esg <= d THEN 'AA' ELSE 'AAA' END AS rating FROM m, q)"""


def rated(spark, sf):
    # the label edges and the rows labelled must agree to the last bit, so both read the one written table of scores
    return K.rate(portfolio(spark, sf), scores(spark, sf))


@query("p2_ratings", f"WITH {RATED} SELECT symbol, organisation, round(esg, 9) + 0.0 AS esg FROM rated")
def p2(spark, sf):
    return rated(spark, sf).select("symbol", "organisation", rnd("esg", 9).alias("esg"))


@query("p2_rating_classes", f"WITH {RATED} SELECT symbol, rating FROM rated")
def p2_classes(spark, sf):
    return rated(spark, sf).select("symbol", "rating")


@query("p3_business_day_prices", f"""
    WITH s AS {PRICES}, c AS (SELECT symbol, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date FROM (SELECT symbol, min(date) AS lo, max(date) AS hi FROM s GROUP BY 1))
    SELECT c.symbol, c.date, round(s.close, 5) + 0.0 AS close FROM c ASOF JOIN s ON c.symbol = s.symbol AND c.date >= s.date WHERE isodow(c.date) < 6""")
def p3(spark, sf):
    return K.price_history(prices(spark, sf)).withColumn("close", rnd("close", 5))


RETURNS = f"""r AS (SELECT symbol, date, close, ln(close / coalesce(lag(close) OVER (PARTITION BY symbol ORDER BY date), close)) AS ret FROM {PRICES})"""


@query("p4_rated_returns", f"""WITH {RATED}, {RETURNS} SELECT symbol, rating, date, round(close, 5) + 0.0 AS close, round(ret, 8) + 0.0 AS "return" FROM r JOIN rated USING (symbol)""")
def p4(spark, sf):
    return K.rated_returns(prices(spark, sf), rated(spark, sf)).withColumns({"close": rnd("close", 5), "return": rnd("return", 8)})


@query("p5_class_returns", f"""WITH {RATED}, {RETURNS} SELECT rating, date, round(sum(ret), 8) + 0.0 AS "return" FROM r JOIN rated USING (symbol) GROUP BY 1, 2""")
def p5(spark, sf):
    return K.class_returns(K.rated_returns(prices(spark, sf), rated(spark, sf))).withColumn("return", rnd("return", 8))


@query("p6_value_at_risk", f"""WITH {RATED}, {RETURNS}, d AS (SELECT rating, date, sum(ret) AS ret FROM r JOIN rated USING (symbol) GROUP BY 1, 2)
    SELECT rating, round(quantile_cont(ret, 0.05), 8) + 0.0 AS "var" FROM d GROUP BY 1""")
def p6(spark, sf):
    return K.value_at_risk(K.class_returns(K.rated_returns(prices(spark, sf), rated(spark, sf)))).withColumn("var", rnd("var", 8))


@query("p7_sentiment_against_price", f"""
    WITH {RATED}, t AS (SELECT 'lowest' AS which, arg_min(symbol, (esg, symbol)) AS symbol FROM rated UNION ALL SELECT 'highest', arg_min(symbol, (-esg, symbol)) FROM rated),
      w AS (SELECT t.which, t.symbol, organisation FROM t JOIN rated USING (symbol)),
      s AS (SELECT organisation, date, sum(tone) / sum(total) AS tone FROM {GOLD} WHERE organisation IN (SELECT organisation FROM w) GROUP BY 1, 2),
      sc AS (SELECT organisation, CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date FROM s GROUP BY organisation),
      sd AS (SELECT sc.organisation, sc.date, s.tone FROM sc ASOF JOIN s ON sc.organisation = s.organisation AND sc.date >= s.date),
      p AS (SELECT symbol, date, close / first_value(close) OVER (PARTITION BY symbol ORDER BY date) * 100 AS close FROM {PRICES} WHERE symbol IN (SELECT symbol FROM w)),
      pc AS (SELECT symbol, CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date FROM p GROUP BY symbol),
      pd AS (SELECT pc.symbol, pc.date, p.close FROM pc ASOF JOIN p ON pc.symbol = p.symbol AND pc.date >= p.date),
      a AS (SELECT w.which, w.symbol, w.organisation, sd.date, sd.tone, pd.close FROM w JOIN sd USING (organisation) LEFT JOIN pd ON pd.symbol = w.symbol AND pd.date = sd.date)
    SELECT which, symbol, organisation, date, CASE WHEN count(tone) OVER m = 30 THEN round(avg(tone) OVER m, 8) + 0.0 END AS tone_smooth,
      CASE WHEN count(close) OVER v = 7 THEN round(avg(close) OVER v, 6) + 0.0 END AS close_smooth FROM a
    WINDOW m AS (PARTITION BY which ORDER BY date ROWS 29 PRECEDING), v AS (PARTITION BY which ORDER BY date ROWS 6 PRECEDING)""")
def p7(spark, sf):
    out = K.sentiment_against_price(rated(spark, sf), N.gold_rollup(news(spark, sf)), prices(spark, sf))
    return out.withColumns({"tone_smooth": rnd("tone_smooth", 8), "close_smooth": rnd("close_smooth", 6)})
