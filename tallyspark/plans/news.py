"""News sentiment queries: lineitem stands for mentions of organisations (suppliers) in articles (orders)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import news as N
from ..operators import relational as R
from ..session import materialize
from ..sources.tables import news, table
from .registry import query, rnd

# names and classes of this binding (fixed values): words of part names stand for theme prefixes
PART_THEMES = {"red": "E", "hot": "E", "small": "G", "blue": "G", "widget": "S", "bolt": "S", "gear": "S"}
PART_ALIASES = {"tiny things": ["small", "brand#1"], "heat": ["hot"], "bolts": ["blue bolt"]}


def articles_of(part):
    """part, as a table or a stream, in the shape of news bronze: two organisations, themes, two places, a tone."""
    code = lambda c: F.struct(c.cast("string").alias("countryCode"))
    return part.select(
        F.lit("2024-01-01").cast("date").alias("publishDate"), F.array("p_name", "p_brand").alias("organisations"), F.col("p_partkey").alias("documentIdentifier"),
        F.transform(F.split("p_name", " "), lambda w: F.concat(w, F.lit("_TOPIC"))).alias("themes"),
        F.array(code(F.col("p_size")), code(F.col("p_size") % 25)).alias("locations"), F.struct(F.col("p_retailprice").alias("tone")).alias("tone"),
    )


@query("o1_enriched_mentions", """
    WITH p AS (SELECT *, list_filter(list_transform(string_split(p_name, ' '), lambda w: CASE w WHEN 'red' THEN 'E' WHEN 'hot' THEN 'E' WHEN 'small' THEN 'G'
        WHEN 'blue' THEN 'G' WHEN 'widget' THEN 'S' WHEN 'bolt' THEN 'S' WHEN 'gear' THEN 'S' END), lambda x: x IS NOT NULL) AS c FROM part),
      o AS (SELECT p.*, lower(unnest([p_name, p_brand])) AS org FROM p WHERE list_contains(c, 'G'))
    SELECT CASE WHEN starts_with(org, 'blue bolt') THEN 'bolts' WHEN starts_with(org, 'hot') THEN 'heat' WHEN starts_with(org, 'small') OR starts_with(org, 'brand#1') THEN 'tiny things' ELSE org END AS organisation,
      p_partkey AS url, array_to_string(list_sort(list_distinct(c)), ',') AS themes, p_retailprice AS tone,
      array_to_string(list_sort(list_distinct(list_filter([CASE WHEN p_size BETWEEN 3 AND 7 THEN 'C' || p_size END, CASE WHEN p_size % 25 BETWEEN 3 AND 7 THEN 'C' || (p_size % 25) END], lambda x: x IS NOT NULL))), ',') AS countries
    FROM o""")
def o1(spark, sf):
    codes = {str(i): f"C{i}" for i in range(3, 8)}
    m = N.enrich(articles_of(table(spark, sf, "part")), PART_ALIASES, codes, PART_THEMES)
    return m.select(
        "organisation", "url", F.array_join(F.array_sort("themes"), ",").alias("themes"), "tone", F.array_join(F.array_sort("countries"), ",").alias("countries")
    )


GOLD = """(SELECT CAST(l_shipdate AS DATE) AS date, l_suppkey AS organisation, l_returnflag AS theme, sum(l_discount) AS tone, CAST(count(*) AS BIGINT) AS total
      FROM lineitem GROUP BY 1, 2, 3)"""


@query("o2_gold_rollup", f"SELECT date, organisation, theme, round(tone, 6) + 0.0 AS tone, total FROM {GOLD}")
def o2(spark, sf):
    return N.gold_rollup(news(spark, sf)).withColumn("tone", rnd("tone", 6))


def _pad_daily_sql(key):
    k, part = (f"{key}, ", f"{key}") if key else ("", "")
    on = f"c.{key} = s.{key} AND " if key else ""
    calendar = f"SELECT {k}CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date FROM (SELECT {k}min(date) AS lo, max(date) AS hi FROM s {'GROUP BY ' + part if key else ''})"
    return f"""WITH s AS (SELECT {k}date, sum(tone) / sum(total) AS tone FROM {GOLD} GROUP BY {k}date), c AS ({calendar})
    SELECT {'c.' + k if key else ''}c.date, round(s.tone, 8) + 0.0 AS tone FROM c ASOF JOIN s ON {on}c.date >= s.date"""


@query("o3_industry_daily", _pad_daily_sql(None))
def o3(spark, sf):
    return N.daily_average(N.gold_rollup(news(spark, sf))).withColumn("tone", rnd("tone", 8))


@query("o3_organisation_daily", _pad_daily_sql("organisation"))
def o3_organisation(spark, sf):
    return N.daily_average(N.gold_rollup(news(spark, sf)), ["organisation"]).withColumn("tone", rnd("tone", 8))


MIN_DAYS, MIN_TOTAL = 180, 195
SCORES = f"""(SELECT o.organisation, o.theme, CAST(sum(o.total) AS BIGINT) AS total, CAST(count(*) AS BIGINT) AS days, avg(o.tone / o.total - i.tone) AS esg FROM {GOLD} o
      JOIN (SELECT date, theme, sum(tone) / sum(total) AS tone FROM {GOLD} GROUP BY 1, 2) i ON o.date = i.date AND o.theme = i.theme
      GROUP BY 1, 2 HAVING count(*) > {MIN_DAYS} AND sum(o.total) > {MIN_TOTAL})"""


def scores(spark, sf):
    """Few rows out of a rollup nearly as long as its input, so they are written by a job of sized shuffles."""
    mentions = news(spark, sf)
    return materialize(N.internal_scores(N.gold_rollup(mentions), MIN_DAYS, MIN_TOTAL), "scores", mentions.count())


@query("o4_internal_scores", f"SELECT organisation, theme, total, days, round(esg, 9) + 0.0 AS esg FROM {SCORES}")
def o4(spark, sf):
    return scores(spark, sf).withColumn("esg", rnd("esg", 9))
