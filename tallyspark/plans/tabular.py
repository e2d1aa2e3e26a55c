"""Indicator and tree-regression queries: nations and years of orders stand for countries and years."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import indicators as I
from ..operators import relational as R
from ..operators import timeseries as TS
from ..session import materialize
from ..sources.tables import table
from .registry import query, rnd

PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
FIRST, LAST = 1996, 2000


def raw_health(spark, sf):
    """orders ⋈ customer in the shape of published indicator rows."""
    customers = table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderpriority", "o_orderstatus", "o_orderdate", "o_totalprice")
    year, price = F.year("o_orderdate"), F.col("o_totalprice")
    sex = F.when(F.col("c_mktsegment") == "BUILDING", "BTSX").when(F.col("c_mktsegment") != "AUTOMOBILE", "MLE")
    return orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderpriority").alias("GHO (CODE)"), F.when(F.col("o_orderstatus") == "P", "VOID").otherwise("PUBLISHED").alias("PUBLISHSTATE (CODE)"),
        sex.alias("SEX (CODE)"), F.when(F.col("o_orderstatus") == "F", F.concat(year, F.lit("-"), year + 2)).otherwise(year.cast("string")).alias("YEAR (CODE)"),
        F.col("c_nationkey").cast("string").alias("COUNTRY (CODE)"), F.when(price > 100000, price).alias("Numeric"), F.round(price).cast("bigint").cast("string").alias("Display Value"),
    )


HEALTH = f"""(SELECT o_orderpriority AS gho, c_nationkey AS country, CAST(unnest(CASE WHEN o_orderstatus = 'F' THEN range(year(o_orderdate), year(o_orderdate) + 3) ELSE [year(o_orderdate)] END) AS INTEGER) AS year,
      CAST(CASE WHEN o_totalprice > 100000 THEN o_totalprice ELSE round(o_totalprice) END AS FLOAT)::DOUBLE AS value
      FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus <> 'P' AND c_mktsegment IN ('BUILDING', 'AUTOMOBILE'))"""


@query("r1_indicator_normalisation", "SELECT CAST(country AS VARCHAR) AS \"Country\", year AS \"Year\", " + ", ".join(f"avg(value) FILTER (gho = '{p}') AS \"{p}\"" for p in PRIORITIES)
       + f" FROM {HEALTH} WHERE year BETWEEN {FIRST} AND {LAST} GROUP BY 1, 2")
def r1(spark, sf):
    tall = I.normalise_health(raw_health(spark, sf), FIRST, LAST)
    # float values add up without error, so the averages are equal to the last bit and need no rounding
    return I.widen(tall.withColumn("Value", F.col("Value").cast("double")), "GHO", PRIORITIES)


@query("r1_supplementary_filters", """
    SELECT p_name AS code, CAST(count(*) AS BIGINT) AS n FROM part WHERE NOT starts_with(p_name, 'red') AND NOT ends_with(p_name, 'bolt') AND p_size BETWEEN 10 AND 40 GROUP BY 1""")
def r1_supplementary(spark, sf):
    # part names become codes with the prefixes and suffixes that the rules drop
    code = F.regexp_replace(F.regexp_replace("p_name", "^red", "PA.red"), "bolt$", "bolt.CN")
    raw = table(spark, sf, "part").select(F.lit("X").alias("Country ISO3"), F.col("p_size").alias("Year"), code.alias("Indicator Code"), F.col("p_retailprice").alias("Value"))
    return I.normalise_supplementary(raw, 10, 40).groupBy(F.col("Indicator").alias("code")).agg(F.count("*").alias("n"))


@query("r2_code_dictionary", """
    SELECT o_orderpriority AS "Code", 'priority ' || o_orderpriority AS "Description" FROM orders UNION SELECT p_type, 'type ' || p_type FROM part UNION SELECT c_mktsegment, 'segment ' || c_mktsegment FROM customer""")
def r2(spark, sf):
    def codes(name, column, word):
        return table(spark, sf, name).select(column, F.concat(F.lit(f"{word} "), column))

    return I.code_dictionary(codes("orders", "o_orderpriority", "priority"), codes("part", "p_type", "type"), codes("customer", "c_mktsegment", "segment"))


def _nation_year(spark, sf):
    customers = table(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").alias("Country"))
    orders = table(spark, sf, "orders").select("o_custkey", F.year("o_orderdate").alias("Year"), "o_orderstatus", "o_orderpriority", "o_totalprice")
    return orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))


def wide_input(spark, sf):
    base = _nation_year(spark, sf)
    price = F.col("o_totalprice")
    a = base.groupBy("Country", "Year").agg(F.avg(price).alias("target"), F.count("*").alias("n"))
    b = base.where((F.col("o_orderstatus") == "F") & (price > 490000)).groupBy("Country", "Year").agg(F.max(price).alias("f_top"))
    c = base.where((F.col("o_orderpriority") == "1-URGENT") & (price > 480000)).groupBy("Country", "Year").agg(F.count("*").alias("urgent"))
    return I.join_wide(a, b, c)


WIDE = """(SELECT c_nationkey AS "Country", CAST(year(o_orderdate) AS INTEGER) AS "Year", avg(o_totalprice) AS target, CAST(count(*) AS BIGINT) AS n,
      max(o_totalprice) FILTER (o_orderstatus = 'F' AND o_totalprice > 490000) AS f_top, CAST(nullif(count(*) FILTER (o_orderpriority = '1-URGENT' AND o_totalprice > 480000), 0) AS BIGINT) AS urgent
      FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)"""


@query("r3_three_way_join", f'SELECT "Country", "Year", round(target, 5) + 0.0 AS target, n, f_top, urgent FROM {WIDE}')
def r3(spark, sf):
    return wide_input(spark, sf).withColumn("target", rnd("target", 5))


def _fill(c):
    return f"""coalesce(last_value({c} IGNORE NULLS) OVER (PARTITION BY "Country" ORDER BY "Year" ROWS UNBOUNDED PRECEDING),
      first_value({c} IGNORE NULLS) OVER (PARTITION BY "Country" ORDER BY "Year" ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS {c}"""


@query("r4_imputation", f'SELECT "Country", "Year", n, {_fill("f_top")}, urgent FROM {WIDE}')
def r4(spark, sf):
    return TS.fill_forward_back(wide_input(spark, sf).drop("target"), "Country", "Year", exclude=["urgent"])


@query("r5_feature_table", f'SELECT "Year", n, {_fill("f_top")}, ' + ", ".join(f'"Country" = {i} AS "Country_{i}"' for i in range(25)) + f" FROM {WIDE}")
def r5(spark, sf):
    filled = TS.fill_forward_back(wide_input(spark, sf).drop("target", "urgent"), "Country", "Year")
    return R.one_hot_flags(filled, "Country", list(range(25)))


FEATURES = ["n", "urgent", "mean_price", "c_acctbal", "c_nationkey"]


def _behaviour(spark, sf):
    """One row per customer and year with orders: number, urgent ones, mean price and spend of that year."""
    orders = table(spark, sf, "orders").select("o_custkey", F.year("o_orderdate").alias("Year"), "o_orderpriority", "o_totalprice")
    return orders.groupBy("o_custkey", "Year").agg(
        F.count("*").cast("double").alias("n"), F.count_if(F.col("o_orderpriority") == "1-URGENT").cast("double").alias("urgent"),
        F.avg("o_totalprice").alias("mean_price"), F.sum("o_totalprice").alias("spend"),
    )


def _with_customers(per, spark, sf):
    customers = table(spark, sf, "customer").select("c_custkey", "c_acctbal", F.col("c_nationkey").cast("double").alias("c_nationkey"))
    return per.join(customers, F.col("o_custkey") == F.col("c_custkey")).drop("c_custkey")


def customer_years(spark, sf):
    """One row per customer and year: this year's behaviour next to this year's spend."""
    return _with_customers(_behaviour(spark, sf), spark, sf)


def customer_years_ahead(spark, sf):
    """One row per customer and year: last year's behaviour next to this year's spend.

    A year without orders is behaviour too: no orders, none urgent, mean price 0. The first year of the table has no year
    before it and only tells of the next.
    """
    per, before = _behaviour(spark, sf), Window.partitionBy("o_custkey").orderBy("Year")
    first = table(spark, sf, "orders").agg(F.min(F.year("o_orderdate"))).scalar()
    ordered = F.lag("Year").over(before) == F.col("Year") - 1
    moved = per.select("o_custkey", "Year", *[F.when(ordered, F.lag(c).over(before)).otherwise(0.0).alias(c) for c in ("n", "urgent", "mean_price")], "spend")
    return _with_customers(moved.where(F.col("Year") > first), spark, sf)


def _model(spark, sf):
    rows = materialize(customer_years(spark, sf), "customer_years")
    train, unseen = rows.where("Year <= 1999"), rows.where("Year > 1999")
    return I.fit_trees(train, FEATURES, "spend", F.col("Year") == 1999), train, unseen


@query("r6_boosted_trees")
def r6(spark, sf):
    model, _, unseen = _model(spark, sf)
    scored = model.transform(I.assemble(unseen, FEATURES))
    return scored.groupBy("Year").agg(F.sqrt(F.avg(F.pow(F.col("prediction") - F.col("spend"), 2))).alias("rmse"), F.count("*").alias("n"))


def _search(spark, sf):
    """The last year before the unseen ones is held out; the unseen years take no part. Features are those of the year before."""
    train = materialize(customer_years_ahead(spark, sf), "customer_years").where("Year <= 1999")
    return I.search_trees(train, FEATURES, "spend", F.col("Year") == 1999)


@query("r7_tree_search")
def r7(spark, sf):
    return _search(spark, sf)[1]


@query("r7_best_tree_trial")
def r7_best(spark, sf):
    return I.best_tree_trial(_search(spark, sf)[1])


@query("r8_permutation_importance")
def r8(spark, sf):
    model, _, unseen = _model(spark, sf)
    return I.permutation_importance(model, unseen, FEATURES, "spend")


@query("r8_group_contrast", """
    WITH r AS (SELECT o_custkey, year(o_orderdate) AS y, count(*) AS n, avg(o_totalprice) AS mean_price, any_value(c_nationkey) AS k, any_value(c_acctbal) AS c_acctbal FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)
    SELECT feature, round(contrast, 6) + 0.0 AS contrast FROM (SELECT avg(n) FILTER (k = 7) - avg(n) FILTER (k <> 7) AS n, avg(mean_price) FILTER (k = 7) - avg(mean_price) FILTER (k <> 7) AS mean_price,
      avg(c_acctbal) FILTER (k = 7) - avg(c_acctbal) FILTER (k <> 7) AS c_acctbal FROM r) UNPIVOT (contrast FOR feature IN (n, mean_price, c_acctbal))""")
def r8_contrast(spark, sf):
    rows = customer_years(spark, sf)
    return I.group_contrast(rows, ["n", "mean_price", "c_acctbal"], F.col("c_nationkey") == 7).withColumn("contrast", rnd("contrast", 6))


@query("r9_score_unseen_years")
def r9(spark, sf):
    model, train, unseen = _model(spark, sf)
    return I.score_unseen(model, train, unseen, FEATURES, "spend", ["o_custkey", "Year"])


@query("r10_what_if_sweep")
def r10(spark, sf):
    model, _, unseen = _model(spark, sf)
    return I.what_if(model, unseen, FEATURES, "n", [1, 2, 3, 5, 8], "Year", [2000, 2001])
