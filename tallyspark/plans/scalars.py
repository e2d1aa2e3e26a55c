"""Scalar functions over the given tables."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..functions import text as X
from ..operators import relational as R
from ..sources.tables import stream_table, table  # noqa: F401
from .registry import query, rnd


@query("h1_date_parts", """
    SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, CAST(date_trunc('month', o_orderdate) AS DATE) AS month_start, CAST(year(o_orderdate) AS INTEGER) AS y,
      CAST(month(o_orderdate) AS INTEGER) AS m, strftime(o_orderdate, '%a') AS dow FROM orders""")
def h1(spark, sf):
    d = F.col("o_orderdate")
    return table(spark, sf, "orders").select(
        "o_orderkey", F.to_date(d).alias("day"), F.trunc(d, "month").alias("month_start"), F.year(d).alias("y"), F.month(d).alias("m"), F.date_format(d, "E").alias("dow")
    )


@query("h1_hour_label", "SELECT event_id, strftime(ts, '%-H:%M') AS hour FROM events")
def h1_hour(spark, sf):
    return table(spark, sf, "events").select("event_id", F.date_format("ts", "H:mm").alias("hour"))


@query("h2_date_arithmetic", """
    SELECT l_orderkey, l_linenumber, l_partkey, CAST(datediff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS INTEGER) AS lag_days, CAST(o_orderdate AS DATE) - l_linenumber AS before
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey""")
def h2(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
    return o.join(lines, F.col("o_orderkey") == F.col("l_orderkey")).select(
        "l_orderkey", "l_linenumber", "l_partkey", F.datediff("l_shipdate", "o_orderdate").alias("lag_days"),
        F.date_sub(F.to_date("o_orderdate"), F.col("l_linenumber")).alias("before"),
    )


@query("h2_clock_stamps")
def h2_clock(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", F.current_date().alias("training_date"), F.current_timestamp().alias("loaded_at"))


@query("h3_year_month_label", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS label FROM orders")
def h3(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", S.year_month("o_orderdate").alias("label"))


@query("h4_string_basics", """
    SELECT p_partkey, lower(p_brand) AS lo, trim('  ' || p_name || ' ') AS tr, CAST(length(p_name) AS INTEGER) AS len, p_type || '-' || p_size AS tag,
      string_split(p_name, ' ')[2] AS second_word, starts_with(p_name, 'red') AS is_red FROM part""")
def h4(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey", F.lower("p_brand").alias("lo"), F.trim(F.concat(F.lit("  "), "p_name", F.lit(" "))).alias("tr"), F.length("p_name").alias("len"),
        F.concat("p_type", F.lit("-"), "p_size").alias("tag"), F.get(F.split("p_name", " "), 1).alias("second_word"), F.col("p_name").startswith("red").alias("is_red"),
    )


# RE2 on the SQL side takes the same patterns; its default "." and anchors agree on single lines
def _step_sql(pattern, replacement, source="replace(text, chr(10), ' ')"):
    return f"regexp_replace({source}, '{pattern}', '{replacement.replace('$', chr(92))}', 'g')"


for _name, _pattern, _replacement in X.CLEANING_STEPS:
    query(f"h5_clean_{_name}", f"SELECT doc_id, md5({_step_sql(_pattern, _replacement)}) AS cleaned FROM documents")(
        lambda spark, sf, name=_name: table(spark, sf, "documents").select(
            "doc_id", F.md5(X.clean_step(F.regexp_replace("text", "\n", " "), name)).alias("cleaned")
        )
    )


@query("h6_printable_ascii", r"SELECT doc_id, md5(regexp_replace(text, '[^\x20-\x7E\t\n\r\x0B\x0C]', '', 'g')) AS ascii FROM documents")
def h6(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.md5(S.printable_ascii("text")).alias("ascii"))


@query("h7_from_json_flatten", "SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events")
def h7(spark, sf):
    parsed = table(spark, sf, "events").select("event_id", F.from_json("props", "k INT").alias("fields"))
    return parsed.select("event_id", "fields.*")


@query("h8_casts", "SELECT event_id, CAST(value AS FLOAT) AS f, CAST(trunc(value) AS INTEGER) AS i, props AS body FROM events")
def h8(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", F.col("value").cast("float").alias("f"), F.col("value").cast("int").alias("i"), F.col("props").cast("binary").cast("string").alias("body")
    )


@query("h9_array_functions", """
    SELECT p_partkey, CAST(len(w) AS INTEGER) AS size, w[1] AS first_word, CAST(len(list_distinct(list_concat(w, w))) AS INTEGER) AS distinct_words,
      array_to_string(list_filter(w, lambda x: length(x) > 4), ',') AS long_words FROM (SELECT p_partkey, string_split(p_name, ' ') AS w FROM part)""")
def h9(spark, sf):
    w = F.split("p_name", " ")
    return table(spark, sf, "part").select(
        "p_partkey", F.size(w).alias("size"), w[0].alias("first_word"), F.size(F.array_distinct(F.concat(w, w))).alias("distinct_words"),
        F.array_join(F.filter(w, lambda x: F.length(x) > 4), ",").alias("long_words"),
    )


@query("h9_explode", "SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part")
def h9_explode(spark, sf):
    return table(spark, sf, "part").select("p_partkey", F.explode(F.split("p_name", " ")).alias("word"))


# theme classes by first word (fixed values of this binding: words of part names stand for theme prefixes)
WORD_CLASSES = {"red": "E", "hot": "E", "small": "G", "blue": "G", "widget": "S", "bolt": "S", "gear": "S"}


@query("h10_prefix_classes", """
    SELECT p_partkey, CASE WHEN list_contains(c, 'G') THEN array_to_string(list_sort(list_distinct(c)), ',') ELSE '' END AS classes FROM (
      SELECT p_partkey, list_filter(list_transform(string_split(p_name, ' '), lambda w: CASE w WHEN 'red' THEN 'E' WHEN 'hot' THEN 'E' WHEN 'small' THEN 'G' WHEN 'blue' THEN 'G'
        WHEN 'widget' THEN 'S' WHEN 'bolt' THEN 'S' WHEN 'gear' THEN 'S' END), lambda x: x IS NOT NULL) AS c FROM part)""")
def h10(spark, sf):
    tags = F.transform(F.split("p_name", " "), lambda w: F.concat(w, F.lit("_X")))
    return table(spark, sf, "part").select("p_partkey", F.array_join(F.array_sort(S.prefix_classes(tags, WORD_CLASSES, "G")), ",").alias("classes"))


@query("h11_ordered_pairs", """
    WITH w AS (SELECT p_partkey, unnest(list_concat(string_split(p_name, ' '), [p_type])) AS t FROM part)
    SELECT a.p_partkey, a.t AS src, b.t AS dst FROM w a JOIN w b ON a.p_partkey = b.p_partkey AND a.t <> b.t""")
def h11(spark, sf):
    words = F.concat(F.split("p_name", " "), F.array("p_type"))
    pairs = table(spark, sf, "part").select("p_partkey", F.explode(S.ordered_pairs(words)).alias("p"))
    return pairs.select("p_partkey", "p.src", "p.dst")


@query("h12_map_any_below", "SELECT l_orderkey, l_linenumber, l_partkey, (l_quantity < 5 OR l_linenumber < 2) AS near FROM lineitem")
def h12(spark, sf):
    distances = F.create_map(F.lit("a"), F.col("l_quantity").cast("int"), F.lit("b"), F.when(F.col("l_linenumber") < 2, 1).otherwise(9))
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", S.any_value_below(distances, 5).alias("near"))


@query("h13_arithmetic", """
    SELECT o_orderkey, round(ln(o_totalprice), 8) + 0.0 AS ln, round(sqrt(o_totalprice), 8) + 0.0 AS sqrt, abs(o_custkey - 500) AS abs, o_custkey % 7 AS rest FROM orders""")
def h13(spark, sf):
    price = F.col("o_totalprice")
    return table(spark, sf, "orders").select(
        "o_orderkey", rnd(F.ln(price), 8).alias("ln"), rnd(F.sqrt(price), 8).alias("sqrt"), F.abs(F.col("o_custkey") - 500).alias("abs"), (F.col("o_custkey") % 7).alias("rest")
    )


@query("h14_conditionals", """
    SELECT o_orderkey, coalesce(CASE o_orderstatus WHEN 'F' THEN 'done' WHEN 'O' THEN 'open' END, 'other') AS state FROM orders""")
def h14(spark, sf):
    state = F.when(F.col("o_orderstatus") == "F", "done").when(F.col("o_orderstatus") == "O", "open")
    return table(spark, sf, "orders").select("o_orderkey", F.coalesce(state, F.lit("other")).alias("state"))


@query("h15_abbreviate", "SELECT doc_id, CASE WHEN length(text) < 32 THEN text ELSE substring(text, 1, 32) || '...' END AS short FROM documents")
def h15(spark, sf):
    return table(spark, sf, "documents").select("doc_id", S.abbreviate("text").alias("short"))


@query("h16_random_choice", "SELECT DISTINCT c_mktsegment AS option, true AS about_even FROM customer")
def h16(spark, sf):
    """Every option is chosen about equally often: within five standard deviations of its share."""
    segments = [r[0] for r in table(spark, sf, "customer").select("c_mktsegment").distinct().orderBy("c_mktsegment").collect()]  # a handful
    chosen = table(spark, sf, "orders").select(S.random_choice(segments, 11).alias("option"))
    counts = chosen.groupBy("option").agg(F.count("*").alias("n"))
    total, share = chosen.agg(F.count("*")).scalar(), 1 / len(segments)
    return counts.select("option", (F.abs(F.col("n") - total * share) <= 5 * F.sqrt(total * share * (1 - share))).alias("about_even"))


@query("j1_row_functions_as_expressions", """
    SELECT l_suppkey, CAST(l_shipdate AS DATE) AS day, round(ln(max(l_extendedprice) / min(l_extendedprice)), 8) + 0.0 AS spread FROM lineitem GROUP BY 1, 2""")
def j1(spark, sf):
    g = table(spark, sf, "lineitem").groupBy("l_suppkey", F.to_date("l_shipdate").alias("day"))
    return g.agg(F.min("l_extendedprice").alias("lo"), F.max("l_extendedprice").alias("hi")).select("l_suppkey", "day", rnd(S.log_return("lo", "hi"), 8).alias("spread"))


@query("j2_iterator_udf", "SELECT doc_id, md5(strip_accents(text)) AS plain FROM documents")
def j2(spark, sf):
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import unicodedata

        class Plain(dict):
            """What a letter is without its accents; filled once per partition, used for every batch."""

            def __missing__(self, code: int) -> str:
                letters = "".join(c for c in unicodedata.normalize("NFD", chr(code)) if not unicodedata.combining(c))
                self[code] = letters
                return letters

        plain = Plain()
        for batch in batches:
            yield batch.map(lambda text: None if text is None else unicodedata.normalize("NFC", text.translate(plain)))

    return table(spark, sf, "documents").select("doc_id", F.md5(F.pandas_udf(run, "string")("text")).alias("plain"))


@query("j5_array_functions", """
    SELECT doc_id, CAST(len(list_distinct(list_filter(string_split(text, ' '), lambda w: length(w) > 5))) AS INTEGER) AS long_words FROM documents""")
def j5(spark, sf):
    words = F.filter(F.split("text", " "), lambda w: F.length(w) > 5)
    return table(spark, sf, "documents").select("doc_id", F.size(F.array_distinct(words)).alias("long_words"))
