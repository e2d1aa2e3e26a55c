import datetime as dt

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tallyspark.functions import text as X
from tallyspark.operators import forecast as P
from tallyspark.operators import indicators as I
from tallyspark.operators import topics as Z
from tallyspark.plans import tabular
from tallyspark.plans import topics as plans_topics


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_forecast_recovers_trend_and_week():
    days = np.arange(0.0, 900.0)
    y = (100 + 0.1 * days) * (1 + 0.2 * np.sin(2 * np.pi * days / 7) + 0.1 * np.cos(2 * np.pi * days / 365.25))
    future = np.concatenate([days, days[-1] + np.arange(1, 91)])
    got = P.fit_series(days, y, future)
    want = (100 + 0.1 * future) * (1 + 0.2 * np.sin(2 * np.pi * future / 7) + 0.1 * np.cos(2 * np.pi * future / 365.25))
    assert np.abs(got["yhat"] / want - 1).max() < 0.05
    assert np.all(got["yhat_upper"] >= got["yhat"]) and np.all(got["yhat_lower"] <= got["yhat"])


def test_forecast_groups_shape_and_short_series(spark):
    df = spark.createDataFrame([("a", "2024-01-01", 1.0), ("a", "2024-01-03", 2.0), ("b", "2024-01-01", 5.0), ("b", None, 5.0)], "s STRING, d STRING, q DOUBLE").withColumn("d", F.to_date("d"))
    out = P.forecast_groups(P.sales_history(df, ["s"], "d", "q"), ["s"], 5)
    assert {r["s"]: r["n"] for r in out.groupBy("s").agg(F.count("*").alias("n")).collect()} == {"a": 7, "b": 6}
    assert out.where("y IS NULL").count() == 10 and str(out.agg(F.max("ds")).first()[0]) == "2024-01-08"


def test_statement_rules(spark):
    text = "12 Our plan for re - use .\nIt was writ-\nten  down , see www.example.com for 1234567 more\n and on. Next one... here"
    got = spark.createDataFrame([(text,)], "t STRING").select(X.statements("t")).first()[0]
    assert got == ["Our plan for re-use.", "It was writ-ten down, see for more and on.", "Next one. here"]
    dash = spark.createDataFrame([("End.\n- item",)], "t STRING")
    assert len(dash.select(X.join_broken_lines("t")).first()[0]) == 2 and len(dash.select(X.join_broken_lines("t", True)).first()[0]) == 1


def test_lemma_and_stop_words(spark):
    r = spark.createDataFrame([("Investments are growing quickly, a x",)], "t STRING").select(X.lemma("t")).first()[0]
    assert r == "invest grow quick"
    companies = spark.createDataFrame([("Goldman Sachs",), ("Goldman Sachs",)], "c STRING")
    words = {r[0] for r in Z.stop_words(companies, "c").collect()}
    assert {"goldman", "sachs", "plc", "the"} <= words


def test_focus_score(spark):
    deciles = spark.createDataFrame([("t", i / 10, float(i)) for i in range(1, 10)], "topic STRING, prob DOUBLE, value DOUBLE")
    counts = spark.createDataFrame([("a", "t", 0), ("b", "t", 1), ("c", "t", 4), ("d", "t", 99)], "company STRING, topic STRING, n INT")
    assert {r["company"]: r["score"] for r in Z.focus_score(counts, deciles).collect()} == {"a": 10, "b": 10, "c": 30, "d": 90}


def test_topic_distances_bounds(spark):
    w = spark.createDataFrame([("x", "a", 1.0), ("y", "b", 1.0), ("z", "a", 5.0)], "topic STRING, term STRING, w DOUBLE")
    got = {(r["x"], r["y"]): r["distance"] for r in Z.topic_distances(w, "topic", "term", "w", ["x", "y", "z"]).collect()}
    assert got[("x", "z")] == 0 and got[("x", "y")] == pytest.approx(np.sqrt(np.log(2)))


def test_health_rules(spark):
    names = ["GHO (CODE)", "PUBLISHSTATE (CODE)", "SEX (CODE)", "YEAR (CODE)", "COUNTRY (CODE)", "Numeric", "Display Value"]
    data = [
        ("A", "PUBLISHED", None, "1999-2001", "CAN", 4.0, "x"), ("A", "PUBLISHED", "BTSX", "2001", "CAN", None, "6.0"), ("A", "PUBLISHED", "MLE", "2001", "CAN", 9.0, "9"),
        ("A", "VOID", None, "2001", "CAN", 9.0, "9"), ("WHOSIS_000015", "PUBLISHED", None, "2001", "CAN", 9.0, "9"),
    ]
    raw = spark.createDataFrame(data, "a STRING, b STRING, c STRING, d STRING, e STRING, f DOUBLE, g STRING").toDF(*names)
    wide = I.widen(I.normalise_health(raw), "GHO", ["A", "B"])
    assert rows(wide) == [("CAN", 2000, 4.0, None), ("CAN", 2001, 5.0, None)]


def test_indicator_code_rules(spark):
    codes = ["NY.GDP", "SP.DYN.LE00", "X.FE", "X.MA.Y", "NY.CN", "PA.X", "PX.Y", "SP.POP"]
    df = spark.createDataFrame([(c,) for c in codes], "`Indicator Code` STRING")
    assert [r[0] for r in df.where(I.keep_indicator()).collect()] == ["NY.GDP", "SP.POP"]


def test_trees_learn_and_importance_finds_the_signal(spark):
    df = spark.range(600).select((F.rand(1) * 10).alias("a"), F.rand(2).alias("b"), F.col("id")).withColumn("y", F.col("a") * 3).cache()
    model = I.fit_trees(df, ["a", "b"], "y", F.col("id") % 5 == 0, maxIter=10)
    rise = {r["feature"]: r["rise"] for r in I.permutation_importance(model, df, ["a", "b"], "y").collect()}
    assert rise["a"] > 10 * abs(rise["b"])
    out = I.what_if(model, df.withColumn("g", F.lit(1)), ["a", "b"], "a", [1.0, 9.0], "g", [1]).orderBy("a").collect()
    assert out[0]["1"] < out[1]["1"]
    assert I.score_unseen(model, df.where("id < 10"), df.where("id >= 590"), ["a", "b"], "y", ["id"]).groupBy("predicted").count().count() == 2
    twins = df.select(F.lit(1.0).alias("a"), F.col("b"), (F.col("id") % 2).cast("double").alias("y"))
    assert all(abs(r["rise"]) < 1e-9 for r in I.permutation_importance(Sum(), twins.limit(1), ["a", "b"], "y").collect())


class Sum:
    """Stands for a fitted model: predicts twice the first feature."""

    def transform(self, frame):
        return frame.withColumn("prediction", 2 * vector_to_array("features")[0])


def test_importance_of_a_linear_model(spark):
    # every row takes another one's value: the mean rise is 2 * variance * slope squared
    df = spark.range(4000).select(F.rand(3).alias("a"), F.lit(5.0).alias("b")).withColumn("y", 2 * F.col("a")).cache()
    rise = {r["feature"]: r["rise"] for r in I.permutation_importance(Sum(), df, ["a", "b"], "y").collect()}
    assert rise["b"] == 0 and rise["a"] == pytest.approx(2 * 4 / 12, rel=0.1)
    # two kinds of rows, equal ones next to each other or not: each row takes its value from another row
    two = spark.range(2).select(F.col("id").cast("double").alias("a"), F.lit(1.0).alias("b")).withColumn("y", 2 * F.col("a"))
    assert {r["feature"]: r["rise"] for r in I.permutation_importance(Sum(), two, ["a", "b"], "y").collect()} == {"a": 4.0, "b": 0.0}


def test_falling_and_negative_series_keep_their_trend():
    days = np.arange(18000.0, 18100.0)
    for y in (50 - np.arange(100.0), -5 - 0.1 * np.arange(100.0)):
        got = P.fit_series(days, y, days)
        assert np.abs(got["yhat"] - y).max() < 1e-6


def test_tree_search_reads_last_years_behaviour(spark, tmp_path, monkeypatch):
    sf = str(tmp_path)
    orders = [(1, dt.datetime(1996, 3, 1), "1-URGENT", 10.0), (1, dt.datetime(1996, 5, 1), "5-LOW", 30.0), (1, dt.datetime(1997, 2, 1), "5-LOW", 7.0),
              (1, dt.datetime(1999, 2, 1), "1-URGENT", 5.0), (2, dt.datetime(1999, 4, 1), "5-LOW", 9.0), (None, dt.datetime(1997, 4, 1), "5-LOW", 9.0), (2, None, "5-LOW", 9.0)]
    spark.createDataFrame(orders, "o_custkey LONG, o_orderdate TIMESTAMP, o_orderpriority STRING, o_totalprice DOUBLE").write.parquet(f"{sf}/orders.parquet")
    spark.createDataFrame([(1, 100.0, 7), (2, 200.0, 8)], "c_custkey LONG, c_acctbal DOUBLE, c_nationkey INT").write.parquet(f"{sf}/customer.parquet")
    seen = []

    def search(df, features, *_):
        seen.extend(tuple(r) for r in df.select("o_custkey", "Year", "spend", *features).collect())
        return None, df

    monkeypatch.setattr(tabular.I, "search_trees", search)
    tabular.r7(spark, sf)
    # the year before, without orders where there were none; 1996 is the first and has no year before it
    assert sorted(seen) == [(1, 1997, 7.0, 2.0, 1.0, 20.0, 100.0, 7.0), (1, 1999, 5.0, 0.0, 0.0, 0.0, 100.0, 7.0), (2, 1999, 9.0, 0.0, 0.0, 0.0, 200.0, 8.0)]


def test_lemmas_are_built_once_and_as_word_by_word(spark, tmp_path, monkeypatch):
    ends = ["", "s", "es", "ed", "ings", "ational", "ation", "ations", "fulness", "ously", "ousness", "ies", "est", "ment", "ments", "ement", "ers", "ly", "ive", "iveness", "ization"]
    words = [w + e for w in ("a", "no", "cat", "größ", "ärger", "relat", "\U0001d49cbc", "кот", "x1yz") for e in ends]
    text = " ".join(words) + ". " + ", ".join(reversed(words)) + "-end's"
    docs = spark.createDataFrame([(1, "s", text), (2, "s", None), (3, "s", "Short."), (3, "s", text)], "doc_id LONG, source STRING, text STRING").coalesce(1)
    by_word = F.array_join(F.filter(F.transform(X.tokens("text"), X.stem), lambda w: F.length(w) >= 4), " ")
    assert docs.where(~X.lemma("text").eqNullSafe(by_word)).count() == 0 and docs.where(X.lemma("text").contains("relat")).count() == 2
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    plans = []
    monkeypatch.setattr(plans_topics, "materialize", lambda df, label: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or df)
    rows = plans_topics._lemmas(spark, str(tmp_path)).collect()
    assert [r["doc_id"] for r in rows].count(1) == [r["doc_id"] for r in rows].count(3) > 0
    assert plans[0].count("(?:ness)") == X._SUFFIX.count("(?:ness)")
