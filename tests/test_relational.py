import pytest
from pyspark.sql import functions as F

from tallyspark.functions import scalars as S
from tallyspark.operators import aggregates as A
from tallyspark.operators import quantiles as Q
from tallyspark.operators import relational as R


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_one_hot_and_back(spark):
    df = spark.createDataFrame([(1, "CAN"), (2, "USA"), (3, None)], "id INT, Country STRING")
    flags = R.one_hot_flags(df, "Country")
    assert flags.columns == ["id", "Country_CAN", "Country_USA"]
    assert rows(flags) == [(1, True, False), (2, False, True), (3, False, False)]
    assert rows(flags.select("id", R.flag_to_label(["Country_CAN", "Country_USA"]))) == [(1, "CAN"), (2, "USA"), (3, None)]


def test_one_hot_refuses_many_values(spark):
    with pytest.raises(ValueError):
        R.distinct_values(spark.range(20).withColumnRenamed("id", "v"), "v", limit=5)


def test_canonical_names_takes_least_of_several(spark):
    names = spark.createDataFrame([("rbc wealth",), ("rbc",), ("citigroup inc",), ("other",), (None,)], "n STRING")
    aliases = spark.createDataFrame([("rbc ", "rbc"), ("citigroup", "citi"), ("citi", "zz")], "alias STRING, canonical STRING")
    assert rows(R.canonical_names(names, "n", aliases)) == [("citigroup inc", "citi"), ("other", "other"), ("rbc wealth", "rbc"), ("rbc", "rbc")]


def test_keep_one_groups_null_keys(spark):
    df = spark.createDataFrame([(None, 1, "a"), (None, 2, "b"), (5, 1, "c")], "k INT, o INT, v STRING")
    assert rows(R.keep_one(df, ["k"], [F.col("o")])) == [(5, 1, "c"), (None, 2, "b")]


def test_union_checked(spark):
    a, b = spark.range(1).toDF("x"), spark.range(1).toDF("y")
    with pytest.raises(ValueError):
        R.union_checked(a, b)


def test_trim_keeps_other_types(spark):
    df = spark.createDataFrame([(1, " a ", None)], "i INT, s STRING, t STRING")
    assert rows(R.trim_strings(df)) == [(1, "a", None)]


def test_sweep_and_append(spark):
    df = spark.createDataFrame([(1,)], "a INT")
    assert rows(R.sweep(df, "g", [1, 2])) == [(1, 1), (1, 2)]
    assert rows(R.append_by_name(df, spark.createDataFrame([(2, "n")], "a INT, b STRING"))) == [(1, None), (2, "n")]


def test_year_range_and_value_fallback(spark):
    df = spark.createDataFrame([("2012-2014", None, "3.5"), ("2012", 2.0, "x"), ("2013", None, "no data")], "y STRING, n DOUBLE, d STRING")
    got = rows(df.select(F.explode(S.year_range("y")).alias("y"), S.value_or_display("n", "d").alias("v")))
    assert got == [(2012, 2.0), (2012, 3.5), (2013, 3.5), (2013, None), (2014, 3.5)]


def test_prefix_classes(spark):
    df = spark.createDataFrame([(["ENV_A", "ECON_B", "ECON_C", "TAX"],), (["ENV_A"],), (None,)], "t ARRAY<STRING>")
    got = [r[0] for r in df.select(S.prefix_classes("t", {"ENV": "E", "ECON": "G", "UNGP": "S"}, "G")).collect()]
    assert got == [["E", "G"], [], []]


def test_pairs_maps_and_abbreviation(spark):
    df = spark.createDataFrame([(["a", "b", "a"], {"x": 7, "y": 4}, "s" * 40)], "a ARRAY<STRING>, m MAP<STRING,INT>, t STRING")
    r = df.select(F.size(S.ordered_pairs("a")), S.any_value_below("m", 5), S.any_value_below("m", 4), S.abbreviate("t"), S.weekday_sunday_zero(F.lit("2024-01-07").cast("date"))).first()
    assert tuple(r) == (4, True, False, "s" * 32 + "...", 0)


@pytest.mark.parametrize("values", [[1.0], [1.0, 2.0], [3.0, 1.0, 2.0, 2.0, 2.0, 10.0], list(map(float, range(1, 1001)))])
def test_exact_quantiles_match_percentile(spark, values):
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v DOUBLE")
    probs = [0.0, 0.05, 0.25, 0.5, 0.9, 1.0]
    want = df.select(F.percentile("v", F.array(*[F.lit(p) for p in probs]))).first()[0]
    got = {r["prob"]: r["value"] for r in Q.exact_quantiles(df, ["v"], probs).collect()}
    assert [got[p] for p in probs] == pytest.approx(want)


def test_exact_quantiles_hot_value_and_null_key(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 2 == 0, "a").alias("k"), F.when(F.col("id") % 3 == 0, 7.0).otherwise(F.col("id").cast("double")).alias("v"))
    want = {r["k"]: r["p"] for r in df.groupBy("k").agg(F.percentile("v", F.lit(0.3)).alias("p")).collect()}
    got = {r["k"]: r["value"] for r in Q.exact_quantiles(df, ["v"], [0.3], keys=["k"]).collect()}
    assert got == pytest.approx(want)


def test_quantile_labels_right_closed_and_ties(spark):
    df = spark.createDataFrame([(float(i),) for i in range(11)], "v DOUBLE")
    got = {r["v"]: r["c"] for r in Q.quantile_labels(df, "v", ["BBB", "BB", "A", "AA", "AAA"], "c").collect()}
    assert [got[float(i)] for i in (0, 2, 3, 4, 6, 8, 9, 10)] == ["BBB", "BBB", "BB", "BB", "A", "AA", "AAA", "AAA"]
    with pytest.raises(Exception, match="not unique"):
        Q.quantile_labels(spark.createDataFrame([(1.0,)] * 9 + [(2.0,)], "v DOUBLE"), "v", ["a", "b", "c"], "c").collect()


def test_histogram_top_edge_and_constant(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (9.99,), (10.0,), (None,)], "v DOUBLE")
    assert rows(Q.histogram(df, "v", 10)) == [(0, 1), (1, 1), (9, 2)]
    assert rows(Q.histogram(spark.createDataFrame([(3.0,), (3.0,)], "v DOUBLE"), "v", 10)) == [(0, 2)]


def test_min_max_constant_and_null(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0), (None, 5.0)], "a DOUBLE, b DOUBLE")
    assert rows(Q.min_max_scale(df, ["a", "b"])) == [(0.0, 0.0), (1.0, 0.0), (None, 0.0)]


def test_group_multiset_is_collect_list(spark):
    df = spark.createDataFrame([(None, "a"), (None, "a"), (1, "b"), (1, None)], "k INT, v STRING")
    assert rows(A.group_multiset(df, "k", "v")) == [(1, "b", 1), (None, "a", 2)]


def test_metrics_and_extremes(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (3.0, None)], "y DOUBLE, p DOUBLE")
    m = A.regression_metrics(df, "y", "p").first()
    assert (m["mae"], m["mse"]) == (1.5, 2.5) and m["rmse"] == pytest.approx(2.5**0.5)
    e = spark.createDataFrame([(1, 5.0), (2, 5.0), (3, 1.0), (4, None)], "id INT, s DOUBLE")
    assert rows(A.extremes(e, "s", "id")) == [("highest", 1, 5.0), ("lowest", 3, 1.0)]


def test_rollup_average_equals_raw_average(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (1, "b", 3.0), (1, "b", 5.0)], "d INT, o STRING, t DOUBLE")
    store = A.rollup_store(df, ["d", "o"], "t")
    assert rows(A.rollup_average(store, ["d"], "t")) == [(1, 3.0, 3)]


def test_random_choice_stays_in_list(spark):
    got = {r[0] for r in spark.range(200).select(S.random_choice(["a", "b"], 3)).collect()}
    assert got == {"a", "b"}
