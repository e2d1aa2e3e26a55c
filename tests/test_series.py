import datetime as dt

import pytest

from tallyspark.operators import timeseries as TS


def d(text):
    return dt.date.fromisoformat(text)


def frame(spark, data):
    return spark.createDataFrame([(k, d(day), v) for k, day, v in data], "k STRING, day DATE, v DOUBLE")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple(map(str, r)))


def test_pad_repeats_rows_and_keeps_nulls(spark):
    df = frame(spark, [("a", "2024-01-05", 1.0), ("a", "2024-01-08", None), ("a", "2024-01-10", 3.0), ("b", "2024-01-01", 9.0)])
    got = rows(TS.densify_pad(df, ["k"], "day"))
    assert [(k, str(x), v) for k, x, v in got] == [
        ("a", "2024-01-05", 1.0), ("a", "2024-01-06", 1.0), ("a", "2024-01-07", 1.0), ("a", "2024-01-08", None), ("a", "2024-01-09", None), ("a", "2024-01-10", 3.0),
        ("b", "2024-01-01", 9.0),
    ]


def test_pad_weekdays_matches_pandas(spark):
    import pandas as pd

    days = ["2024-01-06", "2024-01-09", "2024-01-13", "2024-01-16", "2024-01-20"]
    got = rows(TS.densify_pad(frame(spark, [("a", x, float(i)) for i, x in enumerate(days)]), ["k"], "day", business_days=True))
    s = pd.Series([float(i) for i in range(5)], index=pd.to_datetime(days)).asfreq("B", method="pad")
    assert [(x, v) for _, x, v in got] == [(i.date(), v) for i, v in s.items()]


def test_returns_skip_nulls_and_start_at_zero(spark):
    df = frame(spark, [("a", "2024-01-01", 1.0), ("a", "2024-01-02", None), ("a", "2024-01-03", 2.0)])
    got = rows(TS.log_returns(df, "k", "day", "v"))
    assert got[0][3] == 0.0 and got[1][3] == pytest.approx(0.693147, abs=1e-6) and len(got) == 2


def test_rolling_mean_needs_full_frame(spark):
    df = frame(spark, [("a", f"2024-01-0{i}", float(i) if i != 3 else None) for i in range(1, 7)])
    assert [r[3] for r in rows(TS.rolling_mean(df, "k", "day", "v", 2, "m"))] == [None, 1.5, None, None, 4.5, 5.5]


def test_fill_forward_then_back(spark):
    df = frame(spark, [("a", "2024-01-01", None), ("a", "2024-01-02", 2.0), ("a", "2024-01-03", None), ("b", "2024-01-01", None)])
    assert [r[2] for r in rows(TS.fill_forward_back(df, "k", "day"))] == [2.0, 2.0, 2.0, None]
    assert [r[2] for r in rows(TS.fill_forward_back(df, "k", "day", exclude=["v"]))] == [None, 2.0, None, None]


def test_average_gap_equals_search_for_next_day(spark):
    from pyspark.sql import functions as F

    df = frame(spark, [("a", "2024-01-01", 1.0), ("a", "2024-01-01", 1.0), ("a", "2024-01-04", 1.0), ("a", "2024-01-10", 1.0), ("b", "2024-01-01", 1.0)])
    days = df.select("k", "day").distinct()
    pairs = TS.next_event(days, "k", "day", "next").groupBy("k").agg(F.avg(F.datediff("next", "day")).alias("g"))
    joined = days.alias("x").join(days.alias("y"), F.expr("x.k = y.k AND x.day < y.day")).groupBy("x.k", "x.day").agg(F.min("y.day").alias("n"))
    theta = joined.groupBy("k").agg(F.avg(F.datediff("n", "day")).alias("g"))
    assert rows(TS.average_gap(df, "k", F.col("day"))) == rows(pairs) == rows(theta) == [("a", 4.5)]


def test_empty_series(spark):
    df = spark.createDataFrame([], "k STRING, day DATE, v DOUBLE")
    assert rows(TS.densify_pad(df, ["k"], "day")) == [] and rows(TS.log_returns(df, "k", "day", "v")) == []
