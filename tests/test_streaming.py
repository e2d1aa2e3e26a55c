import datetime as dt

from pyspark.sql import functions as F

from tallyspark.operators import mutate as M
from tallyspark.session import scratch
from tallyspark.sources.incremental import file_stream
from tallyspark.streaming import medallion as S

SCHEMA = "device STRING, ts TIMESTAMP, v DOUBLE"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def put(spark, path, data):
    spark.createDataFrame([(d, dt.datetime.fromisoformat(t), v) for d, t, v in data], SCHEMA).coalesce(1).write.mode("append").parquet(path)


def test_upsert_across_batches_and_replay(spark):
    source, log, progress = (scratch(spark, x) for x in ("src", "log", "progress"))
    sink = lambda: S.drain(S.upsert_sink(file_stream(spark, source, "parquet", SCHEMA, 1), log, progress, ["device"], [F.col("ts")]))
    put(spark, source, [("a", "2024-01-01T00:00", 1.0), ("a", "2024-01-01T01:00", 2.0), ("b", "2024-01-01T00:00", 5.0)])
    sink()
    assert [r[2] for r in rows(S.current_rows(spark, log, ["device"]))] == [2.0, 5.0]
    put(spark, source, [("a", "2024-01-02T00:00", 7.0), ("c", "2024-01-02T00:00", 8.0)])
    sink()
    first = rows(S.current_rows(spark, log, ["device"]))
    assert [r[2] for r in first] == [7.0, 5.0, 8.0]
    sink()  # nothing new
    assert rows(S.current_rows(spark, log, ["device"])) == first
    assert M.history(S.read_log(spark, log)).count() == 2


def test_windowed_stream_equals_batch(spark):
    source, log = scratch(spark, "src"), scratch(spark, "log")
    for day in (1, 2):
        put(spark, source, [("a", f"2024-01-0{day}T00:10", 1.0 * day), ("a", f"2024-01-0{day}T00:50", 3.0), ("b", f"2024-01-0{day}T05:00", 2.0), ("a", "2024-01-01T00:20", 8.0)])
    stream = S.event_time(file_stream(spark, source, "parquet", SCHEMA, 1), "ts", "7 days")
    means = S.windowed(stream, "ts", "1 hour", ["device"], v=F.avg("v"), n=F.count("*"))
    S.drain(S.upsert_sink(means, log, scratch(spark, "progress"), ["window", "device"], [F.col("window")], mode="update"))
    batch = S.windowed(spark.read.parquet(source), "ts", "1 hour", ["device"], v=F.avg("v"), n=F.count("*"))
    assert rows(S.current_rows(spark, log, ["window", "device"])) == rows(batch)


def test_watermark_drops_late_rows_after_the_window_closed(spark):
    source, out = scratch(spark, "src"), scratch(spark, "out")
    put(spark, source, [("a", "2024-01-01T00:10", 1.0)])
    put(spark, source, [("a", "2024-01-03T00:10", 1.0)])
    put(spark, source, [("a", "2024-01-05T00:10", 1.0)])  # its batch closes the first window
    put(spark, source, [("a", "2024-01-01T00:20", 1.0), ("a", "2024-01-07T00:00", 1.0)])
    stream = S.event_time(file_stream(spark, source, "parquet", SCHEMA, 1), "ts", "1 hour")
    S.drain(S.append_sink(S.windowed(stream, "ts", "1 hour", ["device"], n=F.count("*")), scratch(spark, "progress")), out)
    got = {r["window"].day: r["n"] for r in spark.read.parquet(out).collect()}
    assert got[1] == 1 and got[3] == 1


def test_split_routes_null_to_the_other_side(spark):
    df = spark.createDataFrame([(1.0,), (None,), (-1.0,)], "v DOUBLE")
    yes, no = S.split_by(df, F.col("v") > 0)
    assert yes.count() == 1 and no.count() == 2


def test_bronze_to_silver(spark):
    raw = spark.createDataFrame([(bytearray(b'{"browser": "Firefox", "k": 3}'), dt.datetime(2024, 1, 2, 3))], "data BINARY, at TIMESTAMP")
    silver = S.bronze_to_silver(S.raw_to_bronze(raw, "data", "at"), "browser STRING, k INT", ["browser"]).first()
    assert silver["browserCleaned"] == "firefox" and silver["k"] == 3 and silver["arrivalDate"] == dt.date(2024, 1, 2)


def test_folds_leave_few_versions_to_read(spark):
    log = scratch(spark, "log")
    truth = {}
    for version in range(24):
        changed = [(k, version * 100 + k, "D" if (k + version) % 11 == 0 else "U") for k in range(version % 5, 40, 5)]
        spark.createDataFrame([(k, None if op == "D" else v, op) for k, v, op in changed], "k INT, v INT, op STRING").coalesce(1).write.parquet(f"{log}/version={version}")
        for k, v, op in changed:
            truth[k] = None if op == "D" else v
        if version in (6, 7, 19):
            S.fold_log(spark, log, ["k"], version)
            S.fold_log(spark, log, ["k"], version)  # a repeated fold changes nothing
    want = sorted(((k, v) for k, v in truth.items() if v is not None), key=repr)
    assert rows(S.current_rows(spark, log, ["k"])) == want == rows(M.as_of(S.read_log(spark, log), ["k"]))
    assert S.latest_fold(spark, log) == 19 and S.latest_fold(spark, log, 18) == 7 and S.latest_fold(spark, log, 5) is None
    for version in (3, 7, 12, 19, 22):
        assert rows(S.current_rows(spark, log, ["k"], version)) == rows(M.as_of(S.read_log(spark, log), ["k"], version))
    read = {f.rsplit("/", 2)[1] for f in S.folded_log(spark, log).inputFiles()}
    plan = S.folded_log(spark, log)._jdf.queryExecution().executedPlan().toString()
    assert "upto=19" in read and "version" in plan and "19" in plan


def test_upsert_sink_folds(spark):
    source, log, progress = (scratch(spark, x) for x in ("src", "log", "progress"))
    for hour in range(9):
        put(spark, source, [("a", f"2024-01-01T{hour:02}:00", float(hour)), (f"d{hour}", f"2024-01-01T{hour:02}:30", 1.0)])
        S.drain(S.upsert_sink(file_stream(spark, source, "parquet", SCHEMA, 1), log, progress, ["device"], [F.col("ts")], fold_every=4))
    assert S.latest_fold(spark, log) == 7
    got = {r["device"]: r["v"] for r in S.current_rows(spark, log, ["device"]).collect()}
    assert got == {"a": 8.0, **{f"d{h}": 1.0 for h in range(9)}}
