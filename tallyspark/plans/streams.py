"""Streaming queries: events stand for device readings and clicks. Each drains its stream and returns the final table."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import news as N
from ..session import scratch
from ..sources.incremental import file_stream
from ..sources.tables import stream_table, table
from ..streaming import medallion as M
from .news import PART_ALIASES, PART_THEMES, articles_of
from .registry import ORACLES, query, rnd


def _bronze(spark, sf):
    """Run events through the bronze append and return the folder."""
    path = scratch(spark, "bronze")
    raw = stream_table(spark, sf, "events").select("event_id", "user_id", F.encode("props", "UTF-8").alias("data"), "ts")
    M.drain(M.append_sink(M.raw_to_bronze(raw, "data", "ts"), scratch(spark, "progress"), ["arrivalDate"]), path)
    return path


@query("i1_raw_to_bronze", 'SELECT event_id, user_id, props AS "jsonData", ts AS "arrivalTimestamp", CAST(ts AS DATE) AS "arrivalDate" FROM events')
def i1(spark, sf):
    return spark.read.parquet(_bronze(spark, sf))


@query("i2_bronze_to_silver", 'SELECT event_id, user_id, CAST(ts AS DATE) AS "arrivalDate", CAST(json_extract(props, \'$.k\') AS INTEGER) AS k FROM events')
def i2(spark, sf):
    bronze, silver = _bronze(spark, sf), scratch(spark, "silver")
    stream = spark.readStream.schema(spark.read.parquet(bronze).schema).parquet(bronze)
    clean = M.bronze_to_silver(stream, "k INT").drop("arrivalTimestamp")
    M.drain(M.append_sink(clean, scratch(spark, "progress"), ["arrivalDate"]), silver)
    return spark.read.parquet(silver)


@query("i3_interval_trigger", "SELECT event_id, event_type FROM events")
def i3(spark, sf):
    path = scratch(spark, "interval")
    stream = stream_table(spark, sf, "events").select("event_id", "event_type")
    running = M.append_sink(stream, scratch(spark, "progress")).trigger(processingTime="1 second").start(path)
    running.processAllAvailable()
    running.stop()
    return spark.read.parquet(path)


@query("i4_drain_twice", "SELECT event_id, user_id, value FROM events")
def i4(spark, sf):
    source, target, progress = scratch(spark, "landing"), scratch(spark, "target"), scratch(spark, "progress")
    rows = table(spark, sf, "events").select("event_id", "user_id", "value", "ts")
    for part in (rows.where("ts < '2024-01-15'"), rows.where("ts >= '2024-01-15'")):
        part.write.mode("append").parquet(source)
        stream = file_stream(spark, source, "parquet", rows.schema, files_per_trigger=1).drop("ts")
        M.drain(M.append_sink(stream, progress), target)
    return spark.read.parquet(target)


@query("i5_complete_counts", "SELECT event_type, CAST(count(*) AS BIGINT) AS n FROM events GROUP BY 1")
def i5(spark, sf):
    path = scratch(spark, "counts")
    counts = stream_table(spark, sf, "events").groupBy("event_type").agg(F.count("*").alias("n"))
    M.drain(M.replace_sink(counts, path, scratch(spark, "progress"), [F.desc("n")]))
    return M.replaced(spark, path)


@query("i6_tumbling_counts", "SELECT time_bucket(INTERVAL 10 SECOND, ts) AS \"window\", event_type, CAST(count(*) AS BIGINT) AS n FROM events GROUP BY 1, 2")
def i6(spark, sf):
    events = M.event_time(stream_table(spark, sf, "events"), "ts")
    return _upserted(spark, M.windowed(events, "ts", "10 seconds", ["event_type"], n=F.count("*")), ["window", "event_type"])


def _upserted(spark, stream, keys):
    log = scratch(spark, "log")
    M.drain(M.upsert_sink(stream, log, scratch(spark, "progress"), keys, [F.col(k) for k in keys], mode="update"))  # an update holds a key once
    rows = M.current_rows(spark, log, keys)
    return rows.withColumn("window", F.col("window").cast("timestamp_ntz")) if "window" in rows.columns else rows


@query("i7_hourly_means", """
    SELECT date_trunc('hour', ts) AS "window", user_id, round(avg(value), 9) + 0.0 AS value, CAST(max(CAST(json_extract(props, '$.k') AS INTEGER)) AS INTEGER) AS k,
      arg_max(event_type, ts) AS last_type FROM events GROUP BY 1, 2""")
def i7(spark, sf):
    events = M.event_time(stream_table(spark, sf, "events"), "ts").withColumn("k", F.from_json("props", "k INT")["k"])
    means = M.windowed(events, "ts", "1 hour", ["user_id"], value=F.avg("value"), k=F.max("k"), last_type=F.max_by("event_type", "ts"))
    return _upserted(spark, means, ["window", "user_id"]).withColumn("value", rnd("value", 9))


@query("i8_upsert_sink", """
    SELECT user_id, event_type, arg_max(event_id, ts) AS event_id, arg_max(value, ts) AS value FROM events GROUP BY 1, 2""")
def i8(spark, sf):
    source, log = scratch(spark, "landing"), scratch(spark, "log")
    rows = table(spark, sf, "events").select("user_id", "event_type", "event_id", "value", "ts")
    for part in (rows.where("ts < '2024-01-15'"), rows.where("ts >= '2024-01-15'")):
        part.coalesce(1).write.mode("append").parquet(source)
    stream = file_stream(spark, source, "parquet", rows.schema, files_per_trigger=1)
    M.drain(M.upsert_sink(stream, log, scratch(spark, "progress"), ["user_id", "event_type"], [F.col("ts")]))
    return M.current_rows(spark, log, ["user_id", "event_type"]).drop("ts")


@query("i8_folded_upserts", """
    SELECT user_id, event_type, arg_max(event_id, ts) AS event_id, arg_max(value, ts) AS value FROM events GROUP BY 1, 2""")
def i8_folded(spark, sf):
    source, log = scratch(spark, "landing"), scratch(spark, "log")
    rows = table(spark, sf, "events").select("user_id", "event_type", "event_id", "value", "ts")
    span = rows.agg(F.min("ts").alias("lo"), F.max("ts").alias("hi")).first()
    width = (span["hi"] - span["lo"]) / 12
    for i in range(12):  # later files hold later events
        part = rows.where(F.col("ts") >= F.lit(span["lo"] + i * width)) if i else rows
        (part.where(F.col("ts") < F.lit(span["lo"] + (i + 1) * width)) if i < 11 else part).coalesce(1).write.mode("append").parquet(source)
    stream = file_stream(spark, source, "parquet", rows.schema, files_per_trigger=1)
    M.drain(M.upsert_sink(stream, log, scratch(spark, "progress"), ["user_id", "event_type"], [F.col("ts")], fold_every=5))
    return M.current_rows(spark, log, ["user_id", "event_type"]).drop("ts")


@query("i9_stream_enrichment", ORACLES.get("o1_enriched_mentions"))
def i9(spark, sf):
    path = scratch(spark, "silver")
    silver = N.enrich(articles_of(stream_table(spark, sf, "part")), PART_ALIASES, {str(i): f"C{i}" for i in range(3, 8)}, PART_THEMES)
    M.drain(M.append_sink(silver, scratch(spark, "progress")), path)
    return spark.read.parquet(path).select(
        "organisation", "url", F.array_join(F.array_sort("themes"), ",").alias("themes"), "tone", F.array_join(F.array_sort("countries"), ",").alias("countries")
    )


@query("i10_several_writers", "SELECT event_type, CAST(count(*) * 2 AS BIGINT) AS n FROM events GROUP BY 1")
def i10(spark, sf):
    path = scratch(spark, "shared")
    stream = stream_table(spark, sf, "events").select("event_id", "event_type")
    writers = [M.append_sink(stream, scratch(spark, "progress")).trigger(availableNow=True).start(f"{path}/writer={w}") for w in ("a", "b")]
    for w in writers:
        w.awaitTermination()
    # each writer keeps its own commit log in its folder, so the folders are read one by one
    both = spark.read.parquet(f"{path}/writer=a").unionByName(spark.read.parquet(f"{path}/writer=b"))
    return both.groupBy("event_type").agg(F.count("*").alias("n"))


@query("i11_tolerates_changed_rows", "SELECT event_id, CASE WHEN event_type = 'click' THEN value * 2 ELSE value END AS value FROM events")
def i11(spark, sf):
    source, log = scratch(spark, "landing"), scratch(spark, "log")
    rows = table(spark, sf, "events").select("event_id", "event_type", "value")
    rows.coalesce(1).write.parquet(source)
    # an update rewrites whole files: changed rows come again together with unchanged ones
    rows.withColumn("value", F.when(F.col("event_type") == "click", F.col("value") * 2).otherwise(F.col("value"))).coalesce(1).write.mode("append").parquet(source)
    stream = file_stream(spark, source, "parquet", rows.schema, files_per_trigger=1)
    M.drain(M.upsert_sink(stream, log, scratch(spark, "progress"), ["event_id"], [F.col("value")]))
    return M.current_rows(spark, log, ["event_id"]).drop("event_type")


@query("i13_closed_windows_only", """
    SELECT date_trunc('hour', ts) AS "window", event_type, CAST(count(*) AS BIGINT) AS n FROM events GROUP BY 1, 2
    HAVING date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)""")
def i13(spark, sf):
    path = scratch(spark, "closed")
    events = M.event_time(stream_table(spark, sf, "events"), "ts", "1 hour")
    M.drain(M.append_sink(M.windowed(events, "ts", "1 hour", ["event_type"], n=F.count("*")), scratch(spark, "progress")), path)
    return spark.read.parquet(path).withColumn("window", F.col("window").cast("timestamp_ntz"))


@query("c7_stream_static_join", "SELECT event_id, c_mktsegment, value FROM events JOIN customer ON user_id = c_custkey")
def c7(spark, sf):
    path = scratch(spark, "joined")
    profiles = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    joined = stream_table(spark, sf, "events").join(profiles, F.col("user_id") == F.col("c_custkey")).select("event_id", "c_mktsegment", "value")
    M.drain(M.append_sink(joined, scratch(spark, "progress")), path)
    return spark.read.parquet(path)


@query("c8_stream_stream_join", """
    SELECT c.event_id AS click_id, p.event_id AS purchase_id, c.user_id, date_trunc('hour', c.ts) AS "window", p.value AS power
    FROM events c JOIN events p ON c.user_id = p.user_id AND date_trunc('hour', c.ts) = date_trunc('hour', p.ts) WHERE c.event_type = 'click' AND p.event_type = 'purchase'""")
def c8(spark, sf):
    def side(kind, prefix):
        rows = stream_table(spark, sf, "events").where(F.col("event_type") == kind)
        timed = M.event_time(rows, "ts").withColumnRenamed("ts", f"{prefix}_ts")
        return timed.select(F.col("event_id").alias(f"{prefix}_id"), F.col("user_id").alias(f"{prefix}_user"), F.col("value").alias(f"{prefix}_value"), f"{prefix}_ts", F.to_date(f"{prefix}_ts").alias(f"{prefix}_date")).withColumn(f"{prefix}_window", F.date_trunc("hour", f"{prefix}_ts"))

    c, p = side("click", "c"), side("purchase", "p")
    near = F.expr("p_ts > c_ts - INTERVAL 1 HOUR AND p_ts < c_ts + INTERVAL 1 HOUR")  # same hour implies this; it lets old state go
    same = (F.col("c_date") == F.col("p_date")) & (F.col("c_window") == F.col("p_window")) & (F.col("c_user") == F.col("p_user")) & near
    joined = c.join(p, same).select(
        F.col("c_id").alias("click_id"), F.col("p_id").alias("purchase_id"), F.col("c_user").alias("user_id"), F.col("c_window").alias("window"), F.col("p_value").alias("power")
    )
    path = scratch(spark, "gold")
    M.drain(M.append_sink(joined, scratch(spark, "progress")), path)
    return spark.read.parquet(path).withColumn("window", F.col("window").cast("timestamp_ntz"))
