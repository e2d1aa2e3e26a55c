"""Forecast queries: suppliers stand for stores, line numbers for items, quantities for sales."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from ..operators import aggregates as A
from ..operators import forecast as P
from ..operators import timeseries as TS
from ..session import scratch
from ..sources.tables import table
from .registry import query, rnd

KEYS = ["store", "item"]


def history(spark, sf):
    lines = table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("store"), F.col("l_linenumber").alias("item"), "l_shipdate", "l_quantity")
    return P.sales_history(lines, KEYS, "l_shipdate", "l_quantity")


HISTORY = "(SELECT l_suppkey AS store, l_linenumber AS item, CAST(l_shipdate AS DATE) AS ds, sum(l_quantity) AS y FROM lineitem GROUP BY 1, 2, 3)"


@query("j3_grouped_map", f"""
    WITH h AS {HISTORY}
    SELECT a.store, a.item, round(median((b.y - a.y) / (b.ds - a.ds)), 8) + 0.0 AS slope FROM h a JOIN h b ON a.store = b.store AND a.item = b.item AND a.ds < b.ds GROUP BY 1, 2""")
def j3(spark, sf):
    """Theil-Sen slope of each series: the median over all pairs of days, which a series has at most one row for."""
    def slope(series: pd.DataFrame) -> pd.DataFrame:
        x = (pd.to_datetime(series["ds"]) - pd.Timestamp("1995-01-01")).dt.days.to_numpy(dtype=float)
        i, j = np.triu_indices(len(series), 1)
        one = pd.DataFrame({"store": series["store"].iloc[:1], "item": series["item"].iloc[:1]})
        y = series["y"].to_numpy()
        return one.assign(slope=float(np.median((y[j] - y[i]) / (x[j] - x[i])))) if len(i) else one.iloc[:0].assign(slope=0.0)

    fits = history(spark, sf).groupBy(*KEYS).applyInPandas(slope, "store BIGINT, item INT, slope DOUBLE")
    return fits.withColumn("slope", rnd("slope", 8))


@query("q1_history", f"SELECT store, item, ds, round(y, 4) + 0.0 AS y FROM {HISTORY}")
def q1(spark, sf):
    return history(spark, sf).withColumn("y", rnd("y"))


@query("q2_forecast_groups")
def q2(spark, sf):
    return P.forecast_groups(history(spark, sf), KEYS)


@query("q3_single_series")
def q3(spark, sf):
    total = P.sales_history(table(spark, sf, "lineitem").select(F.lit("all").alias("series"), "l_shipdate", "l_quantity"), ["series"], "l_shipdate", "l_quantity")
    return P.forecast_groups(total, ["series"])


@query("q4_history_in_forecast", f"""
    WITH h AS {HISTORY}, g AS (SELECT store, item, max(ds) AS hi FROM h GROUP BY 1, 2),
      f AS (SELECT store, item, ds FROM h UNION ALL SELECT store, item, hi + CAST(i AS INTEGER) FROM g, range(1, 91) t(i))
    SELECT f.store, f.item, f.ds, round(h.y, 4) + 0.0 AS y FROM f LEFT JOIN h ON f.store = h.store AND f.item = h.item AND f.ds = h.ds""")
def q4(spark, sf):
    h = history(spark, sf)
    return P.join_history(P.forecast_groups(h, KEYS), h, KEYS).select("store", "item", "ds", rnd("y").alias("y"))


@query("q5_metrics_per_series", f"""
    WITH h AS {HISTORY}, f AS (SELECT *, avg(y) OVER (PARTITION BY store, item ORDER BY ds ROWS 6 PRECEDING) AS yhat, count(*) OVER (PARTITION BY store, item ORDER BY ds ROWS 6 PRECEDING) AS n FROM h)
    SELECT store, item, round(avg(abs(y - yhat)), 7) + 0.0 AS mae, round(avg((y - yhat) ** 2), 7) + 0.0 AS mse, round(sqrt(avg((y - yhat) ** 2)), 7) + 0.0 AS rmse
    FROM f WHERE n = 7 AND ds < DATE '2000-01-01' GROUP BY 1, 2""")
def q5(spark, sf):
    naive = TS.rolling_mean(history(spark, sf), KEYS, "ds", "y", 7, "yhat").where("yhat IS NOT NULL")
    m = P.forecast_metrics(naive, KEYS, F.lit("2000-01-01").cast("date"))
    return m.withColumns({c: rnd(c, 7) for c in ("mae", "mse", "rmse")})


@query("q5_forecast_metrics")
def q5_forecast(spark, sf):
    return P.forecast_metrics(P.forecast_groups(history(spark, sf), KEYS), KEYS, F.lit("2000-01-01").cast("date"))


@query("q6_latest_run_of_an_item", f"""
    SELECT store, item, ds, round(y, 4) + 0.0 AS yhat, DATE '2001-06-01' AS training_date FROM {HISTORY} WHERE item = 2 AND ds < DATE '2001-06-01'""")
def q6(spark, sf):
    path = scratch(spark, "forecasts")
    for day in ("2001-01-01", "2001-06-01"):
        P.save_run(history(spark, sf).where(F.col("ds") < F.lit(day).cast("date")).withColumnRenamed("y", "yhat"), path, F.lit(day).cast("date"))
    return P.latest_run(spark.read.parquet(path)).where("item = 2").select("store", "item", "ds", rnd("yhat").alias("yhat"), "training_date")


@query("q7_components")
def q7(spark, sf):
    return P.components(P.forecast_groups(history(spark, sf), KEYS), KEYS)
