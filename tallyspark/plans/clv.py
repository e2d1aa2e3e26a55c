"""Customer lifetime queries: orders stand for retail invoices."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from ..functions import lifetime as L
from ..operators import clv as C
from ..operators import lifetime_fit as fit
from ..sources.tables import invoices, table
from .registry import query, rnd

# parameters for scoring queries (fixed values)
MODEL = L.BgNbd(r=2.0, alpha=400.0, a=0.8, b=2.5)
SPEND = L.GammaGamma(p=6.25, q=3.74, v=15.44)

D = "(SELECT o_custkey AS customer, CAST(o_orderdate AS DATE) AS day, sum(o_totalprice) AS amt, count(*) AS lines FROM orders GROUP BY 1, 2)"
END = "(SELECT CAST(max(o_orderdate) AS DATE) FROM orders)"
RFT = f"""(SELECT customer, CAST(count(*) - 1 AS FLOAT) AS frequency, CAST(max(day) - min(day) AS FLOAT) AS recency, CAST({END} - min(day) AS FLOAT) AS "T",
      CASE WHEN count(*) = 1 THEN 0.0::DOUBLE ELSE (sum(amt) - arg_min(amt, day)) / (count(*) - 1) END AS monetary_value FROM {D} WHERE customer IS NOT NULL GROUP BY customer)"""
FIRST = f"(SELECT customer, min(day) AS first_day FROM {D} GROUP BY 1)"


def holdout_sql(h=90, holdout_value="avg(amt)"):
    return f"""(SELECT d.customer, CAST(count(*) FILTER (day < {END} - {h}) - 1 AS FLOAT) AS frequency_cal,
      CAST(max(day) FILTER (day < {END} - {h}) - any_value(first_day) AS FLOAT) AS recency_cal, CAST({END} - {h} - any_value(first_day) AS FLOAT) AS "T_cal",
      coalesce(sum(amt) FILTER (day < {END} - {h} AND day > first_day) / nullif(count(*) FILTER (day < {END} - {h} AND day > first_day), 0), 0.0) AS monetary_value_cal,
      CAST(count(*) FILTER (day >= {END} - {h}) AS FLOAT) AS frequency_holdout,
      coalesce({holdout_value} FILTER (day >= {END} - {h}), 0.0) AS monetary_value_holdout, CAST({h} AS FLOAT) AS duration_holdout
      FROM {D} d JOIN {FIRST} f ON d.customer = f.customer GROUP BY d.customer HAVING count(*) FILTER (day < {END} - {h}) > 0)"""


def rft(spark, sf, amount="SalesAmount"):
    return C.rft_summary(invoices(spark, sf), "CustomerID", "InvoiceDate", amount).withColumnRenamed("CustomerID", "customer")


def holdout(spark, sf, amount="SalesAmount", raw_lines=False, days=90):
    return C.rft_holdout(invoices(spark, sf), "CustomerID", "InvoiceDate", days, amount, raw_lines).withColumnRenamed("CustomerID", "customer")


@query("m1_rft_summary", f'SELECT customer, frequency, recency, "T" FROM {RFT}')
def m1(spark, sf):
    return rft(spark, sf, None)


@query("m2_rft_with_value", f'SELECT customer, frequency, recency, "T", round(monetary_value, 6) + 0.0 AS monetary_value FROM {RFT}')
def m2(spark, sf):
    return rft(spark, sf).withColumn("monetary_value", rnd("monetary_value", 6))


@query("m3_calibration_holdout", f'SELECT customer, frequency_cal, recency_cal, "T_cal", frequency_holdout, duration_holdout FROM {holdout_sql()}')
def m3(spark, sf):
    return holdout(spark, sf, None)


HOLDOUT_OUT = """customer, frequency_cal, recency_cal, "T_cal", round(monetary_value_cal, 6) + 0.0 AS monetary_value_cal, frequency_holdout,
      round(monetary_value_holdout, 6) + 0.0 AS monetary_value_holdout, duration_holdout"""


@query("m4_calibration_holdout_value", f"SELECT {HOLDOUT_OUT} FROM {holdout_sql()}")
def m4(spark, sf):
    return _rounded(holdout(spark, sf))


def _rounded(df):
    return df.withColumns({c: rnd(c, 6) for c in ("monetary_value_cal", "monetary_value_holdout")})


@query("m5_holdout_value_of_lines", f"""
    SELECT h.customer, frequency_cal, recency_cal, "T_cal", round(monetary_value_cal, 6) + 0.0 AS monetary_value_cal, frequency_holdout,
      round(coalesce(v, 0.0), 6) + 0.0 AS monetary_value_holdout, duration_holdout
    FROM {holdout_sql()} h LEFT JOIN (SELECT o_custkey, avg(o_totalprice) AS v FROM orders WHERE CAST(o_orderdate AS DATE) >= {END} - 90 GROUP BY 1) r ON h.customer = r.o_custkey""")
def m5(spark, sf):
    return _rounded(holdout(spark, sf, raw_lines=True))


@query("m6_repeat_buyers", f'SELECT customer, frequency, recency, "T" FROM {RFT} WHERE frequency > 0 AND monetary_value > 0')
def m6(spark, sf):
    return C.repeat_buyers(rft(spark, sf), "frequency", "monetary_value").drop("monetary_value")


@query("m7_frequency_value_correlation", f"SELECT round(corr(frequency, monetary_value), 6) + 0.0 AS r FROM {RFT} WHERE frequency > 0 AND monetary_value > 0")
def m7(spark, sf):
    return C.repeat_buyers(rft(spark, sf), "frequency", "monetary_value").agg(rnd(F.corr(F.col("frequency").cast("double"), "monetary_value"), 6).alias("r"))


def _fit_frame(spark, model, fitted):
    rows = [(model, name, float(v), fitted.log_likelihood, fitted.rounds, fitted.gradient, fitted.converged) for name, v in zip(fit.PARAMETERS[model], fitted.parameters)]
    return spark.createDataFrame(rows, "model STRING, parameter STRING, value DOUBLE, log_likelihood DOUBLE, rounds INT, gradient DOUBLE, converged BOOLEAN")


@query("m8_fit_bgnbd")
def m8(spark, sf):
    return _fit_frame(spark, "bgnbd", fit.fit_lifetimes(fit.lifetime_cells(rft(spark, sf, None)), [("bgnbd", 0.001)])[0])


@query("m9_fit_pareto")
def m9(spark, sf):
    return _fit_frame(spark, "pareto", fit.fit_lifetimes(fit.lifetime_cells(rft(spark, sf, None)), [("pareto", 0.001)])[0])


def _mean_frame(spark, cells, model, theta):
    values, slopes = fit.likelihood_sums(cells, [(model, theta)])
    names = ["log_likelihood", *[f"by_{p}" for p in fit.PARAMETERS[model]]]
    return spark.createDataFrame([tuple(float(v) for v in (values[0], *slopes[0]))], ", ".join(f"{n} DOUBLE" for n in names)).select(*[rnd(n, 6).alias(n) for n in names])


def _mean_sql(value, theta, source, step=1e-4):
    """Mean of a log-likelihood in SQL, and its slopes by central differences."""
    def at(**moved):
        return "avg(" + value({**theta, **moved}) + ")"

    slopes = [f"round(({at(**{p: v * (1 + step)})} - {at(**{p: v * (1 - step)})}) / {2 * v * step!r}, 6) + 0.0 AS by_{p}" for p, v in theta.items()]
    return f"SELECT round({at()}, 6) + 0.0 AS log_likelihood, {', '.join(slopes)} FROM {source}"


def _bgnbd_sql(p):
    r, alpha, a, b, x = (f"{v!r}::DOUBLE" for v in (p["r"], p["alpha"], p["a"], p["b"], 0.0))
    x, tx, t = "frequency::DOUBLE", "recency::DOUBLE", '"T"::DOUBLE'
    alive, left = f"(-({r} + {x}) * ln({alpha} + {t}))", f"(ln({a} / ({b} + greatest({x}, 1) - 1)) - ({r} + {x}) * ln({alpha} + {tx}))"
    both = f"CASE WHEN {x} > 0 THEN greatest({alive}, {left}) + ln(1 + exp(-abs({alive} - {left}))) ELSE {alive} END"
    return f"lgamma({b} + {x}) - lgamma({b}) + lgamma({a} + {b}) - lgamma({a} + {b} + {x}) + lgamma({r} + {x}) - lgamma({r}) + {r} * ln({alpha}) + ({both})"


def _gammagamma_sql(p):
    p_, q, v = (f"{p[k]!r}::DOUBLE" for k in "pqv")
    x, m = "frequency::DOUBLE", "monetary_value"
    return f"lgamma({p_} * {x} + {q}) - lgamma({p_} * {x}) - lgamma({q}) + {q} * ln({v}) + ({p_} * {x} - 1) * ln({m}) + {p_} * {x} * ln({x}) - ({p_} * {x} + {q}) * ln({x} * {m} + {v})"


# fixed parameters at which likelihoods and slopes are compared; time in days
BGNBD_AT, SPEND_AT = {"r": 2.0, "alpha": 400.0, "a": 0.8, "b": 2.5}, {"p": 6.25, "q": 3.74, "v": 15000.0}


@query("m8_likelihood_and_slopes", _mean_sql(_bgnbd_sql, BGNBD_AT, RFT))
def m8_likelihood(spark, sf):
    return _mean_frame(spark, fit.lifetime_cells(rft(spark, sf, None)), "bgnbd", list(BGNBD_AT.values()))


@query("m12_likelihood_and_slopes", _mean_sql(_gammagamma_sql, SPEND_AT, f"{RFT} WHERE frequency > 0 AND monetary_value > 0"))
def m12_likelihood(spark, sf):
    return _mean_frame(spark, fit.spend_cells(rft(spark, sf)), "gammagamma", list(SPEND_AT.values()))


ALIVE = f"""CASE WHEN frequency > 0 THEN 1 / (1 + {MODEL.a} / ({MODEL.b} + frequency::DOUBLE - 1)
      * pow(({MODEL.alpha} + "T"::DOUBLE) / ({MODEL.alpha} + recency::DOUBLE), {MODEL.r} + frequency::DOUBLE)) ELSE 1.0::DOUBLE END"""


def series_sql(t, x='frequency::DOUBLE', age='"T"::DOUBLE'):
    a, b, c, z = f"({MODEL.r} + {x})", f"({MODEL.b} + {x})", f"({MODEL.a} + {MODEL.b} + {x} - 1)", f"(({t}) / ({MODEL.alpha} + {age} + ({t})))"
    term = f"exp(lgamma({a} + k) - lgamma({a}) + lgamma({b} + k) - lgamma({b}) - lgamma({c} + k) + lgamma({c}) - lgamma(k + 1) + k * ln({z}))"
    return f"list_sum(list_transform(range(0, 200), lambda k: {term}))"


def expected_sql(t, alive=ALIVE, x='frequency::DOUBLE', age='"T"::DOUBLE'):
    shrink = f"pow(({MODEL.alpha} + {age}) / ({MODEL.alpha} + {age} + ({t})), {MODEL.r} + {x})"
    return f"(({MODEL.a} + {MODEL.b} + {x} - 1) / ({MODEL.a} - 1) * (1 - {shrink} * {series_sql(t, x, age)}) * ({alive}))"


@query("m10_probability_alive", f"SELECT customer, round({ALIVE}, 8) + 0.0 AS prob_alive FROM {RFT}")
def m10(spark, sf):
    return rft(spark, sf, None).select("customer", rnd(L.p_alive("frequency", "recency", "T", MODEL), 8).alias("prob_alive"))


@query("m11_expected_purchases", "SELECT customer, " + ", ".join(f"round({expected_sql(float(t))}, 7) + 0.0 AS purchases_{t}" for t in (15, 30, 45)) + f" FROM {RFT}")
def m11(spark, sf):
    days = (15, 30, 45)
    e = rft(spark, sf, None).select("customer", L.expected_purchases_at(days, "frequency", "recency", "T", MODEL).alias("e"))
    return e.select("customer", *[rnd(F.col("e")[i], 7).alias(f"purchases_{t}") for i, t in enumerate(days)])


@query("m12_fit_gammagamma")
def m12(spark, sf):
    metrics = C.repeat_buyers(rft(spark, sf), "frequency", "monetary_value")
    return _fit_frame(spark, "gammagamma", fit.fit_spends(fit.spend_cells(metrics), [0.001])[0])


SPEND_SQL = f"({SPEND.p} * ({SPEND.v} + frequency::DOUBLE * monetary_value) / ({SPEND.p} * frequency::DOUBLE + {SPEND.q} - 1))"


@query("m13_expected_spend", f"SELECT customer, round({SPEND_SQL}, 5) + 0.0 AS spend FROM {RFT} WHERE frequency > 0 AND monetary_value > 0")
def m13(spark, sf):
    m = C.repeat_buyers(rft(spark, sf), "frequency", "monetary_value")
    return m.select("customer", rnd(L.expected_spend("frequency", "monetary_value", SPEND), 5).alias("spend"))


CLV_SQL = f"""
    WITH m AS (SELECT * FROM {RFT} WHERE frequency > 0 AND monetary_value > 0),
      e AS (SELECT customer, i, {expected_sql('30.0 * i')} AS e FROM m, range(1, 13) t(i)),
      f AS (SELECT customer, i, e - coalesce(lag(e) OVER (PARTITION BY customer ORDER BY i), 0) AS d FROM e)
    SELECT customer, round(any_value({SPEND_SQL}) * sum(d / pow(1.01, i)), 3) + 0.0 AS clv FROM f JOIN m USING (customer) GROUP BY customer"""


@query("m14_customer_lifetime_value", CLV_SQL)
def m14(spark, sf):
    m = C.repeat_buyers(rft(spark, sf), "frequency", "monetary_value")
    return m.select("customer", rnd(L.lifetime_value("frequency", "recency", "T", "monetary_value", MODEL, SPEND), 3).alias("clv"))


@query("m15_model_search")
def m15(spark, sf):
    return fit.search_lifetime_model(holdout(spark, sf, None), 90.0)


@query("m15_best_lifetime_model")
def m15_best(spark, sf):
    return fit.best_trial(fit.search_lifetime_model(holdout(spark, sf, None), 90.0))


@query("m15_spend_search")
def m15_spend(spark, sf):
    return fit.search_spend_model(holdout(spark, sf))


@query("m15_best_spend_model")
def m15_best_spend(spark, sf):
    return fit.best_trial(fit.search_spend_model(holdout(spark, sf)))


def _evaluation_sql(by):
    alive = ALIVE.replace("frequency", "frequency_cal").replace("recency", "recency_cal").replace('"T"', '"T_cal"')
    e = expected_sql(90.0, alive, "frequency_cal::DOUBLE", '"T_cal"::DOUBLE')
    return f"""SELECT k AS {by}, round(avg(y), 6) + 0.0 AS actual, round(avg(p), 6) + 0.0 AS predicted, CAST(count(*) AS BIGINT) AS customers FROM (
      SELECT {'"T_cal" - recency_cal' if by == 'time_since_last_purchase' else by} AS k, frequency_holdout::DOUBLE AS y, {e} AS p FROM {holdout_sql()}) GROUP BY k"""


for _by in ("frequency_cal", "recency_cal", "time_since_last_purchase"):
    query(f"m16_holdout_by_{_by}", _evaluation_sql(_by))(
        lambda spark, sf, by=_by: C.holdout_evaluation(holdout(spark, sf, None), MODEL, by, 90)
        .select(by, rnd("actual", 6).alias("actual"), rnd("predicted", 6).alias("predicted"), "customers")
    )


@query("m17_score_matrices", f"""
    WITH b AS (SELECT CAST(max(frequency) AS INTEGER) AS fx, CAST(max("T") AS INTEGER) AS tx FROM {RFT}),
      g AS (SELECT f AS frequency, r AS recency, tx AS "T" FROM b, range(0, (SELECT fx + 1 FROM b)) a(f), range(0, (SELECT tx + 1 FROM b)) c(r))
    SELECT CAST(frequency AS INTEGER) AS frequency, CAST(recency AS INTEGER) AS recency, round({ALIVE}, 7) + 0.0 AS prob_alive,
      round({expected_sql(30.0)}, 7) + 0.0 AS expected FROM g""")
def m17(spark, sf):
    return C.score_matrices(rft(spark, sf, None), MODEL).withColumns({c: rnd(c, 7) for c in ("prob_alive", "expected")})


@query("m18_alive_history", f"""
    WITH d AS (SELECT DISTINCT o_custkey AS customer, CAST(o_orderdate AS DATE) AS day FROM orders WHERE o_custkey = 100),
      c AS (SELECT CAST(unnest(generate_series((SELECT min(day) FROM d), {END}, INTERVAL 1 DAY)) AS DATE) AS "on"),
      s AS (SELECT "on", count(*) - 1 AS frequency, (max(day) - min(day))::DOUBLE AS recency, ("on" - min(day))::DOUBLE AS "T" FROM c JOIN d ON d.day <= c."on" GROUP BY 1)
    SELECT CAST(100 AS BIGINT) AS customer, "on" AS day, CAST(frequency AS INTEGER) AS frequency, round({ALIVE}, 8) + 0.0 AS prob_alive FROM s""")
def m18(spark, sf):
    rows = invoices(spark, sf).select(F.col("CustomerID").alias("customer"), "InvoiceDate")
    return C.alive_history(rows, "customer", "InvoiceDate", MODEL, F.col("customer") == 100).withColumn("prob_alive", rnd("prob_alive", 8))


@query("m19_engagement_scores", "SELECT customer, round(" + ALIVE + ", 7) + 0.0 AS alive, " + ", ".join(f"round({expected_sql(float(t))}, 7) + 0.0 AS next_{t}" for t in (15, 30, 45)) + f" FROM {RFT}")
def m19(spark, sf):
    scored = rft(spark, sf, None).select("customer", C.engagement_scores("frequency", "recency", "T", MODEL).alias("s"))
    return scored.select("customer", *[rnd(F.col("s")[i], 7).alias(n) for i, n in enumerate(("alive", "next_15", "next_30", "next_45"))])


@query("j4_registered_scoring_function", "SELECT customer, " + ", ".join(f"round({expected_sql(float(t))}, 7) + 0.0 AS next_{t}" for t in (15, 30, 45)) + f" FROM {RFT}")
def j4(spark, sf):
    theta = (MODEL.r, MODEL.alpha, MODEL.a, MODEL.b)

    def next_purchases(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for x, tx, t in batches:
            d = {"x": x.to_numpy("float64"), "tx": tx.to_numpy("float64"), "t": t.to_numpy("float64")}
            yield pd.Series(list(np.stack([fit.bgnbd_expected(theta, d, h) for h in (15.0, 30.0, 45.0)], axis=1)))

    spark.udf.register("next_purchases", F.pandas_udf(next_purchases, "array<double>"))
    return spark.sql(
        """SELECT customer, round(p[0], 7) + 0.0D AS next_15, round(p[1], 7) + 0.0D AS next_30, round(p[2], 7) + 0.0D AS next_45
           FROM (SELECT customer, next_purchases(frequency, recency, T) AS p FROM {metrics})""",
        metrics=rft(spark, sf, None),
    )
