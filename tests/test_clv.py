import datetime as dt
import math

import numpy as np
import pytest

from tallyspark.functions import lifetime as L
from tallyspark.operators import clv as C
from tallyspark.operators import lifetime_fit as fit


def orders(spark):
    data = [
        ("one", "2024-01-10", 5.0), ("two", "2024-01-01", 10.0), ("two", "2024-01-01", 5.0), ("two", "2024-02-01", 20.0), ("two", "2024-03-31", 40.0),
        ("late", "2024-03-30", 7.0), ("edge", "2024-01-01", 1.0), ("edge", "2024-03-01", 3.0), (None, "2024-03-31", 99.0), ("neg", "2024-01-01", 1.0), ("neg", "2024-01-05", -4.0),
    ]
    return spark.createDataFrame([(c, dt.datetime.fromisoformat(d), a) for c, d, a in data], "c STRING, at TIMESTAMP_NTZ, amt DOUBLE")


def by_key(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


def test_rft(spark):
    got = by_key(C.rft_summary(orders(spark), "c", "at", "amt"))
    assert got == {"one": (0, 0, 81, 0), "two": (2, 90, 90, 30), "late": (0, 0, 1, 0), "edge": (1, 60, 90, 3), "neg": (1, 4, 90, -4)}
    assert set(by_key(C.repeat_buyers(C.rft_summary(orders(spark), "c", "at", "amt"), "frequency", "monetary_value"))) == {"two", "edge"}


def test_holdout_cut_day_belongs_to_holdout(spark):
    got = by_key(C.rft_holdout(orders(spark), "c", "at", 30, "amt"))  # the cut is 2024-03-01
    assert "late" not in got
    assert got["edge"] == (0, 0, 60, 0, 1, 3, 30) and got["two"] == (1, 31, 60, 20, 1, 40, 30) and got["one"] == (0, 0, 51, 0, 0, 0, 30)


def test_dataframe_form_equals_sql_form(spark):
    orders(spark).createOrReplaceTempView("o_rft")
    sql = spark.sql("""
        WITH d AS (SELECT c, to_date(at) AS day, sum(amt) AS amt FROM o_rft WHERE c IS NOT NULL GROUP BY ALL), f AS (SELECT c, min(day) AS first FROM d GROUP BY c)
        SELECT d.c, CAST(count(*) - 1 AS FLOAT), CAST(datediff(max(day), min(first)) AS FLOAT), CAST(datediff((SELECT max(to_date(at)) FROM o_rft), min(first)) AS FLOAT)
        FROM d JOIN f ON d.c = f.c GROUP BY d.c""")
    assert by_key(sql) == by_key(C.rft_summary(orders(spark), "c", "at"))


def test_closed_forms_agree_with_simulation():
    rng = np.random.default_rng(1)
    m = L.BgNbd(1.5, 20.0, 2.0, 4.0)
    n = 400_000
    lam, p = rng.gamma(m.r, 1 / m.alpha, n), rng.beta(m.a, m.b, n)
    t, horizon = 30.0, 20.0
    clock, x, tx, alive, later = np.zeros(n), np.zeros(n), np.zeros(n), np.ones(n, bool), np.zeros(n)
    for _ in range(60):
        clock = clock + rng.exponential(1 / lam)
        inside, after = alive & (clock <= t), alive & (clock > t) & (clock <= t + horizon)
        x[inside] += 1
        tx[inside] = clock[inside]
        later[after] += 1
        drop = rng.random(n) < p
        alive &= ~(drop & (inside | after))
    pick = (x == 2) & (np.abs(tx - 20) < 3)
    d = {"x": np.array([2.0]), "tx": np.array([20.0]), "t": np.array([t])}
    want = fit.bgnbd_expected((m.r, m.alpha, m.a, m.b), d, horizon)[0]
    assert pick.sum() > 2000 and later[pick].mean() == pytest.approx(want, rel=0.06)


def test_scoring_columns_match_numpy(spark):
    m, g = L.BgNbd(2.0, 400.0, 0.8, 2.5), L.GammaGamma(6.25, 3.74, 15.44)
    df = spark.createDataFrame([(0.0, 0.0, 50.0, 0.0), (3.0, 100.0, 200.0, 40.0), (30.0, 900.0, 1000.0, 12.0), (None, None, None, None)], "x DOUBLE, tx DOUBLE, t DOUBLE, mv DOUBLE")
    got = df.select(L.expected_purchases(30, "x", "tx", "t", m).alias("e"), L.p_alive("x", "tx", "t", m).alias("p"), L.lifetime_value("x", "tx", "t", "mv", m, g).alias("v")).collect()
    d = {"x": np.array([0.0, 3.0, 30.0]), "tx": np.array([0.0, 100.0, 900.0]), "t": np.array([50.0, 200.0, 1000.0])}
    want = fit.bgnbd_expected((2.0, 400.0, 0.8, 2.5), d, 30.0)
    assert [r["e"] for r in got[:3]] == pytest.approx(want) and got[0]["p"] == 1.0 and got[3]["e"] is None
    e = np.array([np.zeros(3)] + [fit.bgnbd_expected((2.0, 400.0, 0.8, 2.5), d, 30.0 * i) for i in range(1, 13)])
    spend = 6.25 * (15.44 + 3.0 * 40.0) / (6.25 * 3.0 + 2.74)
    assert got[1]["v"] == pytest.approx(spend * sum((e[i] - e[i - 1])[1] / 1.01**i for i in range(1, 13)))


def test_lgamma_and_pareto_likelihood():
    z = np.array([0.05, 0.7, 3.3, 120.0])
    assert fit.lgamma(z) == pytest.approx([math.lgamma(v) for v in z])
    # numeric integral of the alive and dead paths
    r, alpha, s, beta = 0.8, 3.0, 1.2, 5.0
    d = {"x": np.array([2.0]), "tx": np.array([4.0]), "t": np.array([9.0])}
    lam, mu = np.meshgrid(np.linspace(1e-6, 6, 1500), np.linspace(1e-6, 6, 1500))
    prior = lam ** (r - 1) * np.exp(-alpha * lam) * alpha**r / math.gamma(r) * mu ** (s - 1) * np.exp(-beta * mu) * beta**s / math.gamma(s)
    like = lam**2 * (mu / (lam + mu) * np.exp(-(lam + mu) * 4) + lam / (lam + mu) * np.exp(-(lam + mu) * 9))
    step = (6 / 1499) ** 2
    assert fit.pareto_loglik((r, alpha, s, beta), d)[0] == pytest.approx(math.log((prior * like).sum() * step), abs=0.02)


def test_fits_recover_parameters(spark):
    rng = np.random.default_rng(3)
    n, true = 20_000, (1.2, 10.0, 1.5, 3.0)
    lam, p, t = rng.gamma(true[0], 1 / true[1], n), rng.beta(true[2], true[3], n), rng.uniform(20, 60, n)
    clock, x, tx, alive = np.zeros(n), np.zeros(n), np.zeros(n), np.ones(n, bool)
    for _ in range(200):
        clock = clock + rng.exponential(1 / lam)
        inside = alive & (clock <= t)
        x[inside] += 1
        tx[inside] = clock[inside]
        alive &= inside & (rng.random(n) >= p)
    rows = spark.createDataFrame([(float(a), float(b), float(c)) for a, b, c in zip(x, tx, t)], "frequency DOUBLE, recency DOUBLE, T DOUBLE").repartition(4)
    got = fit.fit_bgnbd(fit.lifetime_cells(rows))
    assert [got[k] for k in ("r", "alpha", "a", "b")] == pytest.approx(true, rel=0.25)
    shape, q, v = 4.0, 5.0, 100.0
    nu = rng.gamma(q, 1 / v, n)
    k = rng.integers(1, 8, n).astype(float)
    mean = rng.gamma(shape * k, 1 / (nu * k))
    spend = spark.createDataFrame([(float(a), float(b)) for a, b in zip(k, mean)], "frequency DOUBLE, monetary_value DOUBLE").repartition(4)
    g = fit.fit_gammagamma(fit.spend_cells(spend))
    assert [g["p"], g["q"], g["v"]] == pytest.approx([shape, q, v], rel=0.15)


def test_engagement_array_and_history(spark):
    m = L.BgNbd(2.0, 400.0, 0.8, 2.5)
    one = C.rft_summary(orders(spark), "c", "at").where("c = 'two'").select(C.engagement_scores("frequency", "recency", "T", m).alias("s")).first()["s"]
    assert len(one) == 4 and one[1] < one[2] < one[3]
    h = C.alive_history(orders(spark), "c", "at", m).where("c = 'two'").orderBy("day").collect()
    assert len(h) == 91 and h[0]["prob_alive"] == 1.0 and h[-1]["frequency"] == 2
    assert h[-1]["prob_alive"] == pytest.approx(one[0])
