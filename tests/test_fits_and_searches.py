"""What SQL cannot say: fits, searches, forecasts and models over the given tables, each held against a property of its result."""

import datetime as dt
import json
import math
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyspark.operators import forecast as P
from tallyspark.operators import indicators as I
from tallyspark.operators import lifetime_fit as fit
from tallyspark.operators import topics as Z
from tallyspark.plans import QUERIES
from tallyspark.plans import clv as plans_clv
from tallyspark.plans import forecast as plans_forecast
from tallyspark.plans import tabular as plans_tabular

SF = os.environ.get("ROWS_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the given tables")


def run(spark, name):
    return QUERIES[name](spark, SF).collect()


# likelihoods ---------------------------------------------------------------------------------------------------------


def data(seed, n=60):
    rng = np.random.default_rng(seed)
    x = rng.integers(0, 7, n).astype(float)
    t = rng.uniform(15, 80, n)
    return {"x": x, "tx": np.where(x > 0, t * rng.uniform(0.05, 0.99, n), 0.0), "t": t, "m": rng.uniform(0.5, 300, n)}


@pytest.mark.parametrize("model,theta", [("bgnbd", (0.9, 7.0, 1.3, 2.2)), ("bgnbd", (3.0, 90.0, 0.2, 9.0)), ("pareto", (0.8, 3.0, 1.2, 5.0)), ("pareto", (2.0, 30.0, 0.2, 1.0)), ("pareto", (1.0, 4.0, 2.0, 90.0)), ("gammagamma", (4.0, 3.0, 50.0))])
def test_slopes_are_derivatives(model, theta):
    d = data(3)
    d["x"] = np.maximum(d["x"], 1) if model == "gammagamma" else d["x"]
    value, slopes = fit.SLOPES[model](theta, d)
    assert value == pytest.approx(fit.LOGLIK[model](theta, d), abs=1e-12)
    for i, slope in enumerate(slopes):
        up, down = ([v * (1 + s) if j == i else v for j, v in enumerate(theta)] for s in (1e-5, -1e-5))
        assert slope == pytest.approx((fit.LOGLIK[model](up, d) - fit.LOGLIK[model](down, d)) / (2e-5 * theta[i]), abs=2e-7, rel=1e-5)


def test_digamma():
    z = np.array([0.01, 0.3, 1.0, 2.5, 40.0])
    assert fit.digamma(np.array([1.0]))[0] == pytest.approx(-0.5772156649015329, abs=1e-13)
    assert fit.digamma(z + 1) - fit.digamma(z) == pytest.approx(1 / z, rel=1e-12)


def test_cells_in_lanes_give_the_same_sums(spark):
    d = data(5, 300)
    cells = spark.createDataFrame([(float(a), float(b), float(c), 1.0 + i % 3) for i, (a, b, c) in enumerate(zip(d["x"], d["tx"], d["t"]))], "x DOUBLE, tx DOUBLE, t DOUBLE, n DOUBLE")
    todo = [("bgnbd", (1.0 + i, 5.0, 1.0, 2.0)) for i in range(7)] + [("pareto", (1.0, 5.0, 1.0, 2.0 + i)) for i in range(4)]
    plain, slopes = fit.likelihood_sums(cells, todo)
    copies = cells.withColumns({"lane": F.explode(F.sequence(F.lit(0), F.lit(2))), "lanes": F.lit(3)}).repartition(5)
    values, by = fit.likelihood_sums(copies, todo)
    n = np.array([1.0 + i % 3 for i in range(300)])
    assert values == pytest.approx(plain, rel=1e-12) and by == pytest.approx(slopes, rel=1e-9)
    assert values[9] == pytest.approx(np.dot(n, fit.pareto_loglik(todo[9][1], d)) / n.sum(), rel=1e-12)


def best_by(cells, model, theta, l2, scale):
    """The penalised mean log-likelihood at a fit and around it, in the units it runs in."""
    around = [theta] + [[v * (1 + s * (i == j)) for j, v in enumerate(theta)] for i in range(len(theta)) for s in (0.02, -0.02)]
    scaled = [[v * (scale if timed else 1.0) for v, timed in zip(p, fit.TIME_UNITS[model])] for p in around]
    values = fit.log_likelihoods(cells, [(model, p) for p in scaled])
    return [v - l2 * sum(x * x for x in p) for v, p in zip(values, scaled)]


@pytest.mark.parametrize("name,model", [("m8_fit_bgnbd", "bgnbd"), ("m9_fit_pareto", "pareto")])
def test_lifetime_fits_are_maxima(spark, name, model):
    rows = {r["parameter"]: r for r in run(spark, name)}
    assert all(r["converged"] and r["gradient"] <= 1e-8 and r["rounds"] < 100 for r in rows.values())
    cells = fit.lifetime_cells(plans_clv.rft(spark, SF, None))
    top = cells.agg(F.max("t")).first()[0]
    scaled = cells.withColumns({"tx": F.col("tx") * 10 / top, "t": F.col("t") * 10 / top})
    objective = best_by(scaled, model, [rows[p]["value"] for p in fit.PARAMETERS[model]], 0.001, 10 / top)
    assert max(objective) <= objective[0] + 1e-9


def test_spend_fit_is_a_maximum(spark):
    rows = {r["parameter"]: r for r in run(spark, "m12_fit_gammagamma")}
    assert set(rows) == {"p", "q", "v"} and all(r["converged"] and r["gradient"] <= 1e-8 and r["value"] > 0 for r in rows.values())


def test_a_fit_without_a_maximum_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(fit, "MAX_ROUNDS", 3)
    cells = spark.createDataFrame([(2.0, 5.0, 9.0, 1.0), (0.0, 0.0, 9.0, 4.0)], "x DOUBLE, tx DOUBLE, t DOUBLE, n DOUBLE")
    with pytest.raises(RuntimeError, match="gradient"):
        fit.fit_all(cells, [("bgnbd", (1.0, 1.0, 0.5, 2.0), 0.0)])


@pytest.mark.parametrize("search,best,models", [("m15_model_search", "m15_best_lifetime_model", {"bgnbd", "pareto"}), ("m15_spend_search", "m15_best_spend_model", {"gammagamma"})])
def test_searches_fit_all_trials(spark, search, best, models):
    rows = run(spark, search)
    assert sorted(r["trial"] for r in rows) == list(range(100)) and {r["model"] for r in rows} == models
    assert all(r["converged"] and r["gradient"] <= 1e-8 and 0 <= r["l2"] < 1 for r in rows)
    (chosen,) = run(spark, best)
    least = min((r["mse"], r["trial"]) for r in rows if not math.isnan(r["mse"]))
    assert chosen["trial"] == least[1] and chosen["mse"] == pytest.approx(least[0])
    # a stronger penalty never gives a better plain likelihood
    for model in models:
        line = sorted((r["l2"], r["log_likelihood"]) for r in rows if r["model"] == model)
        assert all(b[1] <= a[1] + 1e-9 for a, b in zip(line, line[1:]))


def test_path_equals_fits_from_scratch(spark):
    d = data(9, 400)
    cells = spark.createDataFrame([(float(a), float(b / 8), float(c / 8), 1.0) for a, b, c in zip(d["x"], d["tx"], d["t"])], "x DOUBLE, tx DOUBLE, t DOUBLE, n DOUBLE")
    plan = [("bgnbd", l2) for l2 in (0.9, 0.02, 0.3)] + [("pareto", 0.05)]
    path = fit.fit_path(cells, plan, fit.STARTS)
    alone = [fit.fit_all(cells, [(m, fit.STARTS[m], l2)])[0] for m, l2 in plan]
    for a, b in zip(path, alone):
        assert a.log_likelihood == pytest.approx(b.log_likelihood, abs=1e-9)


# trees ---------------------------------------------------------------------------------------------------------------


def test_boosting_stops_by_itself_and_helps(spark):
    model, train, unseen = plans_tabular._model(spark, SF)
    assert 1 < model.getNumTrees < 1000
    mean = train.where("Year < 1999").agg(F.avg("spend")).first()[0]
    for r in run(spark, "r6_boosted_trees"):
        own = unseen.where(F.col("Year") == r["Year"])
        plain = math.sqrt(own.agg(F.avg(F.pow(F.col("spend") - mean, 2))).first()[0])
        assert r["rmse"] < 0.6 * plain and r["n"] == own.count()


def test_a_fit_that_still_gains_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(I, "MAX_TREES", 2)
    train = plans_tabular.customer_years(spark, SF).where("Year <= 1999")
    with pytest.raises(RuntimeError, match="still falls"):
        I.fit_trees(train, plans_tabular.FEATURES, "spend", F.col("Year") == 1999)


def test_search_keeps_the_better_trials(spark):
    train = plans_tabular.customer_years(spark, SF).where("Year <= 1999")
    model, table = I.search_trees(train, plans_tabular.FEATURES, "spend", F.col("Year") == 1999, trials=8, first=1, keep=2, last=2, parallelism=8)
    rows = table.collect()
    rungs = [sorted((r["rmse"], r["trial"]) for r in rows if r["rung"] == k) for k in range(3)]
    assert [len(r) for r in rungs] == [8, 4, 2] and {r["trees"] for r in rows if r["rung"] == 1} == {2}
    for before, after in zip(rungs, rungs[1:]):
        assert {t for _, t in after} == {t for _, t in before[: len(after)]}
    (best,) = I.best_tree_trial(table).collect()
    assert best["rmse"] == rungs[2][0][0] and model.getNumTrees == best["trees"]
    assert json.loads(best["parameters"]) == I.tree_trials(8)[best["trial"]] and len(I.tree_trials()) == 96


def test_importance_scores_and_sweep(spark):
    rise = {r["feature"]: r["rise"] for r in run(spark, "r8_permutation_importance")}
    assert set(rise) == set(plans_tabular.FEATURES) and max(rise, key=rise.get) in ("n", "mean_price") and rise["n"] > 0
    scored = run(spark, "r9_score_unseen_years")
    years = plans_tabular.customer_years(spark, SF)
    assert len(scored) == years.count() and sum(r["predicted"] for r in scored) == years.where("Year > 1999").count()
    sweep = sorted(run(spark, "r10_what_if_sweep"), key=lambda r: r["n"])
    assert [r["n"] for r in sweep] == [1, 2, 3, 5, 8] and sweep[-1]["2000"] > sweep[0]["2000"]


# forecasts -----------------------------------------------------------------------------------------------------------


def test_two_breaks_are_found():
    rng = np.random.default_rng(1)
    days = np.arange(1000.0)
    t = days / 999
    season = np.hstack([P._fourier(days, 7.0, P.WEEKLY_TERMS), P._fourier(days, 365.25, P.YEARLY_TERMS)])
    trend = 50 + 40 * t - 120 * np.maximum(t - 0.3, 0) + 150 * np.maximum(t - 0.6, 0)
    y = trend + 4 * season[:, 0] + 6 * season[:, 7] + rng.normal(0, 0.5, 1000)
    line, at, changes = P.fit_trend(t, y, season)
    assert np.abs(P.trend_at(t, line, at, changes) - trend).max() < 3
    big = at[np.abs(changes) > 20]
    assert all(np.abs(big - b).min() < 0.05 for b in (0.3, 0.6)) and all(min(abs(x - 0.3), abs(x - 0.6)) < 0.08 for x in big)
    got = P.fit_series(days, y, np.append(days, 1000 + np.arange(60.0)))
    assert np.abs(got["trend"][-60:] - (trend[-1] + 70 / 999 * np.arange(1, 61))).max() < 4


def test_straight_series_stay_straight():
    rng = np.random.default_rng(2)
    t = np.linspace(0, 1, 600)
    season = np.zeros((600, 0))
    y = 10 + 5 * t + rng.normal(0, 1, 600)
    line, at, changes = P.fit_trend(t, y, season)
    slope, level = np.polyfit(t, y, 1)
    assert np.abs(P.trend_at(t, line, at, changes) - (level + slope * t)).max() < 0.5
    # a large penalty leaves the least-squares line exactly
    line, at, changes = P.fit_trend(t, y, season, change_scale=1e-9)
    assert not changes.any() and line == pytest.approx([level, slope])


def test_lasso_against_its_closed_form():
    rng = np.random.default_rng(3)
    a = rng.normal(size=(50, 1))
    y = rng.normal(size=50)
    for penalty in (0.0, 1.0, 5.0, 1e3):
        c, g = float(a[:, 0] @ y), float(a[:, 0] @ a[:, 0])
        assert P.lasso(a.T @ a, a.T @ y, penalty)[0] == pytest.approx(math.copysign(max(abs(c) - penalty, 0) / g, c), abs=1e-12)
    a = rng.normal(size=(80, 6))
    x = P.lasso(a.T @ a, a.T @ rng.normal(size=80), 3.0)
    assert len(x) == 6
    x = P.lasso(a.T @ a, a.T @ (a @ [3, 0, 0, -2, 0, 0.01]), 0.0)
    assert x == pytest.approx([3, 0, 0, -2, 0, 0.01], abs=1e-7)
    y = rng.normal(size=80) * 3
    x = P.lasso(a.T @ a, a.T @ y, 8.0)
    slope = a.T @ (y - a @ x)  # optimality: at the penalty where a value is not zero, within it elsewhere
    assert np.all(np.abs(slope) <= 8 + 1e-6) and slope[x != 0] == pytest.approx(8 * np.sign(x[x != 0]), abs=1e-6)


def test_forecast_queries(spark):
    history = plans_forecast.history(spark, SF)
    sizes = {(r["store"], r["item"]): r["n"] for r in history.groupBy("store", "item").agg(F.count("*").alias("n")).collect()}
    rows = run(spark, "q2_forecast_groups")
    seen = {}
    for r in rows:
        seen[r["store"], r["item"]] = seen.get((r["store"], r["item"]), 0) + 1
        scale = math.copysign(1, r["trend"]) if r["trend"] else 1
        assert r["yhat_lower"] <= r["yhat"] <= r["yhat_upper"] and math.isfinite(r["yhat"])
        assert (r["yhat"] - r["trend"]) * scale == pytest.approx((r["weekly"] + r["yearly"]) * max(abs(r["trend"]), 1e-9), abs=1e-6) or abs(r["trend"]) < 0.1 * abs(r["yhat"]) + 3
    assert seen == {k: n + 90 for k, n in sizes.items()}
    parts = {(r["store"], r["item"], r["ds"]): (r["trend"], r["weekly"], r["yearly"]) for r in run(spark, "q7_components")}
    assert parts == {(r["store"], r["item"], r["ds"]): (r["trend"], r["weekly"], r["yearly"]) for r in rows}
    errors = {}
    for r in rows:
        if r["y"] is not None and r["ds"] < dt.date(2000, 1, 1):
            errors.setdefault((r["store"], r["item"]), []).append(r["y"] - r["yhat"])
    for r in run(spark, "q5_forecast_metrics"):
        own = np.array(errors[r["store"], r["item"]])
        assert (r["mae"], r["mse"], r["rmse"]) == pytest.approx((np.abs(own).mean(), (own**2).mean(), math.sqrt((own**2).mean())))
    one = run(spark, "q3_single_series")
    days = history.groupBy("ds").count().count()
    assert len(one) == days + 90 and sum(r["y"] is None for r in one) == 90


# clocks and topics ---------------------------------------------------------------------------------------------------


def test_clock_stamps(spark):
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    for r in run(spark, "h2_clock_stamps"):
        for value in r:
            if isinstance(value, dt.datetime):
                assert abs(value.replace(tzinfo=None) - now) < dt.timedelta(hours=1)
            elif isinstance(value, dt.date):
                assert abs(value - now.date()) <= dt.timedelta(days=1)


def test_topic_queries_agree(spark):
    rows = run(spark, "n7_principal_topic")
    assert rows and all(0 <= r["topic"] < 9 and 1 / 9 - 1e-9 <= r["probability"] <= 1 for r in rows)
    counts = {r["topic"]: r["statements"] for r in run(spark, "n6_topic_model")}
    assert counts == {t: sum(r["topic"] == t for r in rows) for t in {r["topic"] for r in rows}}
    clear = {}
    for r in rows:
        if r["probability"] > 0.5:
            clear.setdefault(r["source"], [0] * 9)[r["topic"]] += 1
    spans = [(min(c[t] for c in clear.values()), max(c[t] for c in clear.values())) for t in range(9)]
    for r in run(spark, "n8_topic_focus"):
        for t, (lo, hi) in enumerate(spans):
            assert r[str(t)] == pytest.approx((clear[r["source"]][t] - lo) / (hi - lo) if hi > lo else 0.0)
    for r in run(spark, "n9_topic_focus_score"):
        t = int(r["topic"])
        values = [c[t] for c in clear.values()]
        below = [i for i in range(1, 10) if np.quantile(values, i / 10) < clear[r["source"]][t] - 1e-9]
        assert r["n"] == clear[r["source"]][t] and r["score"] == 10 * max(below, default=1)
    terms = run(spark, "n10_topic_terms")
    for t in range(9):
        own = [r["weight"] for r in terms if r["topic"] == t]
        assert 0 < len(own) <= 200 and sum(own) <= 1 + 1e-9 and min(own) > 0


def words_of(seed, topics, rows, words):
    rng = np.random.default_rng(seed)
    mix = rng.dirichlet([0.1] * topics, rows)
    shares = rng.dirichlet([0.05] * 120, topics)
    return [[f"w{w}" for w in rng.choice(120, size=words, p=m @ shares)] for m in mix], shares


def mean_word_likelihood(counts, shares):
    """Mean ln p of a word under fixed topics, each row with its own best mixture (expectation-maximisation)."""
    total = 0.0
    for row in counts:
        mix = np.full(len(shares), 1 / len(shares))
        for _ in range(200):
            joint = mix[:, None] * shares
            mix = (joint / np.maximum(joint.sum(axis=0), 1e-300) * row).sum(axis=1)
            mix /= mix.sum()
        total += row @ np.log(np.maximum(mix @ shares, 1e-300))
    return total / counts.sum()


def test_topics_are_no_worse_than_the_library_ones(spark):
    from pyspark.ml.clustering import LDA
    from pyspark.ml.feature import CountVectorizer

    texts, _ = words_of(4, 4, 240, 60)
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "row LONG, tokens ARRAY<STRING>").repartition(4)
    held = Z.corpus(rows, "row", "tokens")
    assert held.rows == 240
    own = Z.fit_topics(held, k=4)
    names = [f"w{i}" for i in range(120)]
    weights = {r["term"]: r["w"] for r in own.collect()}
    mine = np.array([[weights[n][j] if n in weights else 1e-9 for n in names] for j in range(4)])
    vectoriser = CountVectorizer(inputCol="tokens", outputCol="features", minDF=1.0).fit(rows)
    model = LDA(k=4, optimizer="online", seed=42, learningDecay=0.3, subsamplingRate=0.5, maxIter=20, featuresCol="features").fit(vectoriser.transform(rows))
    matrix = model.topicsMatrix().toArray()
    place = {w: i for i, w in enumerate(vectoriser.vocabulary)}
    theirs = np.array([[matrix[place[n], j] if n in place else 1e-9 for n in names] for j in range(4)])
    counts = np.array([[t.count(n) for n in names] for t in texts], float)
    scores = [mean_word_likelihood(counts, w / w.sum(axis=1, keepdims=True)) for w in (mine, theirs)]
    assert scores[0] >= scores[1] - 0.01, scores
    shares = {r["row"]: r["topicDistribution"] for r in Z.topic_distributions(held, own, k=4).collect()}
    assert len(shares) == 240 and all(sum(s) == pytest.approx(1) for s in shares.values())


def test_blocks_do_not_change_the_topics(spark):
    texts, _ = words_of(6, 3, 60, 30)
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(99, [])], "row LONG, tokens ARRAY<STRING>").repartition(3)
    whole = Z.corpus(rows, "row", "tokens")
    cut = Z.corpus(rows, "row", "tokens", entries=50)
    # numbers of terms differ between the two, weights do not depend on them here
    start = lambda c: c.vocabulary.select("term", "id", F.array(*[(F.pmod(F.xxhash64("term", F.lit(j)), F.lit(97)) + 1).cast("double") for j in range(3)]).alias("w"))
    found = [{r["row"]: r["topicDistribution"] for r in Z.topic_distributions(c, start(c), k=3).collect()} for c in (whole, cut)]
    assert set(found[0]) == set(found[1]) and 99 not in found[0]
    for row, share in found[0].items():
        assert share == pytest.approx(found[1][row], abs=0.02)
    assert cut.blocks.count() > 5 * whole.blocks.count()


def test_blocks_grow_with_the_corpus(spark, monkeypatch):
    monkeypatch.setattr(Z, "BLOCK_ENTRIES", (20, 100_000))
    monkeypatch.setattr(Z, "BLOCKS", 4)
    texts, _ = words_of(6, 3, 60, 30)
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "row LONG, tokens ARRAY<STRING>").repartition(3)
    held = Z.corpus(rows, "row", "tokens")
    assert held.rows == 60 and held.blocks.count() <= 4 + int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_rows_of_any_length_get_their_own_topics(monkeypatch):
    from tallyspark.operators.lifetime_fit import digamma

    rng = np.random.default_rng(8)
    sizes = [1, 7, 40, 3, 3, 90, 1]
    ends = np.append(0, np.cumsum(sizes)).astype(np.int32)
    places, counts = rng.integers(0, 50, ends[-1]).astype(np.int32), rng.integers(1, 4, ends[-1]).astype(float)
    words = rng.dirichlet([0.1] * 50, 4).T + 1e-6
    for chunk in (1, 64, 1 << 17):  # less than a row, a few rows, all
        monkeypatch.setattr(Z, "CHUNK", chunk)
        gamma, share = Z.row_topics(ends, places, counts, words, 0.25)
        for i, size in enumerate(sizes):
            at, g, moved, rounds = slice(ends[i], ends[i + 1]), np.ones(4), 1.0, 0
            while moved >= 1e-3 or rounds % 8:
                theta = np.exp(digamma(g) - digamma(g.sum()))
                ratio = counts[at] / (words[places[at]] @ theta)
                after = 0.25 + theta * (ratio @ words[places[at]])
                moved, g, rounds = np.abs(after - g).mean(), after, rounds + 1
            assert gamma[i] == pytest.approx(g, rel=1e-9) and share[at] == pytest.approx(ratio, rel=1e-9)


def test_a_step_moves_only_what_its_blocks_ask_for(spark, monkeypatch):
    """Weights stay dealt by term: they are written after every fifth step, and no step reads a table of them again."""
    texts, _ = words_of(6, 3, 60, 30)
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "row LONG, tokens ARRAY<STRING>").repartition(3)
    held = Z.corpus(rows, "row", "tokens", entries=50)
    written, write = [], Z.materialize
    monkeypatch.setattr(Z, "materialize", lambda df, label, *more: written.append(label) or write(df, label, *more))
    weights = Z.fit_topics(held, k=3)
    assert written == ["topic-weights"] * 2
    terms = {t for text in texts for t in text}
    assert {r["term"] for r in weights.collect()} == terms and weights.count() == len(terms)


def test_a_path_evaluates_few_candidates(spark, monkeypatch):
    rng = np.random.default_rng(3)
    rows = [(float(x), float(rng.uniform(1, 60)) if x else 0.0, float(rng.uniform(60, 90)), float(rng.integers(1, 5))) for x in rng.integers(0, 6, 300)]
    cells = spark.createDataFrame(rows, "x DOUBLE, tx DOUBLE, t DOUBLE, n DOUBLE")
    asked, sums = [], fit.likelihood_sums
    monkeypatch.setattr(fit, "likelihood_sums", lambda c, candidates, **k: asked.append(len(candidates)) or sums(c, candidates, **k))
    fitted = fit.fit_lifetimes(cells, [("bgnbd", 0.02 + 0.02 * i) for i in range(24)])
    assert all(f.converged and f.gradient <= fit.TOLERANCE for f in fitted)
    assert sum(asked) < 24 * 15  # one round of three steps and their slopes for every trial alone would be that


def test_a_path_to_the_edge_evaluates_few_candidates(monkeypatch):
    """Buyers who never leave: parameters of leaving run to zero, where slope and curvature vanish together."""
    rng = np.random.default_rng(4)
    t = rng.uniform(6, 10, 300)
    times = [np.cumsum(rng.exponential(1 / rate, 200)) for rate in rng.gamma(2.0, 1.0, 300)]
    x = np.array([float((s <= end).sum()) for s, end in zip(times, t)])
    d = {"x": x, "tx": np.array([s[int(n) - 1] if n else 0.0 for s, n in zip(times, x)]), "t": t}
    asked = []

    def sums(cells, candidates, **_):
        asked.append(len(candidates))
        found = [fit.SLOPES[m](theta, cells) for m, theta in candidates]
        return np.array([v.mean() for v, _ in found]), np.array([[b.mean() for b in by] for _, by in found])

    monkeypatch.setattr(fit, "likelihood_sums", sums)
    plan = [(m, l2) for l2 in np.linspace(0.05, 0.95, 12).tolist() for m in ("bgnbd", "pareto")]
    with np.errstate(all="ignore"):
        fitted = fit.fit_path(d, plan, fit.STARTS)
    assert all(f.converged and f.gradient <= fit.TOLERANCE for f in fitted) and sum(asked) < 450
    for model in ("bgnbd", "pareto"):
        line = [f.log_likelihood for (m, _), f in zip(plan, fitted) if m == model]
        assert all(b < a for a, b in zip(line, line[1:]))
