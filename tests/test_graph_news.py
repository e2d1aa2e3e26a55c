import datetime as dt
import random
from collections import Counter
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyspark.operators import graph as G
from tallyspark.operators import news as N
from tallyspark.operators import risk as K


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def pairs_by_hand(mentions, blocked, limit):
    by_url = {}
    for url, org in mentions:
        if org is not None and org not in blocked:
            by_url.setdefault(url, []).append(org)
    counts = Counter((a, b) for orgs in by_url.values() for a, b in product(orgs, orgs) if a != b)
    return sorted((a, b, n) for (a, b), n in counts.items() if n > limit)


@pytest.mark.parametrize("limit", [0, 2, 5])
def test_co_mentions_against_pairs(spark, limit, monkeypatch):
    monkeypatch.setattr(G, "BLOCK", 2)  # long articles are cut in blocks
    mentions = [(i % 4 if i % 7 else None, f"o{(i * i) % 9}") for i in range(60)] + [(1, "reuters"), (1, "o1"), (1, "o1"), (8, "o1"), (9, None)]
    df = spark.createDataFrame(mentions, "url INT, organisation STRING")
    assert rows(G.co_mentions(df, limit, ["reuters"])) == pairs_by_hand(mentions, {"reuters"}, limit)


def chain(spark):
    links = [(1, 2), (2, 3), (3, 4), (4, 5), (5, 6), (7, 8)]
    return spark.createDataFrame(links + [(b, a) for a, b in links], "src INT, dst INT")


def test_hops_and_depth_filter(spark):
    marks = spark.createDataFrame([(1,), (3,)], "id INT")
    got = {(r["id"], r["landmark"]): r["distance"] for r in G.hop_distances(chain(spark), marks).collect()}
    assert got[(6, 1)] == 5 and got[(5, 1)] == 4 and got[(1, 1)] == 0 and got[(6, 3)] == 3 and (7, 1) not in got
    near, edges = G.within_hops(chain(spark), spark.createDataFrame([(1,)], "id INT"), 4)
    assert {r[0] for r in near.collect()} == {1, 2, 3, 4, 5} and edges.count() == 8


@pytest.mark.parametrize("hub_edges", [2, 100_000])
def test_hops_of_many_landmarks(spark, monkeypatch, hub_edges):
    monkeypatch.setattr(G, "HUB_EDGES", hub_edges)
    rng = random.Random(5)
    links = {(rng.randrange(140), rng.randrange(140)) for _ in range(230)} | {(0, v) for v in range(1, 40)}
    marks = list(range(150))  # more than two groups of 64; some have no edge at all
    near = {m: {m: 0} for m in marks}
    for m in marks:
        todo = [m]
        while todo:
            following = [a for b in todo for a, c in links if c == b and a not in near[m]]
            for a in following:
                near[m].setdefault(a, near[m][todo[0]] + 1)
            todo = list(dict.fromkeys(following))
    edges = spark.createDataFrame(list(links), "src LONG, dst LONG")
    got = G.hop_distances(edges, spark.createDataFrame([(m,) for m in marks], "id LONG").repartition(3))
    assert {(r["id"], r["landmark"]): r["distance"] for r in got.collect()} == {(v, m): d for m in marks for v, d in near[m].items()}
    assert G.hop_distances(edges.limit(0), spark.createDataFrame([(1,)], "id LONG")).collect() == [(1, 1, 0)]


def _exact_ranks(links, marks, vertices):
    at = {v: i for i, v in enumerate(vertices)}
    out = Counter(a for a, _ in links)
    step = np.zeros((len(at), len(at)))
    for a, b in links:
        step[at[b], at[a]] += 0.85 / out[a]
    solved = np.linalg.inv(np.eye(len(at)) - step)
    return {m: dict(zip(vertices, 0.15 * solved[:, at[m]])) for m in marks}


@pytest.mark.parametrize("hub_edges,block_edges,kind,tolerance", [(100_000, 200_000, "LONG", 1e-10), (5, 60, "STRING", 1e-3)])
def test_pushed_ranks_are_exact(spark, monkeypatch, hub_edges, block_edges, kind, tolerance):
    monkeypatch.setattr(G, "HUB_EDGES", hub_edges)
    rng = random.Random(hub_edges + block_edges)
    links = [(rng.randrange(60), rng.randrange(60)) for _ in range(260)] + [(0, v) for v in range(1, 30)] + [(v, 77) for v in range(5)]  # 77 is a sink
    links += links[:9]  # repeated edges count
    marks, vertices = [0, 3, 77, 99], sorted({v for e in links for v in e} | {99})
    name = (lambda v: f"v{v}") if kind == "STRING" else (lambda v: v)
    edges = spark.createDataFrame([(name(a), name(b)) for a, b in links], f"src {kind}, dst {kind}")
    got = {(r[0], r[1]): r[2] for r in G.push_ranks(edges, spark.createDataFrame([(name(m),) for m in marks], f"id {kind}"), block_edges=block_edges, tolerance=tolerance, normalise=False).collect()}
    want = _exact_ranks(links, marks, vertices)
    for m in marks:
        assert sum(abs(got.get((name(m), name(v)), 0.0) - r) for v, r in want[m].items()) < tolerance
    assert {k for k in got if k[0] == name(99)} == {(name(99), name(99))}


def test_pushed_ranks_edges(spark):
    edges = spark.createDataFrame([(1, 2), (2, 1)], "src LONG, dst LONG")
    none = spark.createDataFrame([], "id LONG")
    assert G.push_ranks(edges, none).count() == 0 and G.push_ranks(edges.limit(0), none).count() == 0
    assert [tuple(r) for r in G.push_ranks(edges.limit(0), spark.createDataFrame([(1,)], "id LONG")).collect()] == [(1, 1, 1.0)]
    with pytest.raises(RuntimeError):
        G.push_ranks(edges, spark.createDataFrame([(1,)], "id LONG"), block_edges=1, max_rounds=2)


def test_ranks_sum_to_one_and_match_dense_iteration(spark, monkeypatch):
    monkeypatch.setattr(G, "HUB_EDGES", 2)  # every vertex with more than two edges counts as a hub
    links = [(1, 2), (1, 3), (1, 4), (1, 5), (2, 1), (3, 1), (4, 1), (5, 6)]  # 6 is a sink
    got = {(r["organisation"], r["connection"]): r["importance"] for r in G.personalised_ranks(
        spark.createDataFrame(links, "src INT, dst INT"), spark.createDataFrame([(1,), (2,)], "id INT"), iterations=7, cut_every=3).collect()}
    out = Counter(a for a, _ in links)
    for s in (1, 2):
        rank = {v: float(v == s) for v in range(1, 7)}
        for _ in range(7):
            rank = {v: 0.15 * (v == s) + 0.85 * sum(rank[a] / out[a] for a, b in links if b == v) for v in rank}
        total = sum(rank.values())
        for v, r in rank.items():
            assert got.get((s, v), 0.0) == pytest.approx(r / total)
        assert sum(x for (o, _), x in got.items() if o == s) == pytest.approx(1.0)


def test_enrich_keeps_only_required_class(spark):
    schema = "publishDate DATE, organisations ARRAY<STRING>, documentIdentifier STRING, themes ARRAY<STRING>, locations ARRAY<STRUCT<countryCode: STRING>>, tone STRUCT<tone: DOUBLE>"
    data = [
        (dt.date(2024, 1, 1), ["JPMorgan Chase", "Acme"], "u1", ["ENV_X", "ECON_Y"], [("UK",), ("ZZ",), ("UK",)], (1.5,)),
        (dt.date(2024, 1, 1), ["Acme"], "u2", ["ENV_X"], [("UK",)], (1.0,)),
        (dt.date(2024, 1, 1), ["Acme"], "u3", None, [("UK",)], (1.0,)),
    ]
    got = rows(N.enrich(spark.createDataFrame(data, schema), {"jp morgan chase": ["jpmorgan", "jp morgan"]}, {"UK": "GBR"}))
    assert [(r[1], r[2], r[3], r[4], r[5]) for r in got] == [("acme", "u1", ["GBR"], ["E", "G"], 1.5), ("jp morgan chase", "u1", ["GBR"], ["E", "G"], 1.5)]


def test_scores_thresholds_and_propagation(spark):
    data = [(dt.date(2024, 1, d), o, "E", float(t), 1) for d in range(1, 5) for o, t in (("a", 3), ("b", 1))] + [(dt.date(2024, 1, 1), "c", "E", 9.0, 1)]
    gold = spark.createDataFrame(data, "date DATE, organisation STRING, theme STRING, tone DOUBLE, total BIGINT")
    got = {r["organisation"]: r["esg"] for r in N.internal_scores(gold, 3, 3).collect()}
    first = (3 + 1 + 9) / 3
    assert got == pytest.approx({"a": ((3 - first) + 3 * 1) / 4, "b": ((1 - first) - 3 * 1) / 4})
    importance = spark.createDataFrame([("a", "a", 0.75), ("a", "b", 0.25), ("a", "x", 0.9)], "organisation STRING, connection STRING, importance DOUBLE")
    contrib = N.contributions(N.internal_scores(gold, 3, 3), importance)
    assert N.propagated_scores(contrib).first()["esg"] == pytest.approx(0.75 * got["a"] + 0.25 * got["b"])
    assert [r["connection"] for r in N.detractors(contrib, "a", "E").collect()] == ["b"]


def test_portfolio_fan_out_and_value_at_risk(spark):
    portfolio = spark.createDataFrame([("s1", "a"), ("s2", "a"), ("s3", "b")], "symbol STRING, organisation STRING")
    scores = spark.createDataFrame([("a", "E", 1.0), ("b", "E", 2.0)], "organisation STRING, theme STRING, esg DOUBLE")
    assert K.portfolio_scores(portfolio, scores).count() == 3
    days = spark.range(101).select(F.lit("AAA").alias("rating"), F.col("id").alias("date"), (F.col("id") / 100).alias("return"))
    assert K.value_at_risk(days).first()["var"] == pytest.approx(0.05)


def test_ranks_of_a_dense_graph_take_few_rounds(spark):
    rng = random.Random(8)
    links = {(rng.randrange(40), rng.randrange(40)) for _ in range(400)}
    links |= {(b, a) for a, b in links}
    edges = spark.createDataFrame(list(links), "src LONG, dst LONG")
    got = {r[1]: r[2] for r in G.push_ranks(edges, spark.createDataFrame([(3,)], "id LONG"), block_edges=20, max_rounds=24, normalise=False).collect()}
    want = _exact_ranks(list(links), [3], sorted({a for a, _ in links} | {3}))[3]
    assert sum(abs(got.get(v, 0.0) - r) for v, r in want.items()) < 1e-11


def test_shuffles_grow_in_number_not_in_size(spark, monkeypatch):
    from tallyspark import session

    monkeypatch.setattr(session, "ROWS_PER_TASK", 10)
    mentions = spark.createDataFrame([(i % 30, f"o{i % 13}") for i in range(200)], "url INT, organisation STRING")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    pairs = G.co_mentions(mentions, 0)
    assert len(pairs.inputFiles()) > int(before) and spark.conf.get("spark.sql.shuffle.partitions") == before


def test_sized_shuffles_are_not_merged_to_one_task_per_core(spark, monkeypatch):
    from tallyspark import session

    name, before = "spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions")
    cores = spark.sparkContext.defaultParallelism
    monkeypatch.setattr(session, "ROWS_PER_TASK", 50)
    spark.conf.set(name, str(8 * cores))  # enough for the rows, so only the merging is in question
    try:
        rows = 50 * 6 * cores
        keyed = spark.range(rows).selectExpr("id * 7 AS k")
        counted = keyed.groupBy("k").count()
        assert len(session.materialize(counted, "counted", rows).inputFiles()) > 4 * cores
        assert session.spread(keyed, rows, "k").groupBy("k").count().rdd.getNumPartitions() == 8 * cores
        assert spark.conf.get(name) == str(8 * cores) and spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled") == "true"
    finally:
        spark.conf.set(name, before)


@pytest.mark.parametrize("steps,most", [(8, 100_000), (8, 3), (1, 100_000)])
def test_edges_out_of_reach_are_not_sent_along(spark, monkeypatch, steps, most):
    monkeypatch.setattr(G, "REACH_STEPS", steps)
    monkeypatch.setattr(G, "REACH_MOST", most)
    sizes, write = [], G.materialize
    monkeypatch.setattr(G, "materialize", lambda df, label, rows=0: sizes.append((label, df.count())) or write(df, label, rows))
    rng = random.Random(4)
    near = [(rng.randrange(30), rng.randrange(30)) for _ in range(150)] + [(30, v) for v in range(3)]  # an edge into it is out of reach too
    links = near + [(a + 100 * k, b + 100 * k) for k in range(1, 6) for a, b in near]
    edges = spark.createDataFrame(links + [(None, 1), (1, None)], "src LONG, dst LONG")
    got = {r[1]: r[2] for r in G.push_ranks(edges, spark.createDataFrame([(3,), (3,), (None,)], "id LONG"), normalise=False).collect()}
    want = _exact_ranks(near + [(1, -1)], [3], sorted({v for e in near for v in e} | {-1}))[3]  # the edge to nowhere takes its part
    assert sum(abs(got.get(v, 0.0) - r) for v, r in want.items() if v >= 0) < 1e-11 and all(0 <= v < 30 for v in got)
    kept = [n for label, n in sizes if label == "links"]
    assert kept == ([151] if (steps, most) == (8, 100_000) else [])


@pytest.mark.parametrize("listed", [0, 3, 64])
@pytest.mark.parametrize("limit", [0, 3, 11])
def test_pairs_built_in_rows_and_by_join_are_the_same(spark, monkeypatch, listed, limit):
    monkeypatch.setattr(G, "LISTED", listed)
    rng = random.Random(limit)
    mentions = [(rng.choice([None, *range(12)]), f"o{min(rng.randrange(9), rng.randrange(9))}") for _ in range(150)]
    mentions += [(50 + k, f"alone{k % 2}") for k in range(30)] + [(50, "weak"), (99, "weak"), (99, "o1"), (5, None)]
    df = spark.createDataFrame(mentions, "url INT, organisation STRING")
    assert rows(G.co_mentions(df, limit)) == pairs_by_hand(mentions, set(), limit)
    orgs = sorted({o for _, o in mentions if o})
    mean = sum(n for _, _, n in pairs_by_hand(mentions, set(), -1)) / (len(orgs) * (len(orgs) - 1))
    assert G.usual_weight(df) == int(mean + 1.4 * mean**0.5)
