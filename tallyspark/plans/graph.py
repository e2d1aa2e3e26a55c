"""Company graph queries over co-mentions of suppliers in orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import graph as G
from ..operators import news as N
from ..session import materialize
from ..sources.tables import news
from .news import SCORES, scores
from .registry import query, rnd

# bindings (fixed values): suppliers that stand for blocked names and for landmarks
BLOCKED = [3, 4]
LANDMARKS = [1, 7, 12]

COUNTS = "(SELECT l_orderkey AS u, l_suppkey AS o, count(*) AS c FROM lineitem WHERE l_suppkey NOT IN (3, 4) GROUP BY 1, 2)"
MIN_WEIGHT = f"""(SELECT floor(m + 1.4::DOUBLE * sqrt(m)) FROM (SELECT CAST(w AS DOUBLE) / (n * (n - 1)) AS m FROM
      (SELECT sum(w) AS w FROM (SELECT sum(c) * sum(c) - sum(c * c) AS w FROM {COUNTS} GROUP BY u)), (SELECT count(DISTINCT l_suppkey) AS n FROM lineitem WHERE l_suppkey NOT IN (3, 4))))"""

EDGES = f"""(SELECT a.o AS src, b.o AS dst, CAST(sum(a.c * b.c) AS BIGINT) AS relationship FROM
      {COUNTS} a JOIN {COUNTS} b ON a.u = b.u AND a.o <> b.o
      GROUP BY 1, 2 HAVING sum(a.c * b.c) > {MIN_WEIGHT})"""


def co_mentions(spark, sf):
    counts, articles = G.mention_counts(news(spark, sf), BLOCKED)
    return G.shared_mentions(counts, articles, G.usual_shared_weight(counts, articles))


def edges(spark, sf):
    return co_mentions(spark, sf)  # its pairs are a written table


def landmarks(spark, e):
    return G.landmarks_in(e.select(F.col("src").alias("id")).distinct(), LANDMARKS)


@query("o5_co_mention_edges", f"SELECT * FROM {EDGES}")
def o5(spark, sf):
    return co_mentions(spark, sf)


@query("o6_vertices", f"SELECT DISTINCT organisation AS id FROM {SCORES}")
def o6(spark, sf):
    return G.vertices(scores(spark, sf))


@query("o6_edges_between_vertices", f"SELECT * FROM {EDGES} WHERE src IN (SELECT organisation FROM {SCORES}) AND dst IN (SELECT organisation FROM {SCORES})")
def o6_edges(spark, sf):
    return G.between(edges(spark, sf), materialize(G.vertices(scores(spark, sf)), "vertices"))


@query("o7_landmarks_present", f"SELECT DISTINCT src AS id FROM {EDGES} WHERE src IN (1, 7, 12)")
def o7(spark, sf):
    return landmarks(spark, co_mentions(spark, sf))


HOPS = f"""WITH RECURSIVE e AS MATERIALIZED (SELECT src, dst FROM {EDGES}),
      h AS (SELECT DISTINCT src AS id, src AS landmark, 0 AS distance FROM e WHERE src IN (1, 7, 12)
        UNION SELECT e.src, h.landmark, h.distance + 1 FROM h JOIN e ON e.dst = h.id WHERE h.distance < 8),
      d AS (SELECT id, landmark, CAST(min(distance) AS INTEGER) AS distance FROM h GROUP BY 1, 2)"""


@query("o8_hop_distances", f"{HOPS} SELECT * FROM d")
def o8(spark, sf):
    e = edges(spark, sf)
    return G.hop_distances(e, landmarks(spark, e))


for _name, _hops in (("o9_within_two_hops", 2), ("o9_within_four_hops", 4)):
    query(_name, f"{HOPS}, k AS (SELECT DISTINCT id FROM d WHERE distance <= {_hops}) SELECT src, dst FROM e WHERE src IN (SELECT id FROM k) AND dst IN (SELECT id FROM k)")(
        lambda spark, sf, hops=_hops: within(spark, sf, hops).select("src", "dst")
    )


def within(spark, sf, hops):
    e = edges(spark, sf)
    return G.within_hops(e, landmarks(spark, e), hops)[1]


# rank = 0.15 * sum of 0.85^k * (walks of k steps); what comes after 200 steps is below 1e-14
RANKS = f"""WITH RECURSIVE e AS MATERIALIZED (SELECT src, dst FROM {EDGES}), g AS MATERIALIZED (SELECT src, count(*) AS n FROM e GROUP BY 1),
      w AS (SELECT DISTINCT 0 AS k, src AS id, src AS landmark, 0.15::DOUBLE AS m FROM e WHERE src IN (1, 7, 12)
        UNION ALL SELECT w.k + 1, e.dst, w.landmark, sum(0.85 * w.m / g.n) FROM w JOIN e ON e.src = w.id JOIN g ON g.src = w.id WHERE w.k < 200 GROUP BY w.k, e.dst, w.landmark),
      s AS (SELECT landmark, id, sum(m) AS m FROM w GROUP BY 1, 2),
      i AS (SELECT landmark AS organisation, id AS connection, m / sum(m) OVER (PARTITION BY landmark) AS importance FROM s)"""


def importance(spark, e):
    return G.push_ranks(e, landmarks(spark, e))


@query("o10_personalised_ranks", f"{RANKS} SELECT organisation, connection, round(importance, 8) + 0.0 AS importance FROM i")
def o10(spark, sf):
    return importance(spark, edges(spark, sf)).withColumn("importance", rnd("importance", 8))


@query("o10_converged_ranks", f"""{RANKS} SELECT organisation, CAST(count(*) AS BIGINT) AS connections, round(max(importance), 7) + 0.0 AS top, round(sum(importance), 6) + 0.0 AS total FROM i GROUP BY 1""")
def o10_converged(spark, sf):
    r = importance(spark, edges(spark, sf))
    return r.groupBy("organisation").agg(F.count("*").alias("connections"), rnd(F.max("importance"), 7).alias("top"), rnd(F.sum("importance"), 6).alias("total"))


@query("o11_landmark_importance", f"{RANKS} SELECT connection, round(importance, 8) + 0.0 AS importance FROM i WHERE organisation = 7 AND connection <> 7 ORDER BY round(i.importance, 9) DESC, connection LIMIT 20")
def o11(spark, sf):
    i = importance(spark, edges(spark, sf)).where("organisation = 7 AND connection <> 7")
    return i.orderBy(F.desc(F.round("importance", 9)), "connection").limit(20).select("connection", rnd("importance", 8).alias("importance"))


CONTRIB = f"{RANKS}, c AS (SELECT i.organisation, i.connection, s.theme, s.esg, i.importance FROM i JOIN {SCORES} s ON s.organisation = i.connection)"


def contributions(spark, sf):
    return N.contributions(scores(spark, sf), importance(spark, edges(spark, sf)))


@query("o12_contributions", f"{CONTRIB} SELECT organisation, connection, theme, round(esg, 8) + 0.0 AS esg, round(importance, 8) + 0.0 AS importance FROM c")
def o12(spark, sf):
    return contributions(spark, sf).withColumns({c: rnd(c, 8) for c in ("esg", "importance")})


@query("o13_propagated_scores", f"{CONTRIB} SELECT organisation, theme, round(sum(esg * importance) / sum(importance), 8) + 0.0 AS esg FROM c GROUP BY 1, 2")
def o13(spark, sf):
    return N.propagated_scores(contributions(spark, sf)).withColumn("esg", rnd("esg", 8))


@query("o14_detractors", f"{CONTRIB} SELECT connection, round(importance, 8) + 0.0 AS importance, round(esg, 8) + 0.0 AS esg FROM c WHERE organisation = 7 AND theme = 'R' AND esg < (SELECT esg FROM c WHERE organisation = 7 AND connection = 7 AND theme = 'R')")
def o14(spark, sf):
    contrib = materialize(contributions(spark, sf), "contributions")
    return N.detractors(contrib, 7, "R").withColumns({c: rnd(c, 8) for c in ("esg", "importance")})


@query("o15_graph_size", f"SELECT CAST(count(DISTINCT src) AS BIGINT) AS vertices, CAST(count(*) AS BIGINT) AS edges FROM {EDGES}")
def o15(spark, sf):
    e = edges(spark, sf)
    return G.size_report(e.select(F.col("src").alias("id")).distinct(), e)
