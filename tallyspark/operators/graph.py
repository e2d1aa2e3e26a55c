"""Company graph: co-mention edges, hop distances, personalised ranking.

Loops write each round to the shared folder and read it back, so a lost executor costs one round and plans stay
short. The driver sees one number per round.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize, partitions, scratch, tasks_for

BLOCK = 512  # organisations per block when one article's pairs are spread over tasks
LISTED = 64  # organisations of an article whose pairs are built in one row
HUB_EDGES = 100_000  # edges of one vertex per task
BLOCK_EDGES = 1_000_000  # edges one task sends ranks along
LANE_ROWS = 50_000  # rows of ranks for one task
LANE = 4  # landmarks in one row
MEMORY = 6  # rounds whose ranks are combined
REACH_STEPS, REACH_MOST = 8, 100_000  # steps, and vertices of one step, up to which edges out of reach are looked for


def mention_counts(mentions: DataFrame, blocked: Sequence = (), url: str = "url", organisation: str = "organisation") -> tuple[DataFrame, DataFrame]:
    """(url, org, c), the mentions per article and organisation, and (url, all, squares, orgs, some), one row per article; both are written once."""
    named = mentions.select(F.col(url).alias("url"), F.col(organisation).alias("org")).where(F.col("org").isNotNull())
    if blocked:
        named = named.where(~F.col("org").isin(list(blocked)))
    counts = materialize(named.groupBy("url", "org").agg(F.count(F.lit(1)).alias("c")), "mentions", mentions.count())
    sums = [F.sum("c").alias("all"), F.sum(F.col("c") * F.col("c")).alias("squares"), F.count(F.lit(1)).alias("orgs"), F.max("org").alias("some")]
    return counts, materialize(counts.groupBy("url").agg(*sums), "articles", counts.count())


def co_mentions(mentions: DataFrame, min_weight: int, blocked: Sequence = (), url: str = "url", organisation: str = "organisation") -> DataFrame:
    """(src, dst, relationship) for organisations sharing articles more than ``min_weight`` times, both directions."""
    return shared_mentions(*mention_counts(mentions, blocked, url, organisation), min_weight)


def shared_mentions(counts: DataFrame, articles: DataFrame, min_weight: int) -> DataFrame:
    """`co_mentions` of counted mentions.

    relationship = Σ over articles of mentions(src) · mentions(dst). Mentions are counted per (article, organisation)
    first, which also tames repeated rows. An organisation's possible weight is bounded by what it shares with all
    others together, and those who cannot pass the threshold leave before pairs are built. A pair is built once and
    mirrored after the filter: in the row of its article, or, where that has more than ``LISTED`` organisations, by a
    join with the left side split in blocks. NULL articles form one group.
    """
    pairs_built = F.sum(F.col("orgs") * (F.col("orgs") - 1) / 2)
    most = int(articles.agg(pairs_built).first()[0] or 0)  # one number
    counts = _without_weak(counts, articles, min_weight)
    long = materialize(articles.where(F.col("orgs") > min(LISTED, BLOCK)).select(F.struct("url").alias("article"), F.ceil(F.col("orgs") / BLOCK).cast("int").alias("blocks")), "long")
    counts = counts.withColumn("article", F.struct("url")).drop("url")  # a struct around the article is never NULL, so keys are plain
    some_long = not long.isEmpty()
    short = counts.join(long, "article", "left_anti") if some_long else counts
    listed = short.groupBy("article").agg(F.array_sort(F.collect_list(F.struct("org", "c"))).alias("m")).where(F.size("m") > 1)
    inner = "flatten(transform(m, (x, i) -> transform(slice(m, i + 2, size(m)), y -> struct(x.org AS a, y.org AS b, x.c * y.c AS w))))"
    pairs = listed.select(F.inline(F.expr(inner)))
    if some_long:
        kept = counts.join(long, "article")
        left = kept.select("article", F.col("org").alias("a"), F.col("c").alias("ca"), F.pmod(F.xxhash64("org"), F.col("blocks")).cast("int").alias("block"))
        right = kept.select(F.col("article").alias("_a"), F.col("org").alias("b"), F.col("c").alias("cb"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("_block"))
        same = (F.col("article") == F.col("_a")) & (F.col("block") == F.col("_block")) & (F.col("a") < F.col("b"))
        pairs = pairs.unionByName(left.join(right, same).select("a", "b", (F.col("ca") * F.col("cb")).alias("w")))
    pairs = pairs.groupBy("a", "b").agg(F.sum("w").alias("relationship")).where(F.col("relationship") > min_weight)
    pairs = materialize(pairs, "pairs", most)
    both = F.array(F.struct(F.col("a").alias("src"), F.col("b").alias("dst")), F.struct(F.col("b").alias("src"), F.col("a").alias("dst")))
    return pairs.select(F.explode(both).alias("e"), "relationship").select("e.src", "e.dst", "relationship")


def _without_weak(counts: DataFrame, articles: DataFrame, min_weight: int) -> DataFrame:
    """Counts of the organisations that share more than ``min_weight`` with all others together.

    Each article with others in it is worth one or more, so the exact sum is only needed for those with few such articles.
    """
    alone = articles.where("orgs = 1").groupBy(F.col("some").alias("org")).agg(F.count(F.lit(1)).alias("alone"))
    each = counts.groupBy("org").agg(F.count(F.lit(1)).alias("n")).join(alone, "org", "left")
    doubtful = materialize(each.where(F.col("n") - F.coalesce("alone", F.lit(0)) <= min_weight).select("org"), "doubtful")
    if doubtful.isEmpty():
        return counts
    totals = articles.where("orgs > 1").select(F.struct("url").alias("article"), "all")
    shared = counts.join(doubtful, "org", "left_semi").withColumn("article", F.struct("url")).join(totals, "article")
    able = shared.groupBy("org").agg(F.sum(F.col("c") * (F.col("all") - F.col("c"))).alias("bound")).where(F.col("bound") > min_weight)
    weak = materialize(doubtful.join(able, "org", "left_anti"), "weak")
    return counts.join(weak, "org", "left_anti")


def usual_weight(mentions: DataFrame, blocked: Sequence = (), deviations: float = 1.4, url: str = "url", organisation: str = "organisation") -> int:
    """Whole part of the mean weight over all pairs of organisations plus so many of its square roots."""
    return usual_shared_weight(*mention_counts(mentions, blocked, url, organisation), deviations)


def usual_shared_weight(counts: DataFrame, articles: DataFrame, deviations: float = 1.4) -> int:
    """`usual_weight` of counted mentions.

    An edge threshold that follows the data. The sum over pairs is (all mentions)² less the squares of each
    organisation's own, article by article, so no pair is built.
    """
    total = articles.agg(F.sum(F.col("all") * F.col("all") - F.col("squares"))).first()[0] or 0
    n = counts.agg(F.countDistinct("org")).first()[0]
    mean = total / (n * (n - 1)) if n > 1 else 0.0
    return math.floor(mean + deviations * math.sqrt(mean))


def vertices(scores: DataFrame) -> DataFrame:
    return scores.select(F.col("organisation").alias("id")).distinct()


def between(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges with both ends among the nodes."""
    src, dst = nodes.select(F.col("id").alias("src")), nodes.select(F.col("id").alias("dst"))
    return edges.join(src, "src", "left_semi").join(dst, "dst", "left_semi")


def landmarks_in(nodes: DataFrame, names: Sequence) -> DataFrame:
    return nodes.where(F.col("id").isin(list(names))).select("id")


def _split_hubs(links: DataFrame, key: str, other: str) -> tuple[DataFrame, DataFrame]:
    """Links with a `part` for each HUB_EDGES rows of a key, and the keys that have several parts (at most links / HUB_EDGES)."""
    sizes = links.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > HUB_EDGES)
    hubs = materialize(sizes.select(F.col(key).alias("_hub"), F.ceil(F.col("_n") / HUB_EDGES).cast("int").alias("parts")), "hubs")
    part = F.pmod(F.xxhash64(other), F.coalesce("parts", F.lit(1))).cast("int")
    return links.join(hubs, F.col(key) == F.col("_hub"), "left").withColumn("part", part).drop("_hub", "parts"), hubs


def _to_parts(rows: DataFrame, hubs: DataFrame, key: str) -> DataFrame:
    """Each row once for every part of its key."""
    parts = F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1))
    return rows.join(hubs, F.col(key) == F.col("_hub"), "left").withColumn("part", parts).drop("_hub", "parts")


def hop_distances(edges: DataFrame, landmarks: DataFrame, max_hops: int | None = None) -> DataFrame:
    """(id, landmark, distance): fewest edges from a vertex to each landmark it can reach.

    Level by level for 64 landmarks at a time: a vertex has one row per group of 64, with a bit for each landmark that has
    reached it and the bits set at this level. Rows with fresh bits move along the edges, an edge of a hub in the part that
    holds it; what arrives and what is known meet in one aggregate. Each level is one folder of a table partitioned by
    distance. Stops when a level sets no bit.
    """
    spark = edges.sparkSession
    out = scratch(spark, "hops")
    kind = landmarks.schema["id"].dataType.simpleString()
    state = f"id {kind}, grp LONG, known LONG, fresh LONG"
    links = edges.select("src", F.col("dst").alias("_to")).distinct()
    links, hubs = _split_hubs(materialize(links, "links"), "_to", "src")
    links = links.repartition("_to", "part").persist(StorageLevel.MEMORY_AND_DISK)
    # 64 consecutive numbers are one group; numbers of different tasks never share one
    numbered = materialize(landmarks.select(F.col("id").alias("landmark")).distinct().withColumn("n", F.monotonically_increasing_id()), "landmarks")
    numbered = numbered.select("landmark", F.shiftright("n", 6).alias("grp"), F.expr("shiftleft(1L, int(n & 63))").alias("bit"))
    numbered.groupBy(F.col("landmark").alias("id"), "grp").agg(F.bit_or("bit").alias("fresh")).select("id", "grp", F.col("fresh").alias("known"), "fresh").write.parquet(f"{out}/distance=0")
    level = 0
    while max_hops is None or level < max_hops:
        before = spark.read.schema(state).parquet(f"{out}/distance={level}")
        moving = _to_parts(before.where("fresh <> 0").select(F.col("id").alias("_to"), "grp", "fresh"), hubs, "_to")
        arrived = links.join(moving, ["_to", "part"]).select(F.col("src").alias("id"), "grp", F.lit(0).cast("long").alias("known"), "fresh")
        both = arrived.unionByName(before.select("id", "grp", "known", F.lit(0).cast("long").alias("fresh")))
        level += 1
        met = both.groupBy("id", "grp").agg(F.bit_or("known").alias("old"), F.bit_or("fresh").alias("new"))
        met.selectExpr("id", "grp", "old | new AS known", "new & ~old AS fresh").write.parquet(f"{out}/distance={level}")
        if spark.read.schema(state).parquet(f"{out}/distance={level}").where("fresh <> 0").isEmpty():
            break
    links.unpersist()
    levels = spark.read.schema(f"{state}, distance INT").parquet(out).where("fresh <> 0")
    return levels.join(numbered, "grp").where("fresh & bit <> 0").select("id", "landmark", "distance")


def within_hops(edges: DataFrame, landmarks: DataFrame, hops: int = 4) -> tuple[DataFrame, DataFrame]:
    """Vertices at most ``hops`` from any landmark, and the edges between them."""
    near = materialize(hop_distances(edges, landmarks, hops).select("id").distinct(), "near")
    return near, between(edges, near)


def personalised_ranks(
    edges: DataFrame, landmarks: DataFrame, iterations: int = 100, reset: float = 0.15, tolerance: float | None = None, cut_every: int = 5, normalise: bool = True
) -> DataFrame:
    """(organisation, connection, importance): PageRank of every vertex seen from each landmark.

    A vertex passes its rank in equal parts along its edges; edge weights do not count. Ranks are kept sparse, one row
    per (vertex, landmark) reached so far. Edges of a hub are spread over several tasks. With ``tolerance`` the loop
    stops once a round between two cuts moves less than that per landmark. Ranks of a landmark sum to 1 at the end.
    """
    spark = edges.sparkSession
    degree = edges.groupBy("src").agg(F.count(F.lit(1)).alias("degree"))
    parts = F.ceil(F.col("degree") / HUB_EDGES).cast("int")
    links = edges.select("src", "dst").join(degree, "src").withColumn("part", F.pmod(F.xxhash64("dst"), parts).cast("int"))
    links = materialize(links, "links").repartition("src", "part").persist(StorageLevel.MEMORY_AND_DISK)
    # only vertices with more edges than one task should take; at most edges / HUB_EDGES rows
    hubs = materialize(degree.where(F.col("degree") > HUB_EDGES).select(F.col("src").alias("id"), parts.alias("parts")), "hubs")
    start = landmarks.select("id", F.col("id").alias("landmark")).distinct()
    start = materialize(start, "landmarks")
    ranks, before, done = start.withColumn("rank", F.lit(1.0)), None, 0
    while done < iterations:
        steps = min(cut_every, iterations - done)
        for step in range(steps):
            if tolerance is not None and step == steps - 1 and step:
                ranks = materialize(ranks, "ranks")  # read twice: by the round and by its difference
            before = ranks
            spread = ranks.join(hubs, "id", "left").withColumn("part", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)))
            sent = spread.withColumnRenamed("id", "src").join(links, ["src", "part"]).select(
                F.col("dst").alias("id"), "landmark", (F.col("rank") / F.col("degree") * (1 - reset)).alias("rank")
            )
            ranks = sent.unionByName(start.withColumn("rank", F.lit(float(reset)))).groupBy("id", "landmark").agg(F.sum("rank").alias("rank"))
            done += 1
        if tolerance is None:
            ranks = materialize(ranks, "ranks")
            continue
        both = ranks.join(before.withColumnRenamed("rank", "_before"), ["id", "landmark"], "left")
        both = materialize(both.withColumn("_moved", F.abs(F.col("rank") - F.coalesce("_before", F.lit(0.0)))).drop("_before"), "ranks")
        moved = both.groupBy("landmark").agg(F.sum("_moved").alias("m")).agg(F.max("m")).first()[0]
        ranks = both.drop("_moved")
        if moved is None or moved < tolerance:
            break
    links.unpersist()
    if normalise:
        totals = ranks.groupBy("landmark").agg(F.sum("rank").alias("_sum"))
        ranks = ranks.join(totals, "landmark").withColumn("rank", F.col("rank") / F.col("_sum")).drop("_sum")
    return ranks.select(F.col("landmark").alias("organisation"), F.col("id").alias("connection"), F.col("rank").alias("importance"))


def push_ranks(edges: DataFrame, landmarks: DataFrame, reset: float = 0.15, tolerance: float = 1e-12, block_edges: int = BLOCK_EDGES, max_rounds: int = 1000, normalise: bool = True) -> DataFrame:
    """(organisation, connection, importance): PageRank of every vertex seen from each landmark, to a total error of ``tolerance``.

    A round sends ranks x along all edges once, which yields g = reset at the landmark + what arrives, and the residual g - x. The
    next x is the combination of the last ``MEMORY`` g whose residuals, combined in the same way, are least (Anderson's method); the
    driver sees the products of residuals, some numbers a round. The loop ends when the residual of every landmark sums to less than
    tolerance * reset, which bounds the error, or raises after ``max_rounds``.

    Edges that no landmark leads to leave first. A vertex has one row for ``LANE`` landmarks, from the round on in which it is reached. Edges stay where they are, dealt by source
    (a hub's by part) to tasks of about ``block_edges``; only ranks, summed by task and vertex, are shuffled.
    """
    spark = edges.sparkSession
    id_kind = edges.schema["src"].dataType.simpleString()
    start = materialize(landmarks.select(F.col("id").cast(id_kind).alias("id")).where("id IS NOT NULL").distinct(), "landmarks")
    numbered = materialize(start.withColumn("n", F.monotonically_increasing_id()), "numbers")
    numbered = numbered.select(F.col("id").alias("landmark"), F.floor(F.col("n") / LANE).alias("lane"), F.pmod("n", F.lit(LANE)).cast("int").alias("place"))
    if numbered.isEmpty():
        return spark.createDataFrame([], f"organisation {id_kind}, connection {id_kind}, importance DOUBLE")
    edges = _within_reach(edges.select("src", "dst").where("src IS NOT NULL"), start)
    degree = materialize(edges.groupBy("src").agg(F.count(F.lit(1)).alias("degree")), "degree")
    parts = F.ceil(F.col("degree") / HUB_EDGES).cast("int")
    hubs = materialize(degree.where(F.col("degree") > HUB_EDGES).select(F.col("src").alias("_hub"), parts.alias("parts")), "hubs")
    dealt = edges.join(degree, "src").select("src", F.pmod(F.xxhash64("dst"), parts).cast("int").alias("part"), "dst", (F.lit(1 - reset) / F.col("degree")).alias("share"))
    lanes, usual = -(-start.count() // LANE), tasks_for(spark, 0)
    few = max(spark.sparkContext.defaultParallelism, -(-lanes * degree.count() // LANE_ROWS))  # a round of a small graph is as long as its tasks are many
    tasks = max(min(few, usual), -(-edges.count() // block_edges))
    links = dealt.repartition(tasks, "src", "part").persist(StorageLevel.MEMORY_AND_DISK)
    whole = hubs.isEmpty()

    # past: of each remembered round, the latest first, g and the residual in LANE numbers each; zero before a row was reached
    places, kept = range(LANE), 2 * LANE * (MEMORY - 1)
    reach = ", ".join(f"IF(place = {c}, {float(reset)!r}D, 0D)" for c in places)
    state = materialize(numbered.selectExpr("landmark AS id", "lane", "place", f"concat(array({reach}, {reach}), array_repeat(0D, {kept})) AS past"), "ranks")
    rank = "+".join(f"mix[{k}] * past[{2 * LANE * k} + c]" for k in range(MEMORY))
    arrived = ", ".join(f"IF(place <=> {c}, {float(reset)!r}D, 0D) + coalesce(s[{c}], 0D)" for c in places)
    products, done = np.zeros((MEMORY, MEMORY)), 0
    try:
        with partitions(spark, tasks):
            while True:
                left, row = _residuals(state)
                products[1:, 1:] = products[:-1, :-1].copy()
                products[0, :] = products[:, 0] = row
                if left <= tolerance * reset:
                    break
                if done == max_rounds:
                    raise RuntimeError(f"residuals still sum to {left} after {max_rounds} rounds")
                mix = np.zeros(MEMORY)
                mix[: done + 1] = _least_mix(products[: done + 1, : done + 1])
                mixed = state.withColumn("mix", F.lit(mix.tolist()))
                now = mixed.select("id", "lane", "place", "past", F.expr(f"transform(sequence(0, {LANE - 1}), c -> {rank})").alias("x"))
                moving = now.select(F.col("id").alias("src"), "lane", "x")
                moving = moving.withColumn("part", F.lit(0)) if whole else _to_parts(moving, hubs, "src")
                # the ranks of a task's own sources are few beside its edges, so they are hashed and the edges are never sorted
                sent = links.join(moving.hint("shuffle_hash"), ["src", "part"]).groupBy(F.col("dst").alias("id"), "lane").agg(F.array(*[F.sum(F.col("x")[c] * F.col("share")) for c in places]).alias("s"))
                met = now.join(sent.where("id IS NOT NULL"), ["id", "lane"], "full").withColumn("g", F.expr(f"array({arrived})"))
                fresh = f"zip_with(g, coalesce(x, array_repeat(0D, {LANE})), (a, b) -> a - b)"
                earlier = f"coalesce(slice(past, 1, {kept}), array_repeat(0D, {kept}))"
                state = materialize(met.selectExpr("id", "lane", "place", f"concat(g, {fresh}, {earlier}) AS past"), "ranks")
                done += 1
    finally:
        links.unpersist()
    tall = state.select("id", "lane", F.posexplode(F.slice("past", 1, LANE)).alias("place", "rank")).where("rank <> 0")
    ranks = tall.withColumn("rank", F.greatest("rank", F.lit(0.0))).join(numbered, ["lane", "place"])
    if normalise:
        totals = ranks.groupBy("landmark").agg(F.sum("rank").alias("_sum"))
        ranks = ranks.join(totals, "landmark").withColumn("rank", F.col("rank") / F.col("_sum"))
    return ranks.select(F.col("landmark").alias("organisation"), F.col("id").alias("connection"), F.col("rank").alias("importance"))


def _within_reach(edges: DataFrame, start: DataFrame) -> DataFrame:
    """Edges that a path from ``start`` leads to, or all edges where that takes many steps or many vertices at a step."""
    known = fresh = start
    for _ in range(REACH_STEPS):
        step = edges.join(fresh.select(F.col("id").alias("src")), "src", "left_semi").select(F.col("dst").alias("id")).where("id IS NOT NULL").distinct()
        fresh = materialize(step.join(known, "id", "left_anti"), "reached")
        found = fresh.count()
        if not found:
            return materialize(edges.join(known.select(F.col("id").alias("src")), "src", "left_semi"), "links")
        if found > REACH_MOST:
            break
        known = known.unionByName(fresh)
    return edges


def _residuals(state: DataFrame) -> tuple[float, list[float]]:
    """Largest sum of a landmark's latest residuals, and the product of the latest residuals with each remembered round's."""
    at = lambda k, c: f"past[{2 * LANE * k + LANE + c}]"
    sums = [F.expr(f"sum(abs({at(0, c)}))").alias(f"l{c}") for c in range(LANE)]
    dots = [F.expr("sum(" + "+".join(f"{at(0, c)} * {at(k, c)}" for c in range(LANE)) + ")").alias(f"d{k}") for k in range(MEMORY)]
    top = F.max(F.greatest(*[f"l{c}" for c in range(LANE)]))
    row = state.groupBy("lane").agg(*sums, *dots).agg(top, *[F.sum(f"d{k}") for k in range(MEMORY)]).first()
    return row[0], list(row)[1:]


def _least_mix(products: np.ndarray) -> np.ndarray:
    """Weights that sum to one and make the weighted sum of residuals least, from their products."""
    plain = np.eye(len(products))[0]
    sizes = np.sqrt(np.diag(products))
    if not (sizes > 0).all():
        return plain
    values, vectors = np.linalg.eigh(products / np.outer(sizes, sizes))
    keep = values > 1e-13 * values[-1]
    weights = (vectors[:, keep] / values[keep]) @ (vectors[:, keep].T @ (1 / sizes)) / sizes
    return weights / weights.sum() if np.isfinite(weights).all() and weights.sum() > 0 else plain


def size_report(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    n = nodes.agg(F.count(F.lit(1)).alias("vertices"))
    return n.withColumn("edges", edges.agg(F.count(F.lit(1))).scalar())
