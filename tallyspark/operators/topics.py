"""Text and topic operators."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text as X
from ..session import materialize, tasks_for
from .quantiles import exact_quantiles, min_max_scale
from .relational import distinct_values


def top_n_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """First n rows per key. Spark keeps n rows per key in each map task before the shuffle (window group limit)."""
    ranked = df.withColumn("_rk", F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col("_rk") <= n).drop("_rk")


def extract_statements(docs: DataFrame, text: str, dash_continues: bool = False, min_length: int = 50) -> DataFrame:
    """One row per sentence longer than ``min_length``, in place of the text column."""
    rest = [c for c in docs.columns if c != text]
    exploded = docs.where(F.col(text).isNotNull()).select(*rest, F.explode(X.statements(text, dash_continues)).alias("statement"))
    return exploded.where(F.length("statement") > min_length)


def stop_words(companies: DataFrame, company: str, base: Sequence[str] = X.COMMON_STOP_WORDS, domain: Sequence[str] = X.DOMAIN_STOP_WORDS) -> DataFrame:
    """Distinct words to ignore: common words, domain words and the words of company names."""
    fixed = companies.sparkSession.createDataFrame([(w,) for w in [*base, *domain]], "word STRING")
    names = companies.select(company).distinct().select(F.explode(F.split(F.lower(company), " ")).alias("word"))
    return fixed.union(names).where("word <> ''").distinct()


def term_counts(docs: DataFrame, tokens: str, keys: Sequence[str] = (), stops: DataFrame | None = None) -> DataFrame:
    """(keys…, term, n). Terms are counted before stop words are taken out, so the anti join sees few rows.

    The outer explode keeps the planner from adding a size filter that would tokenise each text a second time.
    """
    terms = docs.select(*keys, F.explode_outer(tokens).alias("term")).where("term IS NOT NULL")
    counts = terms.groupBy(*keys, "term").agg(F.count(F.lit(1)).alias("n"))
    return counts if stops is None else counts.join(stops.select(F.col("word").alias("term")), "term", "left_anti")


@dataclass(frozen=True)
class Corpus:
    """Rows of text as blocks of term numbers, and the terms with their numbers and counts. Both are tables in the shared folder."""

    blocks: DataFrame
    vocabulary: DataFrame
    rows: int


BLOCK = "block LONG, rows ARRAY<LONG>, ends ARRAY<INT>, places ARRAY<INT>, counts ARRAY<DOUBLE>, terms ARRAY<LONG>"
BLOCK_ENTRIES = (200_000, 2_000_000)  # least and most entries of a block
BLOCKS = 48  # blocks of a corpus whose blocks are between these sizes


def corpus(docs: DataFrame, row: str, tokens: str, stops: DataFrame | None = None, entries: int | None = None) -> Corpus:
    """Count vectors over every term that is not in ``stops``, dealt to blocks of about so many ``entries``.

    Terms get their numbers where they are counted, so there is no list of them on the driver and no limit to their number.
    A block names each of its terms once; its entries point into that list. Without ``entries`` blocks grow with the corpus:
    each step of a fit moves a term once for every block it is in.
    """
    counts = materialize(term_counts(docs, tokens, [row], stops).withColumnRenamed(row, "row"), "term-counts")
    if entries is None:
        entries = min(max(BLOCK_ENTRIES[0], counts.count() // BLOCKS), BLOCK_ENTRIES[1])
    vocabulary = materialize(counts.groupBy("term").agg(F.sum("n").alias("n")).withColumn("id", F.monotonically_increasing_id()), "vocabulary")
    coded = counts.join(vocabulary.select("term", "id"), "term").select(F.col("row").cast("long").alias("row"), "id", F.col("n").cast("double").alias("n"))
    blocks = materialize(coded.repartition("row").sortWithinPartitions("row", "id").mapInArrow(partial(_cut_blocks, entries=entries), BLOCK), "blocks")
    return Corpus(blocks, vocabulary, blocks.agg(F.sum(F.size("rows"))).first()[0] or 0)


def _cut_blocks(batches: Iterator[pa.RecordBatch], entries: int) -> Iterator[pa.RecordBatch]:
    held: list[pa.RecordBatch] = []
    names = [c.split()[0] for c in BLOCK.split(", ")]
    part, number = TaskContext.get().partitionId(), 0

    def block(whole: pa.RecordBatch) -> pa.RecordBatch:
        nonlocal number
        row, term, n = (whole.column(i).to_numpy() for i in range(3))
        starts = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1])))
        terms, places = np.unique(term, return_inverse=True)
        values = ((part << 32) + number, row[starts], np.append(starts, len(row)).astype(np.int32), places.astype(np.int32), n, terms)
        number += 1
        types = (pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.float64()), pa.list_(pa.int64()))
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types)], names)

    size = 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size < entries:
            continue
        whole = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        row = whole.column(0).to_numpy()
        first = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1])))
        done = 0
        for stop in first[1:]:  # the last row may go on
            if stop - done >= entries:
                yield block(whole.slice(done, int(stop) - done))
                done = int(stop)
        held, size = [whole.slice(done)], whole.num_rows - done
    if size:
        yield block(pa.Table.from_batches(held).combine_chunks().to_batches()[0])


def _digamma(z: np.ndarray) -> np.ndarray:
    """Derivative of ln Γ for positive z: a shift by eight, its terms taken in pairs, and a series. Called for every row and round."""
    y, q = z + 8, z * (z + 7)
    v = 1 / (y * y)
    series = v * (1 / 12 - v * (1 / 120 - v * (1 / 252 - v * (1 / 240 - v / 132))))
    return np.log(y) - 0.5 / y - series - (2 * z + 7) * (1 / q + 1 / (q + 6) + 1 / (q + 10) + 1 / (q + 12))


def expected_logs(weights: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """exp E[log p] of Dirichlet weights whose sum over the other axis is given."""
    return np.exp(_digamma(weights) - _digamma(totals))


CHUNK = 1 << 17  # entries, with padding, whose rows move together


def row_topics(ends: np.ndarray, places: np.ndarray, counts: np.ndarray, words: np.ndarray, alpha: float, tolerance: float = 1e-3, most: int = 200) -> tuple[np.ndarray, np.ndarray]:
    """Variational weights of every row's topics, and of every entry the expected count over the sum of its topics.

    Rows of about the same length, padded to the longest, move together; those whose mean change falls below ``tolerance`` stop.
    """
    number, k = len(ends) - 1, words.shape[1]
    gamma, share = np.ones((number, k)), np.zeros(len(places))
    sizes = np.diff(ends)
    order = np.argsort(sizes, kind="stable")
    first = 0
    while first < number:
        near = order[first : first + CHUNK]
        rows = near[: max(1, np.count_nonzero(sizes[near] * np.arange(1, len(near) + 1) <= CHUNK))]
        first += len(rows)
        width = np.arange(sizes[rows[-1]])
        real = width < sizes[rows][:, None]
        entry = np.where(real, ends[rows][:, None] + width, 0)
        b, n, g = words[places[entry]], np.where(real, counts[entry], 0.0), np.ones((len(rows), k))
        for turn in range(most):
            for _ in range(8):  # the rows that still move are gathered anew from time to time
                before = g
                theta = expected_logs(g, g.sum(axis=1, keepdims=True))
                ratio = n / np.maximum((b @ theta[:, :, None])[:, :, 0], 1e-300)
                g = alpha + theta * (ratio[:, None, :] @ b)[:, 0, :]
            moving = np.abs(g - before).mean(axis=1) >= tolerance
            if turn == most - 1:
                moving[:] = False
            if moving.all():
                continue
            still = ~moving
            gamma[rows[still]], share[entry[still][real[still]]] = g[still], ratio[still][real[still]]
            if not moving.any():
                break
            rows, real, entry, b, n, g = (x[moving] for x in (rows, real, entry, b, n, g))
    return gamma, share


def _block_parts(block: pa.Table, weights: pa.Table) -> tuple[np.ndarray, ...]:
    rows, ends, places, counts, terms = (block.column(c)[0].values.to_numpy() for c in ("rows", "ends", "places", "counts", "terms"))
    order = np.argsort(weights.column("id").to_numpy())
    flat = weights.column("w").combine_chunks().flatten().to_numpy().reshape(len(order), -1)[order]
    return rows, ends, places, counts, terms, flat


def _term_statistics(block: pa.Table, weights: pa.Table, totals: list[float], alpha: float) -> pa.Table:
    """(id, s): expected counts of each term of a block in each topic."""
    if not block.num_rows or not weights.num_rows:
        return pa.table({"id": pa.array([], pa.int64()), "s": pa.array([], pa.list_(pa.float64()))})
    _, ends, places, counts, terms, flat = _block_parts(block, weights)
    words = expected_logs(flat, np.array(totals))
    gamma, share = row_topics(ends, places, counts, words, alpha)
    theta = expected_logs(gamma, gamma.sum(axis=1, keepdims=True))[np.repeat(np.arange(len(ends) - 1), np.diff(ends))]
    sums = np.stack([np.bincount(places, share * theta[:, j], len(terms)) for j in range(words.shape[1])], axis=1) * words
    return pa.table({"id": terms, "s": pa.FixedSizeListArray.from_arrays(sums.ravel(), words.shape[1]).cast(pa.list_(pa.float64()))})


def _distributions(block: pa.Table, weights: pa.Table, totals: list[float], alpha: float) -> pa.Table:
    if not block.num_rows or not weights.num_rows:
        return pa.table({"row": pa.array([], pa.int64()), "topicDistribution": pa.array([], pa.list_(pa.float64()))})
    rows, ends, places, counts, _, flat = _block_parts(block, weights)
    gamma, _ = row_topics(ends, places, counts, expected_logs(flat, np.array(totals)), alpha)
    share = gamma / gamma.sum(axis=1, keepdims=True)
    return pa.table({"row": rows, "topicDistribution": pa.FixedSizeListArray.from_arrays(share.ravel(), share.shape[1]).cast(pa.list_(pa.float64()))})


def _beside(blocks: DataFrame, weights: DataFrame, work: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
    """Run ``work`` on each block and the weights of its own terms."""
    wanted = blocks.select(F.col("block").alias("to"), F.explode("terms").alias("id")).join(weights.select("id", "w"), "id")
    return _paired(blocks, wanted, work, schema)


def _paired(blocks: DataFrame, wanted: DataFrame, work: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
    return blocks.groupBy("block").cogroup(wanted.groupBy("to")).applyInArrow(lambda block, own: work(block, own), schema)


def _topic_totals(weights: DataFrame, k: int) -> list[float]:
    return [float(v or 0.0) for v in weights.agg(*[F.sum(F.col("w")[j]).alias(f"t{j}") for j in range(k)]).first()]  # one number per topic


CUT_EVERY = 5  # steps between two written tables of weights: a plan doubles with each step since the last one


def fit_topics(texts: Corpus, k: int = 9, seed: int = 42, decay: float = 0.3, parts: int = 2, passes: int = 5) -> DataFrame:
    """Online variational topic model: (term, id, w: weight of the term in each topic).

    The topic weights are a table with one row per term and never leave the executors. Each step takes one of ``parts`` equal
    shares of the blocks, brings every block the weights of its own terms, and sums the expected counts by term; a step of
    number t moves the weights by (1 + t) ** -decay towards what its share asks for. ``passes`` times all rows take part.

    Blocks stay where they are, and so do the weights, dealt by term and each with the numbers of its term's blocks: a step
    shuffles only the weights that its blocks ask for and the counts that come back. Every fifth step the weights are written,
    so a lost executor costs no more than five.
    """
    spark = texts.blocks.sparkSession
    alpha = eta = 1.0 / k
    turned = texts.blocks.withColumn("turn", F.pmod(F.xxhash64("block"), F.lit(parts)).cast("int") if parts > 1 else F.lit(0))
    found = turned.groupBy("turn").agg(F.sum(F.size("rows")).alias("n"), F.count(F.lit(1)).alias("blocks"), F.sum(F.size("terms")).alias("pairs")).collect()  # one row per part
    sizes = {r["turn"]: r["n"] for r in found}
    dealt = turned.repartition(max(tasks_for(spark, 0), 2 * sum(r["blocks"] for r in found)), "block").persist(StorageLevel.MEMORY_AND_DISK)
    tasks = tasks_for(spark, sum(r["pairs"] for r in found))
    noise = [F.sqrt(-2 * F.log(_uniform("id", seed, 2 * j))) * F.cos(2 * math.pi * _uniform("id", seed, 2 * j + 1)) for j in range(k)]
    start = texts.vocabulary.select("id", F.array(*[F.greatest(F.lit(0.01), 1 + 0.1 * x) for x in noise]).alias("w")).repartition(tasks, "id")
    within = turned.select(F.explode("terms").alias("id"), F.struct("turn", "block").alias("p")).repartition(tasks, "id").groupBy("id").agg(F.collect_list("p").alias("within"))
    weights = start.join(within.hint("merge"), "id", "left").persist(StorageLevel.MEMORY_AND_DISK)  # ``within`` is no longer than the list of blocks
    totals, step = _topic_totals(weights, k), 0
    for _ in range(passes):
        for turn, size in sorted(sizes.items()):
            work = partial(_term_statistics, totals=totals, alpha=alpha)
            wanted = weights.select("id", "w", F.explode(F.filter("within", lambda p: p["turn"] == turn)).alias("p")).select(F.col("p.block").alias("to"), "id", "w")
            asking = _paired(dealt.where(F.col("turn") == turn).drop("turn"), wanted, work, "id LONG, s ARRAY<DOUBLE>").repartition(tasks, "id")
            sums = asking.groupBy("id").agg(F.array(*[F.sum(F.col("s")[j]) for j in range(k)]).alias("s"))
            rate = (1 + step) ** -decay if len(sizes) > 1 else 1.0
            asked = lambda w, s: (1 - rate) * w + rate * (eta + texts.rows / size * F.coalesce(s, F.lit(0.0)))
            before, moved = weights, weights.join(sums.hint("merge"), "id", "left")
            weights = moved.select("id", F.array(*[asked(F.col("w")[j], F.col("s")[j]) for j in range(k)]).alias("w"), "within").persist(StorageLevel.MEMORY_AND_DISK)
            totals = _topic_totals(weights, k)  # fills the persisted rows
            before.unpersist()
            step += 1
            if step % CUT_EVERY == 0 and step < passes * len(sizes):
                before, weights = weights, materialize(weights, "topic-weights").repartition(tasks, "id").persist(StorageLevel.MEMORY_AND_DISK)
                weights.count()
                before.unpersist()
    out = materialize(texts.vocabulary.select("term", "id").join(weights.select("id", "w"), "id").select("term", "id", "w"), "topic-weights")
    weights.unpersist()
    dealt.unpersist()
    return out


def _uniform(key: str, seed: int, number: int) -> Column:
    """A number between 0 and 1, both excluded, that the key, the seed and a number decide."""
    return (F.pmod(F.xxhash64(F.col(key), F.lit(seed), F.lit(number)), F.lit(1 << 52)).cast("double") + 0.5) / float(1 << 52)


def topic_distributions(texts: Corpus, weights: DataFrame, k: int = 9) -> DataFrame:
    """(row, topicDistribution) of every row that has terms."""
    work = partial(_distributions, totals=_topic_totals(weights, k), alpha=1.0 / k)
    return _beside(texts.blocks, weights, work, "row LONG, topicDistribution ARRAY<DOUBLE>")


def principal_topic(distributed: DataFrame, column: str = "topicDistribution") -> DataFrame:
    """Most likely topic of each row (0-based) and its probability."""
    return distributed.withColumns({
        "probability": F.array_max(column), "topic": (F.array_position(column, F.array_max(column)) - 1).cast("int"),
    }).drop(column)


def focus_counts(rows: DataFrame, company: str, topic: str, topics: Sequence | None = None, probability: str | None = None, threshold: float = 0.5) -> DataFrame:
    """Company × topic counts of rows with a clear topic; 0 where there is none."""
    clear = rows if probability is None else rows.where(F.col(probability) > threshold)
    topics = distinct_values(clear, topic) if topics is None else topics
    return clear.groupBy(company).pivot(topic, list(topics)).count().fillna(0)


def focus_scaled(counts: DataFrame, company: str) -> DataFrame:
    return min_max_scale(counts, [c for c in counts.columns if c != company])


def industry_deciles(counts: DataFrame, topics: Sequence[str]) -> DataFrame:
    """(topic, prob, value): deciles over companies of each topic's count."""
    return exact_quantiles(counts, topics, [round(0.1 * i, 1) for i in range(1, 10)]).withColumnRenamed("column", "topic")


def focus_score(company_counts: DataFrame, deciles: DataFrame, topic: str = "topic", n: str = "n") -> DataFrame:
    """100 · the last decile whose threshold is below the count, as a whole number; 10 if there is none.

    ``company_counts`` has (…, topic, n). The deciles are nine rows per topic, folded into one array before the join.
    """
    steps = deciles.groupBy("topic").agg(F.array_sort(F.collect_list(F.struct("prob", "value"))).alias("_steps"))  # nine entries
    joined = company_counts.join(steps, company_counts[topic] == steps["topic"]).drop(steps["topic"])
    last = F.array_max(F.transform(F.filter("_steps", lambda s: s["value"] < F.col(n)), lambda s: s["prob"]))
    return joined.withColumn("score", F.floor(F.round(100 * F.coalesce(last, F.lit(0.1)), 6)).cast("int")).drop("_steps")


def topic_terms(weights: DataFrame, n: int = 200) -> DataFrame:
    """(topic, term, weight) of the n heaviest terms per topic; the weights of a topic sum to 1 over all terms."""
    tall = weights.select("term", F.posexplode("w").alias("topic", "w"))
    totals = tall.groupBy("topic").agg(F.sum("w").alias("_sum"))
    return top_n_per_group(tall, ["topic"], [F.desc("w"), F.asc("term")], n).join(totals, "topic").select("topic", "term", (F.col("w") / F.col("_sum")).alias("weight"))


def topic_distances(weights: DataFrame, topic: str, term: str, weight: str, topics: Sequence) -> DataFrame:
    """Jensen-Shannon distance (square root of the divergence, natural log) of each pair of topics.

    Each term brings its weights in all topics as one row; pairs of the few topics are built inside the row, so
    the only shuffle is by term.
    """
    topics = list(topics)
    totals = weights.groupBy(topic).agg(F.sum(weight).alias("_sum"))
    shares = weights.join(totals, topic).select(topic, term, (F.col(weight) / F.col("_sum")).alias("_p"))
    wide = shares.groupBy(term).agg(*[F.coalesce(F.sum(F.when(F.col(topic) == t, F.col("_p"))), F.lit(0.0)).alias(f"p{i}") for i, t in enumerate(topics)])

    def part(a: Column, b: Column) -> Column:
        m = (a + b) / 2
        half = lambda v: F.when(v > 0, v * F.ln(v / m)).otherwise(0.0)
        return (half(a) + half(b)) / 2

    pairs = [(i, j) for i in range(len(topics)) for j in range(i + 1, len(topics))]
    sums = wide.agg(*[F.sum(part(F.col(f"p{i}"), F.col(f"p{j}"))).alias(f"d{i}_{j}") for i, j in pairs])
    rows = F.array(*[F.struct(F.lit(topics[i]).alias("x"), F.lit(topics[j]).alias("y"), F.sqrt(F.greatest(F.col(f"d{i}_{j}"), F.lit(0.0))).alias("distance")) for i, j in pairs])
    return sums.select(F.explode(rows).alias("r")).select("r.*")
