"""Text and topic queries: documents stand for company reports, their source for the company."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import topics as Z
from ..session import materialize
from ..sources.tables import table
from .registry import query, rnd

LANGS = ["de", "en", "es", "fr"]

ASCII = r"regexp_replace(text, '[^\x20-\x7E\t\n\r\x0B\x0C]', '', 'g')"


def _clean_sql(source):
    first = X.CLEANING_STEPS[0]
    out = f"trim(regexp_replace({source}, '{first[1]}', '\\1'), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"
    for _, pattern, replacement in X.CLEANING_STEPS[1:]:
        out = f"regexp_replace({out}, '{pattern}', '{replacement.replace('$', chr(92))}', 'g')"
    return out


def _statements_sql(dash):
    marked = f"replace(replace({ASCII}, '.' || chr(10), '.' || chr(1)), chr(1) || ' ', chr(10) || ' ')"
    if dash:
        marked = f"replace({marked}, chr(1) || '-', chr(10) || '-')"
    sentences = "string_split(regexp_replace(c, '([.!?])\\s+([\"''(]?[A-Z0-9])', '\\1' || chr(1) || '\\2', 'g'), chr(1))"
    white = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    return f"""(SELECT doc_id, source, statement FROM (
        SELECT doc_id, source, trim(unnest({sentences}), {white}) AS statement FROM (
          SELECT doc_id, source, {_clean_sql("p")} AS c FROM (
            SELECT doc_id, source, replace(unnest(string_split(' ' || {marked}, chr(1))), chr(10), ' ') AS p FROM documents)))
      WHERE length(statement) > 50)"""


def statements(spark, sf, dash=False):
    docs = table(spark, sf, "documents").select("doc_id", "source", "text")
    return Z.extract_statements(docs, "text", dash)


for _dash, _name in ((False, "n1_statements"), (True, "n2_statements_dash_continues")):
    query(_name, f"SELECT doc_id, statement FROM {_statements_sql(_dash)}")(
        lambda spark, sf, dash=_dash: statements(spark, sf, dash).select("doc_id", "statement")
    )


WORDS_SQL = r"list_filter(regexp_split_to_array(lower({0}), '[^\p{{L}}]+'), lambda w: length(w) >= 1)"
STEM_SQL = r"regexp_replace(w, '^(\p{L}{3,}?)(" + "|".join(X.SUFFIXES) + ")$', '\\1')"


@query("n3_lemmas", f"""
    SELECT doc_id, md5(array_to_string(list_filter(list_transform({WORDS_SQL.format('text')}, lambda w: {STEM_SQL}), lambda s: length(s) >= 4), ' ')) AS lemma FROM documents""")
def n3(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.md5(X.lemma("text")).alias("lemma"))


STOPS_SQL = "(SELECT unnest([" + ", ".join(f"'{w}'" for w in [*X.COMMON_STOP_WORDS, *X.DOMAIN_STOP_WORDS]) + "]) AS word UNION SELECT unnest(string_split(lower(source), ' ')) FROM documents)"


@query("n4_stop_words", f"SELECT DISTINCT word FROM {STOPS_SQL}")
def n4(spark, sf):
    return Z.stop_words(table(spark, sf, "documents"), "source")


@query("n5_term_counts", f"""
    SELECT term, CAST(count(*) AS BIGINT) AS n FROM (SELECT unnest({WORDS_SQL.format('text')}) AS term FROM documents) WHERE term NOT IN (SELECT word FROM {STOPS_SQL}) GROUP BY 1""")
def n5(spark, sf):
    docs = table(spark, sf, "documents").select("source", X.tokens("text").alias("tokens"))
    return Z.term_counts(docs, "tokens", stops=Z.stop_words(docs, "source"))


#: A statement enters the topic model with a lemma longer than this (fixed value).
LEMMA_CHARS = 100


def _lemmas(spark, sf):
    # a filter does not pass an outer explode, so the lemma is built once
    lemmas = statements(spark, sf).select("doc_id", "source", F.explode_outer(F.array(X.lemma("statement"))).alias("lemma")).where(F.length("lemma") > LEMMA_CHARS)
    # training goes over these rows many times, so they are written once
    return materialize(lemmas.select("doc_id", "source", F.split("lemma", " ").alias("tokens")).withColumn("row", F.monotonically_increasing_id()), "lemmas")


#: Topic models of this session by application, data folder and state of its files: the topic queries share one fit.
_FITTED: dict[tuple, dict] = {}


def _state(spark, sf):
    """A number that changes with the name, size or time of any file."""
    file = F.struct("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time")
    return table(spark, sf, "documents").select(F.xxhash64(file).alias("h")).distinct().agg(F.bit_xor("h"), F.count("*")).first()


def _fitted(spark, sf):
    """Statements, their corpus and the weights of the terms."""
    key = (spark.sparkContext.applicationId, sf, *_state(spark, sf))
    if key not in _FITTED:
        rows = _lemmas(spark, sf)
        stops = Z.stop_words(table(spark, sf, "documents"), "source")
        texts = Z.corpus(rows, "row", "tokens", stops.select(X.stem(F.col("word")).alias("word")))
        _FITTED[key] = {"rows": rows, "texts": texts, "weights": Z.fit_topics(texts)}
    return _FITTED[key]


def _shares(spark, sf):
    """The topics of every statement; one without any term has all topics alike."""
    fit = _fitted(spark, sf)
    if "shares" not in fit:
        shares = fit["rows"].select("row", "doc_id", "source").join(Z.topic_distributions(fit["texts"], fit["weights"]), "row", "left")
        even = F.array_repeat(F.lit(1 / 9), 9)
        fit["shares"] = materialize(shares.select("doc_id", "source", F.coalesce("topicDistribution", even).alias("topicDistribution")), "topics")
    return fit["shares"]


def principal(spark, sf):
    return Z.principal_topic(_shares(spark, sf))


@query("n6_topic_model")
def n6(spark, sf):
    return principal(spark, sf).groupBy("topic").agg(F.count("*").alias("statements"))


@query("n7_principal_topic")
def n7(spark, sf):
    return principal(spark, sf)


TOPICS = list(range(9))


@query("n8_topic_focus")
def n8_topics(spark, sf):
    counts = Z.focus_counts(principal(spark, sf), "source", "topic", TOPICS, "probability")
    return Z.focus_scaled(counts, "source")


@query("n9_topic_focus_score")
def n9_topics(spark, sf):
    counts = Z.focus_counts(principal(spark, sf), "source", "topic", TOPICS, "probability")
    names = [str(t) for t in TOPICS]
    tall = counts.unpivot("source", names, "topic", "n")
    return Z.focus_score(tall, Z.industry_deciles(counts, names)).select("source", "topic", "n", "score")


FOCUS_SQL = "(SELECT source, " + ", ".join(f"CAST(count(*) FILTER (lang = '{t}') AS BIGINT) AS {t}" for t in LANGS) + " FROM documents GROUP BY source)"


def focus(spark, sf):
    docs = table(spark, sf, "documents").select("source", "lang")
    return Z.focus_counts(docs, "source", "lang", LANGS)


@query("n8_focus_counts", f"SELECT * FROM {FOCUS_SQL}")
def n8(spark, sf):
    return focus(spark, sf)


@query("n8_focus_scaled", "SELECT source, " + ", ".join(f"round(CAST({t} - min({t}) OVER () AS DOUBLE) / (max({t}) OVER () - min({t}) OVER ()), 8) + 0.0 AS {t}" for t in LANGS) + f" FROM {FOCUS_SQL}")
def n8_scaled(spark, sf):
    return Z.focus_scaled(focus(spark, sf), "source").withColumns({t: rnd(t, 8) for t in LANGS})


@query("n9_focus_score", f"""
    WITH f AS (UNPIVOT {FOCUS_SQL} ON {', '.join(LANGS)} INTO NAME topic VALUE n),
      q AS (SELECT topic, p, quantile_cont(n, p) AS v FROM f, (VALUES {', '.join(f'({i}::DOUBLE / 10)' for i in range(1, 10))}) t(p) GROUP BY 1, 2)
    SELECT f.source, f.topic, f.n, CAST(round(coalesce(max(p) FILTER (v < f.n), 0.1) * 100) AS INTEGER) AS score FROM f JOIN q USING (topic) GROUP BY 1, 2, 3""".replace("quantile_cont(n, p)", "CASE " + " ".join(f"WHEN p = {i}::DOUBLE / 10 THEN quantile_cont(n, 0.{i})" for i in range(1, 10)) + " END"))
def n9(spark, sf):
    counts = focus(spark, sf)
    tall = counts.unpivot("source", LANGS, "topic", "n")
    return Z.focus_score(tall, Z.industry_deciles(counts, LANGS)).select("source", "topic", "n", "score")


@query("n10_topic_terms")
def n10(spark, sf):
    return Z.topic_terms(_fitted(spark, sf)["weights"], 200)


DIST = f"(SELECT lang, term, count(*) AS n FROM (SELECT lang, unnest({WORDS_SQL.format('text')}) AS term FROM documents) GROUP BY 1, 2)"


@query("n11_topic_distances", f"""
    WITH d AS (SELECT lang, term, n::DOUBLE / sum(n) OVER (PARTITION BY lang) AS p FROM {DIST}), t AS (SELECT DISTINCT term FROM d),
      l AS (SELECT a.lang AS x, b.lang AS y FROM (SELECT DISTINCT lang FROM d) a JOIN (SELECT DISTINCT lang FROM d) b ON a.lang < b.lang),
      v AS (SELECT l.x, l.y, coalesce(a.p, 0) AS p, coalesce(b.p, 0) AS q FROM l CROSS JOIN t LEFT JOIN d a ON a.lang = l.x AND a.term = t.term LEFT JOIN d b ON b.lang = l.y AND b.term = t.term WHERE a.p IS NOT NULL OR b.p IS NOT NULL)
    SELECT x, y, round(sqrt(sum((CASE WHEN p > 0 THEN p * ln(2 * p / (p + q)) ELSE 0 END + CASE WHEN q > 0 THEN q * ln(2 * q / (p + q)) ELSE 0 END) / 2)), 8) + 0.0 AS distance FROM v GROUP BY 1, 2""")
def n11(spark, sf):
    counts = Z.term_counts(table(spark, sf, "documents").select("lang", X.tokens("text").alias("tokens")), "tokens", ["lang"])
    return Z.topic_distances(counts, "lang", "term", "n", LANGS).withColumn("distance", rnd("distance", 8))
