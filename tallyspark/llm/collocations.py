"""Phrase collocation mining by top-order marginalisation.

Every word of a piece opens one window: the word and the words that lead it, padded at the end of the piece to the longest
phrase. Only these longest windows are counted. A rollup then sums them over successively shorter prefixes, so the counts of
all shorter phrases, and of all words of a language, come from the counted windows and no text is cut into n-grams again.

A phrase's parts occur at least as often as the phrase, so one threshold on the counts keeps all that scores and cover rules
ask for, and a window can be padded from a pair of words on that is too rare: windows that differ only behind it become one.
Windows combine before the shuffle, which tames frequent ones; everything after it works on distinct phrases.
Tops are ranked in `SALTS` parts of a language first, so no task ranks more than `SALTS` times the wished number.

Defined cases: null text counts as empty, null lang as `und` (one language with rows that say `und`); repeated rows count
each time; empty tables return no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyspark.session import materialize

from .common import table
from .registry import query

CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PIECE_END = r"[.,;:!?\x0A-\x0D]"
LONGEST, LEAST, COVER_PERCENT, TOP, SCALE = 4, 30, 80, 2000, 2_000_000
SALTS = 32
MOST_PAIRS = 4_000_000  # rows of 4 bytes that may be broadcast


def piece_words(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """lang and words of every piece that has any."""
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit("und"))
    pieces = docs.select(lang.alias("lang"), F.explode(F.split(F.replace(F.col(text_col), F.lit("\t"), F.lit(" ")), PIECE_END)).alias("piece"))
    # `lower` knows more than A-Z, so it is for pieces of ASCII
    small = F.when(F.octet_length("piece") == F.length("piece"), F.lower("piece")).otherwise(F.translate("piece", CAPITALS, SMALL))
    return pieces.select("lang", F.array_remove(F.split(small, " "), "").alias("words")).where(F.size("words") > 0)


def windows(pieces: DataFrame, longest: int = LONGEST) -> DataFrame:
    """lang, w0, w1, ... of the window at every word; null past the end of its piece."""
    leads = [F.col("words")] + [F.slice("words", k + 1, F.size("words")) for k in range(1, longest)]
    return pieces.select("lang", F.inline(F.arrays_zip(*[w.alias(f"w{k}") for k, w in enumerate(leads)]))).toDF("lang", *_names(longest))


def _pair(first: str, second: str) -> Column:
    return F.hash("lang", first, second)


def end_at_rare_pairs(opened: DataFrame, pieces: DataFrame, longest: int, least: int) -> DataFrame:
    """Windows padded from the first pair of words on that occurs less than `least` times: no phrase with it can be frequent.

    Pairs are counted by a 32-bit hash; pairs that share one only keep a window longer than needed. Beyond `MOST_PAIRS` frequent
    hashes the windows stay as they are, which gives the same phrases from larger shuffles.
    """
    pairs = windows(pieces, 2).where("w1 IS NOT NULL").groupBy(_pair("w0", "w1").alias("pair")).agg(F.count(F.lit(1)).alias("f"))
    frequent = materialize(pairs.where(F.col("f") >= least).select("pair"), "pairs")
    if frequent.count() > MOST_PAIRS:
        return opened
    names = _names(longest)
    joined, whole, out = opened, F.lit(True), [F.col("lang"), F.col("w0")]
    for k in range(1, longest):
        joined = joined.join(F.broadcast(frequent.withColumnRenamed("pair", f"p{k}")), _pair(names[k - 1], names[k]) == F.col(f"p{k}"), "left")
        whole = whole & F.col(f"p{k}").isNotNull()
        out.append(F.when(whole, F.col(names[k])).alias(names[k]))
    return joined.select(*out)


def _names(longest: int) -> list[str]:
    return [f"w{k}" for k in range(longest)]


def phrase_counts(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """lang, phrase, size, f of all phrases of 1 to `longest` words that occur `least` times; size 0 holds a language's words."""
    names = _names(longest)
    pieces = piece_words(docs, text_col, lang_col)
    opened = end_at_rare_pairs(windows(pieces, longest), pieces, longest, least)
    # a window is counted as one string, which is what its rows are shuffled as; padding leaves no trace in it
    counted = materialize(opened.groupBy("lang", F.concat_ws(" ", *names).alias("phrase")).agg(F.count(F.lit(1)).alias("f")), "windows")
    full = counted.where((_prefix("phrase", longest - 1) != F.col("phrase")) & (F.col("f") >= least))
    sums = counted.select("lang", F.explode(_prefixes("phrase", longest - 1)).alias("phrase"), "f").where("phrase IS NOT NULL")
    sums = sums.groupBy("lang", "phrase").agg(F.sum("f").alias("f")).where((F.col("phrase") == "") | (F.col("f") >= least))
    size = F.when(F.col("phrase") == "", 0).otherwise(F.size(F.split("phrase", " ")))
    return sums.unionByName(full).select("lang", "phrase", size.cast("int").alias("size"), "f")


def _prefix(phrase: str, words: int) -> Column:
    return F.substring_index(phrase, " ", words)


def _prefixes(phrase: str, most: int) -> Column:
    """The first 0 to `most` words of a phrase; null where it has fewer."""
    longer = [F.when(_prefix(phrase, m) != _prefix(phrase, m - 1), _prefix(phrase, m)) for m in range(2, most + 1)]
    return F.array(F.lit(""), *([_prefix(phrase, 1)] if most else []), *longer)


def _exact(value: Column | int) -> Column:
    return (F.lit(value) if isinstance(value, int) else value).cast("decimal(19,0)")


def cut_scores(phrases: DataFrame, scale: int = SCALE) -> DataFrame:
    """Each phrase of two words and more with its lowest-scoring cut: lang, phrase, size, a, l, r, score."""
    words = F.split("phrase", " ")
    cuts = phrases.where("size > 1").select("lang", "phrase", "size", F.col("f").alias("a"), words.alias("w"), F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "size", "a", "k", F.concat_ws(" ", F.slice("w", 1, F.col("k"))).alias("first"), F.concat_ws(" ", F.slice("w", F.col("k") + 1, F.col("size"))).alias("rest"))
    parts = phrases.where("size > 0")
    left = parts.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    right = parts.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    both = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"])
    scored = both.withColumns({"top": _exact(scale) * _exact(F.col("a")), "bottom": _exact(F.col("l")) + _exact(F.col("r"))}).withColumn("score", F.expr("top div bottom"))
    best = scored.groupBy("lang", "phrase", "size", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    return best.select("lang", "phrase", "size", "a", "cut.l", "cut.r", "cut.score")


def uncovered(scored: DataFrame, phrases: DataFrame, percent: int = COVER_PERCENT) -> DataFrame:
    """Without phrases that stand inside a longer one which occurs at least `percent` % as often."""
    inner = "flatten(transform(sequence(2, size - 1), m -> transform(sequence(1, size - m + 1), i -> concat_ws(' ', slice(split(phrase, ' '), i, m)))))"
    longer = phrases.where("size > 2").select("lang", F.explode(F.expr(inner)).alias("phrase"), "f")
    most = longer.groupBy("lang", "phrase").agg(F.max("f").alias("cover"))
    joined = scored.join(most, ["lang", "phrase"], "left")
    return joined.where(F.col("cover").isNull() | (_exact(100) * _exact(F.col("cover")) < _exact(percent) * _exact(F.col("a")))).drop("cover")


def best_per_language(scored: DataFrame, top: int = TOP) -> DataFrame:
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salt = F.pmod(F.xxhash64("phrase"), F.lit(SALTS))
    near = scored.withColumn("salt", salt).withColumn("place", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("place") <= top)
    return near.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top).drop("salt", "place")


def collocations(
    docs: DataFrame, longest: int = LONGEST, least: int = LEAST, percent: int = COVER_PERCENT, top: int = TOP, scale: int = SCALE, text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """lang, rank, phrase, size, a, l, r, n, score: the best `top` phrases of every language."""
    phrases = materialize(phrase_counts(docs, longest, least, text_col, lang_col), "phrases")
    kept = uncovered(cut_scores(phrases, scale), phrases, percent)
    words = phrases.where("size = 0").select("lang", F.col("f").alias("n"))
    return best_per_language(kept, top).join(words, "lang").select("lang", "rank", "phrase", "size", "a", "l", "r", "n", "score")


PHRASES_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), split AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') AS w FROM pieces
), grams AS (
  SELECT lang, m AS size, unnest(list_transform(range(1, len(w) - m + 2), lambda i: array_to_string(w[i : i + m - 1], ' '))) AS phrase FROM split, range(1, 5) t(m) WHERE len(w) >= m
), counted AS MATERIALIZED (
  SELECT lang, size, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 30
), total AS (
  SELECT lang, sum(len(w)) AS n FROM split GROUP BY 1
), cuts AS (
  SELECT lang, size, phrase, f AS a, k, array_to_string(string_split(phrase, ' ')[1 : k], ' ') AS head, array_to_string(string_split(phrase, ' ')[k + 1 : size], ' ') AS tail
  FROM counted, range(1, 4) t(k) WHERE size > 1 AND k < size
), scored AS (
  SELECT c.lang, c.phrase, c.size, c.a, k, l.f AS l, r.f AS r, (2000000::HUGEINT * c.a) // (l.f::HUGEINT + r.f) AS score
  FROM cuts c JOIN counted l ON l.lang = c.lang AND l.phrase = c.head JOIN counted r ON r.lang = c.lang AND r.phrase = c.tail
), lowest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), kept AS (
  SELECT * FROM lowest s WHERE NOT EXISTS (SELECT 1 FROM counted c WHERE c.lang = s.lang AND c.size > s.size AND contains(' ' || c.phrase || ' ', ' ' || s.phrase || ' ') AND 100 * c.f::HUGEINT >= 80 * s.a::HUGEINT)
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM kept JOIN total USING (lang) QUALIFY rank <= 2000
"""


@query("op11_collocation_rollup", PHRASES_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents")).drop("size")
