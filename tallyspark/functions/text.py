"""Text cleaning as column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .scalars import as_col, printable_ascii

# The cleaning steps in the order they apply to a paragraph (name, pattern, replacement).
# The white-space trim comes between the first and the second.
CLEANING_STEPS = [
    ("header_number", r"^\s?\d+(.*)$", "$1"),
    ("split_word", r"\s?-\s?", "-"),
    ("space_before_punctuation", r"\s?([,:;\.])", "$1"),
    ("figures", r"\d{5,}", " "),
    ("urls", r"((http|https)\:\/\/)?[a-zA-Z0-9\.\/\?\:@\-_=#]+\.([a-zA-Z]){2,6}([a-zA-Z0-9\.\&\/\?\:@\-_=#])*", " "),
    ("spaces", r"\s+", " "),
    ("dots", r"\.+", "."),
]

WHITE = " \t\n\r\u000b\u000c"


def clean_step(text: Column | str, name: str) -> Column:
    pattern, replacement = next((p, r) for n, p, r in CLEANING_STEPS if n == name)
    return F.regexp_replace(as_col(text), "(?d)" + pattern, replacement)  # only a line feed ends a line


def strip(text: Column) -> Column:
    return F.trim(text, F.lit(WHITE))


# A text without these cannot change in the step, which spares most paragraphs the costly patterns
STEP_NEEDS = {
    "split_word": lambda t: t.contains("-"),
    "urls": lambda t: t.rlike(r"\.[a-zA-Z]{2}"),
    "dots": lambda t: t.contains(".."),
}


def _clean_where(paragraphs: Column, name: str, need: Callable[[Column], Column]) -> Column:
    return F.transform(paragraphs, lambda t: F.when(need(t), clean_step(t, name)).otherwise(t))


def clean_paragraphs(paragraphs: Column) -> Column:
    """All cleaning steps on each element.

    One transform per step: its lambda variable is computed once, where nested CASE branches would repeat the
    steps before them.
    """
    out = F.transform(paragraphs, lambda t: strip(clean_step(t, CLEANING_STEPS[0][0])))
    for name, _, _ in CLEANING_STEPS[1:]:
        need = STEP_NEEDS.get(name, lambda t: F.lit(True))
        out = _clean_where(out, name, need)
    return out


def join_broken_lines(text: Column | str, dash_continues: bool = False) -> Column:
    """Paragraphs of a text: a line goes on with the one before if it starts with a space (or, on request, a dash)
    or the one before does not end with a dot.

    A break is therefore a line feed after a dot with no space next; every other line feed is a joint.
    """
    stop = r"(?<=\.)\n(?![ \-])" if dash_continues else r"(?<=\.)\n(?! )"
    paragraphs = F.split(as_col(text), stop)
    # the first line is joined to an empty start, which leaves a space before it
    return F.transform(paragraphs, lambda p, i: F.concat(F.when(i == 0, " ").otherwise(""), F.regexp_replace(p, r"\n", " ")))


def sentences(text: Column | str) -> Column:
    """Split after '.', '!' or '?' (and closing quotes) before white space and a capital, digit or opening quote.

    A rule, not a trained sentence model: abbreviations before a capital also split.
    """
    parts = F.split(as_col(text), r"""(?<=[.!?])\s+(?=["'(]?[A-Z0-9])""")
    return F.filter(F.transform(parts, strip), lambda s: F.length(s) > 0)


def statements(text: Column | str, dash_continues: bool = False) -> Column:
    """ASCII filter, line joining, cleaning, sentence split; an array of sentences."""
    lines = join_broken_lines(printable_ascii(text), dash_continues)
    return F.flatten(F.transform(clean_paragraphs(lines), sentences))


# Words without topic content; report words first, then common English words
DOMAIN_STOP_WORDS = [
    "plc", "group", "target", "track", "capital", "holding", "report", "annual", "esg", "bank", "csr", "environment", "social", "governance", "corporate",
    "responsibility", "million", "billion",
]
COMMON_STOP_WORDS = [
    "the", "and", "for", "that", "this", "with", "from", "have", "has", "had", "was", "were", "are", "been", "being", "not", "but", "you", "your", "our",
    "ours", "their", "them", "they", "there", "these", "those", "its", "his", "her", "she", "him", "who", "whom", "which", "what", "when", "where", "why",
    "how", "all", "any", "both", "each", "few", "more", "most", "other", "some", "such", "nor", "only", "own", "same", "than", "too", "very", "can", "will",
    "just", "should", "would", "could", "into", "over", "under", "again", "then", "once", "here", "about", "against", "between", "through", "during", "before",
    "after", "above", "below", "out", "off", "down", "because", "until", "while", "also",
]

# Suffix rules of the light stemmer, longest first. An approximation of a full stemmer.
SUFFIXES = ["ational", "ization", "fulness", "ousness", "iveness", "ations", "ments", "ement", "ation", "ingly", "edly", "ness", "ment", "ings", "ies", "ing", "ers", "est", "ful", "ous", "ive", "ed", "er", "ly", "es", "s"]


def tokens(text: Column | str, min_length: int = 1, max_length: int | None = None) -> Column:
    """Lower-case runs of letters of any alphabet; length limits only on request."""
    words = F.split(F.lower(as_col(text)), r"[^\p{L}]+")
    if max_length is not None:
        return F.filter(words, lambda w: F.length(w).between(min_length, max_length))
    return F.filter(words, lambda w: F.length(w) >= min_length)


# the same suffixes by their first letters, which spares most of the comparisons at each letter
_SUFFIX = "(?:a(?:tional|tions?)|i(?:zation|veness|ngly|ngs?|es|ve)|ful(?:ness)?|ous(?:ness)?|ments?|e(?:ment|dly|rs?|st|d|s)|ness|ly|s)"


def stem(word: Column) -> Column:
    """Drop the longest known suffix that leaves at least three letters."""
    return F.regexp_replace(word, rf"^(\p{{L}}{{3,}}?){_SUFFIX}$", "$1")


def lemma(text: Column | str, min_length: int = 4) -> Column:
    """Stems of at least ``min_length`` letters, joined by spaces. All words of the text are stemmed in one pass, which ``stem`` would do word by word."""
    stems = F.regexp_replace(F.lower(as_col(text)), rf"(?<!\p{{L}})(\p{{L}}{{3,}}?){_SUFFIX}(?!\p{{L}})", "$1")
    return F.array_join(F.filter(F.split(stems, r"[^\p{L}]+"), lambda s: F.length(s) >= min_length), " ")
