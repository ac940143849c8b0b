"""Text to word arrays, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that carry no topic, in four languages.
STOP_WORDS = [
    "and", "are", "but", "for", "from", "has", "have", "her", "his", "its",
    "not", "she", "that", "the", "their", "there", "they", "this", "was", "were",
    "will", "with", "you",
    "avec", "dans", "des", "elle", "est", "les", "par", "pas", "pour", "que",
    "qui", "sur", "une",
    "auf", "aus", "das", "dem", "den", "der", "die", "ein", "eine", "ich",
    "ist", "mit", "nicht", "sich", "sie", "und", "von",
    "con", "del", "las", "los", "por", "para", "una",
]
# What a tag is, and what a word is.
TAG = "<.*?>"
WORD = r"[\p{L}]{2,}"
SHORT_LATIN = "^[a-z]{1,2}$"


def strip_tags(text: Column) -> Column:
    return F.regexp_replace(text, TAG, "")


def raw_words(text: Column) -> Column:
    """Lower-case runs of at least two letters, in text order."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def topic_words(text: Column) -> Column:
    """Words without tags, stop words and one- or two-letter Latin words."""
    return F.filter(
        raw_words(strip_tags(text)),
        lambda w: ((F.length(w) > 2) | ~w.rlike(SHORT_LATIN)) & ~w.isin(STOP_WORDS),
    )


def topic_words_sql(text: str) -> str:
    """The same rule for the SQL twin."""
    stop = ", ".join(f"'{w}'" for w in STOP_WORDS)
    return (
        f"list_filter(regexp_extract_all(lower(regexp_replace({text}, '{TAG}', '', 'g')), '{WORD}'), "
        f"lambda w: w NOT IN ({stop}) AND NOT regexp_matches(w, '{SHORT_LATIN}'))"
    )
