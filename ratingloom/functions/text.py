"""Token expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Shortest counted word has more than this many letters; what topic tokens keep.
MIN_LETTERS = 2
NOT_TOPIC = r"[^a-z\s]"


def tokens(text: str) -> Column:
    """Lower-case runs of word characters (ASCII letters, digits, underscore)."""
    return F.filter(F.split(F.lower(text), r"\W+"), lambda w: w != "")


def topic_tokens(text: str, stop_words: list[str]) -> Column:
    """Lower-case a-z words of more than two letters that are no stop words."""
    letters = F.regexp_replace(F.lower(text), NOT_TOPIC, "")
    return F.filter(F.split(letters, r"\s+"),
                    lambda w: (F.length(w) > MIN_LETTERS) & ~w.isin(stop_words))


def is_counted(word: Column) -> Column:
    """Letters only and longer than two."""
    return (F.length(word) > MIN_LETTERS) & word.rlike(r"^\p{L}+$")


def counted_tokens(text: str, domain: list[str], stop_words: list[str]) -> Column:
    """The tokens that word counts are made of: domain words that are no stop words."""
    wanted = [w for w in domain if w not in set(stop_words)]
    return F.filter(tokens(text), lambda w: is_counted(w) & w.isin(wanted))
