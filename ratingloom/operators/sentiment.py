"""Sentiment of texts from a lexicon (word, valence), and sentiment by stars."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ratingloom.functions import text as tx, wordlists as wl
from ratingloom.functions.numbers import count_or_zero
from ratingloom.operators.spread import is_small, lookup_join

# Limits of the classes.
COMPOUND_LIMIT = 0.05
GOOD_STARS = 4.0
MIDDLE_STARS = 3.0
LOOK_BACK = 3
# A lexicon of at most so many words is sent with the expressions.
MOST_LISTED = 16384


def sentiment_label(compound: Column | str) -> Column:
    c = F.col(compound) if isinstance(compound, str) else compound
    return (F.when(c >= COMPOUND_LIMIT, "positive").when(c <= -COMPOUND_LIMIT, "negative")
            .otherwise("neutral"))


def rating_category(stars: Column | str) -> Column:
    """3.5 stars are negative: only exactly 3 is neutral."""
    s = F.col(stars) if isinstance(stars, str) else stars
    return (F.when(s.isNull(), "unknown").when(s >= GOOD_STARS, "positive")
            .when(s == MIDDLE_STARS, "neutral").otherwise("negative"))


def _compound(total: Column) -> Column:
    return F.round(total / F.sqrt(total * total + wl.NORM), 4)


def lexicon_sentiment(df: DataFrame, key: str, text: str, lexicon: DataFrame,
                      carry: list[str] = []) -> DataFrame:
    """Sum of the valences of the lower-case tokens, squeezed into -1..1, and its class.

    Rows without text or hits are neutral. ``key`` is unique; ``carry`` columns go along. The rows
    of a text sit together, so they shrink to one row before the shuffle by key.
    """
    words = df.select(key, *carry, F.explode_outer(tx.tokens(text)).alias("word"))
    hits = lookup_join(words, lexicon, ["word"], "left")
    total = F.sum(F.coalesce("valence", F.lit(0.0)))
    return (hits.groupBy(key, *carry).agg(_compound(total).alias("compound"))
            .withColumn("sentiment", sentiment_label("compound")))


# ---------------------------------------------------------------------------------------------
# The same with the published rules: capitals, boosters, negation, "but", "least", idioms and
# emphasis by punctuation.


def _shouted(word: Column) -> Column:
    return (F.upper(word) == word) & (F.lower(word) != word)


def _negates(word: Column) -> Column:
    return word.isin(wl.NEGATIONS) | word.contains("n't")


def _bare(word: Column) -> Column:
    """The word without one punctuation mark before or after it, if that leaves a plain word."""
    marks = "|".join("".join("\\" + ch for ch in mark)
                     for mark in sorted(wl.PUNCTUATION, key=len, reverse=True))
    plain = r"([^\p{Punct}]{2,})"
    return F.regexp_replace(word, f"^(?:(?:{marks}){plain}|{plain}(?:{marks}))$", "$1$2")


def _in_context(df: DataFrame, key: str, text: str, carry: list[str], listed: list[str] | None = None) -> DataFrame:
    """Every word, or every one whose lower case is ``listed``, with its three predecessors and two successors ('' past
    the ends), and for every text one row without a word (position -1). Each word is trimmed once, where it stands in
    its text."""
    split = F.filter(F.split(text, r"(?U)\s+"), lambda w: F.length(w) > 1)
    edged = r"^\p{Punct}|\p{Punct}$"
    docs = df.select(key, *carry, F.col(text).alias("_text"), split.alias("_raw"))
    docs = docs.withColumn("_words", F.transform("_raw", lambda w: F.when(w.rlike(edged), _bare(w)).otherwise(w)))
    size = F.size("_words")
    places = F.when(size > 0, F.sequence(F.lit(0), size - 1)).otherwise(F.array().cast("array<int>"))
    if listed is not None:
        places = F.filter(places, lambda i: F.lower(F.get("_words", i)).isin(listed))
    offsets = {"w": 0, "p1": -1, "p2": -2, "p3": -3, "n1": 1, "n2": 2}
    but = F.array_position(F.transform("_words", F.lower), "but").cast("int")
    docs = docs.select(
        key, *carry, "_words",
        F.when(F.lower("_text").contains("but") & (but > 0), but - 1).alias("_but"),
        F.size(F.filter("_raw", _shouted)).between(1, size - 1).alias("_mixed_caps"),
        (F.length("_text") - F.length(F.replace("_text", F.lit("!")))).alias("_exclaims"),
        (F.length("_text") - F.length(F.replace("_text", F.lit("?")))).alias("_asks"),
        F.transform(F.concat(F.array(F.lit(-1)), places), lambda i: F.struct(
            i.alias("i"), *[F.coalesce(F.get("_words", i + n), F.lit("")).alias(c) for c, n in offsets.items()]))
        .alias("_hits")).drop("_words")
    # Outer, as a plain explode of a column filters on its size, below all this, by computing it twice.
    rows = docs.select("*", F.explode_outer("_hits").alias("_h")).drop("_hits")
    return rows.select("*", F.col("_h")["i"].alias("_i"), *[F.col("_h")[c].alias(c) for c in offsets]).drop("_h")


def _listed(lexicon: DataFrame, most: int = MOST_LISTED) -> list[str] | None:
    """The words of a lexicon that is short enough to be looked up where the texts stand."""
    words = [r["word"] for r in lexicon.select("word").where("word IS NOT NULL").distinct().limit(most + 1).collect()]
    return sorted(words) if len(words) <= most else None


def rule_sentiment(df: DataFrame, key: str, text: str, lexicon: DataFrame,
                   carry: list[str] = []) -> DataFrame:
    """Lexicon sentiment with the rules; same columns as ``lexicon_sentiment``.

    All look-ups happen next to the words, in one stage; only one row per text is shuffled. Words of no valence add
    nothing, so with a short lexicon they get no row.
    """
    small = is_small(lexicon)
    rows = _in_context(df, key, text, carry, _listed(lexicon) if small else None).withColumn("word", F.lower("w"))
    rows = lookup_join(rows, lexicon, ["word"], "left", small)
    boosters = wl.INTENSIFIERS + wl.DAMPENERS
    muted = F.col("word").isin(boosters) | ((F.col("word") == "kind") & (F.lower("n1") == "of"))
    rows = rows.withColumn("v", F.when((F.col("_i") >= 0) & ~muted, F.col("valence")))
    rows = rows.where(F.col("v").isNotNull() | (F.col("_i") < 0))

    # Which predecessors carry a valence of their own.
    for n in range(1, LOOK_BACK + 1):
        rows = rows.withColumn(f"l{n}", F.lower(f"p{n}"))
        known = lexicon.select(F.col("word").alias(f"l{n}"), F.lit(True).alias(f"known{n}"))
        rows = lookup_join(rows, known, [f"l{n}"], "left", small)

    v = F.col("v")
    rows = rows.withColumn("v", v + F.when(
        F.col("_mixed_caps") & _shouted(F.col("w")),
        F.when(v > 0, wl.CAPITALS).otherwise(-wl.CAPITALS)).otherwise(0.0))

    damping = {1: 1.0, 2: 0.95, 3: 0.9}
    so_this = ["so", "this"]
    l1, l2, l3 = (F.col(f"l{n}") for n in (1, 2, 3))
    for n in range(1, LOOK_BACK + 1):
        before = F.col(f"l{n}")
        acts = (F.col("_i") >= n) & F.col(f"known{n}").isNull()
        loud = F.when(F.col("_mixed_caps") & _shouted(F.col(f"p{n}")), wl.CAPITALS).otherwise(0.0)
        push = (F.when(before.isin(wl.INTENSIFIERS), wl.BOOST)
                .when(before.isin(wl.DAMPENERS), -wl.BOOST))
        signed = F.when(v > 0, push + loud).otherwise(-push - loud)
        rows = rows.withColumn("v", v + F.when(
            acts, F.coalesce(signed, F.lit(0.0)) * damping[n]).otherwise(0.0))
        turn = F.when(_negates(before), wl.NEGATION).otherwise(1.0)
        if n == 2:
            turn = F.when((l2 == "never") & l1.isin(so_this), 1.5).otherwise(turn)
        if n == 3:
            turn = F.when(((l3 == "never") & l2.isin(so_this)) | l1.isin(so_this), 1.25).otherwise(turn)
        rows = rows.withColumn("v", v * F.when(acts, turn).otherwise(1.0))

    # Idioms are looked for once three words precede.
    w, n1, n2 = F.col("word"), F.lower("n1"), F.lower("n2")
    phrases = [(l1, w), (l2, l1, w), (l2, l1), (l3, l2, l1), (l3, l2)]
    later = [(w, n1), (w, n1, n2)]

    idioms = F.create_map(*[F.lit(x) for pair in wl.IDIOMS.items() for x in pair])

    def idiom(phrase: tuple[Column, ...]) -> Column:
        return idioms[F.concat_ws(" ", *phrase)]

    looks = (F.col("_i") >= 3) & F.col("known3").isNull() & v.isNotNull()
    rows = rows.withColumn("v", F.when(
        looks, F.coalesce(*[idiom(p) for p in reversed(later)], *[idiom(p) for p in phrases], v))
        .otherwise(v))
    damped_pair = (F.concat_ws(" ", l3, l2).isin(wl.DAMPENING_PAIRS)
                   | F.concat_ws(" ", l2, l1).isin(wl.DAMPENING_PAIRS))
    rows = rows.withColumn("v", v - F.when(looks & damped_pair, wl.BOOST).otherwise(0.0))

    least = (l1 == "least") & F.col("known1").isNull() & (
        (F.col("_i") == 1) | ((F.col("_i") > 1) & ~l2.isin(["at", "very"])))
    rows = rows.withColumn("v", v * F.when(least, wl.NEGATION).otherwise(1.0))

    weight = (F.when(F.col("_i") < F.col("_but"), 0.5).when(F.col("_i") > F.col("_but"), 1.5)
              .otherwise(1.0))
    sums = rows.groupBy(key, *carry).agg(
        F.sum(F.coalesce(v * weight, F.lit(0.0))).alias("_sum"),
        F.max("_exclaims").alias("_exclaims"), F.max("_asks").alias("_asks"))
    emphasis = (F.least(F.col("_exclaims"), F.lit(4)) * wl.EXCLAMATION
                + F.when(F.col("_asks") > 3, wl.QUESTIONS_MANY)
                .when(F.col("_asks") > 1, F.col("_asks") * wl.QUESTION).otherwise(0.0))
    total = (F.when(F.col("_sum") > 0, F.col("_sum") + emphasis)
             .when(F.col("_sum") < 0, F.col("_sum") - emphasis).otherwise(0.0))
    return (sums.withColumn("_total", total)
            .select(key, *carry, _compound(F.col("_total")).alias("compound"))
            .withColumn("sentiment", sentiment_label("compound")))


# ---------------------------------------------------------------------------------------------
# Summaries over labelled rows.


def label_summary(labelled: DataFrame) -> DataFrame:
    """One row with the size of every class of ``sentiment`` and ``rating_category``, as text."""
    classes = [("sentiment", ["positive", "neutral", "negative"]),
               ("rating_category", ["positive", "neutral", "negative", "unknown"])]
    return labelled.agg(*[
        F.count_if(F.col(column) == name).cast("string").alias(f"{column}_{name}")
        for column, names in classes for name in names])


def label_summary_long(summary: DataFrame) -> DataFrame:
    """The summary as (label, n) rows; missing or unreadable counts are 0."""
    return (summary.unpivot([], summary.columns, "label", "text")
            .select("label", count_or_zero(F.col("text")).alias("n")))


def sentiment_vs_rating(labelled: DataFrame) -> DataFrame:
    """How text sentiment and star category agree."""
    return labelled.groupBy("sentiment", "rating_category").agg(F.count("*").alias("reviews"))
