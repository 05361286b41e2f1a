"""Sentiment, words and topics on planted rows."""

import math
import random
import re

import pytest
from pyspark.sql import functions as F

from ratingloom.functions import text as tx, wordlists as wl
from ratingloom.operators import sentiment, topics, words

LEXICON = {"good": 1.9, "great": 3.1, "bad": -2.5, "awful": -2.0, "love": 3.2, "not": 0.0,
           "bomb": -2.2, "ass": -2.5, "best": 3.2, "like": 1.5, "cut": -1.1}
LEXICON.pop("not")


@pytest.fixture(scope="module")
def lexicon(spark):
    return spark.createDataFrame(list(LEXICON.items()), "word string, valence double")


def brute_force(text):
    """The published rules, word by word."""
    def shouted(w):
        return w.upper() == w and w.lower() != w

    marks = sorted(wl.PUNCTUATION, key=len, reverse=True)
    punct = set("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")

    def bare(w):
        for mark in marks:
            for inner in ([w[len(mark):]] if w.startswith(mark) else []) + (
                    [w[:-len(mark)]] if w.endswith(mark) else []):
                if len(inner) > 1 and not set(inner) & punct:
                    return inner
        return w

    ws = [bare(w) for w in text.split() if len(w) > 1]
    low = [w.lower() for w in ws]
    mixed = 0 < sum(map(shouted, ws)) < len(ws)
    boost = {**{w: wl.BOOST for w in wl.INTENSIFIERS}, **{w: -wl.BOOST for w in wl.DAMPENERS},
             **{w: -wl.BOOST for w in wl.DAMPENING_PAIRS}}

    def negates(w):
        return w in wl.NEGATIONS or "n't" in w

    values = []
    for i, w in enumerate(low):
        if w in boost or (w == "kind" and low[i + 1:i + 2] == ["of"]) or w not in LEXICON:
            values.append(0.0)
            continue
        v = LEXICON[w]
        if mixed and shouted(ws[i]):
            v += wl.CAPITALS if v > 0 else -wl.CAPITALS
        for n, damp in ((1, 1.0), (2, 0.95), (3, 0.9)):
            if i < n or low[i - n] in LEXICON:
                continue
            b = low[i - n]
            if b in boost:
                s = boost[b] + (wl.CAPITALS if mixed and shouted(ws[i - n]) else 0.0) if v > 0 else \
                    -boost[b] - (wl.CAPITALS if mixed and shouted(ws[i - n]) else 0.0)
                v += s * damp
            special = n == 2 and b == "never" and low[i - 1] in ("so", "this")
            wider = n == 3 and ((b == "never" and low[i - 2] in ("so", "this"))
                                or low[i - 1] in ("so", "this"))
            if special:
                v *= 1.5
            elif wider:
                v *= 1.25
            elif negates(b):
                v *= wl.NEGATION
            if n == 3:
                near = [low[i - 1:i + 1], low[i - 2:i + 1], low[i - 2:i], low[i - 3:i], low[i - 3:i - 1]]
                hit = [wl.IDIOMS[" ".join(p)] for p in near if " ".join(p) in wl.IDIOMS][:1]
                for later in (low[i:i + 2], low[i:i + 3]):
                    if " ".join(later) in wl.IDIOMS:
                        hit = [wl.IDIOMS[" ".join(later)]]
                v = hit[0] if hit else v
                if " ".join(low[i - 3:i - 1]) in boost or " ".join(low[i - 2:i]) in boost:
                    v -= wl.BOOST
        if i > 0 and low[i - 1] == "least" and "least" not in LEXICON:
            if i == 1 or low[i - 2] not in ("at", "very"):
                v *= wl.NEGATION
        values.append(v)
    if "but" in low:
        at = low.index("but")
        values = [v * (0.5 if i < at else 1.5 if i > at else 1.0) for i, v in enumerate(values)]
    total = sum(values)
    asks = text.count("?")
    emphasis = min(text.count("!"), 4) * wl.EXCLAMATION + (
        0 if asks < 2 else asks * wl.QUESTION if asks < 4 else wl.QUESTIONS_MANY)
    total += emphasis if total > 0 else -emphasis if total < 0 else 0
    return total / math.sqrt(total * total + wl.NORM)


SENTENCES = [
    "", "   ", "good", "The food is good", "The food is GOOD", "GOOD FOOD", "not good at all",
    "it isn't good", "very good", "VERY good food", "it was really very good", "kind of good",
    "it is kind of good", "this place is the bomb", "that is one bad ass place",
    "good food but awful service", "BUT good", "at least good", "the least good", "least good",
    "never so good", "never this bad", "i never really so good", "we thought this great",
    "good!", "good!!!!!!", "bad??", "bad?????", "(good)", "\"good\"", "good, great; bad.", "don't like it",
    "we did not really like it", "cut the mustard", "they can never cut the mustard here",
    "slightly bad and somewhat awful", "uber LOVE it!", "like?!? like!!!", "good\tgreat\nbad", "x good", "good (but) bad", "good but! bad", "!!good!! 'great' bad.'",
    "very kind of", "kind of", "GOOD! BAD! food", "a\u00a0good\u00a0place",
]


@pytest.mark.parametrize("small", [True, False])
def test_rules_by_brute_force(spark, lexicon, small, monkeypatch):
    """A lexicon that may be sent, and one that has to be joined."""
    monkeypatch.setattr(sentiment, "is_small", lambda _: small)
    rng = random.Random(5)
    pool = (list(LEXICON) + ["very", "not", "never", "so", "this", "but", "least", "at", "kind", "of", "the",
                             "bomb", "isn't", "really", "barely", "food", "yeah", "right", "just", "enough"])
    made = []
    for _ in range(300):
        picked = [rng.choice(pool) for _ in range(rng.randint(1, 12))]
        picked = [w.upper() if rng.random() < 0.1 else w for w in picked]
        made.append(" ".join(w + rng.choice(["", "", "", "!", ",", "?"]) for w in picked))
    texts = SENTENCES + made
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    got = {r.id: r.compound for r in sentiment.rule_sentiment(df, "id", "text", lexicon).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        assert got[i] == pytest.approx(brute_force(text), abs=1e-4), text


def test_only_listed_words_get_rows(spark, lexicon, monkeypatch):
    """Words of no valence get no row with a short lexicon; a long one gives the same scores."""
    df = spark.createDataFrame(list(enumerate([*SENTENCES, "", None, "plain words only here"])), "id int, text string")
    words = [r["word"] for r in lexicon.select("word").collect()]
    rows = sentiment._in_context(df, "id", "text", [], words)
    assert {r["w"].lower() for r in rows.where("_i >= 0").collect()} <= set(words)
    assert rows.where("_i < 0").count() == df.count()
    short = sorted(map(tuple, sentiment.rule_sentiment(df, "id", "text", lexicon).collect()))
    monkeypatch.setattr(sentiment, "_listed", lambda _: None)
    assert short == sorted(map(tuple, sentiment.rule_sentiment(df, "id", "text", lexicon).collect()))


def test_null_text_is_neutral(spark, lexicon):
    df = spark.createDataFrame([(1, None), (2, "good"), (3, "bad")], "id int, text string")
    for score in (sentiment.rule_sentiment, sentiment.lexicon_sentiment):
        got = {r.id: (r.compound, r.sentiment) for r in score(df, "id", "text", lexicon).collect()}
        assert got[1] == (0.0, "neutral") and got[2][1] == "positive" and got[3][1] == "negative"


def test_labels(spark):
    df = spark.createDataFrame(
        [(None, 0.05), (2.99, -0.05), (3.0, 0.0499), (3.5, -0.0499), (4.0, 1.0)], "stars double, c double")
    got = df.select(sentiment.rating_category("stars"), sentiment.sentiment_label("c")).collect()
    assert [tuple(r) for r in got] == [("unknown", "positive"), ("negative", "negative"), ("neutral", "neutral"),
                                       ("negative", "neutral"), ("positive", "positive")]


def test_word_counts_count_every_token(spark):
    df = spark.createDataFrame([(1, "Food food, FOOD menu the bar x1"), (2, "food menu"), (3, "menu"), (4, None)],
                               "id int, text string")
    labels = spark.createDataFrame([(1, "positive"), (2, "negative"), (3, "neutral"), (4, "positive")],
                                   "id int, sentiment string")
    counts = words.word_counts(df, "id", "text", labels, wl.RESTAURANT_WORDS, ["bar"])
    assert sorted(map(tuple, counts.collect())) == [
        ("negative", "food", 1), ("negative", "menu", 1), ("positive", "food", 3), ("positive", "menu", 1)]
    assert list(map(tuple, words.word_frequencies(counts, 1).collect())) == [("food", 3, 1)]
    assert {r.word for r in words.vocab_union(counts).collect()} == {"food", "menu"}


def test_ties_go_to_the_smaller_word(spark):
    counts = spark.createDataFrame([("positive", w, 5) for w in "dcba"], "sentiment string, word string, count long")
    assert [r.word for r in words.word_frequencies(counts, 2).collect()] == ["a", "b"]
    assert {r.word for r in words.wordclouds(counts, 3).collect()} == {"a", "b", "c"}


def test_summary_adds_up(spark):
    df = spark.createDataFrame([("positive", "unknown"), ("negative", "positive")] * 3,
                               "sentiment string, rating_category string")
    row = sentiment.label_summary(df).first().asDict()
    assert row["sentiment_positive"] == "3" and row["rating_category_unknown"] == "3"
    assert sum(int(v) for k, v in row.items() if k.startswith("sentiment")) == 6
    long = sentiment.label_summary_long(spark.createDataFrame([("4", None, "x")], "a string, b string, c string"))
    assert sorted(map(tuple, long.collect())) == [("a", 4), ("b", 0), ("c", 0)]


def test_topic_tokens(spark):
    df = spark.createDataFrame([("It's the Best-Ever, 2 cats!",), (None,), ("the",)], "t string")
    got = [r[0] for r in df.select(tx.topic_tokens("t", ["the"])).collect()]
    assert got == [["its", "bestever", "cats"], None, []]


SEGMENTS = "business_id string, year int, month int"


def test_spike_report(spark):
    flagged = spark.createDataFrame([("b", 2020, 1, "spike"), ("c", 2020, 2, "dip")], SEGMENTS + ", spike_or_dip string")
    reviews = spark.createDataFrame(
        [(1, "b", 2020, 1, "great tacos great"), (2, "b", 2020, 2, "other"), (3, "c", 2020, 2, "the")],
        "id int, " + SEGMENTS + ", text string")
    kept = topics.spike_reviews(reviews, flagged)
    assert {r.id for r in kept.collect()} == {1, 3}
    tokens = topics.topic_token_table(kept, topics.SEGMENT, "text", ["the"])
    report = {r.business_id: r.topics for r in topics.spike_report(flagged, topics.segment_topics(tokens)).collect()}
    assert report == {"b": ['0.667*"great" + 0.333*"tacos"'], "c": []}


def test_lda_topics(spark):
    rows = [(i, "b" if i % 2 else "c", 2020, 1, "taco salsa taco burrito" if i % 2 else "sushi wasabi ramen sushi")
            for i in range(40)] + [(99, "d", 2020, 1, "")]
    df = spark.createDataFrame(rows, "id int, " + SEGMENTS + ", text string")
    found = topics.lda_topics(df, "id", "text", ["the"], k=2, terms=2)
    rows = found.collect()
    assert {r.business_id for r in rows} == {"b", "c"} and max(r["rank"] for r in rows) == 2
    assert {r.term for r in rows if r.business_id == "b"} <= {"taco", "salsa", "burrito"}
    listed = topics.lda_segment_topics(found).collect()
    assert all(len(r.topics) == 2 and re.match(r'^\d\.\d{3}\*"', r.topics[0]) for r in listed)
    empty = topics.lda_topics(df.where("id = 99"), "id", "text", [])
    assert empty.isEmpty() and empty.columns == found.columns


def test_topic_word_merge(spark):
    df = spark.createDataFrame([("b", ['0.050*"Good" + 0.014*"bad"', "0.05*'good' + 0.001*tiny"])],
                               "k string, topics array<string>")
    assert list(map(tuple, topics.topic_word_merge(df, ["k"]).collect())) == [("b", "good", 10), ("b", "bad", 1)]


def test_token_lists(spark):
    df = spark.createDataFrame([(1, "Ab cd_1 Éa"), (2, "")], "id int, t string")
    got = [(r.id, r.word) for r in words.token_table(df, "id", "t").collect()]
    assert got == [(1, "ab"), (1, "cd_1"), (1, "a")]
    kept = words.token_filter(spark.createDataFrame([("abc",), ("ab",), ("ab1",), ("été",)], "word string"))
    assert {r.word for r in kept.collect()} == {"abc", "été"}
    assert words.whitespace_tokens(df, "id", "t").select(F.count("*")).first()[0] == 3
