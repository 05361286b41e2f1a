"""Topics with Dirichlet priors: the functions, the bound, months that settle, and the fit by hand."""

import math
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from ratingloom.functions.gamma import digamma, log_gamma
from ratingloom.operators import dirichlet, topics
from ratingloom.operators.topics import start_value

SCHEMA = "business_id string, year int, month int, row long, text string"
STEP = 1e-5


def test_gamma_functions(spark):
    points = [0.05, 1 / 3, 0.5, 1.0, 1.5, 2.0, 7.25, 100.0, 1e6]
    rows = spark.createDataFrame([(x,) for x in points], "x double").select(
        "x", log_gamma(F.col("x")).alias("l"), digamma(F.col("x")).alias("d")).collect()
    for r in rows:
        assert r["l"] == pytest.approx(math.lgamma(r["x"]), rel=1e-8, abs=1e-8)
        slope = (math.lgamma(r["x"] * (1 + STEP)) - math.lgamma(r["x"] * (1 - STEP))) / (2 * STEP * r["x"])
        assert r["d"] == pytest.approx(slope, rel=1e-4, abs=1e-5)


@pytest.fixture(scope="module")
def reviews(spark):
    """Months of two clear subjects, of one word, and of nothing but stop words."""
    food, car = "taco salsa lime corn".split(), "wheel brake motor light".split()
    rows = []
    for i in range(24):
        words = food if i % 2 else car
        rows.append(("a", 2024, 1, i, " ".join(words[(i + j * (i % 3 + 1)) % 4] for j in range(12))))
    rows += [("b", 2024, 2, 100 + i, "plain plain plain") for i in range(3)]
    rows += [("c", 2024, 3, 200, "the the"), ("c", 2024, 4, 201, None)]
    rows += [("d", 2023, 5, 300 + i, "soup " * (i + 1) + "bread rice noodles") for i in range(9)]
    return spark.createDataFrame(rows, SCHEMA)


def fitted(reviews, **options):
    top, bounds = dirichlet.dirichlet_topics(reviews, "row", "text", ["the"], **options)
    history = defaultdict(dict)
    for r in bounds.collect():
        history[(r["business_id"], r["year"], r["month"])][r["pass"]] = r["bound"]
    return top, history


def test_bound_never_falls_and_settled_months_leave(reviews):
    top, history = fitted(reviews, passes=15, settled=5e-4)
    assert set(history) == {("a", 2024, 1), ("b", 2024, 2), ("d", 2023, 5)}
    lengths = set()
    for bounds in history.values():
        passes = sorted(bounds)
        assert passes == list(range(1, len(passes) + 1))
        values = [bounds[p] for p in passes]
        assert all(b >= a - 1e-6 * abs(a) for a, b in zip(values, values[1:]))
        gains = [b - a for a, b in zip(values, values[1:])]
        assert all(g >= 5e-4 * abs(v) for g, v in zip(gains[:-1], values[1:-1]))  # or it had left earlier
        assert len(passes) == 15 or gains[-1] < 5e-4 * abs(values[-1])
        lengths.add(len(passes))
    assert len(lengths) > 1, "months settle at different passes"


def test_subjects_are_told_apart(reviews):
    top, _ = fitted(reviews, k=2, terms=4, passes=16, settled=1e-7, alpha=0.1, eta=0.1)
    topics = defaultdict(set)
    for r in top.where("business_id = 'a'").collect():
        topics[r["topic"]].add(r["term"])
    assert {frozenset(t) for t in topics.values()} == {
        frozenset("taco salsa lime corn".split()), frozenset("wheel brake motor light".split())}


def by_hand(rows, k, alpha, eta, passes, seeds):
    """The same updates with dictionaries and the library's own gamma functions."""
    def slope(x):
        total = 0.0
        while x < 30:
            total, x = total - 1 / x, x + 1
        return total + math.log(x) - 1 / (2 * x) - 1 / (12 * x**2) + 1 / (120 * x**4)

    counts = defaultdict(int)
    for doc, text in rows:
        for word in text.split():
            counts[doc, word] += 1
    part = {key: seeds[key[1]] for key in counts}
    words, bounds = {w for _, w in counts}, []
    for _ in range(passes):
        gamma, lam = defaultdict(lambda: [alpha] * k), defaultdict(lambda: [eta] * k)
        for (d, w), n in counts.items():
            gamma[d] = [g + n * p for g, p in zip(gamma[d], part[d, w])]
            lam[w] = [g + n * p for g, p in zip(lam[w], part[d, w])]
        whole = [sum(lam[w][t] for w in words) for t in range(k)]
        doc_log = {d: [slope(x) - slope(sum(g)) for x in g] for d, g in gamma.items()}
        word_log = {w: [slope(x) - slope(v) for x, v in zip(lam[w], whole)] for w in words}
        bound = 0.0
        for (d, w), n in counts.items():
            p = [math.exp(a + b) for a, b in zip(doc_log[d], word_log[w])]
            bound += n * math.log(sum(p))
            part[d, w] = [x / sum(p) for x in p]
        for d, g in gamma.items():
            bound += math.lgamma(k * alpha) - k * math.lgamma(alpha) - math.lgamma(sum(g)) + sum(
                (alpha - x) * e + math.lgamma(x) for x, e in zip(g, doc_log[d]))
        for t in range(k):
            bound += math.lgamma(len(words) * eta) - len(words) * math.lgamma(eta) - math.lgamma(whole[t]) + sum(
                (eta - lam[w][t]) * word_log[w][t] + math.lgamma(lam[w][t]) for w in words)
        bounds.append(bound)
    return bounds


def test_bounds_by_hand(spark, reviews):
    rows = [(r["row"], r["text"]) for r in reviews.where("business_id = 'd'").collect()]
    words = sorted({w for _, t in rows for w in t.split()})
    drawn = spark.createDataFrame([("d", 2023, 5, w) for w in words], "business_id string, year int, month int, term string")
    keys = ["business_id", "year", "month", "term"]
    seeds = {}
    for r in drawn.select("term", *[start_value(100, t, keys).alias(f"s{t}") for t in range(3)]).collect():
        values = [r[f"s{t}"] for t in range(3)]
        seeds[r["term"]] = [v / sum(values) for v in values]
    _, history = fitted(reviews.where("business_id = 'd'"), passes=5, settled=0.0)
    wanted = by_hand(rows, 3, 1 / 3, 1 / 3, 5, seeds)
    found = [history["d", 2023, 5][p] for p in sorted(history["d", 2023, 5])]
    assert found == pytest.approx(wanted[:len(found)], rel=1e-6) and len(found) >= 2


def test_no_reviews(reviews):
    top, history = fitted(reviews.limit(0))
    assert top.count() == 0 and not history


def sorted_rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_both_ways_of_passes_agree(spark, reviews):
    """Months fitted in one task give the rows of grouped sums, with repeated and missing row ids."""
    odd = reviews.unionByName(reviews.limit(5)).unionByName(reviews.where("row < 3").withColumn("row", F.lit(None).cast("long")))
    own = dirichlet.dirichlet_topics(odd, "row", "text", ["the"])
    summed = dirichlet.dirichlet_topics(odd, "row", "text", ["the"], most_chars=0)
    some = dirichlet.dirichlet_topics(odd, "row", "text", ["the"], most_chars=500)
    wanted = sorted_rows(summed[0])
    assert len(wanted) > 20 and sorted_rows(own[0]) == wanted and sorted_rows(some[0]) == wanted
    bounds = [{tuple(r[:4]): r["bound"] for r in b.collect()} for _, b in (own, summed, some)]
    assert bounds[0] == pytest.approx(bounds[1], abs=1e-6) and bounds[2] == pytest.approx(bounds[1], abs=1e-6)


def test_smoothed_passes_agree(spark, reviews):
    odd = reviews.unionByName(reviews.where("row < 3").withColumn("row", F.lit(None).cast("long")))
    wanted = sorted_rows(topics.lda_topics(odd, "row", "text", ["the"], most_chars=0))
    assert len(wanted) > 20
    for most in (500, 1 << 24):
        assert sorted_rows(topics.lda_topics(odd, "row", "text", ["the"], most_chars=most)) == wanted


def test_passes_write_no_tables(spark, reviews, monkeypatch):
    """What is written does not grow with the passes."""
    written = []
    for module in (topics, dirichlet):
        kept = module.stored
        monkeypatch.setattr(module, "stored", lambda df, label, kept=kept: (written.append(label), kept(df, label))[1])
    for passes in (2, 9):
        topics.lda_topics(reviews, "row", "text", ["the"], passes=passes).count()
        dirichlet.dirichlet_topics(reviews, "row", "text", ["the"], passes=passes)[0].count()
    assert written == ["topic-texts", "topics-found"] * 4
