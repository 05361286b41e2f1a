"""The rule ensemble: held-out accuracy, statistics by brute force, rules against the trees, messy rows."""

import math
import re
import zlib

import pytest

import messy
from __spark_entry__ import queries
from pyspark.sql import functions as F
from ratingloom.llm import rule_ensemble as ens

FOLDER = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def by_hand(text):
    text = text or ""
    words, chars = WORD.findall(text), len(text)
    lines = [line for line in text.split("\n") if line.strip(" ")]
    n = len(words)

    def share(a, b):
        return a / b if b else 0.0

    return {
        "log_words": math.log1p(n), "word_length": share(sum(map(len, words)), n),
        "symbol_share": share(len(re.findall(r"[#*$%&|<>@^~=_+\\/{}\[\]]", text)), chars),
        "digit_share": share(len(re.findall("[0-9]", text)), chars),
        "calls_per_word": share(len(re.findall("[!?]", text)), n),
        "stops_per_word": share(len(re.findall("[.,;:]", text)), n),
        "short_share": share(sum(len(w) <= 3 for w in words), n),
        "echo_share": share(sum(a == b for a, b in zip(words, words[1:])), n),
        "distinct_words": share(len(set(words)), n), "distinct_lines": share(len(set(lines)), len(lines)),
        "words_per_line": share(n, len(lines)), "wide_share": share(len(text.encode()) - chars, chars)}


def test_statistics(spark):
    docs = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    texts = [*docs, *[r[1] for r in messy.ROWS], "a a a\tb\n\na", "!?!", "  \n \n"]
    found = ens.statistics(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    for row in found:
        for name, value in by_hand(texts[row["doc_id"]]).items():
            assert row[name] == pytest.approx(value, abs=1e-12), (row["doc_id"], name)


def test_held_out_labels(spark):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    found = queries()["op11_rule_ensemble"](spark, FOLDER)
    assert found.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = found.join(labels.select("doc_id", "quality"), "doc_id").collect()
    assert found.count() == 1000 and all(0 <= r["score"] <= 1 for r in rows)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert all(r["predicted"] == (r["score"] >= 0.3) for r in rows)
    test = [r for r in rows if r["held_out"]]
    assert len(test) > 60 and sum(r["predicted"] == r["quality"] for r in test) >= 0.97 * len(test)
    good, bad = ([r["score"] for r in test if r["quality"] == q] for q in (1, 0))
    pairs = [(g > b) + (g == b) / 2 for g in good for b in bad]
    assert sum(pairs) / len(pairs) >= 0.97


def test_held_out_labels_are_not_read(spark):
    """Turning every held-out label round changes no score."""
    docs, labels = (spark.read.parquet(f"{FOLDER}/{n}.parquet") for n in ("documents", "labels"))
    turned = labels.withColumn("quality", F.when(ens.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = ({r["doc_id"]: r["score"] for r in ens.classify(docs, x).collect()} for x in (labels, turned))
    assert a == b


def test_rules_are_the_paths(spark):
    tree = """DecisionTreeClassificationModel: uid=x, depth=2, numNodes=5, numClasses=2, numFeatures=13
  If (feature 2 <= 0.25)
   If (feature 2 <= 0.125)
    Predict: 1.0
   Else (feature 2 > 0.125)
    Predict: 0.0
  Else (feature 2 > 0.25)
   If (feature 9 <= 1.0E-4)
    Predict: 0.0
   Else (feature 9 > 1.0E-4)
    Predict: 1.0
"""
    inf = math.inf
    assert [r.bounds for r in ens.tree_rules(tree)] == [
        ((2, -inf, 0.25),), ((2, -inf, 0.125),), ((2, 0.125, 0.25),), ((2, 0.25, inf),),
        ((2, 0.25, inf), (9, -inf, 1e-4)), ((2, 0.25, inf), (9, 1e-4, inf))]


def test_compiled_score_is_the_sum_of_rules(spark):
    docs, labels = (spark.read.parquet(f"{FOLDER}/{n}.parquet") for n in ("documents", "labels"))
    stats = ens.written(ens.statistics(docs), "statistics")
    model = ens.fit(ens.training_rows(stats, labels))
    assert 0 < len(model.rules) < 100
    for row in stats.withColumn("score", model.score()).collect():
        x = [row[s] for s in ens.STATISTICS]
        total = model.intercept + sum(w for r, w in model.rules if all(a < x[i] <= b for i, a, b in r.bounds))
        total += sum(w * min(max(x[i], a), b) for i, a, b, w in model.linear)
        assert row["score"] == pytest.approx(1 / (1 + math.exp(-total)), abs=1e-12)


def test_messy_rows_and_missing_labels(spark):
    docs = messy.documents(spark)
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 1), (None, 0), (5, None), (13, 0), (13, 0), (15, 1)],
                                   "doc_id long, quality int")
    rows = ens.classify(docs, labels).collect()
    assert len(rows) == len(messy.ROWS) and all(0 <= r["score"] <= 1 for r in rows)
    by_text = {}
    for r in rows:
        by_text.setdefault((r["doc_id"], r["text_hash"]), set()).add(r["score"])
    assert all(len(scores) == 1 for scores in by_text.values())
    assert [r["held_out"] for r in rows if r["doc_id"] is None] == [False] * 3
    assert ens.classify(messy.nothing(spark), labels).count() == 0
    assert {r["score"] for r in ens.classify(docs, labels.limit(0)).collect()} == {0.5}


def test_bound_on_training_rows(spark):
    """An id on many rows counts row by row."""
    stats = ens.statistics(spark.createDataFrame([(1, f"word {i}") for i in range(300)], "doc_id long, text string"))
    labels = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    assert ens.training_rows(stats, labels, max_rows=10).count() == 10
