"""Quality rules and a log-likelihood ratio between trusted target and raw corpus.

Both are multinomials over hashed character n-grams (bytes of the UTF-8 text): the raw one counts
every document of the corpus, the trusted one every document labelled good. A document's score is
the mean log ratio over its n-grams. The threshold comes from the scores of all labelled documents,
so that every document is judged by one fixed number.
"""

from __future__ import annotations

import sys
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window, functions as F

from ratingloom.llm.shared import written
from ratingloom.operators.spread import spread_join

cloudpickle.register_pickle_by_value(sys.modules[__name__])

GRAM = 3
BITS = 16
# Without labels of both kinds: a document is rejected if its n-grams are, in the geometric mean,
# less than 60 % as likely in the target as in the corpus.
DEFAULT_THRESHOLD = float(np.log(0.6))
MIN_WORDS = 50
REPEAT_PERCENT = 50
SYMBOLS = "#*$%&|<>"

FEATURES = ("n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
            "n_repeat_words bigint, base_failed boolean, score double")


def gram_buckets(text: str | None) -> np.ndarray:
    """The bucket of each n-gram of the text with a blank at either end; none for an empty text."""
    if not text:
        return np.empty(0, np.int64)
    raw = np.frombuffer(f" {text} ".encode("utf-8", "surrogatepass"), np.uint8).astype(np.uint64)
    rows = max(0, len(raw) - GRAM + 1)
    code = raw[:rows]
    for i in range(1, GRAM):
        code = (code << np.uint64(8)) | raw[i:rows + i]
    return ((code * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BITS)).astype(np.int64)


def count_buckets(texts: pd.Series) -> np.ndarray:
    total = np.zeros(1 << BITS, np.int64)
    for text in texts:
        total += np.bincount(gram_buckets(text), minlength=1 << BITS)
    return total


def corpus_counts(docs: DataFrame) -> np.ndarray:
    """How often each bucket occurs in all texts: every task counts its own, the sums are added up
    by bucket. The vector has 2**BITS numbers at any input."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(1 << BITS, np.int64)
        for batch in batches:
            for text in batch["text"]:
                found = gram_buckets(text)
                if len(found) < 1 << 12:
                    np.add.at(total, found, 1)
                else:
                    total += np.bincount(found, minlength=1 << BITS)
        used = np.flatnonzero(total)
        yield pd.DataFrame({"bucket": used, "n": total[used]})

    rows = (docs.select(F.col("text").cast("string").alias("text"))
            .mapInPandas(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")))
    out = np.zeros(1 << BITS, np.int64)
    for row in rows.collect():
        out[row["bucket"]] = row["n"]
    return out


def labelled_ids(labels: DataFrame) -> DataFrame:
    """doc_id and quality of all labelled documents, each pair once."""
    return written(labels.where("quality in (0, 1) and doc_id is not null").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).distinct(),
        "labelled-ids")


def best_threshold(scored: DataFrame) -> float:
    """Of rows (quality, score), the middle of the gap between scores that separates both kinds best.

    Scores are sorted by range, so a task has one range of them; the sums below a range come from one row per range.
    """
    counts = scored.groupBy("score").agg(F.count_if(F.col("quality") == 1).alias("good"),
                                         F.count_if(F.col("quality") == 0).alias("bad"))
    laid = written(counts.repartitionByRange("score").sortWithinPartitions("score").withColumn(
        "task", F.shiftrightunsigned(F.monotonically_increasing_id(), 33)), "label-scores")
    ranges = laid.groupBy("task").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"),
                                      F.max("score").alias("last")).orderBy("task").collect()
    all_good, all_bad = (sum(r[c] for r in ranges) for c in ("good", "bad"))
    if not all_good or not all_bad:
        return DEFAULT_THRESHOLD
    rows, good, bad, last = [], 0, 0, None
    for r in ranges:
        rows.append((r["task"], good, bad, last))
        good, bad, last = good + r["good"], bad + r["bad"], r["last"]
    below = scored.sparkSession.createDataFrame(
        rows, "task long, good_before long, bad_before long, score_before double")
    inside = Window.partitionBy("task").orderBy("score")
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    gain = ((F.col("bad_before") + F.sum("bad").over(upto) - F.col("bad")) / F.lit(float(all_bad))
            - (F.col("good_before") + F.sum("good").over(upto) - F.col("good")) / F.lit(float(all_good)))
    splits = laid.join(F.broadcast(below), "task").select(
        F.round(gain, 12).alias("gain"), (-F.col("score")).alias("low"), "score",
        F.coalesce(F.lag("score").over(inside), F.col("score_before")).alias("before"))
    best = splits.where("before IS NOT NULL").agg(F.max(F.struct("gain", "low", "score", "before")).alias("b")).first()["b"]
    return DEFAULT_THRESHOLD if best is None or best["gain"] <= 0 else float((best["before"] + best["score"]) / 2)


def fit(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, float]:
    """The log ratio of each bucket, and the threshold.

    The threshold is the score that separates the labelled documents best (largest share of good
    documents at or above it plus share of bad ones below), in the middle of the gap between the
    scores next to it; of equally good gaps the lowest. Without labels of both kinds it is ``DEFAULT_THRESHOLD``;
    without trusted text the ratio is 0 everywhere. No text is written. While the ids of good documents are small
    enough to be sent, texts do not move either; beyond, they are shuffled once.
    """
    texts, ids = docs.select("doc_id", "text"), labelled_ids(labels)
    raw = corpus_counts(docs)
    target = corpus_counts(spread_join(texts, ids.where("quality = 1").select("doc_id"), ["doc_id"]))
    if not target.sum():
        return np.zeros(1 << BITS), DEFAULT_THRESHOLD
    ratio = (np.log((target + 0.5) / (target.sum() + 0.5 * len(target)))
             - np.log((raw + 0.5) / (raw.sum() + 0.5 * len(raw))))
    # Scores are joined with the labels, not texts, whatever the number of labels.
    scored = written(with_features(texts, ratio).where("not base_failed").select("doc_id", "score"), "scores")
    return ratio, best_threshold(spread_join(scored, ids, ["doc_id"]).select("quality", "score"))


def text_features(text: str | None, ratio: np.ndarray) -> tuple:
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    n = len(words)
    windows = list(zip(words, words[1:], words[2:]))
    often = {w for w, c in Counter(windows).items() if c > 1}
    repeated, upto = 0, 0
    if often:
        for i, window in enumerate(windows):
            if window in often:
                repeated += i + 3 - max(i, upto)
                upto = i + 3
    lines = Counter(line for line in raw.split(b"\n") if line.split())
    found = gram_buckets(text)
    return (n, sum(len(w.decode("utf-8", "surrogatepass")) for w in words) if not text.isascii()
            else sum(map(len, words)),
            sum(text.count(c) for c in SYMBOLS), sum(c - 1 for c in lines.values()), repeated,
            n < MIN_WORDS or 100 * repeated > REPEAT_PERCENT * n,
            float(ratio[found].mean()) if len(found) else 0.0)


def with_features(docs: DataFrame, ratio: np.ndarray) -> DataFrame:
    """``docs`` with the columns of ``FEATURES`` added, which replace columns of the same name."""
    table = docs.sparkSession.sparkContext.broadcast(ratio)

    @F.pandas_udf(FEATURES)
    def measure(texts: pd.Series) -> pd.DataFrame:
        names = [part.split()[0] for part in FEATURES.split(", ")]
        return pd.DataFrame([text_features(text, table.value) for text in texts], columns=names)

    out = docs.withColumn("_measured", measure.asNondeterministic()(F.col("text").cast("string")))
    for name in (part.split()[0] for part in FEATURES.split(", ")):
        out = out.withColumn(name, F.col("_measured")[name])
    return out.drop("_measured")


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` with the rules' counts, ``score`` and ``kept``.

    A document fails with fewer than 50 words or if more than half its words are in repeated windows
    of three. Any other is kept if its score reaches the threshold. Null and empty texts have no words
    and fail. Repeated rows and null ids are judged like any other; an empty table gives no rows.
    """
    ratio, threshold = fit(docs, labels)
    return with_features(docs, ratio).withColumn(
        "kept", ~F.col("base_failed") & (F.col("score") >= F.lit(threshold)))


def kept_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, with their own columns only."""
    packed = docs.select(F.struct("*").alias("_row"), "doc_id", "text")
    return judge(packed, labels).where("kept").select("_row.*")
