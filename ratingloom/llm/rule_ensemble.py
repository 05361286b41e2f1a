"""A quality classifier made of rules: paths of shallow trees, weighted by a lasso logistic regression.

Texts are reduced once to a narrow table of statistics. A forest of shallow trees is grown on a bounded
sample of labelled rows; every path from a root is a rule, a conjunction of bounds on statistics. A
logistic regression with an L1 penalty picks few of the rules and gives them weights, and these become one
Spark column expression. So scoring is a projection over the narrow table, without Python.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, functions as F

from ratingloom.llm.shared import SPACES, WORD, row_hash, written

# At most so many labelled rows train the classifier; which ones, a hash of id and text decides.
MAX_LABELLED = 20_000
TREES = 24
DEPTH = 3
SEED = 11
# Weight of the L1 penalty: the larger, the fewer rules are left.
PENALTY = 0.001
# Statistics enter the regression as they are too, cut at these quantiles of the sample.
CUT = (0.025, 0.975)
LINEAR_SPREAD = 0.4

# A word that is followed by itself.
ECHO = (r"(?<![^\x20\x09-\x0D])([^\x20\x09-\x0D]++)[\x20\x09-\x0D]++(?=\1(?:[\x20\x09-\x0D]|\z))")
#: name -> Java pattern whose matches are counted
COUNTS = {
    "words": WORD,
    "blanks": r"[\x20\x09-\x0D]",
    "symbols": r"[#*$%&|<>@^~=_+\\/{}\[\]]",
    "capitals": r"\p{Lu}",
    "digits": r"[0-9]",
    "calls": "[!?]",
    "stops": "[.,;:]",
    "short": r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D]{1,3}+(?![^\x20\x09-\x0D])",
    "echoes": ECHO,
}


def _share(part: Column, whole: Column) -> Column:
    """0 where there is nothing to share."""
    return F.when(whole > 0, part.cast("double") / whole).otherwise(F.lit(0.0))


def _share_distinct(values: Column) -> Column:
    return _share(F.size(F.array_distinct(values)), F.size(values))


#: The statistics, in the order in which the trees number them.
STATISTICS = ("log_words", "word_length", "symbol_share", "capital_share", "digit_share", "calls_per_word",
              "stops_per_word", "short_share", "echo_share", "distinct_words", "distinct_lines",
              "words_per_line", "wide_share")


def statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, text_hash and ``STATISTICS`` (double) of every row.

    Null texts count as empty; a text without words has 0 in every statistic but ``wide_share`` and
    the shares of characters it does have. Further columns of ``docs`` are not read.
    """
    counted = docs.select(
        F.col("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("t")).select(
        "doc_id", row_hash("t").alias("text_hash"), F.length("t").alias("chars"),
        F.octet_length("t").alias("bytes"),
        *[F.regexp_count("t", F.lit(pattern)).alias(name) for name, pattern in COUNTS.items()],
        F.filter(F.split("t", "\n"), lambda line: F.trim(line) != "").alias("lines"),
        _share_distinct(F.filter(F.split("t", SPACES), lambda w: w != "")).alias("distinct_words"))
    c = F.col
    return counted.select(
        "doc_id", "text_hash",
        F.log1p(c("words")).alias("log_words"),
        _share(c("chars") - c("blanks"), c("words")).alias("word_length"),
        _share(c("symbols"), c("chars")).alias("symbol_share"),
        _share(c("capitals"), c("chars")).alias("capital_share"),
        _share(c("digits"), c("chars")).alias("digit_share"),
        _share(c("calls"), c("words")).alias("calls_per_word"),
        _share(c("stops"), c("words")).alias("stops_per_word"),
        _share(c("short"), c("words")).alias("short_share"),
        _share(c("echoes"), c("words")).alias("echo_share"),
        "distinct_words",
        _share_distinct(c("lines")).alias("distinct_lines"),
        _share(c("words"), F.size("lines")).alias("words_per_line"),
        _share(c("bytes") - c("chars"), c("chars")).alias("wide_share"))


@dataclass(frozen=True)
class Rule:
    """Bounds on statistics that hold together: (number of the statistic, above, up to)."""

    bounds: tuple[tuple[int, float, float], ...]

    def column(self) -> Column:
        parts = []
        for i, low, high in self.bounds:
            if low > -math.inf:
                parts.append(F.col(STATISTICS[i]) > F.lit(low))
            if high < math.inf:
                parts.append(F.col(STATISTICS[i]) <= F.lit(high))
        return reduce(lambda a, b: a & b, parts)


def tree_rules(tree: str) -> list[Rule]:
    """One rule per node below the root of a tree, from the tree's printed form (``toDebugString``)."""
    path: list[tuple[int, int, str, float]] = []
    found = []
    for line in tree.splitlines():
        step = re.match(r"( *)(?:If|Else) \(feature (\d+) (<=|>) (\S+)\)", line)
        if not step:
            continue
        depth = len(step[1])
        path = [p for p in path if p[0] < depth] + [(depth, int(step[2]), step[3], float(step[4]))]
        bounds: dict[int, tuple[float, float]] = {}
        for _, i, sign, value in path:
            low, high = bounds.get(i, (-math.inf, math.inf))
            bounds[i] = (low, min(high, value)) if sign == "<=" else (max(low, value), high)
        found.append(Rule(tuple((i, *bounds[i]) for i in sorted(bounds))))
    return found


@dataclass(frozen=True)
class Ensemble:
    """The fitted classifier: intercept, weighted rules, and weighted statistics with their cuts."""

    intercept: float
    rules: tuple[tuple[Rule, float], ...] = ()
    linear: tuple[tuple[int, float, float, float], ...] = ()  # statistic, low, high, weight

    def logit(self) -> Column:
        total = F.lit(self.intercept)
        for rule, weight in self.rules:
            total = total + F.when(rule.column(), F.lit(weight)).otherwise(F.lit(0.0))
        for i, low, high, weight in self.linear:
            total = total + F.lit(weight) * _cut(i, low, high)
        return total

    def score(self) -> Column:
        return 1 / (1 + F.exp(-self.logit()))


def _cut(i: int, low: float, high: float) -> Column:
    return F.least(F.greatest(F.col(STATISTICS[i]), F.lit(low)), F.lit(high))


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a document's label is never learned from. A null id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def training_rows(stats: DataFrame, labels: DataFrame, max_rows: int = MAX_LABELLED) -> DataFrame:
    """label and statistics of at most ``max_rows`` labelled rows, in a fixed order in one small file.

    Ids are chosen by a hash, so that the shares of the labels stay; rows of an id that is repeated
    often count towards the bound. A document with both labels gives a row for each.
    """
    known = (labels.where("quality in (0, 1) and doc_id is not null")
             .select(F.col("doc_id").cast("long").alias("_id"), F.col("quality").cast("double").alias("label"))
             .where(~held_out("_id")).distinct())
    chosen = known.orderBy(F.xxhash64("_id"), "_id", "label").limit(max_rows)
    order = [F.xxhash64("_id", "text_hash"), F.col("_id"), F.col("label"), *[F.col(s) for s in STATISTICS]]
    rows = (stats.join(F.broadcast(chosen), F.col("doc_id").cast("long") == F.col("_id"))
            .orderBy(*order).limit(max_rows).select("label", *STATISTICS))
    # The forest draws its samples by partition, so a fixed result needs one partition in one order.
    return written(rows.coalesce(1).sortWithinPartitions("label", *STATISTICS), "rule-sample").coalesce(1)


def fit(sample: DataFrame, trees: int = TREES, depth: int = DEPTH, penalty: float = PENALTY,
        seed: int = SEED) -> Ensemble:
    """Grows the trees, takes their paths as rules and weighs them. Without labels of both kinds there is
    no rule, and every text gets the smoothed share of label 1."""
    share = sample.agg(F.count("*").alias("n"), F.coalesce(F.sum("label"), F.lit(0.0)).alias("good")).first()
    if share["good"] in (0, share["n"]):
        return Ensemble(math.log((share["good"] + 1) / (share["n"] - share["good"] + 1)))
    sample = sample.cache()
    try:
        forest = RandomForestClassifier(
            numTrees=trees, maxDepth=depth, subsamplingRate=0.5, featureSubsetStrategy="onethird",
            minInstancesPerNode=2, seed=seed).fit(
            VectorAssembler(inputCols=list(STATISTICS), outputCol="features").transform(sample))
        rules = sorted({r for tree in forest.trees for r in tree_rules(tree.toDebugString)},
                       key=lambda r: r.bounds)
        edges = sample.agg(*[F.percentile_approx(s, list(CUT), 10_000).alias(s) for s in STATISTICS]).first()
        linear = []
        spreads = sample.agg(*[F.stddev_pop(_cut(i, *edges[s])).alias(s)
                               for i, s in enumerate(STATISTICS)]).first()
        for i, s in enumerate(STATISTICS):
            if spreads[s] > 0:
                linear.append((i, edges[s][0], edges[s][1], LINEAR_SPREAD / spreads[s]))
        terms = [r.column().cast("double") for r in rules] + [
            F.lit(scale) * _cut(i, low, high) for i, low, high, scale in linear]
        model = LogisticRegression(elasticNetParam=1.0, regParam=penalty, maxIter=100, standardization=False).fit(
            sample.select("label", array_to_vector(F.array(*terms)).alias("features")))
    finally:
        sample.unpersist()
    weights = [float(w) for w in model.coefficients.toArray()]
    return Ensemble(
        float(model.intercept),
        tuple((r, w) for r, w in zip(rules, weights) if w),
        tuple((i, low, high, scale * w)
              for (i, low, high, scale), w in zip(linear, weights[len(rules):]) if w))


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.3,
             max_rows: int = MAX_LABELLED) -> DataFrame:
    """doc_id, text_hash, the statistics, held_out, score and predicted for every row of ``docs``.

    Labels of held-out documents are not looked at; null ids never match a label. Repeated rows get a row
    each with equal scores; null and empty texts are scored by their zeros; an empty table gives no rows.
    """
    stats = written(statistics(docs), "statistics", "zstd")
    model = fit(training_rows(stats, labels, max_rows))
    return (stats.withColumn("held_out", held_out()).withColumn("score", model.score())
            .withColumn("predicted", (F.col("score") >= F.lit(threshold)).cast("int")))
