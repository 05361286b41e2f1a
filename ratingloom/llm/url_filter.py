"""Verdicts on URLs: hand-written host and path rules first, else a logistic regression on hashed
character n-grams of host and path. Built-in functions and the JVM's ML stages only; no shuffle."""

from __future__ import annotations

import string

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

BUCKETS = 1 << 14
SIZES = (3, 4, 5)
MAX_LABELLED = 10_000

#: (host, path, verdict)
RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("net", "/fr/", "block"))

# Hand-labelled examples: 1 is to be blocked.
LABELLED = (
    ("http://casino-royal-win.test/bonus/free-spins", 1), ("https://www.win-casino.test/play", 1),
    ("http://best-casino.test/en/jackpot", 1), ("https://blog.online-casino.test/fr/12", 1),
    ("http://cheap-meds.test/buy/now", 1), ("https://www.pills-cheap.test/en/order?id=3", 1),
    ("http://cheap-pills-online.test/de/77", 1), ("http://m.pills4u.test/discount", 1),
    ("http://farm-of-spam.test/en/1", 1), ("https://spam-links.test/es/301.html", 1),
    ("http://m.link-farm.test/fr/9", 1), ("https://spamfarm.test/", 1),
    ("http://free-money-now.test/win/cash", 1), ("http://xxx-hot.test/adult/video", 1),
    ("https://viagra-shop.test/buy", 1), ("http://loan-fast-cash.test/apply/now", 1),
    ("http://replica-watches.test/cheap/rolex", 1), ("https://poker-win-big.test/en/bonus", 1),
    ("http://casino-win-big.test/de/5/", 1), ("http://spam-farm-two.test/en/850", 1),
    ("https://www.library.test/en/books/history", 0), ("https://news.daily.test/2021/05/elections", 0),
    ("http://blog.gardens.test/en/853/", 0), ("https://m.weather.test/de/25", 0),
    ("https://university.test/research/papers/12.html", 0), ("http://museum.test/fr/825?page=2", 0),
    ("https://www.recipes.test/es/533/", 0), ("https://docs.project.test/guide/install", 0),
    ("http://forum.cycling.test/en/960", 0), ("https://city-council.test/services/water", 0),
    ("https://www.therth.test/en/148.html", 0), ("http://thnder.test/en/676", 0),
    ("https://tionere.test/fr/414", 0), ("https://blog.ingher.test/es/978?page=2", 0),
    ("http://www.oureth.test/en/453#top", 0), ("https://m.blerth.test/de/770", 0),
    ("https://school.test/courses/mathematics", 0), ("http://hospital.test/visitors/opening-hours", 0),
    ("https://wiki.test/en/Solar_System", 0), ("https://music-review.test/albums/2019/17", 0))


def labelled_urls(spark: SparkSession) -> DataFrame:
    """The hand-labelled table: url, label."""
    return spark.sql("SELECT * FROM VALUES "
                     + ", ".join(f"('{u}', {float(y)}D)" for u, y in LABELLED) + " AS t(url, label)")


def host_path(url: str = "url") -> tuple[Column, Column]:
    """Host, its A-Z in lower case, and path; both empty for null or a URL without ``://``."""
    start = F.instr(F.col(url), "://")
    rest = F.when(start > 0, F.substr(F.col(url), start + 3)).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), r"^[^?#]*", 0)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase), path


def matching_rule(host: Column, path: Column, rules: tuple = RULES) -> tuple[Column, Column]:
    """The longest rule that fits, as host + path, and its verdict; null if none does. A rule fits
    its host and all subdomains if the path starts with the rule's. Of equally long ones the one with
    the longer host wins, then the smaller text, then block. For hand-written lists: each rule is a
    test in the row's expression."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    ranked = sorted(rules, key=lambda r: (-len(r[0] + r[1]), -len(r[0]), r[0] + r[1], r[2] != "block"))
    for at, under, answer in reversed(ranked):
        fits = ((host == at) | host.endswith("." + at)) & path.startswith(under)
        rule = F.when(fits, at + under).otherwise(rule)
        verdict = F.when(fits, answer).otherwise(verdict)
    return rule, verdict


def grams(text: str, mark: str, sizes: tuple = SIZES) -> Column:
    """Character n-grams of the column with its ends marked; none for an empty text."""
    padded = F.concat(F.lit("^"), F.col(text), F.lit("$"))
    lists = [F.when((F.length(text) > 0) & (F.length(padded) >= n),
                    F.transform(F.sequence(F.lit(1), F.length(padded) - (n - 1)),
                                lambda i, n=n: F.concat(F.lit(mark), F.substr(padded, i, F.lit(n)))))
             .otherwise(F.array().cast("array<string>")) for n in sizes]
    return F.concat(*lists)


def features(urls: DataFrame) -> DataFrame:
    host, path = host_path()
    return (urls.withColumn("_host", host).withColumn("_path", path)
            .withColumn("_grams", F.concat(grams("_host", "h"), grams("_path", "p"))))


def fit(labelled: DataFrame, buckets: int = BUCKETS, max_labelled: int = MAX_LABELLED,
        penalty: float = 0.01) -> PipelineModel:
    """Trained on at most ``max_labelled`` rows (url, label), the first by a hash of the URL: label 1
    is to be blocked. Rows without a label are left out."""
    rows = (labelled.where("label is not null").select("url", F.col("label").cast("double").alias("label"))
            .orderBy(F.xxhash64("url"), "url", "label").limit(max_labelled))
    return Pipeline(stages=[
        HashingTF(inputCol="_grams", outputCol="_vector", numFeatures=buckets, binary=True),
        LogisticRegression(featuresCol="_vector", labelCol="label", regParam=penalty, maxIter=100,
                           probabilityCol="_probability", rawPredictionCol="_raw",
                           predictionCol="_block", standardization=False),
    ]).fit(features(rows))


def judge(pages: DataFrame, model: PipelineModel, rules: tuple = RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, by_model (the model's own verdict) for every row.

    Repeated rows and null ids are judged like any other. A URL with neither host nor path gets
    the verdict of the model's intercept. Only page_id and url are read.
    """
    scored = model.transform(features(pages.select("page_id", "url")))
    rule, verdict = matching_rule(F.col("_host"), F.col("_path"), rules)
    by_model = F.when(F.col("_block") == 1.0, "block").otherwise("allow")
    return scored.select("page_id", F.col("_host").alias("host"), F.col("_path").alias("path"),
                         rule.alias("rule"), F.coalesce(verdict, by_model).alias("verdict"),
                         by_model.alias("by_model"))
