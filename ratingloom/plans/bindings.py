"""Business and review tables as views of the given test tables.

Each view exists twice: as a DataFrame, and as the text of a SQL common table expression for the
check. Suppliers or parts stand for businesses, line items or documents for reviews.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ratingloom.functions.hours import DAYS
from ratingloom.operators import joins, trends


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


# --- suppliers and line items: dense rating series ----------------------------------------------

def biz(spark: SparkSession, d: str) -> DataFrame:
    places = (table(spark, d, "nation")
              .join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")))
    key = F.col("s_suppkey").cast("string")
    return (table(spark, d, "supplier").join(places, F.col("s_nationkey") == F.col("n_nationkey"))
            .select(key.alias("business_id"), F.col("s_name").alias("name"),
                    F.concat(F.lit("No. "), key).alias("address"), F.col("n_name").alias("city"),
                    F.col("r_name").alias("state"), F.lpad(key, 5, "0").alias("postal")))


def rev(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("business_id"),
        F.ceil(F.col("l_quantity") / 10).cast("double").alias("stars"),
        F.concat("l_returnflag", F.lit(" "), "l_linestatus").alias("review_text"),
        F.col("l_shipdate").alias("datetime"))


def dated(spark: SparkSession, d: str) -> DataFrame:
    return trends.prepare(rev(spark, d))


def monthly(spark: SparkSession, d: str) -> DataFrame:
    return trends.monthly_ratings(dated(spark, d))


BIZ = """
biz AS (SELECT CAST(s_suppkey AS VARCHAR) AS business_id, s_name AS name,
    'No. ' || CAST(s_suppkey AS VARCHAR) AS address, n_name AS city, r_name AS state,
    lpad(CAST(s_suppkey AS VARCHAR), 5, '0') AS postal
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""
REV = """
rev AS (SELECT CAST(l_suppkey AS VARCHAR) AS business_id,
    CAST(ceil(l_quantity / 10) AS DOUBLE) AS stars,
    l_returnflag || ' ' || l_linestatus AS review_text, l_shipdate AS datetime,
    CAST(year(l_shipdate) AS INTEGER) AS year, CAST(month(l_shipdate) AS INTEGER) AS month,
    CAST(quarter(l_shipdate) AS INTEGER) AS quarter
  FROM lineitem)"""


def rounded(expression: str, digits: int) -> str:
    """SQL that rounds half up on the decimal digits, as Spark does. The digits kept before rounding
    must go far beyond it, or a value just below a tie would be rounded up twice."""
    kept = 9 if digits <= 2 else 15
    return f"CAST(round(CAST({expression} AS DECIMAL(28, {kept})), {digits}) AS DOUBLE)"


MONTHLY = f"""
monthly AS (SELECT business_id, year, month, {rounded('avg(stars)', 2)} AS monthly_avg_rating,
    coalesce({rounded('stddev_samp(stars)', 2)}, 0e0) AS monthly_rating_std,
    count(*) AS review_volume
  FROM rev GROUP BY business_id, year, month)"""
QUARTERLY = f"""
quarterly AS (SELECT business_id, year, quarter, {rounded('avg(stars)', 2)} AS avg_quarterly_rating,
    count(*) AS total_reviews, coalesce({rounded('stddev_samp(stars)', 2)}, 0e0) AS rating_volatility
  FROM rev GROUP BY business_id, year, quarter)"""
CHANGES = f"""
lagged AS (SELECT *, lag(monthly_avg_rating) OVER (PARTITION BY business_id ORDER BY year, month)
    AS prev_avg_rating FROM monthly),
changes AS (SELECT *, {rounded('monthly_avg_rating - prev_avg_rating', 2)} AS rating_diff FROM lagged)"""
FLAGGED = """
flagged AS (SELECT *, CASE WHEN rating_diff > 1e0 THEN 'spike' ELSE 'dip' END AS spike_or_dip
  FROM changes WHERE rating_diff > 1e0 OR rating_diff < -1e0)"""


# --- parts and line items: categories, hours, places on a map -----------------------------------

def _day_text(i: int, day: str) -> Column:
    time = F.lit("8:0-17:0")
    if day == "Monday":
        time = F.when(F.col("p_partkey") % 7 == 0, "0:0-0:0").otherwise(time)
    open_bit = F.shiftright("p_size", i) % 2 == 1
    return F.when(open_bit, F.concat(F.lit(f"'{day}': '"), time, F.lit("'")))


def partbiz(spark: SparkSession, d: str) -> DataFrame:
    key = F.col("p_partkey").cast("string")
    days = F.concat_ws(", ", *[_day_text(i, day) for i, day in enumerate(DAYS[:6])])
    return table(spark, d, "part").select(
        key.alias("business_id"), F.col("p_name").alias("name"),
        F.concat(F.lit("No. "), F.col("p_size").cast("string")).alias("address"),
        F.col("p_brand").alias("city"), F.col("p_type").alias("state"),
        F.lpad(key, 5, "0").alias("postal"),
        (25 + F.col("p_partkey") * 37 % 2400 / 100).alias("lat"),
        (-125 + F.col("p_partkey") * 53 % 5800 / 100).alias("lon"),
        F.replace("p_name", F.lit(" "), F.lit(", ")).alias("categories"),
        F.when(F.col("p_partkey") % 10 == 0, "None")
        .otherwise(F.concat(F.lit("{"), days, F.lit("}"))).alias("opening_hours"))


def prev(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").select(
        F.col("l_partkey").cast("string").alias("business_id"),
        F.ceil(F.col("l_quantity") / 10).cast("double").alias("stars"))


def aggregated(spark: SparkSession, d: str) -> DataFrame:
    return joins.join_aggregated(partbiz(spark, d), prev(spark, d))


def sql_hours(key: str = "p_partkey", size: str = "p_size") -> str:
    days = []
    for i, day in enumerate(DAYS[:6]):
        time = f"CASE WHEN {key} % 7 = 0 THEN '0:0-0:0' ELSE '8:0-17:0' END" if i == 0 else "'8:0-17:0'"
        days.append(f"CASE WHEN ({size} >> {i}) % 2 = 1 THEN '''{day}'': ''' || {time} || '''' END")
    return (f"CASE WHEN {key} % 10 = 0 THEN 'None' ELSE '{{' || concat_ws(', ', {', '.join(days)})"
            " || '}' END")


PARTBIZ = f"""
partbiz AS (SELECT CAST(p_partkey AS VARCHAR) AS business_id, p_name AS name,
    'No. ' || CAST(p_size AS VARCHAR) AS address, p_brand AS city, p_type AS state,
    lpad(CAST(p_partkey AS VARCHAR), 5, '0') AS postal,
    25e0 + (p_partkey * 37 % 2400) / 1e2 AS lat, -125e0 + (p_partkey * 53 % 5800) / 1e2 AS lon,
    replace(p_name, ' ', ', ') AS categories, {sql_hours()} AS opening_hours, p_size, p_partkey
  FROM part)"""
PREV = """
prev AS (SELECT CAST(l_partkey AS VARCHAR) AS business_id, CAST(ceil(l_quantity / 10) AS DOUBLE) AS stars
  FROM lineitem)"""
AGGREGATED = """
counts AS (SELECT business_id, """ + ", ".join(
    f"count(*) FILTER (WHERE floor(stars + 5e-1) = {i}) AS star{i}" for i in range(6)) + """
  FROM prev GROUP BY business_id),
agg AS (SELECT partbiz.*, """ + ", ".join(
    f"CAST(coalesce(star{i}, 0) AS INTEGER) AS star{i}" for i in range(6)) + """,
    CAST(""" + " + ".join(f"coalesce(star{i}, 0)" for i in range(6)) + """ AS INTEGER) AS total
  FROM partbiz LEFT JOIN counts USING (business_id))"""
CATEGORY = """
cat AS (SELECT agg.*, trim(lower(c)) AS category FROM agg, unnest(string_split(categories, ',')) AS u(c))"""


# --- documents as reviews -----------------------------------------------------------------------

# Small fixed word lists that find something in the documents.
LEXICON = [("ing", 1.5), ("tion", 2.0), ("ble", 1.0), ("thin", 0.8), ("rewh", -1.5), ("orre", -2.0),
           ("thatin", -1.0), ("inoran", -0.7)]
STOP = ["the", "and", "that", "for", "was", "with", "this", "are", "from"]
DOMAIN = [word for word, _ in LEXICON] + ["ononst", "hehely", "orantion", "ther"]


def texts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select(
        "doc_id", F.col("text").alias("review_text"),
        F.concat_ws("-", "source", F.floor(F.col("doc_id") / 500).cast("string")).alias("business_id"),
        (1 + F.col("n_chars") % 5).cast("double").alias("stars"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 360).cast("int"))
        .cast("timestamp").alias("datetime"))


def lexicon(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(LEXICON, "word string, valence double")


def words(spark: SparkSession, listed: list[str]) -> DataFrame:
    return spark.createDataFrame([(w,) for w in listed], "word string")


TEXTS = """
texts AS (SELECT doc_id, text AS review_text,
    source || '-' || CAST(doc_id // 500 AS VARCHAR) AS business_id,
    CAST(1 + n_chars % 5 AS DOUBLE) AS stars,
    CAST(year(DATE '2024-01-01' + CAST(doc_id % 360 AS INTEGER)) AS INTEGER) AS year,
    CAST(month(DATE '2024-01-01' + CAST(doc_id % 360 AS INTEGER)) AS INTEGER) AS month
  FROM documents)"""
TEXT_MONTHLY = MONTHLY.replace("FROM rev", "FROM texts")
TOKENS = r"""
tok AS (SELECT doc_id, word FROM texts, unnest(string_split_regex(lower(review_text), '\W+')) AS u(word)
  WHERE word <> '')"""
LEX = "\nlex(word, valence) AS (VALUES " + ", ".join(f"('{w}', {v!r}e0)" for w, v in LEXICON) + ")"
STOP_SQL = "(" + ", ".join(f"'{w}'" for w in STOP) + ")"
DOMAIN_SQL = "(" + ", ".join(f"'{w}'" for w in DOMAIN) + ")"
LABELS = """
sums AS (SELECT doc_id, sum(valence) AS s FROM tok JOIN lex USING (word) GROUP BY doc_id),
compounds AS (SELECT doc_id, stars,
    """ + rounded("coalesce(s, 0e0) / sqrt(coalesce(s, 0e0) * coalesce(s, 0e0) + 15e0)", 4) + """ AS compound
  FROM texts LEFT JOIN sums USING (doc_id)),
labels_ AS (SELECT doc_id, stars, compound,
    CASE WHEN compound >= 0.05 THEN 'positive' WHEN compound <= -0.05 THEN 'negative'
      ELSE 'neutral' END AS sentiment,
    CASE WHEN stars >= 4 THEN 'positive' WHEN stars = 3 THEN 'neutral' ELSE 'negative' END
      AS rating_category
  FROM compounds)"""
WORD_COUNTS = f"""
wc AS (SELECT sentiment, word, count(*) AS "count" FROM tok JOIN labels_ USING (doc_id)
  WHERE sentiment <> 'neutral' AND length(word) > 2 AND regexp_matches(word, '^[a-z]+$')
    AND word IN {DOMAIN_SQL} AND word NOT IN {STOP_SQL}
  GROUP BY sentiment, word)"""


# --- embeddings as text vectors -----------------------------------------------------------------

def vectors(spark: SparkSession, d: str) -> DataFrame:
    """Five vectors per business; city 0 holds more than a third of the businesses."""
    business = F.floor(F.col("vec_id") / 5)
    city = F.when(business % 3 == 0, 0).otherwise(business % 10)
    return table(spark, d, "embeddings").select(
        "vec_id", business.cast("string").alias("business_id"),
        F.concat(F.lit("Name "), business.cast("string")).alias("name"),
        F.concat(F.lit("City "), city.cast("string")).alias("city"),
        F.lit("S").alias("state"),
        F.col("embedding").cast("array<double>").alias("vector"))


VECTORS = """
vecs AS (SELECT vec_id, CAST(vec_id // 5 AS VARCHAR) AS business_id,
    'Name ' || CAST(vec_id // 5 AS VARCHAR) AS name,
    'City ' || CAST(CASE WHEN vec_id // 5 % 3 = 0 THEN 0 ELSE vec_id // 5 % 10 END AS VARCHAR) AS city,
    CAST(embedding AS DOUBLE[]) AS vector
  FROM embeddings)"""
PROFILES = """
dims AS (SELECT business_id, name, city, i, avg(vector[i]) AS m
  FROM vecs, unnest(range(1, 65)) AS u(i) GROUP BY business_id, name, city, i),
prof AS (SELECT business_id, name, city, list(m ORDER BY i) AS profile
  FROM dims GROUP BY business_id, name, city)"""
SIMILAR = """
pairs AS (SELECT a.business_id, a.name, a.city, b.business_id AS recommended_business_id,
    b.name AS recommended_name, """ + rounded("list_cosine_similarity(a.profile, b.profile)", 6) + """ AS similarity
  FROM prof a JOIN prof b ON a.city = b.city AND a.business_id <> b.business_id),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY business_id
    ORDER BY similarity DESC, recommended_business_id) AS INTEGER) AS rank FROM pairs),
top AS (SELECT * FROM ranked WHERE rank <= 5)"""


def with_views(views: list[str], select: str) -> str:
    return "WITH " + ",".join(views) + "\n" + select.strip()
