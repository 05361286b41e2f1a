"""Queries on cleaning, joining, sorting, sampling and the sources and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ratingloom.functions.dates import with_date_parts
from ratingloom.functions.numbers import half_up, mean_star, parse_finite, parse_int, ratio
from ratingloom.operators import cleaning, joins, kpis, places, sampling
from ratingloom.plans import bindings as b
from ratingloom.session import scratch_folder
from ratingloom.sources import readers, schemas, writers


# --- incoming lines with planted faults ----------------------------------------------------------

def business_lines(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("p_partkey")
    key = k.cast("string")
    fields = [
        key, F.col("p_name"), F.concat(F.lit("No. "), F.col("p_size").cast("string")),
        F.when(k % 11 == 0, "").otherwise(F.col("p_brand")), F.col("p_type"), F.lpad(key, 5, "0"),
        F.when(k % 13 == 0, "x").otherwise((k % 90).cast("string")),
        (k % 180).cast("string"), F.lit("1"), F.col("p_size").cast("string"), F.lit("1"), F.lit("-"),
        F.concat(F.when(k % 17 == 0, "Shop, ").otherwise("Food, "),
                 F.replace("p_name", F.lit(" "), F.lit(", "))),
        F.when(k % 19 == 0, "  ").otherwise("{'Monday': '8:0-17:0'}"),
    ]
    whole = F.concat_ws("\t", *fields)
    return b.table(spark, d, "part").select(
        F.when(k % 7 == 0, F.concat_ws("\t", *fields[:10], F.lit(""), F.lit(""))).otherwise(whole)
        .alias("value"))


def review_lines(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("l_orderkey") + F.col("l_linenumber")
    key = F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
    stars = F.ceil(F.col("l_quantity") / 10).cast("string")
    return b.table(spark, d, "lineitem").select(F.concat_ws(
        "\t", key, F.lit("u"), F.col("l_partkey").cast("string"),
        F.when(k % 5 == 0, "6").when(k % 23 == 0, "many").otherwise(stars),
        F.lit("0"), F.lit("0"), F.lit("0"),
        F.when(k % 7 == 0, "  ").otherwise(F.concat(F.lit('"Item '), F.col("l_returnflag"))),
        F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss"),
        F.when(k % 9 == 0, "extra")).alias("value"))


BUSINESS_IN = """
bin AS (SELECT p_partkey AS k, CAST(p_partkey AS VARCHAR) AS business_id, p_name AS name,
    'No. ' || CAST(p_size AS VARCHAR) AS address,
    CASE WHEN p_partkey % 11 = 0 THEN '' ELSE p_brand END AS city, p_type AS state,
    lpad(CAST(p_partkey AS VARCHAR), 5, '0') AS postal, CAST(p_partkey % 90 AS DOUBLE) AS lat,
    CAST(p_partkey % 180 AS DOUBLE) AS lon, p_size AS review_count,
    CASE WHEN p_partkey % 17 = 0 THEN 'Shop, ' ELSE 'Food, ' END || replace(p_name, ' ', ', ')
      AS categories, '{''Monday'': ''8:0-17:0''}' AS opening_hours,
    CASE WHEN p_partkey % 7 = 0 THEN 'field_count' WHEN p_partkey % 17 = 0 THEN 'category'
      WHEN p_partkey % 11 = 0 THEN 'missing_field' WHEN p_partkey % 13 = 0 THEN 'bad_number'
      WHEN p_partkey % 19 = 0 THEN 'blank_field' END AS reject_reason
  FROM part)"""
REVIEW_IN = """
rin AS (SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS review_id,
    CAST(l_partkey AS VARCHAR) AS business_id, CAST(ceil(l_quantity / 10) AS DOUBLE) AS stars,
    '"Item ' || l_returnflag AS review_text,
    strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS datetime,
    CASE WHEN (l_orderkey + l_linenumber) % 9 = 0 THEN 'field_count'
      WHEN (l_orderkey + l_linenumber) % 5 = 0 THEN 'stars_range'
      WHEN (l_orderkey + l_linenumber) % 23 = 0 THEN 'bad_number'
      WHEN (l_orderkey + l_linenumber) % 7 = 0 THEN 'blank_text' END AS reject_reason
  FROM lineitem)"""


def clean_business(spark, d):
    return cleaning.clean_business(business_lines(spark, d))[0]


def clean_review(spark, d):
    return cleaning.clean_review(review_lines(spark, d))[0]


def reject_reasons(spark, d):
    business = cleaning.judge_business(business_lines(spark, d)).withColumn(
        "reject_reason", F.concat(F.lit("business "), "reject_reason"))
    review = cleaning.judge_review(review_lines(spark, d)).withColumn(
        "reject_reason", F.concat(F.lit("review "), "reject_reason"))
    return cleaning.reject_reasons(business, review)


def keyword_filter(spark, d):
    part = b.table(spark, d, "part").select("p_partkey", F.upper("p_name").alias("categories"))
    return cleaning.keyword_filter(part, "Ring").select("p_partkey")


def validate_non_blank(spark, d):
    lines = b.table(spark, d, "part").select(
        "p_partkey", F.when(F.col("p_partkey") % 3 == 0, " \t").otherwise(F.col("p_name")).alias("name"),
        F.when(F.col("p_size") % 5 != 0, F.col("p_brand")).alias("brand"))
    return cleaning.validate_non_blank(lines, ["p_partkey", "name", "brand"])


def parse_numbers(spark, d):
    lines = b.table(spark, d, "part").select(
        "p_partkey",
        F.when(F.col("p_partkey") % 13 == 0, "x").when(F.col("p_partkey") % 17 == 0, "NaN")
        .otherwise((F.col("p_size") / 4).cast("string")).alias("a"),
        F.when(F.col("p_partkey") % 11 == 0, "1.0").when(F.col("p_partkey") % 7 == 0, " 7")
        .otherwise(F.lpad(F.col("p_size").cast("string"), 3, "0")).alias("b"))
    return lines.select("p_partkey", parse_finite("a").alias("as_double"), parse_int("b").alias("as_int"))


def string_fns(spark, d):
    part = b.table(spark, d, "part")
    tail = F.split("p_name", " ", 2)
    return part.select(
        "p_partkey", tail[0].alias("first_word"), tail[1].alias("rest"),
        F.upper("p_name").alias("upper_name"), F.lower("p_type").alias("type_lower"),
        F.trim(F.concat(F.lit("  "), "p_name", F.lit(" "))).alias("trimmed"),
        F.col("p_name").contains("ing").alias("has_ing"),
        F.col("p_name").startswith("s").alias("starts_s"), F.col("p_name").endswith("t").alias("ends_t"),
        F.substring("p_brand", 1, 5).alias("brand_head"), F.length("p_name").alias("name_length"),
        F.concat_ws("|", "p_brand", "p_type").alias("joined"),
        F.regexp_replace("p_brand", "[^0-9]", "").alias("digits"))


def numeric_fns(spark, d):
    items = b.table(spark, d, "lineitem")
    half = F.col("l_quantity") / 10
    counts = items.groupBy("l_partkey").agg(
        *[F.count_if(half_up(half) == i).alias(f"star{i}") for i in range(6)],
        F.count("*").alias("total"))
    return counts.select(
        "l_partkey", "total", mean_star([f"star{i}" for i in range(6)], "total").alias("mean_star"),
        ratio(F.col("star5") - F.col("star0"), F.col("star1"), 3).alias("guarded"))


# --- joins and histograms -------------------------------------------------------------------------

def join_raw(spark, d):
    """Every fourth business goes by another id, so that its reviews find none."""
    business = b.partbiz(spark, d).withColumn("business_id", F.when(
        F.col("business_id").cast("int") % 4 == 0, F.concat(F.lit("x"), "business_id")).otherwise(F.col("business_id")))
    reviews = b.table(spark, d, "lineitem").select(
        F.col("l_partkey").cast("string").alias("business_id"),
        F.ceil(F.col("l_quantity") / 10).cast("double").alias("stars"),
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
        .alias("review_text"))
    return joins.join_raw(business, reviews)


def join_aggregated(spark, d):
    """Reviews of every ninth business go to unknown ids."""
    reviews = b.prev(spark, d).withColumn("business_id", F.when(
        F.col("business_id").cast("int") % 9 == 0, F.concat(F.lit("x"), "business_id")).otherwise(F.col("business_id")))
    return joins.join_aggregated(b.partbiz(spark, d), reviews)


def star_histogram(spark, d):
    half = b.table(spark, d, "lineitem").select(
        F.col("l_partkey").alias("business_id"), (F.col("l_quantity") / 10).alias("stars"))
    return joins.star_histogram(half)


def star_histogram_long(spark, d):
    return joins.star_histogram_long(b.aggregated(spark, d))


def drop_null_keys(spark, d):
    reviews = b.rev(spark, d).withColumn("stars", F.when(F.col("stars") != 3, F.col("stars")))
    kept = cleaning.drop_null_keys(reviews, ["business_id", "stars", "datetime"])
    return kept.groupBy("business_id").agg(F.count("*").alias("kept"))


def date_parts(spark, d):
    text = F.when(F.col("l_linenumber") == 3, "2020-13-01 00:00:00").otherwise(
        F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss"))
    parts = with_date_parts(b.table(spark, d, "lineitem").select(text.alias("datetime")))
    return parts.groupBy("year", "month", "quarter").agg(F.count("*").alias("n"))


def sorted_by_key(spark, d):
    lines = b.table(spark, d, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_quantity")
    return joins.sorted_by_key(lines, "l_suppkey")


def sample_n(spark, d):
    lines = b.table(spark, d, "lineitem")
    return sampling.sample_n(lines, [F.desc("l_extendedprice"), "l_orderkey", "l_linenumber", "l_partkey",
                                     "l_suppkey", "l_quantity"], 1000).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")


# --- sources and sinks ----------------------------------------------------------------------------

def load_raw(spark, d):
    """Cleaned and joined from lines, written as tab-separated text, read back by the fixed layout."""
    business = cleaning.clean_business(business_lines(spark, d))[0]
    review = cleaning.clean_review(review_lines(spark, d))[0]
    folder = scratch_folder(spark, "raw")
    writers.write_tsv(joins.join_raw(joins.one_per_key(business, "business_id", ["review_count"]), review),
                      folder)
    return readers.read_raw(spark, folder, escaped=True)


def load_plain(spark, d):
    """A plain table as others write it: backslashes, quotes and ``\\N`` are text, some lines end with a carriage
    return, some lack their last field."""
    k = F.col("p_partkey")
    key = k.cast("string")
    fields = [key, F.concat(F.lit("C:\\new\\temp "), F.col("p_name")), F.when(k % 5 == 0, "\\N").otherwise(F.concat(F.lit('"'), key)),
              F.when(k % 7 == 0, "x").otherwise(F.col("p_size").cast("string"))]
    line = F.when(k % 11 == 0, F.concat_ws("\t", *fields[:3])).otherwise(F.concat_ws("\t", *fields))
    folder = scratch_folder(spark, "plain")
    b.table(spark, d, "part").select(F.concat(line, F.when(k % 3 == 0, "\r").otherwise("")).alias("value")).write.option(
        "lineSep", "\n").text(folder)
    return readers.read_tsv(spark, folder, schemas.struct("key:s path:s mark:s size:i"), escaped=False)


PARTS = schemas.struct("key:l name:s size:i")


def judged_json(spark, d):
    """Lines with planted faults: cut off, a list, text for a number, blank."""
    k = F.col("p_partkey")
    whole = F.to_json(F.struct(k.alias("key"), F.col("p_name").alias("name"), F.when(k % 13 == 0, F.lit("many")).otherwise(
        F.col("p_size").cast("string")).alias("size")))
    number = F.regexp_replace(whole, r'"size":"(\d+)"', '"size":$1')
    line = (F.when(k % 7 == 0, F.substring(number, 1, 12)).when(k % 11 == 0, F.concat(F.lit("["), number, F.lit("]")))
            .when(k % 17 == 0, "  ").otherwise(number))
    folder = scratch_folder(spark, "lines")
    b.table(spark, d, "part").select(line.alias("value")).write.text(folder)
    return readers.judge_json_lines(spark, folder, PARTS).drop("file")


def json_rejects(spark, d):
    return readers.json_rejects(judged_json(spark, d).withColumn("file", F.lit("all"))).drop("file")


def roundtrip_tsv(spark, d):
    folder = scratch_folder(spark, "aggregated")
    writers.write_tsv(b.aggregated(spark, d), folder)
    return readers.read_aggregated(spark, folder, escaped=True)


def roundtrip_text(spark, d):
    """Document texts with tabs, line ends, blanks at the ends, backslashes, empty and null."""
    folder = scratch_folder(spark, "texts")
    kind = F.col("doc_id") % 6
    text = (F.when(kind == 0, F.concat(F.lit(" \\t\t"), "text", F.lit("\r\n\\"))).when(kind == 1, "")
            .when(kind != 2, F.col("text")))
    writers.write_tsv(b.table(spark, d, "documents").select("doc_id", text.alias("text"), "source"), folder)
    return readers.read_tsv(spark, folder, b.table(spark, d, "documents").select("doc_id", "text", "source").schema, escaped=True)


def publish_json(spark, d):
    folder = scratch_folder(spark, "details")
    details = places.business_details(b.aggregated(spark, d))
    writers.write_json(details, folder)
    back = readers.read_json_lines(spark, folder, details.schema)
    return back.withColumn("hours", F.array_join("hours", "|", "-"))


def read_published(spark, d):
    """One table published three ways: JSON lines, CSV with a header, and a JSON array."""
    table = kpis.kpis_long(b.rev(spark, d).join(b.biz(spark, d).select("business_id", "city", "state"),
                                                "business_id"))
    lines, csv, array = (scratch_folder(spark, f"kpis-{kind}") for kind in ("json", "csv", "array"))
    writers.write_json(table, lines, small=True)
    published = readers.read_json_lines(spark, lines, schemas.KPIS)
    writers.write_csv_header(published, csv, small=True)
    packed = published.agg(F.to_json(F.sort_array(F.collect_list(F.struct("metric", "value")))).alias("value"))
    packed.coalesce(1).write.text(array)
    sources = [published, readers.read_csv_header(spark, csv, schemas.KPIS),
               readers.read_json_array(spark, array, schemas.KPIS)]
    return sources[0].union(sources[1]).union(sources[2])


KPI_SQL = f"""
j AS (SELECT rev.*, biz.city, biz.state FROM rev JOIN biz USING (business_id)),
k AS (SELECT count(DISTINCT business_id) AS total_businesses, count(*) AS total_reviews,
    count(DISTINCT state) AS num_states, count(DISTINCT city) AS num_cities,
    {b.rounded('avg(stars)', 2)} AS overall_avg_rating FROM j),
long_ AS (SELECT 'total_businesses' AS metric, format('{{:,}}', total_businesses) AS value FROM k
  UNION ALL SELECT 'total_reviews', format('{{:,}}', total_reviews) FROM k
  UNION ALL SELECT 'num_states', format('{{:,}}', num_states) FROM k
  UNION ALL SELECT 'num_cities', format('{{:,}}', num_cities) FROM k
  UNION ALL SELECT 'overall_avg_rating', CAST(overall_avg_rating AS VARCHAR) FROM k)"""

PLACE_COLUMNS = "business_id, name, address, city, state, postal, lat, lon, categories, opening_hours"
STAR_COLUMNS = ", ".join(f"star{i}" for i in range(6))

JSON_SQL = """
lines AS (SELECT p_partkey AS k, p_name, p_size, '{"key":' || p_partkey || ',"name":"' || p_name || '","size":'
    || CASE WHEN p_partkey % 13 = 0 THEN '"many"' ELSE CAST(p_size AS VARCHAR) END || '}' AS whole FROM part),
judged AS (SELECT *, CASE WHEN k % 7 = 0 THEN 'not_json' WHEN k % 11 = 0 THEN 'no_object' WHEN k % 13 = 0 THEN 'bad_field'
    END AS reject_reason, CASE WHEN k % 7 = 0 THEN substr(whole, 1, 12) WHEN k % 11 = 0 THEN '[' || whole || ']'
    ELSE whole END AS value FROM lines WHERE k % 17 <> 0 OR k % 7 = 0 OR k % 11 = 0)"""

QUERIES = {
    "load_plain": (load_plain, """
SELECT CAST(p_partkey AS VARCHAR) AS key, 'C:\\new\\temp ' || p_name AS path,
  CASE WHEN p_partkey % 5 = 0 THEN '\\N' ELSE '"' || CAST(p_partkey AS VARCHAR) END AS mark,
  CASE WHEN p_partkey % 7 <> 0 AND p_partkey % 11 <> 0 THEN p_size END AS size FROM part"""),
    "judged_json": (judged_json, b.with_views([JSON_SQL], """
SELECT CASE WHEN reject_reason IS NULL THEN k END AS key, CASE WHEN reject_reason IS NULL THEN p_name END AS name,
  CASE WHEN reject_reason IS NULL THEN p_size END AS size, reject_reason,
  CASE WHEN reject_reason IS NOT NULL THEN value END AS value FROM judged""")),
    "json_rejects": (json_rejects, b.with_views([JSON_SQL], """
SELECT reject_reason, count(*) AS lines FROM judged WHERE reject_reason IS NOT NULL GROUP BY reject_reason""")),
    "clean_business": (clean_business, b.with_views([BUSINESS_IN], """
SELECT business_id, name, address, city, state, postal, lat, lon, review_count, categories, opening_hours
FROM bin WHERE reject_reason IS NULL""")),
    "clean_review": (clean_review, b.with_views([REVIEW_IN], """
SELECT review_id, business_id, stars, review_text, datetime FROM rin WHERE reject_reason IS NULL""")),
    "reject_reasons": (reject_reasons, b.with_views([BUSINESS_IN, REVIEW_IN], """
SELECT 'business ' || reject_reason AS reject_reason, count(*) AS lines FROM bin
WHERE reject_reason IS NOT NULL GROUP BY reject_reason
UNION ALL SELECT 'review ' || reject_reason, count(*) FROM rin
WHERE reject_reason IS NOT NULL GROUP BY reject_reason""")),
    "keyword_filter": (keyword_filter, "SELECT p_partkey FROM part WHERE p_name LIKE '%ring%'"),
    "validate_non_blank": (validate_non_blank, """
SELECT p_partkey, p_name AS name, p_brand AS brand FROM part
WHERE p_partkey % 3 <> 0 AND p_size % 5 <> 0"""),
    "parse_numbers": (parse_numbers, """
SELECT p_partkey,
  CASE WHEN p_partkey % 13 <> 0 AND p_partkey % 17 <> 0 THEN p_size / 4e0 END AS as_double,
  CASE WHEN p_partkey % 11 <> 0 AND p_partkey % 7 <> 0 THEN p_size END AS as_int FROM part"""),
    "string_fns": (string_fns, """
SELECT p_partkey, split_part(p_name, ' ', 1) AS first_word,
  substr(p_name, strpos(p_name, ' ') + 1) AS rest, upper(p_name) AS upper_name,
  lower(p_type) AS type_lower, p_name AS trimmed, contains(p_name, 'ing') AS has_ing,
  starts_with(p_name, 's') AS starts_s, suffix(p_name, 't') AS ends_t,
  substr(p_brand, 1, 5) AS brand_head, CAST(length(p_name) AS INTEGER) AS name_length,
  p_brand || '|' || p_type AS joined, regexp_replace(p_brand, '[^0-9]', '', 'g') AS digits
FROM part"""),
    "numeric_fns": (numeric_fns, f"""
WITH c AS (SELECT l_partkey, count(*) AS total, """ + ", ".join(
        f"count(*) FILTER (WHERE floor(l_quantity / 10 + 5e-1) = {i}) AS star{i}" for i in range(6)) + f"""
  FROM lineitem GROUP BY l_partkey)
SELECT l_partkey, total,
  {b.rounded('(star1 + 2 * star2 + 3 * star3 + 4 * star4 + 5 * star5) / CAST(total AS DOUBLE)', 2)}
    AS mean_star,
  {b.rounded('(star5 - star0) / CAST(nullif(star1, 0) AS DOUBLE)', 3)} AS guarded FROM c"""),
    "join_raw": (join_raw, b.with_views([b.PARTBIZ], f"""
SELECT {PLACE_COLUMNS}, CAST(ceil(l_quantity / 10) AS DOUBLE) AS stars,
  CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS review_text
FROM lineitem JOIN partbiz ON l_partkey = p_partkey WHERE p_partkey % 4 <> 0""")),
    "join_aggregated": (join_aggregated, b.with_views(
        [b.PARTBIZ, b.PREV.replace("FROM lineitem", "FROM lineitem WHERE l_partkey % 9 <> 0"),
         b.AGGREGATED],
        f"SELECT {PLACE_COLUMNS}, {STAR_COLUMNS}, total FROM agg")),
    "star_histogram": (star_histogram, "SELECT l_partkey AS business_id, " + ", ".join(
        f"count(*) FILTER (WHERE floor(l_quantity / 10 + 5e-1) = {i}) AS star{i}" for i in range(6))
        + ", count(*) AS total FROM lineitem GROUP BY l_partkey"),
    "star_histogram_long": (star_histogram_long, b.with_views(
        [b.PARTBIZ, b.PREV, b.AGGREGATED], " UNION ALL ".join(
            f"SELECT business_id, {i} AS star, star{i} AS reviews FROM agg" for i in range(6)))),
    "drop_null_keys": (drop_null_keys, b.with_views([b.REV], """
SELECT business_id, count(*) AS kept FROM rev WHERE stars <> 3 GROUP BY business_id""")),
    "date_parts": (date_parts, """
SELECT CASE WHEN l_linenumber <> 3 THEN CAST(year(l_shipdate) AS INTEGER) END AS year,
  CASE WHEN l_linenumber <> 3 THEN CAST(month(l_shipdate) AS INTEGER) END AS month,
  CASE WHEN l_linenumber <> 3 THEN CAST(quarter(l_shipdate) AS INTEGER) END AS quarter,
  count(*) AS n FROM lineitem GROUP BY 1, 2, 3"""),
    "sorted_by_key": (sorted_by_key, """
SELECT l_suppkey, l_orderkey, l_linenumber, l_quantity FROM lineitem
ORDER BY l_suppkey, l_orderkey, l_linenumber, l_quantity"""),
    "sample_n": (sample_n, """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM lineitem
ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity LIMIT 1000"""),
    "load_raw": (load_raw, b.with_views([BUSINESS_IN, REVIEW_IN], """
SELECT business_id, name, address, city, state, postal, lat, lon, categories, opening_hours, stars, review_text,
  datetime
FROM rin JOIN bin USING (business_id) WHERE rin.reject_reason IS NULL AND bin.reject_reason IS NULL""")),
    "roundtrip_tsv": (roundtrip_tsv, b.with_views([b.PARTBIZ, b.PREV, b.AGGREGATED],
        f"SELECT {PLACE_COLUMNS}, {STAR_COLUMNS}, total FROM agg")),
    "roundtrip_text": (roundtrip_text, r"""
SELECT doc_id, CASE doc_id % 6 WHEN 0 THEN ' \t' || chr(9) || text || chr(13) || chr(10) || chr(92) WHEN 1 THEN ''
  WHEN 2 THEN NULL ELSE text END AS text, source FROM documents"""),
    "read_published": (read_published, b.with_views([b.REV, b.BIZ, KPI_SQL],
        "SELECT * FROM long_ UNION ALL SELECT * FROM long_ UNION ALL SELECT * FROM long_")),
}
