"""The registered queries of this package: name -> (query, checking SQL or None)."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from ratingloom.llm import (coordinate_join, curriculum, digest_index, piece_counts, rule_ensemble, secret_crf,
                            setm, structure_repair, sum_of_squares, target_ratio, token_orc, url_filter, warc)
from ratingloom.llm.shared import table, written
from ratingloom.session import scratch_folder


def op1_warc(spark: SparkSession, d: str) -> DataFrame:
    found = warc.archive_pages(table(spark, d, "pages"), scratch_folder(spark, "warc"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_token_orc(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_folder(spark, "token-orc")
    token_orc.write_tokens(table(spark, d, "documents"), path,
                           public_tokenizers.path("word_bpe_49k.json"), end=1)
    return token_orc.summaries(spark, path)


def op3_target_ratio(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text")
    return target_ratio.judge(docs, table(spark, d, "labels")).drop("text")


def op4_curriculum(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    planned = curriculum.written_plan(docs)
    read = written(curriculum.placed_readings(docs, planned), "mix-readings", "zstd")
    return curriculum.read_back(planned, read).select("doc_id", "size", "source_size", "target", "taken", "positions")


def op5_secret_crf(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    return secret_crf.find_secrets(docs, secret_crf.fit(docs))


def op6_url_filter(spark: SparkSession, d: str) -> DataFrame:
    model = url_filter.fit(url_filter.labelled_urls(spark))
    return url_filter.judge(table(spark, d, "pages"), model)


def op7_sum_of_squares(spark: SparkSession, d: str) -> DataFrame:
    return sum_of_squares.pack(sum_of_squares.encoded(
        table(spark, d, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end=2))


def op8_piece_counts(spark: SparkSession, d: str) -> DataFrame:
    return piece_counts.token_counts(table(spark, d, "documents"),
                                     public_tokenizers.path("piece_bpe_32k.model"))


def op9_digest_index(spark: SparkSession, d: str) -> DataFrame:
    found = digest_index.exact_duplicates(table(spark, d, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept",
                        F.col("digest").alias("text_sha256"))


def op10_coordinate_join(spark: SparkSession, d: str) -> DataFrame:
    found = coordinate_join.near_duplicates(table(spark, d, "documents"), words=2)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op11_rule_ensemble(spark: SparkSession, d: str) -> DataFrame:
    found = rule_ensemble.classify(table(spark, d, "documents"), table(spark, d, "labels"))
    return found.select("doc_id", "held_out", "score", "predicted")


def op12_structure_repair(spark: SparkSession, d: str) -> DataFrame:
    rows = structure_repair.damaged(table(spark, d, "conversations"))
    return structure_repair.summaries(structure_repair.repaired(rows, rows["gone"]))


def op13_setm(spark: SparkSession, d: str) -> DataFrame:
    return setm.collocations(table(spark, d, "documents"))


OP9_SQL = r"""
WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS h
           FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
  doc_id IS NOT DISTINCT FROM min(doc_id) OVER w AS kept, h AS text_sha256
FROM d WINDOW w AS (PARTITION BY h)"""

OP1_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
 d AS (SELECT page_id, octet_length(b) AS n, sha256(b) AS h FROM p),
 f AS (SELECT *, CASE WHEN n >= 100 THEN min(page_id) OVER (PARTITION BY h) END AS first FROM d)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, h AS payload_digest,
  CASE WHEN first <> page_id OR (page_id IS NULL AND first IS NOT NULL) THEN 'revisit'
       ELSE 'response' END AS record_type,
  CASE WHEN first <> page_id OR page_id IS NULL THEN first END AS refers_to
FROM f"""

OP13_SQL = r"""
WITH p AS (SELECT lang, regexp_extract_all(unnest(regexp_split_to_array(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')),
    '[^\x20\x09]+') AS w
  FROM (SELECT coalesce(lang, 'und') AS lang, coalesce(text, '') AS text FROM documents)),
 g AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM p, (VALUES (1), (2), (3), (4)) AS t(k))),
 c AS (SELECT lang, k, phrase, string_split(phrase, ' ') AS w, count(*) AS a FROM g GROUP BY ALL),
 n AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM c WHERE k = 1 GROUP BY lang),
 f AS (SELECT * FROM c WHERE a >= 30),
 cuts AS (SELECT lang, phrase, w, a, j, array_to_string(w[1:j], ' ') AS x, array_to_string(w[j + 1:], ' ') AS y
  FROM (SELECT *, unnest(range(1, k)) AS j FROM f)),
 s AS (SELECT cuts.*, x.a AS l, y.a AS r,
    CAST(CAST(2000000 AS HUGEINT) * cuts.a // (x.a + y.a) AS BIGINT) AS score
  FROM cuts JOIN f x ON x.lang = cuts.lang AND x.phrase = cuts.x JOIN f y ON y.lang = cuts.lang AND y.phrase = cuts.y),
 best AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
 inside AS (SELECT lang, array_to_string(w[i:i + z - 1], ' ') AS phrase, max(a) AS longer
  FROM (SELECT *, unnest(range(1, k - z + 2)) AS i FROM f, (VALUES (2), (3)) AS t(z) WHERE z < k) GROUP BY 1, 2),
 top AS (SELECT best.*, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM best LEFT JOIN inside USING (lang, phrase)
  WHERE longer IS NULL OR CAST(100 AS HUGEINT) * longer < CAST(80 AS HUGEINT) * a)
SELECT lang, rank, phrase, a, l, r, n, score FROM top JOIN n USING (lang) WHERE rank <= 2000"""

QUERIES = {
    "op1_warc": (op1_warc, OP1_SQL),
    "op2_token_orc": (op2_token_orc, None),
    "op3_target_ratio": (op3_target_ratio, None),
    "op4_curriculum": (op4_curriculum, None),
    "op5_secret_crf": (op5_secret_crf, None),
    "op6_url_filter": (op6_url_filter, None),
    "op7_sum_of_squares": (op7_sum_of_squares, None),
    "op8_piece_counts": (op8_piece_counts, None),
    "op9_digest_index": (op9_digest_index, OP9_SQL),
    "op10_coordinate_join": (op10_coordinate_join, None),
    "op11_rule_ensemble": (op11_rule_ensemble, None),
    "op12_structure_repair": (op12_structure_repair, None),
    "op13_setm": (op13_setm, OP13_SQL),
}
