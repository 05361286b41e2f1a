"""Queries on review texts: sentiment, words, spike topics."""

from __future__ import annotations

from pyspark.sql import functions as F

from ratingloom.functions import wordlists as wl
from ratingloom.operators import sentiment, topics, trends, words
from ratingloom.plans import bindings as b


def _labelled(spark, d):
    scored = sentiment.lexicon_sentiment(b.texts(spark, d), "doc_id", "review_text", b.lexicon(spark),
                                         ["stars"])
    return scored.withColumn("rating_category", sentiment.rating_category("stars"))


def _counts(spark, d):
    return words.word_counts(b.texts(spark, d), "doc_id", "review_text", _labelled(spark, d),
                             b.DOMAIN, b.STOP)


def tokens(spark, d):
    return words.token_table(b.texts(spark, d), "doc_id", "review_text").groupBy("doc_id", "word").agg(
        F.count("*").alias("n"), F.max("pos").alias("last_pos"))


def tokens_whitespace(spark, d):
    parts = words.whitespace_tokens(b.texts(spark, d), "doc_id", "review_text")
    return parts.groupBy("word").agg(F.count("*").alias("n"))


def token_filter(spark, d):
    kept = words.token_filter(words.token_table(b.texts(spark, d), "doc_id", "review_text"))
    return kept.groupBy("word").agg(F.count("*").alias("n"))


def lexicon_semi(spark, d):
    table = words.token_table(b.texts(spark, d), "doc_id", "review_text")
    return words.keep_words(table, b.words(spark, b.DOMAIN)).select("doc_id", "word")


def stopword_anti(spark, d):
    table = words.token_table(b.texts(spark, d), "doc_id", "review_text")
    return (words.drop_words(table, b.words(spark, b.STOP))
            .groupBy("doc_id").agg(F.count("*").alias("n")))


def lexicon_sentiment(spark, d):
    return _labelled(spark, d).select("doc_id", "compound", "sentiment")


def rule_sentiment(spark, d):
    return sentiment.rule_sentiment(b.texts(spark, d), "doc_id", "review_text", b.lexicon(spark))


def sentiment_label(spark, d):
    return (b.table(spark, d, "lineitem")
            .groupBy(sentiment.sentiment_label((F.col("l_discount") - F.lit(0.05)) * 2).alias("sentiment"))
            .agg(F.count("*").alias("n")))


def rating_category(spark, d):
    half = F.when(F.col("l_linenumber") != 2, F.floor(F.col("l_quantity") / 5) / 2)
    return (b.table(spark, d, "lineitem")
            .groupBy(sentiment.rating_category(half).alias("rating_category"))
            .agg(F.count("*").alias("n")))


def word_counts(spark, d):
    return _counts(spark, d)


def word_frequencies(spark, d):
    return words.word_frequencies(_counts(spark, d))


def wordclouds(spark, d):
    return words.wordclouds(_counts(spark, d), n=5)


def vocab_union(spark, d):
    return words.vocab_union(_counts(spark, d))


def label_summary(spark, d):
    return sentiment.label_summary(_labelled(spark, d))


def label_summary_long(spark, d):
    return sentiment.label_summary_long(sentiment.label_summary(_labelled(spark, d)))


def sentiment_vs_rating(spark, d):
    return sentiment.sentiment_vs_rating(_labelled(spark, d))


# --- spike topics -------------------------------------------------------------------------------

def _flagged(spark, d):
    return trends.spikes_dips(trends.monthly_ratings(trends.prepare(b.texts(spark, d))))


def _spike_reviews(spark, d):
    return topics.spike_reviews(trends.prepare(b.texts(spark, d)), _flagged(spark, d))


def _spike_tokens(spark, d):
    return topics.topic_token_table(_spike_reviews(spark, d), topics.SEGMENT, "review_text", b.STOP)


def spike_reviews(spark, d):
    return _spike_reviews(spark, d).select("doc_id", "business_id", "year", "month", "review_text")


def topic_tokens(spark, d):
    table = topics.topic_token_table(b.texts(spark, d), ["doc_id"], "review_text", b.STOP)
    return table.groupBy("doc_id").agg(F.count("*").alias("tokens"),
                                       F.count_distinct("term").alias("terms"))


def bag_of_words(spark, d):
    table = topics.topic_token_table(b.texts(spark, d), ["doc_id"], "review_text", b.STOP)
    return topics.bag_of_words(table, "doc_id")


def segment_top_terms(spark, d):
    return topics.segment_top_terms(_spike_tokens(spark, d))


def spike_report(spark, d):
    report = topics.spike_report(_flagged(spark, d), topics.segment_topics(_spike_tokens(spark, d)))
    return report.withColumn("topics", F.array_join("topics", " ; "))


def lda_topics(spark, d):
    return topics.lda_topics(_spike_reviews(spark, d), "doc_id", "review_text", b.STOP)


def lda_report(spark, d):
    report = topics.spike_report(_flagged(spark, d), topics.lda_segment_topics(lda_topics(spark, d)))
    return report.withColumn("topics", F.array_join("topics", " ; "))


def topic_word_merge(spark, d):
    name = F.split("p_name", " ")
    string = F.format_string('0.%03d*"%s" + 0.%03d*"%s"', F.col("p_size"), F.upper(name[0]),
                             F.col("p_size") * 3, name[1])
    strings = b.table(spark, d, "part").select(
        F.col("p_brand").alias("business_id"), F.array(string).alias("topics"))
    return topics.topic_word_merge(strings, ["business_id"])


LEXED = [b.TEXTS, b.TOKENS, b.LEX, b.LABELS]
COUNTED = [*LEXED, b.WORD_COUNTS]
TEXT_FLAGS = [b.TEXTS, b.TEXT_MONTHLY, b.CHANGES, b.FLAGGED]
SPIKED = """
spiked AS (SELECT * FROM texts WHERE (business_id, year, month) IN
  (SELECT (business_id, year, month) FROM flagged))"""


def terms_sql(source: str) -> str:
    return rf"""
terms AS (SELECT doc_id, business_id, year, month, term FROM {source},
    unnest(string_split_regex(regexp_replace(lower(review_text), '[^a-z\s]', '', 'g'), '\s+')) AS u(term)
  WHERE length(term) > 2 AND term NOT IN {b.STOP_SQL})"""


TOP_TERMS = f"""
tc AS (SELECT business_id, year, month, term, count(*) AS n FROM terms GROUP BY ALL),
tt AS (SELECT *, CAST(sum(n) OVER (PARTITION BY business_id, year, month) AS DOUBLE) AS a,
    CAST(row_number() OVER (PARTITION BY business_id, year, month ORDER BY n DESC, term) AS INTEGER) AS rank
  FROM tc),
tops AS (SELECT business_id, year, month, rank, term, n, {b.rounded('n / a', 3)} AS weight
  FROM tt WHERE rank <= 5)"""

def _sql_list(words: list[str]) -> str:
    return "(" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + ")"


def _rules() -> str:
    """The sentiment rules over words with their positions, one step after another."""
    marks = "|".join("".join("\\" + ch for ch in mark) for mark in sorted(wl.PUNCTUATION, key=len, reverse=True))
    marks, plain = marks.replace("'", "''"), "([^[:punct:]]{2,})"

    def bare(word: str) -> str:
        return f"regexp_replace({word}, '^(?:(?:{marks}){plain}|{plain}(?:{marks}))$', '\\1\\2')"

    def shouted(word: str) -> str:
        return f"(upper({word}) = {word} AND lower({word}) <> {word})"

    def negates(word: str) -> str:
        return f"({word} IN {_sql_list(wl.NEGATIONS)} OR contains({word}, 'n''t'))"

    near = ", ".join(f"coalesce({f'lag(w, {n})' if n > 0 else f'lead(w, {-n})'} OVER o, '') AS {c}"
                     for c, n in [("p1", 1), ("p2", 2), ("p3", 3), ("n1", -1), ("n2", -2)])
    known = ", ".join(f"lower(p{n}) IN (SELECT word FROM lex) AS k{n}, lower(p{n}) AS l{n}" for n in (1, 2, 3))
    steps = [rf"""
rw AS (SELECT doc_id, review_text, list_filter(string_split_regex(review_text, '[\s\x{{0b}}\x{{85}}\p{{Z}}]+'),
    lambda x: length(x) > 1) AS ws FROM texts),
rp AS (SELECT doc_id, i - 1 AS i, ws[i] AS raw, {bare('ws[i]')} AS w FROM rw, unnest(range(1, len(ws) + 1)) AS u(i)),
rd AS (SELECT doc_id, count(*) FILTER (WHERE {shouted('raw')}) BETWEEN 1 AND count(*) - 1 AS mixed,
    min(i) FILTER (WHERE lower(w) = 'but') AS but FROM rp GROUP BY doc_id),
rc AS (SELECT *, {near} FROM rp WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
r0 AS (SELECT rc.*, mixed, but, lower(w) AS lw, lower(n1) AS m1, lower(n2) AS m2, {known},
    valence + CASE WHEN mixed AND {shouted('w')} THEN CASE WHEN valence > 0 THEN {wl.CAPITALS}e0 ELSE -{wl.CAPITALS}e0 END
      ELSE 0e0 END AS v
  FROM rc JOIN lex ON lower(w) = lex.word JOIN rd USING (doc_id)
  WHERE NOT (lower(w) IN {_sql_list(wl.INTENSIFIERS + wl.DAMPENERS)} OR (lower(w) = 'kind' AND lower(n1) = 'of')))"""]
    turns = {1: "", 2: "WHEN l2 = 'never' AND l1 IN ('so', 'this') THEN 1.5e0",
             3: "WHEN (l3 = 'never' AND l2 IN ('so', 'this')) OR l1 IN ('so', 'this') THEN 1.25e0"}
    for n, damping in (1, 1.0), (2, 0.95), (3, 0.9):
        loud = f"CASE WHEN mixed AND {shouted(f'p{n}')} THEN {wl.CAPITALS}e0 ELSE 0e0 END"
        push = (f"CASE WHEN l{n} IN {_sql_list(wl.INTENSIFIERS)} THEN {wl.BOOST}e0 "
                f"WHEN l{n} IN {_sql_list(wl.DAMPENERS)} THEN -{wl.BOOST}e0 END")
        steps.append(f"""
r{n}a AS (SELECT * REPLACE (v + CASE WHEN i >= {n} AND NOT k{n} THEN coalesce(CASE WHEN v > 0 THEN {push} + {loud}
    ELSE -({push}) - {loud} END, 0e0) * {damping}e0 ELSE 0e0 END AS v) FROM r{n - 1}),
r{n} AS (SELECT * REPLACE (v * CASE WHEN i >= {n} AND NOT k{n} THEN CASE {turns[n]}
    WHEN {negates(f'l{n}')} THEN {wl.NEGATION}e0 ELSE 1e0 END ELSE 1e0 END AS v) FROM r{n}a)""")

    def idiom(*words: str) -> str:
        cases = " ".join(f"WHEN '{phrase}' THEN {value}e0" for phrase, value in wl.IDIOMS.items())
        return f"CASE concat_ws(' ', {', '.join(words)}) {cases} END"

    found = ", ".join(idiom(*p) for p in [("lw", "m1", "m2"), ("lw", "m1"), ("l1", "lw"), ("l2", "l1", "lw"),
                                          ("l2", "l1"), ("l3", "l2", "l1"), ("l3", "l2")])
    pairs = _sql_list(wl.DAMPENING_PAIRS)
    steps.append(f"""
r4 AS (SELECT * REPLACE (CASE WHEN i >= 3 AND NOT k3 THEN coalesce({found}, v)
    - CASE WHEN l3 || ' ' || l2 IN {pairs} OR l2 || ' ' || l1 IN {pairs} THEN {wl.BOOST}e0 ELSE 0e0 END ELSE v END AS v) FROM r3),
r5 AS (SELECT doc_id, sum(v * CASE WHEN l1 = 'least' AND NOT k1 AND (i = 1 OR (i > 1 AND l2 NOT IN ('at', 'very')))
    THEN {wl.NEGATION}e0 ELSE 1e0 END * CASE WHEN i < but THEN 0.5e0 WHEN i > but THEN 1.5e0 ELSE 1e0 END) AS s
  FROM r4 GROUP BY doc_id),
r6 AS (SELECT doc_id, coalesce(s, 0e0) AS s, length(review_text) - length(replace(review_text, '!', '')) AS e,
    length(review_text) - length(replace(review_text, '?', '')) AS q FROM texts LEFT JOIN r5 USING (doc_id)),
r7 AS (SELECT doc_id, s, least(e, 4) * {wl.EXCLAMATION}e0 + CASE WHEN q > 3 THEN {wl.QUESTIONS_MANY}e0
    WHEN q > 1 THEN q * {wl.QUESTION}e0 ELSE 0e0 END AS x FROM r6),
r8 AS (SELECT doc_id, CASE WHEN s > 0 THEN s + x WHEN s < 0 THEN s - x ELSE 0e0 END AS t FROM r7),
ruled AS (SELECT doc_id, {b.rounded(f't / sqrt(t * t + {wl.NORM}e0)', 4)} AS compound FROM r8)""")
    return ",".join(steps)


def _lda_passes() -> str:
    """The passes written out, one table each."""
    ks, key = range(topics.TOPICS), "business_id, year, month"

    def parts(p: list[str]) -> str:
        whole = " + ".join(f"({x})" for x in p)
        return ", ".join(f"CAST(({x}) / ({whole}) AS DECIMAL(12, 9)) AS r{t}" for t, x in zip(ks, p))

    def sums(names: str) -> str:
        return ", ".join(f"CAST(sum(n * r{t}) AS DOUBLE) AS {names}{t}" for t in ks)

    starts = [f"(1e0 + CAST(CAST('0x' || substr(md5('{topics.SEED}|{t}|' || business_id || '|' || year || '|' || month "
              f"|| '|' || term), 1, 4) AS INTEGER) AS DOUBLE) / 65536e0)" for t in ks]
    third = repr(1.0 / topics.TOPICS) + "e0"
    steps = [f"""
bags AS (SELECT {key}, doc_id, term, count(*) AS n FROM terms GROUP BY ALL),
s0 AS MATERIALIZED (SELECT *, {parts(starts)} FROM bags)"""]
    for i in range(topics.PASSES):
        new = [f"(d{t} + {third}) * (b{t} + {third}) / (a{t} + words / {float(topics.TOPICS)!r}e0)" for t in ks]
        steps.append(f"""
s{i + 1} AS MATERIALIZED (SELECT {key}, doc_id, term, n, {parts(new)} FROM s{i}
  JOIN (SELECT {key}, doc_id, {sums("d")} FROM s{i} GROUP BY ALL) d USING ({key}, doc_id)
  JOIN (SELECT {key}, term, {sums("b")} FROM s{i} GROUP BY ALL) b USING ({key}, term)
  JOIN (SELECT {key}, count(DISTINCT term) AS words, {sums("a")} FROM s{i} GROUP BY ALL) a USING ({key}))""")
    last = f"s{topics.PASSES}"
    listed = " UNION ALL ".join(f"SELECT {key}, {t} AS topic, term, sum(n * r{t}) AS w FROM {last} GROUP BY ALL" for t in ks)
    steps.append(f"""
lw AS (SELECT {key}, topic, term, round(CAST(w AS DOUBLE), 6) AS w FROM ({listed}) WHERE w > 0),
lt AS (SELECT *, CAST(sum(CAST(w AS DECIMAL(30, 6))) OVER (PARTITION BY {key}, topic) AS DOUBLE) AS a,
    CAST(row_number() OVER (PARTITION BY {key}, topic ORDER BY w DESC, term) AS INTEGER) AS rank FROM lw),
lda AS (SELECT {key}, topic, rank, term, {b.rounded('w / a', 3)} AS weight FROM lt WHERE rank <= {topics.TERMS})""")
    return ",".join(steps)


LDA_VIEWS = [*TEXT_FLAGS, SPIKED, terms_sql("spiked"), _lda_passes()]

QUERIES = {
    "tokens": (tokens, b.with_views([b.TEXTS], r"""
SELECT doc_id, word, count(*) AS n, CAST(max(pos) AS INTEGER) AS last_pos FROM (
  SELECT doc_id, l[i] AS word, i - 1 AS pos FROM (
    SELECT doc_id, list_filter(string_split_regex(lower(review_text), '\W+'), lambda x: x <> '') AS l
    FROM texts), unnest(range(1, len(l) + 1)) AS u(i))
GROUP BY doc_id, word""")),
    "tokens_whitespace": (tokens_whitespace, r"""
SELECT word, count(*) AS n FROM documents, unnest(string_split_regex(lower(text), '\s+')) AS u(word)
WHERE word <> '' GROUP BY word"""),
    "token_filter": (token_filter, b.with_views([b.TEXTS, b.TOKENS], """
SELECT word, count(*) AS n FROM tok WHERE length(word) > 2 AND regexp_matches(word, '^[a-z]+$')
GROUP BY word""")),
    "lexicon_semi": (lexicon_semi, b.with_views([b.TEXTS, b.TOKENS],
        f"SELECT doc_id, word FROM tok WHERE word IN {b.DOMAIN_SQL}")),
    "stopword_anti": (stopword_anti, b.with_views([b.TEXTS, b.TOKENS],
        f"SELECT doc_id, count(*) AS n FROM tok WHERE word NOT IN {b.STOP_SQL} GROUP BY doc_id")),
    "lexicon_sentiment": (lexicon_sentiment, b.with_views(LEXED,
        "SELECT doc_id, compound, sentiment FROM labels_")),
    "rule_sentiment": (rule_sentiment, b.with_views([b.TEXTS, b.LEX, _rules()], """
SELECT doc_id, compound, CASE WHEN compound >= 0.05 THEN 'positive' WHEN compound <= -0.05 THEN 'negative'
  ELSE 'neutral' END AS sentiment FROM ruled""")),
    "sentiment_label": (sentiment_label, """
SELECT CASE WHEN (l_discount - 5e-2) * 2 >= 5e-2 THEN 'positive'
  WHEN (l_discount - 5e-2) * 2 <= -5e-2 THEN 'negative' ELSE 'neutral' END AS sentiment, count(*) AS n
FROM lineitem GROUP BY 1"""),
    "rating_category": (rating_category, """
SELECT CASE WHEN l_linenumber = 2 THEN 'unknown' WHEN floor(l_quantity / 5) / 2 >= 4 THEN 'positive'
  WHEN floor(l_quantity / 5) / 2 = 3 THEN 'neutral' ELSE 'negative' END AS rating_category,
  count(*) AS n FROM lineitem GROUP BY 1"""),
    "word_counts": (word_counts, b.with_views(COUNTED, "SELECT * FROM wc")),
    "word_frequencies": (word_frequencies, b.with_views(COUNTED, """
SELECT word, CAST(coalesce(sum("count") FILTER (WHERE sentiment = 'positive'), 0) AS BIGINT) AS positive,
  CAST(coalesce(sum("count") FILTER (WHERE sentiment = 'negative'), 0) AS BIGINT) AS negative
FROM wc GROUP BY word ORDER BY sum("count") DESC, word LIMIT 20""")),
    "wordclouds": (wordclouds, b.with_views(COUNTED, """
SELECT sentiment, word, "count" FROM (SELECT *, row_number() OVER (PARTITION BY sentiment
  ORDER BY "count" DESC, word) AS r FROM wc) WHERE r <= 5""")),
    "vocab_union": (vocab_union, b.with_views(COUNTED, "SELECT DISTINCT word FROM wc")),
    "label_summary": (label_summary, b.with_views(LEXED, "SELECT " + ", ".join(
        f"CAST(count(*) FILTER (WHERE {c} = '{v}') AS VARCHAR) AS {c}_{v}"
        for c, names in [("sentiment", ["positive", "neutral", "negative"]),
                         ("rating_category", ["positive", "neutral", "negative", "unknown"])]
        for v in names) + " FROM labels_")),
    "label_summary_long": (label_summary_long, b.with_views(LEXED, " UNION ALL ".join(
        f"SELECT '{c}_{v}' AS label, count(*) FILTER (WHERE {c} = '{v}') AS n FROM labels_"
        for c, names in [("sentiment", ["positive", "neutral", "negative"]),
                         ("rating_category", ["positive", "neutral", "negative", "unknown"])]
        for v in names))),
    "sentiment_vs_rating": (sentiment_vs_rating, b.with_views(LEXED, """
SELECT sentiment, rating_category, count(*) AS reviews FROM labels_ GROUP BY sentiment, rating_category""")),
    "spike_reviews": (spike_reviews, b.with_views([*TEXT_FLAGS, SPIKED],
        "SELECT doc_id, business_id, year, month, review_text FROM spiked")),
    "topic_tokens": (topic_tokens, b.with_views([b.TEXTS, terms_sql("texts")], """
SELECT doc_id, count(*) AS tokens, count(DISTINCT term) AS terms FROM terms GROUP BY doc_id""")),
    "bag_of_words": (bag_of_words, b.with_views([b.TEXTS, terms_sql("texts")],
        "SELECT doc_id, term, count(*) AS n FROM terms GROUP BY doc_id, term")),
    "segment_top_terms": (segment_top_terms, b.with_views([*TEXT_FLAGS, SPIKED, terms_sql("spiked"), TOP_TERMS],
        "SELECT * FROM tops")),
    "spike_report": (spike_report, b.with_views([*TEXT_FLAGS, SPIKED, terms_sql("spiked"), TOP_TERMS], """
SELECT flagged.*, coalesce(topics, '') AS topics FROM flagged LEFT JOIN (
  SELECT business_id, year, month, string_agg(CAST(CAST(weight AS DECIMAL(18, 3)) AS VARCHAR)
    || '*"' || term || '"', ' + ' ORDER BY rank) AS topics FROM tops GROUP BY ALL) t
  USING (business_id, year, month)""")),
    "lda_topics": (lda_topics, b.with_views(LDA_VIEWS, "SELECT * FROM lda")),
    "lda_report": (lda_report, b.with_views(LDA_VIEWS, """
SELECT flagged.*, coalesce(topics, '') AS topics FROM flagged LEFT JOIN (
  SELECT business_id, year, month, string_agg(s, ' ; ' ORDER BY topic) AS topics FROM (
    SELECT business_id, year, month, topic, string_agg(CAST(CAST(weight AS DECIMAL(18, 3)) AS VARCHAR)
      || '*"' || term || '"', ' + ' ORDER BY rank) AS s FROM lda GROUP BY ALL) GROUP BY ALL) t
  USING (business_id, year, month)""")),
    "topic_word_merge": (topic_word_merge, """
WITH w AS (SELECT p_brand AS business_id, lower(split_part(p_name, ' ', 1)) AS word,
    CAST('0.' || lpad(CAST(p_size AS VARCHAR), 3, '0') AS DOUBLE) AS x FROM part
  UNION ALL SELECT p_brand, lower(split_part(p_name, ' ', 2)),
    CAST('0.' || lpad(CAST(p_size * 3 AS VARCHAR), 3, '0') AS DOUBLE) FROM part)
SELECT business_id, word, CAST(sum(floor(x * 1e2 + 5e-1)) AS BIGINT) AS value FROM w
GROUP BY business_id, word HAVING sum(floor(x * 1e2 + 5e-1)) > 0.5"""),
}
