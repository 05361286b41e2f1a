"""Queries on topics with Dirichlet priors, and their passes written out as SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ratingloom.functions.gamma import HALF_LOG_TWO_PI, SHIFT
from ratingloom.operators import dirichlet, topics
from ratingloom.plans import bindings as b, text_queries as tq

KEY = "business_id, year, month"
KS = range(topics.TOPICS)
PRIOR = repr(1 / topics.TOPICS) + "e0"
PART = "DECIMAL(30, 9)"


def _fitted(spark, d):
    return dirichlet.dirichlet_topics(tq.spike_reviews(spark, d), "doc_id", "review_text", b.STOP)


def dirichlet_topics(spark, d):
    return _fitted(spark, d)[0]


def dirichlet_bounds(spark, d):
    """The bound of each month after each pass that it took part in."""
    return _fitted(spark, d)[1].withColumn("bound", F.round("bound", 3))


def _digamma(x: str) -> str:
    y = f"({x} + {SHIFT})"
    steps = "".join(f" - 1 / ({x} + {i})" for i in range(SHIFT))
    return (f"(ln({y}) - 1 / (2 * {y}) - (1 / ({y} * {y})) * ({1 / 12!r}e0 - (1 / ({y} * {y})) * "
            f"({1 / 120!r}e0 - 1 / (252 * ({y} * {y})))){steps})")


def _log_gamma(x: str) -> str:
    y = f"({x} + {SHIFT})"
    product = x + "".join(f" * ({x} + {i})" for i in range(1, SHIFT))
    return (f"(({y} - 0.5e0) * ln({y}) - {y} + {HALF_LOG_TWO_PI!r}e0 + (1 / {y}) * ({1 / 12!r}e0 - "
            f"(1 / ({y} * {y})) * ({1 / 360!r}e0 - 1 / (1260 * ({y} * {y})))) - ln({product}))")


def _listed(make) -> str:
    return ", ".join(make(t) for t in KS)


def _sum(make) -> str:
    return " + ".join(f"({make(t)})" for t in KS)


def _one_pass(i: int) -> str:
    """Tables of pass ``i``: y (all months in it), now (their bounds), s (months that go on), ended."""
    before, last = f"s{i - 1}", i == dirichlet.MOST_PASSES
    done = "TRUE" if last else "FALSE" if i == 1 else f"coalesce(bound - before < {dirichlet.SETTLED!r} * abs(bound), FALSE)"
    joined = "" if i == 1 else f" LEFT JOIN (SELECT {KEY}, bound AS before FROM now{i - 1}) USING ({KEY})"
    return f"""
d{i} AS (SELECT {KEY}, doc_id, {_listed(lambda t: f'CAST(sum(n * r{t}) AS DOUBLE) + {PRIOR} AS o{t}')}
  FROM {before} GROUP BY {KEY}, doc_id),
e{i} AS (SELECT *, {_sum(lambda t: f'o{t}')} AS whole FROM d{i}),
g{i} AS MATERIALIZED (SELECT *, {_listed(lambda t: f"{_digamma(f'o{t}')} - {_digamma('whole')} AS g{t}")} FROM e{i}),
b{i} AS (SELECT {KEY}, term, {_listed(lambda t: f'sum(n * r{t}) AS b{t}')} FROM {before} GROUP BY {KEY}, term),
a{i} AS (SELECT {KEY}, CAST(count(*) AS DOUBLE) AS words, count(*) * {PRIOR} AS prior_words,
    {_listed(lambda t: f'CAST(sum(b{t}) AS DOUBLE) AS a{t}')} FROM b{i} GROUP BY {KEY}),
w{i} AS (SELECT {KEY}, term, words, prior_words, {_listed(lambda t: f'CAST(b{t} AS DOUBLE) + {PRIOR} AS o{t}')},
    {_listed(lambda t: f'a{t} + prior_words AS w{t}')} FROM b{i} JOIN a{i} USING ({KEY})),
h{i} AS MATERIALIZED (SELECT *, {_listed(lambda t: f"{_digamma(f'o{t}')} - {_digamma(f'w{t}')} AS h{t}")} FROM w{i}),
x{i} AS (SELECT {KEY}, doc_id, term, n, {_listed(lambda t: f'exp(g{t} + h{t}) AS p{t}')}
  FROM {before} JOIN g{i} USING ({KEY}, doc_id) JOIN h{i} USING ({KEY}, term)),
z{i} AS (SELECT *, {_sum(lambda t: f'p{t}')} AS p FROM x{i}),
y{i} AS MATERIALIZED (SELECT {KEY}, doc_id, term, n, CAST(n * ln(p) AS {PART}) AS fit,
    {_listed(lambda t: f'CAST(p{t} / p AS DECIMAL(12, 9)) AS r{t}')} FROM z{i}),
parts{i} AS (SELECT {KEY}, sum(fit) AS part FROM y{i} GROUP BY {KEY}
  UNION ALL SELECT {KEY}, sum(CAST({_sum(lambda t: f"({PRIOR} - o{t}) * g{t} + {_log_gamma(f'o{t}')}")}
    - {_log_gamma('whole')} + {_log_gamma('1e0')} - {topics.TOPICS} * {_log_gamma(PRIOR)} AS {PART})) FROM g{i} GROUP BY {KEY}
  UNION ALL SELECT {KEY}, sum(CAST(({_sum(
        lambda t: f"({PRIOR} - o{t}) * h{t} + {_log_gamma(f'o{t}')} - {_log_gamma(PRIOR)}")})
    + ({_sum(lambda t: f"{_log_gamma('prior_words')} - {_log_gamma(f'w{t}')}")}) / words AS {PART})) FROM h{i} GROUP BY {KEY}),
bound{i} AS (SELECT {KEY}, {i} AS pass, CAST(sum(part) AS DOUBLE) AS bound FROM parts{i} GROUP BY {KEY}),
now{i} AS MATERIALIZED (SELECT *, {done} AS done FROM bound{i}{joined}),
s{i} AS MATERIALIZED (SELECT y{i}.* FROM y{i} JOIN now{i} USING ({KEY}) WHERE NOT done),
ended{i} AS MATERIALIZED (SELECT y{i}.* FROM y{i} JOIN now{i} USING ({KEY}) WHERE done)"""


def _passes() -> str:
    rounds = range(1, dirichlet.MOST_PASSES + 1)
    starts = [f"(1e0 + CAST(CAST('0x' || substr(md5('{topics.SEED}|{t}|' || business_id || '|' || year || '|' || month "
              "|| '|' || term), 1, 4) AS INTEGER) AS DOUBLE) / 65536e0)" for t in KS]
    whole = " + ".join(starts)
    first = f"""
bags AS (SELECT {KEY}, doc_id, term, count(*) AS n FROM terms GROUP BY ALL),
s0 AS MATERIALIZED (SELECT *, {_listed(lambda t: f'CAST({starts[t]} / ({whole}) AS DECIMAL(12, 9)) AS r{t}')} FROM bags)"""
    union = " UNION ALL ".join
    weights = union(f"SELECT {KEY}, term, {t} AS topic, sum(n * r{t}) AS w FROM ended GROUP BY ALL" for t in KS)
    return first + "," + ",".join(_one_pass(i) for i in rounds) + f""",
bounds AS ({union(f"SELECT {KEY}, pass, bound FROM now{i}" for i in rounds)}),
ended AS MATERIALIZED ({union(f"SELECT * FROM ended{i}" for i in rounds)}),
lw AS (SELECT {KEY}, topic, term, round(CAST(w AS DOUBLE), 6) AS w FROM ({weights}) WHERE w > 0),
lt AS (SELECT *, CAST(sum(CAST(w AS DECIMAL(30, 6))) OVER (PARTITION BY {KEY}, topic) AS DOUBLE) AS a,
    CAST(row_number() OVER (PARTITION BY {KEY}, topic ORDER BY w DESC, term) AS INTEGER) AS rank FROM lw),
tops AS (SELECT {KEY}, topic, rank, term, {b.rounded('w / a', 3)} AS weight FROM lt WHERE rank <= {topics.TERMS})"""


VIEWS = [*tq.TEXT_FLAGS, tq.SPIKED, tq.terms_sql("spiked"), _passes()]

QUERIES = {
    "dirichlet_topics": (dirichlet_topics, b.with_views(VIEWS, "SELECT * FROM tops")),
    "dirichlet_bounds": (dirichlet_bounds, b.with_views(VIEWS, f"""
SELECT {KEY}, pass, {b.rounded('bound', 3).replace('DECIMAL(28, 15)', 'DECIMAL(28, 9)')} AS bound FROM bounds""")),
}
