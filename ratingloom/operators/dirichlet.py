"""Topics per flagged month by variational inference with Dirichlet priors, up to a bound.

Each month has a model of its own: topics of a review and words of a topic have Dirichlet priors, and a
review's word is divided among the topics by exp(E ln topic share + E ln word share). A month's texts go to one
task; very large months are fitted together as grouped sums over (month, review, term). A pass can only raise the lower bound of a month's
likelihood; a month whose bound has risen by less than a share of itself is settled and leaves the passes.
"""

from __future__ import annotations

from functools import partial, reduce

from pyspark.sql import Column, DataFrame, functions as F

from ratingloom.functions.gamma import digamma, log_gamma
from ratingloom.operators import segment_fit
from ratingloom.operators.spread import spread_join
from ratingloom.operators.topics import (SEED, SEGMENT, TERMS, TOPICS, start_value, term_fractions, top_terms,
                                         topic_token_table)
from ratingloom.session import stored

MOST_PASSES = 10
# A month is settled when a pass raises its bound by less than this share of it.
SETTLED = 5e-4
PART = "decimal(30,9)"


def _total(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, columns)


def review_shares(state: DataFrame, keys: list[str], k: int, alpha: float) -> DataFrame:
    """Per review: g0.. (expected logarithms of its topic shares) and its part of the bound."""
    sums = state.groupBy(*keys).agg(*[F.sum(F.col("n") * F.col(f"r{t}")).cast("double").alias(f"d{t}")
                                      for t in range(k)])
    own = [F.col(f"d{t}") + alpha for t in range(k)]
    whole = _total(own)
    shares = sums.select(*keys, *[o.alias(f"o{t}") for t, o in enumerate(own)], whole.alias("whole"))
    logs = shares.select("*", *[(digamma(F.col(f"o{t}")) - digamma(F.col("whole"))).alias(f"g{t}") for t in range(k)])
    part = _total([(alpha - F.col(f"o{t}")) * F.col(f"g{t}") + log_gamma(F.col(f"o{t}")) for t in range(k)])
    fixed = log_gamma(F.lit(k * alpha)) - k * log_gamma(F.lit(alpha))
    return logs.select(*keys, *[f"g{t}" for t in range(k)],
                       (part - log_gamma(F.col("whole")) + fixed).cast(PART).alias("part"))


def word_shares(state: DataFrame, segment: list[str], k: int, eta: float) -> DataFrame:
    """Per month and term: h0.. (expected logarithms of its shares of the topics) and its part of the bound.
    Sums of a month come from its terms, not from the reviews again."""
    sums = stored(state.groupBy(*segment, "term").agg(
        *[F.sum(F.col("n") * F.col(f"r{t}")).alias(f"b{t}") for t in range(k)]), "topic-words")
    whole = sums.groupBy(*segment).agg(F.count("*").alias("words"), *[
        F.sum(f"b{t}").cast("double").alias(f"a{t}") for t in range(k)])
    joined = spread_join(sums, whole, segment)
    own = joined.select(*segment, "term", "words",
                        *[(F.col(f"b{t}").cast("double") + eta).alias(f"o{t}") for t in range(k)],
                        *[(F.col(f"a{t}") + F.col("words") * eta).alias(f"w{t}") for t in range(k)])
    logs = own.select("*", *[(digamma(F.col(f"o{t}")) - digamma(F.col(f"w{t}"))).alias(f"h{t}") for t in range(k)])
    part = _total([(eta - F.col(f"o{t}")) * F.col(f"h{t}") + log_gamma(F.col(f"o{t}")) - log_gamma(F.lit(eta))
                   for t in range(k)])
    # What a month adds once is dealt over its terms.
    once = _total([log_gamma(F.col("words") * eta) - log_gamma(F.col(f"w{t}")) for t in range(k)])
    return logs.select(*segment, "term", *[f"h{t}" for t in range(k)],
                       (part + once / F.col("words")).cast(PART).alias("part"))


def one_pass(state: DataFrame, segment: list[str], key: str, k: int, alpha: float,
             eta: float) -> tuple[DataFrame, DataFrame]:
    """(new state, bound per month)."""
    reviews = stored(review_shares(state, [*segment, key], k, alpha), "topic-reviews")
    terms = stored(word_shares(state, segment, k, eta), "topic-terms")
    joined = (state.drop("fit").join(reviews.drop("part"), [*segment, key])
              .join(terms.drop("part"), [*segment, "term"]))
    weights = [F.exp(F.col(f"g{t}") + F.col(f"h{t}")) for t in range(k)]
    fit = (F.col("n") * F.ln(_total(weights))).cast(PART).alias("fit")
    state = stored(joined.select(*segment, key, "term", "n", *[
        f.alias(f"r{t}") for t, f in enumerate(term_fractions(weights))], fit), "topics")
    parts = (state.groupBy(*segment).agg(F.sum("fit").alias("part"))
             .unionByName(reviews.groupBy(*segment).agg(F.sum("part").alias("part")))
             .unionByName(terms.groupBy(*segment).agg(F.sum("part").alias("part"))))
    return state, parts.groupBy(*segment).agg(F.sum("part").cast("double").alias("bound"))


def dirichlet_topics(reviews: DataFrame, key: str, text: str, stop_words: list[str],
                     segment: list[str] = SEGMENT, k: int = TOPICS, terms: int = TERMS, alpha: float = 1 / TOPICS,
                     eta: float = 1 / TOPICS, passes: int = MOST_PASSES, settled: float = SETTLED, seed: int = SEED,
                     most_chars: int = segment_fit.MOST_CHARS) -> tuple[DataFrame, DataFrame]:
    """(topics, bounds). Topics: segment, topic, rank, term, weight, as ``topics.lda_topics`` has them. Bounds:
    segment, pass, bound, one row for each pass that a month took part in.

    The texts of a segment go to one task, which makes its passes; segments of more than ``most_chars`` characters are
    fitted as grouped sums. Parts are decimals in both, so sums do not depend on the order of rows.
    """
    texts = stored(reviews.select(*segment, key, text), "topic-texts")
    small, large = segment_fit.split_by_size(texts, text, segment, most_chars)

    fit = partial(segment_fit.bound_fit, key=key, seed=seed, k=k, passes=passes, terms=terms, alpha=alpha, eta=eta,
                  settled=settled)
    found = stored(segment_fit.fit_segments(small, key, text, stop_words, segment, fit), "topics-found")
    top = segment_fit.shown(found, segment)
    history = found.where("pass IS NOT NULL").select(*segment, "pass", "bound")
    if large is None:
        return top, history
    more, bounds = _summed(large, key, text, stop_words, segment, k, terms, alpha, eta, passes, settled, seed)
    return top.unionByName(more), history.unionByName(bounds.select(*segment, "pass", "bound"))


def _summed(reviews: DataFrame, key: str, text: str, stop_words: list[str], segment: list[str], k: int, terms: int,
            alpha: float, eta: float, passes: int, settled: float, seed: int) -> tuple[DataFrame, DataFrame]:
    """The passes as grouped sums; every pass is written."""
    bags = (topic_token_table(reviews, [*segment, key], text, stop_words)
            .groupBy(*segment, key, "term").agg(F.count("*").alias("n")))
    starts = [start_value(seed, t, [*segment, "term"]) for t in range(k)]
    state = stored(bags.select("*", *[f.alias(f"r{t}") for t, f in enumerate(term_fractions(starts))]), "topics")
    finished, history, last = [], [], None
    for i in range(1, passes + 1):
        state, bound = one_pass(state, segment, key, k, alpha, eta)
        bound = bound.withColumn("pass", F.lit(i))
        if last is not None:
            before = last.select(*segment, F.col("bound").alias("before"))
            bound = bound.join(before, segment, "left")
        else:
            bound = bound.withColumn("before", F.lit(None).cast("double"))
        gain = F.col("bound") - F.col("before")
        done = F.lit(True) if i == passes else F.coalesce(gain < settled * F.abs("bound"), F.lit(False))
        last = stored(bound.withColumn("done", done), "topic-bounds")
        history.append(last.select(*segment, "pass", "bound"))
        marked = spread_join(state, last.select(*segment, "done"), segment)
        finished.append(marked.where("done").drop("done"))
        if last.where("not done").isEmpty():
            break
        state = marked.where("not done").drop("done")
    whole = reduce(DataFrame.unionByName, finished)
    weights = (whole.groupBy(*segment, "term").agg(*[
        F.sum(F.col("n") * F.col(f"r{t}")).cast("double").alias(f"t{t}") for t in range(k)])
        .unpivot([*segment, "term"], [f"t{t}" for t in range(k)], "topic", "w")
        .withColumn("topic", F.substring("topic", 2, 9).cast("int")))
    top = top_terms(weights.where("w > 0").withColumn("w", F.round("w", 6)), [*segment, "topic"], terms).drop("w")
    return top, reduce(DataFrame.unionByName, history)
