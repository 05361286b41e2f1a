"""Topic models of many small segments: a segment's texts meet in one task, which makes all its passes.

Segments are fitted apart from one another, so nothing but their texts moves, once. Parts of a term are whole
billionths, as the decimals of the passes as grouped sums are, and sums of them are exact in any order.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from ratingloom.functions import gamma, text as tx
from ratingloom.functions.gamma import digamma, log_gamma

cloudpickle.register_pickle_by_value(sys.modules[__name__])
cloudpickle.register_pickle_by_value(gamma)

# A segment with more characters is no longer one task's: its passes are grouped sums over all tasks.
MOST_CHARS = 1 << 24
UNIT = 1_000_000_000


def whole_units(values: np.ndarray) -> np.ndarray:
    """Billionths, halves away from zero."""
    return (np.sign(values) * np.floor(np.abs(values) * UNIT + 0.5)).astype(np.int64)


def fractions(parts: np.ndarray) -> np.ndarray:
    """Each row's parts of its sum, in billionths."""
    return whole_units(parts / in_order(parts)[:, None])


def in_order(columns: np.ndarray) -> np.ndarray:
    """Sum over the second axis, from left to right."""
    total = columns[:, 0]
    for t in range(1, columns.shape[1]):
        total = total + columns[:, t]
    return total


class Bag:
    """Terms of the reviews of a segment: review, term, n, and the parts ``r`` of the topics."""

    def __init__(self, doc: np.ndarray, term: np.ndarray, n: np.ndarray, r: np.ndarray) -> None:
        self.n, self.r = n, r
        self.docs, self.doc = np.unique(doc, return_inverse=True)
        self.terms, self.term = np.unique(term, return_inverse=True)
        self.by_doc, self.by_term = np.argsort(self.doc, kind="stable"), np.argsort(self.term, kind="stable")

    def _sums(self, order: np.ndarray, groups: np.ndarray) -> np.ndarray:
        if not len(order):
            return np.empty((0, self.r.shape[1]), np.int64)
        firsts = np.flatnonzero(np.diff(groups[order], prepend=-1))
        return np.add.reduceat((self.n[:, None] * self.r)[order], firsts, axis=0)

    def doc_sums(self) -> np.ndarray:
        return self._sums(self.by_doc, self.doc)

    def term_sums(self) -> np.ndarray:
        return self._sums(self.by_term, self.term)

    def where(self, kept: np.ndarray, r: np.ndarray) -> Bag:
        return Bag(self.docs[self.doc[kept]], self.terms[self.term[kept]], self.n[kept], r[kept])


def bag_of(table: pa.Table, key: str, seed: int, k: int) -> tuple[Bag, np.ndarray, pa.Array]:
    """(bag with drawn parts, which rows have a key, terms in their order). Terms are numbered in that order."""
    words = table["_words"].combine_chunks()
    flat, of = words.flatten(), pc.list_parent_indices(words).to_numpy()
    docs = table[key].combine_chunks().dictionary_encode(null_encoding="encode")
    known = pc.is_valid(docs.dictionary).to_numpy(zero_copy_only=False)
    coded = flat.dictionary_encode()
    order = pc.sort_indices(coded.dictionary).to_numpy()
    names = coded.dictionary.take(pa.array(order))
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    pairs = docs.indices.to_numpy()[of].astype(np.int64) * max(1, len(order)) + rank[coded.indices.to_numpy()]
    pairs, n = np.unique(pairs, return_counts=True)
    doc, term = np.divmod(pairs, max(1, len(order)))
    head = table["_segment"][0].as_py()
    starts = np.array([[1.0 + int(hashlib.md5(f"{seed}|{t}|{head}|{name}".encode()).hexdigest()[:4], 16) / 65536.0
                        for t in range(k)] for name in names.to_pylist()]).reshape(-1, k)
    return Bag(doc, term, n.astype(np.int64), fractions(starts)[term]), known[doc], names


def smoothed_pass(bag: Bag, k: int) -> np.ndarray:
    """New parts: (weight of the topic in the review) x (weight of the term in the topic), both smoothed."""
    d, b = bag.doc_sums() / UNIT, bag.term_sums()
    a = b.sum(axis=0) / UNIT
    parts = (d[bag.doc] + 1.0 / k) * (b[bag.term] / UNIT + 1.0 / k) / (a + len(bag.terms) / float(k))
    return fractions(parts)


def bound_pass(bag: Bag, kept: np.ndarray, whole: bool, k: int, alpha: float, eta: float) -> tuple[np.ndarray, float]:
    """(new parts, bound) of a pass with Dirichlet priors; the parts of rows that are not ``kept`` add nothing to the
    bound, nor do the terms of a segment without all its keys (not ``whole``)."""
    def lgamma(x: np.ndarray | float) -> np.ndarray:
        return log_gamma(np.asarray(x, float), np.log)

    own = bag.doc_sums() / UNIT + alpha
    total = in_order(own)
    g = digamma(own, np.log) - digamma(total, np.log)[:, None]
    fixed = lgamma(k * alpha) - k * lgamma(alpha)
    bound = whole_units(in_order((alpha - own) * g + lgamma(own)) - lgamma(total) + fixed).sum()
    b, words = bag.term_sums(), len(bag.terms)
    share, every = b / UNIT + eta, b.sum(axis=0) / UNIT + words * eta
    h = digamma(share, np.log) - digamma(every, np.log)
    once = in_order((lgamma(words * eta) - lgamma(every))[None, :])
    if whole:
        bound += whole_units(in_order((eta - share) * h + lgamma(share) - lgamma(eta)) + once / words).sum()
    weights = np.exp(g[bag.doc] + h[bag.term])
    bound += whole_units(bag.n * np.log(in_order(weights)))[kept].sum()
    return fractions(weights), float(bound) / UNIT


def heaviest(bag: Bag, names: pa.Array, most: int) -> pa.Table:
    """topic, rank, term, w and the topic's whole weight, of the ``most`` heaviest terms of each topic."""
    sums, columns = bag.term_sums(), {c: [] for c in ("topic", "rank", "term", "w", "of")}
    for t in range(sums.shape[1]):
        used = np.flatnonzero(sums[:, t] > 0)
        micro = (sums[used, t] + 500) // 1000
        top = np.lexsort((used, -micro))[:most]
        columns["topic"] += [t] * len(top)
        columns["rank"] += list(range(1, len(top) + 1))
        columns["term"] += names.take(pa.array(bag.terms[used[top]])).to_pylist()
        columns["w"] += list(micro[top] / 1e6)
        columns["of"] += [micro.sum() / 1e6] * len(top)
    kinds = [pa.int32(), pa.int32(), pa.string(), pa.float64(), pa.float64()]
    return pa.table([pa.array(v, kind) for v, kind in zip(columns.values(), kinds)], names=list(columns))


def smoothed_fit(table: pa.Table, whole: bool, key: str, seed: int, k: int, passes: int, terms: int) -> tuple[list[float], pa.Table]:
    """(no bounds, topics) after all passes."""
    bag, known, names = bag_of(table, key, seed, k)
    for i in range(passes):
        bag = bag.where(known if not i else np.ones(len(bag.n), bool), smoothed_pass(bag, k))
    return [], heaviest(bag, names, terms)


def bound_fit(table: pa.Table, whole: bool, key: str, seed: int, k: int, passes: int, terms: int, alpha: float,
              eta: float, settled: float) -> tuple[list[float], pa.Table]:
    """(bound of each pass, topics) up to the pass that raises the bound too little."""
    bag, known, names = bag_of(table, key, seed, k)
    known, bounds = known & whole, []
    while len(bag.n):
        r, bound = bound_pass(bag, known, whole, k, alpha, eta)
        bounds.append(bound)
        bag, known = bag.where(known, r), np.ones(int(known.sum()), bool)
        if len(bounds) == passes or (len(bounds) > 1 and bound - bounds[-2] < settled * abs(bound)):
            break
    return bounds, heaviest(bag, names, terms)


def fit_segments(reviews: DataFrame, key: str, text: str, stop_words: list[str], segment: list[str],
                 fit: Callable[[pa.Table, bool], tuple[list[float], pa.Table]]) -> DataFrame:
    """segment, pass, bound of each pass and segment, topic, rank, term, w, of of each topic's terms, in one table.
    ``fit`` gets the texts of a segment and whether it has all its keys."""
    words = reviews.select(*segment, key, tx.topic_tokens(text, stop_words).alias("_words"), F.concat_ws(
        "|", *[F.col(c).cast("string") for c in segment]).alias("_segment")).where(F.size("_words") > 0)
    kinds = dict(reviews.dtypes)

    def fitted(table: pa.Table) -> pa.Table:
        bounds, topics = fit(table, all(table[c].null_count == 0 for c in segment))
        n, m = len(bounds), len(topics)
        own = table.select(segment).take(pa.array(np.zeros(n + m, np.int64)))
        columns = {c: own[c] for c in segment}
        columns["pass"] = pa.array([*range(1, n + 1), *[None] * m], pa.int32())
        columns["bound"] = pa.array([*bounds, *[None] * m], pa.float64())
        for c in topics.column_names:
            columns[c] = pa.concat_arrays([pa.nulls(n, topics[c].type), topics[c].combine_chunks()])
        return pa.table(columns)

    return words.groupBy(*segment).applyInArrow(fitted, ", ".join(f"`{c}` {kinds[c]}" for c in segment)
                                                + ", pass int, bound double, topic int, rank int, term string, w double, of double")


def split_by_size(reviews: DataFrame, text: str, segment: list[str], most_chars: int) -> tuple[DataFrame, DataFrame | None]:
    """(reviews of segments that a task can hold, those of the others or None). ``reviews`` are read twice."""
    large = (reviews.groupBy(*segment).agg(F.sum(F.length(text)).alias("chars")).where(F.col("chars") > most_chars)
             .select(*[F.col(c).alias(f"_{c}") for c in segment]))
    if large.isEmpty():
        return reviews, None
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in segment]
    return (reviews.join(F.broadcast(large), same, "left_anti"), reviews.join(F.broadcast(large), same, "left_semi"))


def shown(fitted: DataFrame, segment: list[str]) -> DataFrame:
    """segment, topic, rank, term and the term's share of the topic."""
    return fitted.where("topic IS NOT NULL").select(
        *segment, "topic", "rank", "term", F.round(F.col("w") / F.col("of"), 3).alias("weight"))
