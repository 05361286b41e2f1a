"""Token counts without token ids: pieces are counted once per distinct pre-token.

A SentencePiece text falls into pre-tokens that no piece crosses: blanks with the characters behind
them, and line ends with the characters behind them. All texts are cut into pre-tokens and counted;
the library then runs on each distinct pre-token once. The most frequent ones, a bounded number, are
sent to every task, which adds up their pieces per document in place; all other pre-tokens of a document
are joined by shuffle and summed.
"""

from __future__ import annotations

import re
import sys
from collections import Counter
from collections.abc import Iterator
from hashlib import sha256

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from ratingloom.llm.shared import written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# At most so many pre-tokens, of at most LONG characters as a key, are sent to every task.
FREQUENT = 1 << 18
LONG = 64
FLUSH = 300_000
BLANK = "▁"  # what the library writes for a blank
UNITS = re.compile(f"[ {BLANK}]+[^ {BLANK}\n]*|\n[^ {BLANK}\n]*")


def pre_tokens(text: str | None) -> list[str]:
    """The text with the library's leading blank, cut before blanks and line ends."""
    return UNITS.findall(f" {text}") if text else []


def key_of(unit: str) -> str:
    """The pre-token, or a digest of a long one; no pre-token starts with two line ends."""
    return unit if len(unit) <= LONG else "\n\n" + sha256(unit.encode("utf-8", "surrogatepass")).hexdigest()[:LONG - 2]


def crossing(model: str) -> list[str]:
    """Pieces of a model that cross a cut, for which this count would be wrong."""
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=model)
    return [p for p in map(library.id_to_piece, range(library.get_piece_size()))
            if re.search(f"[^{BLANK}]{BLANK}|\n", p)]


def frequencies(docs: DataFrame) -> DataFrame:
    """key, long (the pre-token if the key is its digest), n: how often in all texts. Every task
    keeps a bounded number of counts and passes them on, to be added up by key."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter = Counter()

        def rows() -> pd.DataFrame:
            units = list(seen)
            keys = list(map(key_of, units))
            return pd.DataFrame({"key": keys, "long": [u if u is not k and u != k else None
                                                       for u, k in zip(units, keys)],
                                 "n": list(seen.values())}).astype({"key": object, "long": object})

        for batch in batches:
            for text in batch["text"]:
                seen.update(pre_tokens(text))
                if len(seen) > FLUSH:
                    yield rows()
                    seen.clear()
        if seen:
            yield rows()

    return (docs.select(F.col("text").cast("string").alias("text"))
            .mapInPandas(count, "key string, long string, n long")
            .groupBy("key", "long").agg(F.sum("n").alias("n")))


def count_pieces(distinct: DataFrame, model: str) -> DataFrame:
    """key, n, pieces: the library's number of pieces for each distinct pre-token."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import sentencepiece

        library = sentencepiece.SentencePieceProcessor(model_file=model)
        for batch in batches:
            units = batch["long"].where(batch["long"].notna(), batch["key"]).tolist()
            # The library puts a blank in front, so a leading one is left to it; before a line end it
            # is a piece too many. A blank alone would be an empty text, which has no pieces.
            pieces = [len(ids) - (unit[0] == "\n") for unit, ids in zip(
                units, library.encode([u if u[0] == "\n" else u[1:] for u in units], num_threads=1))]
            yield pd.DataFrame({"key": batch["key"], "n": batch["n"], "pieces": [
                1 if len(u) == 1 and u != "\n" else p for u, p in zip(units, pieces)]})

    return distinct.mapInPandas(run, "key string, n long, pieces long")


def least_frequent_sent(counted: DataFrame, most: int) -> int:
    """The smallest n such that at most ``most`` pre-tokens occur n times or more. Works on the table
    of how many pre-tokens occur how often, which has few rows."""
    levels = counted.groupBy("n").agg(F.count("*").alias("keys")).select(
        "n", F.expr("sum(keys) OVER (ORDER BY n DESC)").alias("upto"))
    return levels.where(F.col("upto") <= most).agg(F.min("n")).first()[0] or (1 << 62)


def token_counts(docs: DataFrame, model: str, limit: int = 4096, frequent: int = FREQUENT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row of ``docs``: the tokens of its whole text
    by the SentencePiece model in the file ``model``, without begin and end.

    Null and empty texts have no tokens. Repeated rows and null ids are counted like any other. An
    empty table gives no rows. Only doc_id and text are read.
    """
    if wrong := crossing(model):
        raise ValueError(f"pieces of this model cross pre-tokens: {wrong[:5]}")
    spark = docs.sparkSession
    counted = written(count_pieces(frequencies(docs), model), "piece-counts")
    least = least_frequent_sent(counted, frequent)
    sent = spark.sparkContext.broadcast(
        {r["key"]: r["pieces"] for r in counted.where(F.col("n") >= least).select("key", "pieces")
         .toLocalIterator()})

    @F.pandas_udf("struct<known:bigint,keys:array<string>,times:array<bigint>>")
    def add_up(texts: pd.Series) -> pd.DataFrame:
        known, rows = sent.value, []
        for text in texts:
            total, others = 0, Counter()
            for unit, n in Counter(pre_tokens(text)).items():
                pieces = known.get(key := key_of(unit))
                if pieces is None:
                    others[key] += n
                else:
                    total += n * pieces
            rows.append((total, list(others), list(others.values())))
        return pd.DataFrame(rows, columns=["known", "keys", "times"])

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    parts = written(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"),
        add_up.asNondeterministic()(text).alias("s"), F.monotonically_increasing_id().alias("row"))
        .select("doc_id", "n_bytes", "row", "s.*"), "piece-parts")
    rare = (parts.select("row", F.explode(F.arrays_zip("keys", "times")).alias("o"))
            .select("row", F.col("o.keys").alias("key"), F.col("o.times").alias("n"))
            .join(counted.where(F.col("n") < least).select("key", "pieces"), "key")
            .select("row", F.lit(None).cast("long").alias("doc_id"),
                    F.lit(None).cast("long").alias("n_bytes"), (F.col("n") * F.col("pieces")).alias("n")))
    total = (parts.select("row", "doc_id", "n_bytes", F.col("known").alias("n")).union(rare)
             .groupBy("row").agg(F.max("doc_id").alias("doc_id"), F.max("n_bytes").alias("n_bytes"),
                                 F.sum("n").alias("n_tokens")))
    return total.select("doc_id", "n_bytes", "n_tokens",
                        (F.col("n_tokens") > limit).alias("over_limit"))
