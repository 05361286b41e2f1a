"""Packing documents into training sequences by the sum-of-squares rule (Csirik et al. 2006).

Documents longer than a sequence are cut so that all pieces but the first fill one. Each other piece goes
where the squared counts of open sequences per residual gap become smallest. Documents are dealt by hash
into groups of bounded size that are packed side by side; a group leaves a few sequences unfilled.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from ratingloom.llm.encoding import Encoder
from ratingloom.llm.shared import own_orders, written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LENGTH = 1024
GROUP = 32_768


def place(sizes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of every piece, in the order given. 0 < size <= length.

    ``count[h]`` open sequences hold h tokens. A piece of s tokens changes the sum of squares by
    2 (count[h + s] - count[h]) + 2 in a sequence with h tokens and by 1 - 2 count[h] where it fills it.
    Of equally good places the fullest is taken. As all pieces are known beforehand, a new sequence is
    opened only for a piece that fits nowhere; with that, and pieces in falling size, the rule wastes
    less than with new sequences among the places to choose from.
    """
    count = np.zeros(length + 1, np.int64)
    open_at: list[list[int]] = [[] for _ in range(length + 1)]
    number, offset = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
    made = 0
    for i, s in enumerate(sizes.tolist()):
        if s == length:
            number[i], offset[i] = made, 0
            made += 1
            continue
        room = length - s
        change = 2 * (count[s + 1:] - count[1:room + 1]) + 2  # for h = 1 .. room
        change[room - 1] = 1 - 2 * count[room]
        change[count[1:room + 1] == 0] = np.iinfo(np.int64).max
        best = room - 1 - int(change[::-1].argmin())
        if count[best + 1]:
            h = best + 1
            bin_ = open_at[h].pop()
            count[h] -= 1
        else:
            h, bin_ = 0, made
            made += 1
        number[i], offset[i] = bin_, h
        if h + s < length:
            open_at[h + s].append(bin_)
            count[h + s] += 1
    return number, offset


def piece_sizes(tokens: int, length: int) -> list[int]:
    first = tokens % length or length
    return [first] + [length] * ((tokens - first) // length)


def encoded(docs: DataFrame, tokenizer: str, end: int, length: int = LENGTH) -> DataFrame:
    """doc_id, n_tokens, crcs (of the ids of each piece) for every row of ``docs``: its whole text's
    ids and the id ``end``. Null and empty texts are just the end."""

    @F.pandas_udf("struct<n_tokens:bigint,crcs:array<bigint>>")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encoder, last = Encoder(tokenizer), np.array([end], "<u4").tobytes()
        for texts in batches:
            rows = []
            for text in texts:
                ids, start, crcs = encoder.encode(text) + last, 0, []
                for size in piece_sizes(len(ids) // 4, length):
                    crcs.append(crc32(ids[4 * start:4 * (start + size)]))
                    start += size
                rows.append((start, crcs))
            yield pd.DataFrame(rows, columns=["n_tokens", "crcs"])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        encode.asNondeterministic()(F.col("text").cast("string")).alias("s"))
            .select("doc_id", "s.n_tokens", "s.crcs"))


def pack(documents: DataFrame, length: int = LENGTH, group: int = GROUP) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset for every piece of ``documents``
    (doc_id, n_tokens, crcs).

    Rows with the same or no doc_id are documents of their own. An empty table gives no rows. Every
    group has some ``group`` documents at any input; numbers of sequences are distinct over groups. The
    documents' order within a group is that of a hash, so results do not depend on partitions.
    """
    rows = written(documents.withColumn("row", F.monotonically_increasing_id()), "encoded")
    groups = max(1, -(-rows.count() // group))
    order = F.xxhash64("doc_id", "n_tokens", "crcs")
    dealt = own_orders(rows.withColumn("order", order)).drop("row").withColumn(
        "group", F.pmod(F.shiftrightunsigned("order", 16), F.lit(groups)))

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["order", "n_tokens"], kind="stable")
        sizes = [np.array(piece_sizes(n, length), np.int64) for n in rows["n_tokens"]]
        each = np.array([len(s) for s in sizes])
        flat, firsts = np.concatenate(sizes), np.cumsum(each) - each
        starts = np.cumsum(flat) - flat
        falling = np.argsort(-flat, kind="stable")
        number, offset = np.empty_like(flat), np.empty_like(flat)
        number[falling], offset[falling] = place(flat[falling], length)
        ids = rows["doc_id"].to_numpy(dtype=object, na_value=None)
        return pd.DataFrame({
            "doc_id": pd.array([None if pd.isna(x) else int(x) for x in np.repeat(ids, each)], "Int64"),
            "piece": (np.arange(len(flat)) - np.repeat(firsts, each)).astype(np.int32),
            "start": starts - np.repeat(starts[firsts], each), "length": flat,
            "ids_crc32": np.concatenate(rows["crcs"].to_list()),
            "sequence_id": number + (int(rows["group"].iloc[0]) << 32), "offset": offset})

    # An id without a value would turn the column into floats on its way, so it goes as text.
    return (dealt.withColumn("doc_id", F.col("doc_id").cast("string"))
            .groupBy("group").applyInPandas(
                run, "doc_id long, piece int, start long, length long, ids_crc32 long, "
                     "sequence_id long, offset long"))


def sequences(documents: DataFrame, packed: DataFrame) -> DataFrame:
    """The sequences themselves: sequence_id and the ids of its pieces in place, from ``documents``
    (doc_id, ids) with distinct ids and the rows of ``pack``."""
    parts = (packed.select("doc_id", "start", "length", "sequence_id", "offset")
             .join(documents.select("doc_id", "ids"), "doc_id")
             .select("sequence_id", F.struct("offset", F.slice("ids", F.col("start") + 1, F.col("length"))
                                             .alias("ids")).alias("part")))
    return (parts.groupBy("sequence_id").agg(F.array_sort(F.collect_list("part")).alias("parts"))
            .select("sequence_id", F.flatten(F.col("parts.ids")).alias("ids")))
