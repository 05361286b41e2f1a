"""Token ids in ORC files: one row per document, in ascending doc_id order over the files.

The ids are an integer column, which ORC run-length encodes; row indexes and Bloom filters on
doc_id let a reader skip stripes and row groups; stripes are read in parallel. Where a document
starts in the whole token stream follows from the files: a metadata pass adds up the tokens of each.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ratingloom.llm.encoding import Encoder
from ratingloom.llm.shared import row_hash

cloudpickle.register_pickle_by_value(sys.modules[__name__])

ORC = {"compression": "zstd", "orc.stripe.size": str(16 << 20), "orc.row.index.stride": "1000",
       "orc.create.index": "true", "orc.bloom.filter.columns": "doc_id", "orc.bloom.filter.fpp": "0.01"}
SCHEMA = "doc_id long, place long, ids array<int>"
# Documents that are encoded and handed on at a time: bounds the ids a task holds.
ROWS, TOKENS = 512, 4_000_000


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end: int, files: int | None = None,
                 options: dict[str, str] = ORC) -> None:
    """Encodes every text of ``docs`` with the vocabulary file ``tokenizer``, appends the id ``end``,
    and writes the ids as ORC files under ``path``.

    Texts are range-partitioned by doc_id first, so a task encodes and writes one stretch of the
    ids in order; ``files`` defaults to the session's shuffle partitions. Null ids come first; rows
    with the same id are in the order of a hash of their text. Null and empty texts are just the end.
    Ids are unsigned 32-bit numbers, kept in ORC's signed ones by their bits.
    """
    keys = (F.asc_nulls_first("doc_id"), F.asc("text_hash"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"), row_hash().alias("text_hash"))
    ranged = rows.repartitionByRange(*([files] if files else []), *keys).sortWithinPartitions(*keys)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, place = Encoder(tokenizer), 0
        last = np.array([end], "<u4").tobytes()

        def made(ids: list, parts: list[bytes]) -> pa.RecordBatch:
            data = np.frombuffer(b"".join(parts), "<i4")
            offsets = np.concatenate([[0], np.cumsum([len(p) // 4 for p in parts])]).astype(np.int32)
            return pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(np.arange(place, place + len(ids))),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(data, pa.int32()))],
                names=["doc_id", "place", "ids"])

        for batch in batches:
            ids, parts, held = [], [], 0
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                ids.append(doc_id)
                parts.append(encoder.encode(text.as_py()) + last)
                held += len(parts[-1]) // 4
                if len(ids) >= ROWS or held >= TOKENS:
                    yield made(ids, parts)
                    place += len(ids)
                    ids, parts, held = [], [], 0
            if ids:
                yield made(ids, parts)
                place += len(ids)

    ranged.select("doc_id", "text").mapInArrow(encode, SCHEMA).write.options(**options).orc(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, place (in its file), ids, and the file's number ``file`` in the order of ids."""
    number = F.regexp_extract(F.col("_metadata.file_name"), r"^part-(\d+)", 1).cast("long")
    return (spark.read.schema(SCHEMA).orc(path)
            .select("doc_id", "place", "ids", number.alias("file")))


def find_tokens(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """The rows of some documents: the filter reaches the ORC reader, which skips by file and stripe
    minima and maxima, row indexes and Bloom filters."""
    return spark.read.schema(SCHEMA).orc(path).where(F.col("doc_id").isin(doc_ids)).select("doc_id", "ids")


def summaries(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files.

    ``start`` is the tokens of earlier files plus those of earlier documents of its own file. Only one
    row per file goes through a single task; the running sums are taken within files.
    """
    @F.pandas_udf("long")
    def checksum(column):
        return column.map(lambda ids: crc32(np.asarray(ids, "<i4").tobytes()))

    rows = read_tokens(spark, path)
    sizes = rows.groupBy("file").agg(F.sum(F.size("ids").cast("long")).alias("tokens"))
    order = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select(F.col("file").alias("_file"),
                         F.coalesce(F.sum("tokens").over(order), F.lit(0)).alias("base"))
    within = Window.partitionBy("file").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    narrow = rows.select("doc_id", "place", "file", F.size("ids").cast("long").alias("n_tokens"),
                         checksum("ids").alias("ids_crc32"))
    return (narrow.withColumn("before", F.coalesce(F.sum("n_tokens").over(within), F.lit(0)))
            .join(bases, F.col("file") == F.col("_file"))
            .select("doc_id", (F.col("base") + F.col("before")).alias("start"), "n_tokens", "ids_crc32"))
