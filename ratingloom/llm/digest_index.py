"""Exact duplicates against a persistent index of text digests.

The index is a table of (digest, keep_id), bucketed and sorted by digest. New documents are reduced
to one row per digest, matched against the index by an anti-join on the bucket key, and what is new
is appended. Documents then read their keep_id from the index. Built-in functions only.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ratingloom.llm.shared import SPACES, join_counted, row_hash, written
from ratingloom.session import scratch_folder
from ratingloom.sources.readers import exists

# An index has at least so many buckets, and one for so many texts that are expected.
LEAST_BUCKETS = 64
A_BUCKET = 10_000_000


def text_digest(text: str = "text") -> Column:
    """SHA-256 of the text with each run of white space as one blank; null counts as empty."""
    return F.sha2(F.regexp_replace(F.coalesce(F.col(text), F.lit("")), SPACES, " "), 256)


class DigestIndex:
    """The index in ``folder``, made for ``expected`` texts if there is none.

    Buckets are fixed when the index is made, and the folder says how many there are: an index that is opened
    again has its own number, whatever is expected then. Some 10 million digests a bucket keep a
    bucket's sort in memory. A batch that was appended before an executor or the driver was lost may be
    appended again: its digests are then found. ``close`` takes the table's name out of the catalog; the
    files stay.
    """

    def __init__(self, spark: SparkSession, folder: str, expected: int = 0, buckets: int | None = None):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.buckets = self._kept_buckets() or buckets or max(LEAST_BUCKETS, -(-expected // A_BUCKET))
        if not self._kept_buckets():
            line = spark.createDataFrame([(self.buckets,)], "buckets int").coalesce(1)
            line.write.mode("overwrite").json(f"{self.folder}/layout")
        self.name = f"digest_index_{uuid.uuid4().hex}"
        spark.sql(f"CREATE TABLE {self.name} (digest STRING, keep_id BIGINT) USING parquet "
                  f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS "
                  f"LOCATION '{self.folder}/rows'")

    def _kept_buckets(self) -> int | None:
        path = f"{self.folder}/layout"
        line = self.spark.read.schema("buckets int").json(path).first() if exists(self.spark, path) else None
        return line["buckets"] if line else None

    def close(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")

    def rows(self) -> DataFrame:
        return self.spark.table(self.name)

    def append(self, digests: DataFrame) -> None:
        """Adds the digests that the index lacks, each with its smallest doc_id. Rows are dealt by bucket,
        so that however many tasks there are, each bucket gets one file."""
        new = digests.groupBy("digest").agg(F.min("doc_id").alias("keep_id"))
        (new.join(self.rows().select("digest").hint("merge"), "digest", "left_anti")
         .repartition(self.buckets, F.pmod(F.hash("digest"), F.lit(self.buckets)))
         .select("digest", "keep_id").write.insertInto(self.name))
        self.spark.catalog.refreshTable(self.name)


def digests_of(docs: DataFrame) -> DataFrame:
    """One narrow row per document, written, so that the texts are hashed once."""
    return written(docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                               text_digest().alias("digest"), row_hash().alias("text_hash")),
                   "digests")


def index_in_order(index: DigestIndex, digests: DataFrame) -> None:
    """Appends the documents as two batches, lower ids first: the first load, then new data that
    the anti-join holds against it. Of equal texts the smallest id stays, as it comes first."""
    edge = digests.agg(((F.min("doc_id") + F.max("doc_id")) / 2).alias("m")).first()["m"]
    first = F.coalesce(F.col("doc_id") <= F.lit(edge), F.lit(False))
    index.append(digests.where(first))
    index.append(digests.where(~first))


def annotate(digests: DataFrame, index: DigestIndex) -> DataFrame:
    """doc_id, text_hash, keep_id, group_size, kept, digest for every row of ``digests``.

    A null doc_id is larger than any other: such a row stays only if no equal text has an id
    (keep_id is then null). Rows that repeat both id and text share one answer.
    """
    groups = written(digests.groupBy("digest").agg(F.count("*").alias("group_size"))
                     .join(index.rows(), "digest"), "digest-groups")
    return (join_counted(digests, groups, "digest", "group_size", digests.count(),
                         F.concat_ws("/", "doc_id", "text_hash"))
            .select("doc_id", "text_hash", F.col("_group.keep_id").alias("keep_id"),
                    F.col("_group.group_size").alias("group_size"),
                    F.col("doc_id").eqNullSafe(F.col("_group.keep_id")).alias("kept"), "digest"))


def exact_duplicates(docs: DataFrame, folder: str | None = None, buckets: int | None = None) -> DataFrame:
    """Indexes the documents in ``folder`` (a new one if not given) and annotates each.

    Null and empty texts are equal to one another. An empty table gives no rows. Further columns
    of ``docs`` are not read, whatever their names.
    """
    spark = docs.sparkSession
    digests = digests_of(docs)
    index = DigestIndex(spark, folder or scratch_folder(spark, "digest-index"), digests.count(), buckets)
    index_in_order(index, digests)
    found = annotate(digests, index)
    index.close()
    return found


def keep_rows(docs: DataFrame, decisions: DataFrame) -> DataFrame:
    """The rows of ``docs``, with all their columns, that ``decisions`` (doc_id, text_hash, kept)
    keeps. One of rows with equal id and text stays, the others are copies."""
    kept = decisions.where("kept").select(F.col("doc_id").alias("_id"),
                                          F.col("text_hash").alias("_hash"))
    again = kept.groupBy("_id", "_hash").count().where("count > 1").isEmpty()
    rows = docs.select(F.struct("*").alias("_row"), F.col("doc_id").cast("long").alias("_doc"),
                       row_hash().alias("_text"))
    found = rows.join(kept if again else kept.distinct(),
                      F.col("_doc").eqNullSafe(F.col("_id")) & (F.col("_text") == F.col("_hash")),
                      "left_semi")
    return (found if again else found.dropDuplicates(["_doc", "_text"])).select("_row.*")
