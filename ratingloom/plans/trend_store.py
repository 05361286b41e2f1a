"""Monthly trends kept as tables, into which batches of reviews are merged.

    sums/batch=N     the batch's own sums per business and month
    series/batch=N   the whole series, with differences, of just the businesses that the batch touched
    base/upto=N      both of the above for all batches up to N, so that reads stay short
    log/             a line per finished batch or base, written last

A batch exists once its line does. What a broken run has left is overwritten by the next try, and a batch
that is in the log is not merged again, whatever its reviews.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from ratingloom.operators import trend_state as state, trends
from ratingloom.operators.spread import spread_join
from ratingloom.sources import readers

LOG = "kind string, number long, businesses long"


class TrendStore:
    """The tables below one folder that all executors share."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")

    def _log(self) -> list:
        path = f"{self.folder}/log"
        return self.spark.read.schema(LOG).json(path).collect() if readers.exists(self.spark, path) else []

    def batches(self) -> list[int]:
        """Numbers of the merged batches."""
        return sorted({r["number"] for r in self._log() if r["kind"] == "batch"})

    def _parts(self, name: str) -> list[str]:
        """Folders that make up a table: the newest base and the batches after it."""
        log = self._log()
        base = max((r["number"] for r in log if r["kind"] == "base"), default=None)
        later = sorted({r["number"] for r in log if r["kind"] == "batch" and (base is None or r["number"] > base)})
        return ([f"{self.folder}/base/upto={base}/{name}"] if base is not None else []) + [
            f"{self.folder}/{name}/batch={n}" for n in later]

    def _table(self, name: str) -> DataFrame | None:
        """The rows of a table's parts with their ``part``, later ones higher."""
        parts = [self.spark.read.parquet(path).withColumn("part", F.lit(i))
                 for i, path in enumerate(self._parts(name))]
        return reduce(DataFrame.unionByName, parts) if parts else None

    def _done(self, kind: str, number: int, businesses: int) -> None:
        line = self.spark.createDataFrame([(kind, number, businesses)], LOG)
        line.coalesce(1).write.mode("append").json(f"{self.folder}/log")

    def merge(self, number: int, reviews: DataFrame) -> bool:
        """Adds dated reviews as batch ``number``; False if that batch is in already. Numbers grow.

        Only the businesses of the batch are read from the older sums and get a new series.
        """
        done = self.batches()
        if number in done:
            return False
        if done and number < done[-1]:
            raise ValueError(f"batch {number} comes before batch {done[-1]}, which is merged")
        older = self._table("sums")
        path = f"{self.folder}/sums/batch={number}"
        state.monthly_sums(reviews).write.mode("overwrite").parquet(path)
        new = self.spark.read.parquet(path)
        touched = new.select("business_id").distinct()
        if older is not None:
            same = spread_join(older.drop("part"), touched, ["business_id"], "left_semi")
            new = state.added(new.unionByName(same))
        path = f"{self.folder}/series/batch={number}"
        trends.month_over_month(state.monthly_ratings(new)).write.mode("overwrite").parquet(path)
        self._done("batch", number, touched.count())
        return True

    def sums(self) -> DataFrame:
        """One row per business and month over all batches."""
        return state.added(self._table("sums").drop("part"))

    def series(self) -> DataFrame:
        """The current series of every business: that of the last batch which touched it."""
        rows = self._table("series")
        last = rows.groupBy("business_id").agg(F.max("part").alias("part"))
        return spread_join(rows, last, ["business_id", "part"], "left_semi").drop("part")

    def compact(self) -> None:
        """Puts all batches so far into one base. Batches merged later are read beside it."""
        done = self.batches()
        if done:
            path = f"{self.folder}/base/upto={done[-1]}"
            self.sums().write.mode("overwrite").parquet(f"{path}/sums")
            self.series().write.mode("overwrite").parquet(f"{path}/series")
            self._done("base", done[-1], 0)
