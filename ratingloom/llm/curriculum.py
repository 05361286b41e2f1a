"""Mixing sources to target weights as a curriculum: which documents a run reads, how often, when.

A source's weight over training time is piecewise linear. Its integral up to time u says which part
of the source's target has been read by u; inverting it gives each reading its position. Readings are
range-sorted by position. Built-in functions only; no task receives a whole source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ratingloom.llm.shared import WORD, Working, own_orders, row_hash, written
from ratingloom.operators.spread import is_small

WEIGHTS = (5, 2, 1)
EPOCHS = 3
SLICE_ROWS = 2_000
SEED = 11
# (time, weight factor) knots by rank of the source's weight: heavy sources lead, light ones end.
SCHEDULES = (((0.0, 1.5), (0.5, 1.0), (1.0, 0.5)),
             ((0.0, 1.0), (1.0, 1.0)),
             ((0.0, 0.5), (0.5, 1.0), (1.0, 1.5)))


def source_targets(sizes: DataFrame, weights: tuple = WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """source, source_size, source_docs, rank, target from (source, size).

    Sources in code point order, null last, take the weights in turn. All targets together are the
    size of all sources; none exceeds ``epochs`` times its source, and what a source cannot take is
    shared by weight among the others. The result of sharing again and again is the one level L with
    sum(min(cap, weight * L)) = total: sources in order of cap / weight are at their cap until L
    falls below. Works on one row per source.
    """
    per = (sizes.groupBy("source").agg(F.sum("size").alias("source_size"),
                                       F.count("*").alias("source_docs"))
           .withColumn("rank", F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]),
                          (F.col("rank") % len(weights) + 1).cast("int"))
    capped = per.withColumn("weight", weight).withColumn("cap", F.col("source_size") * epochs)
    order = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    above = order.rowsBetween(Window.unboundedPreceding, -1)
    all_rows = Window.partitionBy()
    level = ((F.sum("source_size").over(all_rows)
              - F.coalesce(F.sum("cap").over(above), F.lit(0)))
             / (F.sum("weight").over(all_rows)
                - F.coalesce(F.sum("weight").over(above), F.lit(0))))
    leveled = (capped.withColumn("level", level)
               .withColumn("free", F.col("cap") > F.col("weight") * F.col("level")))
    # The first free source in the order has the final level; later ones share it.
    first = F.min_by(F.when(F.col("free"), F.col("level")),
                     F.when(F.col("free"), F.struct(F.col("cap") / F.col("weight"), "rank"))
                     ).over(all_rows)
    return leveled.withColumn("final", first).select(
        "source", "source_size", "source_docs", "rank",
        F.when(F.col("final").isNotNull() & (F.col("cap") > F.col("weight") * F.col("final")),
               F.col("weight") * F.col("final"))
        .otherwise(F.col("cap").cast("double")).alias("target"))


def inverse_demand(share: Column, knots: tuple) -> Column:
    """The time at which a source with these knots has read ``share`` (0 to 1) of its target."""
    pieces, done = [], 0.0
    for (t0, a), (t1, b) in zip(knots, knots[1:]):
        area = (a + b) / 2 * (t1 - t0)
        pieces.append((t0, t1, a, b, done, area))
        done += area
    answer = F.lit(knots[-1][0])
    for t0, t1, a, b, before, area in reversed(pieces):
        slope = (b - a) / (t1 - t0)
        rest = share * done - before
        if slope:
            inside = (F.sqrt(F.greatest(a * a + 2 * slope * rest, F.lit(0.0))) - a) / slope
        else:
            inside = rest / a if a else F.lit(0.0)
        answer = F.when(share * done <= before + area, t0 + inside).otherwise(answer)
    return answer


def sliced_ends(rows: DataFrame) -> DataFrame:
    """Adds ``end``, the running sum of size in a source by slice, order and row. Slices are summed
    first, so that no task holds a source."""
    by_source = Window.partitionBy("source").orderBy("slice")
    starts = (rows.groupBy("source", "slice").agg(F.sum("size").alias("words"))
              .withColumn("before", F.sum("words").over(by_source) - F.col("words"))
              .select(F.col("source").alias("_source"), F.col("slice").alias("_slice"), "before"))
    inside = (Window.partitionBy("source", "slice").orderBy("order", "row")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (rows.withColumn("within", F.sum("size").over(inside))
            .join(starts, F.col("source").eqNullSafe(F.col("_source"))
                  & (F.col("slice") == F.col("_slice")))
            .withColumn("end", F.col("before") + F.col("within"))
            .drop("_source", "_slice", "before", "within"))


def filled(placed: DataFrame, slice_rows: int, keep=written) -> DataFrame:
    """_source, reached, steps, picks, over: how the remainder behind a source's first documents is filled.

    The unread documents are gone through in their order, and each that still fits is read. A step
    takes those that fit at its start in stretches of some ``slice_rows``: stretches that fit as a
    whole are read (a step is kept as its gap and the slice where it stopped), the next one is gone
    through row by row (``picks``). What it leaves fits few documents further on, so steps are few.
    They end when no unread document fits. ``over`` is the row of the smallest unread document if
    reading it too comes nearer to the target.
    """
    same = F.col("source").eqNullSafe(F.col("_source"))
    steps = F.array().cast("array<struct<gap:double,slice:bigint>>")
    state = keep(placed.groupBy(F.col("source").alias("_source")).agg(
        F.coalesce(F.max(F.when(F.col("fits"), F.col("end"))), F.lit(0)).alias("reached"),
        F.first("left").alias("left")).select(
            "_source", "reached", (F.col("left") - F.col("reached")).alias("gap"), steps.alias("steps"),
            F.array().cast("array<bigint>").alias("picks")), "mix-gaps")

    def unread() -> DataFrame:
        return (placed.where(~F.col("fits") & (F.col("size") > 0)).join(state, same)
                .where(~is_filler()).select("source", "slice", "order", "row", "size", "gap"))

    by_source = Window.partitionBy("source")
    while True:
        fitting = unread().where("size <= gap")
        stretches = (fitting.groupBy("source", "slice").agg(
            F.count("*").alias("n"), F.sum("size").alias("words"), F.first("gap").alias("gap"))
            .withColumn("stretch", F.floor((F.sum("n").over(by_source.orderBy("slice")) - F.col("n"))
                                           / slice_rows))
            .groupBy("source", "stretch").agg(
                F.min("slice").alias("from"), F.max("slice").alias("to"), F.sum("words").alias("words"),
                F.first("gap").alias("gap"))
            .withColumn("end", F.sum("words").over(by_source.orderBy("stretch"))))
        stops = F.col("end") > F.col("gap")
        whole = keep(stretches.groupBy(F.col("source").alias("_source")).agg(
            F.coalesce(F.max(F.when(~stops, F.col("end"))), F.lit(0)).alias("more"),
            F.min(F.when(stops, F.struct("from", "to"))).alias("stop")), "mix-step")
        if whole.isEmpty():
            break
        start = F.struct((F.first("gap") - F.first("more")).alias("gap"),
                         F.array().cast("array<bigint>").alias("picks"))
        picked = (fitting.join(whole, same).where("slice BETWEEN stop.from AND stop.to")
                  .groupBy("_source").agg(F.aggregate(
                      F.array_sort(F.collect_list(F.struct("slice", "order", "row", "size"))), start,
                      lambda got, k: F.when(k["size"] <= got["gap"], F.struct(
                          (got["gap"] - k["size"]).alias("gap"),
                          F.array_append(got["picks"], k["row"]).alias("picks"))).otherwise(got)).alias("last"))
                  .withColumnRenamed("_source", "_of"))
        step = F.struct("gap", F.coalesce("stop.from", F.lit((1 << 63) - 1)).alias("slice"))
        state = keep(
            state.join(whole.withColumnRenamed("_source", "_at"),
                       F.col("_source").eqNullSafe(F.col("_at")), "left")
            .join(picked, F.col("_source").eqNullSafe(F.col("_of")), "left").select(
                "_source", "reached",
                F.coalesce("last.gap", F.col("gap") - F.coalesce("more", F.lit(0))).alias("gap"),
                F.when(F.col("more").isNotNull(), F.array_append("steps", step))
                .otherwise(F.col("steps")).alias("steps"),
                F.concat("picks", F.coalesce("last.picks", F.array().cast("array<bigint>"))).alias("picks")),
            "mix-gaps")
    over = (unread().groupBy(F.col("source").alias("_of"))
            .agg(F.min(F.struct("size", "row")).alias("over")))
    return keep(state.join(over, F.col("_source").eqNullSafe(F.col("_of")), "left").select(
        "_source", "reached", "steps", "picks",
        F.when(F.col("over.size") - F.col("gap") < F.col("gap"), F.col("over.row")).alias("over")),
        "mix-filled")


def is_filler() -> Column:
    """Whether a document behind its source's first ones has been read by a step."""
    return F.exists("steps", lambda s: (F.col("size") <= s["gap"]) & (F.col("slice") < s["slice"])) \
        | F.array_contains("picks", F.col("row"))


def whole_hash(docs: DataFrame) -> Column:
    """Tells apart rows that differ in any column."""
    return F.xxhash64(*[F.col(c) for c, kind in docs.dtypes if "map<" not in kind])


def first_order(seed: int, doc_id: str, text_hash: str) -> Column:
    return F.xxhash64(F.lit(seed), F.col(doc_id), F.col(text_hash))


def slice_of(order: Column, slices: Column) -> Column:
    return F.pmod(F.shiftrightunsigned(order, 16), slices).cast("long")


def written_plan(docs: DataFrame, **options) -> DataFrame:
    """The plan, written; its working tables are deleted."""
    working = Working()
    planned = written(plan(docs, keep=working.written, **options), "mix-plan")
    working.drop()
    return planned


def plan(docs: DataFrame, weights: tuple = WEIGHTS, epochs: int = EPOCHS, schedules: tuple = SCHEDULES,
         seed: int = SEED, slice_rows: int = SLICE_ROWS, keep=written) -> DataFrame:
    """row (a number), doc_id, text_hash, whole_hash (of all columns), source, size, source_size, target, passes,
    taken, positions per document, and slices, seed and front, by which texts that are not read can be told.

    A source's documents stand in an order drawn by a hash of ``seed``, id and text. Every document
    is read once for each whole multiple of its source's size in the target. Of the remainder, those
    that fit into it from the front of the order are read once more. What they leave over is filled from
    all unread documents that fit into it, in the same order, again and again until none fits; then
    with the smallest unread document, if exceeding the target by it comes nearer. So only whole
    documents are read, at most ``epochs`` times each, and a source misses its target by at most half
    of its smallest unread document.

    Null texts and texts without words have size 0 and are read like others. A null source is a
    source of its own. Rows with the same id and text are documents of their own; the answers of rows that
    are equal in every column may change places. An empty table gives no rows. ``keep`` writes working tables.
    """
    sizes = keep(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
        F.coalesce(F.regexp_count(F.col("text"), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        row_hash().alias("text_hash"), whole_hash(docs).alias("whole_hash"))
        .withColumn("row", F.monotonically_increasing_id()), "mix-sizes")
    targets = keep(source_targets(sizes, weights, epochs), "mix-targets")
    slices = max(1, -(-sizes.count() // slice_rows))
    keyed = own_orders(sizes.withColumn("order", first_order(seed, "doc_id", "text_hash")), keep).withColumn(
        "slice", slice_of(F.col("order"), F.lit(slices)))
    wanted = targets.select(
        F.col("source").alias("_source"), "source_size", "target", "rank",
        F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
        .otherwise(0).alias("whole"))
    placed = keep(
        sliced_ends(keyed)
        .join(wanted, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
        .withColumn("left", F.col("target") - F.col("whole") * F.col("source_size"))
        .withColumn("fits", F.col("end") <= F.col("left")), "mix-order")
    extra = F.when(F.col("fits") | (F.col("size") == 0), False).otherwise(
        is_filler() | F.col("row").eqNullSafe(F.col("over")))
    turns = (placed.join(filled(placed, slice_rows, keep), F.col("source").eqNullSafe(F.col("_source")))
             .withColumn("extra", extra).drop("_source", "steps", "picks", "over"))
    # Where the documents that fill the remainder end in it, behind the first ones.
    behind = (sliced_ends(turns.where("extra").select("source", "slice", "order", "row", "size", "reached"))
              .select(F.col("row").alias("_row"), (F.col("reached") + F.col("end")).alias("last")))
    passes = F.col("whole") + F.when(F.col("fits") | F.col("extra"), 1).otherwise(0)
    middles = F.transform(
        F.sequence(F.lit(0), F.col("passes").cast("int") - 1),
        lambda k: F.least((k * F.col("source_size") - F.col("size") / 2
                           + F.when(k == F.col("whole"), F.coalesce("last", "end")).otherwise(F.col("end")))
                          / F.col("target"), F.lit(1.0)))
    by_rank = F.col("rank") % len(schedules)
    positions = F.transform(middles, lambda share: F.coalesce(
        *[F.when(by_rank == i, inverse_demand(share, knots)) for i, knots in enumerate(schedules)]))
    none = F.array().cast("array<double>")
    return (turns.join(behind, F.col("row") == F.col("_row"), "left")
            .withColumn("passes", F.least(passes, F.lit(epochs)).cast("long"))
            .select("row", "doc_id", "text_hash", "whole_hash", "source", "size", "source_size", "target", "passes",
                    F.lit(slices).alias("slices"), F.lit(seed).alias("seed"),
                    ((F.col("whole") > 0) | F.col("fits")).alias("front"),
                    (F.col("passes") * F.col("size")).alias("taken"),
                    F.when((F.col("passes") > 0) & (F.col("target") > 0), positions)
                    .when(F.col("passes") > 0,
                          F.transform(F.sequence(F.lit(1), F.col("passes").cast("int")),
                                      lambda k: F.lit(0.0)))
                    .otherwise(none).alias("positions")))


def _perhaps_read(rows: DataFrame, planned: DataFrame) -> DataFrame:
    """Without most of the rows (_source, _doc, _text) that the plan does not read, so that their texts
    stay where they are: a source's documents are read from the front of their order up to some place, and
    the few behind it are listed. Rows that are read all stay; if a list is not small, all others too."""
    settings = planned.select("slices", "seed").first()
    if settings is None:
        return rows
    order = first_order(settings["seed"], "doc_id", "text_hash")
    place = F.struct(slice_of(order, F.lit(settings["slices"])), order)
    read = planned.where("passes > 0").withColumn("place", place)
    ends = read.where("front").groupBy("source").agg(F.max("place").alias("_end"))
    if not is_small(ends):
        return rows
    ends = F.broadcast(ends.withColumnRenamed("source", "_of"))
    behind = (read.join(ends, F.col("source").eqNullSafe(F.col("_of")), "left")
              .where("_end IS NULL OR place > _end")
              .select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), F.lit(True).alias("_listed")).distinct())
    if not is_small(behind):
        return rows
    own = first_order(settings["seed"], "_doc", "_text")
    here = F.struct(slice_of(own, F.lit(settings["slices"])), own)
    known = (rows.join(ends, F.col("_source").eqNullSafe(F.col("_of")), "left")
             .join(F.broadcast(behind), F.col("_doc").eqNullSafe(F.col("_id")) & (F.col("_text") == F.col("_hash")), "left"))
    return known.where((here <= F.col("_end")) | F.col("_listed")).select(*rows.columns)


def placed_readings(docs: DataFrame, planned: DataFrame) -> DataFrame:
    """_row (a row of ``docs``), _position and _of (the planned row) per reading, range-sorted by
    position. A table written from it has its files in training order."""
    turns = planned.select(F.col("doc_id").alias("_id"), F.col("whole_hash").alias("_hash"),
                           F.col("row").alias("_of"), F.explode("positions").alias("_position"))
    rows = docs.select(F.struct("*").alias("_row"), F.col("doc_id").cast("long").alias("_doc"), row_hash().alias("_text"),
                       F.col("source").cast("string").alias("_source"), whole_hash(docs).alias("_whole"))
    rows = _perhaps_read(rows, planned).drop("_source")
    if not planned.groupBy("doc_id", "whole_hash").count().where("count > 1").isEmpty():
        rows = rows.dropDuplicates(["_doc", "_whole"])  # one of equal rows meets the readings of all its copies
    return (rows.join(turns, F.col("_doc").eqNullSafe(F.col("_id"))
                      & (F.col("_whole") == F.col("_hash")))
            .repartitionByRange("_position", "_doc", "_whole")
            .sortWithinPartitions("_position", "_doc", "_whole").select("_row", "_position", "_of"))


def readings(docs: DataFrame, planned: DataFrame) -> DataFrame:
    """The training order: every row of ``docs`` with all its columns, once per reading."""
    return placed_readings(docs, planned).select("_row.*")


def read_back(planned: DataFrame, read: DataFrame) -> DataFrame:
    """``planned`` with positions, passes and taken from the readings ``read`` that were written."""
    found = read.groupBy("_of").agg(F.array_sort(F.collect_list("_position")).alias("_found"))
    positions = F.coalesce("_found", F.array().cast("array<double>"))
    return (planned.join(found, F.col("row") == F.col("_of"), "left")
            .withColumns({"positions": positions, "passes": F.size(positions).cast("long"),
                          "taken": F.size(positions) * F.col("size")}).drop("_of", "_found"))
