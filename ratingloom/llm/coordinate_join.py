"""Near duplicates by an inverted join over MinHash signature coordinates.

Each distinct shingle set gets a signature of ``coordinates`` minima. Every (coordinate, value) pair is
a posting list. Two sets whose signatures agree in at least ``matches`` coordinates must meet in a
list of the first ``coordinates - matches + 1`` coordinates of either, in any order common to all; rare
values come first (prefix). Lists give candidates, the signatures' agreements are counted (collisions),
pairs with enough of them are confirmed on the full sets, and links make classes.

Long lists are not expanded: their members are first compared with one centre per list, and afterwards
only members of different classes meet, in blocks; a pair counts at the first list it shares (skip).
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window, functions as F

from ratingloom.llm.components import components
from ratingloom.llm.shared import join_counted, row_hash, written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

COORDINATES = 32
# Two sets of similarity 0.8 agree in 25.6 of 32 coordinates on average, in fewer than 14 once in
# some 840,000 times; more similar ones far more rarely.
MATCHES = 14
SHORT = 32
BLOCK = 512


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles of ``words`` words, A-Z in lower case. A
    shorter text is one shingle; no words give no shingles."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))
    size = min(words, len(hashes))
    rows = len(hashes) - size + 1
    out = _mix(hashes[:rows] + np.uint64(size))
    for i in range(1, size):
        out = _mix(out * np.uint64(0x9E3779B97F4A7C15) + hashes[i:rows + i])
    return np.unique(out)


def signature(shingles: np.ndarray, coordinates: int) -> np.ndarray:
    """The minimum of each of ``coordinates`` hash functions, as keys unlike those of others."""
    seeds = _mix(np.arange(1, coordinates + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    least = np.full(coordinates, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(shingles), 4096):
        least = np.minimum(least, _mix(shingles[i:i + 4096, None] ^ seeds).min(axis=0))
    return _mix(least ^ _mix(seeds)).view(np.int64)


def sketches(docs: DataFrame, words: int, coordinates: int) -> DataFrame:
    """doc_id, text_hash, n_shingles, set_hash, keys per row of ``docs``."""

    @F.pandas_udf("struct<n_shingles:bigint,set_hash:string,keys:array<bigint>>")
    def sketch(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for text in texts:
            found = shingle_set(text, words)
            rows.append((len(found), xxhash.xxh3_128_hexdigest(found.tobytes()),
                         signature(found, coordinates) if len(found) else None))
        return pd.DataFrame(rows, columns=["n_shingles", "set_hash", "keys"])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_hash().alias("text_hash"),
                        sketch.asNondeterministic()("text").alias("s"))
            .select("doc_id", "text_hash", "s.*"))


def distinct_sets(sketched: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Members (doc_id, text_hash, n_shingles, node) and sets (node, n_shingles, keys, doc_id,
    text_hash, least_id): one node per distinct set, numbered by the row that stands for it, as
    texts that repeat a doc_id have sets of their own. ``least_id`` is the smallest doc_id of the set's
    rows, null if none has one."""
    rows = written(sketched.withColumn("row", F.monotonically_increasing_id()), "sketches")
    full = rows.where("n_shingles > 0")
    lead = written(full.groupBy("set_hash").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("lead"),
        F.count("*").alias("copies"))
        .select("set_hash", F.col("lead.row").alias("node"), F.col("lead.doc_id").alias("least_id"),
                "copies"), "set-groups")
    joined = join_counted(full.withColumnRenamed("row", "own"), lead, "set_hash", "copies",
                          full.count(), F.col("own"))
    members = written(joined.select(
        "doc_id", "text_hash", "n_shingles", F.col("_group.node").alias("node"),
        F.when(F.col("own") == F.col("_group.node"), F.col("keys")).alias("keys"),
        F.col("_group.least_id").alias("least_id")), "members")
    sets = members.where("keys is not null")
    alone = rows.where("n_shingles = 0").select(
        "doc_id", "text_hash", "n_shingles", F.lit(None).cast("long").alias("node"),
        F.col("doc_id").alias("least_id"))
    return members.drop("keys").union(alone), sets


def prefix_lists(sets: DataFrame, coordinates: int, matches: int) -> DataFrame:
    """Posting rows (key, pos, node, prefix) of all lists with two members or more.

    ``pos`` is the coordinate, ``prefix`` a bit mask of the coordinates in the node's prefix. The order
    is by list length, then key. Coordinates that no other set shares come first and need no rows.
    """
    posted = sets.select("node", F.posexplode("keys").alias("pos", "key"))
    shared = written(posted.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "shared-keys")
    total = shared.agg(F.sum("n")).first()[0] or 0
    mine = (join_counted(posted, shared, "key", "n", total, F.col("node"), hot=1024)
            .where("_group is not null")
            .select("node", "pos", "key", F.col("_group.n").alias("n")))
    order = Window.partitionBy("node")
    ranked = (mine.withColumn("rank", F.row_number().over(order.orderBy("n", "key")))
              .withColumn("alone", F.lit(coordinates) - F.count("*").over(order))
              .where(F.col("rank") + F.col("alone") <= coordinates - matches + 1)
              .withColumn("prefix", F.sum(F.expr("shiftleft(1L, pos)")).over(order)))
    return written(ranked.select("key", "pos", "node", "prefix"), "prefix-lists")


def count_collisions(pairs: DataFrame, sets: DataFrame, matches: int) -> DataFrame:
    """The pairs (a, b) whose signatures agree in at least ``matches`` coordinates."""
    keys = sets.select("node", "keys")
    return (pairs.join(keys.toDF("a", "keys_a"), "a").join(keys.toDF("b", "keys_b"), "b")
            .where(F.size(F.array_intersect("keys_a", "keys_b")) >= matches).select("a", "b"))


def confirm(pairs: DataFrame, full: DataFrame, percent: int) -> DataFrame:
    """The pairs whose sets have ``percent`` of their union in common. ``full``: node, shingles."""
    both = F.size(F.array_intersect("set_a", "set_b"))
    return (pairs.join(full.toDF("b", "set_b"), "b").join(full.toDF("a", "set_a"), "a")
            .where(100 * both >= percent * (F.size("set_a") + F.size("set_b") - both))
            .select("a", "b"))


def full_sets(docs: DataFrame, sets: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """node, shingles of the nodes in ``wanted``: their texts are read and cut once more."""
    rows = (sets.join(wanted, "node", "left_semi")
            .select("node", F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")))
    texts = docs.select(F.col("doc_id").cast("long").alias("_doc"), row_hash().alias("_text"), "text")

    @F.pandas_udf("array<bigint>")
    def shingles(column: pd.Series) -> pd.Series:
        return pd.Series([shingle_set(text, words).view(np.int64) for text in column])

    found = (texts.join(rows, F.col("_doc").eqNullSafe(F.col("_id")) & (F.col("_text") == F.col("_hash")))
             .select("node", "text"))
    return written(found.select("node", shingles("text").alias("shingles")).dropDuplicates(["node"]),
                   "full-sets")


def across_classes(lists: DataFrame, sets: DataFrame, found: DataFrame, long_lists: DataFrame,
                   full: DataFrame, matches: int, percent: int, block: int) -> DataFrame:
    """Links (a, b) among members of a long list that are in different classes.

    The members outside a list's largest class, if that has more than one, are dealt into blocks. Each pair
    of blocks is a task, and each block meets the largest class in blocks; so two members meet once in a
    list. A task holds the signatures and sets of two blocks: it counts collisions, confirms the pairs that
    have enough on the sets, and emits of a member's links into one class one, which is all that classes need.
    """
    labelled = written(lists.join(long_lists.select("key", "n"), "key").join(found, "node", "left")
                       .withColumn("label", F.coalesce("component", "node")).drop("component"), "long-lists")
    mains = F.when(F.col("m") > 1, F.col("m")).otherwise(0)
    parts = (labelled.groupBy("key", "n", "label").agg(F.count("*").alias("m"))
             .groupBy("key", "n").agg(F.max_by("label", F.struct("m", "label")).alias("main"),
                                      F.max("m").alias("m")).where("m < n")
             .select("key", F.when(F.col("m") > 1, F.col("main")).alias("main"),
                     F.ceil((F.col("n") - mains) / block).cast("int").alias("few"),
                     F.ceil(mains / block).cast("int").alias("mains")))
    rows = (labelled.drop("n").join(parts, "key").join(sets.select("node", "keys"), "node")
            .join(full, "node"))
    at = F.xxhash64("node", "key")
    own = F.pmod(at, F.col("few")).cast("int")
    place = F.pmod(at, F.greatest("mains", F.lit(1))).cast("int")

    def role(among: bool, left: Column | bool, i: Column, j: Column) -> Column:
        return F.struct(F.lit(among).alias("among"), (F.lit(left) if isinstance(left, bool) else left).alias("left"),
                        i.alias("i"), j.alias("j"))

    blocks = F.sequence(F.lit(0), F.col("few") - 1)
    others = F.transform(blocks, lambda b: role(True, own <= b, F.least(own, b), F.greatest(own, b)))
    towards = F.transform(F.sequence(F.lit(0), F.greatest("mains", F.lit(1)) - 1), lambda b: role(False, True, own, b))
    roles = (F.when(F.col("label").eqNullSafe(F.col("main")), F.transform(blocks, lambda b: role(False, False, b, place)))
             .when(F.col("mains") > 0, F.concat(others, towards)).otherwise(others))

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        inside = bool(group["among"].iloc[0]) and group["i"].iloc[0] == group["j"].iloc[0]
        one, two = (group, group) if inside else (group[group["left"]], group[~group["left"]])
        if one.empty or two.empty:
            return pd.DataFrame({"a": [], "b": []}, dtype="int64")
        keys, pos, links = np.stack(two["keys"].to_list()), int(group["pos"].iloc[0]), []
        nodes, labels, masks = (two[c].to_numpy() for c in ("node", "label", "prefix"))
        others = [x.view(np.uint64) for x in two["shingles"]]
        sizes = np.array([len(x) for x in others])
        bits = np.int64(1) << np.arange(keys.shape[1], dtype=np.int64)
        for at, (node, label, prefix, mine, own) in enumerate(zip(*(one[c] for c in (
                "node", "label", "prefix", "keys", "shingles")))):
            first = at + 1 if inside else 0  # a block meets itself in pairs, not twice
            own, same = own.view(np.uint64), keys[first:] == mine
            both = same & ((masks[first:] & prefix)[:, None] & bits != 0)
            near = first + np.flatnonzero(
                (same.sum(axis=1) >= matches) & (labels[first:] != label) & (both.argmax(axis=1) == pos)
                & (100 * np.minimum(sizes[first:], len(own)) >= percent * np.maximum(sizes[first:], len(own))))
            if not len(near):
                continue
            theirs = np.concatenate([others[k] for k in near])
            hit = own[np.minimum(np.searchsorted(own, theirs), len(own) - 1)] == theirs
            common = np.add.reduceat(hit, np.cumsum(sizes[near]) - sizes[near], dtype=np.int64)
            linked = near[100 * common >= percent * (len(own) + sizes[near] - common)]
            _, least = np.unique(labels[linked], return_index=True)
            links += [(max(node, x), min(node, x)) for x in nodes[linked[least]]]
        return pd.DataFrame(links, columns=["a", "b"]).astype("int64")

    return (rows.select("key", "pos", "node", "prefix", "label", "keys", "shingles", F.explode(roles).alias("role"))
            .select("key", "pos", "node", "prefix", "label", "role.*", "keys", "shingles")
            .groupBy("key", "among", "i", "j").applyInPandas(compare, "a long, b long").distinct())


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80,
                    coordinates: int = COORDINATES, matches: int = MATCHES, short: int = SHORT,
                    block: int = BLOCK) -> DataFrame:
    """doc_id, text_hash, n_shingles, component_id, kept for every row of ``docs``.

    Two texts are linked if their sets of distinct ``words``-word shingles have ``percent`` of their
    union in common; ``component_id`` is the smallest doc_id reachable by links. Texts without words
    and null texts are linked with nothing. Rows without an id take part; their component_id is that
    of the rows they reach, null if none of them has an id. Repeated rows share one answer. An empty
    table gives no rows. ``coordinates`` is at most 62.
    """
    members, sets = distinct_sets(sketches(docs, words, coordinates))
    lists = prefix_lists(sets, coordinates, matches)
    info = written(lists.groupBy("key").agg(
        F.count("*").alias("n"), F.min(F.struct(F.xxhash64("key", "node").alias("h"), "node")).alias("c"))
        .where("n > 1").select("key", "n", F.col("c.node").alias("centre")), "lists")
    total = info.agg(F.sum("n")).first()[0] or 0
    star = (join_counted(lists, info, "key", "n", total, F.col("node"), hot=1024)
            .select("node", F.col("_group.centre").alias("centre")).where("node <> centre")
            .select(F.least("node", "centre").alias("a"), F.greatest("node", "centre").alias("b")))
    brief = lists.join(info.where(F.col("n") <= short).select("key"), "key").select("key", "node")
    small = (brief.toDF("key", "a").join(brief.toDF("key", "b"), "key").where("a < b")
             .select("a", "b"))
    pairs = written(count_collisions(star.union(small).distinct(), sets, matches), "pairs")
    long_lists = info.where(F.col("n") > short)
    wanted = (pairs.select(F.col("a").alias("node")).union(pairs.select("b"))
              .union(lists.join(long_lists.select("key"), "key").select("node")).distinct())
    full = full_sets(docs, sets, wanted, words)
    links = written(confirm(pairs, full, percent), "links")
    found = components(links)
    more = written(across_classes(lists, sets, found, long_lists, full, matches, percent, block), "links")
    if not more.isEmpty():
        found = components(links.union(more))
    # A class goes by the smallest doc_id of its sets; rows of sets without links by that of their own.
    linked = found.union(found.select(F.col("component").alias("node"), "component").distinct())
    classes = written(linked.join(sets.select("node", "least_id"), "node").groupBy("component").agg(
        F.min("least_id").alias("smallest"), F.count("*").alias("n")), "classes")
    total = classes.agg(F.sum("n")).first()[0] or 0
    named = (join_counted(linked, classes, "component", "n", total, F.col("node"))
             .select("node", F.lit(True).alias("linked"), F.col("_group.smallest").alias("smallest")))
    return (members.join(named, "node", "left")
            .withColumn("component_id", F.when(F.col("linked"), F.col("smallest"))
                        .otherwise(F.col("least_id")))
            .select("doc_id", "text_hash", "n_shingles", "component_id",
                    F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")))
