"""Collocations by set-oriented mining: relations of sorted occurrences, extended word by word.

The occurrences of a language are cut into chunks of whole pieces. A relation is a table with a row per
chunk that holds its occurrences as sorted columns of packed numbers: place (a running number in which pieces
are never adjacent) and group (the number of a frequent phrase). To extend phrases by a word, a chunk's relation is
merged with itself by adjacent place, the pairs are counted in the chunk and added up over all chunks by a
grouping, and the relation is semi-joined with the pairs that are frequent before the next length. Each
relation is written; a chunk is bounded. Frequent groups go to all tasks while their size, which is checked,
allows it; beyond, each chunk is co-grouped with those that it has.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame, Window, functions as F

from ratingloom.llm.shared import written
from ratingloom.operators.spread import is_small, spread_join

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LEAST = 30
LONGEST = 4
TOP = 2_000
# A part of a longer candidate goes if that has so many hundredths of its occurrences.
COVERED = 80
SCALE = 2_000_000
# Words in a chunk. A chunk ends between pieces, so only a longer piece exceeds it.
CHUNK = 1 << 18
# A task that reads many languages closes its largest chunk beyond so many chunks' words.
OPEN = 4
# Pairs that a task counts at a time, and occurrences of all texts per bucket of pairs.
COUNTED = 1 << 20
A_BUCKET = 1 << 21
# Frequent groups up to this size are sent to all tasks.
SENT_BYTES = 32 << 20
UNKNOWN = "und"

# Bytes of UTF-8 text: piece ends become line ends, tabs blanks, A-Z lower case.
PIECE_ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
TABLE = bytes.maketrans(PIECE_ENDS + b"\t", b"\n" * len(PIECE_ENDS) + b" ")


def words_of(text: str) -> tuple[list[bytes], np.ndarray]:
    """The words of a text, and whether each begins a piece."""
    raw = text.encode("utf-8", "surrogatepass").translate(TABLE).lower()
    found = raw.split()
    if not found:
        return found, np.empty(0, bool)
    data = np.frombuffer(raw, np.uint8)
    solid = (data != 32) & (data != 10)
    starts = np.flatnonzero(solid & ~np.concatenate([[False], solid[:-1]]))
    ends = np.cumsum(data == 10)[starts]
    return found, np.concatenate([[True], ends[1:] != ends[:-1]])


class _Chunk:
    """Words of one language on their way into a row."""

    def __init__(self) -> None:
        self.known: dict[bytes, int] = {}
        self.codes: list[np.ndarray] = []
        self.breaks: list[np.ndarray] = []
        self.size = 0

    def add(self, words: list[bytes], begins: np.ndarray) -> None:
        known = self.known
        self.codes.append(np.fromiter((known.setdefault(w, len(known)) for w in words), np.int32, len(words)))
        self.breaks.append(begins)
        self.size += len(words)

    def row(self, lang: str, chunk: int) -> dict:
        codes, begins = np.concatenate(self.codes), np.concatenate(self.breaks)
        counts = np.bincount(codes, minlength=len(self.known))
        return {"chunk": chunk, "lang": lang, "size": self.size, "steps": packed(1 + begins.astype(np.int64)),
                "code": packed(codes), "words": [w.decode("utf-8", "surrogatepass") for w in self.known],
                "counts": counts}


def packed(numbers: np.ndarray) -> bytes:
    """Whole numbers from 0 as bytes of the least width, which the first byte tells: a cell that Spark and its
    files move as it is."""
    top = int(numbers.max(initial=0))
    width = next(w for w in (1, 2, 4, 8) if top < 1 << 8 * w)
    return bytes([width]) + numbers.astype(f"<u{width}").tobytes()


def unpacked(cell: bytes) -> np.ndarray:
    return np.frombuffer(cell, f"<u{cell[0]}", offset=1).astype(np.int64)


def _batch(row: dict, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([row[f.name]], f.type) for f in schema], schema=schema)


OCCURRENCES = pa.schema([("chunk", pa.int64()), ("lang", pa.string()), ("size", pa.int64()),
                         ("steps", pa.binary()), ("code", pa.binary()),
                         ("words", pa.list_(pa.string())), ("counts", pa.list_(pa.int64()))])
RELATION = pa.schema([("chunk", pa.int64()), ("lang", pa.string()), ("steps", pa.binary()),
                      ("group", pa.binary()), ("next", pa.binary())])
COUNTS = pa.schema([("bucket", pa.int32()), ("steps", pa.binary()), ("n", pa.binary())])


def chunks(docs: DataFrame, chunk_words: int = CHUNK) -> DataFrame:
    """All words of all texts: a row per chunk of one language, with places, the chunk's own word codes,
    and its words with their counts."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_chunks: dict[str, _Chunk] = {}
        number = TaskContext.get().partitionId() << 33

        def closed(lang: str) -> pa.RecordBatch:
            nonlocal number
            number += 1
            return _batch(open_chunks.pop(lang).row(lang, number), OCCURRENCES)

        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), batch.column(1)
            for lang, text in zip(langs, texts):
                words, begins = words_of(text.as_py())
                while words:
                    here = open_chunks.setdefault(lang, _Chunk())
                    take = len(words)
                    if here.size + take > chunk_words:  # up to the last piece that fits, at least one
                        firsts = np.flatnonzero(begins)
                        fitting = firsts[firsts <= chunk_words - here.size]
                        take = int(fitting[-1]) if len(fitting) else 0
                        if not take and not here.size:
                            take = int(firsts[1]) if len(firsts) > 1 else len(words)
                    if take:
                        here.add(words[:take], begins[:take])
                        words, begins = words[take:], begins[take:]
                    if words:
                        yield closed(lang)
                if sum(c.size for c in open_chunks.values()) > OPEN * chunk_words:
                    yield closed(max(open_chunks, key=lambda k: open_chunks[k].size))
        for lang in list(open_chunks):
            yield closed(lang)

    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"),
                        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).where("text <> ''")
    kinds = "chunk long, lang string, size long, steps binary, code binary, words array<string>, counts array<long>"
    return texts.mapInArrow(cut, kinds)


# --- extending ----------------------------------------------------------------------------------

def _column(table: pa.Table | pa.RecordBatch, name: str, row: int = 0) -> np.ndarray:
    return unpacked(table.column(name)[row].as_py())


def _adjacent(place: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The value at each wanted place, -1 where the sorted places lack it: a merge of two sorted lists."""
    if not len(place):
        return np.full(len(wanted), -1, np.int64)
    at = np.minimum(np.searchsorted(place, wanted), len(place) - 1)
    return np.where(place[at] == wanted, values[at], -1)


def _restricted(of: pa.Table | pa.RecordBatch, i: int, place: np.ndarray, group: np.ndarray,
                following: np.ndarray) -> pa.RecordBatch:
    """Row ``i`` of a relation with other occurrences."""
    return _batch({"chunk": of.column("chunk")[i].as_py(), "lang": of.column("lang")[i].as_py(),
                   "steps": packed(np.diff(place, prepend=0)), "group": packed(group),
                   "next": packed(following + 1)}, RELATION)


def _followed(of: pa.Table | pa.RecordBatch, i: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """place, group and next word (-1: none that is frequent) of row ``i``. The relation of single words
    holds no next words, as these are the groups of the next places."""
    place, group, following = np.cumsum(_column(of, "steps", i)), _column(of, "group", i), _column(of, "next", i)
    return place, group, following - 1 if len(following) else _adjacent(place, group, place + 1)


RELATION_KINDS = "chunk long, lang string, steps binary, group binary, next binary"
NONE = np.empty(0, np.int64)


def _of_words(of: pa.Table | pa.RecordBatch, i: int, ids: np.ndarray) -> pa.RecordBatch:
    """Row ``i`` of the occurrences with ``ids`` (-1: not frequent) in place of its own codes."""
    place, group = np.cumsum(_column(of, "steps", i)), ids[_column(of, "code", i)]
    return _restricted(of, i, place[group >= 0], group[group >= 0], NONE)


def frequent_words(occurrences: DataFrame, frequent: DataFrame, sent_bytes: int = SENT_BYTES) -> DataFrame:
    """The relation of frequent words."""
    wanted = frequent.select("lang", "phrase", "id")
    if is_small(wanted, sent_bytes):
        by_lang = {}
        table = wanted.toArrow().combine_chunks()
        for lang in pc.unique(table["lang"]).to_pylist():
            of = table.filter(pc.equal(table["lang"], lang))
            by_lang[lang] = of["phrase"].combine_chunks(), of["id"].to_numpy()
        known = occurrences.sparkSession.sparkContext.broadcast(by_lang)

        def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i, lang in enumerate(batch.column("lang").to_pylist()):
                    phrases, ids = known.value.get(lang, (pa.array([], pa.string()), NONE))
                    at = pc.index_in(batch.column("words")[i].values.cast(pa.string()), phrases.cast(pa.string()))
                    at = pc.fill_null(at, -1).to_numpy(zero_copy_only=False)
                    yield _of_words(batch, i, np.where(at >= 0, np.append(ids, -1)[at], -1))

        return occurrences.select("chunk", "lang", "steps", "code", "words").mapInArrow(number, RELATION_KINDS)
    codes = occurrences.select("chunk", "lang", F.posexplode("words").alias("code", "phrase"))
    here = spread_join(codes, wanted, ["lang", "phrase"]).select(F.col("chunk").alias("of"), "code", "id")

    def restrict(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left) or not len(right):
            return RELATION.empty_table()
        ids = np.full(int(_column(left, "code").max()) + 1, -1, np.int64)
        ids[right["code"].to_numpy()] = right["id"].to_numpy()
        return pa.Table.from_batches([_of_words(left, 0, ids)])

    return (occurrences.select("chunk", "lang", "steps", "code").groupBy("chunk")
            .cogroup(here.groupBy("of")).applyInArrow(restrict, RELATION_KINDS))


def _pairs(of: pa.Table | pa.RecordBatch, i: int, words: int) -> np.ndarray:
    """Row ``i``'s phrases that a frequent word follows, as group * words + word."""
    _, group, following = _followed(of, i)
    return (group * words + following)[following >= 0]


def pair_counts(relation: DataFrame, words: int, buckets: int, least: int) -> DataFrame:
    """pair (group * words + word), a: how often each frequent phrase is followed by each of the ``words``
    frequent words, where that is at least ``least``.

    A task counts the pairs of a few chunks, and sends each of ``buckets`` parts of them as one row of sorted
    numbers; a bucket's rows are then added up.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def sent() -> Iterator[pa.RecordBatch]:
            pairs, n = np.unique(np.concatenate(held), return_counts=True)
            bucket = (pairs.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)) % np.uint64(buckets)
            order = np.argsort(bucket, kind="stable")
            edges = np.searchsorted(bucket[order], np.arange(buckets + 1, dtype=np.uint64))
            for b in np.flatnonzero(np.diff(edges)):
                part = order[edges[b]:edges[b + 1]]
                yield _batch({"bucket": int(b), "steps": packed(np.diff(pairs[part], prepend=0)),
                              "n": packed(n[part])}, COUNTS)

        for batch in batches:
            for i in range(batch.num_rows):
                held.append(_pairs(batch, i, words))
                size += len(held[-1])
                if size > COUNTED:
                    yield from sent()
                    held, size = [], 0
        if size:
            yield from sent()

    def added(rows: pa.Table) -> pa.Table:
        pairs = np.concatenate([np.cumsum(unpacked(x)) for x in rows["steps"].to_pylist()])
        n = np.concatenate([unpacked(x) for x in rows["n"].to_pylist()])
        order = np.argsort(pairs, kind="stable")
        pairs, n = pairs[order], n[order]
        firsts = np.flatnonzero(np.diff(pairs, prepend=-1))
        total = np.add.reduceat(n, firsts)
        keep = total >= least
        return pa.table({"pair": pairs[firsts][keep], "a": total[keep]})

    sent = relation.select("chunk", "steps", "group", "next").mapInArrow(count, "bucket int, steps binary, n binary")
    return sent.groupBy("bucket").applyInArrow(added, "pair long, a long")


def chunk_pairs(relation: DataFrame, words: int) -> DataFrame:
    """of (a chunk), pair: the distinct pairs of each chunk."""
    schema = pa.schema([("of", pa.int64()), ("pair", pa.int64())])

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                pairs = np.unique(_pairs(batch, i, words))
                chunk = np.full(len(pairs), batch.column("chunk")[i].as_py())
                yield pa.RecordBatch.from_arrays([pa.array(chunk, pa.int64()), pa.array(pairs, pa.int64())], schema=schema)

    return relation.select("chunk", "steps", "group", "next").mapInArrow(listed, "of long, pair long")


def _longer(of: pa.Table | pa.RecordBatch, i: int, words: int, pairs: np.ndarray, ids: np.ndarray) -> pa.RecordBatch:
    """Row ``i`` with phrases one word longer, of the sorted ``pairs`` with their ``ids``. The next place's
    phrase ends one word further, so its next word follows the longer phrase too."""
    place, group, following = _followed(of, i)
    found = np.where(following >= 0, _adjacent(pairs, ids, group * words + following), -1)
    keep = found >= 0
    return _restricted(of, i, place[keep], found[keep], _adjacent(place, following, place[keep] + 1))


def extended(relation: DataFrame, frequent: DataFrame, words: int, sent_bytes: int = SENT_BYTES) -> DataFrame:
    """The relation of phrases one word longer: occurrences that ``frequent`` (pair, id) has, each with the
    word behind it."""
    wanted = frequent.select("pair", "id")
    if is_small(wanted, sent_bytes):
        table = wanted.toArrow()
        pairs, ids = (table[c].to_numpy() for c in ("pair", "id"))
        order = np.argsort(pairs)
        known = relation.sparkSession.sparkContext.broadcast((pairs[order], ids[order]))

        def lengthen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(batch.num_rows):
                    yield _longer(batch, i, words, *known.value)

        return relation.mapInArrow(lengthen, RELATION_KINDS)
    here = spread_join(chunk_pairs(relation, words), wanted, ["pair"])

    def restrict(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left) or not len(right):
            return RELATION.empty_table()
        pairs, ids = right["pair"].to_numpy(), right["id"].to_numpy()
        order = np.argsort(pairs)
        return pa.Table.from_batches([_longer(left, 0, words, pairs[order], ids[order])])

    return relation.groupBy("chunk").cogroup(here.groupBy("of")).applyInArrow(restrict, RELATION_KINDS)


def numbered(rows: DataFrame, label: str) -> DataFrame:
    """``rows``, written, with an ``id`` from 0 without gaps."""
    rows = written(rows.withColumn("at", F.monotonically_increasing_id()), label)
    part = F.shiftrightunsigned("at", 33)
    starts = rows.groupBy(part.alias("part")).agg(F.count("*").alias("n")).withColumn(
        "before", F.sum("n").over(Window.orderBy("part")) - F.col("n")).drop("n")  # a row per file
    return (rows.withColumn("part", part).join(F.broadcast(starts), "part")
            .withColumn("id", F.col("before") + F.col("at").bitwiseAND((1 << 33) - 1)).drop("part", "at", "before"))


def phrases(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, chunk_words: int = CHUNK,
            sent_bytes: int = SENT_BYTES) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, length, a) of all phrases of at most ``longest`` words with ``least`` occurrences or
    more, and (lang, n) with the words of each language."""
    occurrences = written(chunks(docs, chunk_words), "occurrences", "zstd")
    totals = written(occurrences.groupBy("lang").agg(F.sum("size").alias("n")), "totals")
    size = totals.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    words = numbered(occurrences.select("lang", F.explode(F.arrays_zip("words", "counts")).alias("w"))
                     .groupBy("lang", F.col("w.words").alias("phrase")).agg(F.sum("w.counts").alias("a"))
                     .where(F.col("a") >= least), "phrases-1")
    relation = written(frequent_words(occurrences, words, sent_bytes), "relation-1", "zstd")
    whole = words.select("lang", "phrase", F.lit(1).alias("length"), "a")
    last, known = words, max(1, words.count())
    for length in range(2, longest + 1):
        pairs = numbered(pair_counts(relation, known, 1 + size // A_BUCKET, least), f"pairs-{length}")
        named = pairs.select("a", "id", "pair", F.expr(f"pair DIV {known}").alias("group"),
                             F.expr(f"pair % {known}").alias("word"))
        named = spread_join(named, last.select(F.col("id").alias("group"), "lang", "phrase"), ["group"])
        named = spread_join(named, words.select(F.col("id").alias("word"), F.col("phrase").alias("next")), ["word"])
        last = written(named.select("lang", F.concat_ws(" ", "phrase", "next").alias("phrase"), "a", "id"),
                       f"phrases-{length}")
        whole = whole.unionByName(last.select("lang", "phrase", F.lit(length).alias("length"), "a"))
        if length < longest:
            relation = written(extended(relation, pairs, known, sent_bytes), f"relation-{length}", "zstd")
    return whole, totals


# --- scores -------------------------------------------------------------------------------------

def _part(first: Column, count: Column) -> Column:
    return F.array_join(F.slice("w", first, count), " ")


def scored(counts: DataFrame, scale: int = SCALE) -> DataFrame:
    """lang, phrase, a, l, r, score of every phrase of two words or more, by its lowest-scoring cut."""
    longer = counts.where("length > 1").withColumn("w", F.split("phrase", " "))
    cuts = longer.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("length") - 1))).select(
        "lang", "phrase", "a", "k", _part(F.lit(1), F.col("k")).alias("first"),
        _part(F.col("k") + 1, F.col("length") - F.col("k")).alias("rest"))
    parts = counts.select("lang", F.col("phrase").alias("part"), F.col("a").alias("f"))
    cuts = spread_join(cuts, parts.withColumnsRenamed({"part": "first", "f": "l"}), ["lang", "first"])
    cuts = spread_join(cuts, parts.withColumnsRenamed({"part": "rest", "f": "r"}), ["lang", "rest"])
    # Whole numbers of up to 38 digits.
    score = F.expr(f"CAST(CAST({scale} AS DECIMAL(10, 0)) * CAST(a AS DECIMAL(20, 0)) "
                   "DIV (CAST(l AS DECIMAL(20, 0)) + CAST(r AS DECIMAL(20, 0))) AS BIGINT)")
    return (cuts.withColumn("score", score).groupBy("lang", "phrase")
            .agg(F.min(F.struct("score", "k", "l", "r", "a")).alias("c"))
            .select("lang", "phrase", "c.a", "c.l", "c.r", "c.score"))


def uncovered(candidates: DataFrame, counts: DataFrame, percent: int = COVERED) -> DataFrame:
    """Without the candidates that lie inside a longer one with nearly as many occurrences."""
    w = counts.where("length > 2").select("lang", "a", "length", F.split("phrase", " ").alias("w"))
    inside = (w.withColumn("size", F.explode(F.sequence(F.lit(2), F.col("length") - 1)))
              .withColumn("from", F.explode(F.sequence(F.lit(1), F.col("length") - F.col("size") + 1)))
              .select("lang", _part(F.col("from"), F.col("size")).alias("phrase"), "a")
              .groupBy("lang", "phrase").agg(F.max("a").alias("longer")))
    covers = F.expr(f"CAST(100 AS DECIMAL(3, 0)) * CAST(longer AS DECIMAL(20, 0)) >= "
                    f"CAST({percent} AS DECIMAL(3, 0)) * CAST(a AS DECIMAL(20, 0))")
    return candidates.join(inside, ["lang", "phrase"], "left").where(
        ~F.coalesce(covers, F.lit(False))).drop("longer")


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP,
                 chunk_words: int = CHUNK, sent_bytes: int = SENT_BYTES) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``top`` phrases of each language by score.

    Null texts have no words; a null language is ``und``; texts of one language are counted together
    however often a row is repeated; ties are in the order of the phrases' bytes; an empty table
    gives no rows. Other columns of ``docs`` are not read.
    """
    counts, totals = phrases(docs, least, longest, chunk_words, sent_bytes)
    kept = written(uncovered(scored(counts), counts), "candidates")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    best = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return best.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l",
                                            "r", "n", "score")
