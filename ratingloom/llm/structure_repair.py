"""Cheapest repairs of conversations, by dynamic programming over grammar-compressed sequences.

A row becomes a symbol of its role and its fault. Symbols of a conversation, in blocks of bounded length,
are strings; Re-Pair replaces pairs that occur often in all of them by rules, round by round. A symbol has a
min-plus matrix: for each state of the grammar ``(s?(ua)+)?`` before and after it, the least cost and the
edits, kept as a rope. A rule's matrix is the product of its two parts', computed once and shared by
all conversations; a block's matrix is the product over what is left of its string. Blocks of a
conversation are then folded by costs and by the order of their edits alone, so that a conversation of any
length never has its edits, rows or texts in one place before the result's own row.
"""

from __future__ import annotations

import functools
import sys
from collections.abc import Iterator
from hashlib import sha256

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

from ratingloom.llm.shared import join_counted, written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Costs of the edits, what an undeleted truncated row adds, and the inserted roles by state.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
# States: nothing yet, behind a system row, behind a user row, behind an assistant row. A conversation may
# end in the first and the last.
START, SYSTEM, USER, ASSISTANT = range(4)
AFTER = {("s", START): SYSTEM, ("u", START): USER, ("u", SYSTEM): USER, ("u", ASSISTANT): USER,
         ("a", USER): ASSISTANT}
ENDS = (START, ASSISTANT)
LEGAL = ("su", "ua", "au")
GONE = "x"  # the symbol of a row that must be deleted
# Rows in one block, rounds of Re-Pair, and rules made in a round.
BLOCK_BITS = 12
ROUNDS = 8
RULES_A_ROUND = 32
FIRST_RULE = 0xE000  # rules are written as characters for private use


def wanted(state: int) -> str:
    """The role that an inserted or rerole row gets behind ``state``."""
    return "a" if state == USER else "u"


# --- matrices ----------------------------------------------------------------------------------

def leaves(rope) -> Iterator[str]:
    stack = [rope]
    while stack:
        top = stack.pop()
        if isinstance(top, tuple):
            stack.extend((top[1], top[0]))
        elif top:
            yield top


def compare(a, b) -> int:
    """Order of two ropes as strings, reading no further than their first difference."""
    left, right = leaves(a), leaves(b)
    x, y = next(left, ""), next(right, "")
    while x and y:
        n = min(len(x), len(y))
        if x[:n] != y[:n]:
            return -1 if x < y else 1
        x, y = x[n:] or next(left, ""), y[n:] or next(right, "")
    return bool(x) - bool(y)


def better(a, b):
    """The cheaper of two cells (cost, rope) or None; of equally cheap ones the smaller string."""
    if a is None or b is None:
        return a or b
    if a[0] != b[0]:
        return a if a[0] < b[0] else b
    return a if compare(a[1], b[1]) <= 0 else b


def inserts() -> list[list]:
    """What inserted rows alone can reach: the cell of each pair of states."""
    table = [[None] * 4 for _ in range(4)]
    for i in range(4):
        state, cost, text = i, 0, ""
        while table[i][state] is None:
            table[i][state] = (cost, text)
            state, cost, text = AFTER[wanted(state), state], cost + INSERT, text + "I"
    return table


def product(a: list[list], b: list[list]) -> list[list]:
    out = [[None] * 4 for _ in range(4)]
    for i in range(4):
        for k in range(4):
            if a[i][k] is not None:
                cost, rope = a[i][k]
                for j in range(4):
                    if b[k][j] is not None:
                        out[i][j] = better(out[i][j], (cost + b[k][j][0], (rope, b[k][j][1])))
    return out


def identity() -> list[list]:
    return [[(0, "") if i == j else None for j in range(4)] for i in range(4)]


def symbol_matrix(symbol: str) -> list[list]:
    """Insertions and then the edit of one row, from each state to each state."""
    edits = [[None] * 4 for _ in range(4)]
    for i in range(4):
        edits[i][i] = (DELETE, "D")
        if symbol != GONE:
            extra, role = (TRUNCATED if symbol.isupper() else 0), symbol.lower()
            goal = AFTER[wanted(i), i]
            edits[i][goal] = better(edits[i][goal], (REROLE + extra, "R"))
            if (role, i) in AFTER:
                goal = AFTER[role, i]
                edits[i][goal] = better(edits[i][goal], (KEEP + extra, "K"))
    return product(inserts(), edits)


class Grammar:
    """Matrices of all symbols, rules bottom-up."""

    def __init__(self, rules: list[str]):
        self.matrices = {s: symbol_matrix(s) for s in "suaoSUAO" + GONE}
        for i, (left, right) in enumerate(rules):
            self.matrices[chr(FIRST_RULE + i)] = product(self.matrices[left], self.matrices[right])

    def of(self, packed: str) -> list[list]:
        """The product over a packed string, by halves."""
        parts = [self.matrices[c] for c in packed] or [identity()]
        while len(parts) > 1:
            parts = [product(*parts[i:i + 2]) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
        return parts[0]


def digest_matrix(matrix: list[list]) -> tuple[list, list, list]:
    """Costs (-1: impossible), places of the strings among those from the same state, and the strings."""
    costs, order, audits = [], [], []
    for row in matrix:
        ranked = sorted((j for j in range(4) if row[j] is not None),
                        key=functools.cmp_to_key(lambda a, b: compare(row[a][1], row[b][1])))
        for j in range(4):
            costs.append(-1 if row[j] is None else row[j][0])
            order.append(ranked.index(j) if row[j] is not None else -1)
            audits.append(None if row[j] is None else "".join(leaves(row[j][1])))
    return costs, order, audits


def fold(blocks: list[tuple[list[int], list[int]]]) -> tuple[int, list[int], int]:
    """Least cost, the cell that each block takes, and the rows to be inserted behind the last.

    Every string of a block ends with the edit of its last row, so of two strings with the same start
    none is the beginning of the other: equally cheap ways are ordered by the first block in which they
    differ, and a rank per state carries that order along.
    """
    cost, rank = {START: 0}, {START: 0}
    steps = []
    for costs, order in blocks:
        best = {}
        for i, before in cost.items():
            for j in range(4):
                if costs[4 * i + j] >= 0:
                    way = (before + costs[4 * i + j], rank[i], order[4 * i + j], i)
                    if j not in best or way < best[j]:
                        best[j] = way
        steps.append({j: way[3] for j, way in best.items()})
        cost = {j: way[0] for j, way in best.items()}
        ranked = sorted(best, key=lambda j: best[j][1:3])
        rank = {j: ranked.index(j) for j in best}
    closing = inserts()
    total, _, state, tail = min((cost[j] + closing[j][e][0], rank[j], j, len(closing[j][e][1]))
                                for j in cost for e in ENDS if closing[j][e] is not None)
    cells = []
    for step in reversed(steps):
        cells.append(4 * step[state] + state)
        state = step[state]
    return total, cells[::-1], tail


# --- rows ---------------------------------------------------------------------------------------

def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and ``gone`` after the fixed damage by crc32 of ``conv_id:turn`` modulo
    20; nulls are one space in role, text and key. Gone rows stay, marked."""
    def plain(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    fate = F.crc32(F.concat_ws(":", plain("conv_id"), plain("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", plain("role").alias("role"), plain("text").alias("text"),
                                fate.alias("fate"))
    text = (F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.translate("text", ".!?", ""))
            .otherwise(F.col("text")))
    copies = F.when(F.col("fate") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv_id", "turn", F.when(F.col("fate") == 4, "user").otherwise(F.col("role")).alias("role"),
                       text.alias("text"), (F.col("fate") == 0).alias("gone"), F.explode(copies).alias("copy")
                       ).drop("copy")


def _keyed(rows: DataFrame) -> DataFrame:
    """Plain columns and ``digest``, which is equal for rows of a conversation with equal role and text."""
    conv = F.col("conv_id").cast("string")
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    key = F.concat_ws("/", F.isnull(conv).cast("string"), F.length(conv).cast("string"), conv,
                      F.length(role).cast("string"), role, text)
    return rows.select("conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"),
                       F.col("gone"), F.md5(key).alias("digest"))


ORDER = ("conv_id", "turn", "digest")


def judged(rows: DataFrame) -> DataFrame:
    """A narrow row per row, ``pos`` in the order of conversation and turn, with its first fault.

    Rows are sorted over ranges of (conversation, turn, digest, row), so a conversation of any size, or one
    row repeated any number of times, is spread over tasks.
    """
    narrow = written(_keyed(rows).select(
        "conv_id", "turn", "digest", "gone", F.substring("role", 1, 1).alias("initial"),
        (~F.col("text").rlike(r"[^\x20\x09-\x0D]")).alias("blank"),
        (~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")).alias("cut"),
        F.monotonically_increasing_id().alias("row")), "turns")
    rows = written(narrow.repartitionByRange(*ORDER, "row").sortWithinPartitions(*ORDER, "row").drop("row")
                   .withColumn("pos", F.monotonically_increasing_id()), "turns-sorted")
    again = written(rows.where("not gone").groupBy("digest").agg(
        F.count("*").alias("n"), F.min("pos").alias("first")).where("n > 1"), "repeats")
    found = join_counted(rows, again, "digest", "n", max(1, rows.count()), F.col("pos"))
    repeat = F.coalesce(F.col("pos") > F.col("_group.first"), F.lit(False))
    fault = (F.when(F.col("blank"), "blank").when(repeat, "duplicate").when(F.col("cut"), "truncated")
             .otherwise("none"))
    role = F.when(F.col("initial").isin("s", "u", "a"), F.col("initial")).otherwise("o")
    return found.withColumn("fault", fault).select(
        "conv_id", "turn", "pos", "gone", "initial", "fault",
        F.when(F.col("fault").isin("blank", "duplicate"), GONE)
        .when(F.col("fault") == "truncated", F.upper(role)).otherwise(role).alias("symbol"))


def blocks_of(rows: DataFrame) -> DataFrame:
    """One row per conversation and stretch of 4,096 positions: its symbols as a string and its counts."""
    row = F.struct("pos", "symbol", "initial", "turn", "fault")
    items = F.array_sort(F.collect_list(F.when(~F.col("gone"), row)))

    def fault(name: str) -> Column:
        return F.size(F.filter("items", lambda r: r["fault"] == name)).alias(name)

    pairs = F.zip_with(F.slice("initials", 1, F.greatest(F.size("initials") - 1, F.lit(0))),
                       F.slice("initials", 2, F.greatest(F.size("initials") - 1, F.lit(0))),
                       lambda a, b: F.concat(a, b))
    return (rows.groupBy("conv_id", F.shiftright("pos", BLOCK_BITS).alias("block"))
            .agg(F.min("pos").alias("id"), items.alias("items"))
            .withColumn("initials", F.transform("items", lambda r: r["initial"]))
            .withColumn("turns", F.filter(F.transform("items", lambda r: r["turn"]), lambda t: t.isNotNull()))
            .select("conv_id", "id", F.array_join(F.transform("items", lambda r: r["symbol"]), "").alias("seq"),
                    fault("blank"), fault("duplicate"), fault("truncated"),
                    F.size(F.filter(pairs, lambda p: ~p.isin(*LEGAL))).alias("illegal"),
                    F.get("initials", F.lit(0)).alias("first"), F.get("initials", F.size("initials") - 1).alias("last"),
                    F.array_min("turns").alias("low"), F.array_max("turns").alias("high"),
                    F.size(F.array_distinct("turns")).alias("turns")))


def grammar_of(seqs: DataFrame, rounds: int = ROUNDS, a_round: int = RULES_A_ROUND) -> tuple[list[str], DataFrame]:
    """The rules, and ``seqs`` (seq) with ``packed``.

    Each round counts the adjacent pairs of all strings, makes rules of the most frequent (at least twice;
    ties by the pair) and replaces them one after the other, left to right. So a rule refers to
    symbols and earlier rules only. There are at most ``rounds`` x ``a_round`` rules at any input.
    """
    rules: list[str] = []
    state = seqs.withColumn("packed", F.col("seq"))
    for _ in range(rounds):
        chars = F.filter(F.split("packed", ""), lambda c: c != "")
        n = F.greatest(F.size("chars") - 1, F.lit(0))
        best = (state.select(chars.alias("chars")).select(F.explode(F.zip_with(
            F.slice("chars", F.lit(1), n), F.slice("chars", F.lit(2), n), lambda a, b: F.concat(a, b))).alias("pair"))
            .groupBy("pair").agg(F.count("*").alias("n")).where("n > 1")
            .orderBy(F.desc("n"), "pair").limit(a_round).collect())
        if not best:
            break
        packed = F.col("packed")
        for row in best:
            packed = F.replace(packed, F.lit(row["pair"]), F.lit(chr(FIRST_RULE + len(rules))))
            rules.append(row["pair"])
        state = written(state.withColumn("packed", packed), "packed")
    return rules, state


MATRIX = "costs array<int>, order array<int>, audits array<string>"


def with_matrices(packed: DataFrame, rules: list[str]) -> DataFrame:
    """``packed`` with the digest of each string's matrix. The rules' matrices are made once a task."""
    def evaluate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        grammar = Grammar(rules)
        for batch in batches:
            rows = [digest_matrix(grammar.of(text)) for text in batch["packed"]]
            yield pd.DataFrame({"seq": batch["seq"], "n": batch["n"], **{
                name: [row[i] for row in rows] for i, name in enumerate(("costs", "order", "audits"))}})

    return packed.select("seq", "n", "packed").mapInPandas(evaluate, f"seq string, n long, {MATRIX}")


SUMMARY = ("gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint")
FOLDED = f"struct<{SUMMARY.replace(' bigint', ':bigint')}, tail:int, cells:array<struct<id:bigint,cell:int>>>"


def _fold_rows(blocks) -> dict:
    """The summary of one conversation from its blocks, in order of position."""
    out = {"gaps": 0, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}
    last, low, high, turns = None, None, None, 0
    for b in blocks:
        for name in ("blank", "duplicate", "truncated", "illegal"):
            out[name] += int(b[name])
        if b["first"] is not None:
            out["illegal"] += last is not None and last + b["first"] not in LEGAL
            last = b["last"]
        if b["low"] is not None:
            turns += int(b["turns"]) - (high is not None and high == int(b["low"]))
            low, high = int(b["low"]) if low is None else low, int(b["high"])
    if low is not None:
        out["gaps"] = min(high - low + 1 - turns, (1 << 63) - 1)
    cost, cells, tail = fold([(b["costs"], b["order"]) for b in blocks])
    return out | {"cost": cost, "tail": tail,
                  "cells": [{"id": int(b["id"]), "cell": c} for b, c in zip(blocks, cells)]}


def with_audits(blocks: DataFrame) -> DataFrame:
    """conv_id, the summary's counts, and ``audit``: one row per conversation.

    The fold sees two short lists of a block, and only then the chosen strings are put together.
    """
    small = ["id", "blank", "duplicate", "truncated", "illegal", "first", "last", "low", "high", "turns",
             "costs", "order"]
    lists = blocks.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct(*small))).alias("blocks"))

    @F.pandas_udf(FOLDED)
    def folded(lists: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([_fold_rows(rows) for rows in lists])

    counts = [part.split()[0] for part in SUMMARY.split(", ")]
    cells = (lists.select("conv_id", F.col("blocks")[0]["id"].alias("key"), folded("blocks").alias("f"))
             .select("conv_id", "key", *[F.col("f")[c].alias(c) for c in [*counts, "tail"]],
                     F.explode("f.cells").alias("c")))
    chosen = cells.withColumn("id", F.col("c.id")).join(blocks.select("id", "audits"), "id").withColumn(
        "part", F.element_at("audits", F.col("c.cell") + 1))
    return chosen.groupBy("key").agg(
        F.first("conv_id").alias("conv_id"), *[F.first(c).alias(c) for c in [*counts, "tail"]],
        F.array_sort(F.collect_list(F.struct("id", "part"))).alias("parts")).select(
        "conv_id", *counts,
        F.concat(F.array_join(F.transform("parts", lambda p: p["part"]), ""), F.repeat(F.lit("I"), F.col("tail")))
        .alias("audit"))


class Walk:
    """Follows the edits of one conversation row by row."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, START

    def inserted(self) -> Iterator[tuple[str, str, str]]:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.at += 1
            yield self._made("I", "")

    def _made(self, edit: str, text: str) -> tuple[str, str, str]:
        role = wanted(self.state)
        self.state = AFTER[role, self.state]
        return edit, "assistant" if role == "a" else "user", text

    def row(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        yield from self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "R":
            yield self._made(edit, text)
        elif edit == "K":
            self.state = AFTER[role[:1], self.state]
            yield edit, role, text


def repaired(rows: DataFrame, gone: Column | None = None) -> DataFrame:
    """The repaired conversations: conv_id, place, edit (K, R or I), role, text, and ``summary``.

    ``rows`` has conv_id, turn, role and text; other columns are not read. Rows for which ``gone`` holds are
    no part of their conversation. Every conversation, empty ones too, begins with a row of place 0, which
    holds its ``summary`` (gaps, faults, illegal neighbours, cost and audit: the edits of all rows);
    its rows follow it in the same task, in order. Rows stand by turn, nulls first, equal turns by a digest of role
    and text. Null roles and texts are one space; a null conv_id is a conversation of its own;
    repeated rows are duplicates; an empty table gives no rows.

    Texts are shuffled once, with the audit, and streamed: a task holds a batch and one audit.
    """
    marked = rows.select("conv_id", "turn", "role", "text", F.coalesce(
        F.lit(False) if gone is None else gone, F.lit(False)).alias("gone"))
    blocks = written(blocks_of(judged(marked)), "blocks")
    seqs = written(blocks.groupBy("seq").agg(F.count("*").alias("n")), "sequences")
    rules, packed = grammar_of(seqs)
    matrices = written(with_matrices(packed, rules), "matrices")
    evaluated = written(join_counted(blocks, matrices, "seq", "n", max(1, blocks.count()), F.col("id"))
                        .select("*", "_group.costs", "_group.order", "_group.audits").drop("_group"), "evaluated")
    heads = with_audits(evaluated)
    names = [c for c in heads.columns if c != "conv_id"]
    kind = dict(heads.dtypes)
    nothing = F.lit(None).cast(f"struct<{','.join(f'{c}:{kind[c]}' for c in names)}>")
    text = F.lit(None).cast("string")
    stream = (heads.select("conv_id", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"),
                           text.alias("digest"), text.alias("role"), text.alias("text"), F.struct(*names).alias("summary"))
              .unionByName(_keyed(marked).where("not gone").select(
                  "conv_id", F.lit(1).alias("kind"), "turn", "digest", "role", "text", nothing.alias("summary"))))
    laid = stream.repartition("conv_id").sortWithinPartitions("conv_id", "kind", "turn", "digest")

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["conv_id", "place", "edit", "role", "text", "summary"]
        now, conv, place = None, None, 0
        for batch in batches:
            out = []

            def put(made) -> None:
                nonlocal place
                for edit, role, text in made:
                    place += 1
                    out.append((conv, place, edit, role, text, None))

            for row in batch.to_dict("records"):
                if row["kind"] == 0:
                    if now:
                        put(now.inserted())
                    now, conv, place = Walk(row["summary"]["audit"]), row["conv_id"], 0
                    out.append((conv, 0, None, None, None, row["summary"]))
                else:
                    put(now.row(row["role"], row["text"]))
            yield pd.DataFrame(out, columns=columns)
        if now:
            out = []
            put(now.inserted())
            yield pd.DataFrame(out, columns=columns)

    id_kind = dict(rows.dtypes)["conv_id"]
    safe = laid.withColumn("conv_id", F.col("conv_id").cast("string"))
    summary = ", ".join(f"{c}: {kind[c]}" for c in names)
    found = safe.mapInPandas(walk, "conv_id string, place long, edit string, role string, text string, "
                                   f"summary struct<{summary}>")
    return found.withColumn("conv_id", F.col("conv_id").cast(id_kind))


def summaries(turns: DataFrame) -> DataFrame:
    """One row per conversation of ``repaired``: its summary and ``repaired_sha256``, the SHA-256 of its
    ``role:text`` lines. Reads each task's rows in their order, so nothing is shuffled."""
    names = turns.schema["summary"].dataType.fieldNames()

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        head, state = None, None
        for batch in batches:
            out = []
            for row in batch.to_dict("records"):
                if row["place"] == 0:
                    if head is not None:
                        out.append((*head, state.hexdigest()))
                    head, state = (row["conv_id"], *[row["summary"][n] for n in names]), sha256()
                else:
                    line = f"{row['role']}:{row['text']}".encode("utf-8", "surrogatepass")
                    state.update(line if row["place"] == 1 else b"\n" + line)
            yield pd.DataFrame(out, columns=["conv_id", *names, "repaired_sha256"])
        if head is not None:
            yield pd.DataFrame([(*head, state.hexdigest())], columns=["conv_id", *names, "repaired_sha256"])

    id_kind = dict(turns.dtypes)["conv_id"]
    kinds = {f.name: f.dataType.simpleString() for f in turns.schema["summary"].dataType.fields}
    found = turns.withColumn("conv_id", F.col("conv_id").cast("string")).mapInPandas(
        hashed, "conv_id string, " + ", ".join(f"{n} {kinds[n]}" for n in names) + ", repaired_sha256 string")
    return found.withColumn("conv_id", F.col("conv_id").cast(id_kind))
