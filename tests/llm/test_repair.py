"""Conversation repair against a plain search over edits."""

import random
import re
import zlib
from hashlib import sha256

import pytest

from __spark_entry__ import queries
from ratingloom.llm import structure_repair as rep

FOLDER = "/root/testdata/sf0.01"
AFTER = {("s", ""): "s", ("u", ""): "u", ("u", "s"): "u", ("u", "a"): "u", ("a", "u"): "a"}
COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        key = ":".join(" " if x is None else str(x) for x in (conv, turn))
        fate = zlib.crc32(key.encode()) % 20
        if fate == 1:
            text = ""
        elif fate == 2:
            text = re.sub("[.!?]", "", text)
        elif fate == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if fate == 0 else 2 if fate == 3 else 1)
    return out


def faults(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        solid = text.strip("\x20\t\n\x0b\f\r")
        out.append("blank" if not solid else "duplicate" if (role, text) in seen
                   else "truncated" if solid[-1] not in ".!?" else "none")
        seen.add((role, text))
    return out


def cheapest(rows, kinds):
    """(cost, audit, lines): all strings of least cost are kept per state, so no rule of ties is used
    before the end."""
    states = {"": (0, {""})}

    def put(into, state, cost, texts):
        best = into.get(state)
        if best is None or cost < best[0]:
            into[state] = (cost, set(texts))
        elif cost == best[0]:
            best[1].update(texts)

    def with_inserts(states):
        for _ in range(3):
            more = {s: (c, set(t)) for s, (c, t) in states.items()}
            for s, (c, texts) in states.items():
                put(more, "a" if s == "u" else "u", c + 5, {t + "I" for t in texts})
            states = more
        return states

    for (_, _, role, _), kind in zip(rows, kinds):
        after = {}
        for s, (c, texts) in with_inserts(states).items():
            put(after, s, c + 2, {t + "D" for t in texts})
            if kind in ("none", "truncated"):
                more = 5 * (kind == "truncated")
                if (role[:1], s) in AFTER:
                    put(after, AFTER[role[:1], s], c + more, {t + "K" for t in texts})
                for goal in "ua":
                    if (goal, s) in AFTER:
                        put(after, goal, c + more + 1, {t + "R" for t in texts})
        # Enough of them to see ties; two strings of one state never depend on what follows.
        states = {s: (c, set(sorted(t)[:50])) for s, (c, t) in after.items()}
    ends = [(c, t) for s, (c, texts) in with_inserts(states).items() if s in ("", "a") for t in texts]
    cost, audit = min(ends)
    lines, state, queue = [], "", list(rows)
    for edit in audit:
        if edit == "I":
            goal = "a" if state == "u" else "u"
            lines.append(("assistant" if goal == "a" else "user") + ":")
            state = goal
            continue
        _, _, role, text = queue.pop(0)
        if edit == "K":
            lines.append(f"{role}:{text}")
            state = AFTER[role[:1], state]
        elif edit == "R":
            state = "a" if state == "u" else "u"
            lines.append(("assistant" if state == "a" else "user") + ":" + text)
    return cost, audit, lines


def by_hand(conv, rows):
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0))
    kinds = faults(rows)
    turns = {r[1] for r in rows if r[1] is not None}
    cost, audit, lines = cheapest(rows, kinds)
    pairs = [a[2][:1] + b[2][:1] for a, b in zip(rows, rows[1:])]
    return (conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0,
            *[kinds.count(k) for k in ("blank", "duplicate", "truncated")],
            sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
            sha256("\n".join(lines).encode()).hexdigest())


def all_by_hand(rows):
    convs = {r[0]: [] for r in rows}
    for row in damage(rows):
        convs[row[0]].append(row)
    return sorted((by_hand(c, r) for c, r in convs.items()), key=lambda r: (r[0] is None, r[0] or 0))


def found(df):
    assert df.columns == COLUMNS
    return sorted((tuple(r) for r in df.collect()), key=lambda r: (r[0] is None, r[0] or 0))


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/conversations.parquet")
            .select("conv_id", "turn", "role", "text").collect()]
    assert found(queries()["op12_structure_repair"](spark, FOLDER)) == all_by_hand(rows)


def random_rows(seed, convs, most):
    rng = random.Random(seed)
    roles = ["user", "assistant", "system", "tool", "", None, "unknown"]
    texts = ["Yes.", "No!", "cut", "", " \t", None, "Why? ", "a.\nb", "é…", "ok.\r\n"]
    rows = []
    for conv in range(convs):
        turns = [rng.choice([None, *range(-2, 60)]) for _ in range(rng.randint(1, most))]
        used = set()
        for turn in turns:
            if turn not in used:  # equal turns have no order of their own
                used.add(turn)
                rows.append((conv if conv else None, turn, rng.choice(roles),
                             rng.choice(texts) if rng.random() < .5 else f"t{rng.randint(0, 99)}."))
    return rows


SCHEMA = "conv_id long, turn long, role string, text string"


def repaired(df):
    marked = rep.damaged(df)
    return rep.summaries(rep.repaired(marked, marked["gone"]))


def test_messy_conversations(spark):
    rows = random_rows(5, 150, 14)
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA + ", pos string, cost int").repartition(3)
    assert found(repaired(df)) == all_by_hand(rows)
    assert found(repaired(df.limit(0))) == []


def test_long_conversations_over_many_blocks(spark, monkeypatch):
    """Blocks of four rows: conversations fold over dozens of them."""
    monkeypatch.setattr(rep, "BLOCK_BITS", 2)
    rows = random_rows(6, 40, 60)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert found(repaired(df)) == all_by_hand(rows)


def test_repeated_rows(spark):
    """One row a thousand times, without a turn: all but the first are duplicates."""
    rows = [(2, None, "user", "Same.")] * 1000
    [row] = repaired(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()
    assert (row["duplicate"], row["blank"], row["gaps"], row["illegal"]) == (999, 0, 0, 999)
    assert row["cost"] == 2 * 1000 and row["audit"] == "D" * 1000
    assert row["repaired_sha256"] == sha256(b"").hexdigest()


def test_rules_and_symbols_give_equal_matrices():
    rng = random.Random(3)
    rules = ["ua", "ax", chr(0xE000) * 2, chr(0xE002) + "U", "s" + chr(0xE003)]
    grammar = rep.Grammar(rules)

    def plain(text):
        return "".join(plain(rules[ord(c) - 0xE000]) if c >= chr(0xE000) else c for c in text)

    for _ in range(200):
        packed = "".join(rng.choice("suaoSUAOx" + "".join(chr(0xE000 + i) for i in range(5)))
                         for _ in range(rng.randint(0, 9)))
        assert rep.digest_matrix(grammar.of(packed)) == rep.digest_matrix(rep.Grammar([]).of(plain(packed)))


def test_grammar_shrinks_common_sequences(spark):
    seqs = spark.createDataFrame([("suaua" * k,) for k in range(1, 9)] + [("",), ("x",)], "seq string")
    rules, packed = rep.grammar_of(seqs)
    rows = {r["seq"]: r["packed"] for r in packed.collect()}
    assert 0 < len(rules) <= rep.ROUNDS * rep.RULES_A_ROUND and len(rows["suaua" * 8]) <= 8

    def plain(text):
        return "".join(plain(rules[ord(c) - 0xE000]) if c >= chr(0xE000) else c for c in text)

    assert all(plain(p) == s for s, p in rows.items())


@pytest.mark.parametrize("a, b", [("", "K"), ("K", "KD"), ("DI", "ID"), ("K", "K")])
def test_rope_order(a, b):
    assert rep.compare(a, (b[:1], b[1:])) == (a > b) - (a < b)
