"""Small tables with everything an operator must put up with."""

WORDS = "the of and ther tion anre erin othe wher and tioned ising onal".split()


def prose(seed, n):
    """n words, each a function of its place and the seed."""
    out, state = [], seed * 2654435761 % 2**32
    for _ in range(n):
        state = (state * 1664525 + 1013904223) % 2**32
        out.append(WORDS[state >> 28 if state >> 28 < len(WORDS) else 0] + f"{state >> 8 & 4095:x}")
    return " ".join(out)


def changed(text, every):
    words = text.split(" ")
    for i in range(0, len(words), every):
        words[i] = f"x{i}"
    return " ".join(words)


BASE = prose(1, 200)
ROWS = [
    (1, BASE, "a"), (2, BASE, "a"), (3, BASE.replace(" ", "\n\t", 5), "b"), (4, changed(BASE, 50), "b"),
    (5, prose(2, 80), None), (6, "", "a"), (7, None, "a"), (8, " \t\n ", None), (9, "one", "c"),
    (10, "ONE", "c"), (11, "two words", "c"), (12, prose(3, 6000), "a"), (13, "x" * 30_000, "b"),
    (14, "é" * 60 + " ß  z  password = 'abcDEF123' AKIA" + "Q7" * 10, "d"),
    (None, BASE, "a"), (None, prose(4, 60), "e"), (None, prose(4, 60), "e"), (15, prose(5, 70), "a"),
    (15, prose(5, 70), "a"), (15, prose(6, 70), "a"), (16, "<|endoftext|> <s> a</s>▁ b  ▁c\r\n\n d ", "d"),
]
# Columns named like the operators' own.
EXTRA = ("kept keep_id digest text_hash group_size size target taken positions n_words score key node row "
         "component_id n_tokens n_bytes piece start length sequence_id offset order slice n pieces "
         "spans lang n_chars").split()
SCHEMA = "doc_id long, text string, source string, " + ", ".join(f"{c} string" for c in EXTRA)


def documents(spark, rows=ROWS):
    return spark.createDataFrame([(*r, *EXTRA) for r in rows], SCHEMA).repartition(3)


def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
