"""Phrase mining against dictionaries of all phrases."""

import re
from collections import Counter, defaultdict

import pytest

import compare
import messy
from __spark_entry__ import oracle_sql, queries
from ratingloom.llm import setm

COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def by_hand(rows, least, longest=4, top=2000):
    """rows: (lang, text)."""
    counts, total = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOWER)):
            words = re.findall("[^ \t]+", piece)
            total[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    counts[lang][tuple(words[i:i + k])] += 1
    out = []
    for lang, found in counts.items():
        f = {p: a for p, a in found.items() if a >= least}
        kept = []
        for p, a in f.items():
            if len(p) < 2:
                continue
            score, k = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            if not any(100 * b >= 80 * a and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))
                       for q, b in f.items() if len(q) > len(p)):
                kept.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, total[lang], -score))
    return sorted(out)


def found(df):
    assert df.columns == COLUMNS
    return sorted(map(tuple, df.collect()))


TEXTS = [
    ("en", "A b c d. a B c d, a b c\td a b\x0bc d"), ("en", "a b c d"), ("en", None), (None, "x y x y x y"),
    ("und", "x y\nx y x  y"), ("", "é è é è É è"), ("en", "a a a a a a a a"), ("fr", "..,;:!?\n\n"), ("fr", ""),
    ("en", "w\x1cv w\x1cv\xa0u"), ("en", "long " * 3000), ("fr", "ß ßß ß ßß; ß ßß. ſ ſ ſ ſ"), ("en", "a b c d"),
]


@pytest.mark.parametrize("chunk_words, sent_bytes", [(1, 0), (1, 1 << 20), (7, 0), (1000, 1 << 20)])
def test_small_texts_in_chunks_of_any_size(spark, chunk_words, sent_bytes):
    """Frequent groups go to all tasks, or to the chunks that have them."""
    docs = spark.createDataFrame([(*t, 1, "x") for t in TEXTS], "lang string, text string, n int, phrase string")
    rows = found(setm.collocations(docs.repartition(3), least=2, chunk_words=chunk_words, sent_bytes=sent_bytes))
    assert rows == by_hand(TEXTS, 2) and len(rows) > 8
    assert found(setm.collocations(docs.limit(0))) == []


def test_many_languages_in_one_task(spark):
    texts = [(f"l{i % 40}", f"a b c{i % 3} a b") for i in range(400)]
    docs = spark.createDataFrame(texts, "lang string, text string").coalesce(1)
    assert found(setm.collocations(docs, least=3, chunk_words=10)) == by_hand(texts, 3)


def test_messy_documents(spark):
    rows = [(r["lang"], r["text"]) for r in messy.documents(spark).select("lang", "text").collect()]
    assert found(setm.collocations(messy.documents(spark), least=2, top=50)) == by_hand(rows, 2, top=50)


def test_score_needs_more_than_64_bits(spark):
    counts = spark.createDataFrame([("en", "a", 1, 9 * 10**18), ("en", "b", 1, 8 * 10**18),
                                    ("en", "a b", 2, 7 * 10**18)], "lang string, phrase string, length int, a long")
    [row] = setm.scored(counts).collect()
    assert row["score"] == 2_000_000 * 7 * 10**18 // (17 * 10**18)
    assert setm.uncovered(setm.scored(counts), counts).count() == 1


def test_query_against_sql(spark):
    folder = "/root/testdata/sf0.01"
    wanted = compare.sql_rows(compare.connect(folder), oracle_sql()["op13_setm"])
    assert compare.spark_rows(queries()["op13_setm"](spark, folder)) == wanted
    docs = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("lang", "text").collect()]
    assert sorted(map(tuple, queries()["op13_setm"](spark, folder).collect())) == by_hand(docs, 30)
