"""Exact and near duplicates against brute force, and on messy tables."""

import collections
import re

import pytest

import messy
from __spark_entry__ import queries
from ratingloom.llm import components, coordinate_join, digest_index
from ratingloom.session import scratch_folder

FOLDER = "/root/testdata/sf0.001"


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def rows_by_place(rows):
    return sorted(rows, key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["text_hash"]))


def test_exact_on_messy_rows(spark):
    found = digest_index.exact_duplicates(messy.documents(spark)).collect()
    assert len(found) == len(messy.ROWS)
    groups = collections.defaultdict(list)
    for doc_id, text, _ in messy.ROWS:
        groups[normal(text)].append(doc_id)
    want = collections.Counter()
    for ids in groups.values():
        keep = min((i for i in ids if i is not None), default=None)
        want.update((i, keep, len(ids), i == keep) for i in ids)
    assert collections.Counter((r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in found) == want


def test_kept_rows_hold_each_text_once(spark):
    docs = messy.documents(spark)
    kept = digest_index.keep_rows(docs, digest_index.exact_duplicates(docs))
    assert kept.columns == docs.columns
    texts = [normal(r["text"]) for r in kept.collect()]
    assert sorted(texts) == sorted({normal(t) for _, t, _ in messy.ROWS})


def test_exact_on_no_rows(spark):
    none = messy.nothing(spark)
    assert digest_index.exact_duplicates(none).count() == 0
    assert digest_index.keep_rows(none, digest_index.exact_duplicates(none)).count() == 0


def test_index_outlives_a_batch(spark):
    folder = scratch_folder(spark, "index-test")
    first = digest_index.DigestIndex(spark, folder, 4)
    docs = digest_index.digests_of(messy.documents(spark, [(5, "a  b", "s"), (6, "c", "s")]))
    first.append(docs)
    again = digest_index.DigestIndex(spark, folder, 4)  # as another session would open it
    again.append(docs)  # a batch appended twice adds nothing
    again.append(digest_index.digests_of(messy.documents(spark, [(1, "a b", "s"), (2, "d", "s")])))
    assert sorted(r["keep_id"] for r in again.rows().collect()) == [2, 5, 6]


def test_a_hot_digest_is_not_joined_by_shuffle(spark):
    docs = spark.range(4000).selectExpr("id AS doc_id", "IF(id % 2 = 0, 'same', concat('t', id)) AS text")
    found = digest_index.exact_duplicates(docs)
    rows = {r["doc_id"]: r for r in found.collect()}
    assert rows[10]["keep_id"] == 0 and rows[10]["group_size"] == 2000 and not rows[10]["kept"]
    assert rows[11]["keep_id"] == 11 and len(rows) == 4000
    assert "BroadcastHashJoin" in found._jdf.queryExecution().toString()


def linked(docs, words, percent):
    """Components by comparing all pairs."""
    sets, parent = {}, {}
    for i, text in docs.items():
        found = (text or "").encode().lower().split()
        n = min(words, len(found))
        sets[i] = {tuple(found[j:j + n]) for j in range(len(found) - n + 1)} if found else set()

    def root(i):
        while parent.setdefault(i, i) != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    x, y = sorted((root(a), root(b)))
                    parent[y] = x
    return {i: (len(sets[i]), root(i)) for i in ids}


def test_near_query_equals_all_pairs(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    found = queries()["op10_coordinate_join"](spark, FOLDER).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == linked(docs, 2, 80)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in found)


def test_near_query_finds_every_link_of_a_thousand_documents(spark):
    """All pairs that share a shingle, counted by shingle."""
    folder = "/root/testdata/sf0.01"
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    sets, holders, common, parent = {}, collections.defaultdict(list), collections.Counter(), {}
    for i in sorted(docs):
        words = (docs[i] or "").encode().lower().split()
        n = min(2, len(words))
        sets[i] = {tuple(words[j:j + n]) for j in range(len(words) - n + 1)} if words else set()
        for shingle in sets[i]:
            common.update((other, i) for other in holders[shingle])
            holders[shingle].append(i)

    def root(i):
        while parent.setdefault(i, i) != i:
            i = parent[i]
        return i

    for (a, b), both in common.items():
        if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    found = queries()["op10_coordinate_join"](spark, folder).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == {i: root(i) for i in docs}


def test_unlinked_texts_that_share_most_words(spark):
    """Long lists without any link: members meet once a list, and no class is made."""
    base = messy.prose(50, 200)
    rows = [(i, f"{base} {messy.prose(1000 + i, 60)}", "a") for i in range(150)]
    found = coordinate_join.near_duplicates(messy.documents(spark, rows), words=2, block=16).collect()
    wanted = linked({i: t for i, t, _ in rows}, 2, 80)
    assert {r["doc_id"]: r["component_id"] for r in found} == {i: c for i, (_, c) in wanted.items()}
    assert len({c for _, c in wanted.values()}) == 150


def test_near_on_messy_rows(spark):
    found = coordinate_join.near_duplicates(messy.documents(spark), words=2).collect()
    assert len(found) == len(messy.ROWS)
    by_id = collections.defaultdict(set)
    for r in found:
        by_id[r["doc_id"]].add((r["component_id"], r["kept"]))
    assert by_id[4] == {(1, False)} and by_id[10] == {(9, False)} and by_id[1] == {(1, True)}
    assert by_id[6] == {(6, True)} and by_id[7] == {(7, True)} and by_id[8] == {(8, True)}
    assert by_id[None] == {(1, False), (None, True)} and by_id[15] == {(15, True)}
    assert coordinate_join.near_duplicates(messy.nothing(spark)).count() == 0


def test_near_texts_that_share_an_id(spark):
    """Each of several texts with one id finds its own near copy."""
    texts = [messy.prose(20 + i, 100) for i in range(4)]
    rows = [(15, t, "a") for t in texts] + [(20 + i, messy.changed(t, 50), "a") for i, t in enumerate(texts)]
    found = coordinate_join.near_duplicates(messy.documents(spark, rows), words=2).collect()
    assert sorted((r["doc_id"], r["component_id"], r["kept"]) for r in found) == \
        [(15, 15, True)] * 4 + [(20 + i, 15, False) for i in range(4)]


def chain(n):
    """Texts that are like their neighbours, less and less like the first, and one long list."""
    words = messy.prose(9, 120).split(" ")
    out = {}
    for i in range(n):
        out[i] = " ".join(words[:20] + [w if j >= i else f"y{j}" for j, w in enumerate(words[20:])])
    return out


@pytest.mark.parametrize("short,block", [(2, 8), (32, 1024)])
def test_long_lists_meet_in_blocks(spark, short, block):
    """With short=2 every list takes the path of long lists, in blocks of eight rows."""
    docs = chain(60) | {100 + i: messy.changed(messy.BASE, 9 + i) for i in range(40)}
    rows = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    found = coordinate_join.near_duplicates(rows, words=2, short=short, block=block).collect()
    want = linked(docs, 2, 80)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == want
    assert len({c for _, c in want.values()}) < len(docs)


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(0, 50)] + [(100, i) for i in range(101, 160)] + [(7, 7), (300, 200)]
    found = components.components(spark.createDataFrame(links, "a long, b long")).collect()
    want = {i: 0 for i in range(1, 51)} | {i: 100 for i in range(101, 160)} | {300: 200}
    assert {r["node"]: r["component"] for r in found} == want
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_index_opened_again_with_another_number_of_buckets(spark, tmp_path):
    """The folder's own number holds: nothing that is indexed is taken for new."""
    rows = [(i, f"text number {i}") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    folder, before = str(tmp_path / "index"), len(spark.catalog.listTables())
    assert digest_index.exact_duplicates(docs, folder, buckets=8).where("kept").count() == 200
    later = spark.createDataFrame([(i + 1000, t) for i, t in rows] + [(5000, "new")], "doc_id long, text string")
    found = digest_index.exact_duplicates(later, folder, buckets=4).collect()
    assert len(found) == 201
    assert [r["doc_id"] for r in found if r["kept"]] == [5000]
    assert all(r["keep_id"] == r["doc_id"] - 1000 for r in found if not r["kept"])
    assert len(spark.catalog.listTables()) == before


def test_buckets_follow_the_expected_texts(spark, tmp_path):
    few = digest_index.DigestIndex(spark, str(tmp_path / "a"))
    many = digest_index.DigestIndex(spark, str(tmp_path / "b"), expected=900_000_001)
    assert (few.buckets, many.buckets) == (64, 91)
    few.close()
    many.close()
