"""The curriculum's targets, readings and order; URL verdicts; the pipeline."""

import collections
import random
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
import messy
from __spark_entry__ import queries
from ratingloom.llm import curriculum, url_filter

FOLDER = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shared_out(sizes, weights=(5, 2, 1), epochs=3):
    """Targets by sharing the excess again and again."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in capped]
        rest = total - sum(capped.values())
        target = capped | {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        above = [s for s in free if target[s] > epochs * sizes[s]]
        if not above:
            return target
        capped |= {s: epochs * sizes[s] for s in above}


@pytest.mark.parametrize("seed", range(6))
def test_targets(spark, seed):
    draw = random.Random(seed)
    names = [None, "", "Z", "a", "é", "\U00010000", "\uffff", *(f"s{i}" for i in range(draw.randrange(12)))]
    sizes = {n: draw.choice([0, 1, 5, 1000, draw.randrange(5000)]) for n in names}
    rows = [(n, part) for n, size in sizes.items() for part in (size // 2, size - size // 2)]
    found = curriculum.source_targets(spark.createDataFrame(rows, "source string, size long")).collect()
    want = shared_out(sizes)
    assert {r["source"]: r["source_size"] for r in found} == sizes
    for r in found:
        assert r["target"] == pytest.approx(want[r["source"]], abs=1e-6)


def check_plan(docs, rows):
    """docs: (doc_id, text, source) rows."""
    sizes, largest = collections.Counter(), collections.Counter()
    for _, text, source in docs:
        n = len(WORD.findall(text or ""))
        sizes[source] += n
        largest[source] = max(largest[source], n)
    targets = shared_out({s: sizes[s] for _, _, s in docs})
    assert len(rows) == len(docs)
    taken = collections.Counter()
    source_of = collections.defaultdict(set)
    for i, text, source in docs:
        source_of[i, len(WORD.findall(text or ""))].add(source)
    for r in rows:
        assert r["taken"] == r["size"] * len(r["positions"]) and 0 <= r["taken"] <= 3 * r["size"]
        assert r["positions"] == sorted(r["positions"]) and all(0 <= p <= 1 for p in r["positions"])
        (source,) = source_of[r["doc_id"], r["size"]]
        assert r["source_size"] == sizes[source]
        assert r["target"] == pytest.approx(targets[source])
        taken[source] += r["taken"]
    for source, target in targets.items():
        assert abs(target - taken[source]) <= largest[source]
    return taken, targets


def test_mix_query(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet")
            .select("doc_id", "text", "source").collect()]
    rows = queries()["op4_curriculum"](spark, FOLDER).collect()
    taken, targets = check_plan(docs, rows)
    assert abs(sum(taken.values()) - sum(targets.values())) < 0.02 * sum(targets.values())
    again = queries()["op4_curriculum"](spark, FOLDER).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def test_rows_that_differ_in_another_column_are_read_as_themselves(spark):
    """Equal in id and text, not in source's neighbour column: none stands in for another."""
    rows = [(1, "a b c", "s", "first"), (1, "a b c", "s", "second"), (2, "d e", "s", "x"), (2, "d e", "s", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, note string")
    read = curriculum.readings(docs, curriculum.written_plan(docs)).collect()
    assert sorted(map(tuple, read)) == sorted(rows)


def test_only_texts_that_are_read_are_moved(spark):
    """Of a source that is read in part, what lies behind its front is left out; no reading is."""
    rows = [(i, " ".join(["w"] * (1 + i % 9)), "abc"[i % 3]) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    planned = curriculum.written_plan(docs, slice_rows=100)
    from pyspark.sql import functions as F
    kept = curriculum._perhaps_read(docs.select(
        F.col("source").alias("_source"), F.col("doc_id").alias("_doc"), curriculum.row_hash().alias("_text")), planned)
    ids = {r["_doc"] for r in kept.collect()}
    read = {r["doc_id"] for r in planned.where("passes > 0").collect()}
    assert read <= ids and len(ids) < len(rows) and len(ids - read) < 0.1 * len(rows)
    found = curriculum.readings(docs, planned).groupBy("doc_id").count().collect()
    assert {r["doc_id"]: r["count"] for r in found} == {
        r["doc_id"]: r["passes"] for r in planned.where("passes > 0").collect()}


def test_mix_on_messy_rows(spark):
    docs = messy.documents(spark)
    planned = curriculum.plan(docs, slice_rows=2)
    rows = planned.collect()
    check_plan(messy.ROWS, rows)
    read = curriculum.readings(docs, planned)
    assert read.columns == docs.columns
    times = collections.Counter()
    for r in rows:
        times[r["doc_id"], r["text_hash"]] += len(r["positions"])
    hashed = read.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).collect()
    assert collections.Counter((r["doc_id"], r["h"]) for r in hashed) == +times
    none = messy.nothing(spark)
    assert curriculum.plan(none).count() == 0 and curriculum.readings(none, curriculum.plan(none)).count() == 0


@pytest.mark.parametrize("share,long", [(0.3, 300_000), (0.6, 300_000), (0.9, 300_000), (0.6, 400)])
def test_the_remainder_is_filled_from_all_unread_documents(spark, share, long):
    """A source misses by at most half of its smallest unread document, wherever a long one stands."""
    draw = random.Random(long)
    sizes = [draw.randrange(50, 400) for _ in range(1000)] + [long]
    docs = spark.createDataFrame(list(enumerate(sizes)), "doc_id long, n int").selectExpr(
        "doc_id", "trim(repeat('w ', n)) AS text", "'a' AS source")
    other = sum(sizes) + 2 * round(share * sum(sizes))  # so that with equal weights the remainder is the share
    docs = docs.union(spark.createDataFrame([(-1, "v " * other, "b")], docs.schema))
    rows = [r for r in curriculum.plan(docs, (1, 1), slice_rows=100).collect() if r["doc_id"] >= 0]
    whole, target = min(r["passes"] for r in rows), rows[0]["target"]
    smallest = min(r["size"] for r in rows if r["passes"] == whole)
    assert abs(target - sum(r["taken"] for r in rows)) <= smallest / 2
    # Readings follow each other without gaps: a document's last reading is no heap at the end.
    assert sum(p >= 0.999 for r in rows for p in r["positions"]) <= 10


def test_readings_stand_in_training_order(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    planned = curriculum.plan(docs)
    first = {(r["doc_id"]): r["positions"] for r in planned.collect()}
    left = {i: list(p) for i, p in first.items()}
    last = 0.0
    for r in curriculum.readings(docs, planned).select("doc_id").collect():
        position = left[r["doc_id"]].pop(0)
        assert position >= last
        last = position
    assert not any(left.values())


def test_mix_query_writes_its_readings(spark, monkeypatch):
    """The query's rows come from readings that it wrote in training order."""
    from ratingloom.llm import queries as registered

    kept, write = {}, registered.written
    monkeypatch.setattr(registered, "written", lambda df, label, *how:
                        kept.setdefault(label, write(df, label, *how)))
    rows = queries()["op4_curriculum"](spark, FOLDER).collect()
    read = kept["mix-readings"].select("_position", "_row.doc_id", "_row.text").collect()
    assert collections.Counter((r["doc_id"], r["_position"]) for r in read) == \
        collections.Counter((r["doc_id"], p) for r in rows for p in r["positions"])


def test_positions_invert_the_integrated_schedule(spark):
    """The share read by a position, by summing the schedule in small steps."""
    for knots in (*curriculum.SCHEDULES, ((0.0, 0.0), (0.3, 2.0), (1.0, 0.2))):
        column = curriculum.inverse_demand(F.col("id") / 20, knots)
        for r in spark.range(21).select("id", column.alias("u")).collect():
            steps, area, upto = 20_000, 0.0, 0.0
            for k in range(steps):
                t = (k + 0.5) / steps
                (t0, a), (t1, b) = next(p for p in zip(knots, knots[1:]) if t <= p[1][0])
                w = a + (b - a) * (t - t0) / (t1 - t0)
                area += w
                upto += w if t < r["u"] else 0
            assert upto / area == pytest.approx(r["id"] / 20, abs=2e-3)


URLS = [None, "", "no scheme.com/x", "http://A.Com", "HTTPS://EXAMPLE.com:8080/EN/", "a://b://c/d", "http://com/x",
        "http://notcom/", "http://xcom/", "http://example.com/en", "http://example.com/en/", "http://x.example.com/en/1?q",
        "http://www.example.com/en/#a", "http://y.www.example.com/en/", "http://z.net/es/", "http://net/fr/?a/b",
        "http://z.net?/es/", "http://É.com/", "http:///path/only", "http://h#f/com", "x\n://a.net/es/\nq", "://"]


def verdict_of(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fit = [(h + p, v) for h, p, v in url_filter.RULES
           if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *max(fit, key=lambda x: len(x[0]), default=(None, None)))


@pytest.fixture(scope="module")
def model(spark):
    return url_filter.fit(url_filter.labelled_urls(spark))


def test_rules_on_odd_urls(spark, model):
    pages = spark.createDataFrame([(i, u, "x", "x") for i, u in enumerate(URLS)] + [(None, URLS[3], "x", "x")] * 2,
                                  "page_id long, url string, label string, host string")
    found = url_filter.judge(pages, model).collect()
    assert len(found) == len(URLS) + 2
    for r in found:
        host, path, rule, verdict = verdict_of(URLS[r["page_id"] if r["page_id"] is not None else 3])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == (verdict or r["by_model"]) and r["by_model"] in ("allow", "block")
    assert url_filter.judge(pages.limit(0), model).count() == 0


def test_url_query(spark):
    urls = {r["page_id"]: r["url"] for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect()}
    found = queries()["op6_url_filter"](spark, FOLDER)
    for r in found.collect():
        host, path, rule, verdict = verdict_of(urls.pop(r["page_id"]))
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule) and r["verdict"] == (verdict or r["by_model"])
    assert not urls
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "html" not in plan and "Python" not in plan


def test_held_out_urls(spark, model):
    bad = [f"http://{a}-{b}.{c}.invalid/{d}" for a in ("casino", "cheap", "spam") for b in ("win", "pills", "farm")
           for c in ("blog", "shop") for d in ("en/1", "fr/22.html")]
    good = [f"https://{a}.{b}.invalid/{c}" for a in ("www", "m", "blog") for b in ("theron", "anshe", "library", "ingle")
            for c in ("en/148.html", "de/770#top", "history/books")]
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(bad + good)], "page_id long, url string")
    right = [(r["by_model"] == "block") == (r["page_id"] < len(bad)) for r in url_filter.judge(pages, model).collect()]
    assert sum(right) >= 0.95 * len(right)


def test_training_sample_is_bounded(spark):
    few = url_filter.fit(url_filter.labelled_urls(spark), max_labelled=4)
    assert few.stages[1].numFeatures == url_filter.BUCKETS


def test_pipeline_stages(spark):
    """Each stage on what the last one kept."""
    from ratingloom.llm.shared import table, written

    docs = table(spark, FOLDER, "documents")
    columns, rows = docs.columns, {r["doc_id"]: r for r in docs.collect()}
    kept = written(corpus_pipeline.quality(spark, docs, FOLDER), "stage")
    judged = {r["doc_id"]: r["kept"] for r in queries()["op3_target_ratio"](spark, FOLDER).collect()}
    assert kept.columns == columns
    assert {r["doc_id"]: r for r in kept.collect()} == {i: r for i, r in rows.items() if judged[i]}

    distinct = written(corpus_pipeline.exact(spark, kept, FOLDER), "stage")
    first = {}
    for i in sorted(i for i in rows if judged[i]):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", rows[i]["text"] or ""), i)
    assert distinct.columns == columns
    assert sorted(r["doc_id"] for r in distinct.collect()) == sorted(first.values())

    from test_dedup import linked
    single = written(corpus_pipeline.near(spark, distinct, FOLDER), "stage")
    classes = linked({i: rows[i]["text"] for i in first.values()}, 5, 80)
    assert single.columns == columns
    assert sorted(r["doc_id"] for r in single.collect()) == sorted({c for _, c in classes.values()})

    mixed = written(corpus_pipeline.mix(spark, single, FOLDER), "stage")
    planned = curriculum.plan(single).collect()
    assert mixed.columns == columns
    assert collections.Counter(r["doc_id"] for r in mixed.collect()) == \
        +collections.Counter({r["doc_id"]: len(r["positions"]) for r in planned})

    pieces = corpus_pipeline.packed(spark, mixed, FOLDER).collect()
    assert collections.Counter(r["doc_id"] for r in pieces if r["piece"] == 0) == \
        collections.Counter(r["doc_id"] for r in mixed.collect())
    whole = corpus_pipeline.run(spark, FOLDER).collect()
    assert collections.Counter(r["doc_id"] for r in whole if r["piece"] == 0) == \
        collections.Counter(r["doc_id"] for r in mixed.collect())


def test_pipeline_of_no_rows_and_messy_rows(spark):
    for docs in (messy.nothing(spark), messy.documents(spark)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, FOLDER)
            assert out.columns == docs.columns, name
            out.collect()
        corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).collect()
