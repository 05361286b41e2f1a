"""The whole run on planted files."""

import json

from pyspark.sql import functions as F

from ratingloom.plans import jobs


def write_inputs(folder):
    cities = ["Austin", "Tampa"]
    business = ["\t".join([f"b{i}", f"Place {i}", f"{i} Street", cities[i % 2], "TX" if i % 2 else "FL", f"0{i}033",
                           "30.5", "-97.5", "4", str(10 + i), "1", "-", "Food, Tacos" if i % 3 else "Shoes",
                           "{'Monday': '8:0-17:0'}"]) for i in range(12)]
    texts = ["good food and great tacos", "awful service, bad staff", "the menu is plain", "GREAT drinks!"]
    reviews = []
    for i in range(12):
        for month in range(1, 7):
            for n in range(2):
                stars = 5 if month % 2 else 1 + n
                reviews.append("\t".join([f"r{i}-{month}-{n}", "u", f"b{i}", str(stars), "0", "0", "0",
                                          texts[(i + month + n) % 4], f"2020-0{month}-1{n} 10:00:00"]))
    (folder / "business.tsv").write_text("\n".join(business + ["broken\tline"]))
    (folder / "review.tsv").write_text("\n".join(reviews + [reviews[12], "broken"]))   # one review twice


def test_run_all(spark, tmp_path):
    write_inputs(tmp_path)
    out = tmp_path / "out"
    lexicon = spark.createDataFrame([("good", 1.9), ("great", 3.1), ("awful", -2.0), ("bad", -2.5)],
                                    "word string, valence double")
    jobs.run_all(spark, str(tmp_path / "business.tsv"), str(tmp_path / "review.tsv"), str(out), lexicon,
                 size=8, partitions=2)

    def published(name):
        return spark.read.json(str(out / "published" / name))

    reasons = (spark.read.parquet(str(out / "judged" / "business")).groupBy("reject_reason").count().collect())
    assert {r.reject_reason: r["count"] for r in reasons} == {None: 8, "category": 4, "field_count": 1}
    raw = spark.read.parquet(str(out / "raw"))
    assert raw.count() == 97 and raw.where("postal like '0%'").count() == 97
    assert {r.metric: r.value for r in published("summary_kpis").collect()}["total_reviews"] == "97"
    assert published("business_details").select(F.sum("sum_totalreviews")).first()[0] == 97
    assert published("business_monthly_trends").count() == 48
    assert {"business_ID", "business_name"} <= set(published("business_quarterly_trends").columns)
    report = published("spike_dip_topic_modeling")
    assert report.count() == 40 and report.where("size(topics) = 0").isEmpty()
    summary = published("sentiment_rating_summary").first().asDict()
    assert sum(int(v) for k, v in summary.items() if k.startswith("sentiment")) == 97
    assert published("word_frequencies").count() > 0
    assert published("top5_similar_businesses").count() == 8
    assert published("similar_businesses_enriched").where("city = ''").isEmpty()

    # The same tables published as text lead to the same figures.
    jobs.publish_text(raw, spark.read.parquet(str(out / "aggregated")), str(out / "text"))
    again, aggregated = jobs.stage_text(spark, str(out / "text" / "raw"), str(out / "text" / "aggregated"),
                                        str(tmp_path / "again"), escaped=True)
    assert again.count() == 97 and again.select("row_id").distinct().count() == 97
    assert aggregated.select(F.sum("total")).first()[0] == 97
    assert json.loads(aggregated.orderBy("business_id").toJSON().first())["postal"].startswith("0")

    jobs.sample_text(spark, str(tmp_path / "review.tsv"), str(out / "sample"), 5)
    lines = sorted((tmp_path / "review.tsv").read_text().splitlines())
    assert sorted(r.value for r in spark.read.text(str(out / "sample")).collect()) == lines[:5]


RAW = ("business_id string, name string, address string, city string, state string, postal string, stars double, "
       "review_text string, datetime string, row_id long")


def test_two_addresses_make_one_month(spark, tmp_path):
    rows = [("b", "N", address, "C", "S", "1", stars, "fine food", f"2020-0{month}-05 00:00:00", i)
            for i, (address, month, stars) in enumerate([("A", 1, 5.0), ("B", 1, 1.0), ("A", 2, 3.0)])]
    raw = jobs.with_date_parts(spark.createDataFrame(rows, RAW))
    store = jobs.Store(spark, str(tmp_path))
    jobs.run_trends(store, raw, [], model=False)
    monthly = spark.read.json(store.path("published/business_monthly_trends"))
    assert sorted((r["month"], r["monthly_avg_rating"], r["review_volume"]) for r in monthly.collect()) == [
        (1, 3.0, 2), (2, 3.0, 1)]
    assert not (tmp_path / "published" / "spike_dip_topic_modeling").exists()  # no month is flagged


def test_nothing_is_written_without_usable_reviews(spark, tmp_path):
    raw = jobs.with_date_parts(spark.createDataFrame([(None,) * 10], RAW))
    jobs.run_trends(jobs.Store(spark, str(tmp_path)), raw, [])
    assert not list(tmp_path.iterdir())
