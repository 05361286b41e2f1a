"""Planted rows for cleaning and joining."""

import pytest

from ratingloom.operators import cleaning, joins
from ratingloom.sources import readers, schemas, writers

GOOD = ["b1", "Bar", "1 Street", "Town", "TX", "08033", "30.5", "-97.5", "4.0", "12", "1", "x",
        "Seafood, Bar", "{'Monday': '8:0-17:0'}"]


def line(**changes):
    fields = list(GOOD)
    for position, value in changes.items():
        fields[int(position[1:])] = value
    return "\t".join(fields)


BUSINESS = [
    (line(), None),
    (line() + "\textra", None),
    (line() + "\t\t", None),
    ("\t".join(GOOD[:13]), "field_count"),
    ("\t".join(GOOD[:13]) + "\t\t\t", "field_count"),
    (line(f12="Shoes"), "category"),
    (line(f12="FOOD"), None),
    (line(f3=""), "missing_field"),
    (line(f3="  "), "blank_field"),
    (line(f0=" "), "blank_field"),
    (line(f6="x"), "bad_number"),
    (line(f6="NaN"), "bad_number"),
    (line(f7="Infinity"), "bad_number"),
    (line(f9="1.0"), "bad_number"),
    (line(f9=" 7"), "bad_number"),
    (line(f9="007"), None),
    (line(f9="99999999999"), "bad_number"),
    ("", "field_count"),
]
REVIEW = ["r1", "u", "b1", "4", "0", "0", "0", "nice", "2020-01-02 03:04:05"]


def review(**changes):
    fields = list(REVIEW)
    for position, value in changes.items():
        fields[int(position[1:])] = value
    return "\t".join(fields)


REVIEWS = [
    (review(), None),
    (review(f3="5.1"), "stars_range"),
    (review(f3="0.9"), "stars_range"),
    (review(f3="1"), None),
    (review(f3="5"), None),
    (review(f3="NaN"), "stars_range"),
    (review(f3="abc"), "bad_number"),
    (review(f3=""), "bad_number"),
    (review(f7=" "), "blank_text"),
    (review(f2=" "), "blank_field"),
    (review(f8=""), "field_count"),
    (review() + "\textra", "field_count"),
    (review() + "\t", None),
]


@pytest.mark.parametrize("judge, cases", [(cleaning.judge_business, BUSINESS),
                                          (cleaning.judge_review, REVIEWS)])
def test_reject_reasons(spark, judge, cases):
    lines = spark.createDataFrame([(text,) for text, _ in cases], "value string")
    got = judge(lines).select("value", "reject_reason").collect()
    assert sorted(got, key=str) == sorted(cases, key=str)


def test_kept_and_rejected_make_the_input(spark):
    lines = spark.createDataFrame([(text,) for text, _ in BUSINESS], "value string")
    kept, rejected = cleaning.clean_business(lines)
    assert kept.count() + rejected.count() == len(BUSINESS)
    row = kept.where("business_id = 'b1'").first()
    assert row.postal == "08033" and row.lat == 30.5 and row.review_count == 12


def test_trailing_columns_keep_quotes_and_zeros(spark, tmp_path):
    rows = [("b", "N", "A", "C", "S", "08033", 1.5, -2.5, "food", "{'Monday': '1:0-2:0'}", 4.0,
             '"open quote', "2020-01-02 03:04:05"),
            ("c", "N", "A", "C", "S", "T5A 0A1", 1.5, -2.5, "food", "None", 3.0, 'a "b" c\\d',
             "2020-01-02 03:04:05")]
    from ratingloom.sources import schemas
    table = spark.createDataFrame(rows, schemas.RAW)
    writers.write_tsv(table, str(tmp_path / "t"))
    assert sorted(readers.read_raw(spark, str(tmp_path / "t"), escaped=True).collect()) == sorted(table.collect())


PLACES = "business_id string, name string, city string, review_count int"


def test_one_per_key(spark):
    df = spark.createDataFrame([("b", "Old", "Z", 3), ("b", "New", "A", 9), ("c", None, "Y", 1)], PLACES)
    got = joins.one_per_key(df, "business_id", ["review_count"]).collect()
    assert sorted(map(tuple, got)) == [("b", "New", "A", 9), ("c", None, "Y", 1)]


def test_joined_tables_agree(spark):
    business = spark.createDataFrame([("b", "B", "X", 1), ("c", "C", "X", 1)], PLACES)
    reviews = spark.createDataFrame(
        [("b", 4.5), ("b", 4.4), ("b", 1.0), ("gone", 5.0)], "business_id string, stars double")
    raw = joins.join_raw(business, reviews)
    assert raw.count() == 3 and raw.columns == ["business_id", "name", "city", "stars"]
    rows = {r.business_id: r.asDict() for r in joins.join_aggregated(business, reviews).collect()}
    assert rows["b"]["total"] == 3 and rows["b"]["star5"] == 1 and rows["b"]["star4"] == 1
    assert rows["c"]["total"] == 0 and set(rows) == {"b", "c"}


def test_plain_text_tables_are_read_as_they_are(spark, tmp_path):
    (tmp_path / "t").write_bytes(b"b1\tC:\\new\\temp\t5\r\nb2\t\\N\t6\nb3\t\"q\t\r\n\r\nb4")
    schema = schemas.struct("id:s text:s n:i")
    rows = [tuple(r) for r in readers.read_tsv(spark, str(tmp_path / "t"), schema, escaped=False).collect()]
    assert rows == [("b1", "C:\\new\\temp", 5), ("b2", "\\N", 6), ("b3", '"q', None), ("", None, None), ("b4", None, None)]


def test_json_lines_are_judged(spark, tmp_path):
    (tmp_path / "a").write_text('{"k": 1, "t": "x"}\n\n{"k": "y"}\n{"k": 2\n[1]\n7\n"s"\nnull\n{}\n{"t": null, "z": [1]}\n')
    (tmp_path / "b").write_text("broken\n")
    judged = readers.judge_json_lines(spark, str(tmp_path), schemas.struct("k:i t:s"))
    rows = {(r["value"], r["reject_reason"]) for r in judged.collect() if r["reject_reason"]}
    assert rows == {('{"k": "y"}', "bad_field"), ('{"k": 2', "not_json"), ("[1]", "no_object"), ("7", "no_object"),
                    ('"s"', "no_object"), ("null", "no_object"), ("broken", "not_json")}
    assert {(r["k"], r["t"]) for r in judged.where("reject_reason IS NULL").collect()} == {(1, "x"), (None, None)}
    counts = {(r["file"].rsplit("/", 1)[1], r["reject_reason"]): r["lines"] for r in readers.json_rejects(judged).collect()}
    assert counts["b", "not_json"] == 1 and counts["a", "no_object"] == 4
