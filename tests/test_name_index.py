"""Name search by trigrams, and sketches that can be added up."""

import pytest
from pyspark.sql import functions as F

from ratingloom.operators import sketches
from ratingloom.operators.name_index import NameIndex

NAMES = ["Taco House", "taco taco", "The House of Tacos", "Café Zürich", "a", "", None, "ab", "House", "house %_ 'x'",
         *[f"Common name {i}" for i in range(200)]]


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    names = spark.createDataFrame([(i, n, "x") for i, n in enumerate(NAMES)], "id int, title string, other string")
    return NameIndex(spark, str(tmp_path_factory.mktemp("names")), "id", "title").build(names.repartition(3))


@pytest.mark.parametrize("needle", ["taco", "HOUSE", "o", "", "ab", "zür", "common name 19", "mon", "nowhere at all", "%_ '", "aco ta"])
def test_search(index, needle):
    found = index.search(needle)
    assert found.columns == ["id", "title", "other"]
    assert sorted(r["id"] for r in found.collect()) == [
        i for i, n in enumerate(NAMES) if n is not None and needle.lower() in n.lower()]


def test_rare_trigrams_are_looked_up(index):
    assert index.rarest("o") is None
    assert index.rarest("common") == ["com"]  # all are common: one is enough
    picked = index.rarest("common name 199")
    assert "199" in picked and not {"com", "omm", "mmo"} & set(picked)
    plan = index.read("postings").where(F.col("trigram").isin(picked))._jdf.queryExecution().executedPlan().toString()
    assert "(trigram,199)" in plan[plan.index("PushedFilters"):]


def test_sketches_of_batches_add_up(spark):
    rows = spark.range(30_000).select((F.col("id") % 3).alias("state"), (F.col("id") % 7).alias("city"),
                                      (F.col("id") % 5000).alias("who"), "id")
    first, second = (sketches.sketched(rows.where(f"id % 2 = {i}"), ["state", "city"], "who") for i in (0, 1))
    found = sketches.estimated(sketches.rolled_up(first.unionByName(second), ["state"])).join(
        rows.groupBy("state").agg(F.count_distinct("who").alias("exact")), "state")
    assert found.count() == 3 and found.where(~sketches.is_right("estimate", "exact")).isEmpty()
    whole = sketches.estimated(sketches.rolled_up(first.unionByName(second), [])).first()["estimate"]
    assert abs(whole - 5000) <= 5000 * sketches.ERRORS * sketches.ERROR
    nulls = spark.createDataFrame([(1, None)], "state int, who int")
    assert sketches.sketched(nulls, ["state"], "who").count() == 0
