"""Every registered query against its SQL, on both small scales."""

import pytest

import compare
from __spark_entry__ import entry, oracle_sql, queries

FOLDERS = ["/root/testdata/sf0.001", "/root/testdata/sf0.01"]


@pytest.fixture(scope="module", params=FOLDERS)
def folder(request):
    return request.param


@pytest.fixture(scope="module")
def con(folder):
    return compare.connect(folder)


@pytest.mark.parametrize("name", list(oracle_sql()))
def test_matches_sql(spark, con, folder, name):
    columns, rows = compare.spark_rows(queries()[name](spark, folder))
    wanted_columns, wanted = compare.sql_rows(con, oracle_sql()[name])
    assert columns == wanted_columns
    assert rows == wanted


@pytest.mark.parametrize("name", sorted(set(queries()) - set(oracle_sql())))
def test_rows_only(spark, name):
    assert queries()[name](spark, FOLDERS[0]).count() > 0


def test_entry(spark):
    assert entry(spark).count() == 175


@pytest.mark.parametrize("name", ["spikes_dips", "word_frequencies", "similar_topk", "hotspots",
                                  "sample_n", "spike_report", "geo_grid"])
def test_same_rows_with_other_partitions(spark, name):
    seen = []
    for partitions in ("1", "7"):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        try:
            seen.append(compare.spark_rows(queries()[name](spark, FOLDERS[0])))
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert seen[0] == seen[1]
