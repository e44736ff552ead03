"""Empty tables, zero denominators and dirty values have defined results."""

import pytest
from pyspark.sql import functions as F

from presslens.operators import aggregates, agreement, cleaning, joins, stats
from presslens.sources import vector_table


def test_shares_of_nothing_are_null(spark):
    df = spark.createDataFrame([("a", True), ("b", True)], "k string, x boolean")
    got = aggregates.compare_shares(df, "k", {"all": F.col("x"), "none": ~F.col("x")}).collect()
    assert {(r.k, r.percentage_all, r.percentage_none) for r in got} == {("a", 50.0, None), ("b", 50.0, None)}
    assert aggregates.share_of_total(spark.createDataFrame([], "k string, n long"), "n").collect() == []


def test_ratios_without_a_whole_are_null(spark):
    whole = spark.createDataFrame([("a", 0), ("b", 4)], "k string, w long")
    part = spark.createDataFrame([("b", 1)], "k string, p long")
    got = {r.k: r.ratio for r in joins.ratio_by_key(part, whole, "k", "p", "w").collect()}
    assert got == {"a": None, "b": 0.25}
    events = spark.createDataFrame([("g", 3, None)], "g string, n long, e string")
    assert aggregates.avg_per_event(events, "g", "n", "e").first().articles_per_event is None


def test_statistics_of_degenerate_samples(spark):
    empty = spark.createDataFrame([], "k string, o double, e double, n long")
    assert stats.z_test_shares(empty, "o", "e", "n").collect() == []
    assert stats.chi_square_gof(empty, "n", "e").first().statistic is None
    assert stats.complement_shares(empty, "n", "n").collect() == []
    rows = spark.createDataFrame([(3, 0.0), (1, 1.0)], "n long, e double")
    got = stats.chi_square_gof(rows, "n", "e").first()
    assert (got.statistic, got.p_value) == (float("inf"), 0.0)
    rows = spark.createDataFrame([(0, 0.0), (4, 1.0)], "n long, e double")
    assert stats.chi_square_gof(rows, "n", "e").first().statistic == 0.0


@pytest.mark.parametrize(
    ("points", "p"), [([(1, 2), (2, 4), (3, 6)], 0.0), ([(1, 2), (2, 5)], None), ([(1, 2), (1, 5), (1, 6)], None)]
)
def test_regression_of_few_or_constant_points(spark, points, p):
    df = spark.createDataFrame(points, "x int, y int")
    assert stats.correlate_regress(df, "x", "y").first().p_value == p
    band = stats.regression_band(df, "x", "y", [1.0]).first()
    assert (band.low is None) == (p is None)


def test_density_of_a_constant_sample_is_null(spark):
    df = spark.createDataFrame([(2.0,), (2.0,)], "x double")
    assert [r.density for r in stats.kde(df, "x", [1.0, 2.0]).collect()] == [None, None]


def test_kappa_without_ratings_is_null(spark):
    table = spark.createDataFrame([], "yes long, no long")
    assert agreement.fleiss_kappa(table, ["yes", "no"]).first().kappa is None


def test_dirty_cells(spark):
    df = spark.createDataFrame([("12345678901234567890",), ("7",), ("x",)], "t string")
    assert {r.t for r in cleaning.digits_only_rows(df, ["t"]).collect()} == {None, 7}
    df = spark.createDataFrame([("-1",), ("x",), (None,)], "t string")
    assert {r.t for r in cleaning.sentinel_to_null(df, "t").collect()} == {None, "x"}


def test_names_that_normalise_to_nothing_stay_and_match_nothing(spark):
    left = spark.createDataFrame([(1, "A. B"), (2, "..."), (3, None), (4, "")], "id int, name string")
    right = spark.createDataFrame([("a b", 9), ("", 8), (None, 7)], "company string, size int")
    got = joins.left_join_normalised(left, right, "name", "company").collect()
    assert {(r.id, r["size"]) for r in got} == {(1, 9), (2, None), (3, None), (4, None)}
    got = joins.left_join_normalised(left, right, "name", "company", match_empty=True).collect()
    assert {(r.id, r["size"]) for r in got} == {(1, 9)} | {(i, s) for i in (2, 3, 4) for s in (7, 8)}


def test_equal_versions_have_a_fixed_winner(spark, tmp_path):
    rows = spark.createDataFrame([(1, "b"), (1, "a")], "id long, document string")
    vector_table.upsert(rows, str(tmp_path / "t"), 1)
    assert vector_table.scan(spark, str(tmp_path / "t")).first().document == "a"
