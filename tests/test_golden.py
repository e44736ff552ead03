"""Hand-made cases with known results."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from presslens.functions import categories, tails, text as X
from presslens.operators import agreement, aggregates, bins, classifier, cleaning, dedup, joins
from presslens.operators import labelling
from presslens.operators import ranking, stats, synthetic


def rows(df, *columns):
    return sorted(tuple(r[c] for c in (columns or df.columns)) for r in df.collect())


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_prefix_join_of_three_mentions(spark):
    mentions = spark.createDataFrame([("Tech",), ("Data",), ("Smart",)], "mention string")
    names = spark.createDataFrame(
        [("Tech Corp",), ("Data Systems",), ("AI Smart Co",), ("Random Name",)], "name string"
    )
    joined = joins.join_name_prefix(mentions, names, "mention", "name")
    assert rows(joined, "mention", "name") == [("Data", "Data Systems"), ("Tech", "Tech Corp")]


def test_chi_square_of_seven_cells(spark):
    data = list(zip([8, 6, 10, 7, 8, 11, 9], [9, 8, 11, 8, 10, 7, 6]))
    fit = stats.chi_square_gof(spark.createDataFrame(data, "o long, e long"), "o", "e").first()
    assert math.isclose(fit.statistic, 5.0127344877, rel_tol=1e-9)
    assert fit.df == 6
    assert math.isclose(fit.p_value, 0.5421808614, rel_tol=1e-8)


def test_chi_square_of_unequal_totals_raises(spark):
    data = spark.createDataFrame([(8, 9), (6, 9)], "o long, e long")
    with pytest.raises(Exception, match="totals differ"):
        stats.chi_square_gof(data, "o", "e", rescale=False, with_p=False).collect()


def test_z_score_of_published_shares(spark):
    """Standard error and z of a category follow from N = 12680 and its two shares."""
    expected, z, n = 20.0, 10.50538, 12680
    se = math.sqrt(0.2 * 0.8 / n)
    observed = expected + 100 * z * se
    data = [("internet", observed, expected, n - 10), ("rest", 100 - observed, 100 - expected, 10)]
    df = spark.createDataFrame(data, "k string, o double, e double, c long")
    tested = {r.k: r for r in stats.z_test_shares(df, "o", "e", "c").collect()}
    assert math.isclose(tested["internet"].standard_error, 0.0035522, rel_tol=1e-4)
    assert math.isclose(tested["internet"].z_score, z, rel_tol=1e-9)
    assert tested["internet"].significant


def test_tail_probabilities():
    assert math.isclose(tails.normal_two_sided(-1.11026), 0.26689, abs_tol=1e-5)
    assert tails.normal_two_sided(10.50538) < 1e-15
    assert math.isclose(tails.chi_square_upper(3.841458820694124, 1), 0.05, rel_tol=1e-9)
    assert math.isclose(tails.student_two_sided(2.2281388519649385, 10), 0.05, rel_tol=1e-9)
    assert math.isclose(tails.student_two_sided(0.0, 10), 1.0)


def test_names_numbers_and_dates(spark):
    lit = F.lit
    assert one(spark, X.normalise_name(lit("AT&T Inc."))) == "att inc"
    assert one(spark, X.normalise_name(lit("Café"))) == "café"
    assert one(spark, X.normalise_name(lit(None).cast("string"))) == ""
    assert one(spark, X.parse_grouped_number(lit("1,234,567"))) == 1234567
    assert one(spark, X.parse_grouped_number(lit("unknown"))) is None
    assert one(spark, X.parse_month_year(lit("Aug 2014"))) == dt.date(2014, 8, 1)
    assert one(spark, X.parse_yyyymmdd(lit(20210405))) == dt.date(2021, 4, 5)
    assert one(spark, X.percent_text(lit(0.125))) == "12.5%"


@pytest.mark.parametrize(
    "mode, expected",
    [
        ("lenient", {"True": True, "yes": True, "1": True, "False": False, "no": False,
                     "0": False, None: False, "AT&T": True, "": False}),
        ("strict", {"True": True, "AT&T": False, "none": False, None: False}),
        ("presence", {"AT&T": True, "": False, "nan": False, "False": False, "0": False, "no": True}),
    ],
)
def test_label_texts_as_booleans(spark, mode, expected):
    df = spark.createDataFrame([(k,) for k in expected], "label string")
    got = {r.label: r.b for r in df.select("label", X.to_bool(F.col("label"), mode).alias("b")).collect()}
    assert got == expected


def test_employee_bins_are_half_open(spark):
    df = spark.createDataFrame([(499,), (500,), (200000,), (0,)], "n long")
    label = bins.bin_edges(F.col("n"), bins.EMPLOYEE_EDGES, bins.EMPLOYEE_LABELS)
    got = {r.n: r.b for r in df.select("n", label.alias("b")).collect()}
    assert got == {499: "1-500", 500: "501-5000", 200000: "200000+", 0: None}


def test_first_key_wins_in_replies(spark):
    reply = "BreachMentioned : True\nCompanyMentioned : A: B\nBreachMentioned : False\nfoo : x"
    df = spark.createDataFrame([(reply,)], "reply string")
    parsed = labelling.parse_response(df, "reply", ["BreachMentioned", "CompanyMentioned"]).first()
    assert (parsed.BreachMentioned, parsed.CompanyMentioned) == ("True", "A: B")


def test_reply_repair(spark):
    df = spark.createDataFrame([("True\nCompanyMentioned : X",), ("Sure: BreachMentioned : no",)], "r string")
    got = labelling.parse_response(df, "r", ["BreachMentioned"], repair_prefix="BreachMentioned")
    assert [r.BreachMentioned for r in got.collect()] == ["True", "no"]


def test_labels_match_their_patterns(spark):
    df = spark.createDataFrame([("True", "Koss"), ("maybe", "Koss"), ("False", "X")],
                               "BreachMentioned string, CompanyMentioned string")
    checked = labelling.validate_labels(df, labelling.LABEL_PATTERNS)
    assert [r.valid for r in checked.collect()] == [True, False, False]


def test_members_of_duplicate_groups(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("a", 3)], "name string, id long")
    assert rows(dedup.members_of_duplicate_groups(df, ["name"]), "name", "id") == [("a", 1), ("a", 3)]


def test_ten_rows_on_three_shards(spark):
    shards = ranking.assign_shards(spark.range(10), ["id"], 3)
    assert rows(shards.groupBy("shard").count()) == [(0, 3), (1, 3), (2, 4)]
    ordered = [r.shard for r in shards.orderBy("id").collect()]
    assert ordered == sorted(ordered)


def test_digit_rows(spark):
    df = spark.createDataFrame([("2014", "10"), ("2014-15", "1"), ("2016", "unknown")], "y string, r string")
    assert rows(cleaning.digits_only_rows(df, ["y", "r"])) == [(2014, 10)]


def test_nulls_survive_exclusion_only_if_wanted(spark):
    df = spark.createDataFrame([("False",), (None,), ("x",)], "v string")
    assert cleaning.exclude_values(df, "v", ["False"]).count() == 2
    assert cleaning.exclude_values(df, "v", ["False"], keep_null=False).count() == 1


def test_unfilled_sizes_are_dropped(spark):
    df = spark.createDataFrame([("a", None, 1), ("b", 5.0, 2), ("b", 7.0, 3)], "k string, size double, id long")
    assert rows(dedup.keep_largest(df, ["k"], "size", ["id"]), "k", "id") == [("b", 3)]
    filled = dedup.keep_largest(df, ["k"], "size", ["id"], fill=-1)
    assert rows(filled, "k", "size") == [("a", -1.0), ("b", 7.0)]


def test_missing_ratings_are_topped_up(spark):
    a = spark.createDataFrame([(1, "x"), (2, "x"), (3, "y")], "k long, v string")
    b = spark.createDataFrame([(1, "x"), (1, "y"), (1, "y"), (2, "y")], "k long, v string")
    # Item 1 has four ratings; item 2 lacks two (one each), item 3 lacks three (1, then 1, then 1).
    got = rows(agreement.fleiss_pivot([a, b], ["k"], "v", ["x", "y"]))
    assert got == [(1, 2, 2), (2, 2, 2), (3, 1, 3)]


def test_identical_raters_agree_fully(spark):
    df = spark.createDataFrame([(i, i % 3 == 0) for i in range(12)], "k long, v boolean")
    table = agreement.fleiss_pivot([df, df], ["k"], "v", ["false", "true"])
    assert agreement.fleiss_kappa(table, ["false", "true"]).first().kappa == 1.0


def test_empty_groups_score_null(spark):
    df = spark.createDataFrame([("a", "yes", "no"), ("a", "yes", "yes")], "g string, t string, p string")
    got = {r.g: r for r in agreement.metrics_by_group(df, {"g": ["a", "b"]}, "t", "p").collect()}
    assert got["a"].accuracy == 0.5 and math.isclose(got["a"].f1, 2 / 3)
    assert got["b"].n == 0 and got["b"].f1 is None and got["b"].accuracy is None


def test_overlap_counts(spark):
    a = spark.createDataFrame([("x", 1), ("x", 1), ("y", 2), (None, 1)], "e string, y long")
    b = spark.createDataFrame([("x", 1), ("z", 3), (None, 1)], "e string, y long")
    assert tuple(joins.overlap_counts(a, b, ["e", "y"]).first()) == (2, 2, 1)


def test_orphans_ignore_null_references(spark):
    child = spark.createDataFrame([(1, 10), (2, 20), (3, None)], "id long, ref long")
    parent = spark.createDataFrame([(10,)], "pid long")
    assert rows(synthetic.orphan_keys(child, parent, "ref", "pid"), "id") == [(2,)]


def test_rollup_sums_small_categories(spark):
    df = spark.createDataFrame([("a", 9, 90.0), ("b", 1, 0.05), ("c", 2, 0.09)], "k string, n long, p double")
    got = {r.k: r.n for r in bins.rollup_small_to_other(df, "k", "p").collect()}
    assert got == {"a": 9, "Other": 3}


def test_schema_subset():
    class Fake:
        def __init__(self, *columns):
            self.columns = list(columns)

    cleaning.assert_schema_subset(Fake("a"), Fake("a", "b"))
    with pytest.raises(ValueError, match="missing"):
        cleaning.assert_schema_subset(Fake("c"), Fake("a", "b"))


def test_names_by_pattern_skip_missing_partners(spark):
    df = spark.createDataFrame([(3, 1)], "posts long, other_in_sub long")
    assert cleaning.derive_by_name_pattern(df).columns == ["posts", "other_in_sub"]


def test_two_level_totals_add_records_once(spark):
    df = spark.createDataFrame([("p", "e", 10), ("p", "e", 10), ("p", "f", 5)], "p string, e string, r long")
    got = aggregates.two_level_totals(df, "p", "e", "r", "records", "articles").first()
    assert (got.records, got.articles) == (15, 3)


def test_organisation_types_by_sector(spark):
    types = categories.lookup(categories.ORG_TYPES_BY_SECTOR)
    df = spark.createDataFrame([("web, gaming",), ("hotel",), ("unheard of",)], "t string")
    assert [r.s for r in cleaning.recode(df, "t", types, out="s").collect()] == ["Technology", "Retail", None]
    kept = cleaning.recode(df, "t", categories.lookup(categories.SECTOR_NAMES), out="s", keep=True)
    assert [r.s for r in kept.collect()] == ["Technology", "hotel", "unheard of"]


def test_sensitivity_names_and_record_ranges(spark):
    df = spark.createDataFrame([(3.0, 999_999), (7.0, 1_000_000)], "s double, n long")
    named = cleaning.recode(df, "s", categories.SENSITIVITY_NAMES)
    assert [r.s for r in named.collect()] == ["Credit card information", None]
    label = bins.bin_edges(F.col("n"), categories.RECORDS_LOST_EDGES, categories.RECORDS_LOST_LABELS)
    assert [r.b for r in df.select(label.alias("b")).collect()] == ["100K-1M", "1M-2.5M"]


def test_size_ranges_sort_by_size(spark):
    df = spark.createDataFrame([("10001+",), ("51 - 200",), ("1 - 10",), ("?",)], "size string")
    ordered = ranking.sort_by_ordinal(df, "size", categories.SIZE_RANGES)
    assert [r.size for r in ordered.collect()] == ["1 - 10", "51 - 200", "10001+", "?"]


def test_text_classifier_learns_from_words(spark):
    data = [(f"data breach number {i}", True) for i in range(30)]
    data += [(f"cookie recipe number {i}", False) for i in range(30)]
    df = spark.createDataFrame(data, "text string, breach boolean")
    model = classifier.train_text_classifier(df, ["breach"], text="text", max_iter=10)
    assert model.predict(df).filter("breach = breach_pred").count() == 60
    with pytest.raises(ValueError, match="one class"):
        classifier.train_text_classifier(df.filter("breach"), ["breach"], text="text")
