import pytest

from conftest import at
from shelfline.operators.quality import (apply_defaults, check_constraints, quality_report, quality_score,
                                         rounded)
from shelfline.fixed_values import ORDER_DEFAULTS, PILLAR_WEIGHTS
from test_standardize import raw


def test_published_run(spark):
    rows = [{"asin": f"A{i % 11}", "scraped_at": at(1, second=0)[:17] + f"{i:02d}.5+00:00",
             "price": None if i < 2 else "799.0"} for i in range(99)]
    report = quality_score(quality_report(raw(spark, *rows)))
    shown = rounded(report).first()
    assert (shown.completeness_score, shown.validity_score, shown.uniqueness_score) == (97.98, 100, 100)
    assert (shown.consistency_score, shown.accuracy_score, shown.timeliness_score) == (100, 100, 100)
    assert shown.overall_score == 99.49
    assert (shown.null_prices, shown.distinct_products, shown.distinct_sources) == (2, 11, 1)


def test_a_row_with_two_faults_counts_twice(spark):
    report = quality_report(raw(spark, {"price": "-1", "rating": "9"})).first()
    assert (report.invalid_prices, report.invalid_ratings, report.suspicious_prices) == (1, 1, 1)
    assert report.validity_score == -100


def test_null_tuples_are_one_distinct_value_but_null_times_none(spark):
    report = quality_report(raw(spark, {"asin": None}, {"asin": None}, {"scraped_at": None},
                                {"scraped_at": None})).first()
    assert (report.distinct_records, report.duplicate_records) == (2, 2)
    assert (report.distinct_products, report.distinct_scrape_times) == (2, 1)
    assert report.consistency_score == 50


def test_unreadable_prices_are_no_null_but_no_number(spark):
    report = quality_report(raw(spark, {"price": "n/a"}, {"price": "250"})).first()
    assert (report.null_prices, report.min_price, report.avg_price) == (0, 250, 250)


@pytest.mark.parametrize("pillar", list(PILLAR_WEIGHTS))
def test_one_pillar_alone_equals_its_part_of_the_report(spark, pillar):
    frame = raw(spark, {}, {"price": None}, {"rating": "9"}, {"asin": "B"})
    alone = quality_report(frame, pillars=[pillar]).first().asDict()
    whole = quality_report(frame).first().asDict()
    assert alone == {name: whole[name] for name in alone}


def test_plain_counts_do_not_shuffle_rows_and_distinct_ones_hash(spark):
    plan = quality_report(raw(spark, {}))._jdf.queryExecution().executedPlan().toString()
    assert "Sort [" not in plan


def test_estimates_of_few_values_are_exact(spark):
    frame = raw(spark, {}, {"asin": None}, {"asin": "B"}, {"scraped_at": None})
    assert quality_report(frame, approximate=True).first() == quality_report(frame).first()


def test_constraints(spark):
    frame = spark.createDataFrame(
        [("a", 1, None), ("a", 2, "x"), ("b", None, "y"), (None, 3, "z")], "id string, n int, s string")
    found = check_constraints(frame, ["id"], ["n", "s"]).first().asDict()
    assert found == {"total_records": 4, "duplicate_keys": 1, "null_id": 1, "null_n": 1, "null_s": 1,
                     "constraints_hold": False}
    assert check_constraints(frame.where("id = 'b'"), ["id"], ["s"]).first().constraints_hold
    assert check_constraints(frame.where("false"), ["id"]).first().total_records == 0


def test_defaults(spark):
    frame = spark.createDataFrame([(None, None, None), (3, "shipped", "m")],
                                  "quantity int, order_status string, marketplace string")
    assert sorted(map(tuple, apply_defaults(frame, ORDER_DEFAULTS).collect())) == [
        (1, "pending", "amazon_in"), (3, "shipped", "m")]
