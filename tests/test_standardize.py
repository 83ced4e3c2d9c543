import datetime as dt

from pyspark.sql import functions as F

from conftest import RUN, counted
from shelfline.operators.standardize import quality_gate, standardize, status_counts, status_summary
from shelfline.schemas import RAW, SILVER
from shelfline.sources.bronze import flatten_payload
from shelfline.schemas import PAYLOAD


def raw(spark, *given):
    default = {"asin": "A", "title": " t ", "price": "12.5", "rating": "4.5", "reviews_count": "7",
               "in_stock": "in_stock", "category": " toys ", "source": "s",
               "scraped_at": "2026-04-01T23:15:57.107993+00:00"}
    rows = [tuple({**default, **row}[name] for name in RAW.fieldNames()) for row in given]
    return spark.createDataFrame(rows, RAW)


def test_types_text_and_order(spark):
    silver = standardize(raw(spark, {}), RUN)
    assert silver.columns == SILVER.fieldNames()
    assert [f.dataType for f in silver.schema] == [f.dataType for f in SILVER]
    row = silver.first()
    assert (row.title, row.category, row.price, row.reviews_count) == ("t", "TOYS", 12.5, 7)
    assert row.processed_at == RUN


def test_only_spaces_are_trimmed(spark):
    assert standardize(raw(spark, {"title": "\tt "}), RUN).first().title == "\tt"


def test_bad_values_become_null(spark):
    row = standardize(raw(spark, {"price": "n/a", "rating": "?", "reviews_count": "99999999999",
                                  "scraped_at": "yesterday"}), RUN).first()
    assert (row.price, row.rating, row.reviews_count, row.scrape_date) == (None, None, None, None)
    assert row.dq_status == "INVALID_PRICE"


def test_date_is_the_text_prefix_in_any_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        assert standardize(raw(spark, {}), RUN).first().scrape_date == dt.date(2026, 4, 1)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_first_fault_names_the_row(spark):
    cases = [({"price": None, "title": None}, "INVALID_PRICE"), ({"price": "0"}, "INVALID_PRICE"),
             ({"price": "-1", "rating": "9"}, "INVALID_PRICE"), ({"price": "NaN"}, "VALID"),
             ({"title": None, "rating": "9"}, "MISSING_TITLE"), ({"title": "   "}, "VALID"),
             ({"rating": "5.01"}, "INVALID_RATING"), ({"rating": "-0.1"}, "INVALID_RATING"),
             ({"rating": "NaN"}, "INVALID_RATING"), ({"rating": None}, "VALID"),
             ({"rating": "0"}, "VALID"), ({"rating": "5"}, "VALID")]
    for row, status in cases:
        assert standardize(raw(spark, row), RUN).first().dq_status == status, row


def test_gate_and_summaries(spark):
    silver = standardize(raw(spark, {}, {"price": None}, {"price": None}, {"title": None}), RUN)
    assert quality_gate(silver).count() == 1
    assert {r[0]: r[1] for r in status_counts(silver).collect()} == {
        "VALID": 1, "INVALID_PRICE": 2, "MISSING_TITLE": 1}
    assert status_summary(silver).first().asDict() == {
        "total_records": 4, "valid_records": 1, "invalid_records": 3, "valid_pct": 25.0}


def test_payload_paths_may_be_missing(spark):
    full = (("Full", 4.0, 9, ((5.5,), ("in_stock",)), [("first",), ("second",)]))
    no_offer = ("No offer", None, None, None, [])
    rows = [("A", full), ("B", no_offer), ("C", None)]
    frame = spark.createDataFrame(rows, "asin string, product " + PAYLOAD.simpleString())
    flat = {r.asin: r for r in flatten_payload(
        frame, scraped_at=F.lit("2026-04-01 10:00:00").cast("timestamp")).collect()}
    assert flat["A"][1:7] == ("Full", 5.5, 4.0, 9, "in_stock", "first")
    assert flat["B"][1:7] == ("No offer", None, None, None, None, None)
    assert flat["C"][1:7] == (None,) * 6
    assert flat["A"].scraped_at == "2026-04-01T10:00:00.000000+00:00"
