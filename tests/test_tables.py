import datetime as dt
import json
import pathlib

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import RUN, at, counted
from shelfline.operators import gold, reports
from shelfline.operators.snapshots import daily_latest
from shelfline.operators.standardize import standardize
from shelfline.functions.columns import as_int
from shelfline.plans.medallion import EmptyInputError, PartialDateError, publish, run, run_gold, run_silver
from shelfline.schemas import GOLD, SILVER
from shelfline.session import fresh_path, setting, shared_dir
from shelfline.sinks.tables import NarrowColumnError, ensure_table, land_raw, land_texts, write_catalog_table, write_table
from shelfline.sources.bronze import CORRUPT, read_bronze
from shelfline.sources.silver import read_merged, read_silver, read_table


def objects(n=60, days=(1, 2, 3)):
    for i in range(n):
        yield {"asin": f"A{i % 4}", "title": f" product {i % 4} ", "price": None if i % 17 == 0 else 100 + 7.5 * (i % 9),
               "rating": None if i % 5 == 0 else 4.1, "reviews_count": 990 + i,
               "in_stock": ["in_stock", "out_of_stock", None][i % 3], "category": ["x", " y "][i % 2],
               "scraped_at": at(days[i % len(days)], i % 24, i % 60), "source": "amazon_in"}


def land_files(root, records):
    for i, record in enumerate(records):
        folder = pathlib.Path(root) / record["scraped_at"][:10]
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"{record['asin']}_{i}.json").write_text(json.dumps(record, indent=2))


@pytest.fixture
def bronze(tmp_path):
    land_files(tmp_path / "bronze", objects())
    return str(tmp_path / "bronze")


def tables(spark, out):
    return {name: counted(read_table(spark, f"{out}/{name}", schema))
            for name, schema in {"products": SILVER, **GOLD}.items()}


def dated(found):
    """Without the rows that have no date."""
    place = {name: sorted(schema.fieldNames()).index("scrape_date")
             for name, schema in {"products": SILVER, **GOLD}.items()}
    return {name: {row: n for row, n in rows.items() if row[place[name]] != "None"}
            for name, rows in found.items()}


def test_one_object_per_file_below_date_folders(spark, bronze):
    raw = read_bronze(spark, bronze)
    assert raw.count() == 60
    assert raw.where("price is null").count() == 4
    (pathlib.Path(bronze) / "bad.json").write_text("{not json")
    bad = [r for r in read_bronze(spark, bronze, keep_corrupt=True).collect() if r[CORRUPT] is not None]
    assert [(r.asin, r[CORRUPT]) for r in bad] == [(None, "{not json")]
    assert read_bronze(spark, bronze).count() == 61


def test_landing_by_date_one_file_per_row(spark, bronze, tmp_path):
    raw = read_bronze(spark, bronze)
    path = str(tmp_path / "landed")
    assert land_raw(raw, path, rows_per_file=1) == 60
    files = list(pathlib.Path(path).glob("dt=2026-04-0*/*.json"))
    assert len(files) == 60
    assert counted(read_bronze(spark, path)) == counted(raw)


def test_a_second_run_changes_nothing(spark, bronze, tmp_path):
    out = str(tmp_path / "out")
    metrics = run(spark, bronze, out, RUN)
    first = tables(spark, out)
    again = run(spark, bronze, out, RUN, rows_per_piece=2)
    assert tables(spark, out) == first
    assert metrics.rows_written == again.rows_written
    assert metrics.rows_written == {name: sum(rows.values()) for name, rows in first.items()}
    assert metrics.status == {"VALID": 56, "INVALID_PRICE": 4}
    assert metrics.quality["total_records"] == 60 and metrics.quality["overall_score"] > 0


def test_plan_tables_equal_the_operators(spark, bronze, tmp_path):
    out = str(tmp_path / "out")
    run(spark, bronze, out, RUN)
    valid = read_silver(spark, f"{out}/products").where("dq_status = 'VALID'")
    daily = daily_latest(valid)
    expected = {"price_history": gold.price_history(valid, RUN), "review_trend": gold.review_trend(daily, RUN),
                "competitor_ranking": gold.competitor_ranking(daily, RUN), "stock_gap": gold.stock_gap(valid, RUN),
                "market_summary": gold.market_summary(daily, RUN)}
    found = tables(spark, out)
    for name, frame in expected.items():
        assert counted(frame) == found[name], name


def test_published_tables_answer_sql_and_reports(spark, bronze, tmp_path):
    out = str(tmp_path / "out")
    metrics = run(spark, bronze, out, RUN)
    for _ in range(2):
        publish(spark, out, "shelf")
        for name, rows in metrics.rows_written.items():
            assert spark.sql(f"SELECT count(*) FROM shelf.{name}").first()[0] == rows
    for name in reports.REPORTS:
        assert reports.run_report(spark, name, "shelf").count() > 0


def test_gold_from_a_date_on_equals_a_full_run(spark, tmp_path):
    early, late = list(objects(days=(1, 2))), list(objects(days=(3, 5)))
    # Times that are none sort before, between and after the others.
    early += [{**early[i], "scraped_at": text, "price": 55.5}
              for i, text in enumerate(["2026", "2026-04-03T zz", "yesterday", "2026-04-02?"])]
    land_files(tmp_path / "bronze", early)
    out, full = str(tmp_path / "out"), str(tmp_path / "full")
    run(spark, str(tmp_path / "bronze"), out, RUN)
    land_files(tmp_path / "bronze", late)
    run_silver(spark, [str(tmp_path / "bronze" / f"2026-04-{d:02d}") for d in (3, 5)], out, RUN)
    for _ in range(2):
        run_gold(spark, f"{out}/products", out, RUN, from_date=dt.date(2026, 4, 3))
    run(spark, str(tmp_path / "bronze"), full, RUN)
    assert dated(tables(spark, out)) == dated(tables(spark, full))
    assert tables(spark, out)["products"] == tables(spark, full)["products"]


def test_nothing_to_do_is_an_error(spark, tmp_path):
    (tmp_path / "bronze").mkdir()
    with pytest.raises(EmptyInputError):
        run(spark, str(tmp_path / "bronze"), str(tmp_path / "out"), RUN)
    land_files(tmp_path / "bronze", [{**row, "price": None} for row in objects(3)])
    with pytest.raises(EmptyInputError):
        run(spark, str(tmp_path / "bronze"), str(tmp_path / "out"), RUN)
    assert read_silver(spark, str(tmp_path / "out/products")).count() == 3


def test_silver_prunes_partitions_and_pushes_the_gate(spark, bronze, tmp_path):
    out = str(tmp_path / "out")
    run_silver(spark, bronze, out, RUN)
    plan = (read_silver(spark, f"{out}/products", from_date=dt.date(2026, 4, 2)).where("dq_status = 'VALID'")
            .select("asin")._jdf.queryExecution().executedPlan().toString())
    assert "PartitionFilters: [isnotnull(scrape_date" in plan
    assert "EqualTo(dq_status,VALID)" in plan
    assert "ReadSchema: struct<asin:string,dq_status:string>" in plan


def test_overwriting_a_date_leaves_the_others(spark, observations, tmp_path):
    path = str(tmp_path / "t")
    assert write_table(observations({}, {"scraped_at": at(2)}), path) == 2
    assert write_table(observations({"price": 5.0}), path) == 1
    assert sorted((r.scrape_date.day, r.price) for r in read_silver(spark, path).collect()) == [(1, 5.0), (2, 10.0)]


def test_appended_columns_are_merged_on_read(spark, observations, tmp_path):
    path = str(tmp_path / "t")
    write_table(observations({}), path, mode="append")
    write_table(observations({"asin": "B"}).withColumn("extra", F.lit(1)), path, mode="append")
    assert {(r.asin, r.extra) for r in read_merged(spark, path).collect()} == {("A", None), ("B", 1)}
    assert read_silver(spark, path).count() == 2


def test_no_rows_are_written_for_dates_to_come(spark, bronze, tmp_path):
    out = str(tmp_path / "out")
    run(spark, bronze, out, RUN)
    before = tables(spark, out)
    metrics = run_gold(spark, f"{out}/products", out, RUN, from_date=dt.date(2030, 1, 1))
    assert tables(spark, out) == before
    assert metrics.rows_written == {"price_history": 0, "competitor_ranking": 0, "review_trend": 0,
                                    "stock_gap": 4, "market_summary": 0}


def test_catalog_tables_and_reports(spark, observations, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS gold")
    valid = observations(*[{"asin": a, "price": p, "scraped_at": at(1, 10, i)}
                           for a in "AB" for i, p in enumerate([10.0, 30.0, 25.0])])
    daily = daily_latest(valid)
    contents = {"products": (valid, SILVER), "price_history": (gold.price_history(valid, RUN), GOLD["price_history"]),
                "competitor_ranking": (gold.competitor_ranking(daily, RUN), GOLD["competitor_ranking"]),
                "market_summary": (gold.market_summary(daily, RUN), GOLD["market_summary"])}
    for name, (frame, schema) in contents.items():
        for _ in range(2):
            ensure_table(spark, f"gold.{name}", schema, "scrape_date", properties={"layer": "gold"})
            assert write_catalog_table(frame, f"gold.{name}") == frame.count()
        assert counted(spark.table(f"gold.{name}")) == counted(frame)
    other_day = observations({"asin": "C", "scraped_at": at(9)})
    with setting(spark, "spark.sql.sources.partitionOverwriteMode", "static"):
        write_catalog_table(other_day, "gold.products")
        write_table(other_day, str(tmp_path / "t"))
        write_table(valid, str(tmp_path / "t"))
    assert spark.table("gold.products").count() == 7
    assert read_silver(spark, str(tmp_path / "t")).count() == 7
    described = {r.col_name: r.comment for r in spark.sql("DESCRIBE gold.products").collect()}
    assert described["scrape_date"] == "Date of the scrape, partition column"
    assert reports.run_report(spark, "product_prices", "gold").first().total_scrapes == 3
    assert [r.price_diff for r in reports.run_report(spark, "price_moves", "gold").collect()] == [20.0, 20.0, -5.0, -5.0]
    assert reports.run_report(spark, "rankings", "gold").count() == 2
    assert reports.run_report(spark, "market", "gold").count() == 1


def test_shared_folder_is_the_one_the_session_names(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir", shared_dir(spark))
    assert fresh_path(spark, "a") != fresh_path(spark, "a")


def test_gold_drops_dates_that_lost_their_rows(spark, tmp_path):
    rows = list(objects(days=(1, 2, 3)))
    land_files(tmp_path / "first", rows)
    land_files(tmp_path / "second", [{**r, "price": None} if r["scraped_at"] < at(2) and r["scraped_at"] >= at(1, 0) else r for r in rows])
    for from_date in (None, dt.date(2026, 4, 1)):
        out, fresh = (str(tmp_path / f"{name}{from_date}") for name in ("out", "fresh"))
        run(spark, str(tmp_path / "first"), out, RUN)
        run(spark, str(tmp_path / "second"), out, RUN, from_date=from_date)
        run(spark, str(tmp_path / "second"), fresh, RUN)
        assert tables(spark, out) == tables(spark, fresh)


def test_a_late_file_leaves_the_rest_of_its_date(spark, tmp_path):
    rows = list(objects(days=(1, 2)))
    late = [r for r in rows if r["asin"] == "A3"]
    land_files(tmp_path / "early", [r for r in rows if r["asin"] != "A3"])
    land_files(tmp_path / "late", late)
    land_files(tmp_path / "all", rows)
    out, fresh = str(tmp_path / "out"), str(tmp_path / "fresh")
    run_silver(spark, str(tmp_path / "early"), out, RUN)
    with pytest.raises(PartialDateError):
        run_silver(spark, str(tmp_path / "late"), out, RUN)
    for _ in range(2):
        run_silver(spark, str(tmp_path / "late"), out, RUN, late=True)
    run_silver(spark, str(tmp_path / "all"), fresh, RUN)
    assert counted(read_silver(spark, f"{out}/products")) == counted(read_silver(spark, f"{fresh}/products"))
    run_silver(spark, str(tmp_path / "late"), out, RUN, replace=True)
    assert read_silver(spark, f"{out}/products").count() == len(late) + 30  # all of them on the second day


def test_catalog_appends_add_columns(spark, tmp_path):
    spark.sql("CREATE TABLE merged (a INT, scrape_date DATE) USING parquet PARTITIONED BY (scrape_date)")
    try:
        rows = spark.sql("SELECT 1 AS a, 'x' AS Extra, DATE'2026-04-01' AS scrape_date")
        write_catalog_table(rows.drop("Extra"), "merged", overwrite=False)
        write_catalog_table(rows, "merged", overwrite=False)
        write_catalog_table(rows.drop("a"), "merged", overwrite=False)
        found = spark.table("merged")
        assert {c.lower() for c in found.columns} == {"a", "extra", "scrape_date"}
        assert counted(found.select("a", F.col("extra"))) == {("1", "None"): 1, ("1", "'x'"): 1, ("None", "'x'"): 1}
    finally:
        spark.sql("DROP TABLE merged")


def test_wider_numbers_widen_the_table(spark, tmp_path):
    schema = T.StructType([T.StructField("a", T.IntegerType(), True, {"comment": "it's a"}), T.StructField("b", T.FloatType()),
                           T.StructField("c", T.DecimalType(5, 2)), T.StructField("scrape_date", T.DateType())])
    ensure_table(spark, "wide", schema, "scrape_date", location=str(tmp_path / "wide"), properties={"layer": "gold"})
    ensure_table(spark, "narrow", schema, "scrape_date")
    day = "DATE'2026-04-0{}' AS scrape_date"
    try:
        write_catalog_table(spark.sql("SELECT 1 AS a, 0.5F AS b, 1.25BD AS c, " + day.format(1)), "wide")
        more = spark.sql("SELECT 3000000000L AS A, 1e300D AS b, CAST(123456.789 AS DECIMAL(12,3)) AS c, " + day.format(2))
        write_catalog_table(more, "wide")
        write_catalog_table(spark.sql("SELECT 2 AS a, 0.25F AS b, 2.5BD AS c, " + day.format(3)), "wide")
        assert [f.dataType.simpleString() for f in spark.table("wide").schema] == ["bigint", "double", "decimal(12,3)", "date"]
        assert sorted((r.a, r.b, float(r.c)) for r in spark.table("wide").collect()) == [
            (1, 0.5, 1.25), (2, 0.25, 2.5), (3000000000, 1e300, 123456.789)]
        assert {r.col_name: r.comment for r in spark.sql("DESCRIBE wide").collect()}["a"] == "it's a"
        with pytest.raises(NarrowColumnError):
            write_catalog_table(more, "narrow")
        assert spark.table("narrow").isEmpty()
    finally:
        spark.sql("DROP TABLE wide")
        spark.sql("DROP TABLE narrow")


def test_whole_numbers_of_any_shape(spark):
    texts = ["990", "990.0", "1500.9", "9.9e2", "-3.7", "x", "3e9", None, "NaN"]
    rows = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string").select(as_int("t")).collect()
    assert [r[0] for r in rows] == [990, 990, 1500, 990, -3, None, None, None, None]


def test_texts_to_files_of_their_own_are_written_by_many_tasks(spark, tmp_path):
    path = tmp_path / "raw"
    rows = spark.range(200).select(F.format_string('{"asin": "%d",\n"title": "t"}', "id").alias("value")).coalesce(1)
    land_texts(rows, str(path), folders=8)
    files = [len(list(folder.glob("part-*"))) for folder in path.glob("part=*")]
    assert len(files) == 8 and sum(files) == 200 and max(files) < 60
    found = read_bronze(spark, str(path))
    assert {row.asin for row in found.collect()} == {str(k) for k in range(200)} and found.count() == 200
