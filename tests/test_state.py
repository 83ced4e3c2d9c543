"""Profiles of dates, keyed state in buckets, the streamed snapshot."""

import datetime as dt
import pathlib
import random

from pyspark.sql import functions as F

from conftest import RUN, at, counted
from shelfline.operators import changes, gold, profiles
from shelfline.operators.standardize import standardize
from shelfline.plans.medallion import run_silver
from shelfline.schemas import SILVER
from shelfline.sinks import buckets
from shelfline.sinks.versions import Changes
from shelfline.sources.bronze import read_bronze
from shelfline.streaming.silver import read_last, stream_bronze, stream_current
from test_changes import FIRST, KEYS, VALUES, log
from test_tables import land_files, objects


def test_profiles_of_dates_add_up(spark, observations):
    rows = observations(*[{"asin": f"A{k % 3000}", "scraped_at": at(1 + k % 9, k % 24), "price": None if k % 7 == 0 else 1.0} for k in range(8000)],
                        {"asin": None, "rating": None}, {"scraped_at": None, "scrape_date": None})
    by_date = profiles.date_profiles(rows)
    assert by_date.count() == 10
    one = profiles.merge_profiles(by_date.where(F.col("scrape_date").between(dt.date(2026, 4, 2), dt.date(2026, 4, 6)))).first()
    held = rows.where(F.col("scrape_date").between(dt.date(2026, 4, 2), dt.date(2026, 4, 6)))
    exact = held.agg(F.count_distinct("asin", "scraped_at"), F.count_distinct("asin")).first()
    assert one.total_records == held.count() and one.null_price == held.where("price is null").count()
    for found, true in zip((one.distinct_records, one.distinct_products), exact):
        assert abs(found - true) <= 3 * profiles.error_of() * true
    whole = profiles.merge_profiles(by_date).first()
    assert whole.distinct_sources == 1 and abs(whole.distinct_products - 3001) <= 3 * profiles.error_of() * 3001
    assert profiles.merge_profiles(by_date, [F.month("scrape_date").alias("m")]).count() == 2


def test_runs_keep_profiles_of_their_dates(spark, tmp_path):
    out = str(tmp_path / "out")
    for days in ((1, 2), (3,), (2,)):
        folder = str(tmp_path / f"b{days[0]}{len(days)}")
        land_files(folder, objects(20 if days != (2,) else 40, days=days))
        run_silver(spark, folder, out, RUN, profiles=True)
    schema = profiles.date_profiles(spark.createDataFrame([], SILVER)).schema
    stored = Changes(spark, out).read("profiles", schema)
    assert {(r.scrape_date.day, r.total_records) for r in stored.collect()} == {(1, 10), (2, 40), (3, 20)}


def test_a_load_writes_the_buckets_it_touches(spark, tmp_path):
    path, rng = str(tmp_path / "state"), random.Random(3)
    rows = [("U", rng.randrange(50), n, f"k{rng.randrange(60)}", rng.choice([None, n]), rng.choice([None, f"b{n}"]), n) for n in range(300)]
    first = log(spark, *rows[:250])
    assert len(buckets.apply_to_buckets(first, path, KEYS, VALUES, keep_earliest=FIRST, buckets=32)) > 20
    before = {p: p.stat().st_mtime_ns for p in pathlib.Path(path).rglob("*.parquet") if "manifest" not in str(p)}
    some = log(spark, *[("D", 55, 400, "k1", None, None, None), ("U", 55, 401, "k2", 7, "last", 1)])
    touched = buckets.apply_to_buckets(some, path, KEYS, VALUES, keep_earliest=FIRST)
    assert 1 <= len(touched) <= 2
    new = {p for p in pathlib.Path(path).rglob("*.parquet") if "manifest" not in str(p)} - set(before)
    assert {p.parent.name for p in new} == {f"bucket={b}" for b in touched}
    late = log(spark, *rows[250:])
    for _ in range(2):
        buckets.apply_to_buckets(late, path, KEYS, VALUES, keep_earliest=FIRST)
    whole = first.unionByName(some).unionByName(late)
    expected = changes.current_rows(changes.apply_changes(None, whole, KEYS, VALUES, keep_earliest=FIRST), KEYS, VALUES, keep_earliest=FIRST)
    assert counted(buckets.read_rows(whole, path, KEYS, VALUES, keep_earliest=FIRST)) == counted(expected)


def test_the_streamed_snapshot_is_the_last_valid_row(spark, tmp_path):
    bronze, out, checkpoint = (str(tmp_path / name) for name in ("bronze", "out", "checkpoint"))
    for part in (objects(40, days=(3, 4)), objects(30, days=(1, 5)), []):
        land_files(bronze, part)
        stream_current(standardize(stream_bronze(spark, bronze, files_per_batch=20), RUN), out, checkpoint, compact_every=2).awaitTermination()
    silver = standardize(read_bronze(spark, bronze), RUN)
    assert counted(gold.stock_gap(read_last(spark, out), RUN)) == counted(gold.stock_gap(silver.where("dq_status = 'VALID'"), RUN))
