"""Tables whose changes appear together, undated rows, one Silver table for stream and batch, and the carried state."""

import datetime as dt
import pathlib
import threading

import pytest
from pyspark.sql import functions as F

from conftest import RUN, at, counted
from shelfline.operators.standardize import standardize
from shelfline.plans import medallion
from shelfline.plans.medallion import CARRY, publish, run, run_gold, run_silver
from shelfline.schemas import GOLD, SILVER
from shelfline.sinks import versions
from shelfline.sinks.tables import write_table
from shelfline.sinks.versions import Changes, ConflictError, read_manifest
from shelfline.sources.bronze import read_bronze
from shelfline.sources.silver import read_silver
from shelfline.streaming.silver import stream_bronze, stream_silver
from test_tables import dated, land_files, objects, tables


def silver_keys(spark, out):
    return sorted((r.asin, str(r.scrape_date)) for r in read_silver(spark, f"{out}/products").collect())


def test_rows_without_a_date_outlive_later_runs(spark, tmp_path):
    out = str(tmp_path / "out")
    base = next(objects(1))
    for day, key in ((1, "A"), (2, "B"), (2, "B"), (3, "C")):
        folder = str(tmp_path / f"b{key}")
        rows = [{**base, "asin": key, "scraped_at": at(day)}]
        if key != "C":
            rows.append({**base, "asin": f"undated{key}", "scraped_at": "no time"})
        land_files(folder, rows)
        run_silver(spark, folder, out, RUN)
    assert silver_keys(spark, out) == [("A", "2026-04-01"), ("B", "2026-04-02"), ("C", "2026-04-03"),
                                       ("undatedA", "None"), ("undatedB", "None")]


def test_stream_and_batch_share_a_table(spark, tmp_path):
    out, bronze, later = (str(tmp_path / name) for name in ("out", "bronze", "later"))
    products = f"{out}/products"

    def stream(checkpoint="checkpoint"):
        stream_silver(stream_bronze(spark, bronze), products, str(tmp_path / checkpoint), RUN).awaitTermination()
    land_files(bronze, objects(12, days=(1,)))
    stream()
    land_files(later, objects(9, days=(2,)))
    run_silver(spark, later, out, RUN)
    land_files(tmp_path / "bronze" / "more", objects(5, days=(1, 2)))
    stream()
    everything = read_bronze(spark, [bronze, later])
    assert counted(read_silver(spark, products)) == counted(standardize(everything, RUN))
    # what a date was added to several times is one folder for the catalog
    publish(spark, out, "streamed")
    assert spark.table("streamed.products").count() == 26
    assert all(len(v) == 1 for v in read_manifest(spark, out).tables["products"].values())
    assert counted(read_silver(spark, products)) == counted(standardize(everything, RUN))


def test_a_batch_run_again_adds_nothing(spark, tmp_path, observations):
    out = str(tmp_path / "out")

    def add(batch_id, rows):
        changes = Changes(spark, out)
        if changes.marks.get("stream", -1) < batch_id:
            changes.write(rows, "products", append=True)
            changes.marks["stream"] = batch_id
            changes.commit()
    for batch_id in (0, 0, 1, 0, 1):
        add(batch_id, observations({"asin": f"A{batch_id}"}))
    assert sorted(r.asin for r in read_silver(spark, f"{out}/products").collect()) == ["A0", "A1"]


def test_a_run_that_is_killed_leaves_all_tables(spark, tmp_path, monkeypatch):
    out = str(tmp_path / "out")
    land_files(tmp_path / "one", objects(20, days=(1, 2)))
    run(spark, str(tmp_path / "one"), out, RUN)
    before = tables(spark, out)
    land_files(tmp_path / "two", [{**row, "price": 5.0} for row in objects(20, days=(1, 2))])

    def killed(self):
        raise KeyboardInterrupt
    for step in ("commit", "write_carry"):
        with monkeypatch.context() as patch:
            if step == "commit":
                patch.setattr(Changes, "commit", killed)
            else:
                patch.setattr(medallion, step, lambda *a: killed(None))
            with pytest.raises(KeyboardInterrupt):
                run(spark, str(tmp_path / "two"), out, RUN)
        assert tables(spark, out) == before
    run(spark, str(tmp_path / "two"), out, RUN)
    fresh = str(tmp_path / "fresh")
    run(spark, str(tmp_path / "two"), fresh, RUN)
    assert tables(spark, out) == tables(spark, fresh)


def test_the_second_of_two_runs_at_a_time_fails(spark, tmp_path, observations):
    out = str(tmp_path / "out")
    first, second = Changes(spark, out), Changes(spark, out)
    first.write(observations({}), "products")
    second.write(observations({"asin": "B"}), "products")
    first.commit()
    with pytest.raises(ConflictError):
        second.commit()


def test_readers_keep_their_files_until_two_lists_later(spark, tmp_path, observations):
    out = str(tmp_path / "out")
    write_table(observations({}, {"scraped_at": at(2)}), f"{out}/products")  # a table from before there were lists
    readers = []
    for k in range(3):
        readers.append(read_silver(spark, f"{out}/products"))
        changes = Changes(spark, out)
        changes.write(observations({"asin": f"B{k}"}), "products")
        changes.commit()
        assert sorted(r.asin for r in readers[-1].collect()) == sorted(["A", f"B{k - 1}" if k else "A"])
    assert sorted(r.asin for r in read_silver(spark, f"{out}/products").collect()) == ["A", "B2"]
    assert {p.name for p in pathlib.Path(out, "products").iterdir()} == {"v=1", "v=2", "scrape_date=2026-04-02"}
    assert {p.name for p in pathlib.Path(out, "manifest").iterdir()} == {"run=1", "run=2"}


def test_a_run_from_a_date_on_reads_no_history(spark, tmp_path):
    out, fresh, bronze = str(tmp_path / "out"), str(tmp_path / "fresh"), tmp_path / "bronze"
    rows = list(objects(120, days=(1, 2, 4, 5, 6, 8))) + [{**next(objects(1)), "asin": "A1", "scraped_at": "2026-04-02?", "price": 3.5}]
    rows += [{**next(objects(1)), "asin": "once", "scraped_at": at(1)}]
    land_files(bronze, [r for r in rows if r["scraped_at"] < "2026-04-05"])
    run(spark, str(bronze), out, RUN)
    for low, high in ((5, 7), (7, 9)):
        part = [r for r in rows if f"2026-04-{low:02d}" <= r["scraped_at"] < f"2026-04-{high:02d}"]
        land_files(tmp_path / f"b{low}", part)
        run_silver(spark, str(tmp_path / f"b{low}"), out, RUN)
        from_date = dt.date(2026, 4, low)
        changes = Changes(spark, out)
        carried = medallion.read_carry(changes, from_date)
        assert carried[1] == dt.date(2026, 4, 4 if low == 5 else 6)
        state = carried[0].withColumn("scrape_date", F.col("seen_on")).select(*SILVER.fieldNames())
        recent = medallion.with_last_before(changes.read("products", SILVER), from_date, carried=(state, carried[1]))
        read = {r[0] for r in recent.select(F.input_file_name()).distinct().collect()}  # what the scan reads, not what it lists
        dates = {name.split("scrape_date=")[1].split("/")[0] for name in read if "/products/" in name}
        assert dates <= {"__HIVE_DEFAULT_PARTITION__", "2026-04-02", *(f"2026-04-{d:02d}" for d in range(low, high))}
        plan = recent._jdf.queryExecution().executedPlan().toString()
        assert plan.count("PartitionFilters: [isnotnull(scrape_date") >= 3
        run_gold(spark, f"{out}/products", out, RUN, from_date=from_date)
        land_files(bronze, part)
    run(spark, str(bronze), fresh, RUN)
    assert dated(tables(spark, out)) == dated(tables(spark, fresh))
    assert len(read_manifest(spark, out).tables[CARRY]) == len(read_manifest(spark, fresh).tables[CARRY])


def test_states_of_changed_dates_are_not_carried(spark, tmp_path):
    out = str(tmp_path / "out")
    land_files(tmp_path / "one", objects(40, days=(1, 2, 3, 4)))
    run(spark, str(tmp_path / "one"), out, RUN)
    assert sorted(read_manifest(spark, out).tables[CARRY]) == [f"2026-04-{d:02d}" for d in (1, 2, 3, 4)]
    land_files(tmp_path / "two", [{**row, "price": 5.0} for row in objects(40, days=(1, 2, 3, 4)) if row["scraped_at"].startswith("2026-04-02")])
    run_silver(spark, str(tmp_path / "two"), out, RUN)
    assert sorted(read_manifest(spark, out).tables[CARRY]) == ["2026-04-01"]
    assert medallion.read_carry(Changes(spark, out), dt.date(2026, 4, 1)) is None


def test_empty_tables_are_on_the_list(spark, tmp_path, observations):
    out = str(tmp_path / "out")
    changes = Changes(spark, out)
    changes.write(observations({}).limit(0), "products")
    changes.commit()
    assert read_silver(spark, f"{out}/products").count() == 0
    assert versions.read_listed(spark, f"{out}/other", SILVER, "scrape_date") is None


def test_broken_records_are_set_apart(spark, tmp_path):
    out, bronze = str(tmp_path / "out"), tmp_path / "bronze"
    land_files(bronze, objects(9, days=(1,)))
    (bronze / "2026-04-01" / "bad.json").write_text('{"asin": "B", "price": ')
    metrics = run_silver(spark, str(bronze), out, RUN)
    assert metrics.rows_written == {"products": 9, "rejects": 1} and metrics.quality["total_records"] == 9
    assert read_silver(spark, f"{out}/products").where("asin IS NULL OR asin = 'B'").isEmpty()

    def rejects():
        return sorted((r.file.rpartition("/")[2], r.text, r.block_start, r.scrape_date) for r in
                      Changes(spark, out).read("rejects", medallion.REJECT_SCHEMA).collect())
    first = [("bad.json", '{"asin": "B", "price": ', 0, RUN.date())]
    assert rejects() == first
    run_silver(spark, str(bronze), out, RUN)
    assert rejects() == first
    later = tmp_path / "later"
    land_files(later, objects(3, days=(2,)))
    (later / "worse.json").write_text("no")
    run_silver(spark, str(later), out, RUN)
    assert rejects() == [*first, ("worse.json", "no", 0, RUN.date())]
    with pytest.raises(medallion.RejectedInputError):
        run_silver(spark, str(later), out, RUN, most_rejects=0.1)


def test_only_new_files_are_parsed(spark, tmp_path, monkeypatch):
    out, bronze, fresh = str(tmp_path / "out"), str(tmp_path / "bronze"), str(tmp_path / "fresh")
    rows = list(objects(60))
    late = [r for r in rows if r["asin"] == "A3" and r["scraped_at"].startswith("2026-04-02")]
    land_files(bronze, [r for r in rows if r not in late])
    run(spark, bronze, out, RUN, new_only=True)
    before, number = tables(spark, out), read_manifest(spark, out).number
    assert sum(before["products"].values()) == 60 - len(late)
    with monkeypatch.context() as patch:
        patch.setattr(medallion, "read_with_origin", lambda *a, **b: pytest.fail("parsed a file again"))
        assert run(spark, bronze, out, RUN, new_only=True).rows_written == {"products": 0}
    assert tables(spark, out) == before and read_manifest(spark, out).number == number
    land_files(tmp_path / "bronze" / "late", late)
    # a file that is written again with another count
    path = next(p for p in pathlib.Path(bronze).rglob("A0_0.json"))
    path.write_text(path.read_text().replace("990", "12345"))
    run(spark, bronze, out, RUN, new_only=True)
    assert not read_silver(spark, f"{out}/products").where("reviews_count = 12345").isEmpty()
    run(spark, bronze, fresh, RUN)
    assert dated(tables(spark, out)) == dated(tables(spark, fresh))


def test_gold_tables_are_written_at_once(spark, observations, tmp_path, monkeypatch):
    out, real, together = str(tmp_path), Changes.write, threading.Barrier(len(GOLD), timeout=60)

    def write(self, rows, name, **options):
        if name in GOLD:
            together.wait()  # breaks unless all of them have begun
        return real(self, rows, name, **options)
    monkeypatch.setattr(Changes, "write", write)
    changes = Changes(spark, out)
    changes.write(observations({}, {"asin": "B", "price": 20.0}), "products")
    metrics = run_gold(spark, f"{out}/products", out, RUN, changes=changes)
    assert {name: metrics.rows_written[name] for name in GOLD} == {
        "price_history": 2, "competitor_ranking": 2, "review_trend": 2, "stock_gap": 2, "market_summary": 1}


def test_the_history_is_written_beside_the_snapshot(spark, observations, tmp_path, monkeypatch):
    write, stage, together = Changes.write, medallion.stage, threading.Barrier(2, timeout=60)

    def first_wait(real, wanted, at):
        def call(*args, **options):
            if args[at] == wanted:
                together.wait()  # breaks unless both have begun
            return real(*args, **options)
        return call
    monkeypatch.setattr(Changes, "write", first_wait(write, "price_history", 2))
    monkeypatch.setattr(medallion, "stage", first_wait(stage, "daily", 1))
    changes = Changes(spark, str(tmp_path))
    changes.write(observations({}, {"asin": "B", "price": 20.0}), "products")
    metrics = run_gold(spark, f"{tmp_path}/products", str(tmp_path), RUN, changes=changes)
    assert metrics.rows_written["price_history"] == 2 and changes.dates(CARRY)


def test_a_run_from_a_date_on_copies_the_last_rows_alone(spark, tmp_path, monkeypatch):
    out, bronze, staged = str(tmp_path / "out"), str(tmp_path / "bronze"), {}
    land_files(bronze, objects(20, days=(1, 2, 3, 4)))
    run_silver(spark, bronze, out, RUN)
    valid = read_silver(spark, f"{out}/products").where("dq_status = 'VALID'")
    before = valid.where("scrape_date < '2026-04-03'").select("asin").distinct().count()
    days = valid.select("asin", "scrape_date").where("scrape_date >= '2026-04-03'").distinct().count()

    def stage(rows, name, owner, real=medallion.stage):
        kept = real(rows, name, owner)
        staged[name] = kept.count()
        return kept
    monkeypatch.setattr(medallion, "stage", stage)
    run_gold(spark, f"{out}/products", out, RUN, from_date=dt.date(2026, 4, 3))
    assert before and staged == {"last": before, "daily": before + days}


@pytest.mark.parametrize("late", [False, True])
def test_rows_of_new_dates_alone_are_held_against_nothing(spark, tmp_path, monkeypatch, late):
    out, joined, frame = str(tmp_path / "out"), [], type(spark.range(1))

    def join(self, other, on=None, how=None, real=frame.join):
        joined.extend([on] if "asin" in on else [])  # not the join of files with those read before
        return real(self, other, on, how)
    monkeypatch.setattr(frame, "join", join)
    for days in ((1, 2), (3, 4)):
        land_files(tmp_path / f"b{days[0]}", objects(40, days=days))
        run_silver(spark, str(tmp_path / f"b{days[0]}"), out, RUN, late=late)
    assert not joined and read_silver(spark, f"{out}/products").count() == 80
    run_silver(spark, str(tmp_path / "b3"), out, RUN, late=late)
    assert joined and read_silver(spark, f"{out}/products").count() == 80
