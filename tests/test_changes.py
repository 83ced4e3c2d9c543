import datetime as dt
import pathlib
import random
from decimal import Decimal

from pyspark.sql import functions as F

from conftest import RUN, counted
from shelfline.functions.columns import date_folder, file_stamp, iso_text, next_status, op_code, op_name
from shelfline.operators import changes, keyed
from shelfline.operators.changes import apply_changes, current_rows
from shelfline.schemas import FEEDS
from shelfline.sinks.tables import ROWS_PER_FILE, land_cdc
from shelfline.sources.cdc import accepted, decode_cdc, quarantined, read_cdc, read_cdc_all

LOG = "op string, change_ts timestamp, seq long, id string, a int, b string, made int"
KEYS, VALUES, FIRST = ["id"], ["a", "b", "made"], ["made"]


def ts(minute):
    return dt.datetime(2026, 4, 1, 10, minute)


def log(spark, *rows):
    return spark.createDataFrame([(op, ts(m), seq, key, a, b, made) for op, m, seq, key, a, b, made in rows], LOG)


def state_of(spark, frame):
    state = changes.apply_changes(None, frame, KEYS, VALUES, keep_earliest=FIRST)
    return {r.id: (r.a, r.b, r.made) for r in
            changes.current_rows(state, KEYS, VALUES, keep_earliest=FIRST).collect()}


def test_last_change_wins_and_null_keeps(spark):
    assert state_of(spark, log(spark, ("I", 1, 0, "x", 1, "p", 5), ("U", 2, 0, "x", None, "q", 7),
                               ("U", 2, 1, "x", 3, None, 6))) == {"x": (3, "q", 5)}


def test_deletion_forgets_values(spark):
    rows = [("I", 1, 0, "x", 1, "p", 5), ("D", 2, 0, "x", 9, "z", None)]
    assert state_of(spark, log(spark, *rows)) == {}
    assert state_of(spark, log(spark, *rows, ("I", 3, 0, "x", 4, None, 8))) == {"x": (4, None, 5)}
    # A late older change does not bring the key back.
    assert state_of(spark, log(spark, *rows, ("U", 1, 5, "x", 4, "w", 8))) == {}


def sequential(rows):
    """The log applied row by row."""
    live, made = {}, {}
    for op, _, _, key, a, b, m in sorted(rows, key=lambda r: (r[1], r[2])):
        if m is not None:
            made[key] = min(m, made.get(key, m))
        if op == "D":
            live.pop(key, None)
        else:
            old = live.get(key, (None, None))
            live[key] = (old[0] if a is None else a, old[1] if b is None else b)
    return {key: (*value, made.get(key)) for key, value in live.items()}


def random_log(seed, n=120):
    rng = random.Random(seed)
    return [(rng.choice("IUUUD"), rng.randrange(50), i, rng.choice("vwxyz"), rng.choice([None, 1, 2, 3]),
             rng.choice([None, "p", "q"]), rng.choice([None, 1, 2, 3])) for i in range(n)]


def test_fold_equals_applying_row_by_row_in_any_split(spark):
    for seed in range(3):
        rows = random_log(seed)
        assert state_of(spark, log(spark, *rows)) == sequential(rows)
        random.Random(seed).shuffle(rows)
        state = None
        for part in (rows[:40], rows[40:70], rows[70:], rows[:20]):
            state = changes.apply_changes(state, log(spark, *part), KEYS, VALUES, keep_earliest=FIRST)
        found = changes.current_rows(state, KEYS, VALUES, keep_earliest=FIRST)
        assert {r.id: (r.a, r.b, r.made) for r in found.collect()} == sequential(rows)


def test_insert_ignore_keeps_the_base_and_the_first(spark):
    base = spark.createDataFrame([("x", 1)], "id string, a int")
    new = spark.createDataFrame([("x", 9, 0), ("y", 2, 1), ("y", 3, 2)], "id string, a int, n int")
    once = keyed.insert_ignore(base, new, ["id"], ["n"])
    assert sorted(map(tuple, once.collect())) == [("x", 1), ("y", 2)]
    assert counted(keyed.insert_ignore(once, new, ["id"], ["n"])) == counted(once)


INVENTORY = "id string, title string, stock int, updated_at timestamp"


def test_update_sets_and_stamps_matches_only(spark):
    base = spark.createDataFrame([("x", "t", 1, ts(1)), ("y", "t", 1, ts(1))], INVENTORY)
    change = spark.createDataFrame([("x", 5, 0), ("x", 7, 1), ("z", 9, 0)], "id string, stock int, n int")
    found = keyed.update_by_key(base, change, ["id"], ["stock"], RUN, ["n"])
    assert sorted(map(tuple, found.collect())) == [("x", "t", 7, RUN), ("y", "t", 1, ts(1))]
    null = spark.createDataFrame([("x", None, 0)], "id string, stock int, n int")
    assert keyed.update_by_key(base, null, ["id"], ["stock"], RUN).where("id = 'x'").first().stock is None


def test_upsert_changes_a_subset_and_is_idempotent(spark):
    base = spark.createDataFrame([("x", "old", 1, ts(1))], INVENTORY)
    new = spark.createDataFrame([("x", "new", 5, ts(2)), ("y", "first", 6, ts(2))], INVENTORY)
    once = keyed.upsert(base, new, ["id"], ["stock"], RUN)
    assert sorted(map(tuple, once.collect())) == [("x", "old", 5, RUN), ("y", "first", 6, RUN)]
    assert counted(keyed.upsert(once, new, ["id"], ["stock"], RUN)) == counted(once)


def test_transitions(spark):
    steps = ["pending", "confirmed", "shipped", "delivered", "pending"]
    rows = [(("U"), i, 0, "x", None, s, None) for i, s in enumerate(steps)]
    rows += [("U", 0, 0, "y", None, "pending", None), ("U", 1, 0, "y", None, "delivered", None)]
    for size in (250_000, 1):
        found = changes.check_transitions(log(spark, *rows), ["id"], status="b", rows_per_piece=size)
        got = [(r.id, r.transition, r.next_status) for r in found.orderBy("id", "change_ts").collect()]
        assert got == [("x", "INITIAL", "confirmed"), ("x", "LEGAL", "shipped"), ("x", "LEGAL", "delivered"),
                       ("x", "LEGAL", None), ("x", "ILLEGAL", "confirmed"), ("y", "INITIAL", "confirmed"),
                       ("y", "ILLEGAL", None)]


def test_codes_and_texts(spark):
    row = spark.range(1).select(
        op_code(F.lit("insert")), op_code(F.lit("D")), op_name(F.lit("U")), next_status(F.lit("delivered")),
        date_folder(F.lit(ts(5))), file_stamp(iso_text(F.lit(ts(5))))).first()
    assert tuple(row) == ("I", "D", "update", None, "2026/04/01", "2026-04-01T10-05-00.000000+00-00")


def write_lines(root, table, lines):
    """One file per change, in folders by date, under changing names."""
    for i, line in enumerate(lines):
        folder = pathlib.Path(root) / "public" / table / "2026/04" / f"{i % 2 + 1:02d}"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"{'orders' if i % 3 else table}_{i}.csv").write_text(line)


def order_line(op="I", key="O1", title="Speaker", quantity="1", price="999.5", status="pending", minute=0):
    stamp = f"2026-04-01T10:{minute:02d}:00.000001+00:00"
    return (f"{op},{stamp},{key},A,{title},{quantity},{price},{status},Pune,Maharashtra,amazon_in,"
            f"{stamp},{stamp}")


def test_feed_is_decoded_and_bad_lines_are_set_apart(spark, tmp_path):
    write_lines(tmp_path, "seller_orders", [
        order_line(), order_line(op="U", status="confirmed", minute=1, price=""),
        order_line(title="Boat, Bar"), order_line(op="X"), order_line(quantity="many"),
        order_line(key=""), "U,2026", order_line(title='"Quoted, title"', key="O2")])
    decoded = decode_cdc(read_cdc(spark, str(tmp_path), "seller_orders"), "seller_orders")
    reasons = sorted(r.reject_reason for r in quarantined(decoded).collect())
    assert reasons == ["no key", "unknown operation", "value of a wrong type", "wrong number of values",
                       "wrong number of values"]
    good = accepted(decoded)
    # The lines stay apart whichever columns are read.
    assert good.select("op").count() == 3
    rows = {(r.order_id, r.op): r for r in good.collect()}
    assert rows["O1", "I"].sale_price == Decimal("999.50") and rows["O1", "U"].sale_price is None
    assert rows["O2", "I"].product_title == "Quoted, title"
    assert rows["O1", "I"].change_ts == dt.datetime(2026, 4, 1, 10, 0, 0, 1)


def test_empty_reorder_point_keeps_the_stored_one(spark, tmp_path):
    stamp = "2026-04-01T10:0{}:00+00:00"
    write_lines(tmp_path, "seller_inventory", [
        f"U,{stamp.format(0)},A,Speaker,90,25,0,{stamp.format(0)}",
        f"U,{stamp.format(1)},A,Speaker,80,,,{stamp.format(1)}"])
    tables = read_cdc_all(spark, str(tmp_path), ["seller_inventory"])
    assert list(tables) == ["seller_inventory"]
    feed = FEEDS["seller_inventory"]
    values = [name for name in feed.columns.fieldNames() if name not in feed.keys]
    log_rows = accepted(decode_cdc(tables["seller_inventory"], feed))
    row = changes.current_rows(changes.apply_changes(None, log_rows, feed.keys, values), feed.keys, values).first()
    assert (row.stock_quantity, row.reorder_point, row.unit_cost) == (80, 25, Decimal("0.00"))


def test_changes_of_one_time_go_from_insert_to_delete(spark, tmp_path):
    lines = []
    for k in range(20):
        lines += [order_line(op="D", key=f"D{k}"), order_line(op="U", key=f"D{k}", status="shipped"), order_line(key=f"D{k}"),
                  order_line(op="U", key=f"U{k}", status="shipped"), order_line(key=f"U{k}")]
    write_lines(tmp_path, "seller_orders", lines)
    feed = FEEDS["seller_orders"]
    keys = list(feed.keys)
    values = [name for name in feed.columns.fieldNames() if name not in keys]
    log = accepted(decode_cdc(read_cdc(spark, str(tmp_path), "seller_orders"), "seller_orders"))
    rows = current_rows(apply_changes(None, log, keys, values), keys, values).collect()
    assert {(r.order_id, r.order_status) for r in rows} == {(f"U{k}", "shipped") for k in range(20)}


def test_titles_may_hold_line_breaks(spark, tmp_path):
    title = 'two\nlines, "quoted"\r\nand more'
    rows = spark.createDataFrame([("O1", title)], "order_id string, product_title string")
    feed = FEEDS["seller_orders"]
    columns = [F.col(f.name) if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name)
               for f in feed.columns.fields]
    land_cdc(rows.select(F.lit("I").alias("op"), F.lit("2026-04-01").cast("timestamp").alias("change_ts"), *columns),
             str(tmp_path), feed)
    decoded = decode_cdc(read_cdc(spark, str(tmp_path), feed), feed)
    found = accepted(decoded).first().product_title
    assert quarantined(decoded).count() == 0 and found.replace("\r\n", "\n") == title.replace("\r\n", "\n")


def test_changes_of_one_time_go_by_their_lines(spark, tmp_path):
    feed = FEEDS["seller_orders"]
    values = [name for name in feed.columns.fieldNames() if name not in feed.keys]
    for load, order in enumerate((range(5), reversed(range(5, 9)))):
        folder = tmp_path / "public" / feed.table / "2026" / f"0{load}"
        folder.mkdir(parents=True)
        (folder / "log.csv").write_text("\n".join(order_line(op="U", key=key, status=f"s{n}") for n in order for key in ("O1", "O2")))
    for multi_line in (True, False):
        log = accepted(decode_cdc(read_cdc(spark, str(tmp_path), feed, multi_line=multi_line).repartition(3), feed))
        state = changes.apply_changes(None, log, list(feed.keys), values, keep_earliest=list(feed.keep_earliest))
        rows = changes.current_rows(state, list(feed.keys), values, keep_earliest=list(feed.keep_earliest)).collect()
        assert {(r.order_id, r.order_status) for r in rows} == {("O1", "s5"), ("O2", "s5")}


def test_no_file_of_a_landed_log_holds_more_than_its_rows(spark, tmp_path):
    feed = FEEDS["seller_orders"]
    rows = spark.range(2 * ROWS_PER_FILE + 1).select(
        F.lit("I").alias("op"), F.lit("2026-04-01").cast("timestamp").alias("change_ts"),
        *[(F.col("id") if f.name == "order_id" else F.lit(None)).cast(f.dataType).alias(f.name) for f in feed.columns.fields])
    assert land_cdc(rows, str(tmp_path), feed) == 2 * ROWS_PER_FILE + 1
    lines = spark.read.option("recursiveFileLookup", True).text(str(tmp_path)).groupBy(F.input_file_name()).count()
    counts = [row[1] for row in lines.collect()]
    assert sum(counts) == 2 * ROWS_PER_FILE + 1 and max(counts) <= ROWS_PER_FILE


def test_the_task_that_reads_a_whole_file_holds_no_rows(spark, tmp_path):
    write_lines(tmp_path, "seller_orders", [order_line(), order_line(op="U", status="shipped")])
    feed = FEEDS["seller_orders"]
    log = accepted(decode_cdc(read_cdc(spark, str(tmp_path), feed), feed))
    plan = changes.fold_changes(log, list(feed.keys), ["order_status"])._jdf.queryExecution().executedPlan().toString()
    reads = plan[plan.rindex("Exchange"):]
    assert "FileScan csv" in reads and "Sort" not in reads and "Aggregate" not in reads
    place = log.select("seq.at.file").first()[0]  # every value of a state has one
    assert not place.startswith("file:") and str(tmp_path) not in place
