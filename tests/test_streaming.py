from conftest import RUN, counted
from shelfline.operators import changes
from shelfline.operators.standardize import standardize
from shelfline.schemas import FEEDS
from shelfline.sinks import snapshots
from shelfline.sources.bronze import read_bronze
from shelfline.sources.cdc import accepted, decode_cdc, read_cdc, stream_cdc
from shelfline.sources.silver import read_silver
from shelfline.streaming.changes import read_current, read_state, stream_changes
from shelfline.streaming.silver import stream_bronze, stream_silver
from test_changes import order_line, write_lines
from test_tables import land_files, objects

FEED = FEEDS["seller_orders"]
KEYS = list(FEED.keys)
VALUES = [name for name in FEED.columns.fieldNames() if name not in KEYS]
EARLIEST = list(FEED.keep_earliest)


def test_new_files_become_silver_once(spark, tmp_path):
    bronze, out, checkpoint = (str(tmp_path / name) for name in ("bronze", "out", "checkpoint"))

    def ingest():
        stream = stream_bronze(spark, bronze, files_per_batch=25)
        stream_silver(stream, out, checkpoint, RUN).awaitTermination()

    land_files(bronze, objects(40, days=(1, 2)))
    ingest()
    assert read_silver(spark, out).count() == 40
    land_files(tmp_path / "bronze", objects(20, days=(4, 5)))
    ingest()
    ingest()
    assert counted(read_silver(spark, out)) == counted(standardize(read_bronze(spark, bronze), RUN))


def test_streamed_log_equals_batch(spark, tmp_path):
    root, out, checkpoint = (str(tmp_path / name) for name in ("cdc", "out", "checkpoint"))
    first = [order_line(), order_line(op="U", status="confirmed", minute=3, price=""),
             order_line(key="O2"), order_line(key="O3", minute=1), order_line(title="Boat, Bar", key="O4")]
    # The second load deletes, brings late older changes and fills in what was empty.
    second = [order_line(op="D", key="O2", minute=5), order_line(op="U", key="O2", minute=4, status="shipped"),
              order_line(op="U", minute=2, status="late", price="1.25"), order_line(op="D", key="O3", minute=0)]

    def apply():
        log = accepted(decode_cdc(stream_cdc(spark, root, FEED, files_per_batch=2), FEED))
        stream_changes(log, out, checkpoint, KEYS, VALUES, keep_earliest=EARLIEST).awaitTermination()

    write_lines(root, FEED.table, first)
    apply()
    write_lines(f"{root}/public/{FEED.table}/more", FEED.table, second)
    apply()
    apply()
    batch = changes.apply_changes(None, accepted(decode_cdc(read_cdc(spark, root, FEED), FEED)), KEYS, VALUES,
                                  keep_earliest=EARLIEST)
    found = read_current(spark, out, KEYS, VALUES, keep_earliest=EARLIEST)
    assert counted(found) == counted(changes.current_rows(batch, KEYS, VALUES, keep_earliest=EARLIEST))
    rows = {r.order_id: r for r in found.collect()}
    assert set(rows) == {"O1", "O3"}
    assert (rows["O1"].order_status, float(rows["O1"].sale_price)) == ("confirmed", 1.25)
    assert read_state(spark, out, KEYS).count() == 3


def test_compacted_state_equals_the_batches(spark, tmp_path):
    root, out, checkpoint = (str(tmp_path / name) for name in ("cdc", "out", "checkpoint"))
    for load in range(6):
        write_lines(f"{root}/{load}", "seller_orders", [
            order_line(op="U" if load else "I", key=f"O{k}", status=f"s{load}", minute=load) for k in range(load, 5)])
        log = accepted(decode_cdc(stream_cdc(spark, f"{root}/*", "seller_orders"), "seller_orders"))
        stream_changes(log, out, checkpoint, KEYS, VALUES, keep_earliest=EARLIEST, compact_every=2).awaitTermination()
    rows = read_current(spark, out, KEYS, VALUES, keep_earliest=EARLIEST).collect()
    assert {(r.order_id, r.order_status) for r in rows} == {(f"O{k}", f"s{k}") for k in range(5)}
    assert list((tmp_path / "out").glob("base_*")) and len(list((tmp_path / "out").glob("batch_id=*"))) < 6


def test_snapshots_are_replaced_and_kept_for_readers(spark, tmp_path):
    path = str(tmp_path / "state")
    log = spark.createDataFrame([(k % 4, "U", k, k, f"v{k}") for k in range(12)],
                                "id int, op string, change_ts int, seq int, value string")
    for low in (0, 4, 8, 8):
        snapshots.apply_to_snapshot(log.where(f"seq >= {low} AND seq < {low + 4}"), path, ["id"], ["value"])
    assert snapshots.versions(spark, path) == [2, 3]
    (tmp_path / "state" / "snapshot=9").mkdir()  # a write that did not end
    rows = snapshots.read_rows(spark, path, ["id"], ["value"]).collect()
    assert {(r.id, r.value) for r in rows} == {(k, f"v{8 + k}") for k in range(4)}
