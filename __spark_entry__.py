
from __future__ import annotations

import datetime as dt
import importlib
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline import fixed_values as fixed
from shelfline.operators import changes, gold, keyed, profiles, quality, reports, snapshots, standardize
from shelfline.functions.columns import date_folder, file_stamp, iso_text, op_code, op_name
from shelfline.plans import medallion
from shelfline.schemas import FEEDS, GOLD, PAYLOAD, SILVER
from shelfline.session import fresh_path
from shelfline.sinks import buckets as bucket_sink
from shelfline.sinks import snapshots as snapshot_sink
from shelfline.sinks import tables as sinks
from shelfline.sinks.versions import Changes
from shelfline.sources import bronze, cdc, silver as silver_source, supplied
from shelfline.streaming import changes as change_stream
from shelfline.streaming import silver as silver_stream

PRODUCT = supplied.PRODUCT
table = supplied.table
RUN = dt.datetime(2024, 2, 1)
FROM = dt.date(2024, 1, 15)
SMALL = 1000  # rows of a piece: nearly every series is cut
ORDERS = FEEDS["seller_orders"]
KEYS = list(ORDERS.keys)
VALUES = [name for name in ORDERS.columns.fieldNames() if name not in KEYS]
EARLIEST = list(ORDERS.keep_earliest)
STAMPS = ("processed_at", gold.STAMP)


# ---------------------------------------------------------------- inputs

def raw(spark: SparkSession, sf: str) -> DataFrame:
    return supplied.event_observations(spark, sf)


def silver(spark: SparkSession, sf: str) -> DataFrame:
    return standardize.standardize(raw(spark, sf), RUN, columns=PRODUCT, source_system="synthetic")


def valid(spark: SparkSession, sf: str) -> DataFrame:
    return standardize.quality_gate(silver(spark, sf), columns=PRODUCT)


def daily(spark: SparkSession, sf: str) -> DataFrame:
    return snapshots.daily_latest(valid(spark, sf), columns=PRODUCT)


def line_valid(spark: SparkSession, sf: str) -> DataFrame:
    rows = standardize.standardize(supplied.line_observations(spark, sf), RUN, columns=PRODUCT,
                                   source_system="lines")
    return standardize.quality_gate(rows, columns=PRODUCT)


def line_daily(spark: SparkSession, sf: str) -> DataFrame:
    return snapshots.daily_latest(line_valid(spark, sf), columns=PRODUCT)


def history(spark: SparkSession, sf: str) -> DataFrame:
    return gold.price_history(valid(spark, sf), RUN, columns=PRODUCT)


def ranking(spark: SparkSession, sf: str) -> DataFrame:
    return gold.competitor_ranking(daily(spark, sf), RUN, columns=PRODUCT)


# ---------------------------------------------------------------- queries

def silver_standardized(spark, sf):
    return silver(spark, sf).drop(*STAMPS)


def dq_status_counts(spark, sf):
    return standardize.status_counts(silver(spark, sf), columns=PRODUCT)


def dq_status_summary(spark, sf):
    return standardize.status_summary(silver(spark, sf), columns=PRODUCT)


def _pillar(name: str, **options):
    def query(spark, sf):
        report = quality.quality_report(raw(spark, sf), columns=PRODUCT, pillars=[name], **options)
        if name != "accuracy":
            return report
        # A mean of doubles may differ in its last digits with the order of the rows.
        return report.withColumns({mean: F.round(mean, 6) for mean in ("avg_price", "avg_rating")})
    return query


def dq_overall(spark, sf):
    report = quality.quality_report(raw(spark, sf), columns=PRODUCT, price_bounds=(20, 200))
    return quality.quality_score(report).select(
        *[f"{pillar}_score" for pillar in fixed.PILLAR_WEIGHTS],
        F.round("overall_score", 6).alias("overall_score"))


def constraint_check(spark, sf):
    return quality.check_constraints(supplied.order_changes(spark, sf), KEYS,
                                     ["product_title", "sale_price"])


def product_price_summary(spark, sf):
    return gold.product_price_summary(silver(spark, sf), columns=PRODUCT)


def most_scraped(spark, sf):
    return reports.most_scraped(silver(spark, sf), columns=PRODUCT)


def price_history(spark, sf):
    return history(spark, sf).drop(*STAMPS)


def price_history_skewsafe(spark, sf):
    return gold.price_history(valid(spark, sf), RUN, columns=PRODUCT, rows_per_piece=SMALL).drop(*STAMPS)


def price_history_from_date(spark, sf):
    recent = medallion.with_last_before(valid(spark, sf), FROM, PRODUCT)
    return (gold.price_history(recent, RUN, columns=PRODUCT)
            .where(F.col("scrape_date") >= F.lit(FROM)).drop(*STAMPS))


def price_changes(spark, sf):
    return reports.price_changes(history(spark, sf), columns=PRODUCT)


def top_price_moves(spark, sf):
    return reports.top_price_moves(history(spark, sf), columns=PRODUCT)


def daily_latest(spark, sf):
    return daily(spark, sf).drop(*STAMPS)


def competitor_ranking(spark, sf):
    return ranking(spark, sf).drop(*STAMPS)


def competitor_ranking_skewsafe(spark, sf):
    return gold.competitor_ranking(daily(spark, sf), RUN, columns=PRODUCT, rows_per_piece=SMALL).drop(*STAMPS)


def competitor_ranking_from_date(spark, sf):
    """The later dates ranked anew, following what was written for the earlier ones."""
    snapshot, later = daily(spark, sf), F.col("scrape_date") >= F.lit(FROM)
    written = gold.competitor_ranking(snapshot.where(~later), RUN, columns=PRODUCT)
    return gold.competitor_ranking(snapshot.where(later), RUN, ranked_before=written,
                                   columns=PRODUCT).drop(*STAMPS)


def ranking_by_category(spark, sf):
    return reports.ranking_by_category(ranking(spark, sf), columns=PRODUCT)


def cheapest_products(spark, sf):
    return reports.cheapest_products(ranking(spark, sf), columns=PRODUCT)


def review_trend(spark, sf):
    return gold.review_trend(daily(spark, sf), RUN, columns=PRODUCT).drop(*STAMPS)


def stock_gap(spark, sf):
    return gold.stock_gap(valid(spark, sf), RUN, columns=PRODUCT).drop(*STAMPS)


def stock_gap_counts(spark, sf):
    return reports.stock_gap_counts(gold.stock_gap(valid(spark, sf), RUN, columns=PRODUCT))


def market_summary(spark, sf):
    return gold.market_summary(daily(spark, sf), RUN, columns=PRODUCT).drop(*STAMPS)


def market_report(spark, sf):
    return reports.market_report(gold.market_summary(daily(spark, sf), RUN, columns=PRODUCT),
                                 columns=PRODUCT)


def line_price_history(spark, sf):
    return gold.price_history(line_valid(spark, sf), RUN, columns=PRODUCT).drop(*STAMPS)


def line_competitor_ranking(spark, sf):
    return gold.competitor_ranking(line_daily(spark, sf), RUN, columns=PRODUCT).drop(*STAMPS)


def line_review_trend(spark, sf):
    return gold.review_trend(line_daily(spark, sf), RUN, columns=PRODUCT).drop(*STAMPS)


def line_stock_gap(spark, sf):
    return gold.stock_gap(line_valid(spark, sf), RUN, columns=PRODUCT).drop(*STAMPS)


def payload_flatten(spark, sf):
    nested = raw(spark, sf).select("product_id", "scraped_at", F.struct(
        "title", "rating", F.col("reviews_count").alias("ratings_total"),
        F.when(F.col("price").isNotNull() | F.col("in_stock").isNotNull(), F.struct(
            F.struct(F.col("price").alias("value")).alias("price"),
            F.struct(F.col("in_stock").alias("type")).alias("availability"))).alias("buybox_winner"),
        F.when(F.col("price") > 30, F.array(F.struct(F.col("category").alias("name")))).alias("categories"),
    ).cast(PAYLOAD).alias("product"))
    time = F.to_timestamp_ntz(F.substring("scraped_at", 1, 26)).cast("timestamp")
    return bronze.flatten_payload(nested, key="product_id", scraped_at=time, source="synthetic")


def _order_view(rows: DataFrame, *further) -> DataFrame:
    """An order with dates for times, which engines print differently."""
    return rows.select("order_id", "asin", "product_title", "quantity",
                       F.col("sale_price").cast("double").alias("sale_price"), "order_status",
                       "marketplace", F.to_date("created_at").alias("created_on"), *further)


def cdc_last_change(spark, sf):
    return _order_view(changes.last_change(supplied.order_changes(spark, sf), KEYS), "op", "seq")


def cdc_current_state(spark, sf):
    state = changes.apply_changes(None, supplied.order_changes(spark, sf), KEYS, VALUES,
                                  keep_earliest=EARLIEST)
    return _order_view(changes.current_rows(state, KEYS, VALUES, keep_earliest=EARLIEST))


def cdc_state_in_steps(spark, sf):
    """The log in two parts, the later one first."""
    log = supplied.order_changes(spark, sf)
    late = F.col("change_ts") >= F.lit("1998-01-01").cast("timestamp")
    state = changes.apply_changes(None, log.where(late), KEYS, VALUES, keep_earliest=EARLIEST)
    state = changes.apply_changes(state, log.where(~late), KEYS, VALUES, keep_earliest=EARLIEST)
    return _order_view(changes.current_rows(state, KEYS, VALUES, keep_earliest=EARLIEST))


def _order_base(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Orders as they stand after the changes of even number, and the changes of odd number."""
    log = supplied.order_changes(spark, sf)
    even = F.col("seq") % 2 == 0
    return snapshots.latest_per(log.where(even), KEYS, ["change_ts"]), log.where(~even)


def cdc_insert_ignore(spark, sf):
    base, new = _order_base(spark, sf)
    return _order_view(keyed.insert_ignore(base, new, KEYS, ["change_ts"]))


def cdc_update(spark, sf):
    base, new = _order_base(spark, sf)
    updated = keyed.update_by_key(base, new, KEYS, ["order_status"], RUN, ["change_ts"])
    return _order_view(updated, F.to_date("updated_at").alias("updated_on"))


def cdc_upsert(spark, sf):
    return keyed.upsert(
        supplied.part_inventory(spark, sf), supplied.line_deliveries(spark, sf), ["product_id"],
        ["stock_quantity"], RUN,
        ["l_shipdate", "l_orderkey", "reorder_point", "unit_cost"]).withColumn(
        "updated_on", F.to_date("updated_at")).drop("updated_at")


def cdc_transitions(spark, sf):
    return changes.check_transitions(supplied.order_changes(spark, sf), KEYS).select(
        "order_id", "seq", "previous_status", "order_status", "next_status", "transition")


def cdc_transitions_skewsafe(spark, sf):
    return changes.check_transitions(supplied.order_changes(spark, sf), KEYS, rows_per_piece=SMALL).select(
        "order_id", "seq", "previous_status", "order_status", "next_status", "transition")


def _landed_orders(spark, sf) -> str:
    root = fresh_path(spark, "cdc")
    sinks.land_cdc(supplied.order_changes(spark, sf), root, "seller_orders", folder="yyyy")
    return root


def cdc_log_roundtrip(spark, sf):
    """The change log written as CSV, read back, decoded and applied."""
    lines = cdc.read_cdc_all(spark, _landed_orders(spark, sf), ["seller_orders"])["seller_orders"]
    log = cdc.accepted(cdc.decode_cdc(lines, "seller_orders"))
    state = changes.apply_changes(None, log, KEYS, VALUES, keep_earliest=EARLIEST)
    return _order_view(changes.current_rows(state, KEYS, VALUES, keep_earliest=EARLIEST))


def cdc_snapshot_in_loads(spark, sf):
    """The log applied to a state on disk in three loads, one of them twice."""
    log, path = supplied.order_changes(spark, sf), fresh_path(spark, "snapshot")
    for k in (1, 0, 0, 2):
        snapshot_sink.apply_to_snapshot(log.where(F.col("seq") % 3 == k), path, KEYS, VALUES, keep_earliest=EARLIEST)
    return _order_view(snapshot_sink.read_rows(spark, path, KEYS, VALUES, keep_earliest=EARLIEST))


def inventory_log_roundtrip(spark, sf):
    """Stock changes written as CSV and applied: titles over two lines, an update without reorder point, and an
    insert, an update and for some parts a delete at one time."""
    feed = FEEDS["seller_inventory"]
    parts = table(spark, sf, "part").select(
        F.col("p_partkey").cast("string").alias("asin"), F.concat("p_name", F.lit("\n2nd line, \"quoted\"")).alias("product_title"),
        F.col("p_size").cast("int").alias("stock_quantity"), F.col("p_size").cast("int").alias("reorder_point"),
        F.col("p_retailprice").cast("decimal(10,2)").alias("unit_cost"),
        F.lit("2024-01-01").cast("timestamp").alias("updated_at"), "p_partkey")
    at = F.lit("2024-01-01 10:00:00").cast("timestamp")
    first = parts.withColumns({"op": F.lit("I"), "change_ts": at})
    second = parts.withColumns({"op": F.lit("U"), "change_ts": at, "stock_quantity": F.col("stock_quantity") + 1,
                                "reorder_point": F.lit(None).cast("int")})
    third = parts.where("p_partkey % 7 = 0").withColumns({"op": F.lit("D"), "change_ts": at})
    root = fresh_path(spark, "cdc")
    sinks.land_cdc(third.unionByName(second).unionByName(first), root, feed)
    log = cdc.accepted(cdc.decode_cdc(cdc.read_cdc(spark, root, feed), feed))
    keys = list(feed.keys)
    values = [name for name in feed.columns.fieldNames() if name not in keys]
    state = changes.apply_changes(None, log, keys, values, keep_earliest=list(feed.keep_earliest))
    return changes.current_rows(state, keys, values, keep_earliest=list(feed.keep_earliest)).select(
        F.col("asin").cast("bigint").alias("product_id"), "product_title", "stock_quantity", "reorder_point")


def cdc_log_of_one_time(spark, sf):
    """Order lines as updates of their order, all of one time: the last line of the log decides."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.concat_ws(
        ",", F.lit("U"), F.lit("2024-01-01T10:00:00.000000+00:00"), "l_orderkey", "l_partkey", F.lit("t"), F.col("l_quantity").cast("int"),
        F.lit("1.50"), F.concat(F.lit("s"), "l_linenumber"), F.lit("c"), F.lit("st"), F.lit("m"), F.lit(""), F.lit("")).alias("value"))
    root = fresh_path(spark, "cdc")
    # files by order, the lines of an order one after another
    (lines.repartitionByRange(8, "l_orderkey").sortWithinPartitions("l_orderkey", "l_linenumber", "value").select("value")
     .write.text(f"{root}/public/seller_orders/2024/01/01"))
    log = cdc.accepted(cdc.decode_cdc(cdc.read_cdc(spark, root, "seller_orders", multi_line=False), "seller_orders"))
    state = changes.apply_changes(None, log, KEYS, VALUES, keep_earliest=EARLIEST)
    return changes.current_rows(state, KEYS, VALUES, keep_earliest=EARLIEST).select(
        F.col("order_id").cast("bigint").alias("order_id"), F.col("asin").cast("bigint").alias("product_id"), "quantity", "order_status")


def stream_cdc_state(spark, sf):
    lines = cdc.stream_cdc(spark, _landed_orders(spark, sf), "seller_orders")
    log = cdc.accepted(cdc.decode_cdc(lines, "seller_orders"))
    out = fresh_path(spark, "state")
    change_stream.stream_changes(log, out, fresh_path(spark, "checkpoint"), KEYS, VALUES,
                                 keep_earliest=EARLIEST).awaitTermination()
    return _order_view(change_stream.read_current(spark, out, KEYS, VALUES, keep_earliest=EARLIEST))


def _landed_raw(spark, sf) -> str:
    path = fresh_path(spark, "raw")
    rows = raw(spark, sf).withColumnRenamed("product_id", "asin").drop("event_id")
    sinks.land_raw(rows, path)
    return path


def _as_product(rows: DataFrame) -> DataFrame:
    return rows.withColumn("asin", F.col("asin").cast("bigint")).withColumnRenamed("asin", "product_id")


def raw_landing_roundtrip(spark, sf):
    landed = bronze.read_bronze(spark, _landed_raw(spark, sf), multi_line=False)
    return _as_product(landed).withColumns({
        "price": F.col("price").cast("double"), "rating": F.col("rating").cast("double"),
        "reviews_count": F.col("reviews_count").cast("bigint")}).select(*supplied.OBSERVATION)


def silver_write_roundtrip(spark, sf):
    """Silver written twice and read back: the second write replaces the first."""
    path = fresh_path(spark, "silver")
    rows = standardize.standardize(
        raw(spark, sf).withColumn("asin", F.col("product_id").cast("string")), RUN,
        source_system="synthetic")
    for _ in range(2):
        sinks.write_table(rows, path)
    return _as_product(silver_source.read_silver(spark, path)).drop(*STAMPS)


def stream_silver(spark, sf):
    out = f"{fresh_path(spark, 'run')}/products"
    landed = silver_stream.stream_bronze(spark, _landed_raw(spark, sf), multi_line=False)
    silver_stream.stream_silver(landed, out, fresh_path(spark, "checkpoint"), RUN,
                                source_system="synthetic").awaitTermination()
    return _as_product(silver_source.read_silver(spark, out)).drop(*STAMPS)


def catalog_sql_report(spark, sf):
    """Silver in a catalog table, reported on from SQL text."""
    rows = standardize.standardize(
        raw(spark, sf).withColumn("asin", F.col("product_id").cast("string")), RUN)
    name = _catalog_table(spark)
    sinks.write_catalog_table(rows, name)
    report = spark.sql(f"""
        SELECT CAST(asin AS BIGINT) AS product_id, MIN(price) AS min_price, MAX(price) AS max_price,
               ROUND(AVG(price), 2) AS avg_price, MAX(price) - MIN(price) AS price_range,
               COUNT(*) AS total_scrapes, MAX(scrape_date) AS latest_scrape
        FROM {name} GROUP BY asin ORDER BY total_scrapes DESC, product_id LIMIT 20""")
    return _without_table(report, name)


def _catalog_table(spark: SparkSession) -> str:
    """An empty Silver table in the catalog, its files in the shared folder."""
    name = f"products_{uuid.uuid4().hex}"
    sinks.ensure_table(spark, name, SILVER, "scrape_date", location=fresh_path(spark, "products"))
    return name


def _without_table(result: DataFrame, name: str) -> DataFrame:
    """The result, staged, so that the table it came from can leave the catalog."""
    spark, path = result.sparkSession, fresh_path(result.sparkSession, "result")
    result.write.parquet(path)
    spark.sql(f"DROP TABLE {name}")
    return spark.read.schema(result.schema).parquet(path)


def catalog_schema_merge(spark, sf):
    """Rows with a further column appended to a catalog table that lacks it."""
    rows = standardize.standardize(raw(spark, sf).withColumn("asin", F.col("product_id").cast("string")), RUN)
    name = _catalog_table(spark)
    even = F.col("asin").cast("bigint") % 2 == 0
    sinks.write_catalog_table(rows.where(even).drop("rating"), name, overwrite=False)
    sinks.write_catalog_table(rows.where(~even).withColumn("seller", F.concat(F.lit("s"), "asin")), name, overwrite=False)
    return _without_table(_as_product(spark.table(name)).select("product_id", "rating", "seller", "scraped_at"), name)


def catalog_widened(spark, sf):
    """Whole numbers and then wider ones in one column of a catalog table."""
    name = f"widened_{uuid.uuid4().hex}"
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_quantity").cast("int").alias("n"), F.trunc("l_shipdate", "year").alias("scrape_date"))
    even = F.col("l_orderkey") % 2 == 0
    sinks.ensure_table(spark, name, lines.schema, "scrape_date", location=fresh_path(spark, "widened"))
    sinks.write_catalog_table(lines.where(even), name, overwrite=False)
    sinks.write_catalog_table(lines.where(~even).withColumn("n", F.col("n") + F.lit(3_000_000_000)), name, overwrite=False)
    return _without_table(spark.table(name).groupBy("scrape_date").agg(F.count(F.lit(1)).alias("lines"), F.sum("n").alias("total")), name)


def two_stage_run(spark, sf):
    """Landed JSON to Silver to Gold; the ranking as written."""
    out = fresh_path(spark, "run")
    medallion.run(spark, _landed_raw(spark, sf), out, RUN, multi_line=False)
    written = silver_source.read_table(spark, f"{out}/competitor_ranking", GOLD["competitor_ranking"])
    return _as_product(written).drop(*STAMPS)


def _gold_digest(spark: SparkSession, out: str) -> DataFrame:
    """Every row and column of the five Gold tables as written; columns a table lacks are NULL."""
    parts = []
    for name, schema in GOLD.items():
        rows = silver_source.read_table(spark, f"{out}/{name}", schema).drop(*STAMPS)
        parts.append((_as_product(rows) if "asin" in rows.columns else rows).withColumn("table_name", F.lit(name)))
    return reduce(lambda one, other: one.unionByName(other, allowMissingColumns=True), parts)


DAY = dt.date(2024, 1, 17)


def _raw_rows(spark, sf) -> DataFrame:
    return raw(spark, sf).withColumnRenamed("product_id", "asin").drop("event_id")


def gold_all_tables(spark, sf):
    """All five Gold tables of a run as written."""
    out = fresh_path(spark, "run")
    medallion.run(spark, _landed_raw(spark, sf), out, RUN, multi_line=False)
    return _gold_digest(spark, out)


def _corrected(spark, sf, from_date: dt.date | None) -> DataFrame:
    """A run, then a day landed again without its prices, and a second run."""
    out, path = fresh_path(spark, "run"), _landed_raw(spark, sf)
    medallion.run(spark, path, out, RUN, multi_line=False)
    day = _raw_rows(spark, sf).where(F.col("scraped_at").startswith(str(DAY)))
    sinks.land_raw(day.withColumn("price", F.lit(None).cast("double")), path, mode="overwrite")
    medallion.run(spark, path, out, RUN, multi_line=False, from_date=from_date)
    return _gold_digest(spark, out)


def gold_after_corrected_day(spark, sf):
    return _corrected(spark, sf, None)


def gold_from_corrected_day(spark, sf):
    """The second run from that day on only."""
    return _corrected(spark, sf, DAY)


def gold_first_run_from_date(spark, sf):
    """A first run that begins at a date, with nothing written before."""
    out = fresh_path(spark, "run")
    medallion.run(spark, _landed_raw(spark, sf), out, RUN, multi_line=False, from_date=FROM)
    return _gold_digest(spark, out)


def silver_after_late_file(spark, sf):
    """Silver of two thirds of the products, then a late file with the rest of all its dates."""
    out = fresh_path(spark, "run")
    late = F.col("asin") % 3 == 0
    for rows, is_late in ((_raw_rows(spark, sf).where(~late), False), (_raw_rows(spark, sf).where(late), True)):
        path = fresh_path(spark, "raw")
        sinks.land_raw(rows, path)
        medallion.run_silver(spark, path, out, RUN, multi_line=False, late=is_late, source_system="synthetic")
    return _as_product(silver_source.read_silver(spark, f"{out}/products")).drop(*STAMPS)


def silver_undated_rows(spark, sf):
    """Two runs of different dates, each with rows whose time gives no date: those of the first stay."""
    out = fresh_path(spark, "run")
    rows = _raw_rows(spark, sf)
    early, unknown = F.col("scraped_at") < F.lit(str(FROM)), F.col("asin") % 4 == 0
    for part in (early, ~early):
        path = fresh_path(spark, "raw")
        sinks.land_raw(rows.where(part).withColumn(
            "scraped_at", F.when(unknown, F.concat(F.lit("unknown "), "scraped_at")).otherwise(F.col("scraped_at"))), path)
        medallion.run_silver(spark, path, out, RUN, multi_line=False, source_system="synthetic")
    return _as_product(silver_source.read_silver(spark, f"{out}/products")).drop(*STAMPS)


def silver_stream_then_batch(spark, sf):
    """One Silver table written by a stream, by a batch run of later dates, and by the stream again for products that come late."""
    out, landed, checkpoint = (fresh_path(spark, name) for name in ("run", "raw", "checkpoint"))
    rows = _raw_rows(spark, sf)
    early, late = F.col("scraped_at") < F.lit(str(FROM)), F.col("asin") % 3 == 0

    def stream() -> None:
        silver_stream.stream_silver(silver_stream.stream_bronze(spark, landed, multi_line=False), f"{out}/products", checkpoint, RUN,
                                    source_system="synthetic").awaitTermination()
    sinks.land_raw(rows.where(early & ~late), landed)
    stream()
    path = fresh_path(spark, "raw")
    sinks.land_raw(rows.where(~early), path)
    medallion.run_silver(spark, path, out, RUN, multi_line=False, source_system="synthetic")
    sinks.land_raw(rows.where(early & late), landed)
    stream()
    return _as_product(silver_source.read_silver(spark, f"{out}/products")).drop(*STAMPS)


def gold_by_successive_runs(spark, sf):
    """A run of the first dates, then two that read their own dates and the state carried from the run before."""
    out, path = fresh_path(spark, "run"), fresh_path(spark, "raw")
    rows, day = _raw_rows(spark, sf), F.substring("scraped_at", 1, 10)
    steps = [None, FROM, FROM + dt.timedelta(days=9)]
    for low, high in zip(steps, [*steps[1:], None]):
        sinks.land_raw(rows.where((day >= str(low)) if low else F.lit(True)).where((day < str(high)) if high else F.lit(True)), path)
        medallion.run(spark, path, out, RUN, multi_line=False, from_date=low)
    return _gold_digest(spark, out)


def bronze_quarantine(spark, sf):
    """Landed records of which every eleventh breaks off: the rejects by their text, and the Silver rows by product."""
    path, out = fresh_path(spark, "raw"), fresh_path(spark, "run")
    rows = _raw_rows(spark, sf).select(F.to_json(F.struct("*")).alias("whole"), "asin", "scraped_at")
    text = F.when(F.col("asin") % 11 == 0, F.concat(F.lit('{"asin": "'), "asin", F.lit('", "price": '))).otherwise(F.col("whole"))
    rows.select(text.alias("value")).write.text(path)
    medallion.run_silver(spark, path, out, RUN, multi_line=False)
    found = Changes(spark, out)
    rejects = found.read(medallion.REJECTS, medallion.REJECT_SCHEMA).select(F.lit("reject").alias("kind"), F.col("text").alias("value"))
    kept = found.read(medallion.PRODUCTS, SILVER).select(F.lit("silver").alias("kind"), F.col("asin").alias("value"))
    return rejects.unionByName(kept).groupBy("kind", "value").agg(F.count(F.lit(1)).alias("n"))


def silver_new_files_only(spark, sf):
    """Four runs that take new files alone: the first dates, nothing new, later dates and files that come late, nothing new."""
    path, out = fresh_path(spark, "raw"), fresh_path(spark, "run")
    rows = _raw_rows(spark, sf)
    first = (F.col("scraped_at") < F.lit(str(FROM))) & (F.col("asin") % 3 > 0)
    for part in (first, ~first):
        sinks.land_raw(rows.where(part), path)
        for _ in range(2):
            medallion.run_silver(spark, path, out, RUN, multi_line=False, new_only=True, source_system="synthetic")
    return _as_product(silver_source.read_silver(spark, f"{out}/products")).drop(*STAMPS)


def stream_stock_gap(spark, sf):
    """The last valid row of each product kept by a stream over files that arrive in two parts, the later dates first."""
    path, out, checkpoint = (fresh_path(spark, name) for name in ("raw", "last", "checkpoint"))
    early = F.col("scraped_at") < F.lit(str(FROM))
    for part in (~early, early):
        sinks.land_raw(_raw_rows(spark, sf).where(part), path)
        landed = silver_stream.stream_bronze(spark, path, multi_line=False)
        silver_stream.stream_current(standardize.standardize(landed, RUN), out, checkpoint).awaitTermination()
    return _as_product(gold.stock_gap(silver_stream.read_last(spark, out), RUN)).drop(*STAMPS)


def dq_from_date_sketches(spark, sf):
    """Counts of halves of the time from stored profiles of dates, and whether each distinct count is within three standard errors."""
    path = fresh_path(spark, "profiles")
    rows = silver(spark, sf)
    profiles.date_profiles(rows, columns=PRODUCT).write.parquet(path)
    half = (F.col("scrape_date") < F.lit(FROM)).alias("early")
    merged = profiles.merge_profiles(spark.read.parquet(path), [half], columns=PRODUCT)
    exact = rows.groupBy(half).agg(F.count_distinct("product_id", "scraped_at").alias("exact_records"),
                                   F.count_distinct("product_id").alias("exact_products"))
    near = lambda kind: F.abs(F.col(f"distinct_{kind}") - F.col(f"exact_{kind}")) <= 3 * profiles.error_of() * F.col(f"exact_{kind}")
    return merged.join(exact, "early").select(
        "early", "total_records", "null_price", "null_rating", "exact_records", "exact_products",
        near("records").alias("records_within"), near("products").alias("products_within"))


def cdc_buckets_in_loads(spark, sf):
    """The log applied to state in buckets in three loads, one of them twice."""
    log, path = supplied.order_changes(spark, sf), fresh_path(spark, "buckets")
    for k in (1, 0, 0, 2):
        bucket_sink.apply_to_buckets(log.where(F.col("seq") % 3 == k), path, KEYS, VALUES, keep_earliest=EARLIEST, buckets=16)
    return _order_view(bucket_sink.read_rows(log, path, KEYS, VALUES, keep_earliest=EARLIEST))


def multi_line_bronze(spark, sf):
    """One object per file, over several lines of text: a supplier as an observation."""
    path = fresh_path(spark, "raw")
    rows = table(spark, sf, "supplier").select(
        F.col("s_suppkey").cast("string").alias("asin"), F.concat("s_name", F.lit("\n")).alias("title"),
        F.col("s_acctbal").alias("price"), F.lit("2024-01-01T00:00:00.000000+00:00").alias("scraped_at"))
    text = F.to_json(F.struct("*"), {"pretty": "true"})
    sinks.land_texts(rows.select(text.alias("value")), path)
    found = bronze.read_bronze(spark, path)
    return found.select(F.col("asin").cast("bigint").alias("product_id"), "title",
                        F.col("price").cast("double").alias("price"), "scraped_at")


def whole_numbers(spark, sf):
    """reviews_count landed as a whole number, with a fraction, with an exponent, as text that is none."""
    k = F.col("l_linenumber") % 5
    count = F.col("l_quantity").cast("int")
    shape = (F.when(k == 0, count.cast("string")).when(k == 1, F.concat(count.cast("string"), F.lit(".0")))
             .when(k == 2, F.concat(count.cast("string"), F.lit(".75")))
             .when(k == 3, F.concat(count.cast("string"), F.lit("e1"))).otherwise(F.lit("9e99")))
    path = fresh_path(spark, "raw")
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.concat(
        F.lit('{"asin": "'), F.col("l_orderkey").cast("string"), F.lit('", "title": "'),
        F.col("l_linenumber").cast("string"), F.lit('", "reviews_count": '), shape, F.lit("}")).alias("value"))
    lines.select("value").write.text(path)
    rows = standardize.standardize(bronze.read_bronze(spark, path, multi_line=False), RUN)
    return rows.groupBy(F.col("asin").cast("bigint").alias("order_key"), F.col("title").cast("int").alias("line")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("reviews_count").alias("reviews"))


def table_row_counts(spark, sf):
    """Rows of the tables a run has written, counted, beside the number each write returned."""
    out = fresh_path(spark, "run")
    metrics = medallion.run(spark, _landed_raw(spark, sf), out, RUN, multi_line=False)
    counts = reports.table_counts({name: silver_source.read_table(spark, f"{out}/{name}", GOLD[name]) for name in GOLD})
    return spark.createDataFrame([(n, counts[n], metrics.rows_written[n]) for n in sorted(counts)],
                                 "table_name string, counted long, written long")


def published_report(spark, sf):
    """A report by name on the catalog table it belongs to."""
    out, database = fresh_path(spark, "run"), f"shelf_{uuid.uuid4().hex}"
    medallion.run(spark, _landed_raw(spark, sf), out, RUN, multi_line=False)
    medallion.publish(spark, out, database)
    found = _as_product(reports.run_report(spark, "product_prices", database))
    path = fresh_path(spark, "result")
    found.write.parquet(path)
    spark.sql(f"DROP DATABASE {database} CASCADE")
    return spark.read.schema(found.schema).parquet(path)


def order_key_listing(spark, sf):
    """Keys with their columns, and the names of operation codes and back, file and folder names of a time."""
    log = supplied.order_changes(spark, sf).withColumns({
        "op_name": op_name("op"), "op_again": op_code(F.upper(op_name("op"))), "op_same": op_code("op"),
        "stamp": file_stamp(iso_text("created_at")), "folder": date_folder("created_at")})
    return reports.key_listing(log, ["order_id", "seq"], ["op_name", "op_again", "op_same", "stamp", "folder"])


def inventory_defaults(spark, sf):
    """Missing stock figures replaced by the table's defaults."""
    rows = table(spark, sf, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.when(F.col("p_size") > 10, F.col("p_size")).cast("int").alias("stock_quantity"),
        F.when(F.col("p_partkey") % 3 > 0, F.col("p_size")).cast("int").alias("reorder_point"))
    return quality.apply_defaults(rows, fixed.INVENTORY_DEFAULTS)


def dq_displayed(spark, sf):
    """The quality scores as a printed report shows them."""
    return quality.rounded(dq_overall(spark, sf), 1)


def run_time_stamp(spark, sf):
    """The stamp of a run with a fixed time, on every row."""
    return silver(spark, sf).groupBy(F.date_format("processed_at", "yyyy-MM-dd HH:mm:ss").alias("processed")).agg(
        F.count(F.lit(1)).alias("n"))


PILLARS = {
    "completeness": {}, "validity": {"price_bounds": (20, 200)}, "uniqueness": {},
    "consistency": {"expected_products": 150}, "accuracy": {"price_bounds": (20, 200)}, "timeliness": {},
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """One entry per operator; each takes (spark, sf_dir)."""
    named = [
        gold_all_tables, gold_after_corrected_day, gold_from_corrected_day, gold_first_run_from_date,
        silver_after_late_file, silver_undated_rows, silver_stream_then_batch, gold_by_successive_runs, bronze_quarantine,
        silver_new_files_only, stream_stock_gap, dq_from_date_sketches, cdc_buckets_in_loads, catalog_widened, catalog_schema_merge, multi_line_bronze, whole_numbers, table_row_counts,
        published_report, cdc_snapshot_in_loads, inventory_log_roundtrip, order_key_listing, inventory_defaults, dq_displayed, run_time_stamp,
        silver_standardized, dq_status_counts, dq_status_summary, dq_overall, constraint_check,
        product_price_summary, most_scraped, price_history, price_history_skewsafe,
        price_history_from_date, price_changes, top_price_moves, daily_latest, competitor_ranking,
        competitor_ranking_skewsafe, ranking_by_category, cheapest_products, review_trend, stock_gap,
        stock_gap_counts, market_summary, market_report, line_price_history, line_competitor_ranking,
        line_review_trend, line_stock_gap, payload_flatten, cdc_last_change, cdc_current_state,
        cdc_state_in_steps, cdc_insert_ignore, cdc_update, cdc_upsert, cdc_transitions,
        cdc_transitions_skewsafe, cdc_log_roundtrip, cdc_log_of_one_time, stream_cdc_state, raw_landing_roundtrip,
        silver_write_roundtrip, stream_silver, competitor_ranking_from_date, catalog_sql_report,
        two_stage_run,
    ]
    corpus, pipeline = _corpus()
    return {**{query.__name__: query for query in named},
            **{f"dq_{name}": _pillar(name, **options) for name, options in PILLARS.items()},
            **(corpus.queries() if corpus else {}),
            **({"pipeline": pipeline.run} if pipeline else {})}


def _corpus() -> tuple:
    """The modules of the corpus operators and of their pipeline, each None where it isn't installed."""
    found = []
    for name in ("shelfline.llm.queries", "corpus_pipeline"):
        try:
            found.append(importlib.import_module(name))
        except ModuleNotFoundError as error:
            if error.name not in ("shelfline.llm", "corpus_pipeline"):
                raise
            found.append(None)
    return tuple(found)


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query: the price history."""
    return price_history(spark, "/root/testdata/sf0.001")


# ---------------------------------------------------------------- the same in SQL

RAW_SQL = """raw_obs AS (
  SELECT event_id, user_id AS product_id,
    CASE WHEN k % 29 = 0 THEN NULL ELSE '  item ' || user_id || ' ' END AS title,
    CASE WHEN k % 23 = 0 THEN NULL WHEN k % 31 = 0 THEN CAST(-10 AS DOUBLE)
         ELSE CAST(10 AS DOUBLE) * (1 + floor(value / 20)) END AS price,
    CASE WHEN k % 13 = 0 THEN NULL ELSE CAST(k AS DOUBLE) / 19 END AS rating,
    CASE WHEN k % 37 = 0 THEN NULL ELSE CAST(960 + (k % 10) * (k % 10) AS BIGINT) END AS reviews_count,
    CASE WHEN k % 17 = 0 THEN NULL WHEN k % 3 = 0 THEN 'out_of_stock' ELSE 'in_stock' END AS in_stock,
    ' ' || event_type || ' ' AS category,
    strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS scraped_at,
    'synthetic' AS source
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events) e)"""

LINE_SQL = """raw_obs AS (
  SELECT l_partkey AS product_id, p_name AS title,
    floor(l_extendedprice / l_quantity * 100) / 100 AS price,
    l_discount * 50 AS rating, CAST(l_quantity AS BIGINT) AS reviews_count,
    CASE WHEN l_returnflag = 'R' THEN 'out_of_stock' ELSE 'in_stock' END AS in_stock,
    p_type AS category, strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS scraped_at,
    'lines' AS source
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""

SILVER_SQL = """silver AS (
  SELECT product_id, trim(title) AS title, price, rating, CAST(reviews_count AS INT) AS reviews_count,
    in_stock, upper(trim(category)) AS category, source, source AS source_system, scraped_at,
    CAST(substr(scraped_at, 1, 10) AS DATE) AS scrape_date,
    CASE WHEN price IS NULL OR price <= 0 THEN 'INVALID_PRICE' WHEN title IS NULL THEN 'MISSING_TITLE'
         WHEN rating IS NOT NULL AND (rating < 0 OR rating > 5) THEN 'INVALID_RATING'
         ELSE 'VALID' END AS dq_status
  FROM raw_obs),
valid AS (SELECT * FROM silver WHERE dq_status = 'VALID')"""

NEWEST = ("scraped_at DESC, price DESC, rating DESC NULLS LAST, reviews_count DESC NULLS LAST, "
          "in_stock DESC NULLS LAST")
OLDEST = ("scraped_at, price, rating NULLS FIRST, reviews_count NULLS FIRST, in_stock NULLS FIRST")

DAILY_SQL = f"""daily AS (
  SELECT * FROM valid
  QUALIFY ROW_NUMBER() OVER (PARTITION BY product_id, scrape_date ORDER BY {NEWEST}) = 1)"""


def _round(value: str, digits: int) -> str:
    """Half up on the digits a double prints, as Spark rounds; DuckDB's own rounding differs."""
    return f"CAST(ROUND(CAST(CAST({value} AS VARCHAR) AS DECIMAL(38,17)), {digits}) AS DOUBLE)"


HISTORY_SQL = f"""history AS (
  SELECT product_id, title, price, previous_price, price_diff, price_change_pct,
    COALESCE(price_diff <> 0, FALSE) AS price_changed,
    CASE WHEN price_diff > 0 THEN 'UP' WHEN price_diff < 0 THEN 'DOWN'
         WHEN price_diff = 0 THEN 'STABLE' ELSE 'FIRST_RECORD' END AS price_direction,
    rating, reviews_count, in_stock, category, scraped_at, scrape_date
  FROM (SELECT *, {_round("price - previous_price", 2)} AS price_diff,
          CASE WHEN previous_price > 0
               THEN {_round("(price - previous_price) / previous_price * 100", 2)} END AS price_change_pct
        FROM (SELECT *, LAG(price) OVER (PARTITION BY product_id ORDER BY {OLDEST}) AS previous_price
              FROM valid) l) d)"""

RANKING_SQL = """ranking AS (
  SELECT product_id, title, category, price, price_rank, price_rank = 1 AS is_cheapest, previous_rank,
    previous_rank - price_rank AS rank_change, rating, reviews_count, in_stock, scrape_date
  FROM (SELECT *, LAG(price_rank) OVER (PARTITION BY product_id ORDER BY scrape_date) AS previous_rank
        FROM (SELECT *, CAST(RANK() OVER (PARTITION BY category, scrape_date ORDER BY price) AS INT)
                AS price_rank FROM daily) r) p)"""

TREND_SQL = """trend AS (
  SELECT product_id, title, rating, reviews_count, previous_review_count, reviews_gained,
    CASE WHEN reviews_gained > 50 THEN 'HIGH' WHEN reviews_gained > 10 THEN 'MEDIUM'
         WHEN reviews_gained > 0 THEN 'LOW' WHEN reviews_gained = 0 THEN 'STAGNANT'
         ELSE 'DECLINING' END AS review_velocity, price, category, scrape_date
  FROM (SELECT *, CASE WHEN previous_review_count IS NULL THEN 0
               ELSE reviews_count - previous_review_count END AS reviews_gained
        FROM (SELECT *, LAG(reviews_count) OVER (PARTITION BY product_id ORDER BY scrape_date)
                AS previous_review_count FROM daily) l) g)"""

GAP_SQL = f"""gap AS (
  SELECT product_id, title, in_stock, is_out_of_stock,
    CASE WHEN is_out_of_stock AND reviews_count > 1000 THEN 'HIGH' WHEN is_out_of_stock THEN 'MEDIUM'
         ELSE 'NONE' END AS opportunity_score,
    price, rating, reviews_count, category, scraped_at, scrape_date
  FROM (SELECT *, COALESCE(in_stock <> 'in_stock', FALSE) AS is_out_of_stock FROM valid
        QUALIFY ROW_NUMBER() OVER (PARTITION BY product_id ORDER BY {NEWEST}) = 1) c)"""

MARKET_SQL = f"""market AS (
  SELECT *, CASE WHEN stock_availability_pct >= 80 THEN 'HEALTHY'
                 WHEN stock_availability_pct >= 50 THEN 'MODERATE' ELSE 'STRESSED' END AS market_health
  FROM (SELECT *, {_round("CAST(products_in_stock AS DOUBLE) / total_products * 100", 1)}
          AS stock_availability_pct
        FROM (SELECT category, scrape_date, COUNT(*) AS total_products,
                {_round(_round("AVG(price)", 9), 2)} AS avg_price, MIN(price) AS min_price, MAX(price) AS max_price,
                {_round(_round("AVG(rating)", 9), 2)} AS avg_rating,
                COUNT(*) FILTER (WHERE in_stock = 'in_stock') AS products_in_stock,
                COUNT(*) FILTER (WHERE in_stock <> 'in_stock') AS products_out_of_stock,
                CAST(MAX(reviews_count) AS BIGINT) AS max_reviews,
                {_round("AVG(reviews_count)", 0)} AS avg_reviews
              FROM daily GROUP BY category, scrape_date) a) s)"""

SUMMARY_SQL = f"""summary AS (
  SELECT product_id, MIN(price) AS min_price, MAX(price) AS max_price,
    {_round("AVG(price)", 2)} AS avg_price, MAX(price) - MIN(price) AS price_range,
    COUNT(*) AS total_scrapes, MAX(scrape_date) AS latest_scrape
  FROM silver GROUP BY product_id)"""

LOG_SQL = """log AS (
  SELECT o_orderkey AS seq,
    CASE WHEN o_orderkey % 19 = 0 THEN 'D' WHEN o_orderstatus = 'O' THEN 'I' ELSE 'U' END AS op,
    o_orderdate + to_microseconds(o_orderkey) AS change_ts,
    CAST(o_custkey AS VARCHAR) AS order_id, 'P' || (o_orderkey % 50) AS asin,
    CASE WHEN o_orderkey % 5 < 2 THEN NULL ELSE o_orderpriority END AS product_title,
    CAST(o_orderkey % 3 + 1 AS INT) AS quantity, o_totalprice AS sale_price,
    CASE o_orderstatus WHEN 'O' THEN 'pending' WHEN 'P' THEN 'confirmed' ELSE 'shipped' END AS order_status,
    'amazon_in' AS marketplace, CAST(o_orderdate AS DATE) AS created_on
  FROM orders)"""

ORDER_COLUMNS = ("order_id, asin, product_title, quantity, sale_price, order_status, marketplace, "
                 "created_on")

STATE_SQL = f"""WITH {LOG_SQL},
deleted AS (SELECT order_id, MAX(change_ts) AS at FROM log WHERE op = 'D' GROUP BY order_id),
first AS (SELECT order_id, MIN(created_on) AS created_on FROM log GROUP BY order_id)
SELECT l.order_id, ARG_MAX(asin, change_ts) AS asin,
  ARG_MAX(product_title, change_ts) FILTER (WHERE product_title IS NOT NULL) AS product_title,
  ARG_MAX(quantity, change_ts) AS quantity, ARG_MAX(sale_price, change_ts) AS sale_price,
  ARG_MAX(order_status, change_ts) AS order_status, ARG_MAX(marketplace, change_ts) AS marketplace,
  ANY_VALUE(f.created_on) AS created_on
FROM log l LEFT JOIN deleted d ON l.order_id = d.order_id JOIN first f ON l.order_id = f.order_id
WHERE d.at IS NULL OR l.change_ts > d.at GROUP BY l.order_id"""

BASE_SQL = f"""{LOG_SQL},
base AS (SELECT * FROM log WHERE seq % 2 = 0
  QUALIFY ROW_NUMBER() OVER (PARTITION BY order_id ORDER BY change_ts DESC) = 1),
new AS (SELECT * FROM log WHERE seq % 2 = 1)"""

TRANSITION_SQL = f"""WITH {LOG_SQL},
steps AS (SELECT *, LAG(order_status) OVER (PARTITION BY order_id ORDER BY change_ts) AS previous_status,
    CASE order_status WHEN 'pending' THEN 'confirmed' WHEN 'confirmed' THEN 'shipped'
      WHEN 'shipped' THEN 'delivered' END AS next_status FROM log)
SELECT order_id, seq, previous_status, order_status, next_status,
  CASE WHEN previous_status IS NULL THEN 'INITIAL'
       WHEN (previous_status = 'pending' AND order_status = 'confirmed')
         OR (previous_status = 'confirmed' AND order_status = 'shipped')
         OR (previous_status = 'shipped' AND order_status = 'delivered') THEN 'LEGAL'
       ELSE 'ILLEGAL' END AS transition FROM steps"""

TOTAL = "COUNT(*) AS total_records"
SUSPICIOUS = "COUNT(*) FILTER (WHERE price < 20 OR price > 200)"


def _score(part: str) -> str:
    return f"CAST({part} AS DOUBLE) / COUNT(*) * 100"


COMPLETE = ("COUNT(*) FILTER (WHERE price IS NOT NULL AND title IS NOT NULL AND product_id IS NOT NULL "
            "AND scraped_at IS NOT NULL)")
BAD_PRICES = "COUNT(*) FILTER (WHERE price <= 0)"
BAD_RATINGS = "COUNT(*) FILTER (WHERE rating < 0 OR rating > 5)"
DISTINCT_ROWS = "COUNT(DISTINCT (product_id, scraped_at))"
COMPLETENESS = _score(COMPLETE)
VALIDITY = _score(f"(COUNT(*) - {BAD_PRICES} - {BAD_RATINGS})")
UNIQUENESS = _score(DISTINCT_ROWS)
ACCURACY = _score(f"(COUNT(*) - {SUSPICIOUS})")


def _consistency(products: int) -> str:
    return (f"CASE WHEN COUNT(DISTINCT product_id) = {products} AND COUNT(DISTINCT source) = 1 "
            "THEN CAST(100 AS DOUBLE) ELSE CAST(50 AS DOUBLE) END")


#: Where each Gold table stands in the SQL.
VIEWS = {"price_history": "history", "competitor_ranking": "ranking", "review_trend": "trend", "stock_gap": "gap",
         "market_summary": "market"}
CORRECTED_SQL = f"""{RAW_SQL.replace("raw_obs AS", "raw_all AS", 1)},
raw_obs AS (SELECT * REPLACE (CASE WHEN scraped_at LIKE '{DAY}%' THEN NULL ELSE price END AS price) FROM raw_all)"""


def digest(raw_sql: str) -> str:
    """Every row and column of the five Gold tables."""
    return _with(raw_sql, SILVER_SQL, DAILY_SQL, HISTORY_SQL, RANKING_SQL, TREND_SQL, GAP_SQL, MARKET_SQL, select=" UNION ALL BY NAME ".join(
        f"SELECT '{name}' AS table_name, * FROM {view}" for name, view in VIEWS.items()))


def _with(*parts: str, select: str) -> str:
    return f"WITH {', '.join(parts)} {select}"


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL for the queries; both sides name their columns alike."""
    to_silver = (RAW_SQL, SILVER_SQL)
    to_daily = (*to_silver, DAILY_SQL)
    lines = (LINE_SQL, SILVER_SQL)
    silver_rows = _with(*to_silver, select="SELECT * FROM silver")
    history_rows = _with(*to_silver, HISTORY_SQL, select="SELECT * FROM history")
    ranking_rows = _with(*to_daily, RANKING_SQL, select="SELECT * FROM ranking")
    ranking_columns = "product_id, title, price, price_rank, is_cheapest, rank_change"

    most_scraped_rows = _with(*to_silver, SUMMARY_SQL, select=(
        "SELECT * FROM summary ORDER BY total_scrapes DESC, product_id LIMIT 20"))

    def report(select: str) -> str:
        return _with(RAW_SQL, select=f"SELECT {select} FROM raw_obs")

    overall_rows = _with(RAW_SQL, select=(
        f"SELECT *, {_round('0.25 * completeness_score + 0.25 * validity_score + 0.20 * uniqueness_score + 0.15 * consistency_score + 0.10 * accuracy_score + 0.05 * timeliness_score', 6)}"
        f" AS overall_score FROM (SELECT {COMPLETENESS} AS completeness_score, "
        f"{VALIDITY} AS validity_score, {UNIQUENESS} AS uniqueness_score, "
        f"{_consistency(11)} AS consistency_score, {ACCURACY} AS accuracy_score, "
        "CAST(100 AS DOUBLE) AS timeliness_score FROM raw_obs) s"))
    corpus, pipeline = _corpus()
    return {
        "silver_standardized": silver_rows,
        "silver_write_roundtrip": silver_rows,
        "stream_silver": silver_rows,
        "raw_landing_roundtrip": _with(
            RAW_SQL, select=f"SELECT {', '.join(supplied.OBSERVATION)} FROM raw_obs"),
        "payload_flatten": _with(RAW_SQL, select=(
            "SELECT product_id, title, price, rating, reviews_count, in_stock, "
            "CASE WHEN price > 30 THEN category END AS category, scraped_at, "
            "source FROM raw_obs")),
        "dq_status_counts": _with(
            *to_silver, select="SELECT dq_status, COUNT(*) AS row_count FROM silver GROUP BY dq_status"),
        "dq_status_summary": _with(*to_silver, select=(
            f"SELECT {TOTAL}, COUNT(*) FILTER (WHERE dq_status = 'VALID') AS valid_records, "
            "COUNT(*) FILTER (WHERE dq_status <> 'VALID') AS invalid_records, "
            "CAST(COUNT(*) FILTER (WHERE dq_status = 'VALID') AS DOUBLE) / COUNT(*) * 100 AS valid_pct "
            "FROM silver")),
        "dq_completeness": report(
            f"{TOTAL}, COUNT(*) FILTER (WHERE price IS NULL) AS null_prices, "
            "COUNT(*) FILTER (WHERE rating IS NULL) AS null_ratings, "
            "COUNT(*) FILTER (WHERE title IS NULL) AS null_titles, "
            "COUNT(*) FILTER (WHERE in_stock IS NULL) AS null_in_stock, "
            "COUNT(*) FILTER (WHERE category IS NULL) AS null_categories, "
            "COUNT(*) FILTER (WHERE scraped_at IS NULL) AS null_scraped_at, "
            f"{COMPLETE} AS complete_records, {COMPLETENESS} AS completeness_score"),
        "dq_validity": report(
            f"{TOTAL}, {BAD_PRICES} AS invalid_prices, {BAD_RATINGS} AS invalid_ratings, "
            f"{SUSPICIOUS} AS suspicious_prices, {VALIDITY} AS validity_score"),
        "dq_uniqueness": report(
            f"{TOTAL}, {DISTINCT_ROWS} AS distinct_records, COUNT(*) - {DISTINCT_ROWS} AS duplicate_records, "
            f"{UNIQUENESS} AS uniqueness_score"),
        "dq_consistency": report(
            f"{TOTAL}, COUNT(DISTINCT product_id) AS distinct_products, "
            f"COUNT(DISTINCT source) AS distinct_sources, {_consistency(150)} AS consistency_score"),
        "dq_accuracy": report(
            f"{TOTAL}, {SUSPICIOUS} AS suspicious_prices, MIN(price) AS min_price, MAX(price) AS max_price, "
            f"{_round('AVG(price)', 6)} AS avg_price, MIN(rating) AS min_rating, MAX(rating) AS max_rating, "
            f"{_round('AVG(rating)', 6)} AS avg_rating, {ACCURACY} AS accuracy_score"),
        "dq_timeliness": report(
            f"{TOTAL}, MIN(scraped_at) AS earliest_scrape, MAX(scraped_at) AS latest_scrape, "
            "COUNT(DISTINCT scraped_at) AS distinct_scrape_times, CAST(100 AS DOUBLE) AS timeliness_score"),
        "dq_overall": overall_rows,
        "dq_displayed": "SELECT " + ", ".join(
            f"round_even({pillar}_score, 1) AS {pillar}_score" for pillar in (*fixed.PILLAR_WEIGHTS, "overall"))
        + f" FROM ({overall_rows}) o",
        "constraint_check": _with(LOG_SQL, select=(
            "SELECT *, duplicate_keys + null_order_id + null_product_title + null_sale_price = 0 "
            "AS constraints_hold FROM (SELECT CAST(SUM(n) AS BIGINT) AS total_records, "
            "COUNT(*) FILTER (WHERE n > 1) AS duplicate_keys, "
            "COUNT(*) FILTER (WHERE order_id IS NULL) AS null_order_id, "
            "CAST(SUM(t) AS BIGINT) AS null_product_title, CAST(SUM(p) AS BIGINT) AS null_sale_price "
            "FROM (SELECT order_id, COUNT(*) AS n, COUNT(*) FILTER (WHERE product_title IS NULL) AS t, "
            "COUNT(*) FILTER (WHERE sale_price IS NULL) AS p FROM log GROUP BY order_id) k) c")),
        "product_price_summary": _with(*to_silver, SUMMARY_SQL, select="SELECT * FROM summary"),
        "most_scraped": most_scraped_rows,
        "catalog_sql_report": most_scraped_rows,
        "price_history": history_rows,
        "price_history_skewsafe": history_rows,
        "price_history_from_date": f"{history_rows} WHERE scrape_date >= DATE '{FROM}'",
        "price_changes": _with(*to_silver, HISTORY_SQL, select=(
            "SELECT product_id, title, price, previous_price, price_diff, price_change_pct "
            "FROM history WHERE price_changed")),
        "top_price_moves": _with(*to_silver, HISTORY_SQL, select=(
            "SELECT product_id, price, previous_price, price_diff, price_change_pct, price_direction "
            "FROM history WHERE price_changed "
            "ORDER BY ABS(price_diff) DESC, product_id, scraped_at, price LIMIT 10")),
        "daily_latest": _with(*to_daily, select="SELECT * FROM daily"),
        "competitor_ranking": ranking_rows,
        "two_stage_run": ranking_rows,
        "gold_all_tables": digest(RAW_SQL),
        "gold_after_corrected_day": digest(CORRECTED_SQL),
        "gold_from_corrected_day": digest(CORRECTED_SQL),
        "gold_first_run_from_date": digest(f"{RAW_SQL.replace('raw_obs AS', 'raw_all AS', 1)}, raw_obs AS "
                                           f"(SELECT * FROM raw_all WHERE scraped_at >= '{FROM}')"),
        "silver_after_late_file": silver_rows,
        "silver_stream_then_batch": silver_rows,
        "silver_new_files_only": silver_rows,
        "bronze_quarantine": _with(RAW_SQL, select=(
            "SELECT CASE WHEN product_id % 11 = 0 THEN 'reject' ELSE 'silver' END AS kind, CASE WHEN product_id % 11 = 0 "
            "THEN '{\"asin\": \"' || product_id || '\", \"price\": ' ELSE CAST(product_id AS VARCHAR) END AS value, COUNT(*) AS n "
            "FROM raw_obs GROUP BY ALL")),
        "gold_by_successive_runs": digest(RAW_SQL),
        "silver_undated_rows": _with(
            RAW_SQL.replace("raw_obs AS", "raw_all AS", 1), "raw_obs AS (SELECT * REPLACE (CASE WHEN product_id % 4 = 0 "
            "THEN 'unknown ' || scraped_at ELSE scraped_at END AS scraped_at) FROM raw_all)",
            SILVER_SQL.replace("CAST(substr", "TRY_CAST(substr", 1), select="SELECT * FROM silver"),
        "catalog_schema_merge": _with(*to_silver, select=(
            "SELECT product_id, CASE WHEN product_id % 2 <> 0 THEN rating END AS rating, "
            "CASE WHEN product_id % 2 <> 0 THEN 's' || product_id END AS seller, scraped_at FROM silver")),
        "catalog_widened": (
            "SELECT CAST(date_trunc('year', l_shipdate) AS DATE) AS scrape_date, COUNT(*) AS lines, CAST(SUM(CAST(l_quantity AS BIGINT) "
            "+ CASE WHEN l_orderkey % 2 = 0 THEN 0 ELSE 3000000000 END) AS BIGINT) AS total FROM lineitem GROUP BY ALL"),
        "multi_line_bronze": (
            "SELECT s_suppkey AS product_id, s_name || chr(10) AS title, s_acctbal AS price, "
            "'2024-01-01T00:00:00.000000+00:00' AS scraped_at FROM supplier"),
        "whole_numbers": (
            "SELECT l_orderkey AS order_key, l_linenumber AS line, COUNT(*) AS n, SUM(CASE l_linenumber % 5 "
            "WHEN 3 THEN CAST(l_quantity AS INT) * 10 WHEN 4 THEN NULL ELSE CAST(l_quantity AS INT) END) AS reviews "
            "FROM lineitem GROUP BY l_orderkey, l_linenumber"),
        "table_row_counts": _with(*to_daily, HISTORY_SQL, RANKING_SQL, TREND_SQL, GAP_SQL, MARKET_SQL, select=" UNION ALL ".join(
            f"SELECT '{name}' AS table_name, COUNT(*) AS counted, COUNT(*) AS written FROM {view}"
            for name, view in VIEWS.items())),
        # the written key is text, and so is the order of its ties
        "published_report": most_scraped_rows.replace("DESC, product_id LIMIT", "DESC, CAST(product_id AS VARCHAR) LIMIT"),
        "order_key_listing": _with(LOG_SQL, select=(
            "SELECT order_id, seq, CASE op WHEN 'I' THEN 'insert' WHEN 'U' THEN 'update' ELSE 'delete' END AS op_name, "
            "op AS op_again, op AS op_same, strftime(created_on, '%Y-%m-%dT00-00-00.000000+00-00') AS stamp, "
            "strftime(created_on, '%Y/%m/%d') AS folder FROM log")),
        "cdc_snapshot_in_loads": STATE_SQL,
        "cdc_buckets_in_loads": STATE_SQL,
        "stream_stock_gap": _with(*to_silver, GAP_SQL, select="SELECT * FROM gap"),
        "dq_from_date_sketches": _with(*to_silver, select=(
            f"SELECT scrape_date < DATE '{FROM}' AS early, COUNT(*) AS total_records, COUNT(*) FILTER (WHERE price IS NULL) AS null_price, "
            "COUNT(*) FILTER (WHERE rating IS NULL) AS null_rating, COUNT(DISTINCT (product_id, scraped_at)) AS exact_records, "
            "COUNT(DISTINCT product_id) AS exact_products, TRUE AS records_within, TRUE AS products_within FROM silver GROUP BY 1")),
        "inventory_log_roundtrip": (
            "SELECT p_partkey AS product_id, p_name || chr(10) || '2nd line, \"quoted\"' AS product_title, "
            "p_size + 1 AS stock_quantity, p_size AS reorder_point FROM part WHERE p_partkey % 7 <> 0"),
        "inventory_defaults": (
            "SELECT p_partkey AS product_id, CASE WHEN p_size > 10 THEN p_size ELSE 0 END AS stock_quantity, "
            "CASE WHEN p_partkey % 3 > 0 THEN p_size ELSE 50 END AS reorder_point FROM part"),
        "run_time_stamp": f"SELECT '{RUN}' AS processed, COUNT(*) AS n FROM events",
        "competitor_ranking_from_date": f"{ranking_rows} WHERE scrape_date >= DATE '{FROM}'",
        "competitor_ranking_skewsafe": ranking_rows,
        "ranking_by_category": _with(*to_daily, RANKING_SQL, select=(
            f"SELECT {ranking_columns} FROM ranking "
            "ORDER BY category, price_rank, product_id, scrape_date LIMIT 11")),
        "cheapest_products": _with(*to_daily, RANKING_SQL, select=(
            f"SELECT {ranking_columns} FROM ranking ORDER BY price_rank, product_id, scrape_date LIMIT 11")),
        "review_trend": _with(*to_daily, TREND_SQL, select="SELECT * FROM trend"),
        "stock_gap": _with(*to_silver, GAP_SQL, select="SELECT * FROM gap"),
        "stock_gap_counts": _with(*to_silver, GAP_SQL, select=(
            "SELECT COUNT(*) FILTER (WHERE is_out_of_stock) AS out_of_stock, "
            "COUNT(*) FILTER (WHERE opportunity_score = 'HIGH') AS high_opportunity FROM gap")),
        "market_summary": _with(*to_daily, MARKET_SQL, select="SELECT * FROM market"),
        "market_report": _with(*to_daily, MARKET_SQL, select=(
            "SELECT category, avg_price, min_price, max_price, products_in_stock, market_health FROM market")),
        "line_price_history": _with(*lines, HISTORY_SQL, select="SELECT * FROM history"),
        "line_competitor_ranking": _with(*lines, DAILY_SQL, RANKING_SQL, select="SELECT * FROM ranking"),
        "line_review_trend": _with(*lines, DAILY_SQL, TREND_SQL, select="SELECT * FROM trend"),
        "line_stock_gap": _with(*lines, GAP_SQL, select="SELECT * FROM gap"),
        "cdc_last_change": _with(LOG_SQL, select=(
            f"SELECT {ORDER_COLUMNS}, op, seq FROM log "
            "QUALIFY ROW_NUMBER() OVER (PARTITION BY order_id ORDER BY change_ts DESC) = 1")),
        "cdc_current_state": STATE_SQL,
        "cdc_state_in_steps": STATE_SQL,
        "cdc_log_roundtrip": STATE_SQL,
        "stream_cdc_state": STATE_SQL,
        "cdc_log_of_one_time": (
            "SELECT order_id, CAST(l.p AS BIGINT) AS product_id, CAST(l.q AS INT) AS quantity, 's' || l.n AS order_status FROM (SELECT l_orderkey AS order_id, "
            "MAX({'n': l_linenumber, 'p': CAST(l_partkey AS VARCHAR), 'q': CAST(CAST(l_quantity AS INT) AS VARCHAR)}) AS l FROM lineitem GROUP BY l_orderkey) x"),
        "cdc_insert_ignore": _with(BASE_SQL, select=(
            f"SELECT {ORDER_COLUMNS} FROM base UNION ALL SELECT {ORDER_COLUMNS} FROM "
            "(SELECT * FROM new WHERE order_id NOT IN (SELECT order_id FROM base) "
            "QUALIFY ROW_NUMBER() OVER (PARTITION BY order_id ORDER BY change_ts) = 1) n")),
        "cdc_update": _with(
            BASE_SQL, "last AS (SELECT order_id, ARG_MAX(order_status, change_ts) AS status "
            "FROM new GROUP BY order_id)",
            select="SELECT b.order_id, asin, product_title, quantity, sale_price, "
            "COALESCE(status, order_status) AS order_status, marketplace, created_on, "
            f"CASE WHEN status IS NOT NULL THEN DATE '{RUN.date()}' ELSE created_on END AS updated_on "
            "FROM base b LEFT JOIN last l ON b.order_id = l.order_id"),
        "cdc_upsert": _with(
            "base AS (SELECT p_partkey AS product_id, p_name AS product_title, p_size AS stock_quantity, "
            "50 AS reorder_point, p_retailprice AS unit_cost FROM part)",
            "lines AS (SELECT * REPLACE (CASE WHEN l_partkey % 4 = 0 THEN -l_partkey ELSE l_partkey END AS l_partkey) "
            "FROM lineitem)",
            "new AS (SELECT l_partkey AS k, MIN({'at': l_shipdate, 'o': l_orderkey, 'n': l_linenumber, 'p': l_extendedprice}) AS f, "
            "MAX({'at': l_shipdate, 'o': l_orderkey, 'n': l_linenumber, 'p': l_extendedprice, 'q': l_quantity}) AS l "
            "FROM lines GROUP BY l_partkey)",
            select="SELECT product_id, product_title, COALESCE(CAST(l.q AS INT), stock_quantity) AS stock_quantity, reorder_point, "
            f"unit_cost, CASE WHEN k IS NOT NULL THEN DATE '{RUN.date()}' ELSE DATE '2020-01-01' END AS updated_on "
            "FROM base LEFT JOIN new ON product_id = k UNION ALL "
            f"SELECT k, 'line ' || f.n, CAST(l.q AS INT), f.n, f.p, DATE '{RUN.date()}' FROM new WHERE k NOT IN (SELECT p_partkey FROM part)"),
        "cdc_transitions": TRANSITION_SQL,
        "cdc_transitions_skewsafe": TRANSITION_SQL,
        **(corpus.oracle_sql() if corpus else {}),
        **({"pipeline": pipeline.ORACLE_SQL} if pipeline and pipeline.ORACLE_SQL else {}),
    }
