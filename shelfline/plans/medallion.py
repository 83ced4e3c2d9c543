"""Bronze to Silver to Gold as one application.

What a run writes appears in one step at its end, all tables together.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Container
from dataclasses import dataclass, field
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline import fixed_values as fixed
from shelfline.operators import gold
from shelfline.operators.pieces import ROWS_PER_PIECE
from shelfline.operators.profiles import date_profiles
from shelfline.operators.quality import quality_report, quality_score
from shelfline.operators.snapshots import current, daily_latest, latest_per
from shelfline.operators.standardize import quality_gate, standardize, status_counts
from shelfline.schemas import DEFAULT, GOLD, SILVER, Columns
from shelfline.session import at_once
from shelfline.sinks.tables import date_folders, ensure_table, stage
from shelfline.sinks.versions import CARRY, NO_DATE, PROFILES, Changes, partition_places
from shelfline.sources.bronze import CORRUPT, list_files, read_with_origin
from shelfline.sources.silver import read_silver


PRODUCTS, REJECTS, FILES = "products", "rejects", "files"
MOST_REJECTS = 0.5

#: Records that are no JSON, by the date of the run that met them.
REJECT_SCHEMA = T.StructType([
    T.StructField("file", T.StringType()), T.StructField("block_start", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("rejected_at", T.TimestampType()), T.StructField("scrape_date", T.DateType())])
#: Files that were read, by the date they were modified.
FILE_SCHEMA = T.StructType([
    T.StructField("file", T.StringType()), T.StructField("size", T.LongType()), T.StructField("modified", T.TimestampType()),
    T.StructField("scrape_date", T.DateType())])
CARRIED_DATES = 7  # dates for which the state at their end is kept

#: The last valid row and rank of each product at the end of a date.
CARRY_SCHEMA = T.StructType([*SILVER.fields, T.StructField("seen_on", T.DateType()), T.StructField("price_rank", T.IntegerType())])


class EmptyInputError(ValueError):
    """A stage found nothing to work on."""


class RejectedInputError(ValueError):
    """Too large a share of the records is no JSON."""


class PartialDateError(ValueError):
    """Files hold only a part of a date that is stored whole."""


@dataclass
class RunMetrics:
    """What a run reports instead of printing."""

    rows_written: dict[str, int] = field(default_factory=dict)
    schemas: dict[str, T.StructType] = field(default_factory=dict)
    quality: dict[str, object] = field(default_factory=dict)
    status: dict[str, int] = field(default_factory=dict)


def run_silver(spark: SparkSession, bronze: str | list[str], out: str, run_ts: dt.datetime, *,
               multi_line: bool = True, columns: Columns = DEFAULT, late: bool = False, replace: bool = False,
               new_only: bool = False, most_rejects: float = MOST_REJECTS, profiles: bool = False,
               source_system: str = fixed.SOURCE_SYSTEM, metrics: RunMetrics | None = None,
               changes: Changes | None = None) -> RunMetrics:
    """Read raw observations, report on their quality, write Silver.

    The dates read replace those written before, so ``bronze`` should hold whole
    dates: all folders, or a list of some. If a date already stored holds a product that is not read again,
    a PartialDateError is raised before anything is written, unless ``replace`` says that it is to go. With ``late``
    the files are additions: stored rows of their dates stay, but for those with the key and time of a row
    read now. Rows whose time gives no date are no date's: they are always added to those stored, but for those that are
    equal to a row read now. The JSON is parsed once; the report and Silver read a columnar copy of it.

    Every run notes the files it has read (``files``: path, size, time). With ``new_only`` it takes those alone that are not noted so,
    as additions to the dates they hold (``late``); without any it changes nothing. A file that is written again replaces its rows by key and time.

    Records that are no JSON give no row; they go to ``rejects`` with their file and text. If more than a share ``most_rejects``
    of all records is such, a RejectedInputError is raised before anything is written.

    With ``profiles`` the counts of each date written, with sketches of the distinct ones, are kept for reports on any range of dates.
    """
    metrics = metrics or RunMetrics()
    own = changes or Changes(spark, out, columns.date)
    known = own.read(FILES, FILE_SCHEMA) if own.dates(FILES) else None

    def list_unread() -> DataFrame:
        found = stage(list_files(spark, bronze).withColumn(columns.date, F.to_date("modified")), "files", out)
        return found if known is None else stage(
            found.join(known, ["file", "size", "modified"], "left_anti").select(*found.columns), "unread", out)
    if new_only:
        unread = list_unread()
        since = unread.agg(F.min("modified")).first()[0]
        if since is None:
            metrics.rows_written[PRODUCTS] = 0
            return metrics
        late = True
        records = stage(read_with_origin(spark, bronze, multi_line=multi_line, only=unread, since=since), "raw", out)
    else:
        unread, records = at_once(spark, list_unread, lambda: stage(read_with_origin(spark, bronze, multi_line=multi_line), "raw", out))
    broken = F.col(CORRUPT).isNotNull()
    counts = records.agg(F.count(F.lit(1)).alias("n"), F.count_if(broken).alias("broken")).first()
    if not counts["n"]:
        raise EmptyInputError(f"no raw observations in {bronze}")
    if counts["broken"] > most_rejects * counts["n"]:
        raise RejectedInputError(f"{counts['broken']} of {counts['n']} records in {bronze} are no JSON")
    raw = records.where(~broken).drop(CORRUPT, "file", "block_start")
    if counts["broken"]:
        metrics.rows_written[REJECTS] = counts["broken"]
    metrics.schemas["raw"] = raw.schema
    silver = standardize(raw, run_ts, columns=columns, source_system=source_system)
    if own.dates(PRODUCTS):
        silver = _with_stored(silver, own.read(PRODUCTS, SILVER), own.dates(PRODUCTS), columns, late=late, replace=replace,
                              what=f"{out}/{PRODUCTS}")
    report, metrics.rows_written[PRODUCTS] = at_once(
        spark, lambda: quality_score(quality_report(raw, columns=columns)).first(), lambda: own.write(silver, PRODUCTS))
    metrics.quality = report.asDict()
    own.drop_from(CARRY, own.written(PRODUCTS))
    own.drop(PROFILES, own.written(PRODUCTS))
    of = F.coalesce(F.col(columns.date).cast("string"), F.lit(NO_DATE)).isin(own.written(PRODUCTS))
    written = own.read(PRODUCTS, SILVER).where(of)
    if profiles:
        own.write(date_profiles(written, columns=columns), PROFILES)
    if counts["broken"]:
        rejects = records.where(broken).select("file", "block_start", F.col(CORRUPT).alias("text"), F.lit(run_ts).alias("rejected_at"),
                                               F.lit(run_ts.date()).alias(columns.date))
        if own.dates(REJECTS):  # those of this date from other files stay
            earlier = own.read(REJECTS, REJECT_SCHEMA).where(F.col(columns.date) == F.lit(run_ts.date()))
            rejects = rejects.unionByName(earlier.join(rejects.select("file").distinct(), "file", "left_anti").select(*rejects.columns))
        own.write(rejects, REJECTS)
    statuses, _ = at_once(spark, lambda: status_counts(written, columns=columns).collect(),
                          lambda: None if unread.isEmpty() else own.write(unread, FILES, append=True))
    metrics.status = {row[0]: row[1] for row in statuses}
    if changes is None:
        own.commit()
    return metrics


def _with_stored(silver: DataFrame, stored: DataFrame, dates: Container[str], columns: Columns, *, late: bool, replace: bool,
                 what: str) -> DataFrame:
    """The rows read now and the stored ones that stay beside them in the dates to be written. ``dates`` are those stored: rows of
    others alone are held against nothing."""
    c = columns
    held = [row[0] for row in silver.select(c.date).distinct().collect()]  # as many as days
    again = [date for date in held if date is not None and date.isoformat() in dates]
    same_dates = stored.where(F.col(c.date).isin(again))
    if late and again:
        read = silver.select(c.key, c.time).distinct()
        silver = silver.unionByName(same_dates.join(read, [c.key, c.time], "left_anti").select(silver.columns))
    elif again and not replace:
        lost = same_dates.join(silver.select(c.date, c.key).distinct(), [c.date, c.key], "left_anti")
        if not lost.isEmpty():
            raise PartialDateError(f"the files lack products that {what} holds for the same dates")
    if None not in held:  # what is stored without a date is not written again
        return silver
    told_by = [name for name in silver.columns if name not in ("processed_at", c.date)]
    now = silver.where(F.col(c.date).isNull()).select(F.struct(*told_by).alias("_row")).distinct()
    before = stored.where(F.col(c.date).isNull()).withColumn("_row", F.struct(*told_by))
    return silver.unionByName(before.join(now, "_row", "left_anti").select(silver.columns))


def daily_tables(daily: DataFrame, run_ts: dt.datetime | None = None, *, wanted: Column | None = None,
                 ranked_before: DataFrame | None = None, columns: Columns = DEFAULT,
                 rows_per_piece: int = ROWS_PER_PIECE) -> dict[str, Callable[[], DataFrame]]:
    """The four Gold tables of the daily snapshot, each by a call, as some count and sample rows before they are defined.

    ``wanted`` are the rows that ranks and markets are made of; trends and the present state follow from all of them.
    """
    rows = daily if wanted is None else daily.where(wanted)
    return {
        "competitor_ranking": lambda: gold.competitor_ranking(
            rows, run_ts, ranked_before=ranked_before, columns=columns, rows_per_piece=rows_per_piece),
        "review_trend": lambda: gold.review_trend(daily, run_ts, columns=columns),
        "stock_gap": lambda: gold.stock_gap(daily, run_ts, columns=columns),
        "market_summary": lambda: gold.market_summary(rows, run_ts, columns=columns),
    }


def with_last_before(valid: DataFrame, from_date: dt.date, columns: Columns = DEFAULT,
                     carried: tuple[DataFrame, dt.date] | None = None,
                     keep: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> DataFrame:
    """The rows from a date on, and what their first rows follow: each product's last row
    before that date, and the rows whose time gives no date, which may sort anywhere.

    ``carried`` are the last rows at the end of an earlier date, and that date: only later ones are read then, not the history.
    ``keep`` is applied to the last rows, for plans that read the result several times: the others are read and not worked out.
    """
    date = F.col(columns.date)
    before = valid.where(date < F.lit(from_date))
    if carried is not None:
        rows, as_of = carried
        before = valid.where((date > F.lit(as_of)) & (date < F.lit(from_date))).unionByName(rows)
    return (valid.where(date >= F.lit(from_date)).unionByName(keep(current(before, columns=columns)))
            .unionByName(valid.where(date.isNull())))


def read_carry(changes: Changes, from_date: dt.date) -> tuple[DataFrame, dt.date] | None:
    """The state at the end of the last date before ``from_date`` for which it is kept, and that date."""
    known = [date for date in changes.dates(CARRY) or {} if date < from_date.isoformat()]
    if not known:
        return None
    as_of = dt.date.fromisoformat(max(known))
    return changes.read(CARRY, CARRY_SCHEMA).where(F.col(changes.partition) == F.lit(as_of)), as_of


def write_carry(changes: Changes, daily: DataFrame, ranks: DataFrame, from_date: dt.date | None, columns: Columns) -> None:
    """Keep the state at the end of the last dates of a run, from its daily snapshot and the ranks of its rows.

    A product's row holds from its date to the day before its next one, so one pass along each product gives the state of all dates. Rows that
    hold at the end of none are not joined with ranks.
    """
    c, date = columns, F.col(columns.date)
    dated = daily.where(date.isNotNull())
    # the ranking has a row for each row of the snapshot, so the dates it was written for are known without a read
    kept = [dt.date.fromisoformat(day) for day in sorted(changes.written("competitor_ranking")) if day != NO_DATE][-CARRIED_DATES:]
    if from_date is not None:
        changes.drop_from(CARRY, [from_date.isoformat()])
    if not kept:
        return
    follows = F.lead(c.date).over(Window.partitionBy(c.key).orderBy(c.date))
    holds = F.filter(F.array(*map(F.lit, kept)), lambda day: (day >= F.col("seen_on")) & (F.col("_next").isNull() | (day < F.col("_next"))))
    rows = (dated.withColumn("_next", follows).withColumnRenamed(c.date, "seen_on").withColumn("_holds", holds).where(F.size("_holds") > 0)
            .join(ranks.select(c.key, F.col(c.date).alias("seen_on"), "price_rank"), [c.key, "seen_on"], "left")
            .withColumn(c.date, F.explode("_holds")))
    changes.write(rows.select(*CARRY_SCHEMA.fieldNames()), CARRY, replace_all=from_date is None)
    changes.tables[CARRY] = dict(sorted(changes.tables[CARRY].items())[-CARRIED_DATES:])


def run_gold(spark: SparkSession, silver: str, out: str, run_ts: dt.datetime, *,
             from_date: dt.date | None = None, columns: Columns = DEFAULT, rows_per_piece: int = ROWS_PER_PIECE,
             metrics: RunMetrics | None = None, changes: Changes | None = None) -> RunMetrics:
    """Build the Gold tables, or with ``from_date`` only their dates from there on; rows
    without a date are then left as they were. Dates that have no valid row any more go:
    the tables end as a run on a new folder would write them.

    The daily snapshot serves four tables and is staged for them, while the history is written beside it. ``stock_gap`` holds
    the present state of each product, so it is always replaced as a whole. The state of each product at the end of the last dates is carried, so
    a run from a date on reads that date's partitions and those after it, the carried state, and no history; where nothing is
    carried (another Silver table, or a date before the carried ones) it reads the history.
    """
    metrics = metrics or RunMetrics()
    own = changes or Changes(spark, out, columns.date)
    ours = silver.rstrip("/") == f"{own.out}/{PRODUCTS}"
    valid = quality_gate(own.read(PRODUCTS, SILVER) if ours and own.dates(PRODUCTS) else read_silver(spark, silver, columns=columns),
                         columns=columns)
    if valid.isEmpty():
        raise EmptyInputError(f"no valid rows in {silver}")
    metrics.schemas["silver"] = valid.schema
    date, wanted, ranked_before = F.col(columns.date), F.lit(True), None
    if from_date is not None:
        wanted = F.coalesce(date >= F.lit(from_date), F.lit(False))
        carried = read_carry(own, from_date) if ours else None
        older = date < F.lit(from_date)
        if carried is not None:
            state, as_of = carried
            last = state.withColumn(columns.date, F.col("seen_on"))
            carried, older = (last.select(*SILVER.fieldNames()), as_of), older & (date > F.lit(as_of))
        ranked = bool(own.dates("competitor_ranking"))
        if ranked:
            written = own.read("competitor_ranking", GOLD["competitor_ranking"])
            written = written.where(older | date.isNull())
            if carried is not None:
                written = written.select(*[name for name in written.columns if name in last.columns]).unionByName(
                    last.where("price_rank IS NOT NULL").select(*[name for name in written.columns if name in last.columns]))
        valid, ranked_before = at_once(
            spark, lambda: with_last_before(valid, from_date, columns, carried, lambda rows: stage(rows, "last", out)),
            lambda: stage(latest_per(written, [columns.key], [columns.date]), "ranked_before", out) if ranked else None)

    def write(name: str, rows: Callable[[], DataFrame]) -> None:
        present = name == "stock_gap"
        metrics.rows_written[name] = own.write(
            rows() if present else rows().where(wanted), name,
            replace_all=present or from_date is None, replace_from=None if present else from_date)

    def write_ranking(daily: DataFrame, rows: Callable[[], DataFrame]) -> None:
        write("competitor_ranking", rows)
        if ours:
            ranks = own.read("competitor_ranking", GOLD["competitor_ranking"]).where(wanted).select(columns.key, columns.date, "price_rank")
            if ranked_before is not None:
                ranks = ranks.unionByName(ranked_before.select(*ranks.columns))
            write_carry(own, daily, ranks, from_date, columns)

    def write_daily() -> None:
        daily = stage(daily_latest(valid, columns=columns), "daily", out)
        tables = daily_tables(daily, run_ts, wanted=wanted, ranked_before=ranked_before, columns=columns, rows_per_piece=rows_per_piece)
        ranking = tables.pop("competitor_ranking")
        at_once(spark, partial(write_ranking, daily, ranking), *[partial(write, name, rows) for name, rows in tables.items()])

    # the history needs no snapshot
    at_once(spark, write_daily, partial(write, "price_history", lambda: gold.price_history(
        valid, run_ts, columns=columns, rows_per_piece=rows_per_piece)))
    if changes is None:
        own.commit()
    return metrics


def publish(spark: SparkSession, out: str, database: str, columns: Columns = DEFAULT) -> None:
    """Make the written tables known to the catalog, for SQL and the reports: its partitions are pointed at the folders of the newest list.

    Dates that a stream has added to several times are written as one folder first.
    """
    tables = {PRODUCTS: SILVER, **GOLD}
    changes, compacted = Changes(spark, out, columns.date), False
    for name, schema in tables.items():
        several = [date for date, versions in (changes.dates(name) or {}).items() if len(versions) > 1]
        if several:
            date = F.coalesce(F.col(columns.date).cast("string"), F.lit(NO_DATE))
            changes.write(changes.read(name, schema).where(date.isin(several)), name)
            compacted = True
    if compacted:
        changes.commit()
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name, schema in tables.items():
        table = f"{database}.{name}"
        ensure_table(spark, table, schema, columns.date, location=f"{out}/{name}")
        places = {date: where[0] for date, where in partition_places(spark, out, name, columns.date).items()}
        if not places:  # not on the list: nothing yet, or written in place
            if changes.dates(name):
                spark.catalog.recoverPartitions(table)
            continue
        known = {row[0].partition("=")[2] for row in spark.sql(f"SHOW PARTITIONS {table}").collect()}
        spec = lambda date: f"PARTITION ({columns.date} = " + ("NULL)" if date in (NO_DATE, "null") else f"'{date}')")
        known = {NO_DATE if date == "null" else date for date in known}
        for date in sorted(known & set(places)):
            spark.sql(f"ALTER TABLE {table} {spec(date)} SET LOCATION '{places[date]}'")
        if new := sorted(set(places) - known):
            spark.sql(f"ALTER TABLE {table} ADD " + " ".join(f"{spec(date)} LOCATION '{places[date]}'" for date in new))
        for date in sorted(known - set(places)):
            spark.sql(f"ALTER TABLE {table} DROP {spec(date)}")
        spark.catalog.refreshTable(table)


def run(spark: SparkSession, bronze: str | list[str], out: str, run_ts: dt.datetime, *,
        multi_line: bool = True, from_date: dt.date | None = None, columns: Columns = DEFAULT,
        rows_per_piece: int = ROWS_PER_PIECE, late: bool = False, replace: bool = False,
        new_only: bool = False, most_rejects: float = MOST_REJECTS) -> RunMetrics:
    """Silver, then Gold, which appear together. A stage that fails ends the run and leaves all tables as they were; where
    no row is valid Silver alone appears.

    With ``from_date`` only the folders of Bronze from that date on are parsed, if ``bronze`` is one
    folder of date folders; Silver and Gold keep the dates before. With ``new_only`` only files not read yet are parsed, and Gold is
    built from the first of their dates on; without any new file nothing changes.
    """
    if from_date is not None and isinstance(bronze, str):
        bronze = date_folders(spark, bronze, from_date)
    changes = Changes(spark, out, columns.date)
    metrics = run_silver(spark, bronze, out, run_ts, multi_line=multi_line, columns=columns, late=late, replace=replace,
                         new_only=new_only, most_rejects=most_rejects, changes=changes)
    if new_only:
        dates = [dt.date.fromisoformat(date) for date in changes.written(PRODUCTS) if date != NO_DATE]
        if not changes.written(PRODUCTS):
            return metrics
        from_date = min(dates) if dates and changes.dates("price_history") else None  # undated rows may sort anywhere
        if NO_DATE in changes.written(PRODUCTS):
            from_date = None
    try:
        run_gold(spark, f"{changes.out}/{PRODUCTS}", out, run_ts, from_date=from_date, columns=columns,
                 rows_per_piece=rows_per_piece, metrics=metrics, changes=changes)
    except EmptyInputError:
        changes.commit()
        raise
    changes.commit()
    return metrics
