"""Change logs: header-less CSV in ``public/<table>/yyyy/MM/dd``, operation code first."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamReader

from shelfline import fixed_values as fixed
from shelfline.schemas import FEEDS, ChangeFeed

BAD_LINE = "bad_line"
LINE = "line"  # where a line stands: file below the feed's folder, start of its part of the file, number within it (in a stream a hash)
REASON = "reject_reason"


def feed_of(table: str | ChangeFeed) -> ChangeFeed:
    return FEEDS[table] if isinstance(table, str) else table


def text_schema(feed: ChangeFeed) -> T.StructType:
    """All positions as text, so that a value of a wrong type stays visible."""
    names = ["op", "change_ts", *feed.columns.fieldNames(), BAD_LINE]
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


def _lines(reader: DataFrameReader | DataStreamReader, feed: ChangeFeed, path: str, multi_line: bool) -> DataFrame:
    # The lines of one part of a file are read in their order by one task, and this number grows along it. Streams allow none.
    row = F.monotonically_increasing_id() if isinstance(reader, DataFrameReader) else F.xxhash64("op", "change_ts", *feed.columns.fieldNames())
    # A state holds the place of each value, so the file goes by its name below the feed's folder.
    file = F.substring_index("_metadata.file_path", f"/public/{feed.table}/", -1)
    # Without pruning every line is split whole, so a wrong number of values shows
    # whichever columns the query reads.
    return (reader.schema(text_schema(feed))
            .option("recursiveFileLookup", True)
            .option("columnPruning", False)
            .option("multiLine", multi_line)
            .option("columnNameOfCorruptRecord", BAD_LINE)
            .csv(path)
            .select("*", F.struct(file.alias("file"), F.col("_metadata.file_block_start").alias("block_start"), row.alias("row")).alias(LINE)))


def read_cdc(spark: SparkSession, root: str, table: str | ChangeFeed, *, multi_line: bool = True) -> DataFrame:
    """The change lines of one table as text, found by folder and not by file name.

    ``multi_line`` lets a quoted text hold line breaks; each file is then read by one task, which passes its lines on
    evenly to others and keeps none, so that what follows does not hold a file in one task. Without it large files are split.
    """
    feed = feed_of(table)
    lines = _lines(spark.read, feed, f"{root}/public/{feed.table}", multi_line)
    return lines.repartition(F.xxhash64(LINE)) if multi_line else lines


def read_cdc_all(spark: SparkSession, root: str,
                 include: Iterable[str] = tuple(FEEDS)) -> dict[str, DataFrame]:
    """The included tables of a change log, by name."""
    return {table: read_cdc(spark, root, table) for table in include}


def stream_cdc(spark: SparkSession, root: str, table: str | ChangeFeed,
               files_per_batch: int | None = None, *, multi_line: bool = True) -> DataFrame:
    """The change lines of one table as a file stream."""
    feed = feed_of(table)
    reader = spark.readStream
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return _lines(reader, feed, f"{root}/public/{feed.table}", multi_line)


def _given(column: str) -> Column:
    """Text of a column, NULL where it is empty."""
    return F.nullif(F.col(column), F.lit(""))


def decode_cdc(lines: DataFrame, table: str | ChangeFeed) -> DataFrame:
    """Typed change rows with ``seq``, which orders rows of one change time, and a
    ``reject_reason`` that is NULL for rows fit to apply.

    Of one time, inserts come before updates and updates before deletes, and further ones in the order of files by name and of their lines.
    Lines that come from no file, and those of one file in a stream, are ordered by a hash instead.
    """
    feed = feed_of(table)
    typed, unreadable = [], F.lit(False)
    for field in feed.columns.fields:
        value = _given(field.name).try_cast(field.dataType)
        typed.append(value.alias(field.name))
        if not isinstance(field.dataType, T.StringType):
            unreadable = unreadable | (_given(field.name).isNotNull() & value.isNull())
    change_ts = _given("change_ts").try_cast("timestamp")
    keyless = F.lit(False)
    for key in feed.keys:
        keyless = keyless | _given(key).isNull()
    reason = (F.when(F.col(BAD_LINE).isNotNull(), "wrong number of values")
              .when(F.col("op").isNull() | ~F.col("op").isin(*fixed.OP_CODES.values()), "unknown operation")
              .when(change_ts.isNull(), "no change time")
              .when(keyless, "no key")
              .when(unreadable, "value of a wrong type"))
    rank = F.coalesce(F.array_position(F.array(*map(F.lit, fixed.OP_CODES.values())), F.col("op")), F.lit(0))
    place = F.col(LINE) if LINE in lines.columns else F.struct(
        F.lit("").alias("file"), F.lit(0).cast("long").alias("block_start"),
        F.xxhash64(*[name for name in lines.columns if name != BAD_LINE]).alias("row"))
    return lines.select("op", change_ts.alias("change_ts"), *typed, F.struct(rank.cast("int").alias("rank"), place.alias("at")).alias("seq"),
                        F.col(BAD_LINE), reason.alias(REASON))


def accepted(decoded: DataFrame) -> DataFrame:
    return decoded.where(F.col(REASON).isNull()).drop(REASON, BAD_LINE)


def quarantined(decoded: DataFrame) -> DataFrame:
    return decoded.where(F.col(REASON).isNotNull())
