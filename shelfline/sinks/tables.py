"""Date-partitioned tables that can be written again without doubling rows."""

from __future__ import annotations

import datetime as dt
import hashlib
from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.functions.columns import named
from shelfline.schemas import ChangeFeed
from shelfline.session import setting, shared_dir
from shelfline.sources.cdc import feed_of


#: What Spark names the folder of rows without a date.
NO_DATE = "__HIVE_DEFAULT_PARTITION__"
#: Change rows in a file: one whose texts hold line breaks is read whole by one task.
ROWS_PER_FILE = 250_000
#: Folders of files with one text each.
FOLDERS = 64


def ensure_table(spark: SparkSession, name: str, schema: T.StructType, partition: str,
                 location: str | None = None, properties: Mapping[str, str] | None = None) -> None:
    """Create a catalog table if it is missing, with the comments of its schema."""
    def column(field: T.StructField) -> str:
        comment = (field.metadata or {}).get("comment", "").replace("'", "\\'")
        return f"{field.name} {field.dataType.simpleString()}" + (f" COMMENT '{comment}'" if comment else "")

    place = f"LOCATION '{location}'" if location else ""
    notes = ", ".join(f"'{key}' = '{value}'" for key, value in (properties or {}).items())
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({', '.join(map(column, schema.fields))}) "
              f"USING parquet PARTITIONED BY ({partition}) {place} "
              + (f"TBLPROPERTIES ({notes})" if notes else ""))


def ready_rows(rows: DataFrame, partition: str) -> tuple[DataFrame, Observation]:
    """Rows of a date together, so that each date gets few files, and their count.

    Adaptive execution splits a large date over several tasks and joins small ones
    in one. The rows are counted behind that shuffle, by the tasks that write them,
    so a repeated map task counts none twice.
    """
    seen = Observation()
    return rows.hint("rebalance", partition).observe(seen, F.count(F.lit(1)).alias("rows")), seen


def folder_names(spark: SparkSession, path: str, prefix: str, *, complete: bool = False) -> list[str]:
    """What follows the prefix in the names of a path's folders; only folders whose write ended, if asked for."""
    jvm = spark._jvm.org.apache.hadoop.fs
    root = jvm.Path(path)
    store = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not store.exists(root):
        return []
    return [f.getPath().getName()[len(prefix):] for f in store.listStatus(root)
            if f.isDirectory() and f.getPath().getName().startswith(prefix)
            and (not complete or store.exists(jvm.Path(f.getPath(), "_SUCCESS")))]


def remove_folder(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def date_files(spark: SparkSession, path: str, partition: str) -> dict[str, set[str]]:
    """The files of each date folder of a table, whatever store it is in; none if there is no table yet."""
    jvm = spark._jvm.org.apache.hadoop.fs
    root = jvm.Path(path)
    store = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not store.exists(root):
        return {}
    folders = [f.getPath() for f in store.listStatus(root) if f.getPath().getName().startswith(f"{partition}=")]
    return {f.getName().partition("=")[2]: {x.getPath().getName() for x in store.listStatus(f)} for f in folders}


def table_exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def date_folders(spark: SparkSession, path: str, from_date: dt.date, folder: str = "dt") -> str | list[str]:
    """The folders ``folder=date`` of a path from a date on; the path itself if it has no such folders."""
    dates = date_files(spark, path, folder)
    wanted = [f"{path}/{folder}={date}" for date in sorted(dates) if date == NO_DATE or date[:10] >= from_date.isoformat()]
    return wanted if dates else path


def write_table(rows: DataFrame, path: str, partition: str = "scrape_date", *,
                mode: str = "overwrite", replace_all: bool = False, replace_from: dt.date | None = None) -> int:
    """Write a partitioned Parquet folder and return the number of rows written.

    ``overwrite`` replaces the dates the rows hold and leaves the others, unless all
    are to be replaced, or all from a date on: dates from ``replace_from`` that the rows don't hold go once
    the rows are written. A run that fails before leaves them, and running again removes them.
    """
    spark = rows.sparkSession
    before = date_files(spark, path, partition) if replace_from is not None else {}
    ready, seen = ready_rows(rows, partition)
    (ready.write.option("partitionOverwriteMode", "static" if replace_all else "dynamic")
     .partitionBy(partition).mode(mode).parquet(path))
    if replace_from is not None:
        after = date_files(spark, path, partition)
        for date, files in before.items():
            # a date that was written again has new files
            if date[:10] >= replace_from.isoformat() and date != NO_DATE and after.get(date) == files:
                remove_folder(spark, f"{path}/{partition}={date}")
    return seen.get.get("rows", 0)


class NarrowColumnError(ValueError):
    """Rows have a wider type than a column of a table whose files belong to the catalog."""


_WIDTHS = (("tinyint", "smallint", "int", "bigint"), ("float", "double"))


def _wider(new: T.DataType, old: T.DataType) -> bool:
    """Whether a type holds all values of another one and more."""
    if isinstance(new, T.DecimalType) and isinstance(old, T.DecimalType):
        return new != old and new.scale >= old.scale and new.precision - new.scale >= old.precision - old.scale
    return any(new.simpleString() in kinds and old.simpleString() in kinds
               and kinds.index(new.simpleString()) > kinds.index(old.simpleString()) for kinds in _WIDTHS)


def widen_columns(spark: SparkSession, name: str, wider: Mapping[str, T.DataType]) -> None:
    """Give columns of a catalog table with a location of its own wider types. Its files stay as they are: Spark reads their narrower
    numbers as the wider type. The table is defined anew, so it is missing from the catalog for a moment."""
    described = {row.col_name: row.data_type for row in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    if described.get("Type") != "EXTERNAL":
        raise NarrowColumnError(f"{name} has narrower columns than {sorted(wider)}; only a table with a location of its own can be defined anew")
    table = spark.table(name).schema
    partition = next(column.name for column in spark.catalog.listColumns(name) if column.isPartition)
    properties = {row.key: row.value for row in spark.sql(f"SHOW TBLPROPERTIES {name}").collect() if not row.key.startswith("transient")}
    schema = T.StructType([T.StructField(f.name, wider.get(f.name.lower(), f.dataType), f.nullable, f.metadata) for f in table])
    spark.sql(f"DROP TABLE {name}")
    ensure_table(spark, name, schema, partition, location=described["Location"], properties=properties)
    spark.catalog.recoverPartitions(name)


def write_catalog_table(rows: DataFrame, name: str, partition: str = "scrape_date", *,
                        overwrite: bool = True) -> int:
    """The same for a catalog table; columns are matched by name.

    Columns the table lacks are added to it first, NULL in its older rows; columns the rows lack are written as NULL. Columns whose
    numbers are wider in the rows are widened in the table first, or a NarrowColumnError is raised before anything is written.
    """
    spark = rows.sparkSession
    held = {field.name.lower(): field.dataType for field in spark.table(name).schema}
    wider = {field.name.lower(): field.dataType for field in rows.schema
             if field.name.lower() in held and _wider(field.dataType, held[field.name.lower()])}
    if wider:
        widen_columns(spark, name, wider)
    known = {column.lower() for column in spark.table(name).columns}
    new = [field for field in rows.schema if field.name.lower() not in known]
    if new:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ("
                  + ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in new) + ")")
    given = {column.lower() for column in rows.columns}
    ready, seen = ready_rows(rows.select(
        *[(F.col(f"`{field.name}`") if field.name.lower() in given else F.lit(None)).cast(field.dataType).alias(field.name)
          for field in spark.table(name).schema]), partition)
    # An insert by table name takes the mode from the session and no option for it.
    with setting(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
        ready.write.insertInto(name, overwrite=overwrite)
    return seen.get.get("rows", 0)


def stage(rows: DataFrame, name: str, owner: str) -> DataFrame:
    """Rows written once to the shared folder, for plans that read them several times.

    A lost executor then costs a read and not the work before it. The next run of
    the same owner writes over the copy.
    """
    spark = rows.sparkSession
    path = f"{shared_dir(spark)}/stage/{hashlib.sha256(owner.encode()).hexdigest()[:16]}/{name}"
    rows.write.mode("overwrite").parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def land_raw(rows: DataFrame, path: str, *, time: str = "scraped_at", folder: str = "dt",
             rows_per_file: int | None = None, mode: str = "append") -> int:
    """Land observations as JSON by the date their time text starts with.

    ``rows_per_file=1`` gives the layout of one object per file.
    """
    ready, seen = ready_rows(rows.withColumn(folder, F.substring(named(time), 1, 10)), folder)
    writer = ready.write.partitionBy(folder).mode(mode).option("partitionOverwriteMode", "dynamic")
    if rows_per_file is not None:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.json(path)
    return seen.get.get("rows", 0)


def land_texts(texts: DataFrame, path: str, *, folders: int = FOLDERS, mode: str = "append") -> None:
    """Land each text of a single column as a file of its own, for records of several lines.

    Opening a file is most of the work, so the rows are dealt by hash to as many tasks as folders. Each writes a folder of its own, which
    the end of the job renames as a whole and which readers list beside others.
    """
    (texts.repartition(folders, *texts.columns).withColumn("part", F.spark_partition_id())
     .write.partitionBy("part").mode(mode).option("maxRecordsPerFile", 1).text(path))


def land_cdc(changes: DataFrame, root: str, feed: str | ChangeFeed, *, folder: str = "yyyy-MM-dd",
             rows_per_file: int = ROWS_PER_FILE, mode: str = "append") -> int:
    """Land change rows as header-less CSV, in folders by a format of the change time. A task goes on in a further file after so many rows."""
    feed = feed_of(feed)
    ready, seen = ready_rows(changes.select(
        "op", "change_ts", *feed.columns.fieldNames(),
        F.date_format("change_ts", folder).alias("at")), "at")
    (ready.write.partitionBy("at").mode(mode)
     .option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
     .option("maxRecordsPerFile", rows_per_file)
     .csv(f"{root}/public/{feed.table}"))
    return seen.get.get("rows", 0)
