"""Landed JSON to Silver rows as a file stream."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from shelfline import fixed_values as fixed
from shelfline.operators.standardize import quality_gate, standardize
from shelfline.schemas import DEFAULT, RAW, Columns
from shelfline.sinks.versions import CARRY, PROFILES, Changes
from shelfline.streaming.changes import read_state, write_states


def stream_bronze(spark: SparkSession, path: str, *, multi_line: bool = True,
                  files_per_batch: int | None = None, schema: T.StructType = RAW) -> DataFrame:
    """Raw observations as their files arrive."""
    reader = (spark.readStream.schema(schema).option("multiLine", multi_line)
              .option("recursiveFileLookup", True))
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(path)


def stream_silver(raw: DataFrame, out: str, checkpoint: str, run_ts: dt.datetime | None = None, *,
                  columns: Columns = DEFAULT, source_system: str = fixed.SOURCE_SYSTEM) -> StreamingQuery:
    """Add the Silver rows of all files not seen yet to the table ``out``, then stop. Each file counts once.

    A batch adds folders to its dates and appears with a mark that holds its number, so a batch that is run again changes
    nothing, and batch runs and this stream write and read one table. ``out`` is a table of its parent folder, as ``run_silver`` writes it.
    """
    folder, _, name = out.rstrip("/").rpartition("/")

    def add(rows: DataFrame, batch_id: int) -> None:
        changes = Changes(rows.sparkSession, folder, columns.date)
        mark = f"stream {checkpoint}"
        if changes.marks.get(mark, -1) >= batch_id:
            return
        changes.write(rows, name, append=True)
        changes.drop_from(CARRY, changes.written(name))  # states and counts that lack these rows
        changes.drop(PROFILES, changes.written(name))
        changes.marks[mark] = batch_id
        changes.commit()

    return (standardize(raw, run_ts, columns=columns, source_system=source_system).writeStream.foreachBatch(add)
            .option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start())


def stream_current(silver: DataFrame, out: str, checkpoint: str, *, columns: Columns = DEFAULT, compact_every: int = 50) -> StreamingQuery:
    """Keep the last valid row of each product as observations arrive, then stop.

    The state of a product is the greatest of its rows by the order of ``current``; it lives in the aggregate, and a
    batch writes the products it touched. Late rows that sort before change nothing.
    """
    others = [name for name in silver.columns if name not in (columns.key, *columns.order)]
    newest = F.max(F.struct(*columns.order, *others)).alias("row")
    return write_states(quality_gate(silver, columns=columns).groupBy(columns.key).agg(newest), out, checkpoint, [columns.key], compact_every)


def read_last(spark: SparkSession, out: str, *, columns: Columns = DEFAULT) -> DataFrame:
    """The last valid row of each product, as ``stock_gap`` takes them."""
    return read_state(spark, out, [columns.key]).select(columns.key, "row.*")
