"""Change logs applied as they arrive.

The state of each key is kept by the streaming aggregate itself. A batch writes
the keys it touched to a folder of its own, so writing a batch again replaces it,
and its size follows the batch and not the table. Every so many batches the newest state of all keys
is written as a base, and readers take the newest base and the batches after it.
"""

from __future__ import annotations

from collections.abc import Sequence

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shelfline.operators.changes import current_rows, fold_changes
from shelfline.operators.snapshots import latest_per
from shelfline.sinks.tables import folder_names, remove_folder

BATCH = "batch_id"
BASE = "base_"


def stream_changes(changes: DataFrame, out: str, checkpoint: str, keys: Sequence[str],
                   columns: Sequence[str], *, keep_earliest: Sequence[str] = (), op: str = "op",
                   order: Sequence[str] = ("change_ts", "seq"), compact_every: int = 50) -> StreamingQuery:
    """Fold all changes not seen yet into the state of their keys, then stop.

    Deleted keys stay in the state with the time of their deletion, so a late older
    change does not bring one back.
    """
    state = fold_changes(changes, keys, columns, keep_earliest=keep_earliest, op=op, order=order)
    return write_states(state, out, checkpoint, keys, compact_every)


def write_states(state: DataFrame, out: str, checkpoint: str, keys: Sequence[str], compact_every: int = 50) -> StreamingQuery:
    """Write the states of a streaming aggregate by keys, those a batch has touched, and stop when all input is read."""
    def write(states: DataFrame, batch_id: int) -> None:
        states.write.mode("overwrite").parquet(f"{out}/{BATCH}={batch_id}")
        if batch_id % compact_every == compact_every - 1:
            compact(states.sparkSession, out, keys)

    return (state.writeStream.outputMode("update").foreachBatch(write)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def _bases(spark: SparkSession, out: str) -> list[int]:
    """The last batch that each base holds; bases whose write did not end don't count."""
    return sorted(int(name) for name in folder_names(spark, out, BASE, complete=True))


def read_state(spark: SparkSession, out: str, keys: Sequence[str]) -> DataFrame:
    """The newest state of each key."""
    bases = _bases(spark, out)
    last = bases[-1] if bases else -1
    newer = sorted(n for n in map(int, folder_names(spark, out, f"{BATCH}=", complete=True)) if n > last)
    parts = [spark.read.parquet(f"{out}/{BASE}{last}").withColumn(BATCH, F.lit(last))] if bases else []
    if newer:
        parts.append(spark.read.option("basePath", out).parquet(*[f"{out}/{BATCH}={n}" for n in newer]))
    return latest_per(reduce(DataFrame.unionByName, parts), keys, [BATCH]).drop(BATCH)


def compact(spark: SparkSession, out: str, keys: Sequence[str]) -> int:
    """Write the newest state of each key as a base; batches and bases that the base before held already go."""
    bases = _bases(spark, out)
    batches = sorted(map(int, folder_names(spark, out, f"{BATCH}=", complete=True)))
    last = batches[-1]
    if bases and bases[-1] >= last:
        return last
    read_state(spark, out, keys).write.mode("overwrite").parquet(f"{out}/{BASE}{last}")
    for old in bases[:-1]:
        remove_folder(spark, f"{out}/{BASE}{old}")
    for batch in batches:
        if bases and batch <= bases[-1]:
            remove_folder(spark, f"{out}/{BATCH}={batch}")
    return last


def read_current(spark: SparkSession, out: str, keys: Sequence[str], columns: Sequence[str], *,
                 keep_earliest: Sequence[str] = ()) -> DataFrame:
    """The rows the log has led to."""
    return current_rows(read_state(spark, out, keys), keys, columns, keep_earliest=keep_earliest)

