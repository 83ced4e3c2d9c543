"""Keyed state on disk, replaced as a whole by each applied load.

A load writes the next snapshot to a folder of its own; it counts from the moment its write has ended, and readers take the
newest that has. So a load that fails leaves the state as it was, and applying it again is safe: a log
applied twice changes nothing. The snapshot before stays for readers that began with it; older ones go.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from shelfline.operators.changes import apply_changes, current_rows
from shelfline.sinks.tables import folder_names, remove_folder

VERSION = "snapshot="


def versions(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(name) for name in folder_names(spark, path, VERSION, complete=True))


def read_snapshot(spark: SparkSession, path: str) -> DataFrame | None:
    """The newest snapshot, None before the first."""
    known = versions(spark, path)
    return spark.read.parquet(f"{path}/{VERSION}{known[-1]}") if known else None


def write_snapshot(rows: DataFrame, path: str) -> int:
    """Write rows as the next snapshot and return its number."""
    spark = rows.sparkSession
    known = versions(spark, path)
    number = known[-1] + 1 if known else 0
    rows.write.mode("overwrite").parquet(f"{path}/{VERSION}{number}")
    for old in known[:-1]:
        remove_folder(spark, f"{path}/{VERSION}{old}")
    return number


def apply_to_snapshot(changes: DataFrame, path: str, keys: Sequence[str], columns: Sequence[str], *,
                      keep_earliest: Sequence[str] = ()) -> int:
    """Apply a further log to the state kept at path."""
    state = read_snapshot(changes.sparkSession, path)
    return write_snapshot(apply_changes(state, changes, keys, columns, keep_earliest=keep_earliest), path)


def read_rows(spark: SparkSession, path: str, keys: Sequence[str], columns: Sequence[str], *,
              keep_earliest: Sequence[str] = ()) -> DataFrame:
    """The rows that the newest state holds."""
    return current_rows(read_snapshot(spark, path), keys, columns, keep_earliest=keep_earliest)
