"""Keyed writes as joins: the base holds each key once, and so does the result."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.functions.columns import run_time

UPDATED = "updated_at"


def insert_ignore(base: DataFrame, new: DataFrame, keys: Sequence[str],
                  order: Sequence[str] | None = None) -> DataFrame:
    """Add the rows whose key is new, the first of each by ``order``; known keys stay as they are."""
    first = _per_key(new, keys, order).select(*keys, "_first.*")
    unknown = first.join(base.select(*keys), list(keys), "left_anti")
    return base.unionByName(unknown.select(*base.columns))


def update_by_key(base: DataFrame, changes: DataFrame, keys: Sequence[str], update: Sequence[str],
                  run_ts: dt.datetime | None = None, order: Sequence[str] | None = None, *,
                  stamp: str | None = UPDATED) -> DataFrame:
    """Set some columns of the rows a change names, NULL included, and stamp those rows."""
    return _merge(base, changes, keys, update, run_ts, order, stamp, "left")


def upsert(base: DataFrame, new: DataFrame, keys: Sequence[str], update: Sequence[str],
           run_ts: dt.datetime | None = None, order: Sequence[str] | None = None, *,
           stamp: str | None = UPDATED) -> DataFrame:
    """Add the rows whose key is new; of known keys set some columns only, and stamp them."""
    return _merge(base, new, keys, update, run_ts, order, stamp, "full_outer")


def _per_key(rows: DataFrame, keys: Sequence[str], order: Sequence[str] | None) -> DataFrame:
    """The first and the last row of each key, combined before the shuffle.

    Without an ``order`` the columns as they stand decide, so the result is the same every time.
    """
    rest = [name for name in rows.columns if name not in keys]
    placed = F.struct(F.struct(*(order or rest)).alias("at"), F.struct(*rest).alias("row"))
    return (rows.groupBy(*keys).agg(F.min(placed).alias("_min"), F.max(placed).alias("_max"))
            .select(*keys, F.col("_min.row").alias("_first"), F.col("_max.row").alias("_last")))


def _merge(base: DataFrame, new: DataFrame, keys: Sequence[str], update: Sequence[str],
           run_ts: dt.datetime | None, order: Sequence[str] | None, stamp: str | None,
           how: str) -> DataFrame:
    joined = (base.withColumn("_known", F.lit(True))
              .join(_per_key(new, keys, order).withColumn("_arrives", F.lit(True)), list(keys), how))
    arrives, known = F.col("_arrives").isNotNull(), F.col("_known").isNotNull()

    def merged(name: str) -> Column:
        if name in keys:
            return F.col(name)
        if name == stamp:
            return F.when(arrives, run_time(run_ts).cast(base.schema[name].dataType)).otherwise(F.col(name))
        if name in update:
            return F.when(arrives, F.col(f"_last.{name}")).otherwise(F.col(name))
        if name in new.columns:
            return F.when(known, F.col(name)).otherwise(F.col(f"_first.{name}"))
        return F.col(name)

    return joined.select(*[merged(name).alias(name) for name in base.columns])
