"""Keyed state on disk in buckets by key, of which a load writes those it touches.

The state of a change log is split by a hash of its keys. A load reads and writes the buckets that hold its keys and
leaves the files of all others; the list of bucket versions appears when all are written. So a load that fails leaves the state as it was,
and applying it again changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.operators.changes import current_rows, fold_changes, merge_states
from shelfline.session import fresh_path
from shelfline.sinks.versions import Changes, read_listed

STATE, BUCKET = "state", "bucket"
BUCKETS = 256


def apply_to_buckets(log: DataFrame, path: str, keys: Sequence[str], columns: Sequence[str], *, keep_earliest: Sequence[str] = (),
                     buckets: int = BUCKETS) -> list[str]:
    """Apply a further log to the state kept at path and return the buckets written. The first load settles how many there are."""
    spark = log.sparkSession
    changes = Changes(spark, path, BUCKET)
    count = changes.marks.setdefault("buckets", buckets)
    folded = fold_changes(log, keys, columns, keep_earliest=keep_earliest).withColumn(BUCKET, F.pmod(F.xxhash64(*keys), F.lit(count)).cast("int"))
    if changes.dates(STATE):
        folded.write.parquet(at := fresh_path(spark, "load"))  # read three times
        folded = spark.read.schema(folded.schema).parquet(at)
        # as many as buckets, and known before the state is read, whose other buckets are not opened
        touched = [row[0] for row in folded.select(BUCKET).distinct().collect()]
        state = changes.read(STATE, folded.schema).where(F.col(BUCKET).isin(touched))
        folded = merge_states(state.select(folded.columns), folded, [*keys, BUCKET], keep_earliest)
    changes.write(folded, STATE)
    changes.commit()
    return sorted(changes.written(STATE), key=int)


def read_buckets(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    """The state of all keys, None before the first load. ``schema`` is that of ``fold_changes``."""
    schema = T.StructType([f for f in schema.fields if f.name != BUCKET] + [T.StructField(BUCKET, T.IntegerType())])
    return read_listed(spark, f"{path.rstrip('/')}/{STATE}", schema, BUCKET)


def read_rows(log: DataFrame, path: str, keys: Sequence[str], columns: Sequence[str], *, keep_earliest: Sequence[str] = ()) -> DataFrame:
    """The rows that the state has led to. Of ``log`` the columns alone matter."""
    schema = fold_changes(log, keys, columns, keep_earliest=keep_earliest).schema
    return current_rows(read_buckets(log.sparkSession, path, schema), keys, columns, keep_earliest=keep_earliest)
