"""Written tables: Parquet folders and catalog tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.schemas import DEFAULT, SILVER, Columns
from shelfline.sinks.versions import read_listed


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A partitioned Parquet table, as the newest list of its folder has it. Partitions stay prunable."""
    listed = read_listed(spark, path, schema, DEFAULT.date)
    if listed is not None:
        return listed
    return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())


def read_merged(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table whose files were appended with differing columns: all of them."""
    return spark.read.option("mergeSchema", True).parquet(path)


def read_silver(spark: SparkSession, path: str, *, from_date: dt.date | None = None,
                columns: Columns = DEFAULT) -> DataFrame:
    """The Silver table, or its partitions from a date on."""
    silver = read_table(spark, path, SILVER)
    return silver if from_date is None else silver.where(F.col(columns.date) >= F.lit(from_date))
