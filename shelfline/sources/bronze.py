"""Raw observations: landed JSON and nested product payloads."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.functions.columns import iso_text, named
from shelfline.schemas import RAW

CORRUPT = "_corrupt_record"


def read_bronze(spark: SparkSession, path: str | Sequence[str], *, multi_line: bool = True,
                keep_corrupt: bool = False, schema: T.StructType = RAW) -> DataFrame:
    """Raw observations below ``path`` (or several), whatever the folders between.

    ``multi_line`` reads one object per file; without it, one object per line.
    ``keep_corrupt`` adds the text of records that are no JSON.
    """
    if keep_corrupt:
        schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    return (spark.read.schema(schema)
            .option("multiLine", multi_line)
            .option("recursiveFileLookup", True)
            .option("columnNameOfCorruptRecord", CORRUPT)
            .json(path if isinstance(path, str) else list(path)))


def list_files(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """file, size and modified of each file below ``path`` (or several). No file is opened."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", True)
            .load(path if isinstance(path, str) else list(path))
            .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"),
                    F.col("_metadata.file_modification_time").alias("modified")))


def read_with_origin(spark: SparkSession, path: str | Sequence[str], *, multi_line: bool = True, only: DataFrame | None = None,
                     since: dt.datetime | None = None, schema: T.StructType = RAW) -> DataFrame:
    """Raw observations with the text of records that are no JSON, their file and where in it the task that read them began.

    ``only`` are the files to take; ``since`` is the earliest time they were modified, and leaves older ones unopened.
    """
    rows = read_bronze(spark, path, multi_line=multi_line, keep_corrupt=True, schema=schema)
    if since is not None:
        rows = rows.where(F.col("_metadata.file_modification_time") >= F.lit(since))
    rows = rows.select("*", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block_start"))
    return rows if only is None else rows.join(only.select("file"), "file", "left_semi")


def flatten_payload(payloads: DataFrame, *, key: str = "asin", product: str = "product",
                    scraped_at: Column | None = None, source: str = "amazon_in") -> DataFrame:
    """Nested product documents as flat observations; a missing path is NULL.

    ``scraped_at`` is a time column, by default the time the query starts.
    """
    time = F.current_timestamp() if scraped_at is None else scraped_at
    return payloads.select(
        named(key),
        F.col(f"{product}.title").alias("title"),
        F.col(f"{product}.buybox_winner.price.value").alias("price"),
        F.col(f"{product}.rating").alias("rating"),
        F.col(f"{product}.ratings_total").alias("reviews_count"),
        F.col(f"{product}.buybox_winner.availability.type").alias("in_stock"),
        F.get(F.col(f"{product}.categories"), F.lit(0))["name"].alias("category"),
        iso_text(time).alias("scraped_at"),
        F.lit(source).alias("source"),
    )
