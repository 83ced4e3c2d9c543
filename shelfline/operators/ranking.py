"""Rank within a group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfline.operators.pieces import AT, HEAVY, KEY, REPEATS, ROWS_PER_PIECE, cuts_of, with_piece


def with_rank(rows: DataFrame, by: Sequence[str], value: str, name: str, *, rows_per_piece: int | None = ROWS_PER_PIECE) -> DataFrame:
    """Add the rank by a number, lowest first: ties share a rank, and the next one skips.

    Groups of more rows than a piece are cut by value into pieces of about equal numbers of rows, whatever the values are.
    A rank is the one within the piece and the number of rows in lower pieces. Rows of a value that alone fills pieces have no others beside
    them, so they all have the rank that follows the lower pieces, and are spread over as many tasks as they fill.
    """
    cuts = None if rows_per_piece is None else cuts_of(rows, by, [value], rows_per_piece)
    if cuts is None:
        return rows.withColumn(name, F.rank().over(Window.partitionBy(*by).orderBy(value)))
    # The number of the partition spreads exact copies too; it is the same when a lost task runs again.
    spread = F.pmod(F.xxhash64(F.spark_partition_id(), *rows.columns), F.col(REPEATS))
    placed = with_piece(rows, by, [value], cuts).withColumn("_share", F.when(F.col(HEAVY), spread).otherwise(0))
    counts = placed.where(F.col(AT) > 0).groupBy(KEY, AT).agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy(KEY).orderBy(AT).rowsBetween(Window.unboundedPreceding, -1)
    # as many rows as pieces
    lower = F.broadcast(counts.select(KEY, AT, F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_lower")))
    in_piece = F.rank().over(Window.partitionBy(KEY, AT, "_share").orderBy(value))
    ranked = placed.withColumn("_in_piece", in_piece).join(lower, [KEY, AT], "left")
    return ranked.select(*rows.columns, (F.col("_in_piece") + F.coalesce("_lower", F.lit(0))).cast("int").alias(name))
