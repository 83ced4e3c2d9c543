"""Series cut in pieces of about equal numbers of rows.

One product, category or order may hold a third of all rows, and a window over it would run in a single task. So the keys that hold more than
a piece are cut: splitters are drawn from a sample of (key, order), as for a range partitioning, and a row's piece is the number of
its key's splitters that are not above it. Pieces follow the rows and not their values: stamps of one minute, or prices within a cent, are cut
like any others. Rows are shuffled once, by key and piece; what a piece needs of those before it is one row or one number for each,
and the splitters bound how many there are. Keys without splitters are one piece, which is the plain window.

Cuts change no result, only which task a row goes to, so the sample need not be exact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfline.session import fresh_path

ROWS_PER_PIECE = 250_000
MOST_PIECES = 10_000  # bounds what is broadcast
SAMPLED = 20          # rows drawn for each piece

KEY, AT, HEAVY, CUTS, REPEATS = "_key", "_piece", "_heavy", "_cuts", "_repeats"
_STEPS = [2**k for k in range(MOST_PIECES.bit_length() - 1, -1, -1)]


def cuts_of(rows: DataFrame, by: Sequence[str], order: Sequence[str], rows_per_piece: int = ROWS_PER_PIECE) -> DataFrame | None:
    """The splitters of each key that holds more than a piece, at most MOST_PIECES in all; None if no key does.

    Counts the rows, and if they are more than a task should hold draws SAMPLED for each piece: of the keys first, and only where one may
    have two splitters of keys and places. Reads key columns, and order columns then only.
    """
    total = rows.count()
    pieces = min(MOST_PIECES, total // rows_per_piece)
    if pieces < 2:
        return None
    spark, path = rows.sparkSession, fresh_path(rows.sparkSession, "cuts")
    drawn, every = min(1.0, SAMPLED * pieces / total), max(1, round(min(SAMPLED, total / pieces)))
    keys = rows.select(F.struct(*by).alias(KEY)).sample(drawn, seed=17)
    if keys.groupBy(KEY).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > every).isEmpty():
        return None
    sample = rows.select(F.struct(*by).alias(KEY), F.struct(*order).alias("_place")).sample(drawn, seed=17)
    # the sample has a bound, so one task may number it
    (sample.withColumn("_n", F.row_number().over(Window.orderBy(KEY, "_place"))).where(F.col("_n") % every == 0)
     .groupBy(KEY).agg(F.sort_array(F.collect_list("_place")).alias(CUTS)).where(F.size(CUTS) >= 2)
     .coalesce(1).write.parquet(path))
    cuts = spark.read.parquet(path)
    return None if cuts.isEmpty() else cuts


def _below(place: Column, inclusive: bool) -> Column:
    """How many splitters are below a row (or beside it), by halving."""
    def step(found: Column, size: Column) -> Column:
        cut = F.get(F.col(CUTS), found + size - 1)
        return found + F.when((found + size <= F.size(CUTS)) & ((cut <= place) if inclusive else (cut < place)), size).otherwise(0)
    return F.aggregate(F.array(*map(F.lit, _STEPS)), F.lit(0), step)


def with_piece(rows: DataFrame, by: Sequence[str], order: Sequence[str], cuts: DataFrame) -> DataFrame:
    """Add the key, the piece, and whether a row's place alone fills several pieces (then how many it fills).

    Rows of such a place have a piece of their own, with an even number. Rows of keys without cuts have piece 0.
    """
    cut = rows.withColumn(KEY, F.struct(*by)).join(F.broadcast(cuts), KEY, "left")
    place, known = F.struct(*order), F.col(CUTS).isNotNull()
    return (cut.withColumn("_upto", F.when(known, _below(place, True)))
            .withColumn(REPEATS, F.when(known, F.col("_upto") - _below(place, False)))
            .withColumn(HEAVY, F.coalesce(F.col(REPEATS) >= 2, F.lit(False)))
            .withColumn(AT, F.coalesce(2 * F.col("_upto") + F.when(F.col(HEAVY), 0).otherwise(1), F.lit(0)))
            .drop(CUTS, "_upto"))
