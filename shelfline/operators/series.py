"""Values of the row before, along the time series of each key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfline.operators.pieces import AT, HEAVY, KEY, REPEATS, ROWS_PER_PIECE, cuts_of, with_piece

COPIES_PER_ROW = 100_000


def with_previous(rows: DataFrame, by: Sequence[str], order: Sequence[str], previous: Mapping[str, str], *,
                  rows_per_piece: int | None = ROWS_PER_PIECE) -> DataFrame:
    """Add ``{new column: column of the row before}`` for each key, NULL on its first row.

    ``order`` should tell all rows of a key apart but for exact copies. Series of more rows than a piece are cut, whatever their
    times, and the last row of a piece is handed to the next. None cuts nothing: only where the rows per key have a bound.
    """
    cuts = None if rows_per_piece is None else cuts_of(rows, by, order, rows_per_piece)
    if cuts is None:
        series = Window.partitionBy(*by).orderBy(*order)
        return rows.withColumns({new: F.lag(old).over(series) for new, old in previous.items()})

    # Exact copies that would fill pieces are one row with a count before anything is shuffled by key.
    placed = with_piece(rows, by, order, cuts).drop(REPEATS)
    copies = (placed.where(HEAVY).groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("_copies")))
    single = placed.where(~F.col(HEAVY)).unionByName(
        with_piece(copies.drop("_copies"), by, order, cuts).drop(REPEATS))

    piece = Window.partitionBy(KEY, AT).orderBy(*order)
    looked_back = single.select("*", F.row_number().over(piece).alias("_position"),
                                *[F.lag(old).over(piece).alias(new) for new, old in previous.items()])
    # One row for each piece, its last, is handed to the piece after it: as many as splitters, at most.
    last = F.max(F.struct(*order, *[F.col(old).alias(f"_{new}") for new, old in previous.items()]))
    tails = single.where(F.col(AT) > 0).groupBy(KEY, AT).agg(last.alias("_tail"))
    handed = tails.select(F.struct(KEY, AT).alias("_to"), F.lag("_tail").over(Window.partitionBy(KEY).orderBy(AT)).alias("_before"))
    begins = (F.col("_position") == 1) & (F.col(AT) > 0)
    # No other row has a _to, so no other row finds a match.
    first = (looked_back.withColumn("_to", F.when(begins, F.struct(KEY, AT)))
             .join(F.broadcast(handed), "_to", "left")
             .withColumns({new: F.when(begins, F.col(f"_before._{new}")).otherwise(F.col(new)) for new in previous}))
    # Every further copy stands behind a copy of itself.
    further = _spread(copies.where(F.col("_copies") > 1), rows.columns).withColumns(
        {new: F.col(old) for new, old in previous.items()})
    wanted = [*rows.columns, *previous]
    return first.select(*wanted).unionByName(further.select(*wanted))


def _spread(counted: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``_copies - 1`` rows for each row, written out by several tasks where there are many."""
    more = F.col("_copies") - 1
    blocks = counted.select(*columns, more.alias("_more"), F.explode(
        F.sequence(F.lit(0), F.floor((more - 1) / COPIES_PER_ROW))).alias("_block"))
    size = F.least(F.lit(COPIES_PER_ROW), F.col("_more") - F.col("_block") * COPIES_PER_ROW)
    return (blocks.repartition(*columns, "_block")
            .withColumn("_copy", F.explode(F.sequence(F.lit(1), size.cast("int"))))
            .select(*columns))
