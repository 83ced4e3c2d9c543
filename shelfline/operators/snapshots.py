"""The latest row of each group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfline.schemas import DEFAULT, Columns


def latest_per(rows: DataFrame, by: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of each group by ``order``.

    The limit on the row number is applied before the shuffle as well, so a
    group sends one row per task, however large it is.
    """
    newest = Window.partitionBy(*by).orderBy(*[F.desc(name) for name in order])
    return (rows.withColumn("_newest", F.row_number().over(newest))
            .where(F.col("_newest") == 1).drop("_newest"))


def daily_latest(valid: DataFrame, *, columns: Columns = DEFAULT) -> DataFrame:
    """The last observation of each product on each date."""
    return latest_per(valid, [columns.key, columns.date], columns.order)


def current(valid: DataFrame, *, columns: Columns = DEFAULT) -> DataFrame:
    """The last observation of each product. The daily snapshot serves as input too."""
    return latest_per(valid, [columns.key], columns.order)


def preview(rows: DataFrame, names: Sequence[str], n: int) -> DataFrame:
    """Any ``n`` rows of some columns."""
    return rows.select(*names).limit(n)
