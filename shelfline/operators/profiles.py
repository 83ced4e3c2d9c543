"""Counts of each date that add up over dates, distinct ones included.

A date's profile holds plain counts and, for each distinct count of the quality report, a sketch. Profiles of any dates merge to one: counts are
summed, sketches united, so a report on a month reads a row for each of its dates and no observation. A distinct count from sketches has a
relative standard error of ``error_of(precision)``; the exact count remains ``quality_report``.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.schemas import DEFAULT, Columns

PRECISION = 14  # sketches of at most 2**14 registers


def error_of(precision: int = PRECISION) -> float:
    """The relative standard error of a distinct count; three times it holds for all but one count in 370."""
    return 1.04 / math.sqrt(2**precision)


def _told_apart(c: Columns) -> dict[str, Column]:
    """What is counted once for each distinct value, as text that differs where the values do; NULL counts as a value but for times."""
    def text(*names: str) -> Column:
        return F.to_json(F.struct(*names), {"ignoreNullFields": "false"})
    return {"distinct_records": text(c.key, c.time), "distinct_products": text(c.key), "distinct_sources": text(c.source),
            "distinct_scrape_times": F.col(c.time)}


def date_profiles(rows: DataFrame, *, columns: Columns = DEFAULT, precision: int = PRECISION) -> DataFrame:
    """One row for each date of Silver rows. Sketches are made before the shuffle, which carries one for each task and date."""
    c = columns
    return rows.groupBy(c.date).agg(
        F.count(F.lit(1)).alias("total_records"),
        *[F.count_if(F.col(name).isNull()).alias(f"null_{name}") for name in (c.price, c.rating, c.title, c.stock)],
        *[F.hll_sketch_agg(column, precision).alias(name) for name, column in _told_apart(c).items()])


def merge_profiles(profiles: DataFrame, by: Sequence[Column] = (), *, columns: Columns = DEFAULT) -> DataFrame:
    """The counts of all dates together, or of those that ``by`` puts together, such as a month."""
    distinct = list(_told_apart(columns))
    plain = [name for name in profiles.columns if name not in (columns.date, *distinct)]
    return profiles.groupBy(*by).agg(
        *[F.sum(name).alias(name) for name in plain],
        *[F.hll_sketch_estimate(F.hll_union_agg(name)).alias(name) for name in distinct])
