"""Raw observations to Silver rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline import fixed_values as fixed
from shelfline.functions.columns import as_double, as_int, run_time, utc_date
from shelfline.schemas import DEFAULT, Columns


def dq_status(price: Column, title: Column, rating: Column,
              rating_bounds: tuple[float, float] = fixed.RATING_BOUNDS) -> Column:
    """The first fault of a row, else VALID. A rating may be missing; a price may be NaN."""
    lowest, highest = rating_bounds
    return (F.when(F.coalesce(price <= 0, F.lit(True)), fixed.INVALID_PRICE)
            .when(title.isNull(), fixed.MISSING_TITLE)
            .when(~rating.between(lowest, highest), fixed.INVALID_RATING)
            .otherwise(fixed.VALID))


def _is(rows: DataFrame, name: str, kind: str) -> bool:
    return rows.schema[name].dataType.simpleString() == kind


def standardize(raw: DataFrame, run_ts: dt.datetime | None = None, *, columns: Columns = DEFAULT,
                source_system: str = fixed.SOURCE_SYSTEM) -> DataFrame:
    """Typed, trimmed and flagged rows in the column order of the Silver table."""
    c = columns
    # A column that has its type is passed on as it is. An alias would hide from Spark that
    # two uses of these rows are the same, and they would be shuffled twice.
    price = F.col(c.price) if _is(raw, c.price, "double") else as_double(c.price).alias(c.price)
    rating = F.col(c.rating) if _is(raw, c.rating, "double") else as_double(c.rating).alias(c.rating)
    title = F.trim(c.title)
    return raw.select(
        F.col(c.key),
        title.alias(c.title),
        price,
        rating,
        as_int(c.reviews).alias(c.reviews),
        F.col(c.stock),
        F.trim(F.upper(c.category)).alias(c.category),
        F.col(c.source),
        F.lit(source_system).alias("source_system"),
        F.col(c.time),
        utc_date(c.time).alias(c.date),
        run_time(run_ts).alias("processed_at"),
        dq_status(price, title, rating).alias(c.status),
    )


def quality_gate(silver: DataFrame, *, columns: Columns = DEFAULT) -> DataFrame:
    """The rows that may reach Gold."""
    return silver.where(F.col(columns.status) == fixed.VALID)


def status_counts(silver: DataFrame, *, columns: Columns = DEFAULT) -> DataFrame:
    """Rows per status."""
    return silver.groupBy(columns.status).agg(F.count(F.lit(1)).alias("row_count"))


def status_summary(silver: DataFrame, *, columns: Columns = DEFAULT) -> DataFrame:
    """One row: total, valid and invalid rows, and the valid share in percent."""
    total = F.count(F.lit(1))
    valid = F.count_if(F.col(columns.status) == fixed.VALID)
    return silver.agg(
        total.alias("total_records"),
        valid.alias("valid_records"),
        (total - valid).alias("invalid_records"),
        (F.try_divide(valid, total) * 100).alias("valid_pct"),
    )
