"""The five Gold tables and the product summary of Silver."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline import fixed_values as fixed
from shelfline.functions.columns import percent, run_time, steps
from shelfline.operators.pieces import ROWS_PER_PIECE
from shelfline.operators.ranking import with_rank
from shelfline.operators.series import with_previous
from shelfline.operators.snapshots import current, latest_per
from shelfline.schemas import DEFAULT, Columns

STAMP = "gold_processed_at"


def price_history(valid: DataFrame, run_ts: dt.datetime | None = None, *,
                  columns: Columns = DEFAULT, rows_per_piece: int = ROWS_PER_PIECE) -> DataFrame:
    """Each price beside the one before it. The direction follows the rounded difference."""
    c = columns
    shown = [c.key, c.title, c.price, c.rating, c.reviews, c.stock, c.category, c.source, c.time, c.date]
    rows = with_previous(valid.select(*shown), [c.key], c.order, {"previous_price": c.price},
                         rows_per_piece=rows_per_piece)
    price, before = F.col(c.price), F.col("previous_price")
    diff = F.round(price - before, 2)
    pct = F.when(before > 0, F.round(percent(price - before, before), 2))
    direction = (F.when(diff.isNull(), fixed.FIRST_RECORD).when(diff > 0, fixed.UP)
                 .when(diff < 0, fixed.DOWN).otherwise(fixed.STABLE))
    return rows.select(
        c.key, c.title, c.price, before,
        diff.alias("price_diff"),
        pct.alias("price_change_pct"),
        F.coalesce(diff != 0, F.lit(False)).alias("price_changed"),
        direction.alias("price_direction"),
        c.rating, c.reviews, c.stock, c.category, c.time, c.date,
        run_time(run_ts).alias(STAMP),
    )


def competitor_ranking(daily: DataFrame, run_ts: dt.datetime | None = None, *,
                       ranked_before: DataFrame | None = None, columns: Columns = DEFAULT,
                       rows_per_piece: int = ROWS_PER_PIECE) -> DataFrame:
    """Price rank within category and date on the daily snapshot, and its change since the
    product was last seen, in whichever category that was.

    ``ranked_before`` are rows of this table at earlier dates, for snapshots that
    start at some date.
    """
    c = columns
    shown = [c.key, c.title, c.category, c.price, c.rating, c.reviews, c.stock, c.date]
    ranked = (with_rank(daily.select(*shown), [c.category, c.date], c.price, "price_rank",
                        rows_per_piece=rows_per_piece)
              .withColumn("_new", F.lit(True)))
    if ranked_before is not None:
        last = latest_per(ranked_before, [c.key], [c.date]).select(*shown, "price_rank")
        ranked = ranked.unionByName(last.withColumn("_new", F.lit(False)))
    # One row per product and day: the days bound the series.
    moved = with_previous(ranked, [c.key], [c.date], {"previous_rank": "price_rank"}, rows_per_piece=None)
    rank, before = F.col("price_rank"), F.col("previous_rank")
    return moved.where("_new").select(
        c.key, c.title, c.category, c.price, rank,
        (rank == 1).alias("is_cheapest"),
        before,
        (before - rank).alias("rank_change"),
        c.rating, c.reviews, c.stock, c.date,
        run_time(run_ts).alias(STAMP),
    )


def review_trend(daily: DataFrame, run_ts: dt.datetime | None = None, *, columns: Columns = DEFAULT,
                 velocity: Sequence[tuple[str, float]] = fixed.REVIEW_VELOCITY) -> DataFrame:
    """Reviews gained since the product was last seen. An unknown gain counts as DECLINING."""
    c = columns
    shown = [c.key, c.title, c.rating, c.reviews, c.price, c.category, c.date]
    # One row per product and day: the days bound the series.
    rows = with_previous(daily.select(*shown), [c.key], [c.date], {"previous_review_count": c.reviews},
                         rows_per_piece=None)
    before = F.col("previous_review_count")
    gained = F.when(before.isNull(), F.lit(0)).otherwise(F.col(c.reviews) - before)
    label = steps(gained, velocity, inclusive=False).when(gained == 0, fixed.STAGNANT)
    return rows.select(
        c.key, c.title, c.rating, c.reviews, before,
        gained.alias("reviews_gained"),
        label.otherwise(fixed.DECLINING).alias("review_velocity"),
        c.price, c.category, c.date,
        run_time(run_ts).alias(STAMP),
    )


def stock_gap(valid: DataFrame, run_ts: dt.datetime | None = None, *, columns: Columns = DEFAULT,
              demand_reviews: int = fixed.DEMAND_REVIEWS) -> DataFrame:
    """Products out of stock now and how much demand they had. Unknown stock is no gap.

    Takes valid rows, or their daily snapshot: both hold each product's last row.
    """
    c = columns
    out = F.coalesce(F.col(c.stock) != fixed.IN_STOCK, F.lit(False))
    wanted = F.coalesce(F.col(c.reviews) > demand_reviews, F.lit(False))
    score = (F.when(out & wanted, fixed.HIGH_OPPORTUNITY).when(out, fixed.MEDIUM_OPPORTUNITY)
             .otherwise(fixed.NO_OPPORTUNITY))
    return current(valid, columns=c).select(
        c.key, c.title, c.stock,
        out.alias("is_out_of_stock"),
        score.alias("opportunity_score"),
        c.price, c.rating, c.reviews, c.category, c.time, c.date,
        run_time(run_ts).alias(STAMP),
    )


def market_summary(daily: DataFrame, run_ts: dt.datetime | None = None, *, columns: Columns = DEFAULT,
                   health: Sequence[tuple[str, float]] = fixed.MARKET_HEALTH) -> DataFrame:
    """One row per category and date of the daily snapshot. Products of unknown stock count
    in the total only."""
    c = columns
    # A sum of doubles has other last digits in another order of rows; what lies half-way must not fall either way with them.
    mean = lambda name: F.round(F.round(F.avg(name), 9), 2)
    grouped = daily.groupBy(c.category, c.date).agg(
        F.count(F.lit(1)).alias("total_products"),
        mean(c.price).alias("avg_price"),
        F.min(c.price).alias("min_price"),
        F.max(c.price).alias("max_price"),
        mean(c.rating).alias("avg_rating"),
        F.count_if(F.col(c.stock) == fixed.IN_STOCK).alias("products_in_stock"),
        F.count_if(F.col(c.stock) != fixed.IN_STOCK).alias("products_out_of_stock"),
        F.max(c.reviews).cast("bigint").alias("max_reviews"),
        F.round(F.avg(c.reviews), 0).alias("avg_reviews"),
    )
    available = F.round(percent(F.col("products_in_stock"), F.col("total_products")), 1)
    return grouped.select(
        "*",
        available.alias("stock_availability_pct"),
        steps(available, health, inclusive=True).otherwise(fixed.STRESSED).alias("market_health"),
        run_time(run_ts).alias(STAMP),
    )


def product_price_summary(silver: DataFrame, *, columns: Columns = DEFAULT) -> DataFrame:
    """Price range of each product over all Silver rows, valid or not."""
    c = columns
    lowest, highest = F.min(c.price), F.max(c.price)
    return silver.groupBy(c.key).agg(
        lowest.alias("min_price"),
        highest.alias("max_price"),
        F.round(F.avg(c.price), 2).alias("avg_price"),
        (highest - lowest).alias("price_range"),
        F.count(F.lit(1)).alias("total_scrapes"),
        F.max(c.date).alias("latest_scrape"),
    )
