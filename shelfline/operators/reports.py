"""Reports on the written tables. Every order ends in columns that settle ties."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline import fixed_values as fixed
from shelfline.operators.gold import product_price_summary
from shelfline.schemas import DEFAULT, Columns


def price_changes(history: DataFrame, *, columns: Columns = DEFAULT) -> DataFrame:
    """Rows of the price history where the price moved."""
    return history.where("price_changed").select(
        columns.key, columns.title, columns.price, "previous_price", "price_diff", "price_change_pct")


def top_price_moves(history: DataFrame, k: int = 10, *, columns: Columns = DEFAULT) -> DataFrame:
    """The ``k`` largest moves either way."""
    c = columns
    return (history.where("price_changed")
            .orderBy(F.abs("price_diff").desc(), c.key, c.time, c.price).limit(k)
            .select(c.key, c.price, "previous_price", "price_diff", "price_change_pct", "price_direction"))


def ranking_by_category(ranking: DataFrame, k: int = 11, *, columns: Columns = DEFAULT) -> DataFrame:
    """The first ``k`` rows by category and rank."""
    c = columns
    return (ranking.orderBy(c.category, "price_rank", c.key, c.date).limit(k)
            .select(c.key, c.title, c.price, "price_rank", "is_cheapest", "rank_change"))


def cheapest_products(ranking: DataFrame, k: int = 11, *, columns: Columns = DEFAULT) -> DataFrame:
    """The first ``k`` rows by rank alone."""
    c = columns
    return (ranking.orderBy("price_rank", c.key, c.date).limit(k)
            .select(c.key, c.title, c.price, "price_rank", "is_cheapest", "rank_change"))


def stock_gap_counts(gaps: DataFrame) -> DataFrame:
    """One row: products out of stock, and those of high opportunity."""
    return gaps.agg(
        F.count_if("is_out_of_stock").alias("out_of_stock"),
        F.count_if(F.col("opportunity_score") == fixed.HIGH_OPPORTUNITY).alias("high_opportunity"))


def market_report(summary: DataFrame, *, columns: Columns = DEFAULT) -> DataFrame:
    return summary.select(columns.category, "avg_price", "min_price", "max_price",
                          "products_in_stock", "market_health")


def most_scraped(silver: DataFrame, k: int = 20, *, columns: Columns = DEFAULT) -> DataFrame:
    """The price summary of the ``k`` products seen most often."""
    return (product_price_summary(silver, columns=columns)
            .orderBy(F.desc("total_scrapes"), columns.key).limit(k))


def key_listing(rows: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    """Some columns in the order of the keys."""
    return rows.select(*keys, *names).orderBy(*keys)


def table_counts(tables: dict[str, DataFrame]) -> dict[str, int]:
    return {name: rows.count() for name, rows in tables.items()}


REPORTS = {
    "product_prices": ("products", most_scraped),
    "price_moves": ("price_history", top_price_moves),
    "rankings": ("competitor_ranking", cheapest_products),
    "market": ("market_summary", market_report),
}


def run_report(spark: SparkSession, name: str, database: str = "default") -> DataFrame:
    """A report on the catalog table it belongs to."""
    table, report = REPORTS[name]
    return report(spark.table(f"{database}.{table}"))
