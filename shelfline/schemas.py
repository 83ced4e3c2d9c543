"""Schemas of every table, and the names operators find their columns under."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import types as T


@dataclass(frozen=True)
class Columns:
    """Column names of an observation table."""

    key: str = "asin"
    title: str = "title"
    price: str = "price"
    rating: str = "rating"
    reviews: str = "reviews_count"
    stock: str = "in_stock"
    category: str = "category"
    source: str = "source"
    time: str = "scraped_at"
    date: str = "scrape_date"
    status: str = "dq_status"

    def with_key(self, key: str) -> "Columns":
        return replace(self, key=key)

    @property
    def order(self) -> list[str]:
        """Time first; the other columns settle the order of rows of one time."""
        return [self.time, self.price, self.rating, self.reviews, self.stock,
                self.title, self.category, self.source]


DEFAULT = Columns()

RAW = T.StructType([
    T.StructField("asin", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("price", T.StringType()),
    T.StructField("rating", T.StringType()),
    T.StructField("reviews_count", T.StringType()),
    T.StructField("in_stock", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("scraped_at", T.StringType()),
    T.StructField("source", T.StringType()),
])

PAYLOAD = T.StructType([
    T.StructField("title", T.StringType()),
    T.StructField("rating", T.DoubleType()),
    T.StructField("ratings_total", T.LongType()),
    T.StructField("buybox_winner", T.StructType([
        T.StructField("price", T.StructType([T.StructField("value", T.DoubleType())])),
        T.StructField("availability", T.StructType([T.StructField("type", T.StringType())])),
    ])),
    T.StructField("categories", T.ArrayType(T.StructType([T.StructField("name", T.StringType())]))),
])


_TYPES = {"string": T.StringType(), "double": T.DoubleType(), "int": T.IntegerType(),
          "bigint": T.LongType(), "boolean": T.BooleanType(), "date": T.DateType(),
          "timestamp": T.TimestampType()}


def _table(*fields: tuple[str, str, str]) -> T.StructType:
    schema = T.StructType()
    for name, kind, comment in fields:
        schema.add(T.StructField(name, _TYPES[kind], True,
                                 {"comment": comment} if comment else {}))
    return schema


SILVER = _table(
    ("asin", "string", "Product identifier"),
    ("title", "string", "Product title, trimmed"),
    ("price", "double", "Price at the time of the scrape"),
    ("rating", "double", "Rating out of five"),
    ("reviews_count", "int", "Number of reviews"),
    ("in_stock", "string", "Availability text"),
    ("category", "string", "Category, trimmed and in capitals"),
    ("source", "string", "Source identifier"),
    ("source_system", "string", "Name of the source system"),
    ("scraped_at", "string", "ISO-8601 time of the scrape"),
    ("scrape_date", "date", "Date of the scrape, partition column"),
    ("processed_at", "timestamp", "Time of this run"),
    ("dq_status", "string", "Quality status of the row"),
)

PRICE_HISTORY = _table(
    ("asin", "string", ""),
    ("title", "string", ""),
    ("price", "double", "Price at the time of the scrape"),
    ("previous_price", "double", "Price of the scrape before"),
    ("price_diff", "double", "Change against the scrape before"),
    ("price_change_pct", "double", "Change in percent"),
    ("price_changed", "boolean", "Whether the price moved"),
    ("price_direction", "string", "UP DOWN STABLE FIRST_RECORD"),
    ("rating", "double", ""),
    ("reviews_count", "int", ""),
    ("in_stock", "string", ""),
    ("category", "string", ""),
    ("scraped_at", "string", ""),
    ("scrape_date", "date", "Partition column"),
    ("gold_processed_at", "timestamp", "Time of this run"),
)

COMPETITOR_RANKING = _table(
    ("asin", "string", ""),
    ("title", "string", ""),
    ("category", "string", ""),
    ("price", "double", ""),
    ("price_rank", "int", "Rank by price in the category, 1 is cheapest"),
    ("is_cheapest", "boolean", "Whether the rank is 1"),
    ("previous_rank", "int", "Rank on the observed day before"),
    ("rank_change", "int", "Positive is relatively cheaper than before"),
    ("rating", "double", ""),
    ("reviews_count", "int", ""),
    ("in_stock", "string", ""),
    ("scrape_date", "date", "Partition column"),
    ("gold_processed_at", "timestamp", "Time of this run"),
)

REVIEW_TREND = _table(
    ("asin", "string", ""),
    ("title", "string", ""),
    ("rating", "double", ""),
    ("reviews_count", "int", ""),
    ("previous_review_count", "int", ""),
    ("reviews_gained", "int", "Reviews gained since the observed day before"),
    ("review_velocity", "string", "HIGH MEDIUM LOW STAGNANT DECLINING"),
    ("price", "double", ""),
    ("category", "string", ""),
    ("scrape_date", "date", "Partition column"),
    ("gold_processed_at", "timestamp", "Time of this run"),
)

STOCK_GAP = _table(
    ("asin", "string", ""),
    ("title", "string", ""),
    ("in_stock", "string", ""),
    ("is_out_of_stock", "boolean", ""),
    ("opportunity_score", "string", "HIGH MEDIUM NONE"),
    ("price", "double", ""),
    ("rating", "double", ""),
    ("reviews_count", "int", ""),
    ("category", "string", ""),
    ("scraped_at", "string", ""),
    ("scrape_date", "date", "Partition column"),
    ("gold_processed_at", "timestamp", "Time of this run"),
)

MARKET_SUMMARY = _table(
    ("category", "string", ""),
    ("scrape_date", "date", "Partition column"),
    ("total_products", "bigint", ""),
    ("avg_price", "double", ""),
    ("min_price", "double", ""),
    ("max_price", "double", ""),
    ("avg_rating", "double", ""),
    ("products_in_stock", "bigint", ""),
    ("products_out_of_stock", "bigint", ""),
    ("max_reviews", "bigint", ""),
    ("avg_reviews", "double", ""),
    ("stock_availability_pct", "double", "Percent of the products in stock"),
    ("market_health", "string", "HEALTHY MODERATE STRESSED"),
    ("gold_processed_at", "timestamp", "Time of this run"),
)

GOLD = {
    "price_history": PRICE_HISTORY,
    "competitor_ranking": COMPETITOR_RANKING,
    "review_trend": REVIEW_TREND,
    "stock_gap": STOCK_GAP,
    "market_summary": MARKET_SUMMARY,
}

SELLER_ORDERS = T.StructType([
    T.StructField("order_id", T.StringType()),
    T.StructField("asin", T.StringType()),
    T.StructField("product_title", T.StringType()),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("sale_price", T.DecimalType(10, 2)),
    T.StructField("order_status", T.StringType()),
    T.StructField("customer_city", T.StringType()),
    T.StructField("customer_state", T.StringType()),
    T.StructField("marketplace", T.StringType()),
    T.StructField("created_at", T.TimestampType()),
    T.StructField("updated_at", T.TimestampType()),
])

# The feed has no last_restocked; the table does.
SELLER_INVENTORY_FEED = T.StructType([
    T.StructField("asin", T.StringType()),
    T.StructField("product_title", T.StringType()),
    T.StructField("stock_quantity", T.IntegerType()),
    T.StructField("reorder_point", T.IntegerType()),
    T.StructField("unit_cost", T.DecimalType(10, 2)),
    T.StructField("updated_at", T.TimestampType()),
])
SELLER_INVENTORY = T.StructType(
    SELLER_INVENTORY_FEED.fields[:-1]
    + [T.StructField("last_restocked", T.TimestampType()), SELLER_INVENTORY_FEED.fields[-1]])


@dataclass(frozen=True)
class ChangeFeed:
    """One table of a change log: its columns by position, its key, what must not be NULL."""

    table: str
    columns: T.StructType
    keys: tuple[str, ...]
    required: tuple[str, ...]
    keep_earliest: tuple[str, ...] = ()


FEEDS = {
    "seller_orders": ChangeFeed("seller_orders", SELLER_ORDERS, ("order_id",),
                                ("asin", "quantity", "sale_price", "order_status"), ("created_at",)),
    "seller_inventory": ChangeFeed("seller_inventory", SELLER_INVENTORY_FEED, ("asin",),
                                   ("stock_quantity", "reorder_point")),
}
