"""Observations and change logs derived from the supplied Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfline.schemas import DEFAULT

PRODUCT = DEFAULT.with_key("product_id")

OBSERVATION = ["product_id", "title", "price", "rating", "reviews_count", "in_stock", "category",
               "scraped_at", "source"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One observation per event, with missing and invalid values spread by ``props.k``."""
    k = "cast(get_json_object(props, '$.k') as int)"
    return table(spark, sf_dir, "events").selectExpr(
        "event_id", "user_id", "ts", "event_type", "value", f"{k} as k").selectExpr(
        "event_id",
        "user_id as product_id",
        "case when k % 29 = 0 then null else '  item ' || user_id || ' ' end as title",
        "case when k % 23 = 0 then null when k % 31 = 0 then -10D"
        " else 10D * (1 + floor(value / 20)) end as price",
        "case when k % 13 = 0 then null else cast(k as double) / 19 end as rating",
        "case when k % 37 = 0 then null else cast(960 + (k % 10) * (k % 10) as bigint) end as reviews_count",
        "case when k % 17 = 0 then null when k % 3 = 0 then 'out_of_stock' else 'in_stock' end as in_stock",
        "' ' || event_type || ' ' as category",
        "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\") || '+00:00' as scraped_at",
        "'synthetic' as source")


def line_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One observation per order line, priced per piece, in the category of its part."""
    lines = table(spark, sf_dir, "lineitem")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
    return lines.join(parts, lines.l_partkey == parts.p_partkey).selectExpr(
        "l_partkey as product_id",
        "p_name as title",
        "floor(l_extendedprice / l_quantity * 100) / 100 as price",
        "l_discount * 50 as rating",
        "cast(l_quantity as bigint) as reviews_count",
        "case when l_returnflag = 'R' then 'out_of_stock' else 'in_stock' end as in_stock",
        "p_type as category",
        "cast(l_shipdate as date) || 'T00:00:00.000000+00:00' as scraped_at",
        "'lines' as source")


def order_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders of a customer as changes of one seller order; no two share a time.

    Some changes give no title, and some delete the order.
    """
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey as seq",
        "case when o_orderkey % 19 = 0 then 'D' when o_orderstatus = 'O' then 'I' else 'U' end as op",
        "cast(timestampadd(MICROSECOND, o_orderkey, o_orderdate) as timestamp) as change_ts",
        "cast(o_custkey as string) as order_id",
        "'P' || (o_orderkey % 50) as asin",
        "case when o_orderkey % 5 < 2 then null else o_orderpriority end as product_title",
        "cast(o_orderkey % 3 + 1 as int) as quantity",
        "cast(o_totalprice as decimal(10,2)) as sale_price",
        "case o_orderstatus when 'O' then 'pending' when 'P' then 'confirmed' else 'shipped' end"
        " as order_status",
        "cast(null as string) as customer_city",
        "cast(null as string) as customer_state",
        "'amazon_in' as marketplace",
        "cast(o_orderdate as timestamp) as created_at",
        "cast(o_orderdate as timestamp) as updated_at")


def part_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An inventory of all parts."""
    return table(spark, sf_dir, "part").selectExpr(
        "p_partkey as product_id",
        "p_name as product_title",
        "p_size as stock_quantity",
        "50 as reorder_point",
        "p_retailprice as unit_cost",
        "cast('2020-01-01' as timestamp) as updated_at")


def line_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stock counts, as many as there are order lines; a quarter is of products without inventory."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        "case when l_partkey % 4 = 0 then -l_partkey else l_partkey end as product_id",
        "'line ' || l_linenumber as product_title",
        "cast(l_quantity as int) as stock_quantity",
        "l_linenumber as reorder_point",
        "l_extendedprice as unit_cost",
        "l_shipdate", "l_orderkey")
