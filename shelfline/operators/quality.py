"""Six-pillar quality report of raw observations, one row, and constraint checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline import fixed_values as fixed
from shelfline.functions.columns import as_double, percent
from shelfline.schemas import DEFAULT, Columns

TOTAL = "total_records"


def _typed(raw: DataFrame, c: Columns) -> DataFrame:
    return raw.withColumns({"_price": as_double(c.price), "_rating": as_double(c.rating)})


def _outside(value: str, bounds: tuple[float, float]) -> Column:
    return (F.col(value) < bounds[0]) | (F.col(value) > bounds[1])


def _counts(c: Columns, price_bounds, rating_bounds) -> dict[str, dict[str, Column]]:
    """Aggregates per pillar that one pass computes without shuffling rows."""
    def nulls(name: str) -> Column:
        return F.count_if(F.col(name).isNull())

    scored = [F.col(name).isNotNull() for name in (c.price, c.title, c.key, c.time)]
    suspicious = {"suspicious_prices": F.count_if(_outside("_price", price_bounds))}
    return {
        "completeness": {
            "null_prices": nulls(c.price), "null_ratings": nulls(c.rating),
            "null_titles": nulls(c.title), "null_in_stock": nulls(c.stock),
            "null_categories": nulls(c.category), "null_scraped_at": nulls(c.time),
            "complete_records": F.count_if(reduce(lambda a, b: a & b, scored)),
        },
        "validity": {
            "invalid_prices": F.count_if(F.col("_price") <= 0),
            "invalid_ratings": F.count_if(_outside("_rating", rating_bounds)),
            **suspicious,
        },
        "accuracy": {
            **suspicious,
            "min_price": F.min("_price"), "max_price": F.max("_price"), "avg_price": F.avg("_price"),
            "min_rating": F.min("_rating"), "max_rating": F.max("_rating"), "avg_rating": F.avg("_rating"),
        },
        "timeliness": {"earliest_scrape": F.min(c.time), "latest_scrape": F.max(c.time)},
    }


def _distinct_counts(c: Columns, approximate: bool) -> dict[str, dict[str, Column]]:
    """Distinct counts per pillar. Inside a struct NULL counts as a value; times alone skip it."""
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    return {
        "uniqueness": {"distinct_records": distinct(F.struct(c.key, c.time))},
        "consistency": {"distinct_products": distinct(F.struct(c.key)),
                        "distinct_sources": distinct(F.struct(c.source))},
        "timeliness": {"distinct_scrape_times": distinct(F.col(c.time))},
    }


def _aggregates(per_pillar: Mapping[str, Mapping[str, Column]], pillars: Sequence[str]) -> list[Column]:
    """The aggregates of some pillars, one asked for by two of them once."""
    wanted = {name: column for pillar in pillars for name, column in per_pillar.get(pillar, {}).items()}
    return [column.alias(name) for name, column in wanted.items()]


def _scores(pillar: str, expected_products: int, expected_sources: int) -> list[Column]:
    """What a pillar derives from its counts, its score last."""
    total = F.col(TOTAL)
    if pillar == "completeness":
        return [percent(F.col("complete_records"), total).alias("completeness_score")]
    if pillar == "validity":
        # A row with both faults counts twice.
        left = total - F.col("invalid_prices") - F.col("invalid_ratings")
        return [percent(left, total).alias("validity_score")]
    if pillar == "uniqueness":
        distinct = F.col("distinct_records")
        return [(total - distinct).alias("duplicate_records"),
                percent(distinct, total).alias("uniqueness_score")]
    if pillar == "consistency":
        as_expected = ((F.col("distinct_products") == expected_products)
                       & (F.col("distinct_sources") == expected_sources))
        return [F.when(as_expected, 100.0).otherwise(fixed.INCONSISTENT_SCORE).alias("consistency_score")]
    if pillar == "accuracy":
        return [percent(total - F.col("suspicious_prices"), total).alias("accuracy_score")]
    return [F.lit(100.0).alias("timeliness_score")]


def quality_report(raw: DataFrame, *, columns: Columns = DEFAULT,
                   pillars: Sequence[str] = tuple(fixed.PILLAR_WEIGHTS),
                   expected_products: int = fixed.EXPECTED_PRODUCTS,
                   expected_sources: int = fixed.EXPECTED_SOURCES,
                   price_bounds: tuple[float, float] = fixed.PRICE_BOUNDS,
                   rating_bounds: tuple[float, float] = fixed.RATING_BOUNDS,
                   approximate: bool = False) -> DataFrame:
    """The counts and scores of the pillars asked for, as one row; scores stay unrounded.

    Plain counts need no shuffle of rows and distinct counts need nothing but their
    own columns, so each kind gets one pass and the two one-row results are put together.
    ``approximate`` estimates the distinct counts, which then shuffle no rows either.
    """
    plain = _aggregates(_counts(columns, price_bounds, rating_bounds), pillars)
    distinct = _aggregates(_distinct_counts(columns, approximate), pillars)
    counted = _typed(raw, columns).agg(F.count(F.lit(1)).alias(TOTAL), *plain)
    if distinct:
        both = counted.unionByName(raw.agg(*distinct), allowMissingColumns=True)
        counted = both.agg(*[F.max(name).alias(name) for name in both.columns])
    scores = [score for pillar in pillars
              for score in _scores(pillar, expected_products, expected_sources)]
    return counted.select("*", *scores)


def quality_score(report: DataFrame,
                  weights: Mapping[str, float] = fixed.PILLAR_WEIGHTS) -> DataFrame:
    """Add the weighted sum of the pillar scores."""
    parts = [F.col(f"{pillar}_score") * weight for pillar, weight in weights.items()]
    return report.withColumn("overall_score", reduce(lambda a, b: a + b, parts))


def rounded(report: DataFrame, digits: int = 2) -> DataFrame:
    """The scores as a printed report shows them, half to even."""
    return report.select(*[F.bround(name, digits).alias(name) if name.endswith("_score") else F.col(name)
                           for name in report.columns])


def check_constraints(rows: DataFrame, keys: Sequence[str], required: Sequence[str] = ()) -> DataFrame:
    """One row: rows, rows with a NULL key, keys held by several rows, NULLs per required
    column, and whether all constraints hold."""
    counted = [F.count_if(F.col(name).isNull()).alias(f"null_{name}") for name in (*keys, *required)]
    nulls = [f"null_{name}" for name in (*keys, *required)]
    per_key = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"), *counted)
    checked = per_key.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias(TOTAL),
        F.count_if(F.col("_rows") > 1).alias("duplicate_keys"),
        *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in nulls])
    faults = reduce(lambda a, b: a + b, [F.col(name) for name in ("duplicate_keys", *nulls)])
    return checked.withColumn("constraints_hold", faults == 0)


def apply_defaults(rows: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Put a default where a column is NULL."""
    return rows.withColumns({name: F.coalesce(F.col(name), F.lit(value).cast(rows.schema[name].dataType))
                             for name, value in defaults.items()})
