import datetime as dt

from conftest import RUN, at, counted
from shelfline.operators import gold, reports
from shelfline.operators.snapshots import daily_latest, preview
from shelfline.schemas import GOLD


def by_time(frame):
    return sorted(frame.collect(), key=lambda r: r.scraped_at)


def test_tables_have_their_schemas(observations):
    valid = observations({})
    daily = daily_latest(valid)
    made = {"price_history": gold.price_history(valid, RUN),
            "competitor_ranking": gold.competitor_ranking(daily, RUN),
            "review_trend": gold.review_trend(daily, RUN), "stock_gap": gold.stock_gap(valid, RUN),
            "market_summary": gold.market_summary(daily, RUN)}
    for name, frame in made.items():
        assert frame.columns == GOLD[name].fieldNames()
        assert [f.dataType for f in frame.schema] == [f.dataType for f in GOLD[name]], name


def test_price_history(observations):
    prices = [100.0, 150.0, 149.999, 150.0, 75.0, 75.0]
    rows = by_time(gold.price_history(observations(
        *[{"price": p, "scraped_at": at(1, 10, i)} for i, p in enumerate(prices)]), RUN))
    assert [r.previous_price for r in rows] == [None, *prices[:-1]]
    assert [r.price_diff for r in rows] == [None, 50.0, 0.0, 0.0, -75.0, 0.0]
    assert [r.price_change_pct for r in rows] == [None, 50.0, 0.0, 0.0, -50.0, 0.0]
    assert [r.price_changed for r in rows] == [False, True, False, False, True, False]
    assert [r.price_direction for r in rows] == ["FIRST_RECORD", "UP", "STABLE", "STABLE", "DOWN", "STABLE"]
    assert rows[0].gold_processed_at == RUN


def test_percent_needs_a_positive_price_before(observations):
    rows = by_time(gold.price_history(observations(
        *[{"price": p, "scraped_at": at(1, 10, i)} for i, p in enumerate([0.0, 5.0, -5.0, 5.0])]), RUN))
    assert [r.price_change_pct for r in rows] == [None, None, -200.0, None]


def test_rounding_is_half_up(observations):
    rows = by_time(gold.price_history(observations(
        {"price": 1000.0, "scraped_at": at(1, 10, 0)}, {"price": 1001.125, "scraped_at": at(1, 10, 1)}), RUN))
    assert (rows[1].price_diff, rows[1].price_change_pct) == (1.13, 0.11)


def test_price_differences_telescope(observations):
    import random
    rng = random.Random(4)
    rows = observations(*[{"asin": rng.choice("AB"), "price": float(rng.randrange(1, 500)),
                           "scraped_at": at(rng.randrange(1, 9), rng.randrange(24), rng.randrange(60), i % 60)}
                          for i in range(200)])
    for size in (250_000, 1):
        found = gold.price_history(rows, RUN, rows_per_piece=size)
        for key in "AB":
            mine = sorted([r for r in found.collect() if r.asin == key], key=lambda r: (r.scraped_at, r.price))
            assert sum(r.price_diff or 0 for r in mine) == mine[-1].price - mine[0].price


def test_daily_snapshot_takes_the_last_of_a_day(observations):
    rows = daily_latest(observations(
        {"price": 1.0, "scraped_at": at(1, 9)}, {"price": 2.0, "scraped_at": at(1, 11)},
        {"price": 3.0, "scraped_at": at(2, 8)}, {"asin": "B", "price": 4.0}))
    assert sorted((r.asin, r.scrape_date.day, r.price) for r in rows.collect()) == [
        ("A", 1, 2.0), ("A", 2, 3.0), ("B", 1, 4.0)]


def test_ranking_ties_moves_and_categories(observations):
    daily = daily_latest(observations(
        {"asin": "A", "price": 5.0}, {"asin": "B", "price": 5.0}, {"asin": "C", "price": 9.0},
        {"asin": "A", "price": 9.0, "scraped_at": at(4)}, {"asin": "C", "price": 1.0, "scraped_at": at(4)},
        {"asin": "B", "price": 2.0, "category": "D", "scraped_at": at(4)}))
    for size in (250_000, 1):
        found = {(r.asin, r.scrape_date.day): r for r in gold.competitor_ranking(daily, RUN, rows_per_piece=size).collect()}
        ranks = {key: (r.price_rank, r.is_cheapest, r.previous_rank, r.rank_change) for key, r in found.items()}
        assert ranks == {("A", 1): (1, True, None, None), ("B", 1): (1, True, None, None),
                         ("C", 1): (3, False, None, None), ("A", 4): (2, False, 1, -1),
                         ("C", 4): (1, True, 3, 2), ("B", 4): (1, True, 1, 0)}


def test_review_velocity(observations):
    counts = [None, 100, 151, 201, 212, 222, 223, 223, 200, None, 300]
    rows = sorted(gold.review_trend(daily_latest(observations(
        *[{"reviews_count": n, "scraped_at": at(i + 1)} for i, n in enumerate(counts)])), RUN).collect(),
        key=lambda r: r.scrape_date)
    assert [r.reviews_gained for r in rows] == [0, 0, 51, 50, 11, 10, 1, 0, -23, None, 0]
    assert [r.review_velocity for r in rows] == [
        "STAGNANT", "STAGNANT", "HIGH", "MEDIUM", "MEDIUM", "LOW", "LOW", "STAGNANT", "DECLINING",
        "DECLINING", "STAGNANT"]


def test_stock_gap(observations):
    valid = observations(
        {"asin": "A", "in_stock": "out", "reviews_count": 1001}, {"asin": "B", "in_stock": "out", "reviews_count": 1000},
        {"asin": "C", "in_stock": "out", "reviews_count": None}, {"asin": "D", "in_stock": None, "reviews_count": 5000},
        {"asin": "E", "in_stock": "in_stock"},
        {"asin": "F", "in_stock": "out", "scraped_at": at(1)}, {"asin": "F", "scraped_at": at(2)})
    found = gold.stock_gap(valid, RUN)
    assert {r.asin: (r.is_out_of_stock, r.opportunity_score) for r in found.collect()} == {
        "A": (True, "HIGH"), "B": (True, "MEDIUM"), "C": (True, "MEDIUM"), "D": (False, "NONE"),
        "E": (False, "NONE"), "F": (False, "NONE")}
    assert counted(found) == counted(gold.stock_gap(daily_latest(valid), RUN))
    assert tuple(reports.stock_gap_counts(found).first()) == (3, 1)


def test_market_summary(observations):
    def stock(*texts, category="C"):
        return [{"asin": f"{category}{i}", "in_stock": s, "category": category, "price": 10.0 + i,
                 "reviews_count": i, "rating": None if i == 0 else 4.0} for i, s in enumerate(texts)]
    found = {r.category: r for r in gold.market_summary(observations(
        *stock("in_stock", "in_stock", "in_stock", "in_stock", None, category="H"),
        *stock("in_stock", "out", category="M"), *stock("out", "out", "in_stock", category="S")), RUN).collect()}
    h = found["H"]
    assert (h.total_products, h.products_in_stock, h.products_out_of_stock) == (5, 4, 0)
    assert (h.avg_price, h.min_price, h.max_price, h.avg_rating) == (12.0, 10.0, 14.0, 4.0)
    assert (h.max_reviews, h.avg_reviews) == (4, 2.0)
    assert [(found[c].stock_availability_pct, found[c].market_health) for c in "HMS"] == [
        (80.0, "HEALTHY"), (50.0, "MODERATE"), (33.3, "STRESSED")]


def test_product_summary_counts_invalid_rows(observations):
    row = gold.product_price_summary(observations(
        {"price": 10.0}, {"price": 20.005, "scraped_at": at(3)}, {"price": None, "dq_status": "INVALID_PRICE"}))
    assert row.first().asDict() == {"asin": "A", "min_price": 10.0, "max_price": 20.005, "avg_price": 15.0,
                                    "price_range": 20.005 - 10, "total_scrapes": 3,
                                    "latest_scrape": dt.date(2026, 4, 3)}


def test_reports(observations):
    valid = observations(*[{"asin": a, "price": p, "scraped_at": at(1, 10, i)}
                           for a in "AB" for i, p in enumerate([10.0, 30.0, 25.0, 25.0])])
    history = gold.price_history(valid, RUN)
    assert reports.price_changes(history).count() == 4
    assert [(r.asin, r.price_diff) for r in reports.top_price_moves(history, 3).collect()] == [
        ("A", 20.0), ("B", 20.0), ("A", -5.0)]
    ranking = gold.competitor_ranking(daily_latest(valid), RUN)
    assert [r.asin for r in reports.cheapest_products(ranking, 1).collect()] == ["A"]
    assert [r.asin for r in reports.ranking_by_category(ranking).collect()] == ["A", "B"]
    assert reports.market_report(gold.market_summary(daily_latest(valid), RUN)).columns == [
        "category", "avg_price", "min_price", "max_price", "products_in_stock", "market_health"]
    assert reports.most_scraped(valid).first().total_scrapes == 4
    assert [r.asin for r in reports.key_listing(valid.dropDuplicates(["asin"]), ["asin"], ["title"]).collect()] == ["A", "B"]
    assert reports.table_counts({"valid": valid}) == {"valid": 8}
    assert preview(valid, ["asin"], 3).count() == 3
