import random

import pytest

from conftest import counted
from shelfline.operators import pieces, series
from shelfline.operators.ranking import with_rank
from shelfline.operators.series import with_previous
from shelfline.operators.snapshots import latest_per

SCHEMA = "k string, t string, v int, w string"


def log(spark, seed, n=400):
    """Keys of unequal size, NULL keys and times, ties and exact copies."""
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        key = rng.choice(["hot"] * 6 + ["a", "b", None])
        time = rng.choice([None] + [f"2026-04-01T10:{rng.randrange(6):02d}:{rng.randrange(3):02d}"] * 9)
        rows.append((key, time, rng.choice([None, 1, 2, 3]), rng.choice("xy")))
    return spark.createDataFrame(rows + rows[: n // 4] * 3, SCHEMA)


ORDER = ["t", "v", "w"]


def test_first_row_has_none_and_null_values_are_handed_on(spark):
    rows = spark.createDataFrame([("a", "1", 5, "x"), ("a", "2", None, "x"), ("a", "3", 7, "x")], SCHEMA)
    got = with_previous(rows, ["k"], ORDER, {"p": "v"}).orderBy("t").collect()
    assert [r.p for r in got] == [None, 5, None]


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("size", [1, 5, 60, 10_000])
def test_pieces_give_what_the_plain_window_gives(spark, seed, size):
    rows = log(spark, seed)
    plain = with_previous(rows, ["k"], ORDER, {"pv": "v", "pw": "w"}, rows_per_piece=None)
    cut = with_previous(rows, ["k"], ORDER, {"pv": "v", "pw": "w"}, rows_per_piece=size)
    assert counted(plain) == counted(cut)


def test_many_copies_are_written_out_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(series, "COPIES_PER_ROW", 7)
    rows = log(spark, 5).unionByName(spark.range(100).selectExpr(
        "'hot' k", "'2026-04-01T10:01:01' t", "9 v", "'x' w"))
    plain = with_previous(rows, ["k"], ORDER, {"pv": "v"}, rows_per_piece=None)
    cut = with_previous(rows, ["k"], ORDER, {"pv": "v"}, rows_per_piece=2)
    assert counted(plain) == counted(cut)


def sizes(rows, by, order, per_piece):
    placed = pieces.with_piece(rows, by, order, pieces.cuts_of(rows, by, order, per_piece))
    return [(r[0][0], r[2]) for r in placed.groupBy("_key", "_piece").count().collect()]


def test_rows_of_one_key_and_one_stamp_are_spread(spark):
    rows = spark.range(200_000).selectExpr("if(id % 10 < 8, 'hot', concat('k', id % 1000)) k", "'2026-04-01T10:00:00' t",
                                           "cast(xxhash64(id) % 1000000 as int) v", "cast(id as string) w")
    held = sizes(rows, ["k"], ORDER, 10_000)
    hot = [n for k, n in held if k == "hot"]
    assert len(hot) >= 10 and max(n for _, n in held) < 25_000 and sum(n for _, n in held) == 200_000
    assert [k for k, _ in held].count("k8") == 1  # a small key is one piece
    plain = with_previous(rows, ["k"], ORDER, {"pv": "v", "pw": "w"}, rows_per_piece=None)
    cut = with_previous(rows, ["k"], ORDER, {"pv": "v", "pw": "w"}, rows_per_piece=10_000)
    assert plain.exceptAll(cut).isEmpty() and cut.count() == 200_000


def test_prices_close_to_each_other_are_cut_evenly(spark):
    rows = spark.range(200_000).selectExpr("'x' c", "'1' d", "100 + pmod(xxhash64(id), 1000000) / 1e6 p", "cast(id as int) n")
    held = [n for _, n in sizes(rows, ["c", "d"], ["p"], 10_000)]
    assert len(held) >= 15 and max(held) < 20_000
    plain = with_rank(rows, ["c", "d"], "p", "r", rows_per_piece=None)
    assert plain.exceptAll(with_rank(rows, ["c", "d"], "p", "r", rows_per_piece=10_000)).isEmpty()


def test_rows_of_one_price_are_spread(spark):
    rows = spark.range(100_000).selectExpr("'x' c", "'1' d", "if(id % 3 = 0, cast(id as double), 7.5D) p", "1 n")
    ranked = with_rank(rows, ["c", "d"], "p", "r", rows_per_piece=5000)
    plan = ranked._jdf.queryExecution().toString()
    assert "_share" in plan
    found = {(r.p, r.r): r["count"] for r in ranked.where("p between 6 and 9").groupBy("p", "r").count().collect()}
    # 0, 3 and 6 are below; 66,666 rows of 7.5; then 9
    assert found == {(6.0, 3): 1, (7.5, 4): 66_666, (9.0, 66_670): 1}


def test_few_rows_are_not_cut(spark):
    assert pieces.cuts_of(log(spark, 1), ["k"], ORDER) is None
    assert pieces.cuts_of(log(spark, 1).limit(0), ["k"], ORDER, 1) is None
    even = spark.range(1000).selectExpr("id k", "id t")  # no key holds a piece
    assert pieces.cuts_of(even, ["k"], ["t"], 100) is None


def test_places_are_read_only_where_a_key_fills_pieces(spark):
    unread = "cast(raise_error('read') as string) t"
    assert pieces.cuts_of(spark.range(1000).selectExpr("id k", unread), ["k"], ["t"], 100) is None
    with pytest.raises(Exception, match="read"):
        pieces.cuts_of(spark.range(1000).selectExpr("if(id < 800, -1, id) k", unread), ["k"], ["t"], 100)


PRICES = "c string, d string, p double, n int"


def prices(spark, seed, n=500):
    rng = random.Random(seed)
    pool = [None, float("nan"), float("inf"), -float("inf"), 0.0, -0.0, -3.5, -3.6, -1e300, 1e300, 1e-300] + [round(rng.uniform(0, 9), 1)
                                                                       for _ in range(30)]
    return spark.createDataFrame(
        [(rng.choice(["x"] * 5 + ["y", None]), rng.choice(["1", "2", None]), rng.choice(pool), i)
         for i in range(n)], PRICES)


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("size", [1, 7, 60, 10_000])
def test_pieces_give_the_rank_the_window_gives(spark, seed, size):
    rows = prices(spark, seed)
    plain = with_rank(rows, ["c", "d"], "p", "r", rows_per_piece=None)
    assert counted(plain) == counted(with_rank(rows, ["c", "d"], "p", "r", rows_per_piece=size))


def test_rank_skips_after_ties(spark):
    rows = spark.createDataFrame([("c", "1", p, i) for i, p in enumerate([2.0, 1.0, 1.0, 3.0])], PRICES)
    for size in (250_000, 1):
        assert sorted(r.r for r in with_rank(rows, ["c", "d"], "p", "r", rows_per_piece=size).collect()) == [1, 1, 3, 4]


def test_latest_is_limited_before_the_shuffle(spark):
    rows = log(spark, 3)
    plan = latest_per(rows, ["k"], ["t", "v", "w"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert plan.index("Exchange") < plan.rindex("WindowGroupLimit")
    best = {}
    for r in rows.where("t is not null and v is not null").collect():
        best[r.k] = max(best.get(r.k, ("", 0, "")), (r.t, r.v, r.w))
    got = latest_per(rows.where("t is not null and v is not null"), ["k"], ["t", "v", "w"]).collect()
    assert {r.k: (r.t, r.v, r.w) for r in got} == best
