import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.frames import calendar, day, dec, detail, finance, news, rows
from tickloom.operators import returns


def events(spark, items):
    return spark.createDataFrame(
        [(c, k, "s", day(d), day(d)) for c, k, d in items],
        "code string, event_type string, specific_eventtype string, notice_date date, dt date",
    )


def test_event_to_date_return(spark):
    cal = calendar(spark, "2024-01-15", 14)
    d = detail(
        spark,
        [("a", "2024-01-16", 10), ("a", "2024-01-20", 10), ("a", "2024-01-24", 12.5)]
        + [("b", "2024-01-16", 10)],
    )
    ev = events(
        spark,
        [("a", "x", "2024-01-15"), ("a", "y", "2024-01-19"), ("b", "x", "2024-01-15")],
    )
    got = returns.event_to_date_return(ev, cal, d, day("2024-01-15"), day("2024-01-24"))
    # y's next day is a Saturday; b did not trade on the end day.
    assert rows(got, "code", "event_type", "upordown") == [("a", "x", "25.00%")]


def test_event_type_return_dedupes_and_skips_zero_price(spark):
    d = detail(
        spark,
        [("a", "2024-01-18", 10), ("a", "2024-01-19", 11), ("z", "2024-01-18", 0)]
        + [("z", "2024-01-19", 5)],
    )
    ev = events(
        spark,
        [("a", "x", "2024-01-18"), ("a", "x", "2024-01-18"), ("z", "x", "2024-01-18")],
    )
    got = returns.event_type_return(ev, d, day("2024-01-18"), day("2024-01-19"))
    assert [(t, float(v)) for t, v in rows(got, "event_type", "up2down")] == [("x", 1000.0)]


def test_hold_k_win_rate(spark):
    cal = calendar(spark, "2024-01-14", 20)
    # Saturday the 13th is before the calendar; +5 is Thursday the 18th, an open day.
    d = detail(
        spark,
        [("a", "2024-01-13", 10), ("a", "2024-01-18", 12)]
        + [("b", "2024-01-15", 10), ("b", "2024-01-20", 9)]
        + [("c", "2024-01-15", 10), ("c", "2024-01-20", 10)],
    )
    ev = events(
        spark, [("a", "x", "2024-01-13"), ("b", "x", "2024-01-15"), ("c", "y", "2024-01-15")]
    )
    got = returns.hold_k_win_rate(ev, cal, d, day("2024-01-01"), day("2024-01-31"))
    assert [(t, float(b), w) for t, b, w in rows(got, "event_type", "bi", "biamount")] == [
        ("x", 0.1, 0.5),
        ("y", 0.0, None),
    ]


def test_profit_bucket_weights_repeated_events(spark):
    d = detail(
        spark, [("a", "2024-01-01", 100), ("a", "2024-01-03", 101.5), ("b", "2024-01-01", 100)]
        + [("b", "2024-01-06", 101)],
    )
    ev = events(
        spark, [("a", "x", "2024-01-01"), ("a", "y", "2024-01-01"), ("b", "x", "2024-01-01")]
    )
    got = returns.profit_bucket_holding(ev, d, day("2024-01-01"))
    assert rows(got) == [("b", 1, pytest.approx(3.0))]
    near = returns.profit_bucket_holding(ev, d, day("2024-01-01"), max_days=2)
    assert rows(near) == [("a", 1, pytest.approx(2.0))]


def test_financing_forward_return_from_min_days(spark):
    d = detail(spark, [("a", f"2024-01-{i:02d}", 100 + i) for i in (1, 5, 6, 7)])
    fin = finance(spark, [("a", "2024-01-01", 25, 0, 0)])
    got = returns.financing_forward_return(fin, d, day("2024-01-01"))
    assert rows(got, "ds", "dif", "ffbi") == [(day("2024-01-06"), 5, 2), (day("2024-01-07"), 6, 2)]


def test_news_pop_needs_exactly_k_days(spark):
    d = detail(
        spark,
        [("a", "2024-01-01", 10), ("a", "2024-01-04", 10.8), ("b", "2024-01-01", 10)]
        + [("b", "2024-01-05", 20)],
    )
    told = news(spark, [("a", "2024-01-01 09:00:00", "t"), ("b", "2024-01-01 09:00:00", "u")])
    assert rows(returns.news_plus_k_pop(told, d), "code", "title", "dif") == [
        ("a", "t", dec("8.00"))
    ]


def test_news_after_close_includes_the_cutoff(spark):
    d = detail(spark, [("a", "2024-01-02", 10, 3)])
    told = news(
        spark,
        [("a", "2024-01-01 14:59:59", "early"), ("a", "2024-01-01 15:00:00", "late")],
    )
    both = [
        returns.news_next_day_move(told, d),
        returns.news_next_day_move(told, d, day("2024-01-02"), day("2024-01-01")),
    ]
    for got in both:
        assert rows(got, "title", "up_down_rate") == [("late", dec("3.00"))]
    assert returns.news_next_day_plain(d, told).count() == 2
    assert returns.news_next_day_ranked(d, told, boards=["9"]).count() == 0
    weekend = returns.news_next_day_plain(d, told, day("2024-01-02"), day("2023-12-31"))
    assert weekend.count() == 0


def _hot_code(spark, days):
    """One code with a price each day and a financing row each day, beside a few small codes."""
    first = dt.date(2020, 1, 1)
    items = [("hot", str(first + dt.timedelta(days=i)), 100 + (i * 7919) % 50) for i in range(days)]
    items += [(f"c{k}", str(first + dt.timedelta(days=i)), 10 + i) for k in range(5) for i in range(3)]
    prices = detail(spark, items)
    rows_ = finance(spark, [(c, d, 50, 0, 0) for c, d, _ in items])
    return prices, rows_, first


@pytest.mark.parametrize("max_days", [None, 90])
@pytest.mark.parametrize("block_days", [7, 128, 5_000])
def test_blocks_make_the_same_pairs(spark, block_days, max_days):
    prices, rows_, first = _hot_code(spark, 300)
    got = returns.financing_forward_return(
        rows_, prices, first, min_days=5, max_days=max_days, block_days=block_days, ordered=False
    )
    later = prices.selectExpr("code", "ds as sell", "current_price as q")
    plain = (
        prices.join(rows_.selectExpr("code", "notice_date as ds"), ["code", "ds"])
        .join(later, "code")
        .where(f"datediff(sell, ds) between 5 and {max_days or 10_000}")
        .selectExpr("code", "(q - current_price) * 100 / current_price as x", "sell as ds", "datediff(sell, ds) as dif")
    )
    shown = lambda df, x: sorted((r.code, str(r.ds), r.dif, round(float(r[x]), 4)) for r in df.collect())
    assert shown(got, "cash_dif") == shown(plain, "x")


def test_pairs_of_a_hot_code_are_spread(spark):
    """No task holds more of the hot code's pairs than a few pairs of blocks."""
    prices, rows_, first = _hot_code(spark, 800)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    options = {
        "spark.sql.shuffle.partitions": "64",
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    for key, value in options.items():
        spark.conf.set(key, value)
    try:
        pairs = returns._held_until_later(
            prices.select("code", "ds", "current_price"), prices, first, 1, None, 50
        )
        sizes = [r["count"] for r in pairs.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for key in options:
            spark.conf.unset(key)
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert sum(sizes) == 800 * 799 // 2 + 5 * 3
    # 16 blocks of 50 days make 136 pairs of blocks over 64 tasks
    assert len(sizes) > 40 and max(sizes) <= 8 * 50 * 50
