import datetime as dt

from pyspark.sql import functions as F

from tests.frames import calendar, day, dec, detail, finance, news, rows
from tickloom.operators import flow, screens
from tickloom.operators.joins import left_join_splittable


def test_splittable_left_join_equals_left_join(spark):
    left = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3), (None, 4)], "k string, l int")
    right = spark.createDataFrame([("a", 10), ("a", 11), ("c", None), (None, 9)], "k string, r int")
    got = left_join_splittable(left, right, ["k"])
    assert rows(got) == rows(left.join(right, "k", "left"))


def setup(spark):
    d = detail(
        spark,
        [("a", "2024-01-02", 10, 6), ("b", "2024-01-02", 10, 4), ("c", "2024-01-02", 10, 1)]
        + [("z", "2024-01-02", 10, 9, "7")],
    )
    told = news(
        spark,
        [("a", "2024-01-01 10:00:00", "t1"), ("a", "2024-01-01 16:00:00", None)]
        + [("c", "2024-01-01 16:00:00", "t3"), ("b", "2024-01-02 16:00:00", "too late")],
    )
    return d, told


def test_movers_and_their_news(spark):
    d, told = setup(spark)
    on = {"day": day("2024-01-02"), "boards": ["2"]}
    assert rows(screens.movers_with_news(told, d, **on), "code", "title") == [
        ("a", None),
        ("a", "t1"),
        ("b", None),
    ]
    found = screens.news_of_movers(told, d, **on)
    assert rows(found, "code", "title", "dt", "up_down_rate") == [
        ("a", None, day("2024-01-01"), dec("6.00")),
        ("a", "t1", day("2024-01-01"), dec("6.00")),
    ]


def test_one_day_equals_the_day_of_all_days(spark):
    d, told = setup(spark)
    one = screens.movers_with_news(told, d, day=day("2024-01-02"))
    every = screens.movers_with_news(told, d).where(F.col("dt") == day("2024-01-02"))
    assert rows(one) == rows(every)


def test_report_join_repeats_per_report(spark):
    d, told = setup(spark)
    report = spark.createDataFrame(
        [("a", dec(1), dec(2)), ("a", dec(3), dec(4))],
        "code string, operate_profit_yoy decimal(10,2), total_current_assets_yoy decimal(10,2)",
    )
    got = screens.mover_news_report(d, told, report, day("2024-01-02"), boards=["2"])
    counts = {r["code"]: r["count"] for r in got.groupBy("code").count().collect()}
    assert counts == {"a": 4, "b": 1, "c": 1}


def test_net_financing_title_rules(spark):
    d, told = setup(spark)
    fin = finance(
        spark,
        [("a", "2024-01-01", 9, 1, 0), ("b", "2024-01-01", 9, 1, 0), ("c", "2024-01-01", 1, 9, 0)],
    )
    titled = screens.net_financing_news(d, fin, told)
    assert rows(titled, "code", "title", "dif") == [("a", "t1", dec("8.0000"))]
    untitled = screens.net_financing_news(d, fin, told, title="null")
    assert rows(untitled, "code", "title") == [("a", None), ("b", None)]


def test_full_join_keeps_news_without_next_day(spark):
    d, told = setup(spark)
    fin = finance(spark, [(c, "2024-01-01", 9, 1, 0) for c in ("a", "c")])
    args = (dt.datetime(2024, 1, 1, 15), day("2024-01-01"))
    got = screens.full_join_news_financing(told, fin, d, *args, day("2024-01-02"))
    assert rows(got, "code", "title", "up_down_rate") == [("c", "t3", dec("1.00"))]
    none = screens.full_join_news_financing(told, fin, d, *args, day("2024-01-05"))
    assert rows(none, "code", "up_down_rate") == [("c", None)]


def test_scores_sort_as_numbers(spark):
    chance = spark.createDataFrame(
        [("a", dec("9.5")), ("b", dec("10.1"))], "code string, stock_rank_ratio decimal(10,2)"
    ).withColumns({c: F.lit(day("2024-01-01")) for c in ("notice_date", "dt")})
    order = [r["code"] for r in screens.score_ranking(chance, day("2024-01-01")).collect()]
    assert order == ["b", "a"]


def test_rankings_are_ordered(spark):
    d, _ = setup(spark)
    assert [r["code"] for r in screens.gainers(d).collect()] == ["z", "a", "b", "c"]
    assert [r["code"] for r in screens.board_ranking(d, boards=["2"]).collect()] == ["a", "b", "c"]


def deals(spark):
    return spark.createDataFrame(
        [
            ("a", 2, dec(5), dec(2), 1),
            ("a", 1, dec(50), dec(3), 2),
            ("a", 4, dec(500), dec(1), 3),
            ("a", 0, dec(99), dec(1), 4),
            ("a", 2, None, dec(1), 5),
        ],
        "code string, buyorsale int, draw decimal(10,0), deal decimal(10,2), dealnum bigint",
    ).withColumn("dt", F.lit(day("2024-01-01")))


def test_tick_aggregates(spark):
    t = deals(spark)
    assert [float(v) for v in rows(flow.side_pivot(t))[0][1:]] == [6, 2, 5, 50, 10, 150]
    assert [float(v) for v in rows(flow.side_amount(t))[0][1:]] == [1000, 15000, 50000]
    assert {b: n for b, n in rows(flow.lot_histogram(t))} == {10: 1, 99: 1, 999: 2, 9999: 1}
    assert flow.side_pivot(t, day("2024-01-02")).count() == 0
    assert flow.side_pivot(t, code="a").count() == 1


def test_flow_shares_sum_to_hundred_and_zero_is_null(spark):
    d = spark.createDataFrame(
        [("a", 10, -20, 30, -40, 0), ("b", 0, 0, 0, 0, 0)],
        "code string, main_inflow int, slarge_inflow int, large_inflow int, "
        "mid_inflow int, small_inflow int",
    ).withColumns(
        {"ds": F.lit(day("2024-01-01")), "dt": F.lit(day("2024-01-01")), "up_down_rate": F.lit(1)}
    )
    shares = {r["code"]: r for r in flow.flow_share(d).collect()}
    parts = ["main", "slarge", "large", "mid", "small"]
    assert sum(abs(shares["a"][p]) for p in parts) == 100
    assert all(shares["b"][p] is None for p in parts)
    assert rows(flow.flow_total(d), "code", "total_inflow") == [("a", -20), ("b", 0)]
    assert rows(flow.big_small_flow(d)) == [("a", -10, -40), ("b", 0, 0)]


def test_news_meet_the_last_close_before_them(spark):
    cal = calendar(spark, "2024-01-18", 6)  # Thursday to Tuesday
    n = news(
        spark,
        [
            ("a", "2024-01-18 15:00:00", "at the close: Wednesday's, not in the calendar's days"),
            ("a", "2024-01-18 15:00:01", "Thursday"),
            ("a", "2024-01-19 14:59:59", "Thursday still"),
            ("a", "2024-01-21 09:00:00", "Friday, told on Sunday"),
            ("a", "2024-01-22 15:00:00", "Friday, told at Monday's close"),
            ("a", "2024-01-23 16:00:00", "Tuesday, no day after"),
            ("b", "2024-01-19 16:00:00", "sold off"),
        ],
    )
    f = finance(spark, [(c, f"2024-01-{d}", 9 if c == "a" else 1, 2, 0) for c in "ab" for d in (18, 19, 22, 23)])
    d = detail(spark, [("a", f"2024-01-{x}", 10, x) for x in (19, 22)])
    got = rows(screens.news_financing_days(n, f, d, cal), "title", "dt", "dif", "up_down_rate")
    assert got == [
        ("Friday, told at Monday's close", day("2024-01-19"), dec("7.0000"), dec("22.00")),
        ("Friday, told on Sunday", day("2024-01-19"), dec("7.0000"), dec("22.00")),
        ("Thursday", day("2024-01-18"), dec("7.0000"), dec("19.00")),
        ("Thursday still", day("2024-01-18"), dec("7.0000"), dec("19.00")),
        ("Tuesday, no day after", day("2024-01-23"), dec("7.0000"), None),
    ]
