import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tests.frames import calendar, day, dec, detail, finance, news, rows
from tickloom.operators import streaks
from tickloom.operators.calendar import calendar_rank, open_day_map
from tickloom.operators.series import latest_per_day

# 2024-01-19 is a Friday.
WEEK = ["2024-01-18", "2024-01-19", "2024-01-22", "2024-01-23", "2024-01-24"]


def streak(df, *keys):
    return rows(df, "code", "times", "sumrate", "tag")


def test_calendar_rank_skips_closed_days(spark):
    cal = calendar(spark, "2024-01-19", 5, closed=("2024-01-23",))
    assert rows(calendar_rank(cal, day("2024-01-19"))) == [
        (day("2024-01-19"), 1),
        (day("2024-01-22"), 2),
    ]


def test_streak_runs_over_a_weekend(spark):
    d = detail(spark, [("a", ds, 10 + i, 1.5) for i, ds in enumerate(WEEK)])
    cal = calendar(spark, "2024-01-14", 12)
    got = streaks.price_streaks(d, cal, day("2024-01-24"))
    assert streak(got) == [("a", 5, dec("6.00"), 1)]  # first day's rate not summed


def test_closed_day_rows_vanish_and_missing_day_breaks(spark):
    cal = calendar(spark, "2024-01-14", 12)
    saturday = [("a", "2024-01-20", 1, 9)]  # no open day: ignored, does not break
    d = detail(spark, [("a", ds, 10 + i, 1) for i, ds in enumerate(WEEK)] + saturday)
    assert streak(streaks.price_streaks(d, cal, day("2024-01-24"))) == [("a", 5, dec("4.00"), 1)]
    gap = detail(spark, [("a", ds, 10 + i, 1) for i, ds in enumerate(WEEK) if i != 2])
    assert streak(streaks.price_streaks(gap, cal, day("2024-01-24"))) == []


def test_equal_and_null_prices_end_a_streak(spark):
    cal = calendar(spark, "2024-01-14", 12)
    prices = {"e": [1, 2, 2, 3, 4], "n": [1, 2, None, 3, 4], "d": [9, 8, 7, 6, 5]}
    d = detail(
        spark, [(c, ds, p, -1) for c, ps in prices.items() for ds, p in zip(WEEK, ps, strict=True)]
    )
    got = streaks.price_streaks(d, cal, day("2024-01-24"))
    assert streak(got) == [("d", 5, dec("-4.00"), 2), ("e", 3, dec("-2.00"), 1)]


def test_not_alive_at_as_of(spark):
    cal = calendar(spark, "2024-01-14", 12)
    d = detail(spark, [("a", ds, p) for ds, p in zip(WEEK, [1, 2, 3, 4, 4], strict=True)])
    assert streak(streaks.price_streaks(d, cal, day("2024-01-24"))) == []
    every = streaks.price_streaks(d, cal, None, lookback=None)
    assert streak(every) == [("a", 4, dec("3.00"), 1)]


def test_duplicate_business_day_takes_latest_load(spark):
    cal = calendar(spark, "2024-01-14", 12)
    base = [("a", ds, 10 + i, 1) for i, ds in enumerate(WEEK)]
    stale = [("a", "2024-01-22", 99, 7, "2", "2024-01-21")]
    d = detail(spark, base + stale)
    assert d.count() == 6 and latest_per_day(d).count() == 5
    assert streak(streaks.price_streaks(d, cal, day("2024-01-24"))) == [("a", 5, dec("4.00"), 1)]


def test_board_filter_and_lookback(spark):
    cal = calendar(spark, "2024-01-14", 12)
    d = detail(
        spark,
        [(c, ds, 10 + i, 1, b) for c, b in (("a", "2"), ("b", "7")) for i, ds in enumerate(WEEK)],
    )
    got = streaks.price_streaks(d, cal, day("2024-01-24"), boards=["2", "6"])
    assert streak(got) == [("a", 5, dec("4.00"), 1)]
    short = streaks.price_streaks(d, cal, day("2024-01-24"), lookback=2, boards=["2"])
    assert streak(short) == [("a", 3, dec("2.00"), 1)]


@settings(
    max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(st.lists(st.lists(st.integers(1, 4), min_size=5, max_size=5), min_size=1, max_size=4))
def test_rising_runs_mirror_falling_runs(spark, prices):
    cal = calendar(spark, "2024-01-14", 12)

    def frame(sign):
        return detail(
            spark,
            [
                (str(c), ds, 10 + sign * p, 1)
                for c, ps in enumerate(prices)
                for ds, p in zip(WEEK, ps, strict=True)
            ],
        )

    up = streaks.price_streak_up(frame(1), cal, None, lookback=None)
    down = streaks.price_streak_down(frame(-1), cal, None, lookback=None)
    assert rows(up, "code", "times", "sumrate") == rows(down, "code", "times", "sumrate")


def test_balance_streaks_follow_observations(spark):
    listed = detail(spark, [("a", "2024-01-24", 1), ("b", "2024-01-24", 1, 1, "9")])
    days = ["2024-01-17", "2024-01-19", "2024-01-23", "2024-01-24"]
    fin = finance(
        spark,
        [("a", d, 0, 0, v) for d, v in zip(days, [9.25, 10.5, 11, 100], strict=True)]
        + [("b", d, 0, 0, v) for d, v in zip(days, [4, 3, 2, 1], strict=True)],
    )
    got = streaks.balance_streaks(fin, listed, day("2024-01-25"), boards=["2"])
    assert rows(got) == [("a", 4, dec("89.5000"), 1)]
    down = streaks.balance_streak_down(fin, listed, day("2024-01-25"))
    assert rows(down) == [("b", 4, dec("-2.0000"), 2)]


def test_growth_islands_use_calendar_days(spark):
    days = ["2024-01-17", "2024-01-18", "2024-01-19", "2024-01-22", "2024-01-23"]
    fin = finance(
        spark, [("a", d, p, 0, 0) for d, p in zip(days, [1, 1, 2, 3, 4], strict=True)]
    )
    got = streaks.daily_growth_islands(fin)
    # Thursday and Friday form one island; Monday never links to Friday.
    assert rows(got, "notice_date", "rk", "num") == [
        (day("2024-01-18"), 1, 2),
        (day("2024-01-19"), 2, 2),
    ]


def test_growth_screen_keeps_movers_without_news(spark):
    fin = finance(
        spark,
        [(c, f"2024-01-{d}", d, 0, 0) for c in ("a", "b", "c") for d in (17, 18, 19)],
    )
    d = detail(
        spark,
        [(c, ds, 10) for c in ("a", "b") for ds in ("2024-01-19", "2024-01-22")]
        + [("c", "2024-01-22", 10)],
    )
    told = news(spark, [("a", "2024-01-19 10:00:00", "x"), ("a", "2024-01-21 10:00:00", "y")])
    got = streaks.growth_screen(
        d, fin, told, day("2024-01-22"), day("2024-01-19"), day("2024-01-19"),
        [day("2024-01-19"), day("2024-01-21")],
    )
    assert rows(got, "code", "title") == [("a", "x"), ("a", "y"), ("b", None)]


def test_ranked_rows_number_from_month_start(spark):
    cal = calendar(spark, "2024-01-01", 31)
    d = detail(spark, [("a", "2024-01-20", 1), ("a", "2024-01-22", 1)])
    got = streaks.ranked_trading_rows(d, cal, since=dt.date(2024, 1, 19))
    assert rows(got, "ds", "rk") == [(day("2024-01-22"), 16)]


def test_open_day_map(spark):
    cal = calendar(spark, "2024-01-19", 6, closed=("2024-01-23",))  # Friday to Wednesday
    got = rows(open_day_map(cal), "ds", "open_day", "prev_open", "next_open")
    friday, monday, wednesday = day("2024-01-19"), day("2024-01-22"), day("2024-01-24")
    assert got == [
        (friday, friday, None, monday),
        (day("2024-01-20"), friday, friday, monday),
        (day("2024-01-21"), friday, friday, monday),
        (monday, monday, friday, wednesday),
        (day("2024-01-23"), monday, monday, wednesday),
        (wednesday, wednesday, monday, None),
    ]


def test_growth_screen_days_agree_with_single_days(spark):
    cal = calendar(spark, "2024-01-10", 14, closed=("2024-01-17",))
    days = [day("2024-01-10") + dt.timedelta(days=i) for i in range(14)]
    d = detail(spark, [(c, str(x), 30 + i, i) for c in "abc" for i, x in enumerate(days) if (i + ord(c)) % 5])
    f = finance(spark, [(c, str(x), (i * ord(c)) % 7, 0, 1) for c in "abc" for i, x in enumerate(days)])
    n = news(spark, [(c, f"{x} 10:00:00", f"{c}{x}") for c in "ab" for x in days[::2]])
    every = streaks.growth_screen_days(d, f, n, cal, max_price=38)
    expected = []
    opened = sorted(r.ds for r in cal.where("astatus = 1").collect())
    for before, today in zip(opened, opened[1:]):
        told = [before + dt.timedelta(days=i) for i in range((today - before).days)]
        one = streaks.growth_screen(d, f, n, today, before, before, told, max_price=38)
        expected += [(today, *r) for r in one.collect()]
    assert sorted(map(str, expected)) == sorted(str(tuple(r)) for r in every.collect())
    assert expected
