import datetime as dt
import random
from functools import reduce

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tests.frames import calendar, day, dec, rows
from tickloom.operators import patterns


def returns(spark, rates, code="a", first="2024-01-01"):
    items = [
        (code, dec(r), day(first) + dt.timedelta(days=i), i + 1) for i, r in enumerate(rates)
    ]
    return spark.createDataFrame(
        items, "code string, up_down_rate decimal(12,3), ds date, rk bigint"
    )


@settings(
    max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(st.integers(1, 9), st.integers(1, 5))
def test_number_of_full_windows(spark, n, w):
    s = returns(spark, range(1, n + 1))
    full = max(0, n - w + 1)
    assert patterns.kline_strings(s, w).count() == full
    assert patterns.window_rows(s, w).count() == full * w


def test_window_rows_match_a_range_join_on_a_gappy_series(spark):
    s = returns(spark, range(1, 13)).where("rk not in (4, 9)")
    ends = s.selectExpr("code", "rk - 4 as g", "rk as end_rk").where("g > 0")
    plain = ends.join(s, "code").where("rk between g and end_rk")
    got = patterns.window_rows(s)
    assert rows(got, "g", "rk", "up_down_rate") == rows(plain, "g", "rk", "up_down_rate")


def test_tokens_and_positions(spark):
    s = returns(spark, [1.4, -2.5, 0.5, 0])
    got = rows(patterns.kline_strings(s, 3), "tags", "kline", "nos")
    assert got == [(1, "1|-3|1", "1?2?3"), (2, "-3|1|0", "1?2?3")]
    assert rows(patterns.kline_signs(s, 4), "kline") == [("1,-1,1,0",)]


def test_cut_series_keeps_old_numbers(spark):
    s = returns(spark, range(1, 11))
    cut = patterns.kline_strings(s, 3, since=day("2024-01-04"))
    # Rows 4 and 5 end short windows: they use up tags 1 and 2.
    assert rows(cut, "tags")[0] == (3,)
    short = patterns.kline_strings_short(s, 3, since=day("2024-01-04"), count=2)
    assert rows(short, "tags", "kline") == [(2, "4|5")]
    assert patterns.kline_strings_short(s, 3, count=2).count() == 0


def klines(spark, strings):
    return spark.createDataFrame([("a", i, s) for i, s in enumerate(strings)],
                                 "code string, tags bigint, kline string")


def test_pattern_frequency_reads_decimals(spark):
    k = klines(spark, ["1|2|3.5", "1|2|4", "1|2|-1", "2|2|1", "2|2|0"])
    assert rows(patterns.pattern_frequency(k, 2)) == [("1|2", 2), ("2|2", 1)]


def test_pattern_up_ratio(spark):
    k = klines(spark, ["1,1,1"] * 3 + ["1,1,-1"] + ["-1,1,1"] * 2 + ["1,1,0"])
    got = patterns.pattern_up_ratio(k, 2, min_up=2)
    assert rows(got) == [("1,1", 3, 1, dec("75.00"))]


def test_weekly_training_skips_short_weeks(spark):
    # Mondays 1, 8, 15, 22 January 2024; the second week misses its Friday.
    cal = calendar(spark, "2024-01-01", 26)
    rates = []
    for i in range(26):
        d = day("2024-01-01") + dt.timedelta(days=i)
        if d != day("2024-01-12"):
            rates.append(("a", dec(f"{i}.26"), d))
    got = patterns.weekly_training(
        spark.createDataFrame(rates, "code string, up_down_rate decimal(10,3), ds date"), cal
    )
    assert rows(got, "weekofyear", "ups", "monday_result", "week_result") == [
        (1, "0.3,1.3,2.3,3.3,4.3", dec(14), dec(81)),
        (3, "14.3,15.3,16.3,17.3,18.3", dec(21), dec(116)),
    ]


def test_week_number_shared_by_both_ends_of_a_year(spark):
    # 30 and 31 December 1996 lie in ISO week 1, as do 1 to 5 January 1996: by calendar
    # year one group, ordered by date.
    cal = calendar(spark, "1996-01-01", 366)
    days = ["1996-01-03", "1996-01-04", "1996-01-05", "1996-12-30", "1996-12-31"]
    days += [f"1996-01-{d:02d}" for d in range(8, 13)]
    rates = [("a", dec(i), day(d)) for i, d in enumerate(days, 1)]
    got = patterns.weekly_training(
        spark.createDataFrame(rates, "code string, up_down_rate decimal(10,3), ds date"), cal
    )
    assert rows(got, "weekofyear", "ups") == [(1, "1.0,2.0,3.0,4.0,5.0")]


def test_unknown_token_is_an_error(spark):
    with pytest.raises(KeyError):
        patterns.kline_strings(returns(spark, [1]), 1, token="nope")


@pytest.mark.parametrize("token, width, prefix", [("round", 13, 12), ("round", 4, 3), ("sign", 8, 7), ("sign", 40, 39), ("round", 3, 1)])
def test_coded_patterns_equal_the_strings(spark, token, width, prefix):
    rng = random.Random(width)
    parts = [
        returns(spark, [rng.choice([-99999999 / 100, 12345678.9, -0.4, 0.5, 1.5, -1, 2]) for _ in range(60)], code)
        for code in "abc"
    ]
    s = reduce(lambda a, b: a.unionByName(b), parts)
    since = day("2024-01-06")
    for cut in (None, since):
        strings = patterns.kline_strings_short(s, width, token, "|", since=cut)
        got = patterns.pattern_frequency_of(s, width, prefix, token, since=cut)
        assert rows(got) == rows(patterns.pattern_frequency(strings, prefix))
        got = patterns.pattern_up_ratio_of(s, width, prefix, token, "|", min_up=0, since=cut)
        assert rows(got) == rows(patterns.pattern_up_ratio(strings, prefix, "|", min_up=0))
        assert got.count()
