"""Streaks (gaps and islands) of prices and financing balances."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions import by_code, in_boards, on_day
from tickloom.operators.calendar import calendar_rank, open_day_map
from tickloom.operators.joins import left_join_splittable
from tickloom.operators.series import board_codes, latest_per_day

UP, DOWN = 1, 2


def _linked(ranked: DataFrame, value: str, directions: Sequence[int]) -> DataFrame:
    """Rows whose predecessor (rank - 1) was lower or higher, tagged and given a run key.

    ``ranked`` has one row per (code, rk). Rank minus the position among the linked
    rows of one direction is constant along a run. Both directions are numbered in
    the same pass: the tag is part of the partition key, and ``code`` alone still
    satisfies the distribution, so there is no further exchange.
    """
    w = by_code("rk")
    before, before_rk = F.lag(value).over(w), F.lag("rk").over(w)
    tag = F.when(F.col(value) > F.col("_before"), UP).when(F.col(value) < F.col("_before"), DOWN)
    position = F.row_number().over(Window.partitionBy("code", "tag").orderBy("rk"))
    return (
        ranked.withColumns({"_before": before, "_before_rk": before_rk})
        .where(F.col("_before_rk") == F.col("rk") - 1)
        .withColumn("tag", tag)
        .where(F.col("tag").isin(*directions))
        .withColumn("run", F.col("rk") - position)
    )


def _runs(
    linked: DataFrame, day: str, measure: Column, alive_at: dt.date | None, min_pairs: int
) -> DataFrame:
    """One row per run: its length in days and its measure."""
    runs = linked.groupBy("code", "tag", "run").agg(
        F.count(F.lit(1)).alias("pairs"), measure.alias("measure"), F.max(day).alias("last_day")
    )
    runs = runs.where(F.col("pairs") >= min_pairs)
    return runs if alive_at is None else runs.where(F.col("last_day") == F.lit(alive_at))


def _price_runs(
    detail: DataFrame,
    calendar: DataFrame,
    as_of: dt.date | None,
    lookback: int | None,
    boards: Sequence[str] | None,
    min_pairs: int,
    directions: Sequence[int],
) -> DataFrame:
    since = None
    if lookback is not None:
        if as_of is None:
            raise ValueError("a lookback needs an as-of day")
        since = as_of - dt.timedelta(days=lookback)
    rows = detail.where(in_boards(F.col("board"), boards))
    if since is not None:
        rows = rows.where(F.col("dt") >= F.lit(since))
    days = latest_per_day(rows.select("code", "ds", "dt", "current_price", "up_down_rate"))
    # One row per open day: broadcasting the calendar is bounded by the dates covered.
    ranked = days.join(F.broadcast(calendar_rank(calendar, since)), "ds", "inner")
    linked = _linked(ranked, "current_price", directions)
    return _runs(linked, "ds", F.sum("up_down_rate"), as_of, min_pairs).select(
        "code",
        (F.col("pairs") + 1).alias("times"),
        F.col("measure").alias("sumrate"),
        "tag",
    )


def price_streaks(
    detail: DataFrame,
    calendar: DataFrame,
    as_of: dt.date | None,
    lookback: int | None = 10,
    boards: Sequence[str] | None = None,
    min_pairs: int = 2,
) -> DataFrame:
    """Runs of trading days with rising (tag 1) or falling (tag 2) closes.

    ``times`` counts the days including the first, ``sumrate`` adds the daily moves
    without the first. With ``as_of`` only runs that reach that day are kept; with
    ``as_of=None, lookback=None`` every run of the series is returned.
    """
    return _price_runs(detail, calendar, as_of, lookback, boards, min_pairs, (UP, DOWN))


def price_streak_up(
    detail: DataFrame,
    calendar: DataFrame,
    as_of: dt.date | None,
    lookback: int | None = 10,
    boards: Sequence[str] | None = None,
    min_pairs: int = 2,
) -> DataFrame:
    """The rising runs of ``price_streaks``."""
    return _price_runs(detail, calendar, as_of, lookback, boards, min_pairs, (UP,))


def price_streak_down(
    detail: DataFrame,
    calendar: DataFrame,
    as_of: dt.date | None,
    lookback: int | None = 10,
    boards: Sequence[str] | None = None,
    min_pairs: int = 2,
) -> DataFrame:
    """The falling runs of ``price_streaks``."""
    return _price_runs(detail, calendar, as_of, lookback, boards, min_pairs, (DOWN,))


def _balance_runs(
    finance: DataFrame,
    detail: DataFrame,
    as_of: dt.date | None,
    lookback: int | None,
    boards: Sequence[str] | None,
    min_pairs: int,
    directions: Sequence[int],
) -> DataFrame:
    rows, yesterday = finance, None
    if as_of is not None:
        yesterday = as_of - dt.timedelta(days=1)
        if lookback is not None:
            rows = rows.where(F.col("dt") >= F.lit(as_of - dt.timedelta(days=lookback)))
    elif lookback is not None:
        raise ValueError("a lookback needs an as-of day")
    listed = board_codes(detail, boards, yesterday)
    days = latest_per_day(
        rows.select("code", "notice_date", "dt", "financing_balance"), day="notice_date"
    ).join(listed, "code", "left_semi")
    ranked = days.withColumn("rk", F.row_number().over(by_code("notice_date")))
    linked = _linked(ranked, "financing_balance", directions)
    spread = F.max("financing_balance") - F.min("financing_balance")
    signed = F.when(F.col("tag") == UP, F.col("measure")).otherwise(-F.col("measure"))
    return _runs(linked, "notice_date", spread, yesterday, min_pairs).select(
        "code", (F.col("pairs") + 1).alias("times"), signed.alias("sumprice"), "tag"
    )


def balance_streaks(
    finance: DataFrame,
    detail: DataFrame,
    as_of: dt.date | None,
    lookback: int | None = 11,
    boards: Sequence[str] | None = None,
    min_pairs: int = 2,
) -> DataFrame:
    """Runs of consecutive observations with a rising or falling financing balance.

    Adjacency is by observation, not by calendar. ``sumprice`` is the spread between
    the run's extremes without its first day, negative for falling runs. With
    ``as_of`` only runs whose last notice is the day before are kept.
    """
    return _balance_runs(finance, detail, as_of, lookback, boards, min_pairs, (UP, DOWN))


def balance_streak_up(
    finance: DataFrame,
    detail: DataFrame,
    as_of: dt.date | None,
    lookback: int | None = 11,
    boards: Sequence[str] | None = None,
    min_pairs: int = 2,
) -> DataFrame:
    """The rising runs of ``balance_streaks``."""
    return _balance_runs(finance, detail, as_of, lookback, boards, min_pairs, (UP,))


def balance_streak_down(
    finance: DataFrame,
    detail: DataFrame,
    as_of: dt.date | None,
    lookback: int | None = 11,
    boards: Sequence[str] | None = None,
    min_pairs: int = 2,
) -> DataFrame:
    """The falling runs of ``balance_streaks``."""
    return _balance_runs(finance, detail, as_of, lookback, boards, min_pairs, (DOWN,))


def daily_growth_islands(
    finance: DataFrame,
    on_date: dt.date | None = None,
    min_size: int = 2,
    codes: DataFrame | None = None,
) -> DataFrame:
    """Days on which financing purchases did not fall against the previous calendar day.

    Each such day carries the size of its island of adjacent calendar days, so a
    Friday never links to a Monday. Islands below ``min_size`` are left out. ``codes``
    (distinct) restricts the codes before the windows; islands lie within one code, so
    their sizes stay.
    """
    days = latest_per_day(
        finance.select("code", "notice_date", "dt", "financing_purchase"), day="notice_date"
    )
    if codes is not None:
        days = days.join(codes, "code", "left_semi")
    w = by_code("notice_date")
    grown = (
        days.withColumns(
            {
                "_day": F.lag("notice_date").over(w),
                "_purchase": F.lag("financing_purchase").over(w),
            }
        )
        .where(F.col("notice_date") == F.date_add("_day", 1))
        .where(F.col("financing_purchase") >= F.col("_purchase"))
        .withColumn("rk", F.row_number().over(w))
        .withColumn("island", F.date_sub("notice_date", F.col("rk")))
    )
    size = F.count(F.lit(1)).over(Window.partitionBy("code", "island"))
    return (
        grown.withColumn("num", size)
        .where((F.col("num") >= min_size) & on_day(F.col("notice_date"), on_date))
        .select("code", "notice_date", F.col("financing_purchase").alias("pre"), "rk", "num")
    )


def growth_screen(
    detail: DataFrame,
    finance: DataFrame,
    news: DataFrame,
    on_date: dt.date,
    exists_dt: dt.date,
    islands_date: dt.date,
    news_dts: Sequence[dt.date],
    max_price: float | int | None = 40,
    boards: Sequence[str] | None = None,
    min_size: int = 2,
) -> DataFrame:
    """Affordable movers whose financing purchases kept growing, with their latest news.

    Only the codes picked that day go through the windows over the financing rows.
    """
    picked = _affordable(detail.where(F.col("dt") == F.lit(on_date)), max_price, boards)
    codes = picked.select("code").distinct()
    growing = daily_growth_islands(finance, islands_date, min_size, codes).select("code")
    present = detail.where(F.col("dt") == F.lit(exists_dt)).select("code")
    picked = (
        picked.select("code", "up_down_rate", "turnover_rate")
        .join(growing, "code", "left_semi")
        .join(present, "code", "left_semi")
    )
    titles = news.where(F.col("dt").isin(*news_dts)).select("code", "title")
    return left_join_splittable(picked, titles, ["code"])


def _affordable(
    detail: DataFrame, max_price: float | int | None, boards: Sequence[str] | None
) -> DataFrame:
    rows = detail.where(in_boards(F.col("board"), boards))
    return rows if max_price is None else rows.where(F.col("current_price") <= max_price)


def growth_screen_days(
    detail: DataFrame,
    finance: DataFrame,
    news: DataFrame,
    calendar: DataFrame,
    max_price: float | int | None = 40,
    boards: Sequence[str] | None = None,
    min_size: int = 2,
) -> DataFrame:
    """``growth_screen`` for every open day of the tables at once.

    The code must have been listed on the open day before, and that day must lie in an
    island of growing purchases. News counts if it was loaded from that day on and before
    the day itself; its load day is mapped to the next open day by the calendar.
    """
    days = F.broadcast(open_day_map(calendar))  # one row per date
    opened = days.where("open_day = ds").select(F.col("ds").alias("dt"), "prev_open")
    picked = _affordable(detail, max_price, boards).select("code", "dt", "up_down_rate", "turnover_rate")
    picked = picked.join(opened, "dt", "inner")
    codes = picked.select("code").distinct()
    before = ["code", "prev_open"]
    growing = daily_growth_islands(finance, None, min_size, codes).select(
        "code", F.col("notice_date").alias("prev_open")
    )
    present = detail.select("code", F.col("dt").alias("prev_open"))
    picked = picked.join(growing, before, "left_semi").join(present, before, "left_semi")
    ahead = days.where("next_open is not null").select(F.col("ds").alias("dt"), "next_open")
    titles = news.join(ahead, "dt", "inner").select("code", F.col("next_open").alias("dt"), "title")
    return left_join_splittable(picked.drop("prev_open"), titles, ["code", "dt"]).select(
        "dt", "code", "up_down_rate", "turnover_rate", "title"
    )


def ranked_trading_rows(
    detail: DataFrame,
    calendar: DataFrame,
    since: dt.date | None = None,
    boards: Sequence[str] | None = None,
) -> DataFrame:
    """Rows of open days with the day's consecutive number since the start of its month."""
    rows = detail.where(in_boards(F.col("board"), boards))
    if since is not None:
        rows = rows.where(F.col("dt") >= F.lit(since))
        since = since.replace(day=1)
    return rows.select("code", "ds", "current_price", "up_down_rate", "turnover_rate").join(
        F.broadcast(calendar_rank(calendar, since)), "ds", "inner"
    )
