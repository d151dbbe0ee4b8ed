"""Screens: movers enriched with news, financing and report columns.

A screen takes the day ``day`` and looks at news or financing rows loaded ``gap``
days earlier. With ``day=None`` it runs for every day of the tables at once, joining
on (code, day), so one code's rows are spread over the days.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions import in_boards, on_day
from tickloom.operators.calendar import open_day_map
from tickloom.operators.joins import left_join_splittable
from tickloom.operators.series import latest_per_day

KEY = ["code", "dt"]


def _shifted(df: DataFrame, day: dt.date | None, gap: int, *columns: str | Column) -> DataFrame:
    """Rows loaded ``gap`` days before ``day``, labelled with the day they are matched to."""
    source = None if day is None else day - dt.timedelta(days=gap)
    return df.where(on_day(F.col("dt"), source)).select(
        "code", F.date_add("dt", gap).alias("dt"), *columns
    )


def _movers(
    detail: DataFrame,
    day: dt.date | None,
    boards: Sequence[str] | None,
    min_rate: float | int | None = None,
    *columns: str,
) -> DataFrame:
    rows = detail.where(on_day(F.col("dt"), day) & in_boards(F.col("board"), boards))
    if min_rate is not None:
        rows = rows.where(F.col("up_down_rate") >= min_rate)
    return rows.select("code", "dt", "up_down_rate", *columns)


def gainers(
    detail: DataFrame, day: dt.date | None = None, columns: Sequence[str] = ()
) -> DataFrame:
    """Rising stocks of a day, strongest first."""
    wanted = columns or [
        c
        for c in (
            "name",
            "pe_ratio_s",
            "main_inflow_ratio",
            "large_inflow_ratio",
            "mid_inflow_ratio",
        )
        if c in detail.columns
    ]
    return (
        detail.where(on_day(F.col("dt"), day) & (F.col("up_down_rate") > 0))
        .select("dt", "code", "up_down_rate", *wanted)
        .orderBy(F.desc("up_down_rate"), "code", "dt")
    )


def board_ranking(
    detail: DataFrame, day: dt.date | None = None, boards: Sequence[str] | None = None
) -> DataFrame:
    """All columns of the chosen boards on a day, by move."""
    return detail.where(
        on_day(F.col("dt"), day) & in_boards(F.col("board"), boards)
    ).orderBy(F.desc("up_down_rate"), "code", "dt")


def financing_news_panel(
    finance: DataFrame,
    detail: DataFrame,
    news: DataFrame,
    day: dt.date | None = None,
    gap: int = 1,
    boards: Sequence[str] | None = None,
) -> DataFrame:
    """Same-day financing rows, the move ``gap`` days later and the financing day's news.

    Here ``day`` is the financing day.
    """
    sold = (
        finance.where(on_day(F.col("dt"), day) & (F.col("notice_date") == F.col("dt")))
        .select(
            "code",
            F.col("notice_date").alias("news_day"),
            F.date_add("dt", gap).alias("dt"),
            "financing_purchase",
            "financing_repay",
            "financing_balance",
        )
    )
    detail_day = None if day is None else day + dt.timedelta(days=gap)
    moved = _movers(
        detail,
        detail_day,
        boards,
        None,
        "total_market_v",
        "circulation_market_v",
        "tradable_shares",
        "ds",
    )
    told = news.select("code", "title", F.to_date("notice_date").alias("news_day")).where(
        on_day(F.col("news_day"), day)
    )
    return (
        left_join_splittable(sold.join(moved, KEY, "inner"), told, ["code", "news_day"])
        .select(
            "code",
            "financing_purchase",
            "financing_repay",
            "financing_balance",
            "up_down_rate",
            "total_market_v",
            "circulation_market_v",
            "tradable_shares",
            "title",
            "ds",
        )
        .orderBy(F.desc("up_down_rate"), "code", "ds", "title")
    )


def _with_news(movers: DataFrame, news: DataFrame, day: dt.date | None, gap: int) -> DataFrame:
    return left_join_splittable(movers, _shifted(news, day, gap, "title"), KEY)


def _with_report(
    movers: DataFrame, report: DataFrame, measures: Sequence[str]
) -> DataFrame:
    """All report rows of the code, whatever their date (a mover repeats per report).

    Reports are few per code and movers many, so the left side is the one to split, which
    AQE does in a plain left join; the one join before it is the split one.
    """
    return movers.join(report.select("code", *measures), "code", "left")


def mover_news_report(
    detail: DataFrame,
    news: DataFrame,
    report: DataFrame,
    day: dt.date | None = None,
    gap: int = 1,
    boards: Sequence[str] | None = None,
) -> DataFrame:
    """A day's movers with the earlier news and all financial reports of the code."""
    measures = ["operate_profit_yoy", "total_current_assets_yoy"]
    movers = _movers(detail, day, boards, None, "turnover_rate")
    return (
        _with_report(_with_news(movers, news, day, gap), report, measures)
        .select("dt", "code", "up_down_rate", "title", *measures, "turnover_rate")
        .orderBy(F.desc("up_down_rate"), "code", "dt", "title", *measures)
    )


def strong_mover_report(
    detail: DataFrame,
    news: DataFrame,
    report: DataFrame,
    day: dt.date | None = None,
    gap: int = 1,
    boards: Sequence[str] | None = None,
    min_rate: float | int = 5,
) -> DataFrame:
    """Strong movers with the earlier news and the year-over-year report columns."""
    measures = ["monetary_funds_yoy", "total_operate_income_yoy", "netcash_operate_yoy"]
    movers = _movers(detail, day, boards, min_rate)
    return _with_report(_with_news(movers, news, day, gap), report, measures).select(
        "dt", "code", "up_down_rate", "title", *measures
    )


def news_of_movers(
    news: DataFrame,
    detail: DataFrame,
    day: dt.date | None = None,
    gap: int = 1,
    boards: Sequence[str] | None = None,
    min_rate: float | int = 4,
) -> DataFrame:
    """News rows whose stock rose by ``min_rate`` percent or more the day after."""
    columns = [c for c in news.columns if c not in KEY]
    told = _shifted(news, day, gap, *columns)
    movers = _movers(detail, day, boards, min_rate)
    # ``dt`` of the result is the news' own load day again.
    return told.join(movers, KEY, "inner").withColumn("dt", F.date_sub("dt", gap))


def movers_with_news(
    news: DataFrame,
    detail: DataFrame,
    day: dt.date | None = None,
    gap: int = 1,
    boards: Sequence[str] | None = None,
    min_rate: float | int = 4,
) -> DataFrame:
    """Movers of a day with the earlier news, movers without news included."""
    movers = _movers(detail, day, boards, min_rate)
    return _with_news(movers, news, day, gap).select("dt", "code", "title")


def _title_rule(title: str) -> Column:
    rules = {"not_null": F.col("title").isNotNull(), "null": F.col("title").isNull()}
    return rules[title]


def _net_purchase(finance: DataFrame) -> DataFrame:
    return finance.withColumn(
        "dif", F.col("financing_purchase") - F.col("financing_repay")
    ).where(F.col("dif") > 0)


def net_financing_news(
    detail: DataFrame,
    finance: DataFrame,
    news: DataFrame,
    day: dt.date | None = None,
    gap: int = 1,
    title: str = "not_null",
    boards: Sequence[str] | None = None,
) -> DataFrame:
    """Movers with net financing purchases the day before, with (or without) a news title.

    The net purchase must be positive, so that join is inner. A wanted title makes the
    news join inner too; ``title="null"`` keeps untitled news and movers without news.
    """
    movers = _movers(detail, day, boards).join(
        _shifted(_net_purchase(finance), day, gap, "dif"), KEY, "inner"
    )
    told = _shifted(news, day, gap, "title")
    if title == "not_null":
        joined = movers.join(told.where(_title_rule(title)), KEY, "inner")
    else:
        joined = left_join_splittable(movers, told, KEY).where(_title_rule(title))
    return joined.select("dt", "code", "up_down_rate", "title", "dif").orderBy(
        F.desc("up_down_rate"), "code", "dt", "title", "dif"
    )


def full_join_news_financing(
    news: DataFrame,
    finance: DataFrame,
    detail: DataFrame,
    cutoff: dt.datetime,
    day: dt.date,
    next_dt: dt.date,
    title: str = "not_null",
    boards: Sequence[str] | None = None,
) -> DataFrame:
    """News after a cutoff with the day's net financing, and the next day's move if any.

    Both sides of the full join are filtered on non-null columns, which leaves its
    inner part.
    """
    told = news.where((F.col("notice_date") > F.lit(cutoff).cast("timestamp_ntz"))).where(
        _title_rule(title)
    )
    net = _net_purchase(finance.where(F.col("dt") == F.lit(day))).select("code", "dif")
    both = told.select("code", "title").join(net, "code", "inner")
    moved = latest_per_day(
        detail.where((F.col("dt") == F.lit(next_dt)) & in_boards(F.col("board"), boards)).select(
            "code", "ds", "dt", "up_down_rate"
        )
    ).select("code", "up_down_rate")
    # The move side is unique per code: the hot side is the left one, which AQE can split.
    return both.join(moved, "code", "left").select(
        "code", "title", "dif", "up_down_rate"
    ).orderBy(F.desc("up_down_rate"), "code", "title", "dif")


def news_financing_days(
    news: DataFrame,
    finance: DataFrame,
    detail: DataFrame,
    calendar: DataFrame,
    cutoff: str = "15:00:00",
    title: str = "not_null",
    boards: Sequence[str] | None = None,
) -> DataFrame:
    """``full_join_news_financing`` for every open day of the tables at once.

    A news item belongs to the last open day whose ``cutoff`` it was published after; it
    meets that day's net financing and the move of the next open day, if there is one.
    Both days come from the calendar; items outside it have none and are left out.
    """
    days = F.broadcast(open_day_map(calendar))  # one row per date
    hours, minutes, seconds = (int(p) for p in cutoff.split(":"))
    closed = dt.timedelta(hours=hours, minutes=minutes, seconds=seconds, microseconds=1)
    told = news.where(_title_rule(title)).select(
        "code", "title", F.to_date(F.col("notice_date") - F.lit(closed)).alias("ds")
    )
    told = told.join(days, "ds", "inner").select(
        "code", "title", F.col("open_day").alias("dt"), "next_open"
    )
    both = told.join(_net_purchase(finance).select(*KEY, "dif"), KEY, "inner")
    # one row per (code, load day): the side that can't be split has no hot key
    moved = detail.where(in_boards(F.col("board"), boards)).select("code", "dt", "ds", "up_down_rate")
    moved = latest_per_day(moved, day="dt", snapshot="ds").select(
        "code", F.col("dt").alias("next_open"), "up_down_rate"
    )
    return (
        both.join(moved, ["code", "next_open"], "left")
        .select("dt", "code", "title", "dif", "up_down_rate")
        .orderBy("dt", F.desc("up_down_rate"), "code", "title", "dif")
    )


def score_ranking(
    chance: DataFrame, day: dt.date | None = None, col: str = "stock_rank_ratio"
) -> DataFrame:
    """Scores noticed on the day they were loaded, ordered by the number (not the text)."""
    return chance.where(
        on_day(F.col("dt"), day) & (F.col("notice_date") == F.col("dt"))
    ).orderBy(F.desc(col), "code", "dt")
