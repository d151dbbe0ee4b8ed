"""Event studies: what a price did after an event, a news item or a financing row.

The returns are computed on the price table first, where (code, ds) is unique, and
the many-rows-per-code side (events, news) is joined to them once on (code, day).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions import day_number, in_boards, on_day, pct_change
from tickloom.operators.calendar import open_days
from tickloom.operators.series import latest_per_day

# Days of a block in joins of a code's days with its later days.
BLOCK_DAYS = 128


def _prices(detail: DataFrame, *extra: str) -> DataFrame:
    return latest_per_day(detail.select("code", "ds", "dt", "current_price", *extra)).drop("dt")


def _with_price_after(detail: DataFrame, days: int, *extra: str) -> DataFrame:
    """Prices with the price exactly ``days`` calendar days later.

    A RANGE frame of that single day replaces the self-join. Days without such a
    later row are left out; a later row whose price is NULL stays, with a NULL.
    """
    later = Window.partitionBy("code").orderBy(day_number(F.col("ds"))).rangeBetween(days, days)
    return (
        _prices(detail, *extra)
        .withColumns(
            {
                "_later": F.max("current_price").over(later),
                "_later_rows": F.count(F.lit(1)).over(later),
            }
        )
        .where(F.col("_later_rows") > 0)
        .drop("_later_rows")
    )


def _moves_to(
    detail: DataFrame, end: dt.date, first: dt.date | None = None, last: dt.date | None = None
) -> DataFrame:
    """Percent move from every day in [first, last] to ``end`` for the codes that traded on ``end``.

    The end price comes from a slice of one day, so no code's history is gathered.
    """
    days = detail
    if first is not None:
        days = days.where(F.col("ds") >= F.lit(first))
    if last is not None:
        days = days.where(F.col("ds") <= F.lit(last))
    finish = _prices(detail.where(F.col("ds") == F.lit(end)))
    finish = finish.select("code", F.col("current_price").alias("_end"))
    return (
        _prices(days)
        .join(finish, "code", "inner")
        .select("code", "ds", pct_change(F.col("_end"), F.col("current_price")).alias("move"))
    )


def event_to_date_return(
    events: DataFrame, calendar: DataFrame, detail: DataFrame, since: dt.date, end: dt.date
) -> DataFrame:
    """Move from the day after each event, if that is an open day, to a fixed end day."""
    starts = F.broadcast(open_days(calendar, since))  # one row per date
    return (
        events.where(F.col("notice_date") >= F.lit(since))
        .select(
            "code", "event_type", "specific_eventtype", F.date_add("notice_date", 1).alias("ds")
        )
        .join(starts, "ds", "left_semi")
        .join(_moves_to(detail, end, first=since), ["code", "ds"], "inner")
        .select(
            "code",
            "event_type",
            "specific_eventtype",
            F.concat(F.col("move").cast("string"), F.lit("%")).alias("upordown"),
            "move",
        )
        .orderBy("move", "code", "event_type", "specific_eventtype")
        .drop("move")
    )


def event_type_return(
    events: DataFrame, detail: DataFrame, on_date: dt.date | None, end: dt.date
) -> DataFrame:
    """Summed move to ``end`` per event type; without ``on_date`` per day and type."""
    seen = (
        events.where(on_day(F.col("notice_date"), on_date))
        .select("code", "event_type", F.col("notice_date").alias("ds"))
        .distinct()
    )
    moves = _moves_to(detail, end, first=on_date, last=on_date)
    return (
        seen.join(moves.where(F.col("move").isNotNull()), ["code", "ds"], "inner")
        .groupBy("ds", "event_type")
        .agg((F.round(F.sum("move"), 2) * 100).alias("up2down"))
        .orderBy(F.desc("up2down"), "ds", "event_type")
    )


def hold_k_win_rate(
    events: DataFrame,
    calendar: DataFrame,
    detail: DataFrame,
    start: dt.date,
    end: dt.date,
    k: int = 5,
) -> DataFrame:
    """Per event type: summed return of holding ``k`` calendar days, and share of gains.

    The event day or the day ``k`` later must be an open day. Both cases are one set
    of dates (the open days and the open days moved back by ``k``), so the two-way
    condition is a single semi join on the notice date. Zero moves count neither way.
    """
    opened = open_days(calendar)
    eligible = opened.unionByName(opened.select(F.date_sub("ds", k).alias("ds"))).distinct()
    held = (
        events.where(F.col("notice_date").between(F.lit(start), F.lit(end)))
        .select("code", "event_type", F.col("notice_date").alias("ds"))
        .distinct()
        .join(F.broadcast(eligible), "ds", "left_semi")  # at most two rows per date
    )
    growth = F.try_divide(F.col("_later") - F.col("current_price"), F.col("current_price"))
    days = F.col("ds").between(F.lit(start), F.lit(end + dt.timedelta(days=k)))
    moves = _with_price_after(detail.where(days), k).select("code", "ds", F.round(growth, 2).alias("move"))
    gains, losses = F.count_if(F.col("move") > 0), F.count_if(F.col("move") < 0)
    return (
        held.join(moves, ["code", "ds"], "inner")
        .groupBy("event_type")
        .agg(F.sum("move").alias("bi"), F.try_divide(gains, gains + losses).alias("biamount"))
        .orderBy(F.desc("biamount"), "event_type")
    )


def _held_until_later(
    base: DataFrame,
    detail: DataFrame,
    first: dt.date,
    min_days: int,
    max_days: int | None,
    block_days: int,
) -> DataFrame:
    """Pair each base row, none before ``first``, with every later day of its code.

    Both sides have one row per (code, ds). The days are cut into blocks of
    ``block_days``, and the blocks of both days are join keys beside the code: a base row
    goes out once for each block from its own to the last it may be sold in, a later day
    once for each block it may have been bought in. So the pairs of one code are spread
    over as many tasks as it has pairs of blocks, none with more than block_days squared
    of them, while a row is copied once per block of days only. The last day that counts is
    a scalar subquery. ``max_days`` is an optional holding limit of the analysis and bounds
    the blocks, too.
    """
    later = _prices(detail).select(
        "code", F.col("ds").alias("sell_ds"), F.col("current_price").alias("sell_price")
    )
    block = lambda day: F.floor(day_number(day) / block_days).cast("int")
    until, since = detail.select(F.max("ds")).scalar(), F.lit(first)
    if max_days is not None:
        until = F.least(until, F.date_add("ds", max_days))
        since = F.greatest(since, F.date_sub("sell_ds", max_days))
    until = F.greatest(until, F.col("ds"))  # a base row after the last day has no pair
    bought = base.withColumns(
        {"_bought": block(F.col("ds")), "_sold": F.explode(F.sequence(block(F.col("ds")), block(until)))}
    )
    sold = later.withColumns(
        {
            "_sold": block(F.col("sell_ds")),
            "_bought": F.explode(F.sequence(block(since), block(F.col("sell_ds")))),
        }
    )
    held = F.datediff("sell_ds", "ds")
    paired = bought.join(sold, ["code", "_bought", "_sold"], "inner").where(held >= min_days)
    if max_days is not None:
        paired = paired.where(held <= max_days)
    return paired.withColumn("days_held", held).drop("_bought", "_sold")


def profit_bucket_holding(
    events: DataFrame,
    detail: DataFrame,
    since: dt.date,
    boards: Sequence[str] | None = None,
    max_days: int | None = None,
    snapshot: dt.date | None = None,
    block_days: int = BLOCK_DAYS,
) -> DataFrame:
    """How long a gain of n percent takes: all later days above the event-day price.

    Events of one (code, day) all yield the same pairs, so they are counted before
    the join and enter the average as a weight.
    """
    weighted = (
        events.where(on_day(F.col("dt"), snapshot) & (F.col("notice_date") >= F.lit(since)))
        .groupBy("code", F.col("notice_date").alias("ds"))
        .agg(F.count(F.lit(1)).alias("weight"))
    )
    bought = in_boards(F.col("board"), boards) & (F.col("ds") >= F.lit(since))
    base = _prices(detail.where(bought)).join(
        weighted, ["code", "ds"], "inner"
    )
    gain = F.try_divide(
        (F.col("sell_price") - F.col("current_price")) * 100, F.col("current_price")
    )
    days = F.sum(F.col("days_held") * F.col("weight")) / F.sum("weight")
    return (
        _held_until_later(base, detail.where(F.col("ds") >= F.lit(since)), since, 1, max_days, block_days)
        .where(F.col("sell_price") > F.col("current_price"))
        .groupBy(F.floor(gain).alias("cash"))
        .agg(F.max("code").alias("code"), days.alias("dif_day"))
        .select("code", "cash", "dif_day")
        .orderBy(F.desc("cash"))
    )


def financing_forward_return(
    finance: DataFrame,
    detail: DataFrame,
    since: dt.date,
    boards: Sequence[str] | None = None,
    min_days: int = 5,
    max_days: int | None = None,
    snapshot: dt.date | None = None,
    block_days: int = BLOCK_DAYS,
    ordered: bool = True,
) -> DataFrame:
    """Move from each financing row's day to every day at least ``min_days`` later.

    ``ffbi`` is the purchase in whole percent of the market value. The pairs are the
    result itself here; without ``ordered`` they stay where the join made them.
    """
    rows = finance.where(
        on_day(F.col("dt"), snapshot) & (F.col("notice_date") >= F.lit(since))
    ).select("code", F.col("notice_date").alias("ds"), "financing_purchase")
    base = _prices(
        detail.where(in_boards(F.col("board"), boards) & (F.col("ds") >= F.lit(since))), "total_market_v"
    ).join(rows, ["code", "ds"], "inner")
    price = F.col("current_price")
    later = detail.where(F.col("ds") >= F.lit(since))
    pairs = (
        _held_until_later(base, later, since, max(min_days, 1), max_days, block_days)
        .select(
            "code",
            F.try_divide((F.col("sell_price") - price) * 100, price).alias("cash_dif"),
            F.col("days_held").alias("dif"),
            F.col("sell_ds").alias("ds"),
            F.floor(
                F.try_divide(F.col("financing_purchase") * 100, F.col("total_market_v"))
            ).alias("ffbi"),
        )
    )
    return pairs.orderBy(F.desc("cash_dif"), "code", "ds", "dif") if ordered else pairs


def news_plus_k_pop(
    news: DataFrame,
    detail: DataFrame,
    k: int = 3,
    min_pct: float | int = 8,
    boards: Sequence[str] | None = None,
) -> DataFrame:
    """News whose stock stood at least ``min_pct`` percent higher ``k`` calendar days later."""
    pops = (
        _with_price_after(detail, k, "board")
        .where(in_boards(F.col("board"), boards))
        .select("code", "ds", pct_change(F.col("_later"), F.col("current_price")).alias("dif"))
        .where(F.col("dif") >= min_pct)
    )
    return (
        news.select("code", "title", "notice_date", F.to_date("notice_date").alias("ds"))
        .join(pops, ["code", "ds"], "inner")
        .select("code", "title", "notice_date", "dif")
        .orderBy(F.desc("dif"), "code", "notice_date", "title")
    )


def _next_day(
    news: DataFrame, detail: DataFrame, day: dt.date | None, gap: int, *columns: str
) -> DataFrame:
    """News joined to the move of its stock ``gap`` days after the news was loaded."""
    earlier = None if day is None else day - dt.timedelta(days=gap)
    moved = detail.where(on_day(F.col("dt"), day)).select("code", "dt", *columns)
    told = news.where(on_day(F.col("dt"), earlier)).select(
        "code", "title", "notice_date", F.date_add("dt", gap).alias("dt")
    )
    return told.join(moved, ["code", "dt"], "inner")


def _gap(day: dt.date | None, news_day: dt.date | None) -> int:
    return 1 if day is None or news_day is None else (day - news_day).days


def news_next_day_move(
    news: DataFrame,
    detail: DataFrame,
    day: dt.date | None = None,
    news_day: dt.date | None = None,
    cutoff: str = "15:00:00",
    boards: Sequence[str] | None = None,
) -> DataFrame:
    """Moves after news published at or after the close of the day before.

    With ``day`` for that day alone, without it for every day of the tables.
    """
    gap = _gap(day, news_day)
    hours, minutes, seconds = (int(p) for p in cutoff.split(":"))
    after = F.make_dt_interval(F.lit(0), F.lit(hours), F.lit(minutes), F.lit(seconds))
    closed = F.date_sub("dt", gap).cast("timestamp_ntz") + after
    return (
        _next_day(
            news, detail.where(in_boards(F.col("board"), boards)), day, gap, "up_down_rate"
        )
        .where(F.col("notice_date") >= closed)
        .select("dt", "code", "title", "notice_date", "up_down_rate")
        .orderBy(F.desc("up_down_rate"), "dt", "code", "notice_date", "title")
    )


def _traded(detail: DataFrame, boards: Sequence[str] | None) -> DataFrame:
    return detail.where(in_boards(F.col("board"), boards) & (F.col("current_price") > 0))


def news_next_day_ranked(
    detail: DataFrame,
    news: DataFrame,
    day: dt.date | None = None,
    news_day: dt.date | None = None,
    boards: Sequence[str] | None = None,
) -> DataFrame:
    """The day before's news with the day's move and turnover, best movers first."""
    joined = _next_day(
        news, _traded(detail, boards), day, _gap(day, news_day), "up_down_rate", "turnover_rate"
    )
    return joined.select(
        "dt", "title", "notice_date", "code", "up_down_rate", "turnover_rate"
    ).orderBy(F.desc("up_down_rate"), "dt", "code", "notice_date", "title")


def news_next_day_plain(
    detail: DataFrame,
    news: DataFrame,
    day: dt.date | None = None,
    news_day: dt.date | None = None,
    boards: Sequence[str] | None = None,
) -> DataFrame:
    """The day before's news with the day's move, unordered."""
    joined = _next_day(news, _traded(detail, boards), day, _gap(day, news_day), "up_down_rate")
    return joined.select("dt", "code", "notice_date", "title", "up_down_rate")
