"""Query registry: every operator over the whole supplied tables.

Day parameters are left open wherever the operator has an every-day form, so a
query joins or aggregates all days at once. ``shape`` only fixes output types.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.operators import (
    calendar,
    flow,
    indicators,
    patterns,
    returns,
    scans,
    screens,
    series,
    streaks,
)
from tickloom.plans import jobs
from tickloom.plans.market import AS_OF, BOARDS, HISTORY_DT, Market
from tickloom.sources import landing, warehouse
from tickloom.sources.schemas import RAW

Query = Callable[[SparkSession, str], DataFrame]

S, L, D, TS, M = "string", "bigint", "date", "timestamp_ntz", "decimal(18,2)"
R2, R6 = "rate", "ratio"

SINCE = dt.date(2024, 1, 1)
MID = dt.date(2024, 1, 15)


def shape(df: DataFrame, **types: str) -> DataFrame:
    """Cast to comparison types: money stays decimal, rates and ratios become doubles."""
    form = {R2: "cast({0} as double)", R6: "cast(round({0}, 6) as double)"}
    return df.selectExpr(
        *[
            form.get(kind, f"cast({{0}} as {kind})").format(f"`{name}`") + f" as `{name}`"
            for name, kind in types.items()
        ]
    )


_QUERIES: dict[str, Query] = {}


def query(fn: Callable[[Market], DataFrame]) -> Callable[[Market], DataFrame]:
    _QUERIES[fn.__name__] = lambda spark, folder: fn(Market(spark, folder))
    return fn


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


# --- ingest and curate --------------------------------------------------------


def _database(m: Market) -> str:
    location = warehouse.shared_dir(m.spark, "warehouse")
    name = "tickloom_" + location.rsplit("-", 1)[-1]
    warehouse.create_database(m.spark, name, location)
    return name


FINANCE_COLUMNS = {
    "code": S,
    "financing_purchase": M,
    "financing_repay": M,
    "financing_balance": M,
    "notice_date": D,
    "dt": D,
}


@query
def load_partition(m: Market) -> DataFrame:
    drop = warehouse.shared_dir(m.spark, "drop")
    m.finance_text.write.options(sep="\t", compression="gzip", nullValue="\\N").csv(drop)
    table = f"{_database(m)}.ods_a_stock_finance_info"
    landing.load_partition(m.spark, drop, "ods_a_stock_finance_info", AS_OF, table)
    return shape(warehouse.scan(m.spark, table, AS_OF), **FINANCE_COLUMNS)


@query
def load_dated_drops(m: Market) -> DataFrame:
    drop = warehouse.shared_dir(m.spark, "drops")
    raw = m.finance_text.withColumn("day", F.col("notice_date"))
    raw.hint("rebalance", "day").write.partitionBy("day").options(sep="\t").csv(drop)
    table = f"{_database(m)}.ods_a_stock_finance_info"
    landing.load_dated_drops(m.spark, drop, "ods_a_stock_finance_info", table)
    return shape(warehouse.scan(m.spark, table), **FINANCE_COLUMNS)


def _landed(m: Market, table: str) -> tuple[str, DataFrame]:
    """One raw table landed from its drops: the target's name and the lines by outcome."""
    root = warehouse.shared_dir(m.spark, "drops")
    lines = m.raw_lines()[table].hint("rebalance", "day")
    lines.write.partitionBy("day").option("compression", "gzip").text(root)
    target = f"{_database(m)}.{table}"
    return target, landing.land(m.spark, root, table, target)


@query
def land_all_tables(m: Market) -> DataFrame:
    """Every raw table landed from drops with bad lines: lines by outcome, and rows stored."""
    rows = []
    for table in RAW:
        target, counts = _landed(m, table)
        stored = m.spark.table(target).agg(F.count(F.lit(1)).alias("stored"))
        kept = m.spark.table(f"{target}_rejects").groupBy("reason").agg(F.count(F.lit(1)).alias("stored"))
        by_reason = counts.groupBy("source", "reason").agg(F.sum("lines").alias("lines"))
        found = stored.select(F.lit(None).cast("string").alias("reason"), "stored").unionByName(kept)
        rows.append(by_reason.join(found.withColumnRenamed("reason", "why"), F.col("reason").eqNullSafe(F.col("why"))))
    return shape(reduce(DataFrame.unionByName, rows), source=S, reason=S, lines=L, stored=L)


@query
def landed_detail(m: Market) -> DataFrame:
    """The daily details as landed: good lines, typed."""
    target, _ = _landed(m, "ods_a_stock_detail_day")
    return shape(
        warehouse.scan(m.spark, target), code=S, name=S, current_price=M, up_down_rate=R2,
        turnover_rate=M, highest=M, lowest=M, volume=L, amount=M, main_inflow=M, ds=D, board=S, dt=D,
    )


@query
def landed_news_rejects(m: Market) -> DataFrame:
    target, _ = _landed(m, "ods_a_stock_news")
    return shape(m.spark.table(f"{target}_rejects"), reason=S, line=S, dt=D)


HISTORY_COLUMNS = {
    "code": S,
    "up_down_rate": R2,
    "closing_price": M,
    "volume": L,
    "amount": M,
    "year": L,
    "month_day": S,
    "dt": D,
}


@query
def history_repartition(m: Market) -> DataFrame:
    """The daily rows laid out by day, in history layout."""
    table = f"{_database(m)}.ods_a_stock_history_list"
    warehouse.repartition_history(series.daily_append(m.detail), table, "dt")
    return shape(warehouse.scan(m.spark, table), **HISTORY_COLUMNS)


@query
def history_repartition_bulk(m: Market) -> DataFrame:
    """The bulk history laid out by month, twice: a rerun doubles nothing."""
    table = f"{_database(m)}.ods_a_stock_history_list"
    bulk = m.history.drop("dt", "name")
    for _ in range(2):
        warehouse.repartition_history(bulk, table, unit="month")
    return shape(
        warehouse.scan(m.spark, table), ds=D, opening_price=M, highest=M, lowest=M, **HISTORY_COLUMNS
    )


@query
def fill_history(m: Market) -> DataFrame:
    """All days of the details appended to the history, then one of them once more."""
    table = f"{_database(m)}.ods_a_stock_history_list"
    jobs.fill_history(m.detail, table)
    jobs.fill_history(m.detail, table, MID)
    return shape(warehouse.scan(m.spark, table), dk_total=L, opening_price=M, **HISTORY_COLUMNS)


@query
def snapshot_carry_forward(m: Market) -> DataFrame:
    history = m.detail.withColumnRenamed("current_price", "closing_price").select(
        "code", "dt", "name", "up_down_rate", "highest", "lowest", "opening_price",
        "closing_price", "volume", "amount",
    )
    return shape(
        series.carry_forward(history, m.detail),
        code=S, ds=D, current_price=M, t_1_price=M, up_down_rate=R2, highest=M, lowest=M,
        volume=L, amount=M, total_market_v=M, main_inflow=M, board=S, dt=D,
    )


@query
def daily_append(m: Market) -> DataFrame:
    return shape(series.daily_append(m.detail), dk_total=L, opening_price=M, **HISTORY_COLUMNS)


@query
def price_series_union(m: Market) -> DataFrame:
    return shape(
        series.price_series(m.history, m.detail),
        code=S, up_down_rate=R2, opening_price=M, closing_price=M, ds=D, rk=L,
    )


def _series(m: Market) -> DataFrame:
    return series.return_series(m.history, m.detail, None)


@query
def return_series(m: Market) -> DataFrame:
    rows = series.return_series(m.history, m.detail, BOARDS, min_year=1996, board_dt=AS_OF)
    return shape(rows, code=S, up_down_rate=R2, ds=D, rk=L)


@query
def return_series_all_boards(m: Market) -> DataFrame:
    return shape(_series(m), code=S, up_down_rate=R2, ds=D, rk=L)


@query
def series_length(m: Market) -> DataFrame:
    return shape(series.series_length(_series(m)), code=S, length=L)


@query
def export_csv(m: Market) -> DataFrame:
    path = warehouse.shared_dir(m.spark, "export")
    weekly = _weekly(m).select("ups", "monday_result", "week_result")
    warehouse.export_csv(weekly, path)
    back = m.spark.read.schema("ups string, monday_result double, week_result double").csv(
        path, header=True
    )
    return shape(back, ups=S, monday_result=R2, week_result=R2)


# --- partition maintenance ----------------------------------------------------


@query
def overwrite_partition(m: Market) -> DataFrame:
    """Fill two partitions, then replace the current one."""
    table = f"{_database(m)}.dwd_finance_continuation_up"
    rows = m.finance.select("code", "notice_date", "financing_balance")
    warehouse.overwrite_partition(rows, table, AS_OF)
    warehouse.overwrite_partition(rows, table)
    warehouse.overwrite_partition(rows.where(F.col("financing_balance") > 100), table)
    return shape(
        warehouse.scan(m.spark, table), code=S, notice_date=D, financing_balance=M, dt=D
    )


@query
def drop_partitions(m: Market) -> DataFrame:
    """Drop a closed range of days and one single day."""
    table = f"{_database(m)}.ods_a_stock_finance_info"
    warehouse.append_dynamic(m.finance, table)
    warehouse.drop_partitions(
        m.spark, table, first=dt.date(2024, 1, 8), last=dt.date(2024, 1, 21)
    )
    warehouse.drop_partitions(m.spark, table, exact=dt.date(2024, 1, 25))
    return shape(warehouse.scan(m.spark, table), **FINANCE_COLUMNS)


CALENDAR_COLUMNS = {
    "ds": D,
    "weekday": L,
    "weekofyear": L,
    "chinesezodiac": S,
    "astatus": L,
    "hkstatus": L,
    "usastatus": L,
}


@query
def truncate_reload(m: Market) -> DataFrame:
    table = f"{_database(m)}.ods_calendar"
    warehouse.truncate_reload(m.calendar.where(F.col("astatus") == 1), table)
    warehouse.truncate_reload(m.calendar, table)
    return shape(m.spark.table(table), **CALENDAR_COLUMNS)


# --- technical indicators -----------------------------------------------------


@query
def prev_close_diff(m: Market) -> DataFrame:
    return shape(
        indicators.prev_close_diff(m.history),
        code=S, ds=D, closing_price=M, last_closing=M, closing_diff=M,
    )


@query
def hhv_llv(m: Market) -> DataFrame:
    return shape(indicators.hhv_llv(m.history), code=S, ds=D, hhv=M, llv=M)


@query
def rsv(m: Market) -> DataFrame:
    return shape(indicators.rsv(m.history), code=S, ds=D, rsv=R6)


@query
def sar_bounds(m: Market) -> DataFrame:
    return shape(indicators.sar_bounds(m.history), code=S, ds=D, sar_high=M, sar_low=M)


@query
def true_range(m: Market) -> DataFrame:
    return shape(indicators.true_range(m.history), code=S, ds=D, tr=M)


@query
def directional_move(m: Market) -> DataFrame:
    return shape(indicators.directional_move(m.history), code=S, ds=D, dmp=M, dmm=M)


@query
def latest_loads(m: Market) -> DataFrame:
    """Three overlapping loads of the bars, reduced to the latest row of each day."""
    return shape(
        series.latest_per_day(m.history_loads.drop("name")),
        code=S, ds=D, opening_price=M, closing_price=M, highest=M, lowest=M, dt=D,
    )


@query
def true_range_of_loads(m: Market) -> DataFrame:
    return shape(indicators.true_range(m.history_loads), code=S, ds=D, tr=M)


@query
def price_streaks_of_loads(m: Market) -> DataFrame:
    loads = m.history_loads.withColumnRenamed("closing_price", "current_price")
    rows = streaks.price_streaks(loads, m.calendar, None, lookback=None)
    return shape(rows, **STREAK)


STEP_COLUMNS = {
    "code": S, "name": S, "closing_price": M, "last_closing": M, "highest": M, "lowest": M,
    "ds": D, "deal_amount": M, "closing_diff": M, "rk": L, "x": M, "i": M, "rsv": R6,
    "sar_high": M, "sar_low": M, "tr": M, "dmp": M, "dmm": M,
}


@query
def stock_step_one(m: Market) -> DataFrame:
    return shape(indicators.stock_step_one(m.history), **STEP_COLUMNS)


@query
def stock_step_one_of_bars(m: Market) -> DataFrame:
    """The indicators over the stored bars table, which needs no exchange."""
    table = f"{_database(m)}.dwd_bars"
    jobs.fill_bars(m.history_loads, table, buckets=8)
    return shape(indicators.stock_step_one(warehouse.scan(m.spark, table)), **STEP_COLUMNS)


@query
def stock_step_one_table(m: Market) -> DataFrame:
    """The indicator table written to a partition and read back."""
    table = f"{_database(m)}.ods_stock_step_one"
    jobs.fill_step_one(m.history, table, HISTORY_DT)
    return shape(warehouse.scan(m.spark, table, HISTORY_DT), **STEP_COLUMNS, dt=D)


# --- streaks ------------------------------------------------------------------

STREAK = {"code": S, "times": L, "sumrate": R2, "tag": L}
BALANCE = {"code": S, "times": L, "sumprice": M, "tag": L}


@query
def calendar_rank(m: Market) -> DataFrame:
    return shape(calendar.calendar_rank(m.calendar), ds=D, rk=L)


@query
def price_streak_up(m: Market) -> DataFrame:
    return shape(
        streaks.price_streak_up(m.detail, m.calendar, AS_OF, boards=BOARDS), **STREAK
    )


@query
def price_streak_down(m: Market) -> DataFrame:
    return shape(
        streaks.price_streak_down(m.detail, m.calendar, AS_OF, boards=BOARDS), **STREAK
    )


@query
def price_streaks(m: Market) -> DataFrame:
    return shape(streaks.price_streaks(m.detail, m.calendar, AS_OF), **STREAK)


@query
def price_streaks_history(m: Market) -> DataFrame:
    """Every run of the long bars, alive or not."""
    return shape(
        streaks.price_streaks(m.long_detail, m.calendar, None, lookback=None), **STREAK
    )


@query
def price_streaks_table(m: Market) -> DataFrame:
    table = f"{_database(m)}.dwd_stock_continuation_up"
    jobs.fill_price_streaks(m.detail, m.calendar, table, AS_OF)
    return shape(warehouse.scan(m.spark, table), **STREAK, dt=D)


@query
def balance_streak_up(m: Market) -> DataFrame:
    return shape(
        streaks.balance_streak_up(m.finance, m.detail, AS_OF, boards=BOARDS), **BALANCE
    )


@query
def balance_streak_down(m: Market) -> DataFrame:
    return shape(
        streaks.balance_streak_down(m.finance, m.detail, AS_OF, boards=BOARDS), **BALANCE
    )


@query
def balance_streaks(m: Market) -> DataFrame:
    return shape(streaks.balance_streaks(m.finance, m.detail, AS_OF), **BALANCE)


@query
def balance_streaks_history(m: Market) -> DataFrame:
    return shape(
        streaks.balance_streaks(m.finance, m.detail, None, lookback=None), **BALANCE
    )


@query
def daily_growth_islands(m: Market) -> DataFrame:
    return shape(
        streaks.daily_growth_islands(m.finance), code=S, notice_date=D, pre=M, rk=L, num=L
    )


@query
def growth_screen(m: Market) -> DataFrame:
    rows = streaks.growth_screen(
        m.detail, m.finance, m.news,
        on_date=dt.date(2024, 1, 29), exists_dt=dt.date(2024, 1, 26),
        islands_date=dt.date(2024, 1, 26),
        news_dts=[dt.date(2024, 1, 26), dt.date(2024, 1, 28)],
    )
    return shape(rows, code=S, up_down_rate=R2, turnover_rate=M, title=S)


@query
def growth_screen_days(m: Market) -> DataFrame:
    rows = streaks.growth_screen_days(m.detail, m.finance, m.news, m.calendar)
    return shape(rows, dt=D, code=S, up_down_rate=R2, turnover_rate=M, title=S)


@query
def ranked_trading_rows(m: Market) -> DataFrame:
    return shape(
        streaks.ranked_trading_rows(m.long_detail, m.calendar),
        code=S, ds=D, current_price=M, up_down_rate=R2, turnover_rate=M, rk=L,
    )


# --- event studies ------------------------------------------------------------


@query
def event_to_date_return(m: Market) -> DataFrame:
    rows = returns.event_to_date_return(m.company_events, m.calendar, m.detail, SINCE, AS_OF)
    return shape(rows, code=S, event_type=S, specific_eventtype=S, upordown=S)


@query
def event_type_return(m: Market) -> DataFrame:
    rows = returns.event_type_return(m.company_events, m.detail, None, AS_OF)
    return shape(rows, ds=D, event_type=S, up2down=R2)


@query
def hold_k_win_rate(m: Market) -> DataFrame:
    rows = returns.hold_k_win_rate(m.company_events, m.calendar, m.detail, SINCE, AS_OF)
    return shape(rows, event_type=S, bi=R2, biamount=R6)


@query
def profit_bucket_holding(m: Market) -> DataFrame:
    rows = returns.profit_bucket_holding(m.company_events, m.detail, SINCE)
    return shape(rows, code=S, cash=L, dif_day=R6)


@query
def financing_forward_return(m: Market) -> DataFrame:
    rows = returns.financing_forward_return(m.finance, m.detail, SINCE)
    return shape(rows, code=S, cash_dif=R6, dif=L, ds=D, ffbi=L)


@query
def profit_bucket_holding_long(m: Market) -> DataFrame:
    """Bars of seven years bought on the days they rose, sold within a year."""
    bought = m.history.where("closing_price > opening_price").select(
        "code", F.col("ds").alias("notice_date"), "dt"
    )
    rows = returns.profit_bucket_holding(bought, m.long_detail, dt.date(1992, 1, 1), max_days=365)
    return shape(rows, code=S, cash=L, dif_day=R6)


@query
def news_plus_k_pop(m: Market) -> DataFrame:
    rows = returns.news_plus_k_pop(m.news, m.detail, boards=BOARDS)
    return shape(rows, code=S, title=S, notice_date=TS, dif=R2)


@query
def news_next_day_move(m: Market) -> DataFrame:
    rows = returns.news_next_day_move(m.news, m.detail)
    return shape(rows, dt=D, code=S, title=S, notice_date=TS, up_down_rate=R2)


@query
def news_next_day_ranked(m: Market) -> DataFrame:
    rows = returns.news_next_day_ranked(m.detail, m.news, boards=BOARDS)
    return shape(
        rows, dt=D, title=S, notice_date=TS, code=S, up_down_rate=R2, turnover_rate=M
    )


@query
def news_next_day_plain(m: Market) -> DataFrame:
    rows = returns.news_next_day_plain(m.detail, m.news)
    return shape(rows, dt=D, code=S, notice_date=TS, title=S, up_down_rate=R2)


# --- screens ------------------------------------------------------------------


@query
def gainers(m: Market) -> DataFrame:
    rows = screens.gainers(m.detail, columns=["name", "main_inflow", "large_inflow", "mid_inflow"])
    return shape(
        rows, dt=D, code=S, name=S, up_down_rate=R2, main_inflow=M, large_inflow=M, mid_inflow=M
    )


DETAIL_COLUMNS = {
    "code": S, "ds": D, "dt": D, "name": S, "board": S, "opening_price": M, "current_price": M,
    "highest": M, "lowest": M, "up_down_rate": R2, "turnover_rate": M, "amount": M,
    "main_inflow": M, "slarge_inflow": M, "large_inflow": M, "mid_inflow": M, "small_inflow": M,
}


@query
def board_ranking(m: Market) -> DataFrame:
    return shape(screens.board_ranking(m.detail, boards=BOARDS), **DETAIL_COLUMNS)


@query
def financing_news_panel(m: Market) -> DataFrame:
    rows = screens.financing_news_panel(m.finance, m.detail, m.news)
    return shape(
        rows, code=S, financing_purchase=M, financing_repay=M, financing_balance=M,
        up_down_rate=R2, total_market_v=M, circulation_market_v=M, tradable_shares=L,
        title=S, ds=D,
    )


@query
def mover_news_report(m: Market) -> DataFrame:
    rows = screens.mover_news_report(m.detail, m.news, m.report, boards=BOARDS)
    return shape(
        rows, dt=D, code=S, up_down_rate=R2, title=S, operate_profit_yoy=R2,
        total_current_assets_yoy=R2, turnover_rate=M,
    )


@query
def strong_mover_report(m: Market) -> DataFrame:
    rows = screens.strong_mover_report(m.detail, m.news, m.report)
    return shape(
        rows, dt=D, code=S, up_down_rate=R2, title=S, monetary_funds_yoy=R2,
        total_operate_income_yoy=R2, netcash_operate_yoy=R2,
    )


@query
def news_of_movers(m: Market) -> DataFrame:
    rows = screens.news_of_movers(m.news, m.detail)
    return shape(
        rows, code=S, medianame=S, title=S, notice_date=TS, dt=D, up_down_rate=R2
    )


@query
def movers_with_news(m: Market) -> DataFrame:
    return shape(screens.movers_with_news(m.news, m.detail), dt=D, code=S, title=S)


NET = {"dt": D, "code": S, "up_down_rate": R2, "title": S, "dif": M}


@query
def net_financing_news(m: Market) -> DataFrame:
    return shape(screens.net_financing_news(m.detail, m.finance, m.news), **NET)


@query
def net_financing_untitled(m: Market) -> DataFrame:
    return shape(
        screens.net_financing_news(m.detail, m.finance, m.news, title="null"), **NET
    )


@query
def full_join_news_financing(m: Market) -> DataFrame:
    rows = screens.full_join_news_financing(
        m.news, m.finance, m.detail, dt.datetime(2024, 1, 15, 15), MID, dt.date(2024, 1, 16)
    )
    return shape(rows, code=S, title=S, dif=M, up_down_rate=R2)


@query
def news_financing_days(m: Market) -> DataFrame:
    rows = screens.news_financing_days(m.news, m.finance, m.detail, m.calendar)
    return shape(rows, dt=D, code=S, title=S, dif=M, up_down_rate=R2)


@query
def score_ranking(m: Market) -> DataFrame:
    rows = screens.score_ranking(m.chance)
    return shape(rows, code=S, total_score=M, stock_rank_ratio=M, notice_date=D, dt=D)


# --- money flow and ticks -----------------------------------------------------


@query
def side_pivot(m: Market) -> DataFrame:
    return shape(
        flow.side_pivot(m.deal), code=S, buy1=L, sell1=L, buy2=L, sell2=L, buy3=M, sell3=M
    )


@query
def side_amount(m: Market) -> DataFrame:
    return shape(flow.side_amount(m.deal), code=S, buy=M, sale=M, gua=M)


@query
def lot_histogram(m: Market) -> DataFrame:
    return shape(flow.lot_histogram(m.deal), bucket=L, cnt=L)


@query
def flow_total(m: Market) -> DataFrame:
    return shape(flow.flow_total(m.detail), code=S, dt=D, total_inflow=M)


@query
def flow_share(m: Market) -> DataFrame:
    return shape(
        flow.flow_share(m.detail), ds=D, code=S, main=R6, slarge=R6, large=R6, mid=R6, small=R6,
        up_down_rate=R2,
    )


@query
def big_small_flow(m: Market) -> DataFrame:
    return shape(flow.big_small_flow(m.detail), code=S, big=M, small=M)


@query
def flow_projection(m: Market) -> DataFrame:
    return shape(
        flow.flow_projection(m.detail, boards=BOARDS), code=S, dt=D, main_inflow=M,
        slarge_inflow=M, large_inflow=M, mid_inflow=M, small_inflow=M,
    )


# --- patterns -----------------------------------------------------------------


@query
def window_rows(m: Market) -> DataFrame:
    return shape(patterns.window_rows(_series(m)), code=S, g=L, up_down_rate=R2, rk=L)


@query
def kline_strings(m: Market) -> DataFrame:
    return shape(patterns.kline_strings(_series(m)), code=S, tags=L, kline=S, nos=S)


CUT = dt.date(1998, 6, 1)


@query
def kline_strings_since(m: Market) -> DataFrame:
    """Full windows of a series that is cut before the windows are formed."""
    return shape(
        patterns.kline_strings(_series(m), since=CUT), code=S, tags=L, kline=S, nos=S
    )


@query
def kline_strings_short(m: Market) -> DataFrame:
    return shape(patterns.kline_strings_short(_series(m)), code=S, tags=L, kline=S)


@query
def kline_strings_cut(m: Market) -> DataFrame:
    """13-row windows that hold only 12 rows: those that reach over the cut by one."""
    return shape(
        patterns.kline_strings_short(_series(m), width=13, since=CUT, count=12),
        code=S, tags=L, kline=S,
    )


@query
def kline_signs(m: Market) -> DataFrame:
    return shape(patterns.kline_signs(_series(m)), code=S, tags=L, kline=S)


@query
def pattern_frequency(m: Market) -> DataFrame:
    signs = patterns.kline_strings_short(_series(m), 13, "sign", "|")
    return shape(patterns.pattern_frequency(signs), pattern=S, num=L)


@query
def pattern_up_ratio(m: Market) -> DataFrame:
    signs = patterns.kline_signs(_series(m), width=8)
    return shape(patterns.pattern_up_ratio(signs), stock=S, up=L, down=L, ratio=R2)


@query
def pattern_frequency_of(m: Market) -> DataFrame:
    """Rounded returns: twelve days and how often a rise followed."""
    return shape(patterns.pattern_frequency_of(_series(m)), pattern=S, num=L)


@query
def pattern_frequency_of_four(m: Market) -> DataFrame:
    return shape(patterns.pattern_frequency_of(_series(m), 5, 4), pattern=S, num=L)


@query
def pattern_up_ratio_of(m: Market) -> DataFrame:
    return shape(patterns.pattern_up_ratio_of(_series(m)), stock=S, up=L, down=L, ratio=R2)


def _weekly(m: Market) -> DataFrame:
    rates = series.stitched_returns(
        m.history, m.detail, None, restrict_detail_to_snapshot=True
    )
    return patterns.weekly_training(rates, m.calendar)


@query
def weekly_training(m: Market) -> DataFrame:
    return shape(
        _weekly(m), code=S, year=L, weekofyear=L, ups=S, monday_result=R2, week_result=R2
    )


@query
def weekly_training_boards(m: Market) -> DataFrame:
    """The weeks of the codes that one day's snapshot lists on the chosen boards."""
    rates = series.stitched_returns(
        m.history, m.detail, BOARDS, board_dt=AS_OF, restrict_detail_to_snapshot=True
    )
    return shape(
        patterns.weekly_training(rates, m.calendar),
        code=S, year=L, weekofyear=L, ups=S, monday_result=R2, week_result=R2,
    )


# --- derived tables, each filled by its job and read back ----------------------


@query
def balance_streaks_table(m: Market) -> DataFrame:
    table = f"{_database(m)}.dwd_finance_continuation_up"
    for _ in range(2):  # a rerun replaces the current partition
        jobs.fill_balance_streaks(m.finance, m.detail, table, AS_OF)
    return shape(warehouse.scan(m.spark, table), **BALANCE, dt=D)


@query
def price_series_table(m: Market) -> DataFrame:
    table = f"{_database(m)}.ods_up_to_stop"
    jobs.fill_price_series(m.history, m.detail, table, AS_OF)
    return shape(
        warehouse.scan(m.spark, table, AS_OF),
        code=S, up_down_rate=R2, opening_price=M, closing_price=M, ds=D, rk=L, dt=D,
    )


@query
def training_tables(m: Market) -> DataFrame:
    """The training chain: the return series stored, its sign windows stored from it."""
    name = _database(m)
    jobs.fill_return_series(m.history, m.detail, f"{name}.dwd_temp", None)
    stored = warehouse.scan(m.spark, f"{name}.dwd_temp", warehouse.CURRENT)
    jobs.fill_klines(stored, f"{name}.dwd_training_data", AS_OF)
    return shape(
        warehouse.scan(m.spark, f"{name}.dwd_training_data"), code=S, tags=L, kline=S, dt=D
    )


@query
def return_series_table(m: Market) -> DataFrame:
    table = f"{_database(m)}.dwd_temp"
    jobs.fill_return_series(m.history, m.detail, table, BOARDS, min_year=1996, board_dt=AS_OF)
    return shape(warehouse.scan(m.spark, table), code=S, up_down_rate=R2, ds=D, rk=L, dt=D)


@query
def weekly_training_table(m: Market) -> DataFrame:
    table = f"{_database(m)}.dwd_train"
    rates = series.stitched_returns(m.history, m.detail, None, restrict_detail_to_snapshot=True)
    jobs.fill_weekly_training(rates, m.calendar, table)
    return shape(warehouse.scan(m.spark, table), ups=S, monday_result=R2, week_result=R2, dt=D)


@query
def rebuild_snapshots(m: Market) -> DataFrame:
    """Two missing snapshots made up for from the day's bars and the day before, one twice."""
    table = f"{_database(m)}.ods_a_stock_detail_day"
    bars = m.detail.withColumnRenamed("current_price", "closing_price").select(
        "code", "dt", "name", "up_down_rate", "highest", "lowest", "opening_price",
        "closing_price", "volume", "amount",
    )
    for day in (MID, MID, AS_OF):
        jobs.rebuild_snapshot(bars, m.detail, table, day, day - dt.timedelta(days=1))
    return shape(
        warehouse.scan(m.spark, table),
        code=S, ds=D, current_price=M, t_1_price=M, up_down_rate=R2, total_market_v=M, board=S, dt=D,
    )


# --- scans and counts ---------------------------------------------------------


@query
def row_count(m: Market) -> DataFrame:
    return shape(scans.row_count(m.history), cnt=L)


@query
def traded_count(m: Market) -> DataFrame:
    return shape(scans.traded_count(m.detail, MID), cnt=L)


@query
def group_flags(m: Market) -> DataFrame:
    return shape(scans.group_flags(m.calendar), chinesezodiac=S, cnt=L, usa=L, hk=L, a=L)


@query
def year_filter(m: Market) -> DataFrame:
    return shape(scans.year_filter(m.calendar, 1998), **CALENDAR_COLUMNS)


@query
def partition_scan(m: Market) -> DataFrame:
    return shape(scans.partition_scan(m.detail, MID), **DETAIL_COLUMNS)


@query
def code_lookup(m: Market) -> DataFrame:
    """News of the codes listed on one board."""
    watchlist = series.board_codes(m.detail, BOARDS[:1], None)
    return shape(
        scans.code_lookup(m.news, watchlist), code=S, medianame=S, title=S, notice_date=TS, dt=D
    )


@query
def code_lookup_one(m: Market) -> DataFrame:
    """News of one code from a table clustered by code: one bucket is read."""
    table = f"{_database(m)}.news_by_code"
    warehouse.load_clustered(m.news, table, buckets=8)
    return shape(
        scans.code_lookup(warehouse.scan(m.spark, table), "7"),
        code=S, medianame=S, title=S, notice_date=TS, dt=D,
    )


@query
def preview(m: Market) -> DataFrame:
    rows = scans.preview(m.finance, 100, ["notice_date", "code"])
    return shape(rows, **FINANCE_COLUMNS)


@query
def table_scan(m: Market) -> DataFrame:
    return shape(
        scans.table_scan(m.company_events), code=S, event_type=S, specific_eventtype=S,
        notice_date=D, dt=D,
    )
