"""Write jobs: each derives one table from others and fills one partition of it.

A table name is ``<database>.<table>``; the jobs create missing tables with the
declared column types (``sources.schemas``) and match columns by name.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame

from tickloom.operators import indicators, patterns, series, streaks
from tickloom.sources import schemas, warehouse
from tickloom.sources.warehouse import CURRENT


def _typed(df: DataFrame, table: str) -> DataFrame:
    return schemas.conform(df, schemas.struct(schemas.DERIVED[table]))


def fill_history(detail: DataFrame, table: str, as_of: dt.date | None = None) -> None:
    """Add a day's rows (or all days') to the partitioned history; a rerun replaces them."""
    warehouse.overwrite_dynamic(series.daily_append(detail, as_of), table)


def fill_bars(history: DataFrame, table: str, buckets: int = 64) -> None:
    """The latest load of every (code, ds), clustered by code and sorted by day.

    Indicators, streaks and patterns over ``warehouse.scan(spark, table)`` plan no exchange.
    """
    warehouse.load_clustered(series.latest_per_day(history), table, buckets, "ds")


def rebuild_snapshot(
    history: DataFrame, detail: DataFrame, table: str, day: dt.date, prev: dt.date
) -> None:
    """Make up for a missing daily snapshot; a rerun replaces it."""
    warehouse.overwrite_partition(series.carry_forward(history, detail, day, prev), table, day)


def fill_step_one(history: DataFrame, table: str, day: dt.date) -> None:
    rows = _typed(indicators.stock_step_one(history), "ods_stock_step_one")
    warehouse.overwrite_partition(rows, table, day, rebalanced=False)


def fill_price_streaks(
    detail: DataFrame,
    calendar: DataFrame,
    table: str,
    as_of: dt.date,
    boards: Sequence[str] | None = None,
) -> None:
    """Replace the current streaks; a day without any leaves the partition empty."""
    rows = streaks.price_streaks(detail, calendar, as_of, boards=boards)
    warehouse.overwrite_partition(_typed(rows, "dwd_stock_continuation_up"), table, CURRENT)


def fill_balance_streaks(
    finance: DataFrame,
    detail: DataFrame,
    table: str,
    as_of: dt.date,
    boards: Sequence[str] | None = None,
) -> None:
    rows = streaks.balance_streaks(finance, detail, as_of, boards=boards)
    warehouse.overwrite_partition(_typed(rows, "dwd_finance_continuation_up"), table, CURRENT)


def fill_price_series(history: DataFrame, detail: DataFrame, table: str, day: dt.date) -> None:
    rows = _typed(series.price_series(history, detail), "ods_up_to_stop")
    warehouse.overwrite_partition(rows, table, day)


def fill_return_series(
    history: DataFrame,
    detail: DataFrame,
    table: str,
    boards: Sequence[str] | None,
    min_year: int | None = None,
    board_dt: dt.date | None = None,
) -> None:
    rows = series.return_series(history, detail, boards, min_year, board_dt)
    warehouse.overwrite_partition(_typed(rows, "dwd_temp"), table, CURRENT)


def fill_klines(
    series_rows: DataFrame, table: str, day: dt.date, width: int = 7, token: str = "sign",
    sep: str = ","
) -> None:
    """Replace a day's pattern strings; readers must split with the same ``sep``."""
    rows = patterns.kline_strings_short(series_rows, width, token, sep)
    warehouse.overwrite_partition(_typed(rows, "dwd_training_data"), table, day)


def fill_weekly_training(
    rates: DataFrame,
    calendar: DataFrame,
    table: str,
    since: dt.date | None = None,
    export_to: str | None = None,
) -> None:
    """Replace the weekly training set and, on request, export it as CSV."""
    rows = _typed(patterns.weekly_training(rates, calendar, since), "dwd_train")
    warehouse.overwrite_partition(rows, table, CURRENT)
    if export_to is not None:
        spark = rates.sparkSession
        warehouse.export_csv(warehouse.scan(spark, table, CURRENT).drop("dt"), export_to)
