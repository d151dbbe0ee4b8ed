"""Trading calendar: open days and their consecutive numbers."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def open_days(
    calendar: DataFrame, since: dt.date | None = None, status: str = "astatus"
) -> DataFrame:
    """Distinct days on which the market is open."""
    rows = calendar.where(F.col(status) == 1)
    if since is not None:
        rows = rows.where(F.col("ds") >= F.lit(since))
    return rows.select("ds").distinct()


def calendar_rank(
    calendar: DataFrame, since: dt.date | None = None, status: str = "astatus"
) -> DataFrame:
    """Consecutive number of each open day.

    The unpartitioned window is safe here: ``open_days`` is distinct on the date, so
    there is at most one row per calendar day (about 260 a year), whatever the data.
    """
    return open_days(calendar, since, status).withColumn(
        "rk", F.row_number().over(Window.orderBy("ds"))
    )


def open_day_map(calendar: DataFrame, status: str = "astatus") -> DataFrame:
    """For every calendar day the open day it belongs to and the open days around it.

    ``open_day`` is the day itself if it is open, else the one before; ``prev_open`` and
    ``next_open`` are the nearest open days strictly before and after. NULL at the ends of
    the calendar. One row per date, so the unpartitioned windows stay as small as there.
    """
    days = calendar.groupBy("ds").agg(F.max(F.when(F.col(status) == 1, F.col("ds"))).alias("_open"))
    order = Window.orderBy("ds")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(1, Window.unboundedFollowing)
    return days.select(
        "ds",
        F.last("_open", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0)).alias("open_day"),
        F.max("_open").over(before).alias("prev_open"),
        F.min("_open").over(after).alias("next_open"),
    )
