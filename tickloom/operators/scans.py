"""Counts, lookups and partition scans."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("cnt"))


def traded_count(detail: DataFrame, day: dt.date) -> DataFrame:
    """Rows of a day with a price."""
    return row_count(detail.where((F.col("dt") == F.lit(day)) & (F.col("current_price") != 0)))


def group_flags(calendar: DataFrame) -> DataFrame:
    """Days and open days of the three markets per zodiac year."""
    return calendar.groupBy("chinesezodiac").agg(
        F.count(F.lit(1)).alias("cnt"),
        F.sum("usastatus").alias("usa"),
        F.sum("hkstatus").alias("hk"),
        F.sum("astatus").alias("a"),
    )


def year_filter(calendar: DataFrame, year: int) -> DataFrame:
    """Days of one year, as a closed range so that it can prune files."""
    first, last = dt.date(year, 1, 1), dt.date(year, 12, 31)
    return calendar.where(F.col("ds").between(F.lit(first), F.lit(last)))


def partition_scan(df: DataFrame, day: dt.date) -> DataFrame:
    return df.where(F.col("dt") == F.lit(day))


def code_lookup(df: DataFrame, codes: str | Sequence[str] | DataFrame) -> DataFrame:
    """Rows of one code, of a few, or of a watchlist frame with a ``code`` column."""
    if isinstance(codes, DataFrame):
        return df.join(codes.select("code"), "code", "left_semi")
    wanted = [codes] if isinstance(codes, str) else list(codes)
    return df.where(F.col("code").isin(*wanted))


def preview(df: DataFrame, n: int = 100, order_by: Sequence[str] = ()) -> DataFrame:
    """First rows: any ``n``, or with ``order_by`` the smallest ``n`` (a distributed top-k)."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)


def table_scan(df: DataFrame) -> DataFrame:
    return df
