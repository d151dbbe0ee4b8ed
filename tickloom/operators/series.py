"""Price and return series: dedupe, stitching, carry-forward, daily append."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions import by_code, in_boards, on_day


# Name of the column metadata that marks a frame as having one row per (code, day).
ONE_ROW_PER = "one_row_per"
# Types whose values an aggregate keeps in place, so that it runs as a hash aggregate.
_FIXED = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType)


def one_row_per_day(df: DataFrame, day: str = "ds") -> DataFrame:
    """Mark a frame that is known to have one row per (code, day), as a bars table has.

    Operators then leave their own reduction out. The mark lies on the code column and
    passes through ``select`` and ``where``; operators that join or stack frames reduce
    them whatever the mark says.
    """
    return df.withMetadata("code", {**df.schema["code"].metadata, ONE_ROW_PER: day})


def has_one_row_per_day(df: DataFrame, day: str = "ds") -> bool:
    return df.schema["code"].metadata.get(ONE_ROW_PER) == day


def _load_order(df: DataFrame, snapshot: str, values: Sequence[str]) -> Column:
    """Days of the load, then 41 bits of the values' hash: rows of a load have a fixed order."""
    load = F.coalesce(F.unix_date(snapshot), F.lit(-(2**21))).cast("bigint")
    return load * F.lit(2**41) + F.xxhash64(*values).bitwiseAND(F.lit(2**41 - 1))


def latest_per_day(
    df: DataFrame, day: str = "ds", snapshot: str = "dt", unique: bool | None = None
) -> DataFrame:
    """One row per (code, business day): the one from the latest load.

    Overlapping loads repeat a business date. They are reduced on the map side first, so
    even a (code, day) with very many copies sends one row per task. Callers select the
    columns that they need beforehand: these alone tell rows of one load apart.

    Columns of fixed width are taken by ``max_by`` under one order, all from the same row,
    in a hash aggregate without a sort; with others a top-1 window does the same. Frames
    known to be unique (``unique``, by default the mark of ``one_row_per_day``) stay as
    they are.
    """
    if has_one_row_per_day(df, day) if unique is None else unique:
        return df
    values = [c for c in df.columns if c not in ("code", day, snapshot)]
    fixed = all(isinstance(df.schema[c].dataType, _FIXED) for c in values)
    if fixed and isinstance(df.schema[snapshot].dataType, T.DateType):
        order = _load_order(df, snapshot, values) if values else F.unix_date(snapshot)
        newest = [F.max_by(c, "_order").alias(c) for c in values]
        reduced = (
            df.withColumn("_order", order).groupBy("code", day).agg(F.max(snapshot).alias(snapshot), *newest)
        )
        return reduced.select(*df.columns)
    newest = Window.partitionBy("code", day).orderBy(
        F.col(snapshot).desc(), *[F.col(c) for c in sorted(values)]
    )
    return (
        df.withColumn("_copy", F.row_number().over(newest))
        .where(F.col("_copy") == 1)
        .drop("_copy")
    )


def board_codes(detail: DataFrame, boards: Sequence[str] | None, day: dt.date | None) -> DataFrame:
    """Distinct codes listed on the chosen boards in one snapshot (or ever)."""
    return (
        detail.where(on_day(F.col("dt"), day) & in_boards(F.col("board"), boards))
        .select("code")
        .distinct()
    )


def latest_of_both(past: DataFrame, recent: DataFrame) -> DataFrame:
    """One row per (code, ds) of two sources: each is reduced by itself, then their stack."""
    stacked = latest_per_day(past).unionByName(latest_per_day(recent))
    return latest_per_day(stacked, unique=False)


def price_series(history: DataFrame, detail: DataFrame) -> DataFrame:
    """Bulk history followed by daily rows as one series, numbered per code by day."""
    past = history.select("code", "up_down_rate", "opening_price", "closing_price", "ds", "dt")
    recent = detail.select(
        "code",
        "up_down_rate",
        "opening_price",
        F.col("current_price").alias("closing_price"),
        "ds",
        "dt",
    )
    stitched = latest_of_both(past, recent).drop("dt")
    return stitched.withColumn("rk", F.row_number().over(by_code()))


def stitched_returns(
    history: DataFrame,
    detail: DataFrame,
    boards: Sequence[str] | None,
    min_year: int | None = None,
    board_dt: dt.date | None = None,
    restrict_detail_to_snapshot: bool = False,
) -> DataFrame:
    """Non-zero daily returns of both sources, one row per (code, ds), not numbered.

    History rows are limited to codes on the boards in the ``board_dt`` snapshot.
    Daily rows are limited by their own board, or by the same snapshot on request.
    """
    listed = board_codes(detail, boards, board_dt)
    past = history.where(F.col("up_down_rate") != 0)
    if min_year is not None:
        past = past.where(F.col("year") >= min_year)
    past = latest_per_day(past.select("code", "up_down_rate", "ds", "dt"))
    past = past.join(listed, "code", "left_semi")

    recent = detail.where((F.col("up_down_rate") != 0) & (F.col("current_price") > 0))
    if not restrict_detail_to_snapshot:
        recent = recent.where(in_boards(F.col("board"), boards))
    recent = latest_per_day(recent.select("code", "up_down_rate", "ds", "dt"))
    if restrict_detail_to_snapshot:
        recent = recent.join(listed, "code", "left_semi")
    # The sources are reduced before the semi joins shuffle by code: raw copies never meet there.
    return latest_per_day(past.unionByName(recent), unique=False).drop("dt")


def return_series(
    history: DataFrame,
    detail: DataFrame,
    boards: Sequence[str] | None,
    min_year: int | None = None,
    board_dt: dt.date | None = None,
) -> DataFrame:
    """Numbered series of non-zero returns: the input of the pattern operators."""
    rows = stitched_returns(history, detail, boards, min_year, board_dt)
    return rows.withColumn("rk", F.row_number().over(by_code()))


def series_length(series: DataFrame) -> DataFrame:
    """Last sequence number of each code."""
    return series.groupBy("code").agg(F.max("rk").alias("length"))


# Columns a new snapshot takes from the day's K-line; everything else is carried over.
# Fixed values.
_FRESH = (
    "id",
    "market",
    "name",
    "up_down_rate",
    "up_down_amount",
    "turnover_rate",
    "amplitude",
    "highest",
    "lowest",
    "opening_price",
    "volume",
    "amount",
)


def carry_forward(
    history: DataFrame,
    detail: DataFrame,
    day: dt.date | None = None,
    prev: dt.date | None = None,
    gap: int = 1,
) -> DataFrame:
    """Rebuild missing snapshots: prices from the K-line, the rest from ``gap`` days before.

    With ``day`` and ``prev`` one snapshot is built; without them one for every day
    that has a K-line and an earlier snapshot. Codes missing in either are dropped.
    """
    if day is not None and prev is not None:
        gap = (day - prev).days
    fresh = [c for c in _FRESH if c in history.columns]
    today = history.where(on_day(F.col("dt"), day)).select(
        "code", "dt", F.col("closing_price").alias("current_price"), *fresh
    )
    known = {"code", "dt", "ds", "current_price", "t_1_price", *fresh}
    carried = [c for c in detail.columns if c not in known]
    yesterday = detail.where(
        on_day(F.col("dt"), None if day is None else day - dt.timedelta(days=gap))
    ).select(
        "code",
        F.date_add("dt", gap).alias("dt"),
        F.col("current_price").alias("t_1_price"),
        *carried,
    )
    built = today.join(yesterday, ["code", "dt"], "inner").withColumn("ds", F.col("dt"))
    order = [c for c in detail.columns if c in built.columns]
    return built.select(*order, *[c for c in built.columns if c not in order])


# Columns that a daily row keeps in the history's layout.
_KEPT = (
    "market",
    "code",
    "name",
    "up_down_rate",
    "up_down_amount",
    "turnover_rate",
    "amplitude",
    "highest",
    "lowest",
    "opening_price",
)


def daily_append(detail: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    """Daily rows in history layout, the day split into year and month-day, ``dt`` = the day."""
    kept = [c for c in _KEPT if c in detail.columns]
    return detail.where(on_day(F.col("ds"), as_of)).select(
        *kept,
        F.lit(0).cast("bigint").alias("dk_total"),
        F.col("current_price").alias("closing_price"),
        "volume",
        "amount",
        F.year("ds").cast("bigint").alias("year"),
        F.date_format("ds", "MM-dd").alias("month_day"),
        F.col("ds").alias("dt"),
    )
