"""Technical indicators over one code's daily bars.

All indicators come from the same window spec, so a plan that asks for several
of them (or for all, ``stock_step_one``) has one exchange, one sort and one Window
node; unused ones are pruned by the optimizer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions import by_code
from tickloom.operators.series import latest_per_day


_SPREAD = ("highest", "lowest")
_PRICES = ("closing_price", *_SPREAD)


def _bars(history: DataFrame, *columns: str) -> DataFrame:
    return latest_per_day(history.select("code", "ds", "dt", *columns)).drop("dt")


def _ranked(history: DataFrame, columns: Sequence[str], **frames: Column) -> DataFrame:
    """One row per (code, ds) with the columns that are needed, its number and the frames."""
    w = by_code()
    return _bars(history, *columns).withColumns({"rk": F.row_number().over(w), **frames})


def _lagged(name: str) -> Column:
    return F.lag(name).over(by_code())


def _trailing(agg: Column, rows: int) -> Column:
    return agg.over(by_code().rowsBetween(-(rows - 1), 0))


def _first_row(default: Column, otherwise: Column) -> Column:
    # A default for the missing predecessor only: a NULL predecessor stays NULL.
    return F.when(F.col("rk") == 1, default).otherwise(otherwise)


def _last_closing() -> Column:
    return _first_row(F.col("closing_price"), F.col("prev_close"))


def prev_close_diff(history: DataFrame) -> DataFrame:
    """Previous close (own close on the first row) and the move from it."""
    return (
        _ranked(history, ["closing_price"], prev_close=_lagged("closing_price"))
        .withColumn("last_closing", _last_closing())
        .select(
            "code",
            "ds",
            "closing_price",
            "last_closing",
            (F.col("closing_price") - F.col("last_closing")).alias("closing_diff"),
        )
    )


def _range_frames(n: int) -> dict[str, Column]:
    return {"hhv": _trailing(F.max("highest"), n), "llv": _trailing(F.min("lowest"), n)}


def hhv_llv(history: DataFrame, n: int = 9) -> DataFrame:
    """Highest high and lowest low of the last ``n`` rows."""
    return _ranked(history, _SPREAD, **_range_frames(n)).select("code", "ds", "hhv", "llv")


def _rsv() -> Column:
    width = F.col("hhv") - F.col("llv")
    position = (F.col("closing_price") - F.col("llv")) * 100
    # nullif keeps a flat range from dividing by zero; flat and NULL ranges both read 0.
    return F.coalesce(position / F.nullif(width, F.lit(0)), F.lit(0))


def rsv(history: DataFrame, n: int = 9) -> DataFrame:
    """Raw stochastic value: where the close lies in the ``n``-row range, in percent."""
    frames = _range_frames(n)
    return _ranked(history, _PRICES, **frames).select("code", "ds", _rsv().alias("rsv"))


def _sar_frames(start: int, step: int) -> dict[str, Column]:
    return {
        "high_start": _trailing(F.max("highest"), start),
        "high_step": _trailing(F.max("highest"), step),
        "low_start": _trailing(F.min("lowest"), start),
        "low_step": _trailing(F.min("lowest"), step),
    }


def _sar_high(start: int) -> Column:
    return F.when(F.col("rk") <= start, F.col("high_start")).otherwise(F.col("high_step"))


def _sar_low(start: int) -> Column:
    return F.when(F.col("rk") <= start, F.col("low_start")).otherwise(F.col("low_step"))


def sar_bounds(history: DataFrame, start: int = 4, step: int = 2) -> DataFrame:
    """Bounds of the parabolic stop: a wide frame over the first rows, then a short one."""
    return _ranked(history, _SPREAD, **_sar_frames(start, step)).select(
        "code", "ds", _sar_high(start).alias("sar_high"), _sar_low(start).alias("sar_low")
    )


def _true_range() -> Column:
    spread = F.col("highest") - F.col("lowest")
    reach = F.greatest(
        F.abs(F.col("last_closing") - F.col("lowest")),
        F.abs(F.col("highest") - F.col("last_closing")),
        spread,
    )
    return F.when(spread.isNotNull(), reach)


def true_range(history: DataFrame) -> DataFrame:
    """Largest of the day's spread and the two distances to the previous close."""
    return (
        _ranked(history, _PRICES, prev_close=_lagged("closing_price"))
        .withColumn("last_closing", _last_closing())
        .select("code", "ds", _true_range().alias("tr"))
    )


def _moves() -> dict[str, Column]:
    zero = F.lit(0)
    return {
        "up_move": _first_row(zero, F.col("highest") - F.col("prev_high")),
        "down_move": _first_row(zero, F.col("prev_low") - F.col("lowest")),
    }


def _dominant(move: str, other: str) -> Column:
    wins = (F.col(move) > 0) & (F.col(move) > F.col(other))
    return F.when(wins, F.col(move)).otherwise(0)


def directional_move(history: DataFrame) -> DataFrame:
    """Up and down moves against the previous row; only the larger positive one counts."""
    return (
        _ranked(history, _SPREAD, prev_high=_lagged("highest"), prev_low=_lagged("lowest"))
        .withColumns(_moves())
        .select(
            "code",
            "ds",
            _dominant("up_move", "down_move").alias("dmp"),
            _dominant("down_move", "up_move").alias("dmm"),
        )
    )


def stock_step_one(history: DataFrame, n: int = 9, start: int = 4, step: int = 2) -> DataFrame:
    """All indicators in one 18-column row per bar."""
    frames = {
        "prev_close": _lagged("closing_price"),
        "prev_high": _lagged("highest"),
        "prev_low": _lagged("lowest"),
        **_range_frames(n),
        **_sar_frames(start, step),
    }
    return (
        _ranked(history, ["name", *_PRICES, "amount"], **frames)
        .withColumns({"last_closing": _last_closing(), **_moves()})
        .select(
            "code",
            "name",
            "closing_price",
            "last_closing",
            "highest",
            "lowest",
            "ds",
            F.col("amount").alias("deal_amount"),
            (F.col("closing_price") - F.col("last_closing")).alias("closing_diff"),
            F.col("rk").cast("bigint").alias("rk"),
            F.col("hhv").alias("x"),
            F.col("llv").alias("i"),
            _rsv().alias("rsv"),
            _sar_high(start).alias("sar_high"),
            _sar_low(start).alias("sar_low"),
            _true_range().alias("tr"),
            _dominant("up_move", "down_move").alias("dmp"),
            _dominant("down_move", "up_move").alias("dmm"),
        )
    )
