"""Money flow of the day and aggregates over trade ticks.

Ticks are the largest input. All tick aggregates are plain sums and counts, so they
are combined on the map side and a code with a large share of the ticks costs
one partial row per task in the shuffle.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions import in_boards, lot_bucket, on_day, share_of

# Trade sides and inflow columns of the tables.
SELL, BUY, PENDING = 1, 2, 4
INFLOWS = ("main_inflow", "slarge_inflow", "large_inflow", "mid_inflow", "small_inflow")


def _only(df: DataFrame, day: dt.date | None, code: str | None) -> DataFrame:
    rows = df.where(on_day(F.col("dt"), day))
    return rows if code is None else rows.where(F.col("code") == code)


def _side_sum(side: int, amount: Column) -> Column:
    return F.sum(F.when(F.col("buyorsale") == side, amount).otherwise(0))


def side_pivot(deal: DataFrame, day: dt.date | None = None, code: str | None = None) -> DataFrame:
    """Trade count, volume and money per code, bought and sold."""
    money = F.col("draw") * F.col("deal")
    return (
        _only(deal, day, code)
        .groupBy("code")
        .agg(
            _side_sum(BUY, F.col("dealnum")).alias("buy1"),
            _side_sum(SELL, F.col("dealnum")).alias("sell1"),
            _side_sum(BUY, F.col("draw")).alias("buy2"),
            _side_sum(SELL, F.col("draw")).alias("sell2"),
            _side_sum(BUY, money).alias("buy3"),
            _side_sum(SELL, money).alias("sell3"),
        )
    )


def side_amount(
    deal: DataFrame, day: dt.date | None = None, code: str | None = None, lot: int = 100
) -> DataFrame:
    """Money per code bought, sold and pending; ``draw`` counts lots of ``lot`` shares."""
    money = F.col("draw") * F.col("deal") * lot
    return (
        _only(deal, day, code)
        .groupBy("code")
        .agg(
            _side_sum(BUY, money).alias("buy"),
            _side_sum(SELL, money).alias("sale"),
            _side_sum(PENDING, money).alias("gua"),
        )
    )


def lot_histogram(
    deal: DataFrame,
    day: dt.date | None = None,
    code: str | None = None,
    edges: Sequence[int] = (10, 99, 999),
    overflow: int = 9999,
) -> DataFrame:
    """Number of ticks per size class, labelled by the class's upper edge."""
    return (
        _only(deal, day, code)
        .groupBy(lot_bucket(F.col("draw"), edges, overflow).alias("bucket"))
        .agg(F.count(F.lit(1)).alias("cnt"))
    )


def _total(columns: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a + b, columns)


def flow_total(detail: DataFrame, day: dt.date | None = None, code: str | None = None) -> DataFrame:
    """Sum of the five inflows per row."""
    return _only(detail, day, code).select(
        "code", "dt", _total([F.col(c) for c in INFLOWS]).alias("total_inflow")
    )


def flow_share(
    detail: DataFrame, since: dt.date | None = None, code: str | None = None
) -> DataFrame:
    """Each inflow in percent of the summed absolute inflows; NULL if all are zero."""
    rows = _only(detail, None, code)
    if since is not None:
        rows = rows.where(F.col("dt") >= F.lit(since))
    moved = _total([F.abs(c) for c in INFLOWS])
    shares = [share_of(F.col(c), moved).alias(c.removesuffix("_inflow")) for c in INFLOWS]
    return rows.select("ds", "code", *shares, "up_down_rate").orderBy("ds", "code")


def big_small_flow(detail: DataFrame, day: dt.date | None = None) -> DataFrame:
    """Large-order against small-order inflow per code, largest first."""
    return (
        _only(detail, day, None)
        .groupBy("code")
        .agg(
            F.sum(F.col("main_inflow") + F.col("slarge_inflow")).alias("big"),
            F.sum(F.col("mid_inflow") + F.col("small_inflow")).alias("small"),
        )
        .orderBy(F.desc("big"), "code")
    )


def flow_projection(
    detail: DataFrame,
    day: dt.date | None = None,
    code: str | None = None,
    boards: Sequence[str] | None = None,
) -> DataFrame:
    """The inflow columns of a day."""
    rows = _only(detail, day, code).where(in_boards(F.col("board"), boards))
    return rows.select("code", "dt", *INFLOWS)
