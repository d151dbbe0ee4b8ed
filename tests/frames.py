"""Hand-made frames for the unit tests."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal


def day(text: str) -> dt.date:
    return dt.date.fromisoformat(text)


def dec(x):
    return None if x is None else Decimal(str(x))


DETAIL = (
    "code string, ds date, dt date, current_price decimal(10,2), opening_price decimal(10,2), "
    "up_down_rate decimal(10,2), turnover_rate decimal(10,2), board string, "
    "total_market_v decimal(20,2)"
)


def detail(spark, rows):
    """Rows of (code, day, price[, rate[, board[, load day]]])."""
    out = []
    for row in rows:
        code, ds, price, *rest = row
        rate = rest[0] if rest else 1
        board = rest[1] if len(rest) > 1 else "2"
        loaded = day(rest[2]) if len(rest) > 2 else day(ds)
        out.append(
            (code, day(ds), loaded, dec(price), dec(price), dec(rate), dec(1), board, dec(1000))
        )
    return spark.createDataFrame(out, DETAIL)


def calendar(spark, first: str, days: int, closed=()):
    """Consecutive days, weekends and ``closed`` ones shut."""
    out = []
    for i in range(days):
        d = day(first) + dt.timedelta(days=i)
        shut = d.isoweekday() > 5 or d.isoformat() in closed
        out.append((d, d.isoweekday(), d.isocalendar().week, 0 if shut else 1))
    return spark.createDataFrame(out, "ds date, weekday int, weekofyear bigint, astatus bigint")


def history(spark, rows):
    """Rows of (code, day, close, high, low)."""
    out = [
        (c, "N" + c, day(d), day("2022-08-04"), dec(close), dec(high), dec(low), dec(5))
        for c, d, close, high, low in rows
    ]
    return spark.createDataFrame(
        out,
        "code string, name string, ds date, dt date, closing_price decimal(10,2), "
        "highest decimal(10,2), lowest decimal(10,2), amount decimal(20,5)",
    )


def finance(spark, rows):
    """Rows of (code, day, purchase, repay, balance)."""
    out = [(c, day(d), day(d), dec(p), dec(r), dec(b)) for c, d, p, r, b in rows]
    return spark.createDataFrame(
        out,
        "code string, notice_date date, dt date, financing_purchase decimal(32,4), "
        "financing_repay decimal(32,4), financing_balance decimal(32,4)",
    )


def news(spark, rows):
    """Rows of (code, time, title)."""
    out = [(c, dt.datetime.fromisoformat(t), title, day(t[:10])) for c, t, title in rows]
    return spark.createDataFrame(
        out, "code string, notice_date timestamp_ntz, title string, dt date"
    )


def rows(df, *names):
    """Collected rows as sorted tuples (NULLs first)."""
    picked = df.select(*names) if names else df
    found = [tuple(r) for r in picked.collect()]
    return sorted(found, key=lambda t: tuple((v is not None, str(v)) for v in t))
