"""Column expressions shared by the operators. All stay JVM-side."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def pct_change(now: Column, base: Column, scale: int = 2) -> Column:
    """Percent move from ``base`` to ``now``; NULL when the base is zero."""
    return F.round(F.try_divide((now - base) * 100, base), scale)


def share_of(part: Column, whole: Column) -> Column:
    """``part`` as a percentage of ``whole`` in double precision, NULL for a zero whole."""
    return F.try_divide(part.cast("double") * 100, whole.cast("double"))


def to_decimal(text: Column, precision: int = 32, scale: int = 4) -> Column:
    """Number kept as text -> decimal; unreadable text becomes NULL instead of an error."""
    return F.trim(text).try_cast(f"decimal({precision},{scale})")


def in_boards(board: Column, boards: Sequence[str] | None) -> Column:
    """True for the chosen market boards; ``None`` accepts every row."""
    return F.lit(True) if boards is None else board.isin(*[str(b) for b in boards])


def on_day(column: Column, day: dt.date | None) -> Column:
    """Literal day predicate (prunes partitions); ``None`` keeps every day."""
    return F.lit(True) if day is None else column == F.lit(day)


def lot_bucket(size: Column, edges: Sequence[int], overflow: int) -> Column:
    """First edge the size lies below; the rest, NULL sizes included, goes to ``overflow``."""
    bucket = None
    for edge in edges:
        below = size < edge
        bucket = F.when(below, edge) if bucket is None else bucket.when(below, edge)
    return bucket.otherwise(overflow)


def split_tokens(text: Column, sep: str) -> Column:
    """Split on a literal separator (it may be a regex metacharacter such as ``|``)."""
    return F.split(text, re.escape(sep))
