"""Window specs over one code's days.

Every frame that reaches these windows holds at most one row per (code, ds):
``operators.series.latest_per_day`` or a (code, ds) aggregate runs first. One
code's window group is therefore never longer than the number of calendar days
covered, however many raw rows the code has.
"""

from __future__ import annotations

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F


def by_code(day: str = "ds") -> WindowSpec:
    return Window.partitionBy("code").orderBy(day)


def day_number(day: Column) -> Column:
    """Days since the epoch: makes date arithmetic usable in RANGE frames."""
    return F.unix_date(day)
