from tickloom.functions.measures import (
    in_boards,
    lot_bucket,
    on_day,
    pct_change,
    share_of,
    split_tokens,
    to_decimal,
)
from tickloom.functions.windows import by_code, day_number

__all__ = [
    "by_code",
    "day_number",
    "in_boards",
    "lot_bucket",
    "on_day",
    "pct_change",
    "share_of",
    "split_tokens",
    "to_decimal",
]
