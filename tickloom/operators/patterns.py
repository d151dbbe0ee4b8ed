"""K-line pattern mining: sliding windows over return series and their statistics.

Input series carry ``rk``, the row's number within its code, unique per code. All
windows are bounded row frames, so a row costs at most ``w`` list entries.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions import by_code, split_tokens


def window_rows(series: DataFrame, w: int = 5) -> DataFrame:
    """Explode every row into the ``w``-row windows it belongs to.

    A window exists for each row ``e`` with ``e - (w - 1) > 0`` and holds the rows
    numbered from there to ``e``. Each row looks ahead over at most ``w`` rows for the
    window ends, which replaces a range self-join.
    """
    span = w - 1
    ahead = F.collect_list("rk").over(by_code("rk").rowsBetween(0, span))
    ends = F.filter(ahead, lambda end: (end <= F.col("rk") + span) & (end > span))
    return (
        series.withColumn("_ends", ends)
        .select("code", F.explode("_ends").alias("end_rk"), "up_down_rate", "rk")
        .select("code", (F.col("end_rk") - span).alias("g"), "up_down_rate", "rk")
    )


def _rounded(rate: Column) -> Column:
    return F.round(rate, 0).cast("bigint")


def _sign(rate: Column) -> Column:
    return F.when(rate > 0, 1).when(rate == 0, 0).otherwise(-1).cast("bigint")


# How a daily return is written into a pattern.
TOKENS = {"round": _rounded, "sign": _sign}
# Bits that hold a token, its sign included: whole percents of a decimal(10, x) need 28.
TOKEN_BITS = {"round": 32, "sign": 2}


def _windows(
    series: DataFrame, width: int, token: str, since: dt.date | None, count: int | None
) -> DataFrame:
    """Per row the tokens of the window that ends there, if it holds ``count`` rows.

    ``_t0`` is the row's own token, ``_t1`` that of the row before, up to ``width - 1``:
    plain lags of an integer, no list is built for a row. ``since`` cuts the series first
    while ``rk`` keeps its old values, so a window that reaches over the cut is short and
    its first tokens are NULL. ``tags`` numbers a code's windows in order, short ones
    included.
    """
    rows = series if since is None else series.where(F.col("ds") >= F.lit(since))
    span, wanted = width - 1, width if count is None else count
    w = by_code("rk")
    # number and token together: one lag for each position brings both
    entry = F.struct("rk", TOKENS[token](F.col("up_down_rate")).alias("t"))
    lags = {f"_e{k}": F.lag("_e0", k).over(w) for k in range(1, width)}
    numbered = F.sum(F.when(F.col("rk") > span, 1).otherwise(0)).over(
        w.rowsBetween(Window.unboundedPreceding, 0)
    )
    # numbers grow along a code, so a window holds the nearest rows down to its first number
    inside = {k: F.coalesce(F.col(f"_e{k}.rk") >= F.col("rk") - span, F.lit(False)) for k in range(width)}
    framed = rows.withColumn("_e0", entry).withColumns({**lags, "tags": numbered})
    held = inside[wanted - 1] if 0 < wanted <= width else F.lit(False)
    if wanted < width:
        held = held & ~inside[wanted]
    tokens = [F.when(inside[k], F.col(f"_e{k}.t")).alias(f"_t{k}") for k in range(width)]
    return framed.where((F.col("rk") > span) & held).select("code", "tags", "rk", *tokens)


def kline_strings(
    series: DataFrame,
    width: int = 13,
    token: str = "round",
    sep: str = "|",
    since: dt.date | None = None,
    count: int | None = None,
) -> DataFrame:
    """Every full window as a delimited token string plus its ``?``-joined positions.

    The series order comes from the frame, so the strings are deterministic.
    ``count`` keeps windows with that many rows instead of ``width``.
    """
    held = width if count is None else count
    tokens = [F.col(f"_t{k}").cast("string") for k in range(min(width, held) - 1, -1, -1)]
    return _windows(series, width, token, since, count).select(
        "code",
        "tags",
        F.concat_ws(sep, *tokens).alias("kline"),
        F.lit("?".join(str(i + 1) for i in range(held))).alias("nos"),
    )


def kline_strings_short(
    series: DataFrame,
    width: int = 12,
    token: str = "round",
    sep: str = "|",
    since: dt.date | None = None,
    count: int | None = None,
) -> DataFrame:
    """Window strings without positions: the rows of the training table."""
    return kline_strings(series, width, token, sep, since, count).drop("nos")


def kline_signs(series: DataFrame, width: int = 7, sep: str = ",") -> DataFrame:
    """Windows of return signs (1, 0, -1)."""
    return kline_strings_short(series, width, "sign", sep)


def _last_move(kline: str, sep: str) -> Column:
    return F.element_at(split_tokens(F.col(kline), sep), -1).try_cast("decimal(20,3)")


def _prefix(kline: str, sep: str, n: int) -> Column:
    return F.substring_index(kline, sep, n)


def pattern_frequency(kline: DataFrame, prefix: int = 12, sep: str = "|") -> DataFrame:
    """How often each prefix was followed by a rise, most frequent first."""
    return (
        kline.where(_last_move("kline", sep) > 0)
        .groupBy(_prefix("kline", sep, prefix).alias("pattern"))
        .agg(F.count(F.lit(1)).alias("num"))
        .orderBy(F.desc("num"), "pattern")
    )


def pattern_up_ratio(
    kline: DataFrame, prefix: int = 7, sep: str = ",", min_up: int = 50
) -> DataFrame:
    """Per prefix: windows ending in a rise, in a fall, and the share of rises in percent."""
    last = _last_move("kline", sep)
    return (
        kline.groupBy(_prefix("kline", sep, prefix).alias("stock"))
        .agg(F.count_if(last > 0).alias("up"), F.count_if(last < 0).alias("down"))
        .where(F.col("up") > min_up)
        .withColumn("ratio", _share_of_rises())
        .orderBy(F.desc("ratio"), "stock")
    )


def _packed(tokens: list[str], bits: int) -> list[Column]:
    """Tokens side by side in as few longs as hold them."""
    per, mask = 64 // bits, (1 << bits) - 1
    out = []
    for start in range(0, len(tokens), per):
        word = F.lit(0).cast("bigint")
        for name in tokens[start : start + per]:
            word = F.shiftleft(word, bits).bitwiseOR(F.col(name).bitwiseAND(F.lit(mask).cast("bigint")))
        out.append(word)
    return out


def _unpacked(words: list[str], n: int, bits: int) -> list[Column]:
    """The ``n`` tokens of packed longs, signs restored."""
    per, out = 64 // bits, []
    for at, word in enumerate(words):
        held = min(per, n - at * per)
        for i in range(held):
            left = 64 - bits * (held - i)
            out.append(F.shiftright(F.shiftleft(F.col(word), left), 64 - bits))
    return out


def _coded(
    series: DataFrame, width: int, prefix: int, token: str, since: dt.date | None
) -> tuple[DataFrame, list[str], list[Column]]:
    """Full windows as packed prefixes and the last token; key columns, and their tokens.

    Returns must not be NULL; the series operators leave such rows out.
    """
    if not 0 < prefix <= width:
        raise ValueError("the prefix lies within the window")
    bits = TOKEN_BITS[token]
    first = [f"_t{k}" for k in range(width - 1, width - 1 - prefix, -1)]
    words = {f"_w{i}": c for i, c in enumerate(_packed(first, bits))}
    rows = _windows(series, width, token, since, None)
    keys = list(words)
    coded = rows.select(*[c.alias(name) for name, c in words.items()], F.col("_t0").alias("_last"))
    return coded, keys, _unpacked(keys, prefix, bits)


def pattern_frequency_of(
    series: DataFrame,
    width: int = 13,
    prefix: int = 12,
    token: str = "round",
    sep: str = "|",
    since: dt.date | None = None,
) -> DataFrame:
    """``pattern_frequency`` straight from a series: patterns stay packed integers.

    Windows are counted by one to a few longs, and only the distinct patterns become text.
    """
    coded, keys, tokens = _coded(series, width, prefix, token, since)
    return (
        coded.where("_last > 0")
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("num"))
        .select(F.concat_ws(sep, *[t.cast("string") for t in tokens]).alias("pattern"), "num")
        .orderBy(F.desc("num"), "pattern")
    )


def pattern_up_ratio_of(
    series: DataFrame,
    width: int = 8,
    prefix: int = 7,
    token: str = "sign",
    sep: str = ",",
    min_up: int = 50,
    since: dt.date | None = None,
) -> DataFrame:
    """``pattern_up_ratio`` straight from a series, on packed integers."""
    coded, keys, tokens = _coded(series, width, prefix, token, since)
    counted = coded.groupBy(*keys).agg(
        F.count_if(F.col("_last") > 0).alias("up"), F.count_if(F.col("_last") < 0).alias("down")
    )
    named = counted.where(F.col("up") > min_up).select(
        F.concat_ws(sep, *[t.cast("string") for t in tokens]).alias("stock"), "up", "down"
    )
    return named.withColumn("ratio", _share_of_rises()).orderBy(F.desc("ratio"), "stock")


def _share_of_rises() -> Column:
    up, down = F.col("up").cast("decimal(20,0)"), F.col("down").cast("decimal(20,0)")
    return F.round(F.try_divide(up * 100, up + down), 2)


def weekly_training(
    rates: DataFrame, calendar: DataFrame, since: dt.date | None = None, days: int = 5
) -> DataFrame:
    """Full trading weeks with their daily moves, labelled by the next kept week.

    ``rates`` has one row per (code, ds). A week counts if it has exactly ``days`` rows
    in its (calendar year, ISO week); the labels (Monday's rounded move and the
    rounded weekly sum) come from the code's next such week within the year, so weeks
    that were left out are skipped and a year's last week has none.
    """
    opened = calendar.where(F.col("astatus") == 1)
    if since is not None:
        opened = opened.where(F.col("ds") >= F.lit(since))
    days_of = opened.select(
        "ds",
        F.year("ds").alias("year"),
        "weekofyear",
        F.col("weekday").cast("int").alias("wd"),
        F.expr("if(month(ds) > 6, 7, 0) + cast(weekday as int) - 1").alias("slot"),
    ).dropDuplicates(["ds"])
    rate = F.col("up_down_rate")
    # One slot per weekday and half of the year, since a year's first and last days can
    # share a week number. Slots are plain maxima of single values: the state per group
    # is fixed and combined on the map side, unlike a collected list.
    names = {slot: f"d{slot}" for slot in range(14)}
    slots = [
        F.max(F.when(F.col("slot") == slot, F.round(rate, 1))).alias(name)
        for slot, name in names.items()
    ]
    ups = F.concat_ws(",", *[F.col(name).cast("string") for name in names.values()])
    weeks = (
        rates.join(F.broadcast(days_of), "ds", "inner")  # one row per date
        .groupBy("code", "year", "weekofyear")
        .agg(
            F.count(F.lit(1)).alias("n"),
            *slots,
            F.sum(F.when(F.col("wd") == 1, F.round(rate, 0)).otherwise(0)).alias("monday"),
            F.round(F.sum(rate), 0).alias("week"),
        )
        .where(F.col("n") == days)
    )
    following = Window.partitionBy("year", "code").orderBy("weekofyear")
    return (
        weeks.withColumns(
            {
                "monday_result": F.lead("monday").over(following),
                "week_result": F.lead("week").over(following),
            }
        )
        .where(F.col("monday_result").isNotNull())
        .select(
            "code",
            "year",
            "weekofyear",
            ups.alias("ups"),
            "monday_result",
            "week_result",
        )
    )
