"""Table schemas: the raw layer as it lies on disk, and how each table is typed on load.

Fixed values: table names, column names and column types are the data contract
with existing warehouses and must stay as they are.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions import to_decimal

# --- fixed values: raw (TSV) tables, columns in file order -------------------

CALENDAR = """
    ds string, weekday string, type string, typeDes string, chineseZodiac string,
    dayOfYear bigint, weekOfYear bigint, indexWorkDayOfMonth bigint,
    Astatus bigint, HKstatus bigint, USAstatus bigint
"""

HISTORY = """
    id bigint, market bigint, code string, name string,
    up_down_rate decimal(10,2), up_down_amount decimal(16,2),
    turnover_rate decimal(10,2), amplitude decimal(10,2),
    highest decimal(10,2), lowest decimal(10,2),
    opening_price decimal(10,2), closing_price decimal(10,2),
    deal_amount decimal(20,5), deal_vol decimal(32,10),
    year bigint, month_day string
"""

DETAIL = """
    id bigint, market bigint, code string, name string,
    current_price decimal(10,2), up_down_rate decimal(10,2),
    up_down_rate5 decimal(10,2), up_down_rate10 decimal(10,2),
    up_down_amount decimal(16,2), turnover_rate decimal(5,2),
    PE_ratio_d decimal(32,2), amplitude decimal(10,2), volume_ratio decimal(10,2),
    highest decimal(10,2), lowest decimal(10,2), opening_price decimal(10,2),
    t_1_price decimal(10,2), total_market_v decimal(32,5),
    circulation_market_v decimal(32,5), price_to_b_ratio decimal(32,5),
    increase_this_year decimal(10,2), time_to_market bigint,
    outer_disk decimal(32,2), inner_disk decimal(32,2), roe decimal(20,3),
    total_share_capital decimal(32,3), tradable_shares decimal(32,3),
    total_revenue decimal(32,5), total_revenue_r decimal(32,5),
    gross_profit_margin decimal(32,10), total_assets decimal(32,10),
    debt_ratio decimal(32,10), industry string, regional_plate string,
    profit decimal(32,10), PE_ratio_s decimal(32,2), ttm decimal(32,2),
    net_assets decimal(32,10), deal_amount decimal(20,5), deal_vol decimal(20,5),
    dealTradeStae bigint, commission decimal(5,2), net_margin decimal(32,5),
    total_profit decimal(32,5), net_assets_per_share decimal(32,5),
    net_profit decimal(32,5), net_profit_r decimal(32,5),
    unearnings_per_share decimal(32,5),
    main_inflow decimal(32,5), main_inflow_ratio decimal(20,2),
    Slarge_inflow decimal(32,5), Slarge_inflow_ratio decimal(20,2),
    large_inflow decimal(32,5), large_inflow_ratio decimal(20,2),
    mid_inflow decimal(32,5), mid_inflow_ratio decimal(20,2),
    small_inflow decimal(32,5), small_inflow_ratio decimal(20,2),
    ds string, board string
"""

HOUR_KLINE = """
    id bigint, market bigint, type bigint, code string, name string,
    trendsTotal decimal(10,2), preClose decimal(10,2), trends string,
    current_price decimal(10,2), current_high decimal(10,2), current_low decimal(10,2),
    deal_amount decimal(20,5), deal_vol decimal(32,10)
"""

COMPANY_EVENT = """
    code string, event_type string, specific_eventtype string,
    l1_comment string, l2_comment string, notice_date string
"""

FINANCE = """
    code string, financing_purchase string, financing_repay string,
    financing_balance string, bond_sell string, bond_repay string,
    bond_balance string, notice_date string
"""

NEWS = "code string, mediaName string, title string, content string, notice_date string"

CHANCE = """
    code string, TOTAL_SCORE string, RISE_1_PROBABILITY string, AVERAGE_1_INCREASE string,
    RISE_5_PROBABILITY string, AVERAGE_5_INCREASE string, STOCK_RANK_RATIO string,
    WORDS_EXPLAIN string, notice_date string
"""

# Financial statements: every measure has a year-over-year column beside it.
REPORT_MEASURES = """
    monetary_funds total_current_assets total_noncurrent_assets total_current_liab
    total_noncurrent_liab total_equity total_operate_income total_operate_cost
    operate_profit total_profit netprofit total_compre_income netcash_operate
    netcash_invest netcash_finance end_cce
""".split()
REPORT_WIDE_YOY = "netcash_invest"

# The trade-tick table has no declaration of its own; these are the columns in use.
DEAL = "code string, buyorsale int, draw decimal(20,2), deal decimal(10,2), dealnum bigint"

# --- fixed values: derived (ORC) tables --------------------------------------
# Narrow decimals are widened: Spark raises on overflow where NULL was stored.

STEP_ONE = """
    code string, name string, closing_price decimal(10,2), last_closing decimal(10,2),
    highest decimal(20,5), lowest decimal(20,5), ds date, deal_amount decimal(20,5),
    closing_diff decimal(20,5), rk bigint, x decimal(10,2), i decimal(10,2),
    rsv decimal(32,10), sar_high decimal(20,5), sar_low decimal(20,5),
    tr decimal(20,5), dmp decimal(20,5), dmm decimal(20,5)
"""
PRICE_STREAKS = "code string, times bigint, sumrate decimal(20,2), tag int"
BALANCE_STREAKS = "code string, times bigint, sumprice decimal(32,4), tag int"
PRICE_SERIES = """
    code string, up_down_rate decimal(10,2), opening_price decimal(10,2),
    closing_price decimal(10,2), ds date, rk bigint
"""
RETURN_SERIES = "code string, up_down_rate decimal(10,3), ds date, rk bigint"
KLINES = "code string, tags bigint, kline string"
WEEKLY = "ups string, monday_result decimal(20,2), week_result decimal(20,2)"

# -----------------------------------------------------------------------------


def _report_ddl() -> str:
    columns = ["code string", "report_date string"]
    for measure in REPORT_MEASURES:
        yoy = "decimal(32,3)" if measure == REPORT_WIDE_YOY else "decimal(10,2)"
        columns += [f"{measure} decimal(32,3)", f"{measure}_yoy {yoy}"]
    return ", ".join(columns)


RAW: dict[str, str] = {
    "ods_calendar": CALENDAR,
    "ods_a_stock_history": HISTORY,
    "ods_a_stock_detail_day": DETAIL,
    "ods_a_stock_hour_kline": HOUR_KLINE,
    "ods_a_stock_company_info": COMPANY_EVENT,
    "ods_a_stock_finance_info": FINANCE,
    "ods_a_stock_news": NEWS,
    "ods_a_stock_chance_info": CHANCE,
    "ods_a_stock_report_info": _report_ddl(),
    "ods_a_stock_deal": DEAL,
}

DERIVED: dict[str, str] = {
    "ods_stock_step_one": STEP_ONE,
    "dwd_stock_continuation_up": PRICE_STREAKS,
    "dwd_finance_continuation_up": BALANCE_STREAKS,
    "ods_up_to_stop": PRICE_SERIES,
    "dwd_temp": RETURN_SERIES,
    "dwd_training_data": KLINES,
    "dwd_train": WEEKLY,
}


# --- fixed values: how a line is checked on load -----------------------------

# Columns without which a row means nothing.
REQUIRED: dict[str, tuple[str, ...]] = {
    **{name: ("code",) for name in RAW},
    "ods_calendar": ("ds",),
    "ods_a_stock_hour_kline": ("type", "code"),
    "ods_a_stock_report_info": ("code", "report_date"),
}

# Days, times and numbers that the raw layer keeps as text.
_DAY, _NUMBER = "date", "decimal(32,4)"
TEXT_VALUES: dict[str, dict[str, str]] = {
    "ods_calendar": {"ds": _DAY, "weekday": "int"},
    "ods_a_stock_detail_day": {"ds": _DAY},
    "ods_a_stock_company_info": {"notice_date": _DAY},
    "ods_a_stock_finance_info": {
        "financing_purchase": _NUMBER, "financing_repay": _NUMBER, "financing_balance": _NUMBER,
        "bond_sell": _NUMBER, "bond_repay": _NUMBER, "bond_balance": _NUMBER, "notice_date": _DAY,
    },
    "ods_a_stock_news": {"notice_date": "timestamp_ntz"},
    "ods_a_stock_chance_info": {
        "TOTAL_SCORE": _NUMBER, "RISE_1_PROBABILITY": _NUMBER, "AVERAGE_1_INCREASE": _NUMBER,
        "RISE_5_PROBABILITY": _NUMBER, "AVERAGE_5_INCREASE": _NUMBER, "STOCK_RANK_RATIO": _NUMBER,
        "notice_date": _DAY,
    },
    "ods_a_stock_report_info": {"report_date": _DAY},
}

# -----------------------------------------------------------------------------


def struct(ddl: str) -> T.StructType:
    """Parsed schema; Spark reads the text, so a session must be running."""
    return T.StructType.fromDDL(" ".join(ddl.split()))


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the schema's columns by name, cast to its types, in its order."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def _calendar(df: DataFrame) -> DataFrame:
    return (
        df.withColumn("ds", F.col("ds").try_cast("date"))
        .withColumn("weekday", F.col("weekday").try_cast("int"))
        .toDF(*[c.lower() for c in df.columns])
    )


def _history(df: DataFrame) -> DataFrame:
    # deal_amount holds the volume and deal_vol the money here, the other way round in detail.
    day = F.concat_ws("-", F.col("year").cast("string"), F.col("month_day"))
    return df.withColumnsRenamed({"deal_amount": "volume", "deal_vol": "amount"}).withColumn(
        "ds", day.try_cast("date")
    )


def _detail(df: DataFrame) -> DataFrame:
    lowered = df.toDF(*[c.lower() for c in df.columns])
    return lowered.withColumnsRenamed({"deal_amount": "amount", "deal_vol": "volume"}).withColumn(
        "ds", F.col("ds").try_cast("date")
    )


def _hour_kline(df: DataFrame) -> DataFrame:
    return df.where(F.col("type").isNotNull())


def _notice_day(df: DataFrame) -> DataFrame:
    return df.withColumn("notice_date", F.col("notice_date").try_cast("date"))


def _finance(df: DataFrame) -> DataFrame:
    numbers = [c for c in df.columns if c.startswith(("financing_", "bond_"))]
    return _notice_day(df.withColumns({c: to_decimal(F.col(c)) for c in numbers}))


def _news(df: DataFrame) -> DataFrame:
    lowered = df.toDF(*[c.lower() for c in df.columns])
    return lowered.withColumn("notice_date", F.col("notice_date").try_cast("timestamp_ntz"))


def _chance(df: DataFrame) -> DataFrame:
    lowered = df.toDF(*[c.lower() for c in df.columns])
    keep_text = {"code", "words_explain", "notice_date", "dt"}
    numbers = [c for c in lowered.columns if c not in keep_text]
    return _notice_day(lowered.withColumns({c: to_decimal(F.col(c)) for c in numbers}))


def _report(df: DataFrame) -> DataFrame:
    return df.withColumn("report_date", F.col("report_date").try_cast("date"))


def _deal(df: DataFrame) -> DataFrame:
    # a tick without a side counts for neither
    return df.withColumn("buyorsale", F.coalesce("buyorsale", F.lit(0)))


_CURATORS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "ods_calendar": _calendar,
    "ods_a_stock_history": _history,
    "ods_a_stock_detail_day": _detail,
    "ods_a_stock_hour_kline": _hour_kline,
    "ods_a_stock_company_info": _notice_day,
    "ods_a_stock_finance_info": _finance,
    "ods_a_stock_news": _news,
    "ods_a_stock_chance_info": _chance,
    "ods_a_stock_report_info": _report,
    "ods_a_stock_deal": _deal,
}


def curate(table: str, raw: DataFrame) -> DataFrame:
    """Type a raw frame: text dates and numbers parsed, volume and amount named alike."""
    curator = _CURATORS.get(table)
    return raw if curator is None else curator(raw)
