"""Market tables derived from the supplied parquet tables.

``events`` play the daily detail, news, company events and financing of 30 days;
``lineitem`` plays several years of bars and the trade ticks; ``customer``,
``supplier`` and ``nation`` give the board of a code; ``orders`` the financial reports.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.operators.series import one_row_per_day
from tickloom.sources.schemas import RAW, struct

# The last day covered by the events.
AS_OF = dt.date(2024, 1, 30)
# The snapshot label of the bulk history.
HISTORY_DT = dt.date(2001, 12, 31)
# The boards screened by default.
BOARDS = ("2", "3")

# Columns read from each table; naming them saves a schema-inference job per read.
TABLES = {
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
        "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz"
    ),
    "customer": "c_custkey bigint, c_nationkey int",
    "supplier": "s_suppkey bigint, s_nationkey int",
    "nation": "n_nationkey int, n_regionkey int",
}

# Raw tables whose stand-ins cover years.
BULK = (
    "ods_calendar", "ods_a_stock_history", "ods_a_stock_hour_kline", "ods_a_stock_report_info",
    "ods_a_stock_deal",
)

# Up to eight digits, a decimal sum runs on plain longs.
MONEY = "decimal(10,2)"


def _sequence_key(*parts: tuple[str, int]) -> str:
    """Several non-negative integers as one decimal that sorts like the tuple.

    ``parts`` are (expression, decimal digits). A decimal fits into the fixed-width
    aggregation buffer, so min_by/max_by on it run as a hash aggregate, where a
    struct key would need a sort before each aggregation step.
    """
    key = ""
    for expression, digits in parts:
        number = f"cast({expression} as decimal({digits},0))"
        moved = f"{key} * cast({10**digits} as decimal(19,0)) + " if key else ""
        key = f"cast({moved}{number} as decimal(38,0))"
    return key


def _flow(kind: str, name: str) -> str:
    amount = f"sum(if(event_type = '{kind}', v - 50, 0))"
    return f"cast({amount} as decimal(18,2)) as {name}"


def _aggregate(df: DataFrame, keys: list[str], *measures: str) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.expr(m) for m in measures])


class Market:
    """Lazy frames over one folder of parquet tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def _read(self, table: str) -> DataFrame:
        return self.spark.read.schema(TABLES[table]).parquet(f"{self.folder}/{table}.parquet")

    @cached_property
    def ev(self) -> DataFrame:
        return self._read("events").selectExpr(
            "event_id",
            "ts",
            "event_type",
            "cast(user_id as string) as code",
            "to_date(ts) as ds",
            f"cast(value as {MONEY}) as v",
        )

    def _with_board(self, df: DataFrame, table: str, key: str, nation_key: str) -> DataFrame:
        boards = (
            self._read(table)
            .withColumnRenamed(nation_key, "n_nationkey")
            .join(self._read("nation"), "n_nationkey")
            .selectExpr(f"cast({key} as string) as code", "cast(n_regionkey as string) as board")
        )
        return df.join(boards, "code", "left")

    @cached_property
    def detail(self) -> DataFrame:
        """One row per user and day."""
        micros = "timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)"
        events = self.ev.selectExpr("*", f"{_sequence_key((micros, 19), ('event_id', 18))} as at")
        days = _aggregate(
            events,
            ["code", "ds"],
            "min_by(v, at) as opening_price",
            "max_by(v, at) as current_price",
            "max(v) as highest",
            "min(v) as lowest",
            "count(1) as volume",
            "cast(sum(v) as decimal(18,2)) as amount",
            _flow("purchase", "main_inflow"),
            _flow("view", "slarge_inflow"),
            _flow("click", "large_inflow"),
            _flow("signup", "mid_inflow"),
            _flow("error", "small_inflow"),
        )
        move = "round(try_divide((current_price - opening_price) * 100, opening_price), 2)"
        priced = days.selectExpr(
            "*",
            "ds as dt",
            "concat('S', code) as name",
            f"cast({move} as decimal(18,2)) as up_down_rate",
            "cast(volume as decimal(10,2)) as turnover_rate",
            "amount * 100 as total_market_v",
            "amount * 60 as circulation_market_v",
            "volume * 1000 as tradable_shares",
        )
        rows = self._with_board(priced, "customer", "c_custkey", "c_nationkey")
        return one_row_per_day(rows)  # grouped by them above

    @cached_property
    def history(self) -> DataFrame:
        """One row per supplier and ship day, several years, one snapshot."""
        at = _sequence_key(("l_orderkey", 17), ("l_linenumber", 3), ("l_partkey", 17))
        lines = self._read("lineitem").selectExpr(
            "cast(l_suppkey as string) as code",
            "to_date(l_shipdate) as ds",
            f"{at} as at",
            f"cast(l_extendedprice as {MONEY}) as v",
            f"cast(l_quantity as {MONEY}) as qty",
            "cast(l_discount as decimal(4,2)) - cast(l_tax as decimal(4,2)) as drift",
        )
        days = _aggregate(
            lines,
            ["code", "ds"],
            "min_by(v, at) as opening_price",
            "max_by(v, at) as closing_price",
            "max(v) as highest",
            "min(v) as lowest",
            "cast(sum(qty) as decimal(18,2)) as volume",
            "cast(sum(v) as decimal(18,2)) as amount",
            "cast(round(sum(drift) * 100 / count(1), 2) as decimal(10,2)) as up_down_rate",
        )
        rows = days.selectExpr(
            "*",
            "concat('S', code) as name",
            "cast(year(ds) as bigint) as year",
            "date_format(ds, 'MM-dd') as month_day",
            f"date'{HISTORY_DT}' as dt",
        )
        return one_row_per_day(rows)

    @cached_property
    def history_loads(self) -> DataFrame:
        """The bars in three overlapping loads: an old one, the bulk, and late corrections."""
        bulk = self.history.drop("month_day", "year")
        # the mark of the bulk doesn't hold for the stack
        bulk = bulk.withMetadata("code", {})
        prices = ("opening_price", "closing_price", "highest", "lowest")

        def moved(rows: DataFrame, days: int, by: str) -> DataFrame:
            shift = {c: F.expr(f"cast({c} + {by} as {MONEY})") for c in prices}
            return rows.withColumns({**shift, "dt": F.lit(HISTORY_DT + dt.timedelta(days=days))})

        late = moved(bulk.where("dayofmonth(ds) % 2 = 1"), 30, "(dayofmonth(ds) - 8)")
        return moved(bulk, -30, "1").unionByName(bulk).unionByName(late)

    @cached_property
    def long_detail(self) -> DataFrame:
        """The bars in daily-detail layout, with the supplier's board."""
        bars = self.history.selectExpr(
            "code",
            "ds",
            "ds as dt",
            "closing_price as current_price",
            "opening_price",
            "up_down_rate",
            "volume as turnover_rate",
        )
        return self._with_board(bars, "supplier", "s_suppkey", "s_nationkey")

    @cached_property
    def calendar(self) -> DataFrame:
        """Every day of the bars and events; weekends closed."""
        shipped = self._read("lineitem").selectExpr("to_date(l_shipdate) as ds").distinct()
        happened = self._read("events").selectExpr("to_date(ts) as ds").distinct()
        works = "weekday(ds) < 5"
        return (
            shipped.unionByName(happened)
            .distinct()
            .selectExpr(
                "ds",
                "weekday(ds) + 1 as weekday",
                "cast(weekofyear(ds) as bigint) as weekofyear",
                "concat('Z', cast(year(ds) % 12 as string)) as chinesezodiac",
                f"cast({works} as bigint) as astatus",
                f"cast({works} and dayofmonth(ds) <> 1 as bigint) as hkstatus",
                f"cast({works} and dayofmonth(ds) <> 4 as bigint) as usastatus",
            )
        )

    @cached_property
    def notice(self) -> DataFrame:
        return self.ev.where("event_type in ('signup', 'error')")

    @cached_property
    def company_events(self) -> DataFrame:
        return self.notice.selectExpr(
            "code",
            "event_type",
            "concat('e', cast(event_id as string)) as specific_eventtype",
            "ds as notice_date",
            "ds as dt",
        )

    @cached_property
    def news(self) -> DataFrame:
        return self.notice.selectExpr(
            "code",
            "event_type as medianame",
            "if(event_type = 'signup', concat('n', cast(event_id as string)), null) as title",
            "ts as notice_date",
            "ds as dt",
        )

    @cached_property
    def finance(self) -> DataFrame:
        days = _aggregate(
            self.ev,
            ["code", "ds"],
            "cast(sum(if(event_type = 'purchase', v, 0)) as decimal(18,2)) as financing_purchase",
            "cast(sum(if(event_type = 'click', v, 0)) as decimal(18,2)) as financing_repay",
            "cast(sum(v) as decimal(18,2)) as financing_balance",
        )
        rows = days.selectExpr(
            "code",
            "financing_purchase",
            "financing_repay",
            "financing_balance",
            "ds as notice_date",
            "ds as dt",
        )
        return one_row_per_day(rows, "notice_date")

    @cached_property
    def finance_text(self) -> DataFrame:
        """Financing rows as they lie in the raw layer: everything is text."""
        return self.finance.selectExpr(
            "code",
            "cast(financing_purchase as string) as financing_purchase",
            "cast(financing_repay as string) as financing_repay",
            "cast(financing_balance as string) as financing_balance",
            "cast(null as string) as bond_sell",
            "cast(null as string) as bond_repay",
            "cast(null as string) as bond_balance",
            "cast(notice_date as string) as notice_date",
        )

    @cached_property
    def report(self) -> DataFrame:
        """Yearly figures per customer with the change against the year before."""
        orders = self._read("orders").selectExpr(
            "cast(o_custkey as string) as code",
            "year(o_orderdate) as year",
            "cast(o_totalprice as decimal(12,2)) as total",
            "o_orderstatus as status",
        )
        years = _aggregate(
            orders,
            ["code", "year"],
            "cast(sum(total) as decimal(18,2)) as total_operate_income",
            "max(total) as total_current_assets",
            "min(total) as monetary_funds",
            "cast(sum(if(status = 'F', total, 0)) as decimal(18,2)) as netcash_operate",
            "cast(sum(if(status <> 'O', total, 0)) as decimal(18,2)) as operate_profit",
        )
        measures = [c for c in years.columns if c not in ("code", "year")]
        before = "over (partition by code order by year)"
        moves = [f"{m} - lag({m}) {before}" for m in measures]
        yoy = [
            f"cast(round(try_divide(({move}) * 100, lag({m}) {before}), 2) as decimal(18,2)) "
            f"as {m}_yoy"
            for m, move in zip(measures, moves, strict=True)
        ]
        return years.selectExpr("*", *yoy, "concat(year, '-12-31') as report_date")

    @cached_property
    def chance(self) -> DataFrame:
        return self.detail.selectExpr(
            "code",
            "cast(amount as decimal(32,4)) as total_score",
            "cast(current_price as decimal(32,4)) as stock_rank_ratio",
            "ds as notice_date",
            "dt",
        )

    @cached_property
    def deal(self) -> DataFrame:
        """Trade ticks: one per order line."""
        return self._read("lineitem").selectExpr(
            "cast(l_suppkey as string) as code",
            "to_date(l_shipdate) as dt",
            "case when l_returnflag = 'R' then 2 when l_returnflag = 'A' then 1 "
            "when l_linestatus = 'O' then 4 else 0 end as buyorsale",
            "cast(floor(l_extendedprice / 50) as int) as draw",
            "cast(l_quantity as decimal(7,2)) as deal",
            "cast(l_linenumber as bigint) as dealnum",
        )

    def raw_lines(self) -> dict[str, DataFrame]:
        """Drops of all raw tables: (line, day), some lines cut short or with a broken value.

        Each raw column is filled from a column of the same meaning where there is one. Of
        every seven codes one has its lines cut by the last column, of every eleven one has
        ``?`` for its first number or day.
        """
        detail = self.detail.withColumnsRenamed({"volume": "deal_vol", "amount": "deal_amount"})
        bars = self.history.withColumnsRenamed({"volume": "deal_amount", "amount": "deal_vol"})
        minute = self.deal.selectExpr(
            "code", "dt", "buyorsale as type", "draw as current_price", "cast(deal as string) as trends"
        )
        days = self.calendar.selectExpr(
            "*", "ds as dt", "cast(dayofyear(ds) as string) as code"
        )
        sources = {
            "ods_calendar": (days, "ds"),
            "ods_a_stock_history": (bars.withColumn("dt", F.col("ds")), "closing_price"),
            "ods_a_stock_detail_day": (detail, "current_price"),
            "ods_a_stock_hour_kline": (minute, "current_price"),
            "ods_a_stock_company_info": (self.company_events, "notice_date"),
            "ods_a_stock_finance_info": (self.finance, "financing_purchase"),
            "ods_a_stock_news": (self.news, "notice_date"),
            "ods_a_stock_chance_info": (self.chance, "TOTAL_SCORE"),
            "ods_a_stock_report_info": (
                self.report.withColumn("dt", F.expr("make_date(year, 12, 31)")), "report_date",
            ),
            "ods_a_stock_deal": (self.deal, "draw"),
        }
        drops = {}
        for table, (rows, broken) in sources.items():
            have = {c.lower() for c in rows.columns}
            fields = []
            for field in struct(RAW[table]):
                value = F.col(field.name).cast("string") if field.name.lower() in have else F.lit(None)
                if field.name.lower() == broken.lower():
                    value = F.when(F.col("code") % 11 == 5, "?").otherwise(value)
                fields.append(F.coalesce(value, F.lit("\\N")))
            cut = F.when(F.col("code") % 7 == 3, F.concat_ws("\t", *fields[:-1]))
            line = F.coalesce(cut, F.concat_ws("\t", *fields))
            # the bulk lies by year, so that days don't become thousands of folders
            day = F.trunc("dt", "year") if table in BULK else F.col("dt")
            drops[table] = rows.select(line.alias("line"), day.alias("day"))
        return drops
