"""Properties of the physical plans that matter at scale."""

import contextlib
import re

import pytest
from pyspark.sql import functions as F

from tests.compare import SF
from tests.frames import day, rows
from tickloom.functions import by_code
from tickloom.operators import indicators, patterns, scans, screens, series, streaks
from tickloom.operators.joins import left_join_splittable
from tickloom.plans import catalog, jobs
from tickloom.plans.market import Market
from tickloom.sources import warehouse


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@contextlib.contextmanager
def conf(spark, **options):
    names = {k.replace("__", "."): v for k, v in options.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_no_cross_join_and_no_python(spark, name):
    # Write jobs run on their own inputs; what is planned here is the final read.
    plan = plan_of(catalog.queries()[name](spark, SF))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas"):
        assert bad not in plan, bad


def test_streak_plan_shuffles_by_day_then_by_code(spark):
    plan = plan_of(catalog.queries()["price_streaks_history"](spark, SF))
    keyed = re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", plan)
    keyed = [re.sub(r"#\d+L?", "", k) for k in keyed]
    # Bars by (code, ds), everything after that by code; the rest builds the calendar.
    assert sorted(k for k in keyed if "code" in k) == ["code", "code, ds"]
    assert set(keyed) <= {"code", "code, ds", "ds"}
    assert "SortMergeJoin" not in plan


def test_only_needed_columns_are_read(spark):
    plan = plan_of(indicators.hhv_llv(Market(spark, SF).history))
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    assert "ReadSchema: struct<l_suppkey:bigint,l_extendedprice:double,l_shipdate:timestamp_ntz>" in scan


def test_day_predicate_prunes_partitions(spark, tmp_path):
    warehouse.create_database(spark, "prune_db", str(tmp_path / "db"))
    warehouse.append_dynamic(Market(spark, SF).detail, "prune_db.detail")
    from tickloom.operators import screens
    from tickloom.plans.market import AS_OF

    plan = plan_of(screens.gainers(spark.table("prune_db.detail"), AS_OF))
    spark.sql("DROP DATABASE prune_db CASCADE")
    filters = next(line for line in plan.splitlines() if "PartitionFilters" in line)
    assert "dt" in filters.split("PartitionFilters: [")[1].split("]")[0]


def test_bucketed_bars_need_no_exchange(spark, tmp_path):
    bars = Market(spark, SF).history.select(
        "code", "name", "closing_price", "highest", "lowest", "ds", "amount", "dt"
    )
    warehouse.create_database(spark, "bucket_db", str(tmp_path / "db"))
    warehouse.create_table(spark, "bucket_db.bars", bars.schema, buckets=4)
    warehouse.append_dynamic(bars, "bucket_db.bars")
    got = indicators.stock_step_one(spark.table("bucket_db.bars"))
    plan, stored = plan_of(got), rows(got, "code", "ds", "rsv", "tr")
    spark.sql("DROP DATABASE bucket_db CASCADE")
    assert "Exchange" not in plan
    assert stored == rows(indicators.stock_step_one(bars), "code", "ds", "rsv", "tr")


def test_hot_right_key_is_split(spark):
    """A third of the right side on one key: the join stage is cut, the result is whole."""
    with conf(
        spark,
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="10KB",
        spark__sql__shuffle__partitions="16",
    ):
        left = spark.range(200).select(F.col("id").cast("string").alias("code"), F.lit(1).alias("l"))
        right = spark.range(0, 60000, 1, 8).select(
            F.when(F.rand(1) < 0.34, "7").otherwise((F.col("id") % 150).cast("string")).alias("code"),
            F.concat(F.lit("title "), F.col("id").cast("string")).alias("title"),
        )
        got = left_join_splittable(left, right, ["code"])
        assert len(got.collect()) == 60000 + 50
        assert "skew=true" in got._jdf.queryExecution().executedPlan().toString()


def hash_exchanges(df) -> list[str]:
    keyed = re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", plan_of(df))
    return [re.sub(r"#\d+L?", "", k) for k in keyed]


SERIES = {
    "prev_close_diff": indicators.prev_close_diff,
    "hhv_llv": indicators.hhv_llv,
    "rsv": indicators.rsv,
    "sar_bounds": indicators.sar_bounds,
    "true_range": indicators.true_range,
    "directional_move": indicators.directional_move,
    "stock_step_one": indicators.stock_step_one,
    "price_streaks": lambda h: streaks.price_streaks(
        h.withColumnRenamed("closing_price", "current_price"),
        h.sparkSession.sql(
            "select explode(sequence(date'1992-01-01', date'1998-12-31')) ds, 1L astatus"
        ),
        None,
        lookback=None,
    ),
    "kline_signs": lambda h: patterns.kline_signs(series.latest_per_day(h).withColumn(
        "rk", F.row_number().over(by_code()))),
    "window_rows": lambda h: patterns.window_rows(series.latest_per_day(h).withColumn(
        "rk", F.row_number().over(by_code()))),
}


@pytest.fixture(scope="module")
def bars(spark, tmp_path_factory):
    """The three overlapping loads as they are, as a flat table and as the clustered bars table."""
    loads = Market(spark, SF).history_loads
    folder = tmp_path_factory.mktemp("bars")
    loads.write.parquet(str(folder / "loads"))
    raw = spark.read.parquet(str(folder / "loads"))
    warehouse.create_database(spark, "bars_db", str(folder / "db"))
    jobs.fill_bars(raw, "bars_db.bars", buckets=4)
    series.latest_per_day(raw).write.parquet(str(folder / "flat"))
    flat = series.one_row_per_day(spark.read.parquet(str(folder / "flat")))
    yield raw, flat, warehouse.scan(spark, "bars_db.bars")
    spark.sql("DROP DATABASE bars_db CASCADE")


@pytest.mark.parametrize("name", sorted(SERIES))
def test_exchanges_of_full_series(bars, name):
    raw, flat, stored = bars
    form = SERIES[name]
    calendar_only = [k for k in hash_exchanges(form(stored)) if "code" in k]
    assert not calendar_only  # clustered by code, one row per day
    assert [k for k in hash_exchanges(form(flat)) if "code" in k] == ["code"]
    assert [k for k in hash_exchanges(form(raw)) if "code" in k] == ["code, ds", "code"] or [
        k for k in hash_exchanges(form(raw)) if "code" in k
    ] == ["code", "code, ds"]


@pytest.mark.parametrize("name", sorted(SERIES))
def test_full_series_agree_on_all_layouts(bars, name):
    raw, flat, stored = (rows(SERIES[name](df)) for df in bars)
    assert raw == flat == stored and raw


def test_loads_are_reduced_by_hash_before_the_shuffle(bars):
    raw, _, _ = bars
    plan = plan_of(indicators.hhv_llv(raw))
    below = plan[plan.index("hashpartitioning(code"):]
    below = below[below.index("ds#"):]
    first = below.index("HashAggregate")
    assert "partial_max_by" in below and "Sort" not in below[first:]
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    read = scan.split("ReadSchema: struct<")[1]
    assert {c.split(":")[0] for c in re.sub(r"decimal\(\d+,\d+\)", "decimal", read.rstrip(">")).split(",")} == {
        "code", "ds", "dt", "highest", "lowest"
    }


def test_columns_of_one_load_stay_together(spark):
    """Rows of one load that differ: the one taken is a whole row, whatever the order."""
    rows_ = [("a", 1, 2), ("a", 3, 4), ("a", 5, None), ("a", None, 8)]
    frame = spark.createDataFrame(rows_, "code string, x int, y int").selectExpr(
        "*", "date'2024-01-01' as ds", "date'2024-01-02' as dt"
    )
    found = {tuple(series.latest_per_day(frame.repartition(n)).select("code", "x", "y").first()) for n in (1, 2, 4)}
    assert len(found) == 1 and found < set(rows_)


def test_two_left_joins_shuffle_the_movers_once(spark):
    m = Market(spark, SF)
    detail, news, report = m.detail, m.news, m.report
    with conf(
        spark,
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
    ):
        folder = warehouse.shared_dir(spark, "e4")
        for name, df in (("detail", detail), ("news", news), ("report", report)):
            df.write.parquet(f"{folder}/{name}")
        tables = [spark.read.parquet(f"{folder}/{n}") for n in ("detail", "news", "report")]
        for form in (screens.mover_news_report, screens.strong_mover_report):
            got = form(*tables)
            got.collect()
            final = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
            made = re.findall(r"(?<!Reused)Exchange \w+", final)
            assert 4 <= len(made) <= 8, made


def test_growth_screens_reduce_the_codes_before_the_windows(spark):
    m = Market(spark, SF)
    for screen in (
        streaks.growth_screen(
            m.detail, m.finance, m.news, day("2024-01-29"), day("2024-01-26"), day("2024-01-26"), []
        ),
        streaks.growth_screen_days(m.detail, m.finance, m.news, m.calendar),
    ):
        tree = screen._jdf.queryExecution().optimizedPlan().toString()
        windows = [i for i, line in enumerate(tree.splitlines()) if "lag(" in line and "Window [" in line]
        assert windows
        assert any("LeftSemi" in line for line in tree.splitlines()[windows[0]:windows[0] + 8])


def test_returns_are_reduced_before_the_semi_join(spark):
    """Raw copies of a code meet by (code, ds) first, not by code."""
    m = Market(spark, SF)
    loads = m.history_loads.withColumn("year", F.year("ds"))
    with conf(
        spark,
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
    ):
        tree = plan_of(series.return_series(loads, m.detail, ["2"], board_dt=day("2024-01-30"))).splitlines()
    join = next(i for i, line in enumerate(tree) if "LeftSemi" in line)
    assert any("max_by" in line for line in tree[join : join + 8])


def test_a_code_reads_one_bucket(spark, tmp_path):
    warehouse.create_database(spark, "code_db", str(tmp_path / "db"))
    warehouse.load_clustered(Market(spark, SF).news, "code_db.news", buckets=8)
    got = scans.code_lookup(warehouse.scan(spark, "code_db.news"), "7")
    found, read = got.count(), got.select(F.input_file_name()).distinct().count()
    # a scan for which the order of buckets doesn't count doesn't print them
    with conf(spark, spark__sql__sources__bucketing__autoBucketedScan__enabled="false"):
        plan = plan_of(scans.code_lookup(warehouse.scan(spark, "code_db.news"), "7"))
    options = spark.sql("DESCRIBE FORMATTED code_db.news").where("col_name = 'Storage Properties'").first()
    spark.sql("DROP DATABASE code_db CASCADE")
    assert "SelectedBucketsCount: 1 out of 8" in plan and "EqualTo(code,7)" in plan
    assert found == Market(spark, SF).news.where("code = '7'").count() > 0 and read == 1
    assert "orc.bloom.filter.columns=code" in options.data_type
