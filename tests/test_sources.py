import gzip
import os

import pytest
from pyspark.sql import functions as F

from tests.frames import calendar, day, dec, detail, finance, history, rows
from tickloom.plans import jobs
from tickloom.sources import landing, schemas, warehouse


@pytest.fixture
def db(spark, tmp_path):
    name = "t_" + os.path.basename(tmp_path).replace("-", "_")[-40:]
    warehouse.create_database(spark, name, str(tmp_path / "db"))
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def write(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with gzip.open(os.path.join(folder, name), "wt") as f:
        f.write("\n".join(lines) + "\n")


def test_every_raw_schema_parses(spark):
    widths = {t: len(schemas.struct(ddl)) for t, ddl in schemas.RAW.items()}
    assert widths["ods_a_stock_detail_day"] == 60  # 59 declared columns and the board
    assert widths["ods_a_stock_report_info"] == 34
    assert len(schemas.struct(schemas.DERIVED["ods_stock_step_one"])) == 18


def test_load_partition_types_text_and_replaces(spark, db, tmp_path):
    drop = str(tmp_path / "drop")
    write(drop, "part.gz", ["a\t9.25\t1\t10.5\t\\N\t\t7\t2024-01-02", "b\tbad\t1\t2\t0\t0\t0\tx"])
    table = f"{db}.finance"
    for _ in range(2):  # the rerun replaces the partition
        landing.load_partition(
            spark, drop, "ods_a_stock_finance_info", day("2024-01-03"), table
        )
    got = warehouse.scan(spark, table, day("2024-01-03"))
    assert rows(got, "code", "financing_purchase", "bond_sell", "notice_date") == [
        ("a", dec("9.2500"), None, day("2024-01-02")),
        ("b", None, dec("0.0000"), None),
    ]


def test_dated_drops_become_partitions(spark, db, tmp_path):
    root = str(tmp_path / "root")
    for d in ("2024-01-02", "2024-01-03"):
        write(os.path.join(root, d), "p.gz", [f"a\tm\tt{d}\tc\t{d} 15:00:00"])
    table = f"{db}.news"
    landing.load_dated_drops(spark, root, "ods_a_stock_news", table)
    assert rows(spark.table(table), "title", "dt") == [
        ("t2024-01-02", day("2024-01-02")),
        ("t2024-01-03", day("2024-01-03")),
    ]


def test_history_and_detail_agree_on_volume_and_amount(spark):
    h = schemas.curate(
        "ods_a_stock_history",
        spark.createDataFrame(
            [("a", dec(1), dec(2), 2022, "08-31")],
            "code string, deal_amount decimal(20,5), deal_vol decimal(32,10), year bigint, "
            "month_day string",
        ),
    )
    assert rows(h, "volume", "amount", "ds") == [(dec("1.00000"), dec("2E+0"), day("2022-08-31"))]
    d = schemas.curate(
        "ods_a_stock_detail_day",
        spark.createDataFrame(
            [("a", dec(1), dec(2), "2022-08-31")],
            "code string, deal_amount decimal(20,5), deal_vol decimal(20,5), ds string",
        ),
    )
    assert rows(d, "volume", "amount") == [(dec("2.00000"), dec("1.00000"))]


def test_minute_bars_need_a_type(spark):
    raw = spark.createDataFrame([(None, "a"), (1, "b")], "type bigint, code string")
    assert rows(schemas.curate("ods_a_stock_hour_kline", raw), "code") == [("b",)]


def test_overwrite_leaves_other_partitions_and_can_empty_one(spark, db):
    table = f"{db}.t"
    frame = spark.createDataFrame([("a", 1)], "code string, n int")
    warehouse.overwrite_partition(frame, table, day("2024-01-01"))
    warehouse.overwrite_partition(frame, table)
    warehouse.overwrite_partition(frame.limit(0), table)
    assert rows(spark.table(table), "dt") == [(day("2024-01-01"),)]
    warehouse.append_partition(frame, table, day("2024-01-01"))
    assert spark.table(table).count() == 2


def test_dynamic_overwrite_touches_only_its_days(spark, db):
    table = f"{db}.t"
    fin = finance(spark, [("a", f"2024-01-0{i}", i, 0, 0) for i in (1, 2, 3)])
    warehouse.append_dynamic(fin, table)
    warehouse.overwrite_dynamic(fin.where("dt = date'2024-01-02'").withColumn(
        "code", F.lit("z")), table)
    assert rows(spark.table(table), "dt", "code") == [
        (day("2024-01-01"), "a"),
        (day("2024-01-02"), "z"),
        (day("2024-01-03"), "a"),
    ]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").upper() == "STATIC"


def test_drop_partitions(spark, db):
    table = f"{db}.t"
    warehouse.append_dynamic(
        finance(spark, [("a", f"2024-01-0{i}", i, 0, 0) for i in range(1, 7)]), table
    )
    assert warehouse.drop_partitions(spark, table, exact=day("2024-01-06")) == [day("2024-01-06")]
    warehouse.drop_partitions(spark, table, first=day("2024-01-02"), last=day("2024-01-04"))
    assert warehouse.drop_partitions(spark, table, exact=day("2030-01-01")) == []
    assert rows(spark.table(table), "dt") == [(day("2024-01-01"),), (day("2024-01-05"),)]
    with pytest.raises(ValueError):
        warehouse.drop_partitions(spark, table)


def test_truncate_reload_and_export(spark, db, tmp_path):
    cal = calendar(spark, "2024-01-01", 3)
    warehouse.truncate_reload(cal, f"{db}.cal")
    warehouse.truncate_reload(cal.limit(2), f"{db}.cal")
    assert spark.table(f"{db}.cal").count() == 2
    warehouse.export_csv(cal, str(tmp_path / "csv"))
    assert spark.read.csv(str(tmp_path / "csv"), header=True).count() == 3


def test_jobs_fill_their_tables(spark, db, tmp_path):
    cal = calendar(spark, "2024-01-14", 20)
    days = ["2024-01-22", "2024-01-23", "2024-01-24"]
    d = detail(spark, [("a", ds, 10 + i, i + 1) for i, ds in enumerate(days)]).withColumns(
        {"volume": F.lit(1), "amount": F.lit(2)}
    )
    h = history(spark, [("a", "2024-01-22", 1, 2, 1)])
    as_of = day("2024-01-24")

    jobs.fill_price_streaks(d, cal, f"{db}.up", as_of)
    assert rows(spark.table(f"{db}.up"), "code", "times", "tag", "dt") == [
        ("a", 3, 1, warehouse.CURRENT)
    ]
    jobs.fill_price_streaks(d, cal, f"{db}.up", day("2024-01-23"))  # two days only: no streak
    assert spark.table(f"{db}.up").count() == 0

    fin = finance(spark, [("a", ds, 0, 0, i) for i, ds in enumerate(days)])
    jobs.fill_balance_streaks(fin, d, f"{db}.bal", day("2024-01-25"))
    assert spark.table(f"{db}.bal").count() == 1

    jobs.fill_step_one(h, f"{db}.step", as_of)
    once = spark.table(f"{db}.step").count()
    jobs.fill_step_one(h, f"{db}.step", as_of)
    assert spark.table(f"{db}.step").count() == once  # a rerun replaces its partition
    jobs.fill_history(d, f"{db}.hist")
    assert spark.table(f"{db}.step").count() == 1 and spark.table(f"{db}.hist").count() == 3

    past = h.withColumns(
        {"up_down_rate": F.lit(1).cast("decimal(10,2)"), "opening_price": F.col("lowest"),
         "year": F.year("ds"), "ds": F.date_sub("ds", 30)}
    )
    jobs.fill_price_series(past, d, f"{db}.prices", as_of)
    jobs.fill_return_series(past, d, f"{db}.temp", None)
    assert rows(spark.table(f"{db}.temp"), "rk") == [(1,), (2,), (3,), (4,)]
    jobs.fill_klines(spark.table(f"{db}.temp"), f"{db}.train", as_of, width=2)
    assert spark.table(f"{db}.train").count() == 3
    assert spark.table(f"{db}.prices").count() == 4

    rates = spark.createDataFrame(
        [("a", dec(1), day("2024-01-15") + (day(x) - day("2024-01-22")))
         for x in ("2024-01-22", "2024-01-23", "2024-01-24", "2024-01-25", "2024-01-26",
                   "2024-01-29", "2024-01-30", "2024-01-31", "2024-02-01", "2024-02-02")],
        "code string, up_down_rate decimal(10,3), ds date",
    )
    out = str(tmp_path / "weekly")
    jobs.fill_weekly_training(rates, cal, f"{db}.weekly", export_to=out)
    assert spark.read.csv(out, header=True).count() == 1

    jobs.rebuild_snapshot(
        past.withColumns({"dt": F.lit(day("2024-01-25")), "ds": F.lit(day("2024-01-25")),
                          "volume": F.lit(1)}),
        d, f"{db}.detail", day("2024-01-25"), as_of,
    )
    assert rows(spark.table(f"{db}.detail"), "t_1_price", "dt") == [
        (dec("12.00"), day("2024-01-25"))
    ]


def test_a_rerun_of_the_bulk_history_replaces_it(spark, db):
    table = f"{db}.hist"
    h = history(spark, [("a", "2024-01-02", 1, 2, 1), ("a", "2024-01-03", 2, 2, 1), ("b", "2024-02-01", 3, 3, 1)])
    for _ in range(2):
        warehouse.repartition_history(h.drop("dt"), table)
    assert rows(spark.table(table), "code", "closing_price", "dt") == [
        ("a", dec("1.00"), day("2024-01-02")),
        ("a", dec("2.00"), day("2024-01-03")),
        ("b", dec("3.00"), day("2024-02-01")),
    ]
    warehouse.repartition_history(h.drop("dt"), f"{db}.months", unit="month")
    assert rows(spark.table(f"{db}.months"), "ds", "dt")[1] == (day("2024-01-03"), day("2024-01-01"))
    with pytest.raises(ValueError):
        warehouse.repartition_history(h.withColumn("ds", F.lit(None).cast("date")), table)


def test_a_failed_overwrite_changes_nothing(spark, db):
    table = f"{db}.hist"
    h = history(spark, [("a", f"2024-01-0{i}", i, i, i) for i in range(1, 7)]).drop("dt")
    warehouse.repartition_history(h, table)
    before = rows(spark.table(table))
    breaks = F.when(F.col("closing_price") > 4, F.raise_error(F.lit("broken")).cast("string")).otherwise("other")
    with pytest.raises(Exception, match="broken"):
        warehouse.repartition_history(h.withColumn("name", breaks), table)
    assert rows(spark.table(table)) == before
    # the session's own mode is never switched, so other loads in it aren't disturbed
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").upper() == "STATIC"


def test_landing_keeps_what_it_rejects(spark, db, tmp_path):
    root, table = str(tmp_path / "root"), f"{db}.ods_a_stock_finance_info"
    good = "a\t9.25\t1\t10.5\t\\N\t\t7\t2024-01-02"
    lines = [good, "b\tbad\t1\t2\t0\t0\t0\t2024-01-02", "c\t1\t2", "\\N\t1\t1\t2\t0\t0\t0\t2024-01-02",
             "d\t1\t1\t2\t0\t0\t0\t2024-13-02", good + "\textra", ""]
    write(f"{root}/2024-01-03", "p.gz", lines)
    write(f"{root}/2024-01-04", "p.gz", ["x"])
    counts = landing.land(spark, root, "ods_a_stock_finance_info", table)
    assert rows(counts, "dt", "reason", "lines") == [
        (day("2024-01-03"), None, 1),
        (day("2024-01-03"), "no code", 1),
        (day("2024-01-03"), "not 8 columns", 3),
        (day("2024-01-03"), "unreadable financing_purchase", 1),
        (day("2024-01-03"), "unreadable notice_date", 1),
        (day("2024-01-04"), "not 8 columns", 1),
    ]
    assert rows(spark.table(table), "code", "financing_purchase", "bond_sell", "notice_date", "dt") == [
        ("a", dec("9.2500"), None, day("2024-01-02"), day("2024-01-03"))
    ]
    assert rows(spark.table(f"{table}_rejects"), "line", "file")[-1] == ("x", "p.gz")
    # the drops come again, mended: nothing of the first landing stays
    write(f"{root}/2024-01-03", "p.gz", ["x"])
    write(f"{root}/2024-01-04", "p.gz", [good, good])
    landing.land(spark, root, "ods_a_stock_finance_info", table)
    assert rows(spark.table(table), "dt") == [(day("2024-01-04"),)] * 2
    assert rows(spark.table(f"{table}_rejects"), "dt", "line") == [(day("2024-01-03"), "x")]
    write(f"{root}/undated", "p.gz", [good])
    with pytest.raises(ValueError, match="1 files"):
        landing.land(spark, root, "ods_a_stock_finance_info", table)
    assert spark.table(table).count() == 2


@pytest.mark.parametrize("table", sorted(schemas.RAW))
def test_landing_takes_a_line_of_every_raw_table(spark, db, tmp_path, table):
    """A line of plain values is taken, and typed the same as by the plain reader."""
    values = {"string": "7", "date": "2024-01-02", "timestamp_ntz": "2024-01-02 10:00:00"}
    fields = []
    for field in schemas.struct(schemas.RAW[table]):
        kind = schemas.TEXT_VALUES.get(table, {}).get(field.name, field.dataType.simpleString())
        fields.append({"year": "2024", "month_day": "01-02"}.get(field.name, values.get(kind, "3")))
    write(str(tmp_path / "root/2024-01-03"), "p.gz", ["\t".join(fields)])
    landing.land(spark, str(tmp_path / "root"), table, f"{db}.{table}")
    landed = spark.table(f"{db}.{table}")
    read = landing.read_dated_drops(spark, str(tmp_path / "root"), table)
    assert rows(landed.select(*sorted(landed.columns))) == rows(read.select(*sorted(read.columns)))
    assert landed.count() == 1 and spark.table(f"{db}.{table}_rejects").count() == 0


def test_lines_are_checked_once(spark, db, tmp_path, monkeypatch):
    """Counts, good lines and rejects come from one pass over the drops, which leaves no folder."""
    root, table = str(tmp_path / "root"), f"{db}.ods_a_stock_finance_info"
    good = "a\t1.5\t2\t3\t\\N\t\\N\t\\N\t2024-01-02"
    write(f"{root}/2024-01-03", "p.gz", [good, good, good, good.replace("1.5", "?"), "c"])
    passed, real = spark.sparkContext.accumulator(0), landing.checked_lines

    def counted(*args):
        lines = real(*args)

        def count(batches):
            for batch in batches:
                passed.add(batch.num_rows)
                yield batch

        return lines.mapInArrow(count, lines.schema)

    monkeypatch.setattr(landing, "checked_lines", counted)
    monkeypatch.setattr(warehouse, "shared_dir", lambda *_: str(tmp_path / "checked"))
    counts = landing.land(spark, root, "ods_a_stock_finance_info", table)
    assert rows(counts, "reason", "lines") == [
        (None, 3), ("not 8 columns", 1), ("unreadable financing_purchase", 1),
    ]
    assert spark.table(table).count() == 3 and spark.table(f"{table}_rejects").count() == 2
    assert passed.value == 5
    assert not (tmp_path / "checked").exists()


@pytest.mark.parametrize("kind", ["int", "bigint", "decimal(10,2)", "decimal(32,4)", "date"])
def test_values_read_like_a_cast(spark, kind):
    """Texts that no cast is tried for are those for which it gives NULL."""
    texts = [
        None, "", " ", "\\N", "?", "12", " 12 ", "\t12\r", "+12", "-12", "1-2", "--1", "12.00", ".5", "5.",
        "1e3", "1E-2", "1e", "e1", "0x1F", "1f", "1d", "12L", "1,000", "1_000", "NaN", "Infinity", "\x0012\x7f",
        "٣", "１２", "99999999999999999999", "2024-01-02", "2024-1-2", "2024-01-02T00:00", "1 2", " 12",
    ]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    read = rows.select("t", landing._read(F.col("t"), kind).alias("a"), F.trim("t").try_cast(kind).alias("b"))
    assert [r for r in read.collect() if r.a != r.b] == []


def test_folder_dates_look_at_the_folder_alone(spark, tmp_path):
    """The same days as by the pattern over whole paths, which costs more than a line's split."""
    root = tmp_path / "2020-01-01" / "dt=2020-01-02"
    for folder in ("2024-01-02", "dt=2024-01-03", "a=b=2024-01-04", "2024-01-05x", "no/2024-01-06", "2024-01-07/x", "2024-13-01"):
        write(str(root / folder), "part=2024-02-02.txt.gz", ["1"])
    lines = spark.read.option("recursiveFileLookup", "true").text(str(root))
    whole = F.regexp_extract("_metadata.file_path", landing.FOLDER_DATE, 1).try_cast("date")
    found = lines.select(landing._folder_date().alias("a"), whole.alias("b"))
    assert [r for r in found.collect() if r.a != r.b] == []
    assert {r.a for r in found.collect() if r.a} == {day(f"2024-01-0{i}") for i in (2, 3, 6)}
    plan = found.select("a")._jdf.queryExecution().optimizedPlan().toString()
    assert "substring_index" in plan


def test_empty_fields_go_before_they_are_looked_at(spark):
    """Fields that hold nothing, most of a wide table's, are neither trimmed nor matched."""
    read = spark.range(1).select(landing._read(F.col("id").cast("string"), "decimal(10,2)").alias("a"))
    plan = read._jdf.queryExecution().analyzed().toString()
    assert "trim(CASE WHEN" in plan


def test_indicators_are_written_without_another_exchange(spark, db, monkeypatch):
    """The windows' tasks write their wide rows themselves."""
    hints, real = [], type(spark.range(1)).hint
    monkeypatch.setattr(type(spark.range(1)), "hint", lambda df, *a: hints.append(a) or real(df, *a))
    bars = history(spark, [("a", "2024-01-02", 2, 3, 1), ("a", "2024-01-03", 3, 4, 2)])
    for _ in range(2):  # a rerun replaces
        jobs.fill_step_one(bars, f"{db}.ods_stock_step_one", day("2024-01-03"))
    assert hints == []
    assert spark.table(f"{db}.ods_stock_step_one").count() == 2
