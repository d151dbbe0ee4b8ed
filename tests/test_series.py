from pyspark.sql import functions as F

from tests.frames import day, dec, detail, history, rows
from tickloom.operators import scans, series


def hist(spark, items):
    return (
        history(spark, [(c, d, p, p, p) for c, d, p, _ in items])
        .join(
            spark.createDataFrame(
                [(c, day(d), dec(r)) for c, d, _, r in items],
                "code string, ds date, up_down_rate decimal(10,2)",
            ),
            ["code", "ds"],
        )
        .withColumns(
            {"year": F.year("ds"), "opening_price": F.col("closing_price"), "volume": F.lit(1)}
        )
    )


def test_price_series_is_numbered_over_both_sources(spark):
    h = hist(spark, [("a", "2022-01-03", 1, 1), ("a", "2022-01-04", 2, 1)])
    d = detail(spark, [("a", "2023-01-03", 3), ("b", "2023-01-03", 4)])
    got = series.price_series(h, d)
    assert rows(got, "code", "ds", "closing_price", "rk") == [
        ("a", day("2022-01-03"), dec("1.00"), 1),
        ("a", day("2022-01-04"), dec("2.00"), 2),
        ("a", day("2023-01-03"), dec("3.00"), 3),
        ("b", day("2023-01-03"), dec("4.00"), 1),
    ]
    assert rows(series.series_length(got)) == [("a", 3), ("b", 1)]


def test_return_series_filters(spark):
    h = hist(
        spark,
        [
            ("a", "2016-01-04", 1, 1),
            ("a", "2022-01-03", 1, 0),
            ("a", "2022-01-04", 1, 2),
            ("x", "2022-01-04", 1, 2),
        ],
    )
    d = detail(
        spark,
        [
            ("a", "2022-12-12", 5, 3, "2"),
            ("a", "2022-12-13", 0, 3, "2"),
            ("x", "2022-12-12", 5, 3, "9"),
        ],
    )
    got = series.return_series(h, d, ["2", "6"], 2017, day("2022-12-12"))
    assert rows(got, "code", "ds", "rk") == [
        ("a", day("2022-01-04"), 1),
        ("a", day("2022-12-12"), 2),
    ]


def test_carry_forward_takes_price_from_kline_and_rest_from_before(spark):
    h = hist(spark, [("a", "2022-08-31", 7, 2), ("new", "2022-08-31", 1, 1)]).withColumn(
        "dt", F.col("ds")
    )
    d = detail(spark, [("a", "2022-08-30", 5), ("gone", "2022-08-30", 5)])
    got = series.carry_forward(h, d, day("2022-08-31"), day("2022-08-30"))
    assert rows(got, "code", "ds", "dt", "current_price", "t_1_price", "board") == [
        ("a", day("2022-08-31"), day("2022-08-31"), dec("7.00"), dec("5.00"), "2")
    ]


def test_daily_append_splits_the_day(spark):
    d = detail(spark, [("a", "2022-08-31", 5), ("a", "2022-08-30", 5)]).withColumns(
        {"volume": F.lit(1), "amount": F.lit(2)}
    )
    got = series.daily_append(d, day("2022-08-31"))
    assert rows(got, "code", "dk_total", "year", "month_day", "dt") == [
        ("a", 0, 2022, "08-31", day("2022-08-31"))
    ]


def test_scans(spark):
    d = detail(spark, [("a", "2022-08-31", 5), ("a", "2022-08-30", 0), ("b", "2022-08-31", 0)])
    assert rows(scans.row_count(d)) == [(3,)]
    assert rows(scans.traded_count(d, day("2022-08-31"))) == [(1,)]
    assert scans.partition_scan(d, day("2022-08-31")).count() == 2
    assert scans.code_lookup(d, "a").count() == 2
    assert scans.code_lookup(d, ["a", "b"]).count() == 3
    assert scans.preview(d, 2).count() == 2
    assert rows(scans.preview(d, 1, ["ds", "code"]), "ds") == [(day("2022-08-30"),)]
