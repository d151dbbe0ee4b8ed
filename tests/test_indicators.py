from tests.frames import day, dec, history, rows
from tickloom.operators import indicators

BARS = [
    ("a", "2024-01-01", 10, 11, 9),
    ("a", "2024-01-02", 12, 13, 10),
    ("a", "2024-01-03", 11, 12, 8),
    ("a", "2024-01-04", 15, 16, 14),
    ("a", "2024-01-05", 15, 15, 15),
    ("b", "2024-01-01", 5, 5, 5),
]


def test_first_row_defaults(spark):
    got = indicators.prev_close_diff(history(spark, BARS))
    assert rows(got.where("code = 'b'"), "last_closing", "closing_diff") == [(dec("5.00"), dec(0))]
    assert rows(got.where("ds = date'2024-01-02' and code = 'a'"), "closing_diff") == [
        (dec("2.00"),)
    ]


def test_null_predecessor_stays_null(spark):
    h = history(spark, [("a", "2024-01-01", None, 2, 1), ("a", "2024-01-02", 3, 4, 2)])
    got = indicators.prev_close_diff(h)
    assert rows(got, "ds", "last_closing") == [
        (day("2024-01-01"), None),
        (day("2024-01-02"), None),
    ]
    # The spread alone is known then.
    assert rows(indicators.true_range(h), "tr") == [(dec("1.00"),), (dec("2.00"),)]


def test_flat_range_reads_zero(spark):
    got = indicators.rsv(history(spark, BARS))
    assert float(rows(got.where("code = 'b'"), "rsv")[0][0]) == 0.0
    second = rows(got.where("code = 'a' and ds = date'2024-01-02'"), "rsv")[0][0]
    assert round(float(second), 6) == 75.0


def test_window_of_highs_is_bounded(spark):
    h = history(spark, [("a", f"2024-01-{i:02d}", 1, 100 - i, i) for i in range(1, 13)])
    last = rows(indicators.hhv_llv(h).where("ds = date'2024-01-12'"), "hhv", "llv")
    assert last == [(dec("96.00"), dec("4.00"))]


def test_sar_frame_switches_after_start(spark):
    got = rows(indicators.sar_bounds(history(spark, BARS)).where("code = 'a'"), "ds", "sar_low")
    assert [float(v) for _, v in got] == [9, 9, 8, 8, 14]


def test_directional_move_keeps_only_the_larger(spark):
    got = rows(
        indicators.directional_move(history(spark, BARS)).where("code = 'a'"), "ds", "dmp", "dmm"
    )
    assert [(float(p), float(m)) for _, p, m in got] == [(0, 0), (2, 0), (0, 2), (4, 0), (0, 0)]


def test_step_one_is_one_window_over_one_exchange(spark):
    h = history(spark, BARS)
    step = indicators.stock_step_one(h)
    assert len(step.columns) == 18 and step.count() == len(BARS)
    plan = step._jdf.queryExecution().executedPlan().toString()
    indicator_windows = [
        line for line in plan.splitlines() if " Window [" in line and "lag(" in line
    ]
    assert len(indicator_windows) == 1
    assert plan.count("Exchange hashpartitioning(code") == 2  # dedupe on (code, ds), then code
