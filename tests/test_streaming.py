from tests.frames import day, dec, rows
from tests.test_sources import write
from tickloom.streaming.drops import follow_drops

TABLE = "ods_a_stock_finance_info"


def test_each_drop_lands_once(spark, tmp_path):
    root, target, done = (str(tmp_path / n) for n in ("root", "target", "checkpoint"))

    def run():
        query = follow_drops(spark, root, TABLE, target, done)
        assert query.awaitTermination(120)
        return spark.read.orc(target)

    write(f"{root}/2024-01-02", "p1.gz", ["a\t9.25\t1\t2\t0\t0\t0\t2024-01-01"])
    assert run().count() == 1
    write(f"{root}/2024-01-02", "p2.gz", ["b\t1\t1\t2\t0\t0\t0\t2024-01-01"])
    write(f"{root}/2024-01-03", "p1.gz", ["a\t2\t1\t2\t0\t0\t0\t2024-01-02"])
    run()
    got = run()  # nothing new
    assert rows(got, "code", "dt", "financing_purchase") == [
        ("a", day("2024-01-02"), dec("9.2500")),
        ("a", day("2024-01-03"), dec("2.0000")),
        ("b", day("2024-01-02"), dec("1.0000")),
    ]
