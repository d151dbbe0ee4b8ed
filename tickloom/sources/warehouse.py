"""Partitioned ORC tables: create, append, overwrite one partition, drop, reload, export.

Tables live in a database whose location is given by the caller, so on a cluster
they are on shared storage. The partition column is always ``dt`` (a date).
"""

from __future__ import annotations

import datetime as dt
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.operators.series import ONE_ROW_PER, one_row_per_day

# Fixed value: the partition that holds the current snapshot of a derived table.
CURRENT = dt.date(9999, 12, 31)


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``.

    Without that setting a local temp folder serves a local master; a cluster raises.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="tickloom-")
    return os.path.join(root, f"{name}-{uuid.uuid4().hex}")


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder of ``shared_dir`` that nothing reads any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def create_database(spark: SparkSession, name: str, location: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{location}'")


def create_table(
    spark: SparkSession,
    table: str,
    schema: T.StructType,
    partitioned: bool = True,
    buckets: int | None = None,
    one_row_per: str | None = None,
    bloom: bool = False,
) -> None:
    """Declare an ORC + snappy table with named, typed columns.

    ``buckets`` clusters the rows by code. Operators that group, window or join by
    code then read their input already distributed and plan no exchange for it, and a
    literal code reads one bucket. ``one_row_per`` states the day column of which a code
    has one row; ``scan`` marks its frames with it. ``bloom`` adds Bloom filters on code,
    by which a lookup skips the stripes of other codes.
    """
    kept = [f for f in schema if f.name != "dt" or not partitioned]
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    options = "compression 'snappy'"
    if bloom:
        options += ", 'orc.bloom.filter.columns' 'code', 'orc.bloom.filter.fpp' '0.01'"
    clauses = [
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}{', dt date' if partitioned else ''})",
        f"USING orc OPTIONS ({options})",
    ]
    if partitioned:
        clauses.append("PARTITIONED BY (dt)")
    if buckets is not None:
        order = "code, ds" if "ds" in schema.names else "code"
        clauses.append(f"CLUSTERED BY (code) SORTED BY ({order}) INTO {buckets} BUCKETS")
    if one_row_per is not None:
        clauses.append(f"TBLPROPERTIES ('{ONE_ROW_PER}' = '{one_row_per}')")
    spark.sql(" ".join(clauses))


def _ensure(df: DataFrame, table: str, partitioned: bool = True) -> None:
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        create_table(spark, table, df.schema, partitioned)


def _columns(spark: SparkSession, table: str) -> list[str]:
    return [c for c in spark.table(table).columns if c != "dt"]


def _insert_static(
    df: DataFrame, table: str, day: dt.date, verb: str, rebalanced: bool = True
) -> None:
    _ensure(df, table)
    names = ", ".join(f"`{c}`" for c in _columns(df.sparkSession, table))
    df.sparkSession.sql(
        f"INSERT {verb} TABLE {table} PARTITION (dt = DATE'{day.isoformat()}') "
        f"SELECT {names} FROM {{rows}}",
        # AQE sizes the files; without it there would be one for each shuffle partition
        rows=df.hint("rebalance") if rebalanced else df,
    )


def overwrite_partition(
    df: DataFrame, table: str, day: dt.date = CURRENT, rebalanced: bool = True
) -> None:
    """Replace one named partition; an empty frame empties it, other partitions stay.

    Without ``rebalanced`` the frame's own tasks write. That saves an exchange where AQE has
    sized them already, as after a window over raw rows.
    """
    _insert_static(df, table, day, "OVERWRITE", rebalanced)


def append_partition(df: DataFrame, table: str, day: dt.date) -> None:
    """Add rows to one named partition."""
    _insert_static(df, table, day, "INTO")


def _overwriting_session(spark: SparkSession) -> SparkSession:
    """A session of its own that replaces only the partitions it writes.

    Spark takes the mode of an insert into a catalog table from the session alone, so the
    caller's session, in which other loads may run, is left as it is.
    """
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if key.startswith("spark.sql.") and spark.conf.isModifiable(key):
            own.conf.set(key, value)
    own.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    return own


def _insert_dynamic(df: DataFrame, table: str, overwrite: bool) -> None:
    _ensure(df, table)
    names = [f"`{c}`" for c in _columns(df.sparkSession, table)]
    # One writer per day keeps file counts low; AQE cuts a day that is too large
    # for one task into several, so a hot day does not become one long task.
    spread = df.hint("rebalance", "dt")
    rows = spread.select(*names, "dt")
    if not overwrite:
        rows.write.insertInto(table)
        return
    view = f"rows_{uuid.uuid4().hex}"
    rows.createGlobalTempView(view)
    try:
        _overwriting_session(df.sparkSession).sql(
            f"INSERT OVERWRITE TABLE {table} PARTITION (dt) SELECT * FROM global_temp.{view}"
        )
    finally:
        df.sparkSession.catalog.dropGlobalTempView(view)


def append_dynamic(df: DataFrame, table: str) -> None:
    """Add rows to the partitions named by their own ``dt``."""
    _insert_dynamic(df, table, overwrite=False)


def overwrite_dynamic(df: DataFrame, table: str) -> None:
    """Replace exactly the partitions that occur in ``df``.

    Spark writes them to a staging folder of the job and moves each into its place when
    all tasks have ended, so a failed attempt leaves the table as it was and a rerun
    doesn't double it.
    """
    _insert_dynamic(df, table, overwrite=True)


def repartition_history(
    history: DataFrame, table: str, day: str = "ds", unit: str = "day"
) -> None:
    """Lay a bulk history out by the day of its rows; a rerun replaces what it wrote.

    ``unit`` "month" or "year" labels partitions by the first day of it instead, where a
    day's rows would make files too small; the day then stays a column. Rows without a day
    can't be placed and raise.
    """
    if history.where(F.col(day).isNull()).limit(1).count():
        raise ValueError(f"rows without {day} have no partition")
    placed = history
    if unit != "day":
        placed = history.withColumn("dt", F.trunc(day, unit))
    elif day != "dt":
        placed = history.withColumn("dt", F.col(day)).drop(day)
    overwrite_dynamic(placed, table)


def drop_partitions(
    spark: SparkSession,
    table: str,
    exact: dt.date | None = None,
    first: dt.date | None = None,
    last: dt.date | None = None,
) -> list[dt.date]:
    """Drop one partition, or every partition in the closed range; returns the dropped days."""
    if exact is not None:
        first = last = exact
    if first is None and last is None:
        raise ValueError("name a partition or a range")
    present = [
        dt.date.fromisoformat(row.partition.split("=", 1)[1])
        for row in spark.sql(f"SHOW PARTITIONS {table}").collect()  # partition names, no data
    ]
    doomed = [
        d for d in present if (first is None or d >= first) and (last is None or d <= last)
    ]
    if doomed:
        specs = ", ".join(f"PARTITION (dt = DATE'{d.isoformat()}')" for d in doomed)
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {specs}")
    return doomed


def truncate_reload(df: DataFrame, table: str) -> None:
    """Empty an unpartitioned dimension and fill it again in one overwrite."""
    _ensure(df, table, partitioned=False)
    names = ", ".join(f"`{c}`" for c in df.sparkSession.table(table).columns)
    df.sparkSession.sql(f"INSERT OVERWRITE TABLE {table} SELECT {names} FROM {{rows}}", rows=df)


def export_csv(df: DataFrame, path: str, header: bool = True) -> None:
    """Write a frame as CSV part files, in parallel."""
    df.write.mode("overwrite").option("header", str(header).lower()).csv(path)


def scan(spark: SparkSession, table: str, day: dt.date | None = None) -> DataFrame:
    """A table, or one of its partitions; marked if it has one row per code and day."""
    rows = spark.table(table)
    properties = spark.sql(f"SHOW TBLPROPERTIES {table}").collect()  # the declaration, no data
    for name, value in properties:
        if name == ONE_ROW_PER:
            rows = one_row_per_day(rows, value)
    return rows if day is None else rows.where(F.col("dt") == F.lit(day))


def load_clustered(df: DataFrame, table: str, buckets: int, one_row_per: str | None = None) -> None:
    """Fill an unpartitioned table clustered by code, with Bloom filters; a rerun replaces it.

    The rows are dealt by the same hash as the buckets, so every task writes one file and
    the files of a bucket stay few.
    """
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        create_table(spark, table, df.schema, False, buckets, one_row_per, bloom=True)
    names = ", ".join(f"`{c}`" for c in spark.table(table).columns)
    spark.sql(
        f"INSERT OVERWRITE TABLE {table} SELECT {names} FROM {{rows}}",
        rows=df.repartition(buckets, "code"),
    )
