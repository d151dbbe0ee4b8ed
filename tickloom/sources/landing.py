"""Landing of raw daily drops (tab-separated text, optionally gzip) into typed partitions."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.sources import warehouse
from tickloom.sources.schemas import RAW, REQUIRED, TEXT_VALUES, curate, struct

# The text format of the raw layer.
FOLDER_DATE = r"/(?:\w+=)?(\d{4}-\d{2}-\d{2})/[^/]*$"
# What no number holds: in it a cast fails at the cost of an exception, thousands of times
# that of a good one, so it isn't tried. Other characters are left to the cast.
NO_NUMBER = {"int": r"[!-*,./:-~]", "bigint": r"[!-*,./:-~]", "decimal": r"[!-*,/:-DF-df-~]"}
TSV_OPTIONS = {"sep": "\t", "nullValue": "\\N", "quote": "", "escape": "", "mode": "PERMISSIVE"}


def read_tsv(spark: SparkSession, path: str, table: str) -> DataFrame:
    """Raw rows of one table's drop; numbers that do not parse are NULL, ``.gz`` is read as is."""
    return spark.read.schema(struct(RAW[table])).options(**TSV_OPTIONS).csv(path)


def load_partition(
    spark: SparkSession, src: str, table: str, day: dt.date, target: str | None = None
) -> None:
    """Type the drop under ``src`` and make it partition ``dt=day``; a rerun replaces it."""
    warehouse.overwrite_partition(
        curate(table, read_tsv(spark, src, table)), target or table, day
    )


def read_dated_drops(spark: SparkSession, root: str, table: str) -> DataFrame:
    """All drops below ``root/<yyyy-MM-dd>/`` in one scan, ``dt`` taken from the folder name."""
    raw = (
        spark.read.schema(struct(RAW[table]))
        .options(**TSV_OPTIONS, recursiveFileLookup="true")
        .csv(root)
    )
    return curate(table, with_folder_date(raw))


def with_folder_date(raw: DataFrame) -> DataFrame:
    return raw.withColumn("dt", _folder_date())


def _folder_date() -> Column:
    # the pattern looks at the file's folder alone, at every row
    last = F.concat(F.lit("/"), F.substring_index("_metadata.file_path", "/", -2))
    return F.regexp_extract(last, FOLDER_DATE, 1).try_cast("date")


def load_dated_drops(
    spark: SparkSession, root: str, table: str, target: str | None = None
) -> None:
    """Backfill: every dated folder becomes its own partition in one job, no driver loop."""
    warehouse.overwrite_dynamic(read_dated_drops(spark, root, table), target or table)


def _held(field: Column) -> Column:
    """A field that holds something; empty and ``\\N``, as most fields of wide tables are, don't."""
    return F.when(~field.isin("", "\\N"), field)


def _read(field: Column, kind: str) -> Column:
    """A field's value, NULL where it has none: empty, ``\\N`` and what isn't of the kind."""
    text = F.trim(_held(field))
    hopeless = NO_NUMBER.get(kind.partition("(")[0])
    if hopeless:
        text = F.when((text != "") & ~text.rlike(hopeless), text)
    return text.try_cast(kind)


def _unread(field: Column, value: Column) -> Column:
    """Whether a field holds something that its type can't: empty and ``\\N`` hold nothing."""
    return value.isNull() & ~field.isin("", "\\N")


def _reason(table: str, names: list[str], types: dict[str, str]) -> Column:
    """Why a line is rejected; NULL for a good one. The first reason found counts."""
    checks = [F.when(F.size("_fields") != len(names), f"not {len(names)} columns")]
    field = {c: F.get("_fields", F.lit(i)) for i, c in enumerate(names)}
    for c in REQUIRED[table]:
        checks.append(F.when(F.coalesce(field[c].isin("", "\\N"), F.lit(True)), f"no {c}"))
    for c in names:
        kind = TEXT_VALUES.get(table, {}).get(c, types[c])
        if kind != "string":
            value = F.col(c) if kind == types[c] else _read(field[c], kind)
            checks.append(F.when(_unread(field[c], value), f"unreadable {c}"))
    if table == "ods_a_stock_history":
        known = [_held(field[c]) for c in ("year", "month_day")]
        checks.append(F.when(F.concat_ws("-", *known).try_cast("date").isNull(), "unreadable month_day"))
    return F.coalesce(*checks)


def checked_lines(spark: SparkSession, root: str, table: str) -> DataFrame:
    """The lines of all drops below ``root/<yyyy-MM-dd>/`` with their columns as declared.

    ``_reason`` says why a line can't be taken (see ``_reason``), ``_line`` and ``_file``
    what and where it is. ``.gz`` files are read as they are. A filter on the reason would
    be evaluated beside the columns, so that values are read twice: store the rows first.
    """
    declared = struct(RAW[table])
    types = {f.name: f.dataType.simpleString() for f in declared}
    names = list(types)
    lines = spark.read.option("recursiveFileLookup", "true").text(root)
    lines = lines.select(
        F.col("value").alias("_line"), F.col("_metadata.file_path").alias("_file"),
        _folder_date().alias("dt"), F.split("value", "\t", -1).alias("_fields"),
    )

    def read(i: int, name: str) -> Column:
        field = F.get("_fields", F.lit(i))
        if types[name] == "string":
            return _held(field).alias(name)
        return _read(field, types[name]).alias(name)

    values = [read(i, name) for i, name in enumerate(names)]
    typed = lines.select(*values, "dt", "_line", "_file", "_fields")
    return typed.select(*names, "dt", _reason(table, names, types).alias("_reason"), "_line", "_file")


def _stored(lines: DataFrame, path: str) -> DataFrame:
    """Checked lines written and read back, line and file only of rejected ones.

    The expressions of a wide table make a method that the JVM doesn't compile, from 8,000
    bytes on; below that limit Spark splits them.
    """
    spark, limit = lines.sparkSession, "spark.sql.codegen.hugeMethodLimit"
    bad = {c: F.when(F.col("_reason").isNotNull(), F.col(c)) for c in ("_line", "_file")}
    before = spark.conf.get(limit)
    spark.conf.set(limit, "8000")
    try:
        lines.withColumns(bad).write.orc(path)
    finally:
        spark.conf.set(limit, before)
    return spark.read.schema(lines.schema).orc(path)


def land(
    spark: SparkSession, root: str, table: str, target: str, rejects: str | None = None
) -> DataFrame:
    """Land every dated folder as its partition; lines that can't be taken go to ``rejects``.

    Each day's partitions of both tables are replaced, also where a day has no good or no
    bad line. ``rejects`` (by default the target's name with ``_rejects``) holds the line,
    its file and the reason. A file outside a dated folder raises before anything is
    written. Returns the lines taken (reason NULL) and rejected, by day and reason: together
    they are all lines. Lines are read and checked once; till both tables are written they
    lie in a folder of their own below ``spark.checkpoint.dir``.
    """
    rejects = rejects or f"{target}_rejects"
    lines = checked_lines(spark, root, table)
    places = {f: re.search(FOLDER_DATE, f) for f in lines.inputFiles()}  # names, no data
    undated = sorted(f for f, found in places.items() if not found)
    if undated:
        raise ValueError(f"{len(undated)} files lie in no dated folder, among them {undated[0]}")
    path = warehouse.shared_dir(spark, "checked")
    lines = _stored(lines, path)
    counts = lines.groupBy("dt", F.col("_reason").alias("reason")).count()
    counted = counts.collect()  # days times reasons
    columns = [f.name for f in struct(RAW[table])]
    good = curate(table, lines.where("_reason is null").select(*columns, "dt"))
    bad = lines.where("_reason is not null").select(
        F.col("_reason").alias("reason"), F.col("_line").alias("line"),
        F.regexp_extract("_file", "[^/]*$", 0).alias("file"), "dt",
    )
    days = {dt.date.fromisoformat(found[1]) for found in places.values()}
    for rows, name, taken in ((good, target, True), (bad, rejects, False)):
        warehouse.overwrite_dynamic(rows, name)
        for empty in days - {r.dt for r in counted if (r.reason is None) == taken}:
            warehouse.drop_partitions(spark, name, exact=empty)
    warehouse.delete(spark, path)
    schema = "source string, dt date, reason string, lines bigint"
    return spark.createDataFrame([(table, r.dt, r.reason, r["count"]) for r in counted], schema)
