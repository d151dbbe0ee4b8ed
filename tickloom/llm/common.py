"""Shared helpers: the folder all executors see, stored intermediate tables, Arrow mappers."""

from __future__ import annotations

import ctypes
import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator, Sequence
from typing import Any

import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Rows turned into Python objects at a time.
SLICE = 512


# Sessions whose executors have been given the package.
_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors' Python workers this package, as a zip file sent by Spark."""
    if spark.sparkContext.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = os.path.join(tempfile.mkdtemp(prefix="tickloom-code-"), "tickloom_code.zip")
    with zipfile.ZipFile(target, "w") as out:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(package)))
    spark.sparkContext.addPyFile(target)
    _SHIPPED.add(spark.sparkContext.applicationId)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, which driver and executors share.

    Where the setting is missing and the master is local (tests), a temporary folder is
    used; on a cluster without it this raises.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="tickloom-llm-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


# Lets Spark remove the shuffle files of an execution at its end.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def stored(
    df: DataFrame, name: str, partition_by: Sequence[str] = (), free: bool = False, rows: int | None = None
) -> DataFrame:
    """The frame written as Parquet to the shared folder and read back: its lineage is cut.

    With ``free`` the shuffle files behind it go as soon as it is written. With ``rows``
    Python workers get so many rows at once; a batch of whole texts takes memory on both sides.
    """
    spark = df.sparkSession
    ship(spark)
    path = shared_folder(spark, name)
    settings = ({_CLEANUP: "true"} if free else {}) | ({_BATCH: str(rows)} if rows else {})
    before = {k: spark.conf.get(k, "false") if k == _CLEANUP else spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        df.write.partitionBy(*partition_by).parquet(path)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    back = spark.read.schema(df.schema).parquet(path)
    back.stored_at = path
    return back


def dropped(df: DataFrame) -> None:
    """Delete the files of a frame that ``stored`` made, once nothing reads it any more."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(df.stored_at)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def filesystem(uri: str) -> tuple[pa.fs.FileSystem, str]:
    """Inside a task: the file system of a shared folder and the path in it."""
    if uri.startswith("file:"):
        return pa.fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return pa.fs.FileSystem.from_uri(uri) if "://" in uri else (pa.fs.LocalFileSystem(), uri)


def stored_rows(path: str, rows: int) -> Iterator[pa.RecordBatch]:
    """Inside a task: what ``stored`` wrote to a folder, ``rows`` rows at a time."""
    files, top = filesystem(path)
    for part in files.get_file_info(pyarrow.fs.FileSelector(top, allow_not_found=True)):
        if part.path.endswith(".parquet"):
            with files.open_input_file(part.path) as source:
                yield from pyarrow.parquet.ParquetFile(source).iter_batches(rows)


def crc_mod(key: Column, n: int) -> Column:
    """crc32 of the key written as text, modulo ``n``; NULL for a NULL key."""
    return F.crc32(key.cast("string").cast("binary")) % n


def fields(ddl: str) -> list[T.StructField]:
    return T._parse_datatype_string(ddl).fields


# What a Python worker keeps from task to task, by name, and the names the task at hand asked for.
_KEPT: dict[Any, Any] = {}
_ASKED: set[Any] = set()


def kept(name: Any, build: Callable[[], Any]) -> Any:
    """Inside ``make``: an object that outlives the task, till its worker runs another kind of task."""
    if name not in _KEPT:
        _KEPT[name] = build()
    _ASKED.add(name)
    return _KEPT[name]


def started(make: Callable[[], Callable]) -> Callable:
    """The function of a task; what earlier tasks kept and this one doesn't ask for goes."""
    _ASKED.clear()
    fn = make()
    for name in set(_KEPT) - _ASKED:
        del _KEPT[name]
    return fn


def released() -> None:
    """Give what a task has freed back to the system: workers live on, and their peaks add up."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc's
    if trim is not None:
        trim(0)


def map_rows(
    df: DataFrame,
    keep: Sequence[str],
    make: Callable[[], Callable[[pa.RecordBatch], list[pa.Array]]],
    added: str,
    rows: int = SLICE,
) -> DataFrame:
    """Add columns (DDL ``added``) to the kept ones, ``rows`` rows at a time.

    ``make`` runs once per task and returns the function of a batch.
    """
    ship(df.sparkSession)
    kept = [df.schema[c] for c in keep]
    new = fields(added)
    schema = T.StructType(kept + new)
    names = [f.name for f in schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = started(make)
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in keep] + fn(part), names=names
                )
        fn = batch = part = None
        released()

    return df.mapInArrow(run, schema)


def map_batches(
    df: DataFrame,
    make: Callable[[], Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]]],
    schema: str,
    finish: bool = False,
    rows: int = SLICE,
) -> DataFrame:
    """Free mapping of batches; with ``finish`` the function is called once more with None."""
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = started(make)
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                yield from fn(batch.slice(at, rows))
        if finish:
            yield from fn(None)
        fn = batch = None
        released()

    return df.mapInArrow(run, schema)


def texts(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """A text column as UTF-8 bytes, NULL as empty."""
    return [t or b"" for t in batch.column(column).cast(pa.binary()).to_pylist()]
