"""Incremental landing: follow the folder of daily drops as a file stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tickloom.sources.landing import TSV_OPTIONS, with_folder_date
from tickloom.sources.schemas import RAW, curate, struct


def stream_drops(spark: SparkSession, root: str, table: str) -> DataFrame:
    """Typed rows of every new file below ``root/<yyyy-MM-dd>/``, ``dt`` from the folder."""
    raw = spark.readStream.schema(struct(RAW[table])).options(**TSV_OPTIONS).csv(f"{root}/*")
    return curate(table, with_folder_date(raw))


def follow_drops(
    spark: SparkSession, root: str, table: str, target: str, checkpoint: str
) -> StreamingQuery:
    """Land what has arrived since the last run into ``target/dt=.../`` and stop.

    The checkpoint records the files that are done and the sink log the files that
    were committed, so a run that dies half-way is repeated without loss or copies.
    """
    return (
        stream_drops(spark, root, table)
        .writeStream.format("orc")
        .option("compression", "snappy")
        .option("checkpointLocation", checkpoint)
        .partitionBy("dt")
        .trigger(availableNow=True)
        .start(target)
    )
