"""URL filters: captures against list entries that were active when they were fetched.

DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm import common

BROADCAST_ENTRIES = 100_000  # entries up to which their intervals are broadcast
_OPEN_END = "9999-12-31 00:00:00"


def host(url: Column) -> Column:
    """Host of a URL in lower case, without user, port and closing dot; empty if there is none."""
    authority = F.regexp_extract(
        F.coalesce(url, F.lit("")), r"^\s*[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1
    )
    return F.rtrim(F.lower(authority), F.lit("."))


def depth(name: Column) -> Column:
    """Number of labels."""
    return F.size(F.split(name, r"\."))


def suffixes(name: Column, depths: list[int]) -> Column:
    """The host itself first, then its parent domains of ``depths`` labels."""
    labels = F.split(name, r"\.")
    shorter = F.filter(F.array(*map(F.lit, depths)).cast("array<int>"), lambda d: d < F.size(labels))
    parents = F.transform(shorter, lambda d: F.array_join(F.slice(labels, -d, d), "."))
    return F.concat(F.array(name), parents)


def validity(log: DataFrame) -> DataFrame:
    """Validity intervals of dated list changes (columns list, entry, action, at).

    Each 'add' holds from its date up to the next change of the same list and entry. Of
    changes at one time an 'add' wins; rows without entry, list or date say nothing.
    """
    known = log.where(
        F.col("entry").isNotNull() & F.col("list").isNotNull() & F.col("at").isNotNull()
    )
    at_once = known.groupBy("list", "entry", "at").agg(
        F.max((F.col("action") == "add").cast("int")).alias("_add")
    )
    order = Window.partitionBy("list", "entry").orderBy("at")
    until = F.coalesce(F.lead("at").over(order), F.lit(_OPEN_END).cast("timestamp"))
    return (
        at_once.withColumn("until", until)
        .where(F.col("_add") == 1)
        .select("list", F.lower("entry").alias("entry"), F.col("at").alias("since"), "until")
    )


def temporal_list_join(
    captures: DataFrame,
    log: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    time_col: str = "fetched_at",
) -> DataFrame:
    """Every capture with the lists that held its host or a parent domain when it was fetched.

    Returns one row per capture: id, url, host, lists (sorted), n_entries (active entries
    that match) and blocked. A capture without host or time matches nothing; repeated
    captures stay; an empty log blocks nothing; further columns are ignored.

    An entry's intervals are gathered into one sorted row, so a capture meets each of its
    domains once however often an entry came and went, and a host with many captures is
    on the side that Spark can split. Of the parent domains those are looked up whose number
    of labels some entry has, so none that an entry could match is left out.
    """
    entries = common.stored(
        validity(log)
        .groupBy(F.col("entry").alias("_entry"))
        .agg(F.sort_array(F.collect_list(F.struct("since", "until", "list"))).alias("_spans")),
        "list-entries",
    )
    small = entries.count() <= BROADCAST_ENTRIES
    depths = sorted(r[0] for r in entries.select(depth(F.col("_entry"))).distinct().collect())
    name = host(F.col(url_col))
    key = ["_id", "url", "_task"]
    base = captures.select(
        F.col(id_col).alias("_id"),
        F.col(url_col).alias("url"),
        F.spark_partition_id().alias("_task"),
        F.col(time_col).alias("_time"),
        name.alias("host"),
    )
    wide = base.select(*key, "_time", "host", F.posexplode(suffixes(F.col("host"), depths)).alias("_n", "_suffix"))
    met = wide.join(
        F.broadcast(entries) if small else entries, F.col("_suffix") == F.col("_entry"), "left"
    )
    active = F.filter("_spans", lambda s: (s.since <= F.col("_time")) & (F.col("_time") < s.until))
    active = F.coalesce(active, F.array().cast(entries.schema["_spans"].dataType))
    met = met.withColumn("_active", active).where((F.col("_n") == 0) | (F.size("_active") > 0))
    per_capture = met.groupBy(*key, "_time", "host").agg(
        F.sum(F.when(F.col("_n") == 0, 1).otherwise(0)).alias("_times"),
        # equal captures of one task are in here together: each brings its entries again
        F.sum(F.size("_active")).alias("_entries"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.col("_active.list"))))).alias("lists"),
    )
    return per_capture.select(
        F.col("_id").alias(id_col),
        "url",
        "host",
        "lists",
        (F.col("_entries") / F.col("_times")).cast("long").alias("n_entries"),
        (F.size("lists") > 0).alias("blocked"),
        F.explode(F.expr("sequence(1, _times)")).alias("_again"),
    ).drop("_again")
