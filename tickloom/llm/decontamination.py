"""Benchmark decontamination with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm import common

# What separates words, as a regular expression and as the characters themselves.
_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_SEPARATOR_CHARS = "".join(
    map(chr, [*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])
)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

BROADCAST_WINDOWS = 2_000_000  # windows up to which they are broadcast: some 100 MB
BROADCAST_ROWS = 200_000  # contaminated documents up to which they are


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case; other letters stay."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))


def words(text: Column) -> Column:
    """Runs of digits, ASCII letters in lower case and non-ASCII characters; NULL has none."""
    inner = F.btrim(lower_ascii(F.coalesce(text, F.lit(""))), F.lit(_SEPARATOR_CHARS))
    none = F.array().cast("array<string>")
    return F.when(inner == "", none).otherwise(F.split(inner, _SEPARATORS))


def windows(benchmark: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    """Distinct windows of the items: size, hash, their words, the ids of items that hold them."""
    items = benchmark.select(
        F.col(id_col).cast("string").alias("_item"), words(F.col(text_col)).alias("_w")
    ).where(F.size("_w") > 0)
    size = F.least(F.size("_w"), F.lit(width))
    starts = F.explode(F.sequence(F.lit(1), F.size("_w") - size + 1))
    cut = items.select("_item", "_w", size.alias("_size"), starts.alias("_at"))
    cut = cut.select("_item", "_size", F.slice("_w", F.col("_at"), F.col("_size")).alias("_words"))
    return cut.groupBy("_size", "_words").agg(F.collect_set("_item").alias("_items")).withColumn(
        "_hash", F.xxhash64("_words")
    )


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    width: int = 13,
    share: int = 20,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
) -> DataFrame:
    """Words of every document that occur inside a benchmark window, and the items hit.

    Returns one row per input row: id, n_words, n_hit, items (ids as strings, sorted),
    contaminated (``n_hit > 0 and share * n_hit >= n_words``), and text_hash.

    A window is ``width`` consecutive words of an item; a shorter item is one window.
    The document's window hashes are looked up in a broadcast hash set, hits are verified
    by comparing words. NULL and empty texts have no words, items without words or with a
    NULL id match nothing; repeated items count once, repeated documents stay rows of
    their own; empty tables give no rows or no hits; further columns are ignored.
    """
    cut = common.stored(
        windows(benchmark.where(F.col(item_col).isNotNull()), width, item_col, text_col), "windows"
    )
    # at most ``width`` different sizes, and the number of windows
    sizes = {row._size: row.n for row in cut.groupBy("_size").agg(F.count("*").alias("n")).collect()}
    small = sum(sizes.values()) <= BROADCAST_WINDOWS
    maybe_broadcast = F.broadcast if small else (lambda df: df)

    # A document is its id, the hash of its text and the task that reads it.
    text = F.coalesce(F.col(text_col), F.lit(""))
    key = ["_id", "text_hash", "_task"]
    base = docs.select(
        F.col(id_col).alias("_id"),
        F.xxhash64(text).alias("text_hash"),
        F.spark_partition_id().alias("_task"),
        words(F.col(text_col)).alias("_w"),
    )
    at = base.select(*key, F.size("_w").alias("n_words"), "_w", F.posexplode_outer("_w").alias("_pos", "_"))
    found = []
    for size in sorted(sizes):
        piece = F.slice("_w", F.col("_pos") + 1, F.lit(size))
        fits = F.col("_pos") + size <= F.col("n_words")
        known = cut.where(F.col("_size") == size).select(F.col("_hash").alias(f"_known{size}")).distinct()
        at = at.withColumn(f"_hash{size}", F.when(fits, F.xxhash64(piece)))
        at = at.join(maybe_broadcast(known), F.col(f"_hash{size}") == F.col(f"_known{size}"), "left")
        found.append(
            F.when(
                F.col(f"_known{size}").isNotNull(),
                F.struct(
                    F.lit(size).alias("size"), F.col(f"_known{size}").alias("hash"), piece.alias("words")
                ),
            )
        )
    hits = F.filter(F.array(*found), lambda x: x.isNotNull()) if found else F.array()
    first = F.coalesce(F.col("_pos"), F.lit(0)) == 0
    anything = [F.col(f"_known{size}").isNotNull() for size in sizes]
    keep = first
    for some in anything:
        keep = keep | some
    rows = at.where(keep).select(*key, "n_words", "_pos", first.alias("_first"), hits.alias("_hits"))
    if found:
        rows = rows.select(
            *key, "n_words", "_pos", "_first", F.posexplode_outer("_hits").alias("_n", "_hit")
        )
        # one row of a document's first word counts the document
        rows = rows.withColumn("_first", F.col("_first") & (F.coalesce("_n", F.lit(0)) == 0))
        verified = cut.select(
            F.col("_hash").alias("_vh"), F.col("_words").alias("_vw"), F.col("_items").alias("_vi")
        )
        rows = rows.join(
            maybe_broadcast(verified),
            (F.col("_hit.hash") == F.col("_vh")) & (F.col("_hit.words") == F.col("_vw")),
            "left",
        )
        span = F.when(
            F.col("_vh").isNotNull(),
            F.struct(F.col("_pos").alias("a"), (F.col("_pos") + F.col("_hit.size")).alias("b")),
        )
    else:
        span = F.lit(None).cast("struct<a:int,b:int>")
        rows = rows.withColumn("_vi", F.lit(None).cast("array<string>"))
    per_doc = rows.groupBy(*key).agg(
        F.max("n_words").cast("long").alias("n_words"),
        F.sum(F.col("_first").cast("int")).alias("_times"),
        F.sort_array(F.collect_set(span)).alias("_spans"),  # at most one per word and size
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("_vi")))).alias("items"),
    )
    # Length of the union of the spans, which are sorted by their start.
    union = F.aggregate(
        "_spans",
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda s, x: F.struct(
            (s.n + F.greatest(x.b - F.greatest(x.a, s.end), F.lit(0))).alias("n"),
            F.greatest(s.end, x.b).alias("end"),
        ),
        lambda s: s.n,
    )
    n_hit = union.cast("long")
    counted = per_doc.select(
        F.col("_id").alias(id_col), "text_hash", "n_words", n_hit.alias("n_hit"), "items", "_times"
    )
    judged = counted.withColumn(
        "contaminated", (F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words"))
    )
    # equal rows read by one task were counted together
    again = F.explode(F.expr("sequence(1, _times)"))
    return judged.withColumn("_again", again).drop("_times", "_again")


def remove_contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    width: int = 13,
    share: int = 20,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
) -> DataFrame:
    """The documents that are not contaminated, with all their columns."""
    judged = contamination(docs, benchmark, width, share, id_col, text_col, item_col)
    gone = judged.where("contaminated").select(
        F.col(id_col).alias("_gone"), F.col("text_hash").alias("_gone_hash")
    )
    gone = common.stored(gone.distinct(), "contaminated")
    small = gone.count() <= BROADCAST_ROWS
    text_hash = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    same = F.col(id_col).eqNullSafe(F.col("_gone")) & (text_hash == F.col("_gone_hash"))
    return docs.join(F.broadcast(gone) if small else gone, same, "left_anti")
