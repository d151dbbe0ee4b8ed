"""The registered queries: each runs one operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import (
    conversation_repair,
    decontamination,
    hard_negatives,
    line_dedup,
    ngram_join,
    packing,
    quality,
    quality_rules,
    rp_forest,
    suffix_tree,
    token_counts,
    url_filters,
    warc,
)
from tickloom.llm.common import crc_mod, shared_folder, table

Query = Callable[[SparkSession, str], DataFrame]

# The parameters that the queries' results are defined by.
CAPACITY = 4096
END_ID = 1
MIN_DOCS = 10
THRESHOLD = 0.3


def op1_suffix_tree(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return suffix_tree.suffix_tree_scores(docs, crc_mod(F.col("doc_id"), 7) == 2)


def op2_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    judged = decontamination.contamination(
        table(spark, folder, "documents"), table(spark, folder, "benchmark"), width=13, share=20
    )
    return judged.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op3_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.similarity_components(table(spark, folder, "documents"), percent=80)


def op4_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return rp_forest.nearest(table(spark, folder, "embeddings"), F.col("id") % 20 == 0, k=20)


def op5_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.best_fit_packing(
        table(spark, folder, "documents"),
        public_tokenizers.path("word_bpe_49k.json"),
        CAPACITY,
        END_ID,
    )


def _hash32(text: F.Column) -> F.Column:
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def _days(n: F.Column) -> F.Column:
    return F.timestamp_seconds(F.lit(1704067200) + n * 86400)  # after 2024-01-01


def url_list_log(pages: DataFrame) -> DataFrame:
    """Dated list changes over the hosts and the two-label domains that the pages have.

    Stand-in for list feeds: each third name is added, half of those are taken off again
    60 days later, and half of these come back after another 60 days.
    """
    names = pages.select(url_filters.host(F.col("url")).alias("host")).where("host <> ''").distinct()
    domain = F.regexp_extract("host", r"[^.]+\.[^.]+$", 0)
    entries = names.union(names.select(domain)).where("host <> ''").distinct()
    entries = entries.select(F.col("host").alias("entry"), _hash32(F.col("host")).alias("h"))
    entries = entries.where("h % 3 = 0").withColumn(
        "list", F.element_at(F.array(*map(F.lit, ("adult", "malware", "spam"))), (F.floor(F.col("h") / 3) % 3 + 1).cast("int"))
    )
    change = F.explode(
        F.array(
            F.struct(F.lit("add").alias("action"), F.lit(0).alias("after")),
            F.struct(F.lit("remove").alias("action"), F.lit(60).alias("after")),
            F.struct(F.lit("add").alias("action"), F.lit(120).alias("after")),
        )
    )
    log = entries.select("entry", "list", "h", change.alias("c"))
    log = log.where(
        "c.after = 0 or (c.after = 60 and h % 2 = 0) or (c.after = 120 and h % 4 = 0)"
    )
    return log.select("list", "entry", "c.action", _days(F.col("h") % 200 + F.col("c.after")).alias("at"))


def op6_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    """Pages as captures, fetched on a day that a hash of their URL gives."""
    pages = table(spark, folder, "pages").select("page_id", "url")
    fetched = pages.withColumn("fetched_at", _days(_hash32(F.coalesce("url", F.lit(""))) % 365))
    judged = url_filters.temporal_list_join(fetched, url_list_log(pages))
    return judged.select(
        "page_id", "host", F.array_join("lists", ",").alias("lists"), "n_entries", "blocked"
    )


def op7_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.archive_round_trip(
        table(spark, folder, "pages"), shared_folder(spark, "warc"), min_bytes=1000
    )


def op8_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    kept = line_dedup.drop_repeated_lines(docs, MIN_DOCS)
    return kept.select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("text"), 256).alias("kept_sha256")
    )


def op9_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    remainder = crc_mod(F.col("doc_id"), 5)
    scored = quality.quality_scores(
        table(spark, folder, "documents"),
        table(spark, folder, "labels"),
        usable=remainder != 0,
        threshold=THRESHOLD,
    )
    held_out = F.coalesce(remainder == 0, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op10_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.token_counts(
        table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"), limit=1024
    )


def op11_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality_rules.line_frequency_rules(
        table(spark, folder, "documents").select("doc_id", "text", "source"), max_docs=10
    )
    return judged.drop("text", "source")


def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(
        vectors.select("vec_id", "embedding", moved.alias("label")), F.col("id") % 100 == 0
    )


def op13_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    return conversation_repair.repair(
        conversation_repair.damaged(table(spark, folder, "conversations"))
    )


def queries() -> dict[str, Query]:
    found = {
        name: fn for name, fn in globals().items() if name.startswith("op") and name[2].isdigit()
    }
    return dict(sorted(found.items(), key=lambda x: int(x[0][2:].split("_")[0])))
