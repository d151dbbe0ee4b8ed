"""A training corpus from raw documents, in five stages of the ``llm`` operators.

Each stage takes (spark, docs, sf_dir) and works on all rows of its predecessor. All
stages but the last return the columns of ``documents``:

1. ``quality``: documents that the quality classifier rejects go.
2. ``line_dedup``: lines that at least ten documents hold go; a document stays, even if
   nothing is left of it, and n_chars follows its text.
3. ``near_duplicates``: of each group of linked documents the one with the smallest id stays.
4. ``decontamination``: documents contaminated with benchmark items go, others stay whole.
5. ``packing``: what is left is packed into sequences; one row per piece.

Awkward rows, the same in every stage: an empty table gives no rows. A NULL text counts as
empty; ``line_dedup`` makes it an empty text, the others pass it on. Rows without an id are
documents, are scored and packed, and link with none. Rows that repeat an id are documents of
their own, but of rows that repeat id and text ``near_duplicates`` keeps one. Columns beside
those of ``documents`` are dropped, whatever they are called. Stages take texts of any length
whole.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import common, decontamination, line_dedup, ngram_join, packing, quality

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted on ``labels``, doesn't reject."""
    scored = quality.quality_scores(
        docs.select(*COLUMNS),
        common.table(spark, sf_dir, "labels"),
        usable=common.crc_mod(F.col("doc_id"), 5) != 0,
        threshold=0.3,
        keep=COLUMNS,
    )
    return scored.where("predicted = 1").select(*COLUMNS)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents without the lines that ten documents hold; n_chars follows the text."""
    kept = line_dedup.drop_repeated_lines(docs.select(*COLUMNS), min_docs=10)
    return kept.withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest id."""
    return ngram_join.one_of_each_group(docs.select(*COLUMNS), percent=80).select(*COLUMNS)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth of the words is a benchmark passage."""
    benchmark = common.table(spark, sf_dir, "benchmark")
    return decontamination.remove_contaminated(docs.select(*COLUMNS), benchmark, width=13, share=20).select(*COLUMNS)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece with its sequence and place."""
    return packing.best_fit_packing(docs, public_tokenizers.path("word_bpe_49k.json"), 4096, 1)


STAGES = [
    ("quality", quality_stage),
    ("line_dedup", line_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]

# The tokenizer of the last stage and the classifier of the first can't be put in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet and read again."""
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
