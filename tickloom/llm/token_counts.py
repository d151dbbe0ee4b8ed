"""Token counts: a broadcast table of frequent pre-token lengths, worker caches for the rest."""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm import common

# White space runs and words with their leading space, cut where the tokenizer's own
# pattern always cuts: before a word, and before the white space in front of it.
_UNITS = re.compile(r" ?\S+|\s+(?!\S)|\s+").findall
# Python counts these as white space, the tokenizer doesn't.
_ODD = re.compile("[\x1c-\x1f]").search

LONGEST = 48  # longer units are encoded anew each time, so a cache entry stays small
CACHED = 300_000  # units a worker remembers beside the table


def _load(path: str):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


class Lengths(dict):
    """Tokens of a unit: the frequent table first, then what this worker has met."""

    def __init__(self, tokenizer, frequent: dict[str, int]):
        super().__init__(frequent)
        self.tokenizer, self.frequent = tokenizer, frequent

    def __missing__(self, unit: str) -> int:
        n = len(self.tokenizer.encode(unit, add_special_tokens=False).ids)
        if len(unit) <= LONGEST:
            if len(self) >= len(self.frequent) + CACHED:
                self.clear()
                self.update(self.frequent)
            self[unit] = n
        return n


class Counting:
    """Counts the tokens of whole texts."""

    def __init__(self, path: str, frequent: dict[str, int]):
        self.tokenizer = _load(path)
        self.lengths = Lengths(self.tokenizer, frequent)
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, special))).search if special else None

    def __call__(self, text: str) -> int:
        if _ODD(text) or self.special and self.special(text):
            return len(self.tokenizer.encode(text, add_special_tokens=False).ids)
        return sum(map(self.lengths.__getitem__, _UNITS(text)))


# One counter for each table in a Python worker: the cache outlives a task.
_WORKER: dict[tuple, Counting] = {}


def _counting(path: str, table) -> Counting:
    key = (path, table.id if hasattr(table, "id") else id(table))
    if key not in _WORKER:
        _WORKER.clear()
        _WORKER[key] = Counting(path, unpack(table.value))
    return _WORKER[key]


def pack(lengths: dict[str, int]) -> tuple[bytes, bytes]:
    """The table in two flat buffers: the units joined by NUL, and their lengths."""
    kept = {u: n for u, n in lengths.items() if "\0" not in u}
    return "\0".join(kept).encode(), np.array(list(kept.values()), np.uint16).tobytes()


def unpack(packed: tuple[bytes, bytes]) -> dict[str, int]:
    lengths = np.frombuffer(packed[1], np.uint16).tolist()
    return dict(zip(packed[0].decode().split("\0"), lengths)) if lengths else {}


def frequent_units(
    docs: DataFrame, text_col: str, size: int, per_task: int, remembered: int = 200_000
) -> list[str]:
    """The units that are frequent over the whole corpus, ``size`` of them at most.

    Each task reads all its texts and reports its ``per_task`` most frequent units, so
    what is shuffled is bounded by the number of tasks; units themselves never are.
    Which units get here changes no count, only the share of cheap lookups.
    """

    def make():
        seen: Counter = Counter()

        def fn(batch):
            if batch is not None:
                for text in batch.column(0).to_pylist():
                    if text:
                        seen.update(_UNITS(text))
                if len(seen) > 2 * remembered:
                    kept = dict(seen.most_common(remembered))
                    seen.clear()
                    seen.update(kept)
                return
            top = [(u, n) for u, n in seen.most_common(per_task) if len(u) <= LONGEST]
            yield pa.RecordBatch.from_arrays(
                [pa.array([u for u, _ in top], pa.string()), pa.array([n for _, n in top], pa.int64())],
                names=["unit", "n"],
            )

        return fn

    heard = common.map_batches(docs.select(text_col), make, "unit string, n long", finish=True)
    top = heard.groupBy("unit").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "unit").limit(size)
    return [row.unit for row in top.collect()]  # at most ``size`` short strings


def token_counts(
    docs: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    limit: int = 1024,
    table_size: int = 40_000,
    per_task: int = 4_000,
) -> DataFrame:
    """Bytes and tokens of every whole text, and whether the tokens exceed ``limit``.

    Returns one row per input row: id, n_bytes, n_tokens, over_limit. A NULL text counts
    as empty (0 and 0), a NULL id is passed on, repeated rows stay, an empty table gives
    no rows, further columns are ignored. A text that holds a special string of the
    tokenizer is given to the library whole, so the string is handled as its default.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col), F.col(text_col).alias("_text"))
    units = frequent_units(docs, "_text", table_size, per_task)
    encoded = _load(tokenizer_path).encode_batch(units, add_special_tokens=False)
    table = spark.sparkContext.broadcast(pack({u: len(e.ids) for u, e in zip(units, encoded)}))

    def make():
        counting = _counting(tokenizer_path, table)

        def fn(batch):
            found = [t or "" for t in batch.column("_text").to_pylist()]
            return [pa.array([counting(t) for t in found], pa.int64())]

        return fn

    sized = docs.withColumn("n_bytes", F.coalesce(F.octet_length("_text"), F.lit(0)).cast("long"))
    counted = common.map_rows(sized, [id_col, "n_bytes"], make, "n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
