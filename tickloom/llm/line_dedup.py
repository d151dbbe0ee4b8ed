"""Removal of lines that many documents share, by sharded minimal perfect hashes."""

from __future__ import annotations

from collections import OrderedDict

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.llm import common

_BLANK = b" \t\n\x0b\x0c\r"
_GOLD = 0x9E3779B97F4A7C15
_MIX = np.uint64(0xBF58476D1CE4E5B9)

SHARD_LINES = 1 << 19  # repeated lines in a shard, so a shard takes some 8 MB
CACHED_BYTES = 96 << 20  # of shards that a Python worker keeps
MEMORY = 200_000  # distinct lines a task sums up before it passes them on


def line_key(line: bytes) -> bytes:
    return line.strip(_BLANK).lower()  # of bytes: only A-Z


def hashes(keys: list[bytes]) -> np.ndarray:
    """128-bit hashes as two columns of 64 bits."""
    raw = b"".join([xxhash.xxh3_128_digest(k) for k in keys])
    return np.frombuffer(raw, "<u8").reshape(-1, 2)


def _place(h: np.ndarray, level: int, slots: int) -> np.ndarray:
    """Slot of each 128-bit hash in a level of the perfect hash."""
    x = h[:, 0] ^ (h[:, 1] + np.uint64(_GOLD * (level + 1) % 2**64))
    x = (x ^ (x >> np.uint64(29))) * _MIX
    return ((x ^ (x >> np.uint64(32))) % np.uint64(slots)).astype(np.int64)


class PerfectHash:
    """Minimal perfect hash: levels of bits, a key sits where no other key of its level does.

    A key's number is the count of set bits before its own. A hash that was not among
    the keys may get a number too; the caller compares fingerprints.
    """

    def __init__(self, words: np.ndarray, slots: np.ndarray):
        self.words, self.slots = words, slots
        self.starts = np.concatenate([[0], np.cumsum(slots // 64)]).astype(np.int64)
        ones = np.bitwise_count(words).astype(np.int64)
        self.before = np.concatenate([[0], np.cumsum(ones)[:-1]]) if len(words) else ones

    @classmethod
    def of(cls, h: np.ndarray, gamma: float = 1.6) -> PerfectHash:
        words, slots, rest, level = [], [], h, 0
        while len(rest):
            n = -(-int(gamma * len(rest) + 1) // 64) * 64
            at = _place(rest, level, n)
            alone = np.bincount(at, minlength=n) == 1
            words.append(np.packbits(alone, bitorder="little").view("<u8"))
            slots.append(n)
            rest, level = rest[~alone[at]], level + 1
        return cls(np.concatenate(words), np.array(slots, np.int64))

    def number(self, h: np.ndarray) -> np.ndarray:
        """Numbers from 0; -1 where no level holds the hash."""
        out = np.full(len(h), -1, np.int64)
        open_ = np.arange(len(h))
        for level, slots in enumerate(self.slots):
            if not len(open_):
                break
            at = _place(h[open_], level, int(slots))
            word, bit = self.starts[level] + at // 64, (at % 64).astype(np.uint64)
            value = self.words[word]
            hit = (value >> bit) & np.uint64(1) == 1
            below = value[hit] & ((np.uint64(1) << bit[hit]) - np.uint64(1))
            out[open_[hit]] = self.before[word[hit]] + np.bitwise_count(below)
            open_ = open_[~hit]
        return out


class Shard:
    """Perfect hash, 64-bit fingerprints and document counts of one shard's lines."""

    def __init__(self, hash_: PerfectHash, prints: np.ndarray, counts: np.ndarray):
        self.hash, self.prints, self.counts = hash_, prints, counts
        self.nbytes = hash_.words.nbytes * 2 + prints.nbytes + counts.nbytes

    @classmethod
    def of(cls, h: np.ndarray, counts: np.ndarray) -> Shard:
        hash_ = PerfectHash.of(h)
        at = hash_.number(h)
        prints, held = np.zeros(len(h), "<u8"), np.zeros(len(h), "<u4")
        prints[at] = h[:, 1]
        held[at] = np.minimum(counts, 0xFFFFFFFF)
        return cls(hash_, prints, held)

    def count(self, h: np.ndarray) -> np.ndarray:
        at = self.hash.number(h)
        known = at >= 0
        known[known] = self.prints[at[known]] == h[known, 1]
        out = np.zeros(len(h), np.int64)
        out[known] = self.counts[at[known]]
        return out

    def columns(self) -> dict[str, bytes]:
        return {
            "words": self.hash.words.tobytes(),
            "slots": self.hash.slots.astype("<i8").tobytes(),
            "prints": self.prints.tobytes(),
            "counts": self.counts.tobytes(),
        }

    @classmethod
    def load(cls, row: dict) -> Shard:
        words, slots = np.frombuffer(row["words"], "<u8"), np.frombuffer(row["slots"], "<i8")
        hash_ = PerfectHash(words, slots)
        return cls(hash_, np.frombuffer(row["prints"], "<u8"), np.frombuffer(row["counts"], "<u4"))


# Shards this Python worker has loaded, the latest used last.
_LOADED: OrderedDict[tuple[str, int], Shard | None] = OrderedDict()


def _shard(path: str, number: int) -> Shard | None:
    key = (path, number)
    if key not in _LOADED:
        fs, inner = common.filesystem(f"{path}/shard={number}")
        shard = None
        for info in fs.get_file_info(pa.fs.FileSelector(inner, allow_not_found=True)):
            if info.path.endswith(".parquet"):
                columns = ["words", "slots", "prints", "counts"]
                with fs.open_input_file(info.path) as f:
                    for row in pq.ParquetFile(f).read(columns).to_pylist():
                        shard = Shard.load(row)
        _LOADED[key] = shard
        while sum(s.nbytes for s in _LOADED.values() if s) > CACHED_BYTES and len(_LOADED) > 1:
            _LOADED.popitem(last=False)
    _LOADED.move_to_end(key)
    return _LOADED[key]


def _shard_of(h: np.ndarray, shards: int) -> np.ndarray:
    return ((h[:, 1] >> np.uint64(40)) % np.uint64(shards)).astype(np.int64)


def repeated_lines(docs: DataFrame, min_docs: int, min_chars: int, text_col: str) -> DataFrame:
    """Hashes (two longs) of the line keys in at least ``min_docs`` documents, with the count.

    Each task adds up its own documents first, so a very common line costs one row a task.
    """

    def make():
        seen: dict[bytes, int] = {}

        def rows():
            h = np.frombuffer(b"".join(seen), "<i8").reshape(-1, 2)
            n = np.fromiter(seen.values(), np.int64, len(seen))
            seen.clear()
            yield pa.RecordBatch.from_arrays(
                [pa.array(h[:, 0]), pa.array(h[:, 1]), pa.array(n)], names=["h1", "h2", "n"]
            )

        def fn(batch):
            if batch is not None:
                for text in common.texts(batch, "_text"):
                    keys = {line_key(line) for line in text.split(b"\n")}
                    for k in keys:
                        if len(k) >= min_chars and len(k.decode()) >= min_chars:
                            d = xxhash.xxh3_128_digest(k)
                            seen[d] = seen.get(d, 0) + 1
            if seen and (batch is None or len(seen) > MEMORY):
                yield from rows()

        return fn

    counted = common.map_batches(
        docs.select(F.col(text_col).alias("_text")), make, "h1 long, h2 long, n long", finish=True
    )
    return counted.groupBy("h1", "h2").agg(F.sum("n").alias("n")).where(F.col("n") >= min_docs)


def build_index(lines: DataFrame, name: str = "line-index") -> tuple[str, int]:
    """Write the shards to the shared folder; their path and number (0: no repeated line)."""
    lines = common.stored(lines, "repeated-lines")
    shards = -(-lines.count() // SHARD_LINES)
    path = common.shared_folder(lines.sparkSession, name)
    if not shards:
        return path, 0

    def build(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        h = np.ascontiguousarray(rows[["h1", "h2"]].to_numpy(np.int64)).view("<u8").reshape(-1, 2)
        shard = Shard.of(h, rows["n"].to_numpy())
        return pd.DataFrame([{"shard": key[0]} | shard.columns()])

    number = F.shiftrightunsigned("h2", 40) % shards
    built = lines.withColumn("shard", number.cast("int")).groupBy("shard").applyInPandas(
        build, "shard int, words binary, slots binary, prints binary, counts binary"
    )
    built.write.partitionBy("shard").parquet(path)
    return path, shards


def drop_repeated_lines(
    docs: DataFrame, min_docs: int = 10, min_chars: int = 1, text_col: str = "text"
) -> DataFrame:
    """Take the lines that at least ``min_docs`` documents hold out of every document.

    A line's key is the line without ASCII white space at its ends, A-Z in lower case;
    keys of fewer than ``min_chars`` characters are never dropped. All columns stay, the
    text becomes what is left (lines joined by a line feed), and n_lines and n_dropped
    are added. A NULL text is one empty line and becomes empty; repeated rows count as
    documents of their own; an empty table gives no rows; columns called n_lines or
    n_dropped are replaced.

    The index holds only the distinct hashes that reach ``min_docs``: at most a share of
    1 / min_docs of all lines. A hash that isn't in it is told by its 64-bit fingerprint.
    A worker reads one shard at a time from the shared folder and keeps recent ones.
    """
    path, shards = build_index(repeated_lines(docs, min_docs, min_chars, text_col))

    def make():
        def fn(batch):
            found = [t.split(b"\n") for t in common.texts(batch, text_col)]
            n_lines = np.array([len(x) for x in found], np.int64)
            keys = [line_key(line) for lines in found for line in lines]
            h = hashes(keys)
            # a short key was never counted, so it isn't in the index
            shard_of = _shard_of(h, shards) if shards else None
            drop = np.zeros(len(keys), bool)
            for number in np.unique(shard_of) if shards else ():
                at = np.flatnonzero(shard_of == number)
                shard = _shard(path, int(number))
                if shard is not None:
                    drop[at] = shard.count(h[at]) >= min_docs
            ends = np.cumsum(n_lines)
            kept, dropped, flags = [], [], drop.tolist()
            for lines, end in zip(found, ends.tolist()):
                own = flags[end - len(lines) : end]
                kept.append(b"\n".join([x for x, gone in zip(lines, own) if not gone]).decode())
                dropped.append(sum(own))
            return [
                pa.array(kept, pa.string()),
                pa.array(n_lines),
                pa.array(dropped, pa.int64()),
            ]

        return fn

    columns = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    # Only the lines are worked on: other columns pass through beside the new text.
    keep = [c for c in columns if c != text_col]
    source = docs.select(*columns)
    out = _with_text(source, keep, text_col, make)
    return out.select(*columns, "n_lines", "n_dropped")


def _with_text(docs: DataFrame, keep: list[str], text_col: str, make) -> DataFrame:
    new = common.fields("_ string, n_lines long, n_dropped long")
    schema = T.StructType(
        [docs.schema[c] for c in keep] + [T.StructField(text_col, T.StringType())] + new[1:]
    )
    names = [f.name for f in schema]

    def run(batches):
        fn = make()
        for batch in batches:
            for at in range(0, batch.num_rows, common.SLICE):
                part = batch.slice(at, common.SLICE)
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in keep] + fn(part), names=names
                )

    return docs.mapInArrow(run, schema)
