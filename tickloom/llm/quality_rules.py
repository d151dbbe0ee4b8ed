"""Quality rules: counts of one text, and lines that too many documents of a host share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tickloom.llm import common

SYMBOLS = b"#*$%&|<>"  # fixed values: the characters that n_symbols counts
SPACE = b" \t\n\v\f\r"
MEMORY = 200_000  # line hashes a task holds before it passes them on
SLICE_BYTES = 8 << 20  # text worked on at a time
BROADCAST_LINES = 1_000_000  # lines above the limit that are broadcast at most: 16 MB

# A-Z in lower case, every digit as 0.
_FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789", b"abcdefghijklmnopqrstuvwxyz000000000")

COUNTS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
DECIDED = "base_failed boolean, n_removed_lines long, n_left_words long, kept boolean"


def line_key(line: bytes) -> bytes:
    """A line with single spaces between its words, A-Z in lower case and digits as 0."""
    return b" ".join(line.split()).translate(_FOLD)


def line_hash(host: bytes | None, key: bytes) -> bytes:
    """128 bits that tell a line of a host from all others; a missing host differs from all."""
    head = b"-" if host is None else b"%d:%s" % (len(host), host)
    return xxhash.xxh3_128_digest(head + key)


def repeat_words(texts: list[list[bytes]]) -> np.ndarray:
    """For each text: its words inside three-word windows that the text holds twice or more."""
    sizes = np.array([len(w) for w in texts], np.int64)
    out = np.zeros(len(texts), np.int64)
    total = int(sizes.sum())
    if total < 3:
        return out
    words = pa.array([w for t in texts for w in t], pa.large_binary()).dictionary_encode()
    ids = words.indices.to_numpy().astype(np.int64)
    n, doc = len(words.dictionary), np.repeat(np.arange(len(texts)), sizes)
    whole = np.flatnonzero(doc[2:] == doc[:-2])  # windows within one text
    if not len(whole):
        return out
    _, pair = np.unique(ids[whole] * n + ids[whole + 1], return_inverse=True)
    # the three words, then the text: ids stay dense, so the products stay small
    _, window = np.unique(pair * n + ids[whole + 2], return_inverse=True)
    _, own, times = np.unique(
        window * len(texts) + doc[whole], return_inverse=True, return_counts=True
    )
    hit = np.zeros(total, bool)
    first = whole[times[own] > 1]
    hit[first] = hit[first + 1] = hit[first + 2] = True
    return out + np.bincount(doc[hit], minlength=len(texts))


def counts(texts: list[bytes]) -> list[np.ndarray]:
    """The columns of ``COUNTS`` for some texts."""
    words = [t.split() for t in texts]
    dup_lines = []
    for t in texts:
        lines = [line for line in t.split(b"\n") if line.strip()]
        dup_lines.append(len(lines) - len(set(lines)))
    return [
        np.array([len(w) for w in words], np.int64),
        np.array([len(t.translate(None, SPACE).decode()) for t in texts], np.int64),
        np.array([len(t) - len(t.translate(None, SYMBOLS)) for t in texts], np.int64),
        np.array(dup_lines, np.int64),
        repeat_words(words),
    ]


def _portions(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with at most some ``SLICE_BYTES`` of text, one row at least."""
    sizes = [len(t) for t in common.texts(batch, column)]
    start = held = 0
    for i, size in enumerate(sizes):
        if held and (held + size > SLICE_BYTES or i - start >= common.SLICE):
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size + 1
    if start < len(sizes):
        yield batch.slice(start)


def _line_rows(docs: DataFrame, text_col: str, host_col: str, id_col: str) -> DataFrame:
    """One row for each distinct line of a document: its hash with the host, and the id."""

    def make():
        found: list[tuple[bytes, int | None]] = []

        def rows():
            h = np.frombuffer(b"".join(d for d, _ in found), "<i8").reshape(-1, 2)
            ids = pa.array([i for _, i in found], pa.string())
            found.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(h[:, 0]), pa.array(h[:, 1]), ids], names=["h1", "h2", "id"]
            )

        def fn(batch):
            if batch is not None:
                hosts = batch.column("host").cast(pa.binary()).to_pylist()
                ids = batch.column("id").to_pylist()
                for text, host, doc in zip(common.texts(batch, "text"), hosts, ids):
                    keys = {line_key(line) for line in text.split(b"\n")} - {b""}
                    found.extend((line_hash(host, k), doc) for k in keys)
                    if len(found) >= MEMORY:
                        yield rows()
            elif found:
                yield rows()

        return fn

    source = docs.select(
        F.col(text_col).cast("string").alias("text"),
        F.col(host_col).cast("string").alias("host"),
        F.col(id_col).cast("string").alias("id"),
    )
    return common.map_batches(source, make, "h1 long, h2 long, id string", finish=True)


def frequent_lines(
    docs: DataFrame,
    max_docs: int = 10,
    text_col: str = "text",
    host_col: str = "source",
    id_col: str = "doc_id",
) -> DataFrame:
    """Hashes (h1, h2) of the lines that more than ``max_docs`` documents of a host hold.

    Documents are told by their id: repeated rows of an id count once, all rows without an
    id are one document. A missing host is a host of its own, lines without a word are
    never counted, an empty table gives no rows. The distinct (line, id) pairs are dealt
    by the pair, then counted on the map side: a line of a third of all documents costs
    one row a task.
    """
    lines = _line_rows(docs, text_col, host_col, id_col)
    n = F.count_distinct(F.struct("id"))
    return lines.groupBy("h1", "h2").agg(n.alias("n_docs")).where(F.col("n_docs") > max_docs)


def _drop_lines(texts: list[bytes], gone: list[set[int]]) -> tuple[list[str], list[int], list[int]]:
    """Texts without the numbered lines, the lines and the words that went."""
    left, lines_gone, words_gone = [], [], []
    for text, numbers in zip(texts, gone):
        if not numbers:
            left.append(text.decode())
            lines_gone.append(0)
            words_gone.append(0)
            continue
        lines = text.split(b"\n")
        left.append(b"\n".join([x for i, x in enumerate(lines) if i not in numbers]).decode())
        lines_gone.append(len(numbers))
        words_gone.append(sum(len(lines[i].split()) for i in numbers))
    return left, lines_gone, words_gone


def line_frequency_rules(
    docs: DataFrame,
    max_docs: int = 10,
    min_words: int = 50,
    max_repeat: int = 50,
    min_left: int = 20,
    max_removed: int = 50,
    text_col: str = "text",
    host_col: str = "source",
    id_col: str = "doc_id",
    broadcast_lines: int = BROADCAST_LINES,
) -> DataFrame:
    """Take each host's frequent lines out of its documents and judge what is left.

    A line goes where more than ``max_docs`` documents of its host hold it (see
    ``frequent_lines``), told by ``line_key``. All columns stay, the text becomes what is
    left (lines joined by a line feed); added are, for the whole text, n_words, word_chars,
    n_symbols, n_dup_lines, n_repeat_words, then base_failed (fewer than ``min_words``
    words, or over ``max_repeat`` percent of them in repeated three-word windows),
    n_removed_lines, n_left_words and kept: not base_failed, and not depleted, that is at
    least ``min_left`` words left and at most ``max_removed`` percent of them removed.

    A NULL text has no words, becomes empty and fails. Rows stay one to one: repeated rows
    get the same result. An empty table gives no rows, columns with the names of added
    ones are replaced.

    Up to ``broadcast_lines`` lines are broadcast and looked up; beyond, (row, line) pairs
    are joined with them by hash, and each row with its line numbers.
    """
    added = [f.name for f in common.fields(f"{COUNTS}, {DECIDED}")]
    columns = [c for c in docs.columns if c not in added]
    source = docs.select(*columns)
    lines = common.stored(
        frequent_lines(source, max_docs, text_col, host_col, id_col).select("h1", "h2"), "frequent"
    )
    if lines.limit(broadcast_lines + 1).count() <= broadcast_lines:
        found = source.withColumns(_parts(text_col, host_col))
        rows = lines.toArrow()
        h = np.column_stack([rows["h1"].to_numpy(), rows["h2"].to_numpy()]).astype("<i8")
        known = source.sparkSession.sparkContext.broadcast(h)

        def start():
            raw = known.value.tobytes()
            held = {raw[i : i + 16] for i in range(0, len(raw), 16)}

            def gone(part, texts):
                if not held:
                    return [()] * len(texts)
                hosts = part.column("__host").cast(pa.binary()).to_pylist()
                return [_found(text, host, held) for text, host in zip(texts, hosts)]

            return gone

    else:
        found = _joined(source, lines, text_col, host_col, id_col)

        def start():
            return lambda part, texts: [set(x or ()) for x in part.column("__gone").to_pylist()]

    types = [T.StringType(), *[f.dataType for f in common.fields(f"{COUNTS}, {DECIDED}")]]

    def make():
        gone_of = start()

        def fn(batch):
            out = [[pa.array([], to_arrow_type(t)) for t in types]]
            for part in _portions(batch, "__text"):
                texts = common.texts(part, "__text")
                left, lines_gone, words_gone = _drop_lines(texts, gone_of(part, texts))
                n = counts(texts)
                n_left = n[0] - np.array(words_gone, np.int64)
                failed = (n[0] < min_words) | (100 * n[4] > max_repeat * n[0])
                depleted = (n_left < min_left) | (100 * (n[0] - n_left) > max_removed * n[0])
                arrays = [*n, failed, np.array(lines_gone, np.int64), n_left, ~failed & ~depleted]
                out.append([pa.array(left, pa.string()), *map(pa.array, arrays)])
            return [pa.concat_arrays(list(x)) for x in zip(*out)]

        return fn

    keep = [c for c in columns if c != text_col]
    judged = common.map_rows(found, keep, make, f"__left string, {COUNTS}, {DECIDED}")
    place = [F.col("__left").alias(c) if c == text_col else F.col(f"`{c}`") for c in columns]
    return judged.select(*place, *added)


def _parts(text_col: str, host_col: str) -> dict[str, Column]:
    return {"__text": F.col(text_col).cast("string"), "__host": F.col(host_col).cast("string")}


def _found(text: bytes, host: bytes | None, held: set[bytes]) -> set[int]:
    """Numbers of the lines whose hash is held."""
    keys = [line_key(line) for line in text.split(b"\n")]
    return {i for i, k in enumerate(keys) if k and line_hash(host, k) in held}


def _joined(docs: DataFrame, lines: DataFrame, text_col: str, host_col: str, id_col: str) -> DataFrame:
    """Documents with __gone, the numbers of their frequent lines.

    Rows are told by 128 bits of their id, host and text.
    """
    cols = [F.col(c).cast("string") for c in (id_col, host_col, text_col)]
    row = {"__r1": F.xxhash64(*cols, F.lit(1)), "__r2": F.xxhash64(F.lit(2), *cols)}
    source = docs.withColumns(_parts(text_col, host_col) | row)

    def make():
        def fn(batch):
            hosts = batch.column("__host").cast(pa.binary()).to_pylist()
            rows, numbers, found = [], [], []
            for i, text in enumerate(common.texts(batch, "__text")):
                for n, line in enumerate(text.split(b"\n")):
                    if k := line_key(line):
                        found.append(line_hash(hosts[i], k))
                        rows.append(i)
                        numbers.append(n)
            if found:
                h = np.frombuffer(b"".join(found), "<i8").reshape(-1, 2)
                at = pa.array(rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(h[:, 0]), pa.array(h[:, 1]), batch.column("__r1").take(at),
                        batch.column("__r2").take(at), pa.array(numbers, pa.int32()),
                    ],
                    names=["h1", "h2", "__r1", "__r2", "n"],
                )

        return fn

    pairs = common.map_batches(
        source.select("__text", "__host", *row), make, "h1 long, h2 long, __r1 long, __r2 long, n int"
    )
    # an inner join, so that the many pairs of a common line can be split over tasks
    gone = pairs.join(lines, ["h1", "h2"]).groupBy(*row).agg(F.collect_set("n").alias("__gone"))
    return source.join(gone, [*row], "left")
