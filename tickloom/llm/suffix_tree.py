"""Language model: a probabilistic suffix tree over words."""

from __future__ import annotations

import mmap
import tempfile
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.llm import common
from tickloom.llm.ngram_join import WordHashes

P_WORD = 1e-6  # share of all tokens from which a word's count is broadcast: at most 1 / P_WORD
P_NGRAM = 1e-7  # share from which an n-gram's weight is broadcast; the others are joined
LEAST = 3  # occurrences that a context or a parameter needs
DEPTH = 4  # words of the longest contexts
DISCOUNT = 0.75
HELD = 3_000_000  # words or n-grams a task holds before it passes them on
SHARES = np.arange(1, 16, dtype=np.uint64) << np.uint64(60)  # a task merges them by a 16th of the hash values
ASKED = 1 << 19  # words and n-grams of a block of texts that are looked up together
SHARD = 1 << 22  # occurrences of the words and n-grams of a part of the table
COUNTED = 1 << 21  # words of the texts for each part in which their n-grams are counted
SKETCH_BITS = 12  # of a sketch for each key in it
SLICE_BITS = 17  # a slice of a sketch has 2**17 words, 1 MB
SKETCH_AT = (0, 6, 12, 18)  # where a key has the numbers of its bits in a word of the sketch
ROUNDS = 4  # the table is asked for a part of the texts at a time, so that their keys don't lie on disk twice
SEED = 42  # of Spark's xxhash64
JOINED = 1 << 18  # bytes of text whose words are hashed at once, unless one text has more
END = np.uint64(0x5851F42D4C957F2D)  # the key of the end symbol


def _hash_long(x: np.ndarray, seed: np.ndarray | np.uint64) -> np.ndarray:
    p1, p2, p3 = (np.uint64(p) for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
    p4, p5 = np.uint64(0x85EBCA77C2B2AE63), np.uint64(0x27D4EB2F165667C5)
    k = x * p2
    h = (seed + p5 + np.uint64(8)) ^ (((k << np.uint64(31)) | (k >> np.uint64(33))) * p1)
    h = ((h << np.uint64(27)) | (h >> np.uint64(37))) * p1 + p4
    h = (h ^ (h >> np.uint64(33))) * p2
    h = (h ^ (h >> np.uint64(29))) * p3
    return h ^ (h >> np.uint64(32))


def ngram_key(context: np.ndarray, suffix: np.ndarray) -> np.ndarray:
    """Spark's xxhash64(context, suffix): the n-gram's first and last n - 1 words make its key."""
    return _hash_long(suffix, _hash_long(context, np.uint64(SEED)))


class Words:
    """Texts as 64-bit keys of their words, A-Z in lower case, each text with an end symbol."""

    def __init__(self) -> None:
        self.hashes = WordHashes()

    def __call__(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The keys of all texts joined, and the text each belongs to."""
        out, first = [], 0
        while first < len(texts):  # some texts at a time, all their words at once
            last, size = first, 0
            while last < len(texts) and (last == first or size + len(texts[last]) <= JOINED):
                size += len(texts[last]) + 1
                last += 1
            some = texts[first:last]
            keys, starts = self.hashes.with_starts(b"\n".join(some))
            ends = np.cumsum([len(t) + 1 for t in some])
            upto = np.searchsorted(starts, ends)
            sizes = np.diff(np.r_[0, upto]) + 1
            out.append((np.insert(keys, upto, END), np.repeat(np.arange(first, last), sizes)))
            first = last
        if not out:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        keys, doc = (np.concatenate(x) for x in zip(*out))
        return keys, doc


def ngrams(keys: np.ndarray, doc: np.ndarray, n: int, shorter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the (n - 1)-grams that begin each n-gram of the documents' joined words.

    ``shorter``: (n - 1)-gram keys by start. Gives the start too; none crosses documents.
    """
    m = len(keys) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return shorter[:m], np.flatnonzero(doc[:m] == doc[n - 1 :])


class Sketch:
    """Some bits for each key in one of the words: a key that was put in is always found.

    It is as large as its keys ask for and never goes through the driver: slices of its words
    are stored, and each worker maps a file of them into memory.
    """

    def __init__(self, keys: DataFrame):
        bits, slices = SLICE_BITS, 1 + keys.count() * SKETCH_BITS // (64 << SLICE_BITS)

        def put(rows: pa.Table) -> pa.Table:
            key = rows["key"].to_numpy().astype(np.int64).view(np.uint64)
            at = Sketch.at(key, slices << bits)
            of = int(at[0]) >> bits
            order = np.argsort(at)
            new, _ = _runs(at[order])
            own = np.zeros(len(key), np.uint64)
            for low in SKETCH_AT:
                own |= np.uint64(1) << ((key >> np.uint64(low)) & np.uint64(63))
            words = np.zeros(1 << bits, np.uint64)
            words[at[order[new]] - (of << bits)] = np.bitwise_or.reduceat(own[order], new)
            return pa.table([pa.array([of], pa.int32()), pa.array([words.tobytes()])], names=["slice", "words"])

        of = F.shiftrightunsigned(F.shiftrightunsigned("key", 32) * F.lit(slices).cast("long"), 32)
        sliced = keys.select("key", of.alias("slice")).groupBy("slice").applyInArrow(put, "slice int, words binary")
        self.stored = common.stored(sliced, "sketch", free=True)
        self.path, self.slices, self.bits = self.stored.stored_at, slices, bits

    def __getstate__(self):
        return {"path": self.path, "slices": self.slices, "bits": self.bits}

    @staticmethod
    def at(keys: np.ndarray, n: int) -> np.ndarray:
        """Which of ``n`` words each key has, in the order of the keys."""
        return (((keys >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)).astype(np.int64)

    def opened(self) -> Callable[[np.ndarray], np.ndarray]:
        """Inside ``make``: the function that tells which keys it holds."""
        size = 8 << self.bits

        def build():
            with tempfile.TemporaryFile() as file:
                file.truncate(self.slices * size)
                for rows in common.stored_rows(self.path, 4):
                    for of, words in zip(rows["slice"].to_pylist(), rows["words"]):
                        file.seek(of * size)
                        file.write(words.as_buffer())
                file.flush()
                return np.frombuffer(mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ), np.uint64)

        words = common.kept(self.path, build)

        def holds(keys: np.ndarray) -> np.ndarray:
            word, found = words[Sketch.at(keys, len(words))], np.uint64(1)
            for low in SKETCH_AT:
                found = found & (word >> ((keys >> np.uint64(low)) & np.uint64(63)))
            return found == 1

        return holds


class Table:
    """Values by key: sorted keys, and where those with each leading bits begin."""

    def __init__(self, rows: pa.Table, value: str):
        keys = rows["key"].to_numpy().astype(np.int64).view(np.uint64)
        order = np.argsort(keys)
        self.keys, self.values = keys[order], rows[value].to_numpy()[order].astype(np.float64)
        bits = max(1, len(keys).bit_length())
        self.shift = np.uint64(64 - bits)
        leading = (self.keys >> self.shift).astype(np.int64)
        self.begins = np.searchsorted(leading, np.arange((1 << bits) + 1)).astype(np.int32)

    def __call__(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The value of each key (0 without one), and whether there is one."""
        value, hit = np.zeros(len(keys)), np.zeros(len(keys), bool)
        if not len(self.keys):
            return value, hit
        lead = (keys >> self.shift).astype(np.int64)
        at, end = self.begins[lead], self.begins[lead + 1]
        open_ = np.flatnonzero(at < end)
        at, end, wanted = at[open_], end[open_], keys[open_]
        while len(open_):  # about one key shares the leading bits
            same = self.keys[at] == wanted
            found = open_[same]
            hit[found], value[found] = True, self.values[at[same]]
            at = at + 1
            go_on = ~same & (at < end)
            open_, at, end, wanted = open_[go_on], at[go_on], end[go_on], wanted[go_on]
        return value, hit


def _runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each run of equal values begins, and how long it is."""
    new = np.flatnonzero(np.r_[True, values[1:] != values[:-1]][: len(values)])
    return new, np.diff(np.r_[new, len(values)])


class Summing:
    """Keys (several columns) that a task holds, summed up before they are passed on.

    ``hashed`` makes one key of the columns. Each batch is summed up when it comes; ``rows``
    merges a share of the hash values at a time, so it takes little beside what is held.
    """

    def __init__(self, names: list[str], hashed: Callable[..., np.ndarray]):
        self.names, self.hashed, self.parts, self.n = names, hashed, [], 0

    def add(self, *columns: np.ndarray) -> None:
        if len(columns[0]):
            by = self.hashed(*columns)
            order = np.argsort(by)
            new, times = _runs(by[order])
            at = order[new]
            begins = np.r_[0, np.searchsorted(by[at], SHARES), len(at)]
            self.parts.append((begins, [c[at] for c in columns], times.astype(np.int32)))
            self.n += len(at)

    def merged(self) -> Iterator[tuple[np.ndarray, list[np.ndarray], np.ndarray]]:
        """Sorted hashes, columns and times, a share at a time."""
        parts, self.parts, self.n = self.parts, [], 0
        for k in range(len(SHARES) + 1):
            some = [(slice(begins[k], begins[k + 1]), columns, times) for begins, columns, times in parts]
            columns = [np.concatenate([c[i][at] for at, c, _ in some]) for i in range(len(self.names))]
            times = np.concatenate([t[at] for at, _, t in some])
            by = self.hashed(*columns)
            order = np.argsort(by)
            by = by[order]
            new, _ = _runs(by)
            if len(new):
                columns = [c[order[new]] for c in columns]
                yield by[new], columns, np.add.reduceat(times[order], new, dtype=np.int64)

    def rows(self):
        for _, columns, times in self.merged():
            columns = [*(c.view(np.int64) for c in columns), times]
            for first in range(0, len(times), 100_000):
                part = [pa.array(c[first : first + 100_000]) for c in columns]
                yield pa.RecordBatch.from_arrays(part, names=[*self.names, "n"])


def count_words(docs: DataFrame) -> DataFrame:
    """Occurrences (key, n) of every word and of the end symbol."""

    def make():
        words, held = Words(), Summing(["key"], lambda key: key)

        def fn(batch):
            if batch is not None:
                keys, _ = words(common.texts(batch, "_text"))
                held.add(keys)
            if held.parts and (batch is None or held.n > HELD):
                yield from held.rows()

        return fn

    counted = common.map_batches(docs, make, "key long, n long", finish=True)
    # the tasks have summed up what they hold, so each row goes to its sum as it is
    return counted.repartition("key").groupBy("key").agg(F.sum("n").alias("n"))


_PIECE = ["shard", "contexts", "kinds", "suffixes", "n"]


def _pieces(held: Summing, shards: int) -> Iterator[pa.RecordBatch]:
    """The n-grams that a task holds as bytes, by shard (a range of the hash values) and context."""
    for by, (context, suffix), n in held.merged():
        shard = (((by >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)).astype(np.int32)
        out = []
        for first, size in zip(*_runs(shard)):
            of = first + np.argsort(context[first : first + size])
            new, kinds = _runs(context[of])
            out.append((shard[first], context[of[new]].tobytes(), _packed(kinds), suffix[of].tobytes(), _packed(n[of])))
        kinds = (pa.int32(), *[pa.binary()] * 4)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=_PIECE)


def _summed(pieces: pa.Table) -> pa.Table:
    """The n-grams of a shard that occur often enough in all its pieces."""
    parts = []
    for contexts, kinds, suffixes, n in zip(*(pieces[c] for c in _PIECE[1:])):
        contexts, suffixes = (np.frombuffer(x.as_buffer(), np.uint64) for x in (contexts, suffixes))
        contexts = np.repeat(contexts, _unpacked(kinds.as_py(), len(contexts)))
        parts.append((contexts, suffixes, _unpacked(n.as_py(), len(suffixes)).astype(np.int32)))
    context, suffix, n = (np.concatenate(x) for x in zip(*parts))
    parts.clear()
    by = ngram_key(context, suffix)
    order = np.argsort(by)
    new, _ = _runs(by[order])
    n = np.add.reduceat(n[order], new, dtype=np.int64)
    often = n >= LEAST
    at = order[new[often]]
    of = pa.array(np.full(len(at), pieces["order"][0].as_py(), np.int32))
    columns = [of, context[at].view(np.int64), suffix[at].view(np.int64), n[often]]
    return pa.table(columns, names=["order", "context", "suffix", "n"])


def count_ngrams(docs: DataFrame, sketch: Sketch, known: int, orders: Sequence[int], shards: int) -> DataFrame:
    """Occurrences (order, context, suffix, n) of the n-grams of some orders, ``LEAST`` at least.

    Context and suffix are the keys of an n-gram's first and last n - 1 words. An n-gram
    can't occur more often than its parts: those that hold a ``known``-gram which the
    sketch of the frequent enough ones doesn't hold are left out before the shuffle. The
    tasks pass on what they have summed up as arrays, one for each shard.
    """

    def make():
        words, holds = Words(), sketch.opened()
        held = {n: Summing(["context", "suffix"], ngram_key) for n in orders}

        def fn(batch):
            if batch is not None:
                keys, doc = words(common.texts(batch, "_text"))
                shorter = keys
                for _ in range(1, known):
                    shorter = ngram_key(shorter[:-1], shorter[1:])
                often = holds(shorter)
                for n in range(known + 1, max(orders) + 1):
                    context, at = ngrams(keys, doc, n, shorter)
                    if not len(at):
                        break
                    # all known-grams inside the n-gram are frequent
                    often = often[:-1] & often[1:]
                    if n in held:
                        of = at[often[at]]
                        held[n].add(context[of], shorter[of + 1])
                    shorter = ngram_key(context, shorter[1:][: len(context)])
            for n, sums in held.items():
                if sums.parts and (batch is None or sums.n > HELD):
                    for rows in _pieces(sums, shards):
                        order = pa.array(np.full(rows.num_rows, n, np.int32))
                        yield pa.RecordBatch.from_arrays([order, *rows.columns], names=["order", *_PIECE])

        return fn

    schema = "order int, shard int, contexts binary, kinds binary, suffixes binary, n binary"
    counted = common.map_batches(docs, make, schema, finish=True)
    return counted.groupBy("order", "shard").applyInArrow(_summed, "order int, context long, suffix long, n long")


def grow(grams: DataFrame, shorter: DataFrame) -> DataFrame:
    """Test contexts for divergence from their parents.

    ``grams``: stored n-grams (context, suffix, n). ``shorter``: the (n - 1)-grams (key, n,
    log: log10 P of the last word in the tree so far). Returns a stored row for each n-gram:
    context, key, n, own (the context's occurrences), rest (log10 weight of its parent),
    parent and log (log10 P of the last word there and in the context) and stays.

    A parameter gets its discounted share, the parent all that is left. A context stays if
    the log likelihood that it gains over its parent on its own occurrences is more than
    half the log of their number for each parameter and for the context itself. Kinds and
    gains are added up on the map side and joined back, so the n-grams of a very common
    context can be split over tasks.
    """
    at_parent = shorter.select(F.col("key").alias("suffix"), F.col("log").alias("parent"))
    known = grams.join(at_parent, "suffix").select(
        "context", F.xxhash64("context", "suffix").alias("key"), "n", "parent"
    )
    known = common.stored(known, "n-grams", free=True)
    contexts = known.groupBy("context").agg(F.count("*").alias("kinds"), F.sum("n").alias("listed"))
    contexts = contexts.join(
        shorter.select(F.col("key").alias("context"), F.col("n").alias("own")), "context"
    )
    left = F.col("own") - F.col("listed")
    rest = F.log10(F.greatest(DISCOUNT * F.col("kinds") + left, F.lit(1e-12)) / F.col("own"))
    p = (F.col("n") - DISCOUNT) / F.col("own") + F.pow(F.lit(10.0), F.col("rest") + F.col("parent"))
    tested = known.join(contexts.withColumn("rest", rest), "context").withColumn("log", F.log10(p))
    gains = tested.groupBy("context", "own", "listed", "kinds", "rest").agg(
        F.sum(F.col("n") * (F.col("log") - F.col("parent"))).alias("gain")
    )
    enough = (F.col("gain") + left * F.col("rest")) * float(np.log(10)) > (
        0.5 * (F.col("kinds") + 1) * F.log(F.greatest("own", F.lit(2)))
    )
    judged = tested.select("context", "key", "n", "own", "rest", "parent", "log").join(
        gains.select("context", enough.alias("stays")), "context"
    )
    out = common.stored(judged, "judged", free=True)
    common.dropped(known)
    return out


def _weights(judged: DataFrame) -> DataFrame:
    """What each n-gram adds to log10 P: (key, n, weight), several rows for a key.

    As parameter of a state, log10 P(last word | the others) over what the shorter contexts
    give; as a state itself, log10 of the share that it leaves to its parent. In a whole
    text something follows every state.
    """
    kept = judged.where("stays")
    states = kept.groupBy("context").agg(F.first("own").alias("n"), F.first("rest").alias("weight"))
    return kept.select("key", "n", (F.col("log") - F.col("rest") - F.col("parent")).alias("weight")).union(
        states.select(F.col("context").alias("key"), "n", "weight")
    )


class Tree:
    """A tree learnt from the training texts; ``learn`` makes it.

    What has a high share of all tokens is in ``words`` (log10 of the base probability by key)
    and ``weights`` (of n-grams); all else is stored in ``rest``, by shard as ``_shards_of``
    gives it. ``sketch`` holds all n-grams with a weight.
    """

    def __init__(
        self, rest: DataFrame, shards: int, words: Table, weights: Table, sketch: Sketch,
        total: int, distinct: int, depth: int,
    ):
        self.rest, self.shards, self.words, self.weights, self.sketch = rest, shards, words, weights, sketch
        self.total, self.norm, self.depth = total, total + distinct + 1, depth


def learn(training: DataFrame, depth: int = DEPTH) -> Tree:
    """A tree of contexts of up to ``depth`` words over all training texts (column _text).

    Whatever occurs ``LEAST`` times is a candidate at any corpus size, and the divergence
    test alone decides. Words and n-grams are known by 64-bit hashes. One pass over the
    texts counts the words, and one the n-grams of each order, until there are none.
    """
    counts = common.stored(count_words(training), "word-counts", free=True, rows=common.SLICE)
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    log0 = F.log10((F.col("n") + 1) / F.lit(float(total + distinct + 1)))
    shorter = counts.where(F.col("n") >= LEAST).select("key", "n", log0.alias("log"))
    found, grown = [], 0
    shards = len(SHARES) + 1
    shards *= 1 + int(total) // (shards * COUNTED)
    # the few n-grams beyond the third order are counted in one pass for two orders
    passes = [[2], [3], *[[n, n + 1] for n in range(4, depth + 2, 2)]]
    for orders in passes:
        orders = [n for n in orders if n <= depth + 1]
        if not orders or grown < orders[0] - 2:
            break
        sketch = Sketch(shorter.select("key"))
        grams = common.stored(
            count_ngrams(training, sketch, orders[0] - 1, orders, shards), "counted", free=True, rows=common.SLICE
        )
        common.dropped(sketch.stored)
        for n in orders:
            own = grams.where(F.col("order") == n).drop("order")
            if own.isEmpty():
                break
            judged = grow(own, shorter)
            found.append(judged)
            grown = n - 1
            log = F.when(F.col("stays"), F.col("log")).otherwise(F.col("parent"))
            shorter = judged.select("key", "n", log.alias("log"))
        common.dropped(grams)
    zero = F.lit(0).cast("long")
    rows = counts.select("key", F.col("n").alias("words"), zero.alias("grams"), F.lit(0.0).alias("weight"))
    for judged in found:
        rows = rows.union(_weights(judged).select("key", zero, "n", "weight"))
    table = rows.groupBy("key").agg(
        F.sum("words").alias("n"), F.max("grams").alias("grams"), F.sum("weight").alias("weight")
    )
    table = common.stored(table, "tree", free=True)
    for frame in [counts, *found]:
        common.dropped(frame)
    frequent = F.col("n") >= max(1, int(np.ceil(P_WORD * total)))
    words = Table(table.where(frequent).select("key", log0.alias("log")).toArrow(), "log")
    heavy = F.col("grams") >= max(LEAST, int(np.ceil(P_NGRAM * total)))
    weights = Table(table.where(heavy).select("key", "weight").toArrow(), "weight")
    sketch = Sketch(table.where("grams > 0"))
    rest = table.where((F.col("n") > 0) & ~frequent | (F.col("grams") > 0) & ~heavy)
    occurrences = rest.agg(F.sum(F.col("n") + F.col("grams"))).first()[0] or 0
    shards = 1 + int(occurrences) // SHARD
    rest = common.stored(_shards_of(rest, shards).repartition("shard"), "rest", ["shard"], free=True)
    common.dropped(table)
    return Tree(rest, shards, words, weights, sketch, int(total), int(distinct), grown)


def _packed(numbers: np.ndarray) -> bytes:
    """Numbers from 0 as bytes, in the narrowest type that takes them all."""
    return numbers.astype(np.min_scalar_type(int(numbers.max(initial=0)))).tobytes()


def _unpacked(packed: bytes, n: int) -> np.ndarray:
    """``n`` packed numbers."""
    return np.frombuffer(packed, f"u{len(packed) // max(n, 1) or 1}").astype(np.int64)


class Asking:
    """What the texts of a block ask of the table, as one row of bytes for each of its shards.

    ``asked``: row (number in the table of texts), key, times as a word and as an n-gram.
    """

    def __init__(self, shards: int):
        self.shards, self.parts, self.n = shards, [], 0

    def add(self, *asked: np.ndarray) -> None:
        if len(asked[0]):
            self.parts.append(asked)
            self.n += len(asked[0])

    def rows(self) -> tuple[int, list[tuple[int, bytes, bytes, bytes, bytes]]]:
        """The block's first row; shard and, as bytes, steps from row to row, keys and times."""
        row, key, words, grams = (np.concatenate(x) for x in zip(*self.parts))
        self.parts, self.n = [], 0
        first = int(row.min())
        shard = (key.view(np.int64) % self.shards).astype(np.min_scalar_type(self.shards))
        order = np.argsort(shard, kind="stable")  # the rows come in order
        row, key, words, grams, shard = (x[order] for x in (row, key, words, grams, shard))
        out = []
        for a, n in zip(*_runs(shard)):
            of = slice(a, a + n)
            steps = np.diff(row[of], prepend=first)
            out.append((int(shard[a]), _packed(steps), key[of].tobytes(), _packed(words[of]), _packed(grams[of])))
        return first, out


_ASKED = "shard int, at binary, keys binary, words binary, grams binary"


def _shards_of(rest: DataFrame, shards: int) -> DataFrame:
    """The table's rows as bytes, several rows for each shard: shard, keys, n and weights."""

    def make():
        parts, held = [], 0

        def fn(batch):
            nonlocal held
            if batch is not None:
                parts.append([batch[c].to_numpy(zero_copy_only=False) for c in ("key", "n", "weight")])
                held += batch.num_rows
            if not parts or batch is not None and held <= SHARD:
                return
            key, n, weight = (np.concatenate(x) for x in zip(*parts))
            parts.clear()
            held, shard = 0, key % shards
            order = np.argsort(shard, kind="stable")
            new, sizes = _runs(shard[order])
            of = [order[a : a + k] for a, k in zip(new, sizes)]
            columns = [[key[i].tobytes() for i in of], [_packed(n[i]) for i in of], [weight[i].tobytes() for i in of]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(shard[order[new]].astype(np.int32)), *(pa.array(c, pa.binary()) for c in columns)],
                names=["shard", "keys", "n", "weights"],
            )

        return fn

    return common.map_batches(
        rest.select("key", "n", "weight"),
        make,
        "shard int, keys binary, n binary, weights binary",
        finish=True,
        rows=SHARD,
    )


def looked_up(asked: DataFrame, rest: DataFrame, norm: int) -> DataFrame:
    """Sums over what each text asks: row, log (log10 of the base probability), known and more.

    ``asked``: block (its first row) and the columns of ``Asking``. Blocks and table meet by
    shard: a task reads a shard of the stored table, gets one block's keys after another, and
    what the block's texts get there goes back to the block in one row.
    """
    met = asked.repartition("shard").sortWithinPartitions("shard", "block")
    met = met.select("shard", "block", "keys", "at", "words", "grams")
    zero, path = np.log10(1 / norm), rest.stored_at

    def opened(shard):
        parts = []
        for rows in common.stored_rows(f"{path}/shard={shard}", 16):
            for keys, n, weights in zip(*(rows[c].to_pylist() for c in ("keys", "n", "weights"))):
                keys = np.frombuffer(keys, np.int64)
                parts.append([keys, _unpacked(n, len(keys)), np.frombuffer(weights, float)])
        key, n, weight = [np.concatenate(x) for x in zip(*parts)] or [np.zeros(0, np.int64)] * 3
        found = pa.table([key, np.arange(len(key))], names=["key", "at"])
        return Table(found, "at"), n, np.log10((n + 1) / norm), weight

    def make():
        at, table = None, None

        def fn(batch):
            nonlocal at, table
            out = []
            for shard, block, keys, row, words, grams in zip(*(c.to_pylist() for c in batch.columns)):
                if shard != at:
                    table = None
                    at, table = shard, opened(shard)
                find, count, log, weight = table
                place, hit = find(np.frombuffer(keys, np.uint64))
                place = place.astype(np.int64)[hit]
                words, grams, row = (_unpacked(x, len(hit)) for x in (words, grams, row))
                sums = np.zeros((3, len(hit)))
                sums[0] = words * zero
                sums[0, hit] = words[hit] * log[place]
                sums[1, hit] = words[hit] * (count[place] > 0)
                sums[2, hit] = grams[hit] * weight[place]
                row = np.cumsum(row)
                new, _ = _runs(row)
                steps = _packed(np.diff(row[new], prepend=0))
                out.append((shard, block, steps, np.add.reduceat(sums, new, axis=1).tobytes()))
            kinds = (pa.int32(), pa.int64(), pa.binary(), pa.binary())
            columns = list(zip(*out)) or [[]] * 4
            names = ["shard", "block", "at", "sums"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

        return fn

    answers = common.map_batches(met, make, "shard int, block long, at binary, sums binary")

    def add_up(answers: pa.Table) -> pa.Table:
        answers = answers.sort_by("shard")
        first = answers["block"][0].as_py()
        sums = [np.frombuffer(x.as_py(), float).reshape(3, -1) for x in answers["sums"]]
        row = [np.cumsum(_unpacked(x.as_py(), k.shape[1])) for x, k in zip(answers["at"], sums)]
        row = np.concatenate(row)
        there, of = np.unique(row, return_inverse=True)
        log, known, more = (np.bincount(of, weights=x) for x in np.concatenate(sums, axis=1))
        columns = [there + np.int64(first), log, known.astype(np.int64), more]
        return pa.table(columns, names=["row", "log", "known", "more"])

    return answers.groupBy("block").applyInArrow(add_up, "row long, log double, known long, more double")


def suffix_tree_scores(
    docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", depth: int = DEPTH
) -> DataFrame:
    """Score every whole text under a suffix tree learnt from the rows that aren't held out.

    Returns one row per input row: id, held_out, n_tokens, n_known, train_tokens,
    base_score (add-one unigrams) and score (the tree), both log10 probabilities of the
    text's words and its end. NULL and empty texts are the end symbol alone; a NULL
    ``held_out`` counts as not held out; repeated rows stay; an empty table gives no rows;
    without training rows both scores give each token probability 1 / 1; further columns
    are ignored.

    A token's probability comes from the longest context before it, of ``depth`` words at
    most, that is a state. The most frequent words' counts and n-grams' weights are
    broadcast, both bounded; all other words and n-grams are counted per document and
    looked up in the table, which grows with the training texts.
    """
    out = F.coalesce(held_out, F.lit(False))
    rows = docs.select(
        F.col(id_col).alias("_id"), out.alias("held_out"), F.col(text_col).alias("_text")
    )
    tree = learn(rows.where(~F.col("held_out")).select("_text"), depth)
    shared = docs.sparkSession.sparkContext.broadcast((tree.words, tree.weights))
    grown, sketch = tree.depth, tree.sketch
    shards, most = tree.shards, ASKED
    rows = rows.withColumn("_row", F.monotonically_increasing_id())
    schema = T.StructType([T.StructField(c, rows.schema[c].dataType) for c in ("_row", "_id", "held_out")])
    for field in common.fields(f"n_tokens long, n_known long, base double, part double, {_ASKED}"):
        schema.add(field)
    names = schema.names

    def make():
        words, (frequent, weights), holds = Words(), shared.value, sketch.opened()
        asking, id_type = Asking(shards), None

        def row_of(values, n):
            nulls = [pa.nulls(n, k) for k in (pa.int32(), *[pa.binary()] * 4)]
            return pa.RecordBatch.from_arrays([*values, *nulls], names=names)

        def fn(batch):
            nonlocal id_type
            if batch is not None:
                id_type = batch["_id"].type
                keys, doc = words(common.texts(batch, "_text"))
                n = batch.num_rows
                log, known = frequent(keys)
                base = np.bincount(doc, weights=log, minlength=n)
                score = base.copy()
                # what the tables don't hold: the texts, keys, and whether a word or an n-gram
                parts = [(doc[~known], keys[~known], np.ones(int((~known).sum()), np.int32))]
                shorter, of = keys, doc
                for k in range(1, grown + 2):
                    if k > 1:
                        context, at = ngrams(keys, doc, k, shorter)
                        shorter = ngram_key(context, shorter[1:][: len(context)])
                        of, own = doc[at], shorter[at]
                    else:
                        own = keys
                    maybe = holds(own)
                    of, own = of[maybe], own[maybe]
                    weight, hit = weights(own)
                    score += np.bincount(of, weights=weight, minlength=n)
                    parts.append((of[~hit], own[~hit], np.zeros(int((~hit).sum()), np.int32)))
                of, own, is_word = (np.concatenate(x) for x in zip(*parts))
                # by text and leading bits of the key; keys that are equal there but differ stay apart
                bits = np.uint64(n.bit_length())
                order = np.argsort((of.astype(np.uint64) << (np.uint64(64) - bits)) | (own >> bits))
                of, own, is_word = of[order], own[order], is_word[order]
                new = np.flatnonzero(np.r_[True, (of[1:] != of[:-1]) | (own[1:] != own[:-1])][: len(of)])
                times = np.diff(np.r_[new, len(of)])
                as_word = np.add.reduceat(is_word, new, dtype=np.int32) if len(new) else np.zeros(0, np.int32)
                row = batch["_row"].to_numpy()
                asking.add(row[of[new]], own[new], as_word, (times - as_word).astype(np.int32))
                found = np.bincount(doc, minlength=n), np.bincount(doc[known], minlength=n), base, score
                yield row_of([*(batch[c] for c in ("_row", "_id", "held_out")), *(pa.array(x) for x in found)], n)
            if asking.n > most or batch is None and asking.n:
                first, asked = asking.rows()
                m = len(asked)
                kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64())
                columns = [pa.array([first] * m), pa.nulls(m, id_type), pa.nulls(m, pa.bool_())]
                columns += [pa.nulls(m, k) for k in kinds]
                shard, *values = zip(*asked)
                columns += [pa.array(shard, pa.int32()), *(pa.array(v, pa.binary()) for v in values)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

        return fn

    scored = common.map_batches(rows, make, schema, finish=True)
    scored = common.stored(scored, "scored", rows=common.SLICE)
    asked = scored.where("shard is not null").select(F.col("_row").alias("block"), *(f.name for f in common.fields(_ASKED)))
    # the rows' numbers begin with that of their partition; files without some of them aren't read
    last = (asked.agg(F.max("block")).first()[0] or 0) >> 33
    ends = sorted({(last + 1) * k // ROUNDS << 33 for k in range(ROUNDS + 1)})
    sums = None
    for first, end in zip(ends, ends[1:]):
        some = asked.where(F.col("block").between(first, end - 1))
        found = common.stored(looked_up(some, tree.rest, tree.norm), "looked-up", free=True, rows=16)
        sums = found if sums is None else sums.union(found)
    common.dropped(tree.rest)
    joined = scored.where("shard is null").join(sums, F.col("_row") == F.col("row"), "left")
    log = F.coalesce("log", F.lit(0.0))
    return joined.select(
        F.col("_id").alias(id_col),
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(tree.total).cast("long").alias("train_tokens"),
        (F.col("base") + log).alias("base_score"),
        (F.col("part") + log + F.coalesce("more", F.lit(0.0))).alias("score"),
    )
