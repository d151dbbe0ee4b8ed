"""Similarity join on word 5-gram sets, with prefix filters under several token orders."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm import common, graph

SHINGLE = 5  # words
BUCKETS = 1 << 20  # of the hashed shingle frequencies
CHUNK = 1 << 13  # of these a row holds when tasks' counts are added up
ADDED = 64  # rows of one chunk that a group adds up at most
CROWD = 256  # documents of a token that still meet in pairs
ROUNDS = 4  # times at most that the documents of crowded tokens get an order of their own
ORDERS = 3  # global token orders whose prefixes candidates must share
REMEMBERED = 300_000  # sets that a task remembers
BLOOM_BITS = 1 << 28  # 32 MB at most

_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_ODD = [np.uint64(x | 1) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                                   0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63)]


def _mixed(x: np.ndarray, salt: int = 0) -> np.ndarray:
    x = x ^ np.uint64(salt * 0x9E3779B97F4A7C15 % 2**64)
    x = (x ^ (x >> np.uint64(33))) * _M1
    x = (x ^ (x >> np.uint64(33))) * _M2
    return x ^ (x >> np.uint64(33))


_rng = np.random.default_rng(20_241)
_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True
# A random value for each byte, the same for A-Z and a-z; white space is worth nothing.
_VALUE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_VALUE[65:91] = _VALUE[97:123]
_VALUE[_WHITE] = 0
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


class WordHashes:
    """Hashes of all words of a text at once: polynomials in an odd base modulo 2 ** 64."""

    def __init__(self) -> None:
        self.powers = self.inverses = np.ones(1, np.uint64)

    def _reach(self, n: int) -> None:
        size = len(self.powers)
        while size < n:
            up = np.uint64(pow(_BASE, size, 1 << 64))
            down = np.uint64(pow(_INVERSE, size, 1 << 64))
            self.powers = np.concatenate([self.powers, self.powers * up])
            self.inverses = np.concatenate([self.inverses, self.inverses * down])
            size *= 2

    def __call__(self, text: bytes) -> np.ndarray:
        return self.with_starts(text)[0]

    def with_starts(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        """The hashes, and where in the text each word begins."""
        b = np.frombuffer(text, np.uint8)
        inside = np.concatenate([[False], ~_WHITE[b], [False]])
        change = np.flatnonzero(inside[1:] != inside[:-1])
        starts, ends = change[::2], change[1::2]
        if not len(starts):
            return np.zeros(0, np.uint64), starts
        self._reach(len(b))
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_VALUE[b] * self.powers[: len(b)])])
        h = (total[ends] - total[starts]) * self.inverses[starts]
        return _mixed(h + (ends - starts).astype(np.uint64)), starts


def shingles(text: bytes, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's word shingles; of all words if there are fewer."""
    h = hashes(text)
    n = min(SHINGLE, len(h))
    if not n:
        return np.zeros(0, np.uint64)
    total = np.full(len(h) - n + 1, n, np.uint64)
    for k in range(n):
        total += h[k : len(h) - n + 1 + k] * _ODD[k]
        total = (total << np.uint64(13)) | (total >> np.uint64(51))
    return np.unique(_mixed(total))


def required(n: int, percent: int) -> int:
    """Least overlap of a set of size ``n`` with any set that it links with."""
    return -(-percent * n // 100)


def rarity(counts: np.ndarray) -> np.ndarray:
    """log2 of how far each hash bucket's frequency lies above the median bucket.

    The median is what rare tokens add up to. It grows with the corpus, its spread only as
    the root, so a passage of many documents stands out at every size.
    """
    return np.log2(np.maximum(counts - np.median(counts), 1)).astype(np.uint8)


def prefix(tokens: np.ndarray, frequency: np.ndarray, order: int, percent: int) -> np.ndarray:
    """The first tokens under a global order, so many that linked sets share one of them.

    All orders put rare tokens first, by the ``rarity`` of their hash bucket, and
    differ in how they order tokens of one class.
    """
    n = len(tokens) - required(len(tokens), percent) + 1
    rank = _mixed(tokens, order + 1) >> np.uint64(8)
    rank |= frequency[(tokens % np.uint64(len(frequency))).astype(np.int64)].astype(np.uint64) << np.uint64(56)
    return tokens[np.lexsort((tokens, rank))[:n]]


def least_overlap(n_a: int, n_b: int, percent: int) -> int:
    """Least overlap with which sets of these sizes link."""
    return -(-percent * (n_a + n_b) // (100 + percent))


def may_link(x: np.ndarray, y: np.ndarray, n_a: int, n_b: int, percent: int) -> bool:
    """Whether two prefixes share a token with enough tokens from it on in both sets.

    The first token that linked sets share is such a token: all that they share lies there.
    """
    _, i, j = np.intersect1d(x, y, return_indices=True)
    need = least_overlap(n_a, n_b, percent)
    return bool(((n_a - i >= need) & (n_b - j >= need)).any())


def parities(tokens: np.ndarray) -> np.ndarray:
    """Bits that tell whether an odd number of the tokens fall into each of some buckets.

    There are two to four buckets a token, a power of two.
    """
    buckets = max(8, 2 << (len(tokens) - 1).bit_length())
    held = np.bincount((tokens % np.uint64(buckets)).astype(np.int64), minlength=buckets)
    return np.packbits(held.astype(np.uint8) & 1, bitorder="little")


def may_agree(x: np.ndarray, y: np.ndarray, n_a: int, n_b: int, percent: int) -> bool:
    """Whether sets of these parities may link: no more bits differ than tokens would.

    A token of both sets changes the same bit of both; so each differing bit needs a token
    that only one set has. Of the longer bits the halves are added up first.
    """
    while len(x) > len(y):
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    while len(y) > len(x):
        y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    differ = int(np.bitwise_count(x ^ y).sum())
    return differ <= n_a + n_b - 2 * least_overlap(n_a, n_b, percent)


def links(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether 100 * intersection >= percent * union."""
    small, large = min(len(a), len(b)), max(len(a), len(b))
    if 100 * small < percent * large:
        return False
    at = np.minimum(np.searchsorted(a, b), len(a) - 1)
    same = int(np.count_nonzero(a[at] == b))
    return 100 * same >= percent * (len(a) + len(b) - same)


# --- what tasks read from the shared folder ---------------------------------------

_LOADED: dict[str, np.ndarray] = {}


def _load(path: str, size: int, kind: str) -> np.ndarray:
    """A flat array that Spark wrote as rows (at, value); kept by the worker."""
    if path not in _LOADED:
        if len(_LOADED) > 1:
            _LOADED.clear()
        out = np.zeros(size, kind)
        fs, inner = common.filesystem(path)
        for info in fs.get_file_info(pa.fs.FileSelector(inner)):
            if info.path.endswith(".parquet"):
                with fs.open_input_file(info.path) as f:
                    rows = pq.ParquetFile(f).read()
                out[rows["at"].to_numpy()] = rows["value"].to_numpy().astype(kind, copy=False)
        _LOADED[path] = out
    return _LOADED[path]


def _write_array(df: DataFrame, name: str) -> str:
    path = common.shared_folder(df.sparkSession, name)
    df.select("at", "value").write.parquet(path)
    return path


def _passing(batch: pa.RecordBatch, only: tuple[str, int] | None) -> pa.RecordBatch:
    """The rows that the Bloom filter of some documents lets pass, by their column _at."""
    if only is None:
        return batch
    at = batch.column("_at").to_numpy()
    wanted = _load(only[0], only[1] // 64, "i8").view("<u8")
    hit = (wanted[at // 64] >> (at % 64).astype(np.uint64)) & np.uint64(1) == 1
    return batch.filter(pa.array(hit))


def _flagged(docs: DataFrame, only: tuple[str, int] | None) -> DataFrame:
    return docs if only is None else docs.withColumn("_at", F.pmod(F.xxhash64("doc"), F.lit(only[1])))


def hashed_frequencies(docs: DataFrame, only: tuple[str, int] | None = None) -> str:
    """The shingles in each hash bucket, counted once a document, over the whole corpus.

    With ``only`` (see ``bloom``) over the documents that the filter lets pass.

    Each task counts into a flat array and passes it on by chunks; groups of ``ADDED``
    tasks add up a chunk, then groups of groups, so no group grows with the corpus.
    """

    def make():
        hashes, counts = WordHashes(), np.zeros(BUCKETS, np.uint32)

        def fn(batch):
            if batch is not None:
                for text in common.texts(_passing(batch, only), "_text"):
                    tokens = shingles(text, hashes)
                    np.add.at(counts, (tokens % np.uint64(BUCKETS)).astype(np.int64), 1)
                return
            rows = counts.reshape(-1, CHUNK)
            at = np.flatnonzero(rows.any(axis=1))
            part = TaskContext.get().partitionId()
            for first in range(0, len(at), 32):
                some = at[first : first + 32]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(some), pa.array(np.full(len(some), part)), pa.array([_packed(rows[i]) for i in some], pa.binary())],
                    names=["chunk", "part", "counts"],
                )

        return fn

    schema = "chunk long, part long, counts binary"

    def add(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        total = sum(_unpacked(x) for x in rows["counts"])
        return pd.DataFrame([{"chunk": key[0], "part": key[1], "counts": _packed(total)}])

    def flat(batch: pa.RecordBatch):
        for chunk, counts in zip(batch.column("chunk").to_pylist(), batch.column("counts").to_pylist()):
            found = _unpacked(counts)
            at = np.flatnonzero(found)
            yield pa.RecordBatch.from_arrays(
                [pa.array(at + chunk * CHUNK), pa.array(found[at])], names=["at", "value"]
            )

    source = _flagged(docs, only)
    counted, parts = common.map_batches(source, make, schema, finish=True), source.rdd.getNumPartitions()
    while True:
        parts = -(-parts // ADDED)
        grouped = counted.withColumn("part", F.floor(F.col("part") / ADDED))
        counted = common.stored(grouped.groupBy("chunk", "part").applyInPandas(add, schema), "counts")
        if parts <= 1:
            break
    return _write_array(common.map_batches(counted, lambda: flat, "at long, value long"), "frequencies")


def _packed(counts: np.ndarray) -> bytes:
    """Counts in as few bytes each as hold them all, the first byte tells how many."""
    width = 1 << max(0, (int(counts.max()).bit_length() - 1).bit_length() - 3) if counts.max() else 1
    return bytes([width]) + counts.astype(f"<u{width}").tobytes()


def _unpacked(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, f"<u{raw[0]}", offset=1).astype(np.int64)


def bloom(ids: DataFrame) -> tuple[str, int]:
    """A Bloom filter (one bit a value) of the ids, as 64-bit words in the shared folder.

    Its size follows the rows, which may name an id several times.
    """
    bits = 1 << 16
    wanted = 8 * ids.count()
    while bits < min(wanted, BLOOM_BITS):
        bits *= 2
    h = F.pmod(F.xxhash64("doc"), F.lit(bits))
    words = ids.select(F.floor(h / 64).cast("long").alias("at"), F.expr(f"shiftleft(1L, cast(pmod(xxhash64(doc), {bits}) % 64 as int))").alias("bit"))
    return _write_array(words.groupBy("at").agg(F.bit_or("bit").alias("value")), "bloom"), bits


# --- the join -----------------------------------------------------------------------


def signatures(docs: DataFrame) -> DataFrame:
    """Set size and 128-bit signature of each document's shingle set."""

    def make():
        hashes = WordHashes()

        def fn(batch):
            sets = [shingles(t, hashes) for t in common.texts(batch, "_text")]
            raw = b"".join(xxhash.xxh3_128_digest(s.tobytes()) for s in sets)
            h = np.frombuffer(raw, "<i8").reshape(-1, 2)
            return [
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array(np.ascontiguousarray(h[:, 0])),
                pa.array(np.ascontiguousarray(h[:, 1])),
            ]

        return fn

    return common.map_rows(docs, ["doc"], make, "n long, h1 long, h2 long")


def prefix_tokens(
    docs: DataFrame, frequencies: str, percent: int, only: tuple[str, int] | None = None
) -> DataFrame:
    """Rows (token, doc, n, at) of prefixes under the first order, ``at`` a token's place in it.

    With ``only`` (see ``bloom``) of the documents that the filter lets pass.

    Of documents with one set, a task passes on the first it meets, so a large group of
    copies costs its prefix once a task.
    """

    def make():
        hashes, seen = WordHashes(), set()
        frequency = rarity(_load(frequencies, BUCKETS, "i8"))

        def fn(batch):
            tokens, ids, sizes, places = [], [], [], []
            batch = _passing(batch, only)
            for doc, text in zip(batch.column("doc").to_pylist(), common.texts(batch, "_text")):
                own = shingles(text, hashes)
                signature = xxhash.xxh3_128_digest(own.tobytes())
                if not len(own) or signature in seen:
                    continue
                if len(seen) >= REMEMBERED:
                    seen.clear()
                seen.add(signature)
                first = prefix(own, frequency, 0, percent)
                tokens.append(first.view(np.int64))
                ids.append(np.full(len(first), doc, np.int64))
                sizes.append(np.full(len(first), len(own), np.int32))
                places.append(np.arange(len(first), dtype=np.int32))
            if tokens:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(x)) for x in (tokens, ids, sizes, places)],
                    names=["token", "doc", "n", "at"],
                )

        return fn

    return common.map_batches(_flagged(docs, only), make, "token long, doc long, n int, at int")


def candidates(
    docs: DataFrame, named: DataFrame, frequencies: str, percent: int, what: str
) -> DataFrame:
    """Of the named documents (column doc) and few others: set size, and tokens or prefixes.

    ``what`` is "tokens" (the sorted set) or "prefixes" (those under all orders but the
    first, tokens cut to 32 bits: a filter may let more through, never less; then the
    set's parities). The others are what a Bloom filter of the names lets pass. The rows
    are dealt by document once.
    """
    only = bloom(named)

    def make():
        hashes = WordHashes()
        frequency = rarity(_load(frequencies, BUCKETS, "i8"))

        def content(own: np.ndarray) -> bytes:
            if what == "tokens" or not len(own):
                return own.tobytes()
            parts = [prefix(own, frequency, k, percent) for k in range(1, ORDERS)]
            return np.concatenate(parts).astype("<u4").tobytes() + parities(own).tobytes()

        def fn(batch):
            batch = _passing(batch, only)
            sets = [shingles(t, hashes) for t in common.texts(batch, "_text")]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc"),
                    pa.array([len(s) for s in sets], pa.int32()),
                    pa.array([content(s) for s in sets], pa.binary()),
                ],
                names=["doc", "n", "content"],
            )

        return fn

    flagged = _flagged(docs, only)
    return common.map_batches(flagged, make, "doc long, n int, content binary").repartition("doc")


def _similar_size(percent: int) -> str:
    return f"100L * least(n_a, n_b) >= {percent}L * greatest(n_a, n_b)"


def _may_link(percent: int) -> str:
    """``may_link`` for a token that both prefixes hold, in SQL."""
    need = f"ceil({percent}L * (n_a + n_b) / {100 + percent}.0D)"
    return f"{_similar_size(percent)} and n_a - at_a >= {need} and n_b - at_b >= {need}"


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("doc")).union(pairs.select(F.col("b").alias("doc")))


def verified(pairs: DataFrame, docs: DataFrame, frequencies: str, percent: int) -> DataFrame:
    """The stored pairs (a, b) that link.

    First they must pass the filters of the other orders and the parities, then the sets
    decide, which are sent for few pairs that don't link.
    """

    def keeping(rows: DataFrame, what: str, test) -> DataFrame:
        sets = candidates(docs, _ends(rows), frequencies, percent, what)
        left = sets.select(F.col("doc").alias("a"), F.col("n").alias("n_a"), F.col("content").alias("of_a"))
        right = sets.select(F.col("doc").alias("b"), F.col("n").alias("n_b"), F.col("content").alias("of_b"))
        joined = rows.join(left, "a").join(right, "b").where(_similar_size(percent))
        columns = ["of_a", "of_b", "n_a", "n_b"]

        def make():
            def fn(batch):
                found = zip(*(batch.column(c).to_pylist() for c in columns))
                hit = [test(x, y, n, m) for x, y, n, m in found]
                yield batch.select(["a", "b"]).filter(pa.array(hit, pa.bool_()))

            return fn

        kept = common.map_batches(joined.select("a", "b", *columns), make, "a long, b long", rows=64)
        return common.stored(kept.distinct(), f"pairs-by-{what}")

    def meet_in_all(x: bytes, y: bytes, n_a: int, n_b: int) -> bool:
        (a, more_a), (b, more_b) = parted(x, n_a), parted(y, n_b)
        if not may_agree(more_a, more_b, n_a, n_b, percent):
            return False
        return all(may_link(a[k], b[k], n_a, n_b, percent) for k in range(ORDERS - 1))

    def parted(content: bytes, n: int) -> tuple[np.ndarray, np.ndarray]:
        held = (ORDERS - 1) * (n - required(n, percent) + 1)
        prefixes = np.frombuffer(content, "<u4", held).reshape(ORDERS - 1, -1)
        return prefixes, np.frombuffer(content, np.uint8, offset=4 * held)

    def agree(x: bytes, y: bytes, n_a: int, n_b: int) -> bool:
        return links(np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8"), percent)

    rows = keeping(pairs, "prefixes", meet_in_all)
    return keeping(rows, "tokens", agree)


def similarity_components(
    docs: DataFrame, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Shingle count and component of every document under exact set similarity.

    Two documents link if 100 * intersection >= percent * union of their sets of distinct
    word 5-grams. Returns one row per input row: id, n_shingles, component_id (the
    smallest id that links reach). NULL and empty texts have no shingles and link with
    nothing; rows with one id are one document; a NULL id has no component; an empty
    table gives no rows; further columns are ignored.

    1. Equal sets are one class by signature; classes are represented by their smallest id.
    2. Prefix tokens under the first order are shuffled; tokens of one document end there.
    3. Each token's smallest document is paired with the others, which is linear.
       Pairs must also share prefixes under the other orders, then the sets decide.
    4. Where a token's documents are still in several components, the pairs between
       components are tried in the same way. So all links that could join components
       are tried, and large groups of near copies don't meet all pairs. Of tokens with more
       than ``CROWD`` documents, which passed for rare by their hash buckets, the documents
       get an order by the frequencies among them alone, and meet in its prefixes instead;
       ``ROUNDS`` times at most, as long as such tokens are left.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("_text"))
    base = common.stored(signatures(rows), "signatures")
    known = base.where("doc is not null and n > 0")
    classes = known.groupBy("h1", "h2").agg(F.min("doc").alias("rep"), F.count("*").alias("_m"))
    classes = common.stored(classes, "classes")
    copies = known.join(classes.where("_m > 1"), ["h1", "h2"]).select(
        F.col("doc").alias("a"), F.col("rep").alias("b")
    )
    copies = common.stored(copies.where("a <> b").distinct(), "copies")

    texts = rows.where("doc is not null")
    frequencies = hashed_frequencies(texts)
    dealt = prefix_tokens(texts, frequencies, percent).repartition("token")
    leader = F.min(F.struct("doc", "n", "at")).alias("leader")
    several = dealt.groupBy("token").agg(leader, F.max("doc").alias("_last"), F.count("*").alias("m"))
    several = several.where("leader.doc < _last").drop("_last")
    shared = dealt.join(several.hint("shuffle_hash"), "token").distinct()
    shared = common.stored(shared, "shared-tokens")

    led = shared.selectExpr(
        "doc as a", "n as n_a", "at as at_a", "leader.doc as b", "leader.n as n_b", "leader.at as at_b"
    )
    first = led.where("a <> b").where(_may_link(percent)).select("a", "b").distinct()
    # copies are linked already: of each class only the representative goes on
    for x in "ab":
        of = copies.select(F.col("a").alias("_copy"), F.col("b").alias("_rep"))
        first = first.join(of, F.col(x) == F.col("_copy"), "left")
        first = first.withColumn(x, F.coalesce("_rep", x)).drop("_copy", "_rep")
    first = first.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    first = common.stored(first.distinct(), "first-pairs")
    copied = copies.select("a", "b")
    first_links = verified(first, texts, frequencies, percent)
    found = graph.components(copied.union(first_links))

    root = found.select(F.col("node").alias("doc"), "root")
    # of two documents, the only pair has been tried
    left = _open_tokens(shared.where("m > 2").select("token", "doc", "n", "at"), root)
    across = None
    for k in range(ROUNDS + 1):
        crowds = left.groupBy("token").count().where(F.col("count") > CROWD).select("token")
        crowds = common.stored(crowds, "crowded-tokens")
        few = left if k == ROUNDS else left.join(crowds, "token", "left_anti")
        found_here = _pairs_across(few, percent)
        across = found_here if across is None else across.union(found_here)
        if k == ROUNDS or crowds.isEmpty():
            break
        # both documents of a pair that meets in a crowded token are among these, and must
        # share a prefix token under any order: under one by the frequencies among them
        among = bloom(left.join(crowds, "token", "left_semi").select("doc"))
        dealt = prefix_tokens(texts, hashed_frequencies(texts, among), percent, among)
        left = _open_tokens(common.stored(dealt, "crowd-prefixes"), root)
    across = common.stored(across.distinct().join(first, ["a", "b"], "left_anti"), "pairs")
    all_links = copied.union(first_links).union(verified(across, texts, frequencies, percent))
    # rows that share an id are one document: their sets' classes belong together
    result = common.stored(graph.components(all_links), "components")
    return base.join(result, base.doc == result.node, "left").select(
        base.doc.alias(id_col), base.n.alias("n_shingles"), F.coalesce("root", "doc").alias("component_id")
    )


def _open_tokens(prefixes: DataFrame, root: DataFrame) -> DataFrame:
    """The rows of tokens whose documents lie in several components, each with its root."""
    placed = prefixes.join(root, "doc", "left").withColumn("root", F.coalesce("root", "doc"))
    open_tokens = placed.groupBy("token").agg(F.min("root").alias("_a"), F.max("root").alias("_b"))
    open_tokens = open_tokens.where("_a < _b").select("token")
    return common.stored(placed.join(open_tokens, "token", "left_semi"), "open-tokens")


def _pairs_across(rows: DataFrame, percent: int) -> DataFrame:
    """Pairs of one token's documents in different components that may link."""
    a, b = (
        rows.selectExpr("token", f"doc as {x}", f"n as n_{x}", f"at as at_{x}", f"root as r_{x}")
        for x in "ab"
    )
    across = a.join(b, "token").where("r_a < r_b").where(_may_link(percent))
    return across.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def one_of_each_group(
    docs: DataFrame, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The documents without those that a document with a smaller id leads a group of.

    All columns stay. Rows without an id, text or words link with nothing and stay. Of rows
    that repeat id and text one stays (the least by its other columns), rows of one id with
    different texts all stay, or all go where the id's group has a smaller one. An empty
    table gives no rows.
    """
    found = similarity_components(docs, percent, id_col, text_col)
    gone = common.stored(
        found.where(F.col("component_id") < F.col(id_col)).select(F.col(id_col).alias("_gone")).distinct(),
        "copies-to-drop",
    )
    small = gone.count() <= 200_000
    kept = docs.join(F.broadcast(gone) if small else gone, F.col(id_col) == F.col("_gone"), "left_anti")
    ids = docs.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_again")).count()
    again = common.stored(ids.where("count > 1").select("_again"), "repeated-ids")
    if again.isEmpty():
        return kept
    # only rows of repeated ids are compared by their texts
    same = F.col(id_col) == F.col("_again")
    others = [c for c in docs.columns if c not in (id_col, text_col)]
    repeated = kept.join(again, same, "left_semi")
    if others:
        least = F.min(F.struct(*[F.col(f"`{c}`") for c in others])).alias("_rest")
        repeated = repeated.groupBy(id_col, text_col).agg(least).select(id_col, text_col, "_rest.*")
    else:
        repeated = repeated.distinct()
    return kept.join(again, same, "left_anti").unionByName(repeated.select(*docs.columns))
