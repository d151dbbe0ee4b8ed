"""Hard negatives by lists of candidates that the members of an anchor cluster share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickloom.llm import common

SAMPLE = 16_384  # anchors that the directions of the clusters are found on, at most
CLUSTERS = 256  # directions at most
PILOT = 4_096  # candidates that give each anchor its first certified floor
CHUNK_BYTES = 64 << 20  # candidate vectors that a task holds at a time
MEMBERS = 512  # anchors read at a time
FIRST = 256  # candidates of a list that are scored first; then twice as many each time
SLACK = 1e-6  # of a bound, for the rounding of angles
LEAST, MOST = -(2**62), 2**62


class Best:
    """The ``k`` best candidates of a band of scores; ties go to the smaller id.

    ``floor`` is certified: no candidate below it can be among the k best. That of an
    empty band is above all scores.
    """

    def __init__(self, k: int, low: int, high: int, own: int | None = None):
        self.k, self.floor, self.high, self.own = k, low if low <= high else MOST, high, own
        self.scores, self.ids = np.empty(0, np.int64), np.empty(0, np.int64)

    def take(self, scores: np.ndarray, ids: np.ndarray) -> None:
        good = (scores >= self.floor) & (scores <= self.high)
        if self.own is not None:
            good &= ids != self.own
        at = np.flatnonzero(good)
        if len(at):
            scores = np.concatenate([self.scores, scores[at].astype(np.int64)])
            ids = np.concatenate([self.ids, ids[at]])
            first = np.lexsort((ids, -scores))[: self.k]
            self.scores, self.ids = scores[first], ids[first]
            if len(first) == self.k:
                self.floor = max(self.floor, int(self.scores[-1]))


def shared_list(members: np.ndarray, x: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Candidates by falling upper bound of their product with any member of length one.

    A member lies within ``spread`` of the cluster's direction, so its angle to a candidate
    is at least the candidate's angle to that direction less ``spread``.
    """
    unit = members / np.maximum(np.sqrt((members * members).sum(axis=1)), 1e-300)[:, None]
    middle = unit.sum(axis=0)
    size = np.sqrt(middle @ middle)
    middle = middle / size if size > 0 else unit[0]
    spread = np.arccos(np.clip(unit @ middle, -1, 1)).max()
    angle = np.arccos(np.clip(x @ middle / np.maximum(lengths, 1e-300), -1, 1))
    bounds = lengths * (np.cos(np.maximum(angle - spread, 0)) + SLACK)
    order = np.argsort(-bounds, kind="stable")
    return order, bounds[order]


def walk(
    members: np.ndarray,
    bests: list[list[Best]],
    x: np.ndarray,
    ids: np.ndarray,
    floats: Callable[[np.ndarray], np.ndarray] = lambda v: v,
) -> int:
    """Every member walks the shared list until no later candidate can reach its floors.

    Returns the products that were computed.
    """
    u, lengths = floats(members), np.sqrt((floats(x) ** 2).sum(axis=1))
    order, bounds = shared_list(u, floats(x), lengths)
    size = np.sqrt((u * u).sum(axis=1))
    active = np.array([i for i, b in enumerate(bests) if b], np.int64)
    at, step, done = 0, FIRST, 0
    while at < len(order):
        floors = np.array([min(b.floor for b in bests[i]) for i in active], np.float64)
        active = active[size[active] * bounds[at] + SLACK >= floors]
        if not len(active):
            break
        rows = order[at : at + step]
        found = members[active] @ x[rows].T
        for i, scores in zip(active, found):
            for best in bests[i]:
                best.take(scores, ids[rows])
        done += found.size
        at, step = at + step, 2 * step
    return done


def directions(x: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """``k`` unit vectors by a few rounds of k-means on the unit vectors of ``x``."""
    x = x[(x != 0).any(axis=1)]
    if not len(x):
        return np.zeros((1, x.shape[1]))
    x = x / np.sqrt((x * x).sum(axis=1))[:, None]
    centres = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(8):
        nearest = (x @ centres.T).argmax(axis=1)
        for c in np.unique(nearest):
            middle = x[nearest == c].sum(axis=0)
            if (size := np.sqrt(middle @ middle)) > 0:
                centres[c] = middle / size
    return centres


def _matrix(column: pa.Array, exact: bool) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)
    return values.astype(np.float64) if exact else values


def _usable(vectors: DataFrame, id_col: str, label_col: str, vector_col: str, scale: int) -> DataFrame:
    """One row for each id: id, label and v, the floors of the scaled components."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    v = F.col(vector_col).cast("array<double>")
    rows = vectors.select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("label"), v.alias("v")
    ).where("id is not null and label is not null and v is not null")
    rows = rows.where(F.forall("v", finite))
    rows = rows.withColumn("v", F.transform("v", lambda x: F.floor(x * scale)))
    rows = rows.groupBy("id").agg(F.min(F.struct("label", "v")).alias("r")).select("id", "r.*")
    rows = common.stored(rows, "candidates")
    lengths = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("v") == (lengths.n if lengths else 0))


def _blocks(path: str) -> Iterator[pa.RecordBatch]:
    """Inside a task: the anchors of a shared folder, members of a cluster beside each other."""
    fs, inner = common.filesystem(path)
    for info in fs.get_file_info(pa.fs.FileSelector(inner)):
        if info.path.endswith(".parquet"):
            with fs.open_input_file(info.path) as f:
                yield from pq.ParquetFile(f).iter_batches(MEMBERS)


def _bests(batch: pa.RecordBatch, k: int) -> list[list[Best]]:
    columns = [batch.column(c).to_pylist() for c in ("id", "lows", "highs")]
    return [[Best(k, a, b, own) for a, b in zip(low, high)] for own, low, high in zip(*columns)]


def _floors(anchors: DataFrame, pilot, k: int, same: bool, exact: bool) -> DataFrame:
    """The anchors with their lows raised to what the pilot's candidates reach."""

    def make():
        ids, labels, x = pilot.value

        def fn(batch):
            bests = _bests(batch, k)
            scores = _matrix(batch.column("v"), exact) @ x.T
            for own, label, s in zip(bests, batch.column("label").to_pylist(), scores):
                at = np.flatnonzero((labels == label) == same)
                for best in own:
                    best.take(s[at], ids[at])
            lows = [[b.floor for b in own] for own in bests]
            return [pa.array(lows, pa.list_(pa.int64()))]

        return fn

    keep = [c for c in anchors.columns if c != "lows"]
    return common.map_rows(anchors, keep, make, "lows array<long>")


def _search(rows: DataFrame, anchors: DataFrame, k: int, same: bool, exact: bool, chunk: int) -> DataFrame:
    """The ``k`` best candidates (anchor, band, id, score) for each anchor and band.

    Anchors lie in the shared folder by cluster. Each task holds a chunk of the candidates
    and reads the anchors a block at a time; it returns at most k rows a band, so what is
    shuffled doesn't depend on the number of equal or close candidates.
    """
    path = common.shared_folder(rows.sparkSession, "anchors")
    anchors.repartitionByRange("label", "cluster", "id").sortWithinPartitions(
        "label", "cluster", "id"
    ).write.parquet(path)

    def make():
        held: list[pa.RecordBatch] = []

        def meet():
            table = pa.Table.from_batches(held).combine_chunks()
            held.clear()
            ids, labels = table["id"].to_numpy(), np.array(table["label"].to_pylist())
            x = _matrix(table["v"].combine_chunks(), exact)
            for block in _blocks(path):
                own, cluster = block.column("label").to_pylist(), block.column("cluster").to_pylist()
                u, bests = _matrix(block.column("v"), exact), _bests(block, k)
                cuts = [i for i in range(len(own)) if not i or (own[i], cluster[i]) != (own[i - 1], cluster[i - 1])]
                for a, b in zip(cuts, [*cuts[1:], len(own)]):
                    at = np.flatnonzero((labels == own[a]) == same)
                    walk(u[a:b], bests[a:b], x[at], ids[at], lambda v: v.astype(np.float64, copy=False))
                found = [
                    (anchor, band, best)
                    for anchor, mine in zip(block.column("id").to_pylist(), bests)
                    for band, best in enumerate(mine)
                    if len(best.ids)
                ]
                if found:
                    sizes = [len(best.ids) for _, _, best in found]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.repeat([a for a, _, _ in found], sizes)),
                            pa.array(np.repeat(np.array([b for _, b, _ in found], np.int32), sizes)),
                            pa.array(np.concatenate([best.ids for _, _, best in found])),
                            pa.array(np.concatenate([best.scores for _, _, best in found])),
                        ],
                        names=["anchor", "band", "id", "score"],
                    )

        def fn(batch):
            if batch is not None:
                held.append(batch)
            if held and (batch is None or sum(b.num_rows for b in held) >= chunk):
                yield from meet()

        return fn

    met = common.map_batches(
        rows.select("id", "label", "v"), make, "anchor long, band int, id long, score long", True, chunk
    )
    order = Window.partitionBy("anchor", "band").orderBy(F.desc("score"), "id")
    return met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
    scale: int = 256,
    id_col: str = "vec_id",
    label_col: str = "label",
    vector_col: str = "embedding",
    seed: int = 12,
) -> DataFrame:
    """For each anchor and each of its positives, the closest rows of other labels in a band.

    ``is_anchor`` is a condition on the column ``id``, the row's id as a long. Components
    become floor(scale * x); a score is their integer inner product. An anchor's positives
    are the ``positives`` best other rows of its label. A negative has another label and
    ``low`` to ``high`` percent of the positive's score; the ``negatives`` best are returned
    (higher scores first, ties by smaller id). A negative positive_score has no such band.

    Returns anchor_id, positive_id, rank (from 1), negative_id, positive_score,
    negative_score. Rows with a NULL id or label, and vectors that are NULL, of another
    length than most or hold NULL or non-finite components take no part. Of an id's several
    rows the least (label, vector) counts. Empty tables and anchors without positives give
    no rows; further columns are ignored. Components whose products don't fit into a long
    raise.

    Anchors are clustered by label and direction (directions from at most ``SAMPLE``
    anchors). For each cluster a task sorts its candidates once by their angular upper
    bound, and every member walks that list until the bound falls below its floor: the
    last of its best so far, at first that of ``PILOT`` common candidates. So the results
    are exact; the pilot and the clusters only shorten the walks. No task holds more than
    ``CHUNK_BYTES`` of candidates and ``MEMBERS`` anchors, however many rows share a label,
    a direction or a vector.
    """
    spark = vectors.sparkSession
    rows = _usable(vectors, id_col, label_col, vector_col, scale)
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    square = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    count, longest, size = rows.agg(F.count("*"), F.max(square), F.max(F.size("v"))).first()
    if not count or not size:
        return spark.createDataFrame([], schema)
    if longest >= MOST:
        raise ValueError("inner products of the scaled components don't fit into a long")
    exact = longest < 2**53  # then products, and their sums in doubles, are whole numbers
    chunk = max(CHUNK_BYTES // (8 * size), 1_024)
    cores = spark.sparkContext.defaultParallelism
    parts = max(-(-count // chunk), min(cores, -(-count // 1_024)))
    dealt = common.stored(rows.repartition(parts, "id"), "dealt")

    anchors = rows.where(is_anchor)
    n_anchors = anchors.count()
    if not n_anchors:
        return spark.createDataFrame([], schema)
    by_hash = [F.xxhash64("id"), "id"]
    some = anchors.orderBy(*by_hash).limit(SAMPLE).select("v").toArrow()["v"].combine_chunks()
    k = min(CLUSTERS, max(1, int(np.sqrt(n_anchors) / 2)))
    centres = spark.sparkContext.broadcast(
        directions(_matrix(some, True), k, np.random.default_rng(seed))
    )
    taken = rows.orderBy(*by_hash).limit(PILOT).toArrow()
    pilot = spark.sparkContext.broadcast(
        (
            taken["id"].to_numpy(),
            np.array(taken["label"].to_pylist()),
            _matrix(taken["v"].combine_chunks(), exact),
        )
    )

    def place():
        def fn(batch):
            x = _matrix(batch.column("v"), True)
            return [pa.array((x @ centres.value.T).argmax(axis=1).astype(np.int32))]

        return fn

    anchors = common.map_rows(anchors, ["id", "label", "v"], place, "cluster int")
    anchors = common.stored(anchors, "clustered")
    open_ = anchors.withColumns(
        {"lows": F.array(F.lit(LEAST).cast("long")), "highs": F.array(F.lit(MOST).cast("long"))}
    )
    best = _search(dealt, _floors(open_, pilot, positives, True, exact), positives, True, exact, chunk)
    best = common.stored(
        best.select(F.col("anchor"), F.col("id").alias("positive"), F.col("score").alias("p"), "rank"),
        "positives",
    )
    # an anchor's bands in the order of its positives, so the band's number is a rank
    bands = best.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("rank", "p"))).alias("ps"))
    share = lambda s, percent: s.p.cast("decimal(20,0)") * F.lit(percent) / F.lit(100)
    ceil = F.transform("ps", lambda s: F.ceil(share(s, low)).cast("long"))
    floor = F.transform("ps", lambda s: F.floor(share(s, high)).cast("long"))
    bounded = anchors.join(bands.withColumnRenamed("anchor", "id"), "id").select(
        *anchors.columns, ceil.alias("lows"), floor.alias("highs")
    )
    found = _search(dealt, _floors(bounded, pilot, negatives, False, exact), negatives, False, exact, chunk)
    found = found.withColumn("at", F.col("band") + 1)
    named = best.withColumnRenamed("rank", "at")
    return found.join(named, ["anchor", "at"]).select(
        F.col("anchor").alias("anchor_id"),
        F.col("positive").alias("positive_id"),
        "rank",
        F.col("id").alias("negative_id"),
        F.col("p").alias("positive_score"),
        F.col("score").alias("negative_score"),
    )
