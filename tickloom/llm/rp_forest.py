"""Nearest neighbours by a forest of random-projection trees with one priority queue per query."""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm import common

TREES = 8
SAMPLE = 16_384  # distinct vectors that the trees are grown on, at most
LEAF = 64  # sampled vectors below which a node is a leaf
SHARE = 0.9  # of all rows that a query's leaves hold in sum, over all trees
LEAST = 4_000  # rows that a query's leaves hold at least
BLOCK = 2_048  # vectors, and queries, that meet in one group at most, about


class Tree:
    """Split planes of one tree: children below zero are leaves, numbered from ``~child``."""

    def __init__(self, x: np.ndarray, leaf: int, rng: np.random.Generator):
        self.normal, self.offset, self.children, self.leaves = [], [], [], 0
        self.root = self._grow(x, np.arange(len(x)), leaf, rng)
        self.normal = np.array(self.normal).reshape(-1, x.shape[1])
        self.offset = np.array(self.offset)

    def _grow(self, x, rows, leaf, rng) -> int:
        if len(rows) > leaf:
            for _ in range(5):
                a, b = x[rng.choice(rows, 2, replace=False)]
                normal = a - b
                length = np.sqrt(normal @ normal)
                if length > 0:
                    side = x[rows] @ (normal / length)
                    cut = float(np.median(side))
                    right = side > cut
                    if 0.1 < right.mean() < 0.9:
                        node = len(self.normal)
                        self.normal.append(normal / length)
                        self.offset.append(cut)
                        self.children.append(None)
                        low = self._grow(x, rows[~right], leaf, rng)
                        high = self._grow(x, rows[right], leaf, rng)
                        self.children[node] = (low, high)
                        return node
        self.leaves += 1
        return ~(self.leaves - 1)

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        """Leaf number of each row: rows go down the tree together."""
        out = np.zeros(len(x), np.int64)
        open_ = [(self.root, np.arange(len(x)))]
        while open_:
            node, rows = open_.pop()
            if node < 0:
                out[rows] = ~node
            elif len(rows):
                right = x[rows] @ self.normal[node] > self.offset[node]
                open_.append((self.children[node][0], rows[~right]))
                open_.append((self.children[node][1], rows[right]))
        return out


def search(trees: list[Tree], q: np.ndarray, sizes: list[np.ndarray], enough: int) -> list[tuple[int, int]]:
    """Leaves (tree, leaf) for a query, from one queue over all trees, nearest planes first."""
    margins = [t.normal @ q - t.offset for t in trees]
    queue = [(-np.inf, k, t.root) for k, t in enumerate(trees)]
    found, held = [], 0
    while queue and held < enough:
        far, k, node = heapq.heappop(queue)
        while node >= 0:
            margin = margins[k][node]
            low, high = trees[k].children[node]
            near, other = (high, low) if margin > 0 else (low, high)
            heapq.heappush(queue, (max(far, abs(margin)), k, other))
            node = near
        if sizes[k][~node]:
            found.append((k, ~node))
            held += int(sizes[k][~node])
    return found


def _usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """One finite, non-zero vector of the commonest length for each id."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    v = F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), v.alias("v")).where(
        F.col("id").isNotNull() & F.col("v").isNotNull()
    )
    rows = rows.where(F.forall("v", finite) & F.exists("v", lambda x: x != 0))
    rows = rows.groupBy("id").agg(F.min("v").alias("v"))
    rows = common.stored(rows, "vectors")
    lengths = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("v") == (lengths.n if lengths else 0))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def nearest(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    share: float = SHARE,
    least: int = LEAST,
    seed: int = 11,
) -> DataFrame:
    """The ``k`` nearest other vectors found for each query row, by largest inner product.

    ``is_query`` is a condition on the column ``id``, the row's id as a long.

    Returns query_id, rank (from 1), vec_id, score; ties go to the smaller id. Rows with a
    NULL id, and vectors that are NULL, zero, of another length than most or hold NULL or
    non-finite components take no part. Of an id's several vectors the smallest counts.
    Empty tables give no rows; further columns are ignored.

    Equal vectors are one entry with its ``k + 1`` smallest ids, so a very common vector
    is no large leaf. A further component makes all vectors equally long, which turns
    the largest inner product into the nearest vector. The trees are grown on at most
    ``SAMPLE`` entries; every entry is put into every tree. A query's leaves come from
    one queue over all trees until they hold ``share`` of all entries (at least
    ``least``); scores are then exact.
    """
    spark = vectors.sparkSession
    rows = _usable(vectors, id_col, vector_col)
    order = Window.partitionBy("v").orderBy("id")
    ranked = rows.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= k + 1)
    entries = ranked.groupBy("v").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    entries = common.stored(entries.withColumn("entry", F.col("ids")[0]), "entries")
    count, longest = entries.agg(
        F.count("*"), F.max(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    ).first()
    queries = rows.where(is_query).select("id", "v")
    schema = "query_id long, rank int, vec_id long, score double"
    if not count:
        return spark.createDataFrame([], schema)

    def lifted(x: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(longest - np.einsum("ij,ij->i", x, x), 0.0))
        return np.column_stack([x, rest])

    sample = entries.orderBy(F.xxhash64("entry"), "entry").limit(SAMPLE).select("v").toArrow()
    points = lifted(_matrix(sample["v"].combine_chunks()))
    rng = np.random.default_rng(seed)
    forest = [Tree(points, LEAF, rng) for _ in range(TREES)]
    trees = spark.sparkContext.broadcast(forest)  # at most 2 * SAMPLE / LEAF planes a tree

    def place():
        def fn(batch):
            x = lifted(_matrix(batch.column("v")))
            leaves = np.stack([t.leaf_of(x) for t in trees.value], axis=1)
            return [pa.array(list(leaves), pa.list_(pa.int64()))]

        return fn

    placed = common.stored(common.map_rows(entries, ["entry", "v"], place, "leaves array<long>"), "placed")
    spread = placed.select("entry", "v", F.posexplode("leaves").alias("tree", "leaf"))
    sizes = [np.zeros(t.leaves, np.int64) for t in forest]
    for row in spread.groupBy("tree", "leaf").count().collect():  # one row for each leaf
        sizes[row.tree][row.leaf] = row["count"]
    enough = max(int(share * count), least)
    largest = int(max(s.max() for s in sizes))
    parts = -(-largest // BLOCK)
    blocks = -(-queries.count() // BLOCK) or 1

    def probe():
        def fn(batch):
            x = _matrix(batch.column("v"))
            found = [
                [t * 1_000_000 + leaf for t, leaf in search(trees.value, q, sizes, enough)]
                for q in np.column_stack([x, np.zeros(len(x))])
            ]
            return [pa.array(found, pa.list_(pa.int64()))]

        return fn

    probes = common.map_rows(queries, ["id", "v"], probe, "places array<long>")
    probes = common.stored(probes, "probes")
    parts_of = F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    blocks_of = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    asked = probes.select(
        F.col("id").alias("query"), "v", F.explode("places").alias("place"),
        F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("block"),
    ).withColumn("part", parts_of)
    held = spread.select(
        "entry", "v", (F.col("tree") * 1_000_000 + F.col("leaf")).alias("place"),
        F.pmod(F.xxhash64("entry"), F.lit(parts)).cast("int").alias("part"),
    ).withColumn("block", blocks_of)

    def meet(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({"query": [], "entry": [], "score": []})
        q, x = np.stack(left["v"].to_numpy()), np.stack(right["v"].to_numpy())
        ids, entry = left["query"].to_numpy(), right["entry"].to_numpy()
        rough = q @ x.T
        # a few more than wanted: the product's last bits depend on the block's shape
        n = min(k + 9, len(entry))
        out = []
        for i, scores in enumerate(rough):
            at = np.argpartition(-scores, n - 1)[:n]
            limit = scores[at].min() - 1e-9
            at = np.flatnonzero(scores >= limit)
            exact = (x[at] * q[i]).sum(axis=1)
            best = np.lexsort((entry[at], -exact))[: k + 1]
            out.append((np.full(len(best), ids[i]), entry[at][best], exact[best]))
        a, b, c = (np.concatenate(p) for p in zip(*out))
        return pd.DataFrame({"query": a, "entry": b, "score": c})

    key = ["place", "part", "block"]
    met = asked.groupBy(*key).cogroup(held.groupBy(*key)).applyInPandas(
        meet, "query long, entry long, score double"
    )
    met = met.groupBy("query", "entry").agg(F.max("score").alias("score"))
    best = Window.partitionBy("query").orderBy(F.desc("score"), "entry")
    top = met.withColumn("_r", F.row_number().over(best)).where(F.col("_r") <= k + 1)
    ids = entries.select("entry", "ids")
    pairs = top.join(ids, "entry").select("query", "score", F.explode("ids").alias("vec_id"))
    pairs = pairs.where("query <> vec_id")
    final = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    return (
        pairs.withColumn("rank", F.row_number().over(final))
        .where(F.col("rank") <= k)
        .select(F.col("query").alias("query_id"), "rank", "vec_id", "score")
    )

