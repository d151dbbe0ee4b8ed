"""Quality classifier: naive Bayes support vectors over hashed byte n-grams."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm import common

BITS = 18  # of the hashed feature space
ORDERS = (2, 3, 4)  # byte n-grams
SAMPLE = 8_000  # labelled documents that the classifier is fitted on, at most
FITTED = 512  # of them that go to the fitting task in one Arrow batch


def ngrams(text: bytes) -> np.ndarray:
    """The distinct n-grams of a text as indices into the hashed feature space."""
    b = np.frombuffer(text, np.uint8).astype(np.uint32)
    found = []
    code = b
    for n in range(2, max(ORDERS) + 1):
        if len(b) < n:
            break
        code = (code[:-1] << np.uint32(8)) | b[n - 1 :]
        if n in ORDERS:
            mixed = (code ^ np.uint32(0x5BD1E995 * n & 0xFFFFFFFF)) * np.uint32(2654435761)
            found.append((mixed ^ (mixed >> np.uint32(15))) >> np.uint32(32 - BITS))
    if not found:
        return np.zeros(0, np.int32)
    return np.unique(np.concatenate(found)).astype(np.int32)


class Model:
    """Weights over the hashed n-grams, with the curve that makes margins probabilities."""

    def __init__(self, ratio: np.ndarray, weight: np.ndarray, bias: float, a: float, b: float):
        self.ratio, self.weight, self.bias, self.a, self.b = ratio, weight, bias, a, b

    def margin(self, features: np.ndarray) -> float:
        x = self.ratio[features]
        norm = float(np.sqrt(x @ x)) or 1.0
        return float(x @ self.weight[features]) / norm + self.bias

    def score(self, features: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.a * self.margin(features) + self.b, -500, 500))))


def log_count_ratio(rows: list[np.ndarray], y: np.ndarray, alpha: float = 1.0) -> np.ndarray:
    """Log of the ratio between the shares that a feature has of either class's counts."""
    counts = np.full((2, 1 << BITS), alpha)
    for features, label in zip(rows, y):
        counts[int(label > 0), features] += 1
    share = counts / counts.sum(axis=1, keepdims=True)
    return np.log(share[1] / share[0])


class Scaled(Sequence):
    """The values of each row's features, of length 1; made when asked for, never held for all rows."""

    def __init__(self, rows: list[np.ndarray], ratio: np.ndarray):
        self.rows, self.ratio = rows, ratio

    def __len__(self) -> int:
        return len(self.rows)

    def __getitem__(self, i: int) -> np.ndarray:
        x = self.ratio[self.rows[i]]
        return x / (np.sqrt(x @ x) or 1.0)


def dual_coordinate_descent(
    rows: list[np.ndarray],
    values: Sequence[np.ndarray],
    y: np.ndarray,
    cost: np.ndarray,
    epochs: int = 12,
    seed: int = 7,
) -> tuple[np.ndarray, float]:
    """Linear support vectors with hinge loss: one dual variable is solved for at a time.

    The bias is the weight of a constant feature. ``cost`` bounds each dual variable.
    """
    w, bias = np.zeros(1 << BITS), 0.0
    alpha = np.zeros(len(rows))
    diagonal = np.array([v @ v + 1.0 for v in values])
    order = np.random.default_rng(seed)
    for _ in range(epochs):
        largest = 0.0
        for i in order.permutation(len(rows)):
            own = values[i]
            gradient = y[i] * (own @ w[rows[i]] + bias) - 1.0
            new = min(max(alpha[i] - gradient / diagonal[i], 0.0), cost[i])
            step = (new - alpha[i]) * y[i]
            if step:
                w[rows[i]] += step * own
                bias += step
                largest = max(largest, abs(step))
                alpha[i] = new
        if largest < 1e-3:
            break
    return w, bias


def _curve(margins: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve through margins, by Newton steps."""
    t = np.where(y > 0, (np.sum(y > 0) + 1) / (np.sum(y > 0) + 2), 1 / (np.sum(y <= 0) + 2))
    a, b = 1.0, 0.0
    x = np.stack([margins, np.ones_like(margins)])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margins + b, -30, 30)))
        gradient = x @ (p - t) + np.array([1e-3 * a, 0])
        hessian = (x * (p * (1 - p))) @ x.T + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-6:
            break
    return float(max(a, 1e-3)), float(b)


def fit(rows: list[np.ndarray], labels: np.ndarray, c: float = 1.0) -> Model:
    """Fit on four fifths of the rows, place the curve by the rest, on which nothing else is fitted.

    With rows of one class only, or none, every text gets the share of that class.
    """
    y = np.where(labels > 0, 1.0, -1.0)
    if len(set(y.tolist())) < 2:
        share = 0.5 if not len(y) else 0.99 if y[0] > 0 else 0.01
        zero = np.zeros(1 << BITS)
        return Model(zero, zero, 0.0, 1.0, float(np.log(share / (1 - share))))
    held = np.arange(len(y)) % 5 == 4
    if len(set(y[held].tolist())) < 2 or len(set(y[~held].tolist())) < 2:
        held = np.zeros(len(y), bool)
    fitted = np.flatnonzero(~held)
    ratio = log_count_ratio([rows[i] for i in fitted], y[fitted])

    # both classes weigh the same in sum
    n = len(fitted)
    cost = c * np.where(y[fitted] > 0, n / 2 / np.sum(y[fitted] > 0), n / 2 / np.sum(y[fitted] < 0))
    own = [rows[i] for i in fitted]
    weight, bias = dual_coordinate_descent(own, Scaled(own, ratio), y[fitted], cost)
    model = Model(ratio, weight, bias, 1.0, 0.0)
    curve = np.flatnonzero(held) if held.any() else fitted
    model.a, model.b = _curve(np.array([model.margin(rows[i]) for i in curve]), y[curve])
    return model


def training_sample(
    docs: DataFrame,
    labels: DataFrame,
    usable: Column,
    label_col: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    sample: int = SAMPLE,
) -> DataFrame:
    """Features and label of at most ``sample`` labelled documents, chosen by a hash of the id.

    The chosen ids are bounded by ``sample``, so they are broadcast to the documents. Of
    several rows with one id, one text and the commoner label count.
    """
    known = labels.where(usable & F.col(label_col).isNotNull()).groupBy(id_col)
    chosen = (
        known.agg(F.when(F.avg(label_col) >= 0.5, 1).otherwise(0).alias("_label"))
        .orderBy(F.xxhash64(id_col), id_col)
        .limit(sample)
    )
    texts = (
        docs.select(id_col, F.col(text_col).alias("_text"))
        .join(F.broadcast(chosen), id_col)
        .groupBy(id_col, "_label")
        .agg(F.min("_text").alias("_text"))
    )

    def make():
        def fn(batch):
            found = [ngrams(t) for t in common.texts(batch, "_text")]
            return [pa.array(found, pa.list_(pa.int32()))]

        return fn

    return common.map_rows(texts, ["_label", id_col], make, "features array<int>")


def train(sampled: DataFrame, id_col: str = "doc_id") -> Model:
    """Fit in one task on the bounded sample; only the model comes to the driver.

    The features come in small batches and are held once, as they came.
    """

    def run(batches):
        found, hashes, labels = [], [], []
        for batch in batches:
            found += [x.values.to_numpy() for x in batch.column("features")]
            hashes += batch.column("_h").to_pylist()
            labels += batch.column("_label").to_pylist()
        order = np.argsort(np.array(hashes, np.int64), kind="stable")
        model = fit([found[i] for i in order], np.array(labels, np.float64)[order])
        found = batch = None
        common.released()
        arrays = [model.ratio.astype("<f4").tobytes(), model.weight.astype("<f4").tobytes()]
        numbers = [model.bias, model.a, model.b]
        yield pa.RecordBatch.from_arrays(
            [pa.array([x]) for x in arrays + numbers], names=["ratio", "weight", "bias", "a", "b"]
        )

    schema = "ratio binary, weight binary, bias double, a double, b double"
    one = sampled.select("_label", "features", F.xxhash64(id_col).alias("_h")).coalesce(1)
    # an empty frame may have no partition at all, then there is no task and no row
    spark, rows_a_batch = sampled.sparkSession, "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(rows_a_batch)
    spark.conf.set(rows_a_batch, str(FITTED))
    try:
        row = next(iter(one.mapInArrow(run, schema).collect()), None)
    finally:
        spark.conf.set(rows_a_batch, before)
    if row is None:
        return fit([], np.zeros(0))
    ratio, weight = (np.frombuffer(bytes(x), "<f4") for x in (row.ratio, row.weight))
    return Model(ratio, weight, row.bias, row.a, row.b)


def quality_scores(
    docs: DataFrame,
    labels: DataFrame,
    usable: Column,
    label_col: str = "quality",
    threshold: float = 0.3,
    id_col: str = "doc_id",
    text_col: str = "text",
    sample: int = SAMPLE,
    keep: tuple[str, ...] | None = None,
) -> DataFrame:
    """Score of every whole text (0 to 1, higher: label 1 likelier), and predicted 0 or 1.

    The model sees texts only, and labels only of rows where ``usable`` holds, at most
    ``sample`` of them. Returns ``keep`` (the id alone if not given) with score and
    predicted. NULL and empty texts get the score of a text without n-grams; NULL ids are
    scored like others; repeated rows stay; an empty table gives no rows; without labels
    every score is 0.5.
    """
    chosen = training_sample(docs, labels, usable, label_col, id_col, text_col, sample)
    model = train(chosen, id_col)
    broadcast = docs.sparkSession.sparkContext.broadcast(model)  # 2 ** BITS weights

    def make():
        held = broadcast.value

        def fn(batch):
            found = [held.score(ngrams(t)) for t in common.texts(batch, "_text_of")]
            return [pa.array(found, pa.float64())]

        return fn

    keep = tuple(keep or (id_col,))
    keep = tuple(c for c in keep if c not in ("score", "predicted"))
    source = docs.select(*keep, F.col(text_col).alias("_text_of"))
    scored = common.map_rows(source, keep, make, "score double", rows=128)
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
