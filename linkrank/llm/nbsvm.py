"""Quality classifier: n-gram indicators scaled by naive Bayes log-count ratios, under a linear hinge-loss model."""

from __future__ import annotations

from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkrank.llm.common import bounded_batches, crc_part, task

#: Labelled documents, at most about, that the model is fitted on.
SAMPLE_DOCUMENTS = 4_000
#: Indicators: each byte, each pair of bytes, triples of bytes by a hash, and for pairs of the same word at a distance of
#: one and of two, whether they make up these shares of all such pairs.
TRIPLES = 1 << 17
PAIR_SHARES = (0.0, 0.02, 0.1, 0.3)
SIZE = 256 + 65_536 + TRIPLES + 2 * len(PAIR_SHARES)
SLICE = 1 << 20
FOLDS = 4


def indicators(text: str | None, held: np.ndarray) -> np.ndarray:
    """Which n-grams of bytes and of equal words a whole text has, in increasing order; ``held`` is an array of SIZE falses, given back so."""
    whole = (text or "").encode()
    words, data = whole.split(), np.frombuffer(whole, np.uint8)
    for k in (1, 2):
        if len(words) > k:
            share = sum(map(eq, words, words[k:])) / (len(words) - k)
            held[[SIZE - k * len(PAIR_SHARES) + i for i, x in enumerate(PAIR_SHARES) if share > x]] = True
    for at in range(0, len(data), SLICE):
        b = data[at : at + SLICE + 2].astype(np.uint32)
        held[b] = True
        pairs = b[:-1] << np.uint32(8) | b[1:]
        held[256 + pairs] = True
        held[65_792 + (((pairs[:-1] << np.uint32(8) | b[2:]) * np.uint32(2_654_435_761)) >> np.uint32(15))] = True
    found = np.flatnonzero(held)
    held[found] = False
    return found


def log_count_ratio(rows: list[np.ndarray], good: np.ndarray) -> np.ndarray:
    """log of the share of an indicator among those of good documents over that among bad ones, counts raised by one."""
    sums = [np.bincount(np.concatenate([r for r, g in zip(rows, good, strict=True) if g == k] or [np.zeros(0, np.int64)]), minlength=SIZE) + 1.0 for k in (True, False)]
    return np.log(sums[0] / sums[0].sum()) - np.log(sums[1] / sums[1].sum())


def dual_coordinate_descent(rows: list[np.ndarray], scale: np.ndarray, good: np.ndarray, cost: float = 1.0, rounds: int = 30, tolerance: float = 1e-3, seed: int = 3) -> np.ndarray:
    """Weights, the last one a constant, that minimise |w|^2 / 2 + cost * sum of max(0, 1 - y w x), rows scaled to length one.

    Goes through the dual variables in random order, each set to its optimum between 0 and the cost with the others fixed.
    """
    rng, w = np.random.default_rng(seed), np.zeros(SIZE + 1)
    y, values = np.where(good, 1.0, -1.0), []
    for r in rows:
        v = scale[r]
        values.append(v / max(np.sqrt(v @ v), 1e-12))
    weight = np.where(good, cost * len(good) / (2 * max(good.sum(), 1)), cost * len(good) / (2 * max((~good).sum(), 1)))  # both classes count alike
    dual = np.zeros(len(rows))
    for _ in range(rounds):
        most = 0.0
        for i in rng.permutation(len(rows)):
            r, v = rows[i], values[i]
            slope = y[i] * (w[r] @ v + w[-1]) - 1
            new = min(max(dual[i] - slope / (v @ v + 1), 0.0), weight[i])
            if new != dual[i]:
                most = max(most, abs(new - dual[i]))
                w[r] += (new - dual[i]) * y[i] * v
                w[-1] += (new - dual[i]) * y[i]
                dual[i] = new
        if most < tolerance:
            break
    return w


def logistic(margins: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """Slope and offset that turn margins into shares, by Newton steps towards targets a little inside 0 and 1."""
    n = good.sum(), (~good).sum()
    target = np.where(good, (n[0] + 1) / (n[0] + 2), 1 / (n[1] + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margins + b, -35, 35)))
        d, h = p - target, np.maximum(p * (1 - p), 1e-9)
        slope = np.array([d @ margins + 1e-6 * a, d.sum()])
        curve = np.array([[h @ margins**2 + 1e-6, h @ margins], [h @ margins, h.sum() + 1e-9]])
        step = np.linalg.solve(curve, slope)
        step *= min(1.0, 5 / max(np.abs(step).max(), 1e-12))
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return float(a), float(b)


class Classifier:
    """Fitted on texts and whether they are good. With one class or none, every score is that class or one half."""

    def __init__(self, texts: list[str | None], good: np.ndarray):
        held = np.zeros(SIZE, bool)
        rows = [indicators(t, held) for t in texts]
        self.constant = None
        if not good.any() or good.all():
            self.constant = 0.5 if not len(good) else float(good[0])
            return
        fold, outside = np.arange(len(rows)) % FOLDS, np.zeros(len(rows))
        for k in range(FOLDS):
            train = np.flatnonzero(fold != k)
            if good[train].any() and not good[train].all():
                part = [rows[i] for i in train]
                scale = log_count_ratio(part, good[train])
                w = dual_coordinate_descent(part, scale, good[train])
                for i in np.flatnonzero(fold == k):
                    outside[i] = _margin(rows[i], scale, w)
        self.scale = log_count_ratio(rows, good).astype(np.float32)
        self.weights = dual_coordinate_descent(rows, self.scale, good).astype(np.float32)
        self.slope, self.offset = logistic(outside, good)

    def score(self, texts: list[str | None]) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        held = np.zeros(SIZE, bool)
        margins = np.array([_margin(indicators(t, held), self.scale, self.weights) for t in texts], np.float64)
        return 1 / (1 + np.exp(-np.clip(self.slope * margins + self.offset, -35, 35)))


def _margin(row: np.ndarray, scale: np.ndarray, w: np.ndarray) -> float:
    v = scale[row]
    return float(w[row] @ v / max(np.sqrt(v @ v), 1e-12) + w[-1])


def fit(documents: DataFrame, labels: DataFrame, sample_documents: int = SAMPLE_DOCUMENTS) -> Classifier:
    """Fitted on ``documents (doc_id, text)`` with a ``labels (doc_id, quality)`` whose crc32 of doc_id, as text, isn't 2 modulo 4.

    Whole texts of about ``sample_documents`` such rows, chosen by a hash of doc_id and text after rows alike in both are merged, reach the driver; null labels and ids are left out.
    """
    bounded_batches(documents.sparkSession)
    marks = labels.where((crc_part("doc_id", 4) != 2) & F.col("quality").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).distinct()
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn("hash", F.xxhash64("text"))
    share = min(1.0, sample_documents / max(texts.select("doc_id", "hash").distinct().join(marks, "doc_id").count(), 1))
    some = texts.where(F.pmod(F.xxhash64("doc_id", "hash"), F.lit(1_000_000)) < share * 1_000_000).dropDuplicates(["doc_id", "hash"])
    rows = some.join(marks, "doc_id").select("doc_id", "text", "quality").collect()
    rows = sorted(rows, key=lambda r: (r["doc_id"], r["quality"], r["text"] or ""))
    return Classifier([r["text"] for r in rows], np.array([r["quality"] == 1 for r in rows], bool))


def _score(batches: Iterator[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    classifier = Classifier.__new__(Classifier)
    vars(classifier).update(model.value)
    for batch in batches:
        scores = classifier.score([x.as_py() for x in batch.column(1)])
        yield pa.record_batch([batch.column(0), pa.array(scores, pa.float64())], names=["doc_id", "score"])


def score(documents: DataFrame, classifier: Classifier) -> DataFrame:
    """``(doc_id, score)`` for each row of ``documents (doc_id, text)``, from the whole text alone; a null text scores as the empty one.

    Null ids and repeated rows stay as they are.
    """
    bounded_batches(documents.sparkSession)
    model = documents.sparkSession.sparkContext.broadcast(vars(classifier))
    return documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(task(_score, model=model), "doc_id long, score double")
