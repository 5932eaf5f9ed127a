"""Quality classifier: naive Bayes support vectors (NB-SVM).

Features are indicators of hashed n-grams: words, and runs of word shapes (which
classes of characters a word holds, and whether it repeats the word before).
Each indicator is scaled by its class log-count ratio; a linear hinge-loss model
is fitted on the scaled, length-normalised vectors by dual coordinate descent and
its margins are turned into probabilities by a logistic curve fitted on
out-of-fold margins.

The fit uses a bounded sample of labelled rows: at most ``max_rows`` (those with
the smallest hash of their id) whose text is at most ``MAX_FIT_BYTES`` long; no
label of a held-out row is ever read.  The sample is joined by broadcast, so
texts are not shuffled.  The model has ``DIMS`` weights (4 MB) at every size.
Scoring reads every whole text once.

Null and empty texts have no features and get the score of the intercept.  Labels
that are null are skipped, a row labelled twice counts once with its smaller
label.  Without labels of both classes every score is the share of label 1 (0.5
without any).  Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from . import words as W

DIMS = 1 << 20
MAX_ROWS = 5000
MAX_FIT_BYTES = 1 << 15
FIT_TEXTS = 50            # texts of the sample whose features are made at a time
BLOCK_BYTES = 1 << 20

# Byte classes for shapes: lower case, upper case, digits, other letters; the rest stands for itself.
_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[ord("a"):ord("z") + 1], _SHAPE[ord("A"):ord("Z") + 1], _SHAPE[ord("0"):ord("9") + 1] = 97, 65, 48
_SHAPE[128:] = 97
_REPEATS = np.uint64(0x5DEECE66D)


def held_out(doc_id: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(5)) == 0


def _shapes(text: bytes) -> bytes:
    """Every run of one byte class as one byte."""
    a = _SHAPE[np.frombuffer(text, dtype=np.uint8)]
    return a[np.concatenate(([True], a[1:] != a[:-1]))].tobytes() if len(a) else b""


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(indices, bounds): distinct features of text i are indices[bounds[i]:bounds[i + 1]]."""
    words, bounds = W.word_hashes(texts, W.WHITE)
    shape, _ = W.word_hashes([_shapes(t) for t in texts], W.WHITE)
    doc = np.repeat(np.arange(len(texts), dtype=np.int64), np.diff(bounds))
    again = np.zeros(len(words), dtype=bool)
    again[1:] = (words[1:] == words[:-1]) & (doc[1:] == doc[:-1])
    shape = np.where(again, _REPEATS, shape)
    found = []
    for salt, (stream, n) in enumerate(((words, 1), (shape, 1), (shape, 2), (shape, 3))):
        grams = W.gram_hashes(stream, n)
        inside = doc[:len(grams)] == doc[n - 1:] if len(grams) else np.empty(0, dtype=bool)
        index = (W.mix(grams + np.uint64(salt)) >> np.uint64(44)).astype(np.int64)
        found.append((doc[:len(grams)][inside] << 20) | index[inside])
    # Shapes repeat a lot: thin them before the common sort.
    every = np.unique(np.concatenate([found[0], *[np.unique(f) for f in found[1:]]]))
    return (every & (DIMS - 1)), np.searchsorted(every >> 20, np.arange(len(texts) + 1))


def _log_ratios(x: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    good, bad = np.ones(DIMS), np.ones(DIMS)
    for idx, label in zip(x, y.tolist(), strict=True):
        (good if label > 0 else bad)[idx] += 1                 # the features of a text are distinct
    for count in (good, bad):
        count /= count.sum()
        np.log(count, out=count)
    good -= bad
    return good


def _dual_descent(x: list[np.ndarray], ratio: np.ndarray, y: np.ndarray, cost: float = 1.0, sweeps: int = 12) -> tuple[np.ndarray, float]:
    """Weights and intercept of a linear hinge-loss model; vectors have length one (with the intercept, two).

    A vector's values are looked up when it is visited: kept, they would take more memory than all features."""
    w, b, alpha, draw = np.zeros(DIMS), 0.0, np.zeros(len(y)), np.random.default_rng(7)
    length = np.array([_length(ratio[idx]) for idx in x])
    cap = np.where(y > 0, cost, cost * np.sqrt(max(1.0, (y > 0).sum() / max(1, (y < 0).sum()))))
    for _ in range(sweeps):
        moved = 0.0
        for i in draw.permutation(len(y)):
            idx = x[i].astype(np.int64)
            val = ratio[idx] / length[i]
            gradient = y[i] * (w[idx] @ val + b) - 1
            new = min(max(alpha[i] - gradient / 2, 0.0), cap[i])
            step = (new - alpha[i]) * y[i]
            if step:
                w[idx] += step * val
                b += step
                alpha[i], moved = new, max(moved, abs(step))
        if moved < 1e-3:
            break
    return w, b


def _length(val: np.ndarray) -> float:
    return max(1e-9, float(np.sqrt(val @ val)))


def _logistic(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """(a, c) of 1 / (1 + exp(-(a * margin + c))), by Newton steps with smoothed targets."""
    good, bad = (y > 0).sum(), (y < 0).sum()
    t = np.where(y > 0, (good + 1) / (good + 2), 1 / (bad + 2))
    a, c = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margin + c, -30, 30)))
        g = np.array([((p - t) * margin).sum() + 1e-3 * a, (p - t).sum()])
        v = np.maximum(p * (1 - p), 1e-6)
        h = np.array([[(v * margin * margin).sum() + 1e-3, (v * margin).sum()], [(v * margin).sum(), v.sum() + 1e-9]])
        step = np.linalg.solve(h, g)
        a, c = a - step[0], c - step[1]
        if np.abs(step).max() < 1e-6:
            break
    return float(a), float(c)


class Model:
    """Weights per feature; the score is a probability of label 1."""

    def __init__(self, texts: list[bytes], labels: np.ndarray):
        y = np.where(labels > 0, 1.0, -1.0)
        self.constant = float(labels.mean()) if len(labels) else 0.5
        if len(set(y.tolist())) < 2:
            return
        self.constant = None
        x = []                           # per text its features; all else that the fit holds is of DIMS numbers
        for i in range(0, len(texts), FIT_TEXTS):
            index, bounds = features(texts[i:i + FIT_TEXTS])
            x += np.split(index.astype(np.int32), bounds[1:-1])
        fold, margin = np.arange(len(y)) % 3, np.zeros(len(y))
        for k in range(3):
            rows = np.flatnonzero(fold != k)
            if len(set(y[rows].tolist())) == 2:
                weights, b = self._fit(x, y, rows)
                for i in np.flatnonzero(fold == k):
                    margin[i] = self._margin(x[i], weights, b)
                del weights
        (self.weights, self.bias), (self.a, self.c) = self._fit(x, y, np.arange(len(y))), _logistic(margin, y)

    @staticmethod
    def _fit(x, y, rows):
        own = [x[i] for i in rows]
        ratio = _log_ratios(own, y[rows])
        w, b = _dual_descent(own, ratio, y[rows])
        return (ratio, w), b

    @staticmethod
    def _margin(idx: np.ndarray, weights, b: float) -> float:
        ratio, w = weights
        val = ratio[idx]
        return float(w[idx] @ val / _length(val) + b)

    def close(self) -> "Model":
        """Keep what scoring needs: per feature its squared length and its share of the margin."""
        if self.constant is None:
            ratio, w = self.weights
            self.square, self.part = (ratio * ratio).astype(np.float32), (ratio * w).astype(np.float32)
            del self.weights
        return self

    def score(self, texts: list[bytes]) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        index, bounds = features(texts)
        doc = np.repeat(np.arange(len(texts)), np.diff(bounds))
        # Summed text by text, so a score does not depend on the texts beside it.
        total = lambda v: np.bincount(doc, weights=v[index], minlength=len(texts))
        margin = total(self.part) / np.maximum(1e-9, np.sqrt(np.maximum(total(self.square), 0))) + self.bias
        return 1 / (1 + np.exp(-np.clip(self.a * margin + self.c, -30, 30)))


def fit(docs: DataFrame, labels: DataFrame, *, max_rows: int = MAX_ROWS, id_col: str = "doc_id", text_col: str = "text",
        label_id: str = "doc_id", label_col: str = "quality") -> Model:
    """A model from the labelled rows that are not held out."""
    known = labels.select(F.col(label_id).alias("_id"), F.col(label_col).alias("_label"))
    known = known.where(F.col("_label").isNotNull() & ~held_out(F.col("_id"))).groupBy("_id").agg(F.min("_label").alias("_label"))
    sample = known.orderBy(F.xxhash64("_id"), "_id").limit(max_rows)
    # At most max_rows rows of two numbers.
    rows = (docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("_text"))
            .join(F.broadcast(sample), "_id").where(F.octet_length("_text") <= MAX_FIT_BYTES)
            .select("_id", "_label", "_text"))
    got: dict = {}
    for r in rows.collect():          # bounded: max_rows texts of MAX_FIT_BYTES at most
        got.setdefault(r["_id"], (int(r["_label"]), bytes(r["_text"])))
    order = sorted(got)
    return Model([got[i][1] for i in order], np.array([got[i][0] for i in order])).close()


def score(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, held_out, score."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(id_col).alias("doc_id"), held_out(F.col(id_col)).alias("held_out"),
                       F.col(text_col).cast("binary").alias("text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in W.blocks(batches, "text", BLOCK_BYTES):
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("held_out"),
                                              pa.array(held.value.score(W.utf8(part.column("text"))))],
                                             names=["doc_id", "held_out", "score"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, score double")


def keep_good(docs: DataFrame, model: Model, *, least: float = 0.3, text_col: str = "text") -> DataFrame:
    """The documents that score at least ``least``, with all their columns."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in W.blocks(batches, text_col, BLOCK_BYTES):
            yield part.filter(pa.array(held.value.score(W.utf8(part.column(text_col))) >= least))

    return docs.mapInArrow(run, docs.schema)
