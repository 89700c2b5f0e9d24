"""Operator 6. Quality classifier: naive Bayes support vectors.

Features are indicators of the 1- and 2-grams of a text's tokens, hashed to 2**18 columns. On the
labelled rows outside the held-out fold each column gets the log ratio of its smoothed counts in the
two classes; the indicators are scaled by it, each row is brought to length 1, and a linear model
with hinge loss is fitted by dual coordinate descent. A sigmoid fitted on a fifth of the sample,
which the linear model doesn't see, turns margins into scores, for the classes' shares in all labelled rows.

The fit uses a bounded sample: ``per_class`` labelled rows of each class (hash order). Its features
go to the driver; the model, 2**18 numbers, goes back as a broadcast. Scoring maps over whole texts in
Arrow batches, without a shuffle.

Defined results: a null or empty text has no feature and gets the sigmoid of the bias; labels that are
null or not 0 or 1 are left out; with no row of one of the classes nothing can be learned and every
score is 1.0 (nothing is known against a text); null ids and repeated rows are scored row by row;
an empty table gives an empty result; input columns named like a result are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import carried, col, map_texts, packed, shared, text_blocks, unpacked
from .labelled import fit_logistic, fold, labelled_sample, sigmoid
from .words import distinct, spread_bits, token_hashes

HASH_BITS, PER_CLASS, FOLDS, HELD_OUT, THRESHOLD, BLOCK_BYTES = 18, 1500, 4, 2, 0.7, 2 << 20


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(text, column) of every distinct 1- and 2-gram, sorted by text."""
    token, at = token_hashes(texts)
    text = np.repeat(np.arange(len(texts)), np.diff(at))
    both = text[:-1] == text[1:]
    two = (token[:-1] * np.uint64(0x5BD1E9955BD1E995) + token[1:])[both]
    key = np.concatenate((text << HASH_BITS | spread_bits(token, HASH_BITS), text[:-1][both] << HASH_BITS | spread_bits(two, HASH_BITS)))
    key = distinct(key)
    return key >> HASH_BITS, key & ((1 << HASH_BITS) - 1)


@dataclass
class Model:
    ratio: np.ndarray   # log-count ratio of each column
    weight: np.ndarray  # hinge-loss weight of each scaled column
    bias: float
    a: float
    b: float

    def margins(self, texts: pa.Array) -> np.ndarray:
        text, column = features(texts)
        r = self.ratio[column]
        norm = np.sqrt(np.bincount(text, r * r, len(texts)))
        return np.bincount(text, r * self.weight[column], len(texts)) / np.where(norm > 0, norm, 1) + self.bias

    def scores(self, texts: pa.Array) -> np.ndarray:
        return sigmoid(self.a * self.margins(texts) + self.b)


def descend(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, size: int, cost: float = 1.0, epochs: int = 15) -> tuple[np.ndarray, float]:
    """Dual coordinate descent for the hinge loss: one multiplier per row, clipped to its share of the
    cost, which is split evenly between the classes. The bias is a column that is always 1."""
    w, bias, alpha = np.zeros(size), 0.0, np.zeros(len(rows))
    n_pos = max(1, int((y > 0).sum()))
    top = np.where(y > 0, cost * len(y) / (2 * n_pos), cost * len(y) / (2 * max(1, len(y) - n_pos)))
    q = np.array([float(v @ v) + 1.0 for _, v in rows])
    rng = np.random.default_rng(0)
    for _ in range(epochs):
        moved = 0.0
        for i in rng.permutation(len(rows)):
            c, v = rows[i]
            g = y[i] * (float(w[c] @ v) + bias) - 1
            new = min(max(alpha[i] - g / q[i], 0.0), top[i])
            if d := new - alpha[i]:
                w[c] += d * y[i] * v
                bias += d * y[i]
                alpha[i], moved = new, max(moved, abs(d))
        if moved < 1e-3:
            break
    return w, bias


def fit(sample: list[tuple[str, int, np.ndarray]]) -> Model | None:
    """From (id, label, columns) rows, in any order."""
    sample = sorted(sample, key=lambda r: (r[0], r[1], len(r[2])))
    y = np.array([r[1] for r in sample])
    if len(set(y.tolist())) < 2:
        return None
    columns = [np.asarray(r[2], np.int64) for r in sample]
    held = np.random.default_rng(1).random(len(y)) < 0.2
    if len(set(y[held].tolist())) < 2 or len(set(y[~held].tolist())) < 2:
        held[:] = False  # too few rows to set some aside
    size = 1 << HASH_BITS
    count = [np.bincount(np.concatenate([c for c, k, h in zip(columns, y, held) if k == v and not h]), minlength=size) + 1.0 for v in (0, 1)]
    ratio = np.log(count[1] / count[1].sum()) - np.log(count[0] / count[0].sum())

    def scaled(c: np.ndarray) -> np.ndarray:
        v = ratio[c]
        norm = float(np.sqrt(v @ v))
        return v / norm if norm else v

    rows = [(c, scaled(c)) for c in columns]
    train = [r for r, h in zip(rows, held) if not h]
    w, bias = descend(train, np.where(y[~held] == 1, 1.0, -1.0), size)
    judge = held if held.any() else ~held
    margin = np.array([float(w[c] @ v) + bias for (c, v), j in zip(rows, judge) if j])
    a, b = fit_logistic(margin[:, None], y[judge])
    return Model(ratio, w, bias, a, b)


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", folds: int = FOLDS, held_out: int = HELD_OUT,
          per_class: int = PER_CLASS, id_col: str = "doc_id", text_col: str = "text") -> Model | None:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_blocks(batches, "t", BLOCK_BYTES):
            text, column = features(batch.column("t"))
            cut = np.searchsorted(text, np.arange(len(batch) + 1))
            found = pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(column, pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column("id").cast(pa.string()), batch.column("y"), found], names=["id", "y", "c"])

    sample, counts = labelled_sample(docs, labels, label, folds, held_out, per_class, id_col, text_col)
    rows = sample.mapInArrow(run, "id string, y int, c array<int>").toArrow()
    columns = [c.values.to_numpy() for chunk in rows["c"].chunks for c in chunk]
    model = fit(list(zip(rows["id"].to_pylist(), rows["y"].to_pylist(), columns)))
    if model is not None:  # the sample holds both classes alike; a score is for the classes as they come
        found = np.bincount(rows["y"].to_numpy(), minlength=2)
        model.b += float(np.log(counts[1] / counts[0]) - np.log(found[1] / found[0]))
    return model


def score_quality(docs: DataFrame, labels: DataFrame, label: str = "quality", folds: int = FOLDS, held_out: int = HELD_OUT,
                  per_class: int = PER_CLASS, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Every row of ``docs`` with held_out, score, predicted. ``carry``: the input columns to keep
    (default: all)."""
    model = shared(docs.sparkSession, train(docs, labels, label, folds, held_out, per_class, id_col, text_col))

    def score(texts: pa.Array, m: Model | None) -> dict[str, pa.Array]:
        return {"s": pa.array(np.ones(len(texts)) if m is None else m.scores(texts))}

    columns = carried(docs, carry)
    rows = packed(docs, columns, text_col, id=col(id_col))
    rows = map_texts(rows, text_col in columns, {"s": T.DoubleType()}, BLOCK_BYTES, score, model)
    return unpacked(rows, columns, {
        "held_out": fold(F.col("id"), folds) == held_out, "score": F.col("s"),
        "predicted": (F.col("s") >= threshold).cast("int")}, text_col)
