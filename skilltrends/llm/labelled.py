"""Bounded samples of labelled rows and score calibration, for the trained operators."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import col, stored

SAMPLE_BYTES = 48 << 20


def fold(id_column: Column, n: int) -> Column:
    """crc32(id as text) mod n; a null id hashes as the empty text."""
    return F.crc32(F.coalesce(id_column.cast("string"), F.lit("")).cast("binary")) % n


def sampled_by(rows: DataFrame, label: str, per_value: int, key: str, most: int) -> tuple[DataFrame, dict]:
    """About ``per_value`` rows of each value of ``label`` (those with the lowest hashes of ``key``), and how
    many rows each value has in all. More than ``most`` values are an error. The share comes from
    the count of all rows, so it is the same wherever the rows lie."""
    counts = {r[0]: r[1] for r in rows.groupBy(label).count().limit(most + 1).collect()}
    if len(counts) > most:
        raise ValueError(f"more than {most} values of {label}")
    place = F.pmod(F.xxhash64(key, F.lit("sample")), F.lit(1 << 30))
    wanted = F.lit(False)
    for value, n in sorted(counts.items()):
        wanted = wanted | ((F.col(label) == F.lit(value)) & (place < F.lit(int(min(1.0, per_value / n) * (1 << 30)))))
    return rows.filter(wanted), counts


def sampled_each(rows: DataFrame, label: str, per_value: int, key: str) -> DataFrame:
    """``sampled_by`` for any number of values: the shares come from a joined table, which holds the values
    with more than ``per_value`` rows; all rows of the others are taken."""
    counts = rows.groupBy(label).agg(F.count("*").alias("n")).filter(F.col("n") > per_value)
    share = F.floor(per_value / F.col("n") * (1 << 30))
    shares = stored(counts.select(F.col(label).alias("_v"), share.alias("_share")), "shares")
    place = F.pmod(F.xxhash64(key, F.lit("sample")), F.lit(1 << 30))
    picked = rows.join(shares, F.col(label) == F.col("_v"), "left")
    return picked.filter(F.col("_share").isNull() | (place < F.col("_share"))).drop("_v", "_share")


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int, per_value: int,
                    id_col: str = "doc_id", text_col: str = "text", most_bytes: int = SAMPLE_BYTES) -> tuple[DataFrame, dict[int, int]]:
    """(id, y, t): labelled rows outside the held-out fold, about ``per_value`` of each of the labels 0 and 1;
    and how many there are of each in all.

    A label takes one text: of several rows of its id the one with the lowest hash. The sample holds at most
    ``most_bytes`` of text: its rows in order of a hash, as many as fit, without texts of more than a
    64th of that."""
    known = labels.select(col(id_col).alias("id"), col(label).cast("int").alias("y"))
    known = known.filter(F.col("id").isNotNull() & F.col("y").isin(0, 1) & (fold(F.col("id"), folds) != held_out)).distinct()
    known, counts = sampled_by(known, "y", per_value, "id", 2)  # a few thousand pairs of numbers
    texts = docs.select(col(id_col).alias("d"), F.coalesce(col(text_col), F.lit("")).alias("t")).filter(F.octet_length("t") <= most_bytes // 64)
    one = texts.join(F.broadcast(known), F.col("d") == F.col("id")).groupBy("id", "y").agg(F.min_by("t", F.xxhash64("t")).alias("t"))
    one = stored(one, "labelled-sample")
    # at most 2 * per_value narrow rows, so one window over all of them
    order = Window.orderBy(F.xxhash64("id", F.lit("order")), "id", "y")
    fits = one.select("id", "y", F.sum(F.octet_length("t")).over(order).alias("bytes")).filter(F.col("bytes") <= most_bytes).drop("bytes")
    return one.join(F.broadcast(fits), ["id", "y"]), counts


def fit_logistic(x: np.ndarray, y: np.ndarray, rounds: int = 100, decay: float = 1e-3) -> np.ndarray:
    """Weights (the constant last) of P(y = 1) = 1 / (1 + exp(-(x w + b))), by damped Newton steps, with
    softened labels. ``x``: a row per case."""
    pos, neg = float((y == 1).sum()), float((y == 0).sum())
    t = np.where(y == 1, (pos + 1) / (pos + 2), 1 / (neg + 2))
    x = np.column_stack((x, np.ones(len(y))))
    w, ridge = np.zeros(x.shape[1]), decay * np.diag([1.0] * (x.shape[1] - 1) + [1e-6])

    def loss(w: np.ndarray) -> float:
        z = x @ w
        return float(np.sum(np.logaddexp(0, z) - t * z) + 0.5 * w @ ridge @ w)

    for _ in range(rounds):
        p = sigmoid(x @ w)
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + ridge + 1e-9 * np.eye(len(w)), x.T @ (p - t) + ridge @ w)
        scale, now = 1.0, loss(w)
        while scale > 1e-4 and loss(w - scale * step) > now:
            scale /= 2
        w = w - scale * step
        if np.abs(scale * step).max() < 1e-7:
            break
    return w


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))
