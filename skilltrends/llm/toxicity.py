"""Operator 8. Toxicity: a linear-chain conditional random field over words.

Two states (clean, toxic); features are the word, its prefixes of 3 to 7 characters, the word before
and the word after, hashed. The labelled tokens come from the document labels: in the sample, a word or
prefix that is far more frequent in toxic documents than in clean ones (document frequencies,
ratio and z-score) labels its tokens toxic where they stand in a toxic document; all other tokens are
clean. The field is fitted to those labels by Adam on the exact gradient (forward-backward).
Marginals of the toxic state give the spans (runs of 0.5 or more, with byte offsets). A text's largest
marginal, their sum and their mean go through a logistic model, fitted on rows kept out of a first
fit of the field, that gives the score; the field then goes on, fitted on all sampled rows.

A chain ends with a sentence (. ! ? or a line break between words) or with the text. All chains of a block
are passed step by step together; a long chain in pieces of ``PIECE`` words, whose products of
transition matrices hand the messages on from piece to piece, so that the marginals are those of the whole chain.

The fit uses a bounded sample (``per_class`` labelled rows of each class and ``SAMPLE_BYTES`` of text, by hash
order). Spark counts the sample's document frequencies and sends the driver the toxic columns,
the sentences that hold one in a toxic document, about ``max_tokens`` tokens of the others, and three numbers a
row for the logistic model. Scoring maps over whole texts in Arrow batches, without a shuffle.

Defined results: a null or wordless text gets the score of a text with no toxic word and no spans; labels that are
null or not 0 or 1 are left out; with no row of one of the classes every score is 0; null ids and
repeated rows are scored row by row; an empty table gives an empty result; input columns named
like a result are replaced.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import carried, col, map_texts, packed, shared, stored, text_blocks, unpacked
from .labelled import fit_logistic, fold, labelled_sample, sigmoid
from .words import ALNUM, coded, hash_words, prefix_hashes, raw_of, spread_bits, words_of

HASH_BITS, PER_CLASS, MAX_TOKENS, FOLDS, HELD_OUT, THRESHOLD = 19, 1200, 300_000, 3, 1, 0.7
PREFIXES = [3, 4, 5, 6, 7]
NONE = 1 << HASH_BITS  # the column of a feature that isn't there
PIECE, BLOCK_BYTES, FAR = 200, 2 << 20, 12.0

#: Bytes that end a sentence.
ENDS = np.zeros(256, bool)
ENDS[[ord(c) for c in ".!?\n"]] = True


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Columns of the features of all words (word, then prefixes), where each text's words start,
    which words start a chain, and each word's byte range within its text."""
    words, at, first, last = words_of(texts, ALNUM)
    ids, distinct = coded(words)
    prefixes = prefix_hashes(distinct, PREFIXES)
    salted = prefixes + np.arange(1, len(PREFIXES) + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    each = np.concatenate((spread_bits(hash_words(distinct), HASH_BITS)[:, None],
                           np.where(prefixes == 0, NONE, spread_bits(salted, HASH_BITS))), axis=1).astype(np.int32)
    column = each[ids]
    raw, base = raw_of(texts)
    ended = np.concatenate(([0], np.cumsum(ENDS[raw])))
    text = np.repeat(base[:-1], np.diff(at))
    head = np.ones(len(ids), bool)
    if len(ids):
        head[1:] = ended[(first + text)[1:]] > ended[(last + text)[:-1]]
        head[at[:-1][np.diff(at) > 0]] = True
    return column, at, head, first, last


class Chains:
    """Chains of a flat token array, in pieces of bounded length, the longest first."""

    def __init__(self, head: np.ndarray):
        chain = np.flatnonzero(head)
        place = np.arange(len(head)) - np.repeat(chain, np.diff(np.concatenate((chain, [len(head)]))))
        start = np.flatnonzero(place % PIECE == 0)
        length = np.diff(np.concatenate((start, [len(head)])))
        number = place[start] // PIECE  # of a piece within its chain
        self.n, self.start, self.length = len(head), start, length
        order = np.argsort(-length, kind="stable")
        self.every, self.first, self.later = order, order[number[order] == 0], order[number[order] > 0]
        by_number = np.argsort(number, kind="stable")
        cuts = np.searchsorted(number[by_number], np.arange(1, int(number.max(initial=0)) + 2))
        self.rounds = [by_number[i:j] for i, j in zip(cuts[:-1], cuts[1:])]  # pieces 1, 2, ... of all chains

    def steps(self, pieces: np.ndarray):
        """(step, positions) of pieces that are sorted by length."""
        length = self.length[pieces]
        for step in range(int(length[0]) if len(pieces) else 0):
            yield step, self.start[pieces[:np.searchsorted(-length, -step, "left")]] + step

    def products(self, psi: np.ndarray, m: np.ndarray) -> np.ndarray:
        """For each later piece the product of its transition matrices, from the word before it to its last."""
        out = np.tile(np.eye(2), (len(self.start), 1, 1))
        for _, at in self.steps(self.later):
            pieces = self.later[:len(at)]
            x = out[pieces] @ m
            x[:, :, 1] *= psi[at, None]
            out[pieces] = x / x.sum((1, 2), keepdims=True)
        return out

    def marginals(self, u: np.ndarray, t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """P(toxic) of each token, and the expected number of each transition. ``u``: score of the
        toxic state less that of the clean one; ``t``: 2 x 2 scores of transitions."""
        psi, m = np.exp(np.clip(u, -30, 30)), np.exp(np.clip(t, -30, 30))
        f, b, pairs = np.empty((self.n, 2)), np.ones((self.n, 2)), np.zeros((2, 2))
        before = np.empty((len(self.start), 2))  # message from the word before a later piece
        last = self.start + self.length - 1

        def forward(pieces: np.ndarray, later: bool) -> None:
            for step, at in self.steps(pieces):
                if step or later:
                    g = f[at - 1] if step else before[pieces[:len(at)]]
                    x = g @ m
                    x[:, 1] *= psi[at]
                else:
                    x = np.stack([np.ones(len(at)), psi[at]], 1)
                f[at] = x / x.sum(1, keepdims=True)

        forward(self.first, False)
        if len(self.later):
            product = self.products(psi, m)
            for k, pieces in enumerate(self.rounds):
                came = f[last[pieces - 1]] if k == 0 else (before[pieces - 1, None] @ product[pieces - 1])[:, 0]
                before[pieces] = came / came.sum(1, keepdims=True)
            for pieces in reversed(self.rounds):
                y = (product[pieces] @ b[last[pieces], :, None])[:, :, 0]
                b[last[pieces - 1]] = y / (before[pieces] * y).sum(1, keepdims=True)
            forward(self.later, True)

        def transitions(at: np.ndarray) -> np.ndarray:
            """Count the transitions into ``at`` and give the messages to the words before."""
            g, y = f[at - 1], b[at].copy()
            y[:, 1] *= psi[at]
            x = y @ m.T
            z = (g * x).sum(1)
            pairs[:] += m * ((g / z[:, None]).T @ y)
            return x / z[:, None]

        for step, at in reversed(list(self.steps(self.every))):
            if step:
                b[at - 1] = transitions(at)
        transitions(self.start[self.later])
        return f[:, 1] * b[:, 1] / (f[:, 0] * b[:, 0] + f[:, 1] * b[:, 1]), pairs


def context(column: np.ndarray, head: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Columns of the words before and after, within the chain."""
    word = column[:, 0]
    before = np.concatenate(([NONE], word[:-1]))[:len(word)]
    after = np.concatenate((word[1:], [NONE]))[:len(word)]
    before[head] = NONE
    after[np.concatenate((head[1:], [True]))[:len(word)]] = NONE
    return before, after


def unary(weights: np.ndarray, bias: float, column: np.ndarray, before: np.ndarray, after: np.ndarray) -> np.ndarray:
    return weights[0][column].sum(1) + weights[1][before] + weights[2][after] + bias


@dataclass
class Model:
    weights: np.ndarray      # (3, columns + 1): word and prefixes, word before, word after
    bias: float
    transitions: np.ndarray
    judge: np.ndarray | None = None  # logistic weights of the summary and, last, the constant

    def toxic(self, column: np.ndarray, head: np.ndarray) -> np.ndarray:
        before, after = context(column, head)
        u = unary(self.weights, self.bias, column, before, after)
        return Chains(head).marginals(u, self.transitions)[0]

    def summary(self, p: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Of each text: log odds of the largest marginal, log of their sum, log of their mean."""
        out = np.tile([-FAR, 0.0, 0.0], (len(at) - 1, 1))
        full = np.flatnonzero(np.diff(at))
        if len(full):
            top = np.clip(np.maximum.reduceat(p, at[full]), 1e-9, 1 - 1e-9)
            total = np.add.reduceat(np.where(p > 0.05, p, 0), at[full])
            out[full, 0] = np.clip(np.log(top / (1 - top)), -FAR, FAR)
            out[full, 1] = np.log1p(total)
            out[full, 2] = np.log1p(100 * total / np.diff(at)[full])
        return out

    def score(self, texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
        column, at, head, first, last = tokens(texts)
        p = self.toxic(column, head)
        hot = p >= 0.5
        text = np.repeat(np.arange(len(texts)), np.diff(at))
        joined = hot[1:] & hot[:-1] & ~head[1:]
        opens = np.flatnonzero(hot & ~np.concatenate(([False], joined))[:len(hot)])
        closes = np.flatnonzero(hot & ~np.concatenate((joined, [False]))[:len(hot)])
        peak = np.maximum.reduceat(np.where(hot, p, 0), opens) if len(opens) else np.zeros(0)
        cut = np.searchsorted(text[opens], np.arange(len(texts) + 1))
        spans = pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.StructArray.from_arrays(
            [pa.array(first[opens]), pa.array(last[closes]), pa.array(peak)], names=["start", "stop", "p"]))
        return sigmoid(self.summary(p, at) @ self.judge[:-1] + self.judge[-1]), spans


def toxic_columns(documents: DataFrame, least: int = 4, ratio: float = 8.0, z: float = 4.0) -> np.ndarray:
    """The columns far more frequent in toxic documents, from (y, columns) rows: document frequencies,
    counted by Spark."""
    totals = documents.groupBy("y").count()
    n = {r["y"]: r["count"] for r in totals.collect()}
    n0, n1 = max(1, n.get(0, 0)), max(1, n.get(1, 0))
    c = documents.select("y", F.explode("columns").alias("c")).groupBy("c").agg(
        F.count_if(F.col("y") == 0).alias("c0"), F.count_if(F.col("y") == 1).alias("c1")).filter(F.col("c1") >= least)
    p0, p1, p = (F.col("c0") + 0.5) / (n0 + 1), (F.col("c1") + 0.5) / (n1 + 1), (F.col("c0") + F.col("c1")) / (n0 + n1)
    deviation = (p1 - p0) / F.sqrt(F.greatest(p * (1 - p), F.lit(1e-9)) * (1 / n0 + 1 / n1))
    return np.array(sorted(r["c"] for r in c.filter((p1 > ratio * p0) & (deviation > z)).select("c").collect()), np.int64)


def fit_field(column: np.ndarray, head: np.ndarray, y: np.ndarray, start: Model | None = None, rounds: int = 45, rate: float = 0.3,
              decay: float = 1e-4) -> Model:
    """Adam on the mean log-likelihood of the token labels, from the weights of ``start`` on."""
    before, after = context(column, head)
    chains = Chains(head)
    inner = ~head[1:]
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[:-1][inner], y[1:][inner]), 1)
    model = Model(np.zeros((3, NONE + 1)), -3.0, np.zeros((2, 2))) if start is None else \
        Model(start.weights.astype(np.float64), start.bias, start.transitions.copy())
    flat = [model.weights, np.array([model.bias]), model.transitions]
    moment = [(np.zeros_like(x), np.zeros_like(x)) for x in flat]
    for k in range(1, rounds + 1):
        p, pairs = chains.marginals(unary(flat[0], flat[1][0], column, before, after), flat[2])
        d = y - p
        grads = [np.stack([np.bincount(column.ravel(), np.repeat(d, column.shape[1]), NONE + 1),
                           np.bincount(before, d, NONE + 1), np.bincount(after, d, NONE + 1)]), np.array([d.sum()]), seen - pairs]
        grads[0][:, NONE] = 0
        for x, g, (m, v) in zip(flat, grads, moment):
            g = g / max(1, int(y.sum())) - decay * x
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            x += rate * (m / (1 - 0.9 ** k)) / (np.sqrt(v / (1 - 0.99 ** k)) + 1e-8)
    model.bias = float(flat[1][0])
    return model


def per_text(sample: DataFrame, schema: str, make: Callable[[str, int, np.ndarray, np.ndarray], tuple | None]) -> DataFrame:
    """Rows made of (id, label, columns, heads) of each sampled text."""
    fields = T._parse_datatype_string(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_blocks(batches, "t", BLOCK_BYTES):
            column, at, head, _, _ = tokens(batch.column("t"))
            rows = [make(i, y, column[a:b], head[a:b]) for i, y, a, b in
                    zip(batch.column("id").cast(pa.string()).to_pylist(), batch.column("y").to_pylist(), at[:-1], at[1:])]
            rows = [r for r in rows if r is not None]
            kinds = {"int": pa.int32(), "bigint": pa.int64(), "boolean": pa.bool_(), "double": pa.float64(), "array<int>": pa.list_(pa.int32()),
                     "array<boolean>": pa.list_(pa.bool_()), "array<double>": pa.list_(pa.float64())}
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kinds[f.dataType.simpleString()]) for k, f in enumerate(fields)], names=fields.names)

    return sample.select("id", "y", "t").mapInArrow(run, fields)


def train_field(sample: DataFrame, max_tokens: int, start: Model | None = None, rounds: int = 45) -> Model:
    """Fit the field on all rows of a sample."""
    documents = stored(per_text(sample, "y int, n bigint, columns array<int>", lambda i, y, c, h: (y, len(c), np.setdiff1d(c, NONE).tolist())), "toxic-documents")
    toxic = toxic_columns(documents)
    share = max_tokens / max(1, documents.agg(F.sum("n")).first()[0] or 0)

    def chains(i: str, y: int, c: np.ndarray, h: np.ndarray) -> tuple | None:
        hot = np.isin(c, toxic).any(1) & (y == 1)
        chain = np.cumsum(h) - 1
        pick = np.bincount(chain, hot) > 0
        pick |= np.random.default_rng(zlib.crc32(f"{i}:{y}".encode())).random(len(pick)) < share
        keep = pick[chain]
        return (c[keep].ravel().tolist(), h[keep].tolist(), hot[keep].tolist()) if keep.any() else None

    rows = per_text(sample, "c array<int>, h array<boolean>, l array<boolean>", chains).toArrow()
    parts = sorted(zip(*[[np.asarray(x) for chunk in rows[k].chunks for x in chunk.to_pylist()] for k in ("c", "h", "l")]),
                   key=lambda r: (len(r[0]), r[0].tobytes(), r[1].tobytes(), r[2].tobytes()))  # the same model wherever the rows lay
    column = np.concatenate([np.zeros(0, np.int64), *[r[0] for r in parts]]).astype(np.int64).reshape(-1, 1 + len(PREFIXES))
    head, marked = (np.concatenate([np.zeros(0, bool), *[r[k].astype(bool) for r in parts]]) for k in (1, 2))
    model = fit_field(column, head, marked.astype(np.int64), start, rounds)
    model.weights = model.weights.astype(np.float32)
    return model


def train(docs: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int, per_class: int, id_col: str, text_col: str,
          max_tokens: int = MAX_TOKENS) -> Model | None:
    """A field fitted without a quarter of the sample (by a hash of the id) has its logistic model from
    that quarter; then the field is fitted on the whole sample."""
    sample, _ = labelled_sample(docs, labels, label, folds, held_out, per_class, id_col, text_col)
    sample = sample.withColumn("held", F.pmod(F.xxhash64("id", F.lit("judge")), F.lit(4)) == 0)
    classes = {(r["y"], r["held"]) for r in sample.groupBy("y", "held").count().collect()}
    if len({y for y, _ in classes}) < 2:
        return None
    apart = len(classes) == 4  # else too few rows to set some aside
    model = train_field(sample.filter("NOT held") if apart else sample, max_tokens)
    held = shared(docs.sparkSession, model)

    def judged(i: str, y: int, c: np.ndarray, h: np.ndarray) -> tuple:
        m = held()
        return y, m.summary(m.toxic(c, h), np.array([0, len(c)]))[0].tolist()

    cases = sorted(map(tuple, per_text(sample.filter("held") if apart else sample, "y int, x array<double>", judged).collect()))
    judge = fit_logistic(np.array([x for _, x in cases]), np.array([y for y, _ in cases]))
    model = train_field(sample, max_tokens, model, 20) if apart else model
    model.judge = judge
    return model


def score_toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic", folds: int = FOLDS, held_out: int = HELD_OUT,
                   per_class: int = PER_CLASS, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Every row of ``docs`` with held_out, score, predicted, and spans: byte ranges of toxic words
    with their largest marginal (start, stop, p; array of structs). ``carry``: the input columns to keep
    (default: all)."""
    model = shared(docs.sparkSession, train(docs, labels, label, folds, held_out, per_class, id_col, text_col))
    span = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("stop", T.LongType()), T.StructField("p", T.DoubleType())]))

    def score(texts: pa.Array, m: Model | None) -> dict[str, pa.Array]:
        if m is None:
            none = pa.array([[]] * len(texts), pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("p", pa.float64())])))
            return {"s": pa.array(np.zeros(len(texts))), "x": none}
        scores, spans = m.score(texts)
        return {"s": pa.array(scores), "x": spans}

    columns = carried(docs, carry)
    rows = packed(docs, columns, text_col, id=col(id_col))
    rows = map_texts(rows, text_col in columns, {"s": T.DoubleType(), "x": span}, BLOCK_BYTES, score, model)
    return unpacked(rows, columns, {
        "held_out": fold(F.col("id"), folds) == held_out, "score": F.col("s"),
        "predicted": (F.col("s") >= threshold).cast("int"), "spans": F.col("x")}, text_col)
