"""Operator 4. Language ID by segmentation-marginalised unigrams.

The pieces of a public tokenizer are the fixed vocabulary. Each language has a probability for each
piece; the probability of a word is the sum over all ways to cut it into pieces, computed by a
forward pass over its characters. A text's log-likelihood is the sum over its words, the score the
posterior of the best language with equal priors.

Piece probabilities are fitted by expectation maximisation: forward-backward over the distinct words
of a bounded sample (``per_language`` training documents of each language, by hash order), weighted
with their counts. The counts are summed by Spark, and each language is fitted in a task of its own. The
model's counts (those above 0) go to the tasks as broadcasts of 64 languages each; a text passes them in turn
with a running best language and sum of the others, so there may be any number of languages: time grows
with it, memory by the counts alone. Texts do not shuffle, as long as the
table of the languages with more documents than that can be broadcast; each distinct word of a block is scored once for
each broadcast.

A word is a run of non-space characters after a word mark. Words of more than 32 characters are summed
in logarithms, whole, as the products of longer ones would leave the range of a double. A character outside the vocabulary has the same probability in every language.

Defined results: a null text, or one without a letter, is ``und`` with score 0; a null lang teaches
nothing; with no training rows every text is ``und`` with score 0; ties go to the language that sorts
first; null ids and repeated rows are scored row by row; an empty table gives an empty result; input
columns named like a result are replaced.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import carried, col, map_texts, packed, shared, stored, text_blocks, unpacked
from .labelled import fold, sampled_each
from .words import NON_SPACE, Table, coded, words_of

FOLDS, HELD_OUT, PER_LANGUAGE, COLUMNS, ROUNDS, RUN, STEP, BLOCK_BYTES = 5, 0, 400, 64, 3, 32, 20_000, 8 << 20
MARK, LONGEST, SCALE, PRIOR = 0x2581, 16, 8.0, 0.01


def vocabulary(model_file: str) -> list[str]:
    """The ordinary pieces of a sentencepiece model of up to 16 characters."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
    return [p for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))
            and 0 < len(p := sp.id_to_piece(i)) <= LONGEST]


class Trie:
    """Pieces as a trie in sorted arrays: an arc is (node, character) -> node."""

    def __init__(self, pieces: list[str]):
        arcs: dict[tuple[int, int], int] = {}
        ends = {}
        for number, p in enumerate(pieces):
            at = 0
            for c in p:
                at = arcs.setdefault((at, ord(c)), len(arcs) + 1)
            ends[at] = number
        self.table = Table(np.array([n << 21 | c for n, c in arcs], np.int64))
        self.piece = np.full(len(arcs) + 1, -1, np.int64)
        self.piece[list(ends)] = list(ends.values())
        self.size = len(pieces)

    def step(self, node: np.ndarray, char: np.ndarray) -> np.ndarray:
        at = self.table.find(node << 21 | char)  # arcs are numbered as the nodes they lead to, from 0
        return np.where(at >= 0, at + 1, -1)


class Lattice:
    """All pieces at all places of a list of words, as arcs between character positions."""

    def __init__(self, trie: Trie, words: pa.Array):
        mark, none = pa.scalar(chr(MARK), pa.large_string()), pa.scalar("", pa.large_string())
        words = pc.binary_join_element_wise(mark, words.cast(pa.large_string()), none)
        length = pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
        self.long = bool(len(length)) and int(length.max()) > RUN
        _, offsets, data = words.buffers()
        text = bytes(data[:int(np.frombuffer(offsets, np.int64)[len(words)])]).decode() if len(words) else ""
        chars = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.int64)
        base = np.cumsum(length + 1) - (length + 1)  # a word of n characters has n + 1 positions
        run = np.repeat(np.arange(len(length)), length)
        place = np.arange(len(chars)) - np.repeat(np.cumsum(length) - length, length)
        start, left = base[run] + place, length[run] - place
        at, node, depth = np.arange(len(chars)), np.zeros(len(chars), np.int64), 0
        found: list[tuple] = []
        single = np.zeros(len(chars), bool)
        while len(at):
            node = trie.step(node, chars[at + depth])
            at, node = at[node >= 0], node[node >= 0]
            depth += 1
            hit = trie.piece[node] >= 0
            found.append((start[at[hit]], start[at[hit]] + depth, trie.piece[node[hit]], place[at[hit]] + depth))
            if depth == 1:
                single[at[hit]] = True
            more = left[at] > depth
            at, node = at[more], node[more]
        lone = np.flatnonzero(~single)  # a character that is no piece stands for itself
        found.append((start[lone], start[lone] + 1, np.full(len(lone), trie.size), place[lone] + 1))
        a, b, piece, end = (np.concatenate([f[i] for f in found]) for i in range(4))
        order = np.lexsort((b, end)) if self.long else np.argsort(end << 40 | b)
        self.a, self.b, self.piece, end = a[order], b[order], piece[order], end[order]
        self.cut = np.searchsorted(end, np.arange(1, (int(end.max()) if len(end) else 0) + 2))
        self.first, self.last, self.size = base, base + length, int(base[-1] + length[-1] + 1) if len(length) else 0
        self.chars = length

    def forward(self, probability: np.ndarray) -> np.ndarray:
        """Sum of the products of all segmentations up to each position, for each column of
        ``probability`` (pieces x languages, scaled by SCALE per character); its logarithm where a word is long."""
        alpha = np.full((self.size, probability.shape[1]), -np.inf if self.long else 0.0)
        alpha[self.first] = 0 if self.long else 1
        p = np.log(np.maximum(probability, 1e-300)) if self.long else probability
        for lo, hi in zip(self.cut[:-1], self.cut[1:]):
            if hi > lo:
                b = self.b[lo:hi]
                heads = np.flatnonzero(np.concatenate(([True], b[1:] != b[:-1])))
                if self.long:
                    each = alpha[self.a[lo:hi]] + p[self.piece[lo:hi]]
                    top = np.maximum.reduceat(each, heads)
                    each -= np.repeat(top, np.diff(np.append(heads, hi - lo)), axis=0)
                    alpha[b[heads]] = top + np.log(np.add.reduceat(np.exp(each), heads))
                else:
                    alpha[b[heads]] = np.add.reduceat(alpha[self.a[lo:hi]] * p[self.piece[lo:hi]], heads)
        return alpha

    def log_words(self, probability: np.ndarray) -> np.ndarray:
        """log P of each word, for each language."""
        ends = self.forward(probability)[self.last]
        return (ends if self.long else np.log(np.maximum(ends, 1e-300))) - self.chars[:, None] * np.log(SCALE)

    def expected(self, probability: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Expected uses of each piece in one language, words weighted."""
        alpha = self.forward(probability)[:, 0]
        beta = np.full(self.size, -np.inf if self.long else 0.0)
        beta[self.last] = 0 if self.long else 1
        p = probability[self.piece, 0]
        p = np.log(np.maximum(p, 1e-300)) if self.long else p
        for lo, hi in zip(self.cut[:-1][::-1], self.cut[1:][::-1]):  # later ends first
            if hi > lo and self.long:
                np.logaddexp.at(beta, self.a[lo:hi], beta[self.b[lo:hi]] + p[lo:hi])
            elif hi > lo:
                np.add.at(beta, self.a[lo:hi], beta[self.b[lo:hi]] * p[lo:hi])
        if self.long:
            total = np.repeat(alpha[self.last], self.chars + 1)[self.a]
            used = np.exp(alpha[self.a] + p + beta[self.b] - total) * np.repeat(weight, self.chars + 1)[self.a]
        else:
            per_word = np.repeat(weight / np.maximum(alpha[self.last], 1e-300), self.chars + 1)
            used = alpha[self.a] * p * beta[self.b] * per_word[self.a]
        return np.bincount(self.piece, used, len(probability))


def lattices(trie: Trie, words: pa.Array) -> Iterator[tuple[np.ndarray, Lattice]]:
    """Lattices of STEP words, the long words apart, and which words each has."""
    words = words.cast(pa.large_string())
    long = pc.utf8_length(words).to_numpy(zero_copy_only=False) >= RUN  # without the mark
    for at in (np.flatnonzero(~long), np.flatnonzero(long)):
        for a in range(0, len(at), STEP):
            yield at[a:a + STEP], Lattice(trie, words.take(pa.array(at[a:a + STEP])))


@dataclass
class Model:
    """Up to COLUMNS languages."""
    trie: Trie
    languages: list[str]
    probability: np.ndarray  # (pieces + 1) x languages; the last row is for other characters


class Models:
    """All languages in the order of their names, a block at a time."""

    def __init__(self, base: Callable, blocks: list[Callable], widest: int):
        self.base, self.blocks, self.widest, self.held = base, blocks, widest, None

    def __iter__(self) -> Iterator[Model]:
        trie, sizes = self.base = self.base() if callable(self.base) else self.base
        for block in self.blocks:
            m = self.held
            if m is None:
                names, counts = zip(*block())
                m = Model(trie, list(names), np.concatenate([scaled(dense(c, len(sizes)), sizes) for c in counts], axis=1))
            if len(self.blocks) == 1:
                self.held = m
            yield m


def score_texts(texts: pa.Array, models: Iterator[Model]) -> tuple[list[str], np.ndarray]:
    """Best language and its posterior."""
    words, at, _, _ = words_of(texts, NON_SPACE)
    ids, distinct = coded(words)
    full = np.flatnonzero(np.diff(at))
    name, top, rest = np.full(len(texts), "", object), np.full(len(texts), -np.inf), np.zeros(len(texts))
    for m in models:
        each = np.empty((len(distinct), len(m.languages)))
        for k, x in lattices(m.trie, distinct):
            each[k] = x.log_words(m.probability)
        total = np.zeros((len(texts), len(m.languages)))
        if len(full):
            total[full] = np.add.reduceat(each[ids], at[full])
        best = total.argmax(1)
        high = total[np.arange(len(texts)), best]
        now = np.maximum(top, high)
        rest = rest * np.exp(top - now) + np.exp(total - now[:, None]).sum(1)  # relative to the best so far
        name = np.where(high > top, np.array(m.languages, object)[best], name)
        top = now
    return name.tolist(), 1 / rest


def dense(counts: tuple[np.ndarray, np.ndarray], pieces: int) -> np.ndarray:
    out = np.zeros(pieces)
    out[counts[0]] = counts[1]
    return out


def scaled(counts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Probabilities from expected counts, smoothed, times SCALE per character."""
    p = (counts + PRIOR) / (counts.sum() + PRIOR * len(counts))
    return np.append(p * SCALE ** sizes, 1.0)[:, None]


def fit(trie: Trie, sizes: np.ndarray, counts: list[tuple[str, int]], rounds: int = ROUNDS) -> np.ndarray:
    """Expected uses of each piece, from a language's (word, count) list. The start takes a piece's
    count from the words that hold it; each round redistributes by forward-backward."""
    words = sorted(counts)
    weight = np.array([n for _, n in words], float)
    parts = [(x, weight[k]) for k, x in lattices(trie, pa.array([w for w, _ in words], pa.large_string()))]
    uses = sum(np.bincount(x.piece, np.repeat(w, x.chars + 1)[x.a], len(sizes) + 1)[:-1] for x, w in parts)
    for _ in range(rounds):
        p = scaled(uses, sizes)
        uses = sum(x.expected(p, w)[:-1] for x, w in parts)
    return uses


def train(docs: DataFrame, model_file: str, folds: int, held_out: int, per_language: int, id_col: str, text_col: str, lang_col: str,
          block: int = COLUMNS) -> Callable[[], Models | None]:
    spark: SparkSession = docs.sparkSession
    known = docs.select(col(id_col).alias("id"), col(lang_col).cast("string").alias("lang"), col(text_col).alias("t"))
    known = known.filter(F.col("lang").isNotNull() & F.col("t").isNotNull() & (fold(F.col("id"), folds) != held_out))
    # the labels alone are counted; texts are read for the sample only
    known = sampled_each(known, "lang", per_language, "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_blocks(batches, "t", BLOCK_BYTES):
            words, at, _, _ = words_of(batch.column("t"), NON_SPACE)
            language = batch.column("lang").take(pa.array(np.repeat(np.arange(len(batch)), np.diff(at))))
            t = pa.table({"lang": language, "word": words.cast(pa.large_string())}).group_by(["lang", "word"]).aggregate([([], "count_all")])
            yield from t.select(["lang", "word", "count_all"]).cast(
                pa.schema([("lang", pa.string()), ("word", pa.string()), ("count_all", pa.int64())])).rename_columns(["lang", "word", "n"]).to_batches()

    rows = known.select("lang", "t").mapInArrow(run, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    pieces = vocabulary(model_file)
    base = shared(spark, (Trie(pieces), np.array([len(p) for p in pieces], float)))
    held: list = []

    def fitted(words: pa.Table) -> pa.Table:
        if not held:
            held.append(base())
        uses = fit(*held[0], list(zip(words["word"].to_pylist(), words["n"].to_pylist())))
        piece = np.flatnonzero(uses)
        return pa.table({"lang": words["lang"].slice(0, 1), "piece": pa.array([piece.astype(np.int32)], pa.list_(pa.int32())),
                         "uses": pa.array([uses[piece]], pa.list_(pa.float64()))})

    model = stored(rows.groupBy("lang").applyInArrow(fitted, "lang string, piece array<int>, uses array<double>"), "langid-model")
    names = sorted(r["lang"] for r in model.select("lang").collect())

    def counts(first: str, last: str) -> list[tuple[str, tuple[np.ndarray, np.ndarray]]]:
        t = model.filter(F.col("lang").between(first, last)).toArrow()
        return sorted(((n, (np.array(p, np.int32), np.array(u))) for n, p, u in zip(*(t[c].to_pylist() for c in ("lang", "piece", "uses")))),
                      key=lambda x: x[0])

    blocks = [shared(spark, counts(names[a], names[a:a + block][-1])) for a in range(0, len(names), block)]
    return lambda: Models(base, blocks, min(len(names), block)) if blocks else None


def identify(docs: DataFrame, model_file: str, folds: int = FOLDS, held_out: int = HELD_OUT, per_language: int = PER_LANGUAGE,
             id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             carry: list[str] | None = None) -> DataFrame:
    """Every row of ``docs`` with held_out, lang_pred, score. ``carry``: the input columns to keep
    (default: all)."""
    model = train(docs, model_file, folds, held_out, per_language, id_col, text_col, lang_col)

    def score(texts: pa.Array, m: Models | None) -> dict[str, pa.Array]:
        names, scores = (["und"] * len(texts), np.zeros(len(texts))) if m is None else score_texts(texts, m)
        return {"l": pa.array(names, pa.string()), "s": pa.array(scores)}

    columns = carried(docs, carry)
    rows = packed(docs, columns, text_col, id=col(id_col), letter=F.coalesce(col(text_col).rlike(r"\p{L}"), F.lit(False)))
    # a row per word and language is held, so more languages mean smaller blocks
    rows = map_texts(rows, text_col in columns, {"l": T.StringType(), "s": T.DoubleType()},
                     lambda m: 4 * BLOCK_BYTES // max(4, m.widest if m else 0), score, model)
    letter = F.col("letter") & (F.col("l") != "und")
    return unpacked(rows, columns, {
        "held_out": fold(F.col("id"), folds) == held_out,
        "lang_pred": F.when(letter, F.col("l")).otherwise("und"), "score": F.when(letter, F.col("s")).otherwise(0.0)}, text_col)
