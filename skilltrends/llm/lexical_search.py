r"""Operator 12. Ranked lexical search of all items at once, sharing common sub-expressions.

An item's score is a sum over its terms, so items that share terms share partial sums. Terms that stand
in exactly the same items become one node first; then the pair of neighbouring nodes (items keep their
nodes ordered by how many items have them) that most items share becomes a node, again and again, until
no pair stands in two items. The nodes form a graph without cycles: a node is a term or the sum of two
nodes. A task tokenises a block of documents, fills the accumulators of the terms, materialises every
shared node once, and combines the items from them.

Two passes over the texts, neither moves text: one counts N, L and the df of the items' terms (summed
per task first), one scores. Each task keeps the ``top`` best rows of every item; their union is ranked
in two steps, by (item, part) and by item. Items go to the tasks in blocks of ``block_bytes`` of text, each
a broadcast of bounded size; more blocks mean more passes.

Terms: maximal runs of [0-9A-Za-z] and characters from U+0080 on, A-Z lower-cased. Weights are doubles
rounded down, all else 64-bit integers (a product beyond them goes through Python's).

Defined results: a null or wordless text is no document (not in N, never a hit); a null or wordless item
has no rows, and a term of no document adds its weight to none; a repeated row of documents is one more
document; a repeated item row counts once, items of one id but different texts are ranked apart under
that id; equal scores go by ascending doc_id, null last; empty tables give an empty result; other columns
of both tables are ignored.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import col, shared, stored, text_blocks
from .words import ALNUM, words_of

TOP, BLOCK_BYTES, TEXT_BYTES, CELLS, PARTS = 10, 1 << 20, 1 << 20, 1 << 22, 64


class SharingGraph:
    """The items of a block as sums over shared nodes.

    ``terms``: the distinct terms, nodes 0..len(terms)-1. ``pairs``: for each further node the two nodes it
    sums, both of lower number. ``items``: for each item the nodes whose sum is its score."""

    def __init__(self, item_terms: list[list[bytes]]):
        self.terms = sorted({t for terms in item_terms for t in terms})
        number = {t: i for i, t in enumerate(self.terms)}
        sets = [[number[t] for t in terms] for terms in item_terms]
        self.pairs: list[tuple[int, int]] = []
        holders: dict[int, list[int]] = defaultdict(list)
        for i, nodes in enumerate(sets):
            for t in nodes:
                holders[t].append(i)
        alike: dict[tuple, list[int]] = defaultdict(list)  # terms of exactly the same items
        for t, items in holders.items():
            alike[tuple(items)].append(t)
        lines: list[list[int]] = [[] for _ in sets]
        for items, nodes in sorted(alike.items(), key=lambda kv: (-len(kv[0]), kv[1])):
            if len(items) > 1:
                nodes = [self._sum(nodes)]
            for i in items:
                lines[i] += nodes  # the most shared first
        self.items = self._pair_up(lines)

    def _sum(self, nodes: list[int]) -> int:
        total = nodes[0]
        for n in nodes[1:]:
            total = self._node(total, n)
        return total

    def _node(self, a: int, b: int) -> int:
        self.pairs.append((a, b))
        return len(self.terms) + len(self.pairs) - 1

    def _pair_up(self, lines: list[list[int]]) -> list[list[int]]:
        """Replace the pairs of neighbours of two items or more by nodes, the most frequent first."""
        while True:
            count = Counter(p for line in lines for p in set(zip(line, line[1:])))
            chosen: dict[tuple[int, int], int] = {}
            used: set[int] = set()
            for (a, b), n in sorted(count.items(), key=lambda kv: (-kv[1], kv[0])):
                if n < 2:
                    break
                if a not in used and b not in used:  # pairs that don't compete in this round
                    used |= {a, b}
                    chosen[a, b] = self._node(a, b)
            if not chosen:
                return lines
            for k, line in enumerate(lines):
                out, i = [], 0
                while i < len(line):
                    node = chosen.get((line[i], line[i + 1])) if i + 1 < len(line) else None
                    out.append(line[i] if node is None else node)
                    i += 1 if node is None else 2
                lines[k] = out

    def levels(self) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """The summing nodes by depth: (node, left, right) arrays, each level from lower ones only."""
        depth = [0] * len(self.terms)
        for a, b in self.pairs:
            depth.append(1 + max(depth[a], depth[b]))
        out: dict[int, list] = defaultdict(list)
        for k, (a, b) in enumerate(self.pairs):
            out[depth[len(self.terms) + k]].append((len(self.terms) + k, a, b))
        return [tuple(np.array(x).T) for _, x in sorted(out.items())]


def terms_of(texts: list[str]) -> list[list[bytes]]:
    """The distinct terms of each text."""
    words, at, _, _ = words_of(pa.array(texts, pa.string()), ALNUM)
    words = words.to_pylist()
    return [sorted(set(words[a:b])) for a, b in zip(at[:-1], at[1:])]


def postings(texts: pa.Array, vocabulary: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Terms of each text (with repeats), and (text, term number, tf) of those in the vocabulary."""
    words, at, _, _ = words_of(texts, ALNUM)
    numbers = pc.fill_null(pc.index_in(words, value_set=vocabulary), -1).to_numpy(zero_copy_only=False).astype(np.int64)
    text = np.repeat(np.arange(len(texts)), np.diff(at))
    known = numbers >= 0
    keys, tf = np.unique(text[known] * max(1, len(vocabulary)) + numbers[known], return_counts=True)
    return np.diff(at), keys // max(1, len(vocabulary)), keys % max(1, len(vocabulary)), tf


def count_terms(docs: DataFrame, vocabulary: pa.Array) -> tuple[int, int, dict[int, int]]:
    """N, L and the document frequency of each vocabulary term, over all texts (column ``t``)."""
    held = shared(docs.sparkSession, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = held()
        n, total, df = 0, 0, np.zeros(len(words), np.int64)
        for batch in text_blocks(batches, "t", TEXT_BYTES):
            sizes, _, term, _ = postings(batch.column("t"), words)
            n, total = n + int((sizes > 0).sum()), total + int(sizes.sum())
            df += np.bincount(term, minlength=len(words))
        seen = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(([-2, -1], seen))), pa.array(np.concatenate(([n, total], df[seen])))], names=["term", "n"])

    rows = docs.select("t").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    counts = {r["term"]: r["n"] for r in rows}  # a row for each term of the block at most
    return counts.pop(-2, 0), counts.pop(-1, 0), counts


def impacts(tf: np.ndarray, size: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """The saturated term frequency: (10**9 * tf) div (1000 * tf + 8 * m)."""
    if not len(tf):
        return tf
    if 90 * n_docs * int(size.max()) < 1 << 62 and int(tf.max()) < 1 << 32:
        m = 10 + 90 * size * n_docs // n_terms
        return 1_000_000_000 * tf // (1000 * tf + 8 * m)
    m = 10 + 90 * size.astype(object) * n_docs // n_terms
    return (1_000_000_000 * tf.astype(object) // (1000 * tf.astype(object) + 8 * m)).astype(np.int64)


class Best:
    """The best rows of every item so far, from blocks of scores."""

    def __init__(self, items: int, top: int):
        self.top = top
        self.item, self.id, self.null, self.score = (np.zeros(0, t) for t in (np.int64, np.int64, bool, np.int64))
        self.floor = np.zeros(items, np.int64)  # what a row must reach, once an item has ``top`` rows

    def add(self, scores: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        """``scores``: a row per item, a column per document."""
        item, place = np.nonzero((scores > 0) & (scores >= self.floor[:, None]))
        item, ids, null, score = (np.concatenate(x) for x in (
            (self.item, item), (self.id, ids[place]), (self.null, null[place]), (self.score, scores[item, place])))
        order = np.lexsort((ids, null, -score, item))
        first = np.searchsorted(item[order], np.arange(len(self.floor)))
        rank = np.arange(len(order)) - first[item[order]]
        full = order[rank == self.top - 1]
        self.floor[item[full]] = score[full]
        order = order[rank < self.top]
        self.item, self.id, self.null, self.score = item[order], ids[order], null[order], score[order]


def search_block(docs: DataFrame, keys: list, texts: list[str], top: int) -> DataFrame:
    """The best rows of every item of a block in every task: (item number, doc_id, score)."""
    graph = SharingGraph(terms_of(texts))
    vocabulary = pa.array(graph.terms, pa.large_binary())
    n_docs, n_terms, df = count_terms(docs, vocabulary)
    weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df.get(t, 0) + 1))) for t in range(len(graph.terms))], np.int64)
    held = shared(docs.sparkSession, (vocabulary, weights, graph.levels(), graph.items, len(graph.terms) + len(graph.pairs)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, weights, levels, items, nodes = held()
        best = Best(len(items), top)
        of = np.repeat(np.arange(len(items)), [len(x) for x in items])
        parts = np.array([x for line in items for x in line], np.int64)
        lines = np.flatnonzero([len(x) > 0 for x in items])
        heads = np.searchsorted(of, lines)
        at_once = max(16, CELLS // max(1, nodes + len(items)))
        for batch in text_blocks(batches, "t", TEXT_BYTES):
            sizes, text, term, tf = postings(batch.column("t"), words)
            score = impacts(tf, sizes[text], n_docs, n_terms) * weights[term]
            ids = batch.column("doc_id")
            null = np.asarray(ids.is_null())
            ids = pc.fill_null(ids, 0).to_numpy(zero_copy_only=False)
            cut = np.searchsorted(text, np.arange(0, len(sizes) + at_once, at_once))
            for k, (a, b) in enumerate(zip(cut[:-1], cut[1:])):
                if a == b:
                    continue
                here, place = np.unique(text[a:b], return_inverse=True)  # documents with a term
                sums = np.zeros((nodes, len(here)), np.int64)
                sums[term[a:b], place] = score[a:b]
                for node, left, right in levels:
                    sums[node] = sums[left] + sums[right]
                scores = np.zeros((len(items), len(here)), np.int64)
                if len(parts):
                    scores[lines] = np.add.reduceat(sums[parts], heads, axis=0)
                best.add(scores, ids[here], null[here])
        yield pa.RecordBatch.from_arrays([pa.array(best.item), pa.array(best.id, mask=best.null), pa.array(best.score)], names=["item", "doc_id", "score"])

    return docs.mapInArrow(run, "item long, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, top: int = TOP, block_bytes: int = BLOCK_BYTES, text_col: str = "text",
           id_col: str = "doc_id", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """For every row of ``items`` its ``top`` documents with a score above 0: item_id, rank, doc_id,
    score. ``docs`` has an integer ``id_col``."""
    spark = docs.sparkSession
    rows = docs.select(col(id_col).cast("long").alias("doc_id"), col(text_col).alias("t"))
    wanted = items.select(col(item_col).alias("k"), F.coalesce(col(item_text), F.lit("")).alias("t")).distinct()
    total = wanted.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    n = max(1, -(-total // block_bytes))
    key_type = wanted.schema["k"].dataType
    found = None
    for i in range(n):
        block = wanted if n == 1 else wanted.filter(F.pmod(F.xxhash64("k", "t"), F.lit(n)) == i)
        part = block.collect()
        names = spark.createDataFrame([(j, r["k"]) for j, r in enumerate(part)],
                                      T.StructType([T.StructField("item", T.LongType()), T.StructField("item_id", key_type)]))
        best = search_block(rows, [r["k"] for r in part], [r["t"] for r in part], top)
        best = best.withColumn("block", F.lit(i))
        names = names.withColumn("block", F.lit(i))
        found = (best, names) if found is None else (found[0].unionAll(best), found[1].unionAll(names))
    best, names = found
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    best = best.withColumn("part", F.pmod(F.xxhash64("doc_id", "score"), F.lit(PARTS)))
    best = (best.withColumn("rank", F.row_number().over(Window.partitionBy("block", "item", "part").orderBy(*order)))
            .filter(F.col("rank") <= top).drop("rank", "part"))
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("block", "item").orderBy(*order))).filter(F.col("rank") <= top)
    return best.join(names, ["block", "item"]).select("item_id", "rank", "doc_id", "score")
