r"""Operator 13. Removal of passages that an earlier document has: seed and extend.

A passage counts from ``window`` (50) words on. Seeds are winnowed anchors: of the 41 sequences of 10
words in a window the one with the smallest hash, the rightmost of equal ones. Which one that is depends on
the window's words alone, so two equal windows have equal anchors at the same place, and every window
belongs to exactly one anchor.

Documents are joined on their anchors. An anchor of one document goes. What all windows of an anchor can
reach (40 words on both sides) is its surroundings: where two anchors agree in them, they extend alike,
and the document with the larger id loses every window of the anchor. Only among the first documents of
different surroundings are the extensions told apart: there the matches are extended both ways, one step
at a time, as hashes of the windows, which are joined on (anchor, window). Windows that touch make one
maximal repeat, a span.

How rows move: anchors (about one in 21 words) once to count and once to join; text once, by (id, digest
of the text), for both the extension and the result (Spark reuses that shuffle); then spans. Counts are
summed before each shuffle, and every join splits a hot key (``operators.joins.split_join``), so a passage or a
text that a third of all rows hold is spread. No pairs of documents are listed.

Two 64-bit hashes (of the anchor and of the surroundings or window) stand for word sequences.

Defined results: a null or wordless text has no words; a null id is neither smaller nor larger than
another, so such a document loses nothing and takes nothing; rows of one id aren't smaller than each
other and keep what they share; repeated rows get equal results; an empty table gives an empty result;
input columns named like a result are replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.joins import split_join
from .common import carried, col, map_texts, packed, stored, text_blocks, unpacked
from .words import NON_SPACE, coded, joined, ranges, words_of

WINDOW, ANCHOR, BLOCK_BYTES = 50, 10, 1 << 20
SPAN = T.StructType([T.StructField("start", T.LongType()), T.StructField("stop", T.LongType())])
FACTOR = 0x9E3779B97F4A7C15
INVERSE = pow(FACTOR, -1, 1 << 64)


def mixed(h: np.ndarray) -> np.ndarray:
    """64-bit hashes, every bit spread over all others."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Rolling:
    """Hashes of any word sequences of the texts in a row."""

    def __init__(self, ids: np.ndarray, vocabulary: pa.Array):
        of_word = np.array([xxhash.xxh64_intdigest(w) for w in vocabulary.to_pylist()], np.uint64)
        words = of_word[ids] if len(ids) else np.zeros(0, np.uint64)
        powers = np.full(len(ids) + 1, FACTOR, np.uint64)
        powers[0] = 1
        self.back = np.full(len(ids) + 1, INVERSE, np.uint64)
        self.back[0] = 1
        powers, self.back = np.cumprod(powers), np.cumprod(self.back)
        self.sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(words * powers[:-1])))

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """The hash of words start..stop-1."""
        return mixed((self.sums[stop] - self.sums[start]) * self.back[start])


def anchors_of(ids: np.ndarray, vocabulary: pa.Array, at: np.ndarray, window: int, anchor: int) -> tuple[np.ndarray, ...]:
    """Of texts (word numbers ``ids``; text r has at[r]..at[r+1]) all anchors: (text, anchor hash,
    surroundings hash, first and last window start within the text)."""
    none = np.zeros(0, np.int64)
    if len(ids) < window:
        return none, none, none, none, none
    rolling = Rolling(ids, vocabulary)
    first = np.arange(len(ids) - anchor + 1)
    grams = rolling.of(first, first + anchor)
    # the smallest, rightmost of window - anchor + 1 neighbours, by doubling
    span, best, width = window - anchor + 1, first, 1
    while width < span:
        step = min(width, span - width)
        left, right = best[:-step], best[step:]
        best = np.where(grams[right] <= grams[left], right, left)
        width += step
    starts, _ = ranges(at[:-1], np.maximum(at[:-1], at[1:] - window + 1))  # windows within one text
    if not len(starts):
        return none, none, none, none, none
    place = best[starts]
    text = np.searchsorted(at, starts, "right") - 1
    new = np.flatnonzero(np.concatenate(([True], (place[1:] != place[:-1]) | (text[1:] != text[:-1]))))
    last = np.concatenate((new[1:], [len(starts)])) - 1
    text, place = text[new], place[new]
    low, high = np.maximum(at[text], place + anchor - window), np.minimum(at[text + 1], place + window)
    around = mixed(rolling.of(low, high) ^ mixed(((place - low) * 1024 * 1024 + (high - place)).astype(np.uint64)))
    return text, grams[place].view(np.int64), around.view(np.int64), starts[new] - at[text], starts[last] - at[text]


def anchor_rows(rows: DataFrame, window: int, anchor: int) -> DataFrame:
    """(key, a, c, first, last) of every anchor of the texts with an id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_blocks(batches, "t", BLOCK_BYTES):
            words, at, _, _ = words_of(batch.column("t"), NON_SPACE)
            ids, vocabulary = coded(words)
            text, a, c, first, last = anchors_of(ids, vocabulary, at, window, anchor)
            yield pa.RecordBatch.from_arrays([batch.column("key").take(pa.array(text)), pa.array(a), pa.array(c), pa.array(first.astype(np.int32)),
                                              pa.array(last.astype(np.int32))], names=["key", "a", "c", "first", "last"])

    wanted = rows.select("key", "t").filter("key.id IS NOT NULL AND t IS NOT NULL")
    return wanted.mapInArrow(run, T.StructType([rows.schema["key"], *[T.StructField(x, T.LongType()) for x in ("a", "c")],
                                                *[T.StructField(x, T.IntegerType()) for x in ("first", "last")]]))


def window_rows(found: DataFrame, window: int) -> DataFrame:
    """(key, aw, start) of the windows of the listed anchors ``open`` (a, first, last) of texts ``t``;
    ``aw`` is (anchor, hash of the window)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_blocks(batches, "t", BLOCK_BYTES):
            words, at, _, _ = words_of(batch.column("t"), NON_SPACE)
            ids, vocabulary = coded(words)
            listed = batch.column("open")
            flat, text = listed.flatten(), np.repeat(np.arange(len(at) - 1), np.asarray(listed.value_lengths()))
            a, first, last = (flat.field(k).to_numpy(zero_copy_only=False) for k in range(3))
            start, which = ranges(first.astype(np.int64), last.astype(np.int64) + 1)
            text = text[which]
            begin = at[text] + start
            hashes = Rolling(ids, vocabulary).of(begin, begin + window).view(np.int64)
            both = pa.StructArray.from_arrays([pa.array(a[which]), pa.array(hashes)], names=["a", "w"])
            yield pa.RecordBatch.from_arrays([batch.column("key").take(pa.array(text)), both, pa.array(start.astype(np.int64))], names=["key", "aw", "start"])

    both = T.StructType([T.StructField(x, T.LongType()) for x in ("a", "w")])
    return found.mapInArrow(run, T.StructType([found.schema["key"], T.StructField("aw", both), T.StructField("start", T.LongType())]))


def repeats(rows: DataFrame, window: int, anchor: int) -> DataFrame:
    """(key, spans): the word ranges, overlapping and unordered, that an earlier document has."""
    seeds = stored(anchor_rows(rows, window, anchor), "substring-anchors")
    groups = (seeds.groupBy("a").agg(F.min("key.id").alias("low"), F.max("key.id").alias("high"), F.min("c").alias("c0"), F.max("c").alias("c1"))
              .filter("low < high").select("a", (F.col("c0") != F.col("c1")).alias("differ")))
    shared = split_join(seeds, groups, "a").select("key", F.struct("a", "c").alias("ac"), "first", "last", "differ")
    shared = stored(shared, "substring-shared")
    shared = split_join(shared, shared.groupBy("ac").agg(F.min("key.id").alias("low")), "ac")
    later = shared.filter("low < key.id").select("key", F.col("first").cast("long").alias("start"), F.expr(f"CAST(last + {window} AS LONG)").alias("stop"))
    open_ = (shared.filter("differ AND low = key.id").groupBy("key")
             .agg(F.collect_list(F.struct(F.col("ac.a").alias("a"), "first", "last")).alias("open")))
    windows = window_rows(split_join(rows, open_, "key"), window)
    earliest = windows.groupBy("aw").agg(F.min("key.id").alias("low"))
    extended = split_join(windows, earliest, "aw").filter("low < key.id").select("key", "start", (F.col("start") + window).alias("stop"))
    return later.unionAll(extended).groupBy("key").agg(F.collect_list(F.struct("start", "stop")).alias("found"))


def judge(texts: pa.Array, found: pa.Array, with_text: bool) -> dict[str, pa.Array]:
    words, at, _, _ = words_of(texts, NON_SPACE)
    n, rows = int(at[-1]), len(texts)
    flat = found.flatten()
    text = np.repeat(np.arange(rows), np.asarray(found.value_lengths().fill_null(0)))
    start, stop = (at[text] + flat.field(k).to_numpy(zero_copy_only=False) for k in range(2))
    depth = np.bincount(start, minlength=n + 1) - np.bincount(stop, minlength=n + 1)
    covered = np.cumsum(depth)[:n] > 0
    kept = np.flatnonzero(~covered)
    kept_at = np.searchsorted(kept, at)
    spaced, byte = joined(words.take(pa.array(kept)), kept_at)
    kept_text = [spaced[byte[r]:byte[r + 1]][:-1].tobytes() for r in range(rows)]
    # spans: a new one where cover begins or a text begins
    opens = covered & np.concatenate(([True], ~covered[:-1]))[:n]
    closes = covered & np.concatenate((~covered[1:], [True]))[:n]
    heads, ends = at[:-1][at[:-1] < at[1:]], at[1:][at[:-1] < at[1:]] - 1
    opens[heads], closes[ends] = covered[heads], covered[ends]
    begin, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    span_at = np.searchsorted(begin, at)
    base = np.repeat(at[:-1], np.diff(span_at))
    spans = pa.ListArray.from_arrays(pa.array(span_at, pa.int32()), pa.StructArray.from_arrays([pa.array(begin - base), pa.array(end - base)], names=["start", "stop"]))
    out = {"n_words": pa.array(np.diff(at)), "n_removed": pa.array(np.diff(at) - np.diff(kept_at)),
           "kept_sha256": pa.array([hashlib.sha256(k).hexdigest() for k in kept_text], pa.string()), "spans": spans}
    return out | ({"kept_text": pa.array([k.decode() for k in kept_text], pa.string())} if with_text else {})


def remove_repeats(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, id_col: str = "doc_id", text_col: str = "text",
                   with_text: bool = False, carry: list[str] | None = None) -> DataFrame:
    """Every row of ``docs`` with n_words, n_removed, kept_sha256 (of the kept words joined by one space) and
    spans: the removed word ranges (start, stop). ``with_text`` adds kept_text; ``carry``: the input
    columns to keep (default: all); ``window`` >= ``anchor`` words."""
    columns = carried(docs, carry)
    key = F.struct(col(id_col).alias("id"), F.xxhash64(col(text_col)).alias("h"))
    rows = packed(docs, columns, text_col, key=key)
    held = split_join(rows, repeats(rows, window, anchor), "key", "left")
    results = {"n_words": T.LongType(), "n_removed": T.LongType(), "kept_sha256": T.StringType(), "spans": T.ArrayType(SPAN)}
    results |= {"kept_text": T.StringType()} if with_text else {}
    out = map_texts(held, text_col in columns, results, BLOCK_BYTES, lambda texts, _, found: judge(texts, found, with_text), beside="found")
    return unpacked(out, columns, {k: F.col(k) for k in results}, text_col)
