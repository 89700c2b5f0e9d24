r"""Operator 7. Benchmark decontamination with an FM-index per training shard.

A shard is a run of whole documents (a few MB of text; a longer document is cut into pieces that
overlap by a window less one word). Its words become numbers of a shard vocabulary; suffixes are
sorted by prefix doubling (only ties are sorted again); the Burrows-Wheeler transform goes into a
wavelet matrix with popcount ranks, and every 16th text position and each document start keep their
suffix position. All windows of the benchmark are searched backwards at once; occurrences walk to
the next sampled position and are merged into spans of words to remove.

Documents never shuffle: a task indexes and searches what it reads, and its memory is that of one
shard. The benchmark is the stated query set. It goes to the tasks in blocks of ``block_bytes`` of
text, each a broadcast of bounded size; more blocks mean more passes over the shards, merged per row.

Words: [0-9a-z] and everything from U+0080 on, after lower-casing A-Z. A window is 13 consecutive
words of an item, or all words of a shorter one.

Defined results: a null or wordless text has no words and no hits (contaminated false); a null or
wordless item has no window; an item without an id goes by the name ``null``; items of one id
count once; an empty benchmark marks nothing; repeated rows are judged row by row; an empty table
gives an empty result; input columns named like a result are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import carried, col, map_texts, packed, shared, unpacked
from .words import ALNUM, coded, ranges, words_of

WINDOW, SHARD_BYTES, SHARD_WORDS, SAMPLE, BLOCK_BYTES = 13, 3 << 20, 1 << 20, 16, 4 << 20


class Bits:
    """A bit vector with popcount ranks."""

    def __init__(self, bits: np.ndarray):
        packed_bits = np.packbits(bits, bitorder="little")
        words = np.zeros(len(bits) // 64 + 1, np.uint64)
        words.view(np.uint8)[:len(packed_bits)] = packed_bits
        self.words = words
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(words), dtype=np.int64)[:-1])).astype(np.int32)

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones before position i."""
        w = i >> 6
        below = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[w] + np.bitwise_count(self.words[w] & below)

    def get(self, i: np.ndarray) -> np.ndarray:
        return ((self.words[i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1)).astype(bool)


def suffix_array(rank: np.ndarray) -> np.ndarray:
    """Suffix order of a sequence whose last symbol, and one symbol in every repeat, is unique
    (the separators are), so no comparison runs off the end."""
    n = len(rank)
    following = np.concatenate((rank[1:], rank[:1]))
    key = rank * (int(rank.max()) + 1) + following
    sa = np.argsort(key)
    key = key[sa]
    slot, h, rank = np.arange(n), 2, np.empty(n, np.int64)
    part = sa
    while True:
        new = np.concatenate(([True], key[1:] != key[:-1]))
        heads = slot[np.maximum.accumulate(np.where(new, np.arange(len(slot)), 0))]
        rank[part] = heads
        alone = new & np.concatenate((new[1:], [True]))
        slot = slot[~alone]
        if not len(slot):
            return sa
        part = sa[slot]
        key = rank[part] * n + rank[part + h]
        order = np.argsort(key)
        part, key = part[order], key[order]
        sa[slot] = part
        h *= 2


class FMIndex:
    """Over texts given as symbol numbers 1.. ; symbol 0 ends every text."""

    def __init__(self, symbols: np.ndarray, text_of_separator: np.ndarray, starts: np.ndarray):
        n, texts = len(symbols), len(starts)
        rank = symbols.astype(np.int64) + texts - 1
        rank[text_of_separator] = np.arange(texts)
        sa = suffix_array(rank)
        top = int(symbols.max()) + 1
        self.first = np.concatenate(([0], np.cumsum(np.bincount(symbols, minlength=top))))
        cur = symbols[sa - 1]
        self.levels: list[tuple[int, Bits, int]] = []
        for b in range(max(1, int(top - 1).bit_length()) - 1, -1, -1):
            one = (cur >> b) & 1 == 1
            self.levels.append((b, Bits(one), n - int(one.sum())))
            cur = np.concatenate((cur[~one], cur[one]))
        self.begin = np.zeros(top, np.int64)
        heads = np.flatnonzero(np.concatenate(([True], cur[1:] != cur[:-1])))
        self.begin[cur[heads]] = heads
        sampled = np.zeros(n, bool)
        sampled[::SAMPLE] = True
        sampled[starts] = True
        marked = sampled[sa]
        self.marked, self.samples, self.n = Bits(marked), sa[marked], n

    def rank(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Occurrences of symbol c in the transform before row i."""
        for b, bits, zeros in self.levels:
            ones = bits.rank(i)
            i = np.where((c >> b) & 1 == 1, zeros + ones, i - ones)
        return i - self.begin[c]

    def back(self, i: np.ndarray) -> np.ndarray:
        """The row of the suffix one position before that of row i."""
        c = np.zeros(len(i), np.int64)
        for b, bits, zeros in self.levels:
            ones, one = bits.rank(i), bits.get(i)
            c |= one.astype(np.int64) << b
            i = np.where(one, zeros + ones, i - ones)
        return self.first[c] + i - self.begin[c]

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row ranges of patterns (right-aligned in a matrix): (pattern, low, high) of those found."""
        which = np.arange(len(patterns))
        low, high = np.zeros(len(which), np.int64), np.full(len(which), self.n, np.int64)
        width = patterns.shape[1]
        done: list[tuple] = []
        for step in range(width):
            over = lengths[which] == step
            if over.any():
                done.append((which[over], low[over], high[over]))
                which, low, high = which[~over], low[~over], high[~over]
            c = patterns[which, width - 1 - step]
            low, high = self.first[c] + self.rank(c, low), self.first[c] + self.rank(c, high)
            alive = low < high
            which, low, high = which[alive], low[alive], high[alive]
            if not len(which):
                break
        done.append((which, low, high))
        return tuple(np.concatenate([d[i] for d in done]) for i in range(3))

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of the suffixes in ``rows``."""
        out, left, steps = np.empty(len(rows), np.int64), np.arange(len(rows)), 0
        while len(left):
            known = self.marked.get(rows)
            out[left[known]] = self.samples[self.marked.rank(rows[known])] + steps
            left, rows, steps = left[~known], self.back(rows[~known]), steps + 1
        return out


class Phrases:
    """The distinct windows of a block of items, and the items of each."""

    def __init__(self, items: list[tuple[str, str]], window: int = WINDOW):
        words, at, _, _ = words_of(pa.array([t for _, t in items], pa.string()), ALNUM)
        ids, self.vocabulary = coded(words)
        names = sorted({k for k, _ in items})
        number = {k: i for i, k in enumerate(names)}
        rows, owner = [], []
        for (k, _), a, b in zip(items, at[:-1], at[1:]):
            if b - a >= window:
                w = np.lib.stride_tricks.sliding_window_view(ids[a:b], window)
            elif b > a:
                w = np.concatenate((np.full(window - (b - a), -1), ids[a:b]))[None]
            else:
                continue
            rows.append(w)
            owner.append(np.full(len(w), number[k]))
        every = np.concatenate(rows) if rows else np.zeros((0, window), np.int64)
        self.windows, which = np.unique(every, axis=0, return_inverse=True)
        pairs = np.unique(np.stack([which.ravel(), np.concatenate(owner)], 1), axis=0) if rows else np.zeros((0, 2), np.int64)
        self.lengths = (self.windows >= 0).sum(1)
        self.owners = pairs[:, 1]
        self.owner_at = np.searchsorted(pairs[:, 0], np.arange(len(self.windows) + 1))
        self.names = np.array(names, dtype=object)
        self.window = window


def find(ids: np.ndarray, dictionary: pa.Array, at: np.ndarray, phrases: Phrases) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Index the texts (word numbers ``ids``; text r has at[r]..at[r+1]) and look all phrases up.
    Returns text, first word within the text, phrase of every occurrence."""
    texts, n = len(at) - 1, len(ids)
    none = np.zeros(0, np.int64)
    numbers = pc.fill_null(pc.index_in(phrases.vocabulary.cast(dictionary.type), value_set=dictionary), -1).to_numpy(zero_copy_only=False).astype(np.int64)
    numbers = np.concatenate((numbers, [-2]))  # the last one, for padding
    wanted = numbers[phrases.windows]
    possible = np.flatnonzero((wanted != -1).all(1))
    symbols = np.zeros(n + texts, np.int32)
    starts = at[:-1] + np.arange(texts)
    separators = at[1:] + np.arange(texts)
    inside = np.ones(n + texts, bool)
    inside[separators] = False
    symbols[inside] = ids + 1
    index = FMIndex(symbols, separators, starts)
    if not len(possible):
        return none, none, none
    which, low, high = index.search(wanted[possible] + 1, phrases.lengths[possible])
    rows, owner = ranges(low, high)
    position = index.locate(rows)
    text = np.searchsorted(starts, position, "right") - 1
    return text, position - starts[text], possible[which[owner]]


def search_batch(texts: pa.Array, phrases: Phrases) -> dict[str, pa.Array]:
    """n_words, spans and items of each text."""
    words, at, _, _ = words_of(texts, ALNUM)
    ids, dictionary = coded(words)
    n_rows = len(texts)
    if len(ids) <= SHARD_WORDS or n_rows > 1:
        row, first, phrase = find(ids, dictionary, at, phrases)
    else:  # one very long text, in pieces that overlap by a window less one word
        found = []
        for a in range(0, len(ids), SHARD_WORDS):
            piece = ids[a:a + SHARD_WORDS + phrases.window - 1]
            _, f, p = find(piece, dictionary, np.array([0, len(piece)]), phrases)
            found.append((f + a, p))
        first, phrase = (np.concatenate([x[i] for x in found]) for i in range(2))
        row = np.zeros(len(first), np.int64)
    begin = at[row] + first
    depth = np.bincount(begin, minlength=len(ids) + 1) - np.bincount(begin + phrases.lengths[phrase], minlength=len(ids) + 1)
    covered = np.concatenate(([False], np.cumsum(depth)[:-1] > 0, [False]))
    change = covered[1:] != covered[:-1]
    cuts = at[1:-1]  # a span ends with its text
    both = cuts[(cuts > 0) & (cuts < len(ids))]
    both = both[covered[both] & covered[both + 1]]
    opens = np.union1d(np.flatnonzero(change & covered[1:]), both)
    closes = np.union1d(np.flatnonzero(change & covered[:-1]), both)
    owner = np.searchsorted(at, opens, "right") - 1
    owner_at = np.searchsorted(owner, np.arange(n_rows + 1))
    spans = pa.ListArray.from_arrays(pa.array(owner_at, pa.int32()), pa.StructArray.from_arrays(
        [pa.array(opens - at[owner]), pa.array(closes - at[owner])], names=["start", "stop"]))
    pairs = np.unique(row * max(1, len(phrases.windows)) + phrase)
    prow, pwin = pairs // max(1, len(phrases.windows)), pairs % max(1, len(phrases.windows))
    owners, of = ranges(phrases.owner_at[pwin], phrases.owner_at[pwin + 1])
    hits = np.unique(prow[of] * max(1, len(phrases.names)) + phrases.owners[owners])
    hrow, hname = hits // max(1, len(phrases.names)), hits % max(1, len(phrases.names))
    items = pa.ListArray.from_arrays(pa.array(np.searchsorted(hrow, np.arange(n_rows + 1)), pa.int32()),
                                     pa.array(phrases.names[hname].tolist(), pa.string()))
    return {"n": pa.array(np.diff(at)), "s": spans, "i": items}


def blocks_of(benchmark: DataFrame, id_col: str, text_col: str, block_bytes: int) -> tuple[int, Iterator[list[tuple[str, str]]]]:
    """Different items in blocks of about ``block_bytes`` of text, and how many blocks."""
    items = benchmark.select(F.coalesce(col(id_col).cast("string"), F.lit("null")).alias("k"),
                             F.coalesce(col(text_col), F.lit("")).alias("t")).distinct()
    total = items.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    n = max(1, -(-total // block_bytes))
    blocks = (items if n == 1 else items.filter(F.pmod(F.xxhash64("k", "t"), F.lit(n)) == i) for i in range(n))
    return n, ([(r["k"], r["t"]) for r in block.collect()] for block in blocks)


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES,
                       id_col: str = "item_id", text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Every row of ``docs`` with n_words, n_hit, n_items, items_sha256, contaminated, and spans: the
    merged word ranges to remove (start, stop; array of structs). ``carry``: the input columns to
    keep (default: all)."""
    spark = docs.sparkSession
    columns = carried(docs, carry)
    rows = packed(docs, columns, text_col)
    span = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("stop", T.LongType())]))
    n, blocks = blocks_of(benchmark, id_col, text_col, block_bytes)
    for k, items in enumerate(blocks):
        def score(texts: pa.Array, phrases: Phrases, k: int = k) -> dict[str, pa.Array]:
            return {f"{name}{k}": v for name, v in search_batch(texts, phrases).items()}

        rows = map_texts(rows, k < n - 1 or text_col in columns, {f"n{k}": T.LongType(), f"s{k}": span, f"i{k}": T.ArrayType(T.StringType())},
                         SHARD_BYTES, score, shared(spark, Phrases(items, window)))
    spans, items = [F.col(f"s{i}") for i in range(n)], [F.col(f"i{i}") for i in range(n)]
    if n > 1:
        merged = F.aggregate(F.array_sort(F.concat(*spans)), F.slice(spans[0], 1, 0), lambda done, x: F.when(
            (F.size(done) > 0) & (F.element_at(done, -1)["stop"] >= x["start"]),
            F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(
                F.element_at(done, -1)["start"].alias("start"), F.greatest(F.element_at(done, -1)["stop"], x["stop"]).alias("stop")))))
            .otherwise(F.concat(done, F.array(x))))
    else:
        merged = spans[0]
    rows = rows.select("row", *["t"][:text_col in columns], F.col("n0").alias("n_words"), merged.alias("spans"),
                       F.array_sort(F.array_distinct(F.concat(*items))).alias("items"))
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x["stop"] - x["start"])
    rows = rows.withColumn("n_hit", hit)
    return unpacked(rows, columns, {
        "n_words": F.col("n_words"), "n_hit": F.col("n_hit"), "n_items": F.size("items").cast("long"),
        "items_sha256": F.sha2(F.array_join("items", ","), 256),
        "contaminated": (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")),
        "spans": F.col("spans")}, text_col)


def without_spans(text: Column, spans: Column) -> Column:
    """The text without the words of the spans and what stands before each of them."""
    word = r"[0-9A-Za-z\u0080-\x{10FFFF}]+"
    pieces = F.regexp_extract_all(text, F.lit(rf"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*{word}"), F.lit(0))
    tail = F.regexp_extract(text, r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*\z", 0)
    keep = F.filter(pieces, lambda x, i: ~F.exists(spans, lambda s: (s["start"] <= i) & (i < s["stop"])))
    return F.concat(F.array_join(keep, ""), tail)
