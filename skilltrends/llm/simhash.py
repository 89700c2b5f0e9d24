"""Operator 9. SimHash near-duplicates by a Gray-order hierarchical index.

1. Fingerprints: 64 bits, each the majority over the XXH64 hashes of all word shingles of a text.
   Texts are hashed in Arrow batches, without a shuffle.
2. Equal fingerprints meet in one partially aggregated row, so a group of copies of any size is
   one node from here on.
3. Fingerprints within d bits agree on at least one of d + 1 bit blocks; each fingerprint goes to
   one cell per block, keyed by the block's value. A cell of more than ``cell_rows`` is cut again
   by the blocks of its other bits, and a cell still too large is tiled: its rows are dealt to
   chunks and every two chunks meet. No rule leaves a pair out.
4. A task sorts its cells by the Gray rank of the fingerprint and builds the index: a leaf holds
   up to 8 neighbours; a node keeps the bits that all below it share (mask, pattern) and hands
   only the rest down. A search adds up the differences on its way down and drops a whole
   group as soon as they exceed d. A group whose rows are all known to belong to the searcher's
   component is dropped too, so a cell of near copies costs no pair for each two of them.
5. A cell passes on a star of each of its components, at most one link a row. Components over
   the whole table come from alternating large-star and small-star rounds on stored tables.

Defined results: null and blank texts have no shingle, fingerprint 0, and link like any other; a
null id is ignored in the smallest id of a component (null if it has no other); repeated rows share
a component; an empty table gives an empty result; input columns named like a result are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import carried, col, map_texts, packed, stored, unpacked

SHINGLE, BITS, SEED, CELL_ROWS, BLOCK_BYTES, LEAF = 3, 3, 42, 50_000, 1 << 20, 8


def fingerprint(text: str | None, n: int = SHINGLE, seed: int = SEED) -> int:
    """64-bit majority fingerprint of one text (unsigned)."""
    import xxhash

    words = (text or "").encode().lower().split()  # bytes: ASCII case and ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(words) > n:
        starts, ends = starts[:len(words) - n + 1], ends[n - 1:]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest, total, k = xxhash.xxh64_intdigest, np.zeros(64, np.int64), len(starts)
    for at in range(0, k, 1 << 16):  # bounded memory however long the text
        pairs = zip(starts[at:at + (1 << 16)].tolist(), ends[at:at + (1 << 16)].tolist())
        hashes = np.array([digest(joined[a:b], seed) for a, b in pairs], dtype="<u8")
        total += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * total > k, bitorder="little").view("<u8")[0])


def with_fingerprints(rows: DataFrame, keep_text: bool, n: int = SHINGLE) -> DataFrame:
    """``rows`` with a column fp: the fingerprint of ``t``, its bits as a signed long."""
    def score(texts: pa.Array, _: None) -> dict[str, pa.Array]:
        return {"fp": pa.array(np.array([fingerprint(t, n) for t in texts.to_pylist()], dtype=np.uint64).view(np.int64))}

    return map_texts(rows, keep_text, {"fp": T.LongType()}, BLOCK_BYTES, score)


# --- the index, inside a task -------------------------------------------------------------------

def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Position of each code word in the reflected Gray sequence."""
    r = codes.copy()
    for s in (1, 2, 4, 8, 16, 32):
        r ^= r >> np.uint64(s)
    return r


class GrayIndex:
    """Index over ``codes``, already sorted by (cell, Gray rank). ``ends``: for each row, the row
    after the last of its cell."""

    def __init__(self, codes: np.ndarray, ends: np.ndarray):
        self.codes, self.ends, self.n = codes, ends, len(codes)
        self.label = np.arange(self.n)
        ones = ~np.uint64(0)
        all_and, all_or = codes, codes
        self.levels: list[tuple[np.ndarray, np.ndarray, int]] = []
        width = 1
        while True:
            cut = np.arange(0, len(all_and), LEAF)
            all_and = np.bitwise_and.reduceat(all_and, cut)
            all_or = np.bitwise_or.reduceat(all_or, cut)
            width *= LEAF
            self.levels.append((~(all_and ^ all_or) & ones, all_and, width))
            if len(cut) == 1:
                break
        # factor: a node keeps only the shared bits that its parent doesn't have already
        for k in range(len(self.levels) - 1):
            mask, pattern, width = self.levels[k]
            above = np.repeat(self.levels[k + 1][0], LEAF)[:len(mask)]
            self.levels[k] = (mask & ~above, pattern, width)

    def union(self, u: np.ndarray, v: np.ndarray) -> None:
        label = self.label
        while True:
            a, b = label[u], label[v]
            differ = a != b
            if not differ.any():
                break
            u, v, a, b = u[differ], v[differ], a[differ], b[differ]
            np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
            while True:
                up = label[label]
                if np.array_equal(up, label):
                    break
                label[:] = up

    def pure(self) -> list[np.ndarray]:
        """For each level the label that all rows of a node share, or -1."""
        low = high = self.label
        out = []
        for _ in self.levels:
            cut = np.arange(0, len(low), LEAF)
            low, high = np.minimum.reduceat(low, cut), np.maximum.reduceat(high, cut)
            out.append(np.where(low == high, low, -1))
        return out

    def link(self, most: int, step: int = 2048) -> None:
        """Join the labels of all rows of a cell that differ in ``most`` bits or fewer."""
        codes, ends = self.codes, self.ends
        for hop in (1, 2):
            i = np.arange(max(0, self.n - hop))
            i = i[i + hop < ends[i]]
            self.union(*(x[np.bitwise_count(codes[i] ^ codes[i + hop]) <= most] for x in (i, i + hop)))
        searchers = np.flatnonzero(np.arange(self.n) + 1 < ends)
        pure = self.pure()
        for at in range(0, len(searchers), step):
            q = searchers[at:at + step]
            node, seen = np.zeros(len(q), np.int64), np.zeros(len(q), np.int64)
            for k in range(len(self.levels) - 1, -1, -1):
                mask, pattern, width = self.levels[k]
                seen = seen + np.bitwise_count((codes[q] ^ pattern[node]) & mask[node])
                keep = (seen <= most) & (node * width < ends[q]) & ((node + 1) * width > q + 1) & (pure[k][node] != self.label[q])
                q, node, seen = q[keep], node[keep], seen[keep]
                below = len(self.levels[k - 1][0]) if k else self.n
                q, seen = np.repeat(q, LEAF), np.repeat(seen, LEAF)
                node = (node[:, None] * LEAF + np.arange(LEAF)).ravel()
                inside = node < below
                q, node, seen = q[inside], node[inside], seen[inside]
            hit = (node > q) & (node < ends[q]) & (np.bitwise_count(codes[q] ^ codes[node]) <= most)
            if hit.any() and (self.label[q[hit]] != self.label[node[hit]]).any():
                self.union(q[hit], node[hit])
                pure = self.pure()


def cell_links(cells: np.ndarray, turned: np.ndarray, codes: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Stars (code, smallest code of its component) over rows with a cell number; ``turned`` are
    the codes with the cell's block in front."""
    order = np.lexsort((gray_rank(turned), cells))
    cells, turned, codes = cells[order], turned[order], codes[order]
    cut = np.flatnonzero(np.concatenate(([True], cells[1:] != cells[:-1], [True])))
    ends = np.repeat(cut[1:], np.diff(cut))
    index = GrayIndex(turned, ends)
    index.link(most)
    root = np.full(len(codes), ~np.uint64(0))
    np.minimum.at(root, index.label, codes)
    root = root[index.label]
    far = root != codes
    return codes[far], root[far]


# --- cells, over the cluster --------------------------------------------------------------------

def blocks(bits: list[int], parts: int) -> list[list[int]]:
    """``bits`` cut into ``parts`` runs of nearly equal length."""
    cut = [round(i * len(bits) / parts) for i in range(parts + 1)]
    return [bits[a:b] for a, b in zip(cut, cut[1:])]


def gather(fp: Column, bits: list[int]) -> Column:
    """The value of a run of adjacent or split bits, as a long."""
    runs, out, at = [], F.lit(0).cast("long"), 0
    for b in bits:
        if runs and runs[-1][-1] == b - 1:
            runs[-1].append(b)
        else:
            runs.append([b])
    for r in runs:
        out = out.bitwiseOR(F.shiftleft(F.shiftrightunsigned(fp, r[0]).bitwiseAND(F.lit((1 << len(r)) - 1)), at))
        at += len(r)
    return out


def cells(nodes: DataFrame, most: int, cell_rows: int) -> DataFrame:
    """(fp, cell string, turn) - each fingerprint once per cell it belongs to. Every two
    fingerprints within ``most`` bits share a cell."""
    parts = blocks(list(range(64)), most + 1)
    first = nodes.select("fp", F.explode(F.array(*[
        F.struct(F.lit(i).alias("b"), gather(F.col("fp"), p).alias("v")) for i, p in enumerate(parts)])).alias("c")
    ).select("fp", "c.b", "c.v")

    def counted(df: DataFrame, key: list[str]) -> tuple[DataFrame, DataFrame]:
        """Rows of small cells, and rows of large ones with the cell's count. The list of large
        cells has at most rows / cell_rows entries."""
        large = stored(df.groupBy(*key).agg(F.count("*").alias("n")).filter(F.col("n") > cell_rows), "cells")
        return df.join(large, key, "left_anti"), df.join(large, key)

    small, large = counted(first, ["b", "v"])
    out = [small.select("fp", F.col("b").alias("turn"), F.concat_ws(":", "b", "v").alias("cell"))]
    if not large.isEmpty():
        second = []
        for i, p in enumerate(parts):
            rest = blocks([b for b in range(64) if b not in p], most + 1)
            second.append(F.when(F.col("b") == i, F.array(*[
                F.struct(F.lit(j).alias("b2"), gather(F.col("fp"), r).alias("v2")) for j, r in enumerate(rest)])))
        deeper = large.drop("n").select("fp", "b", "v", F.explode(F.coalesce(*second)).alias("c")).select("fp", "b", "v", "c.b2", "c.v2")
        key = ["b", "v", "b2", "v2"]
        small2, large2 = counted(deeper, key)
        out.append(small2.select("fp", F.col("b").alias("turn"), F.concat_ws(":", *key).alias("cell")))
        if not large2.isEmpty():
            chunks = F.ceil(2 * F.col("n") / cell_rows)
            mine = F.pmod(F.xxhash64("fp"), chunks)
            tiled = large2.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), chunks - 1)))
            out.append(tiled.select("fp", F.col("b").alias("turn"), F.concat_ws(
                ":", *key, F.least("mine", "other"), F.greatest("mine", "other")).alias("cell")))
    df = out[0]
    for more in out[1:]:
        df = df.unionByName(more)
    return df


def link_fingerprints(nodes: DataFrame, most: int = BITS, cell_rows: int = CELL_ROWS) -> DataFrame:
    """(u, v): links whose components are those of all pairs within ``most`` bits."""
    width = 64 // (most + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(rows: pa.Table) -> Iterator[pa.RecordBatch]:
            cell = rows["cell"].combine_chunks().dictionary_encode().indices.to_numpy()
            codes = rows["fp"].to_numpy().astype(np.int64).view(np.uint64)
            turn = (rows["turn"].to_numpy().astype(np.uint64) * np.uint64(width)) % np.uint64(64)
            # block 0 is the lowest bits: turn right so that the block comes out on top
            by = (turn + np.uint64(width)) % np.uint64(64)
            turned = np.where(by == 0, codes, (codes >> by) | (codes << ((np.uint64(64) - by) % np.uint64(64))))
            u, v = cell_links(cell, turned, codes, most)
            yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], names=["u", "v"])

        held: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= 2 * cell_rows:  # cells come sorted: all but the last are complete
                table = pa.Table.from_batches(held).combine_chunks()
                ids = table["cell"].combine_chunks().dictionary_encode().indices.to_numpy()
                cut = int(np.searchsorted(ids, ids[-1]))  # ids rise with the first appearance
                if cut:
                    yield from out(table.slice(0, cut))
                    table = table.slice(cut)
                held, rows = table.to_batches(), table.num_rows
        if rows:
            yield from out(pa.Table.from_batches(held))

    dealt = cells(nodes, most, cell_rows)
    dealt = dealt.repartition(F.col("cell")).sortWithinPartitions("cell")
    return dealt.mapInArrow(run, "u long, v long").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node that each node of (u, v) reaches; nodes without a link are
    left out. Large-star and small-star in turn until the links stay the same: each round links
    every node to the smallest of its neighbourhood, so the rounds grow with the logarithm of the
    longest chain. The minima are stored before they are joined, so that both sides of the join
    are plain shuffles, which Spark can split where a root is hot."""
    def star(pairs: DataFrame, large: bool) -> DataFrame:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else pairs
        least = stored(both.groupBy("u").agg(F.min("v").alias("m")), "star-min")
        least = least.select("u", F.least("m", "u").alias("m"))
        moved = both.join(least, "u")
        if large:  # neighbours above u go to the smallest of the neighbourhood
            return moved.filter((F.col("v") > F.col("u")) & (F.col("v") != F.col("m"))).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        out = moved.filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        return out.unionByName(least.select("u", F.col("m").alias("v")).filter("u != v")).distinct()

    def mark(pairs: DataFrame) -> tuple:
        return tuple(pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    pairs = stored(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u != v").distinct(), "links")
    before = mark(pairs)
    while before[0]:
        pairs = stored(star(pairs, True), "star")
        pairs = stored(star(pairs, False), "star")
        now = mark(pairs)
        if now == before:
            break
        before = now
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("root"))


def component_table(fps: DataFrame, most: int = BITS, cell_rows: int = CELL_ROWS) -> DataFrame:
    """Stored (fp, root) for every fingerprint of ``fps`` that links to another one."""
    nodes = stored(fps.select("fp").distinct(), "fingerprints")
    return stored(components(link_fingerprints(nodes, most, cell_rows)).select(F.col("node").alias("fp"), "root"), "fp-roots")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, most: int = BITS, cell_rows: int = CELL_ROWS,
                    id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Every row of ``docs`` with fingerprint (16 hex digits) and component_id. ``carry``: the input
    columns to keep (default: all)."""
    columns = carried(docs, carry)
    rows = packed(docs, columns, text_col, id=col(id_col))
    rows = stored(with_fingerprints(rows, text_col in columns, shingle), "simhash")
    roots = component_table(rows, most, cell_rows)
    by_fp = rows.groupBy("fp").agg(F.min("id").alias("least")).join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    ids = by_fp.groupBy("root").agg(F.min("least").alias("component_id"))
    named = stored(by_fp.select("fp", "root").join(ids, "root").select("fp", "component_id"), "fp-components")
    return unpacked(rows.join(named, "fp"), columns, {
        "fingerprint": F.lower(F.lpad(F.hex("fp"), 16, "0")), "component_id": F.col("component_id")}, text_col)


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, most: int = BITS, cell_rows: int = CELL_ROWS,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The columns of ``docs``, one row of each component: the smallest id (nulls last)."""
    rows = packed(docs, docs.columns, text_col, id=col(id_col))
    rows = stored(with_fingerprints(rows, True, shingle).withColumn("uid", F.monotonically_increasing_id()), "simhash")
    keys = rows.select("fp", "id", "uid")
    best = F.min(F.struct(F.isnull("id").alias("no"), "id", "uid"))
    roots = component_table(keys, most, cell_rows)
    by_fp = keys.groupBy("fp").agg(best.alias("best")).join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    kept = stored(by_fp.groupBy("root").agg(F.min("best").alias("best")).select(F.col("best")["uid"].alias("uid")), "kept")
    # as many rows as documents: never a broadcast, at no size
    return unpacked(rows.join(kept.hint("shuffle_merge"), "uid", "left_semi"), docs.columns, {}, text_col)
