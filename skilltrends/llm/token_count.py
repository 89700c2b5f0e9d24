r"""Operator 10. Token counts by rank-synchronous array merging.

The vocabulary of a sentencepiece BPE model with byte fallback gives a table of pairs: two adjacent
pieces whose joined string is a piece, ranked by that piece's score. A text is cut into pre-tokens
before each run of word marks (U+2581, which stands for a space) that follows another character;
no piece holds a mark after another character, so no merge crosses a cut. Each distinct pre-token of a batch is held once, as a run of symbol
numbers in one ragged numpy array. In every round each sequence merges its pair of lowest rank, the
leftmost of equals, all sequences at the same time, until none has a pair left. A surviving symbol
counts one; a character outside the vocabulary counts its UTF-8 bytes.

A round reads every living symbol, which a long sequence can't afford once a merge. So a pre-token of more
than ``LONG`` characters is cut where no piece holds the two characters side by side (no merge crosses
such a place), and a part that is still longer takes its pairs from a heap by (rank, place): the same
merges in the same order, in time near its length.

The model is read through its path, a parameter, on the driver; its table (bounded by the
vocabulary) goes to the tasks as a broadcast. Texts never shuffle.

Defined results: a null or empty text has 0 bytes and 0 tokens; control strings such as ``<s>``
inside a text are ordinary text; null ids and repeated rows are counted row by row; an empty table
gives an empty result; input columns named like a result are replaced.
"""

from __future__ import annotations

import heapq
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import carried, col, map_texts, packed, row_blocks, shared, unpacked
from .words import Table

LIMIT, BLOCK_BYTES, MARK, SYMBOLS, LONG = 4096, 8 << 20, "▁", 1 << 20, 256
NO_RANK = np.iinfo(np.int32).max


class Merges:
    """Piece table of a sentencepiece BPE model, as plain arrays."""

    def __init__(self, model_file: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        pieces = {sp.id_to_piece(i): i for i in range(sp.get_piece_size())
                  if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))}
        if any(MARK in p.lstrip(MARK) for p in pieces):
            raise ValueError("a piece holds a word mark after another character")
        if sp.encode("  a③") != sp.encode("▁▁a③") or not all(sp.is_byte(sp.piece_to_id(f"<0x{b:02X}>")) for b in range(256)):
            raise ValueError("only models with identity normalisation and byte fallback are handled")
        order = sorted(pieces.values(), key=lambda i: (-sp.get_score(i), i))
        rank_of, last = {}, None
        for i in order:  # equal scores share a rank, so that the leftmost wins
            if last is None or sp.get_score(i) != last[0]:
                last = (sp.get_score(i), len(rank_of))
            rank_of[i] = last[1]
        chars = {p: i for p, i in pieces.items() if len(p) == 1}
        self.size = sp.get_piece_size()
        pairs = {}
        for p, i in pieces.items():
            for cut in range(1, len(p)):
                a, b = self.known(p[:cut], pieces), self.known(p[cut:], pieces)
                if a is not None and b is not None:
                    pairs[a << 22 | b] = (rank_of[i], i)
        self.table = Table(np.array(list(pairs), np.int64))
        self.ranks = np.array([*(r for r, _ in pairs.values()), NO_RANK], np.int32)  # the last one: no pair
        self.made = np.array([*(i for _, i in pairs.values()), 0], np.int64)
        self.pair_of = pairs  # the same as a dictionary, for one pair at a time
        side_by_side = {(ord(a), ord(b)) for p in pieces for a, b in zip(p, p[1:])}
        self.neighbours = np.array(sorted(a << 21 | b for a, b in side_by_side), np.int64)
        # characters: number of the piece, or size + code point when it is none
        self.char_points = np.array(sorted(map(ord, chars)), np.int64)
        self.char_ids = np.array([chars[chr(c)] for c in self.char_points.tolist()], np.int64)

    def known(self, p: str, pieces: dict[str, int]) -> int | None:
        """A part of a piece: a piece itself, or one character that is none."""
        return pieces.get(p, self.size + ord(p) if len(p) == 1 else None)

    def symbols(self, points: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.char_points, points), len(self.char_points) - 1)
        return np.where(self.char_points[at] == points, self.char_ids[at], self.size + points)

    def weigh(self, ids: np.ndarray) -> np.ndarray:
        """Tokens of a surviving symbol: one, or the bytes of an unknown character."""
        c = ids - self.size
        return np.where(c < 0, 1, 1 + (c >= 0x80) + (c >= 0x800) + (c >= 0x10000))

    def look(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and result of the pairs (a, b)."""
        at = self.table.find(a << 22 | b)
        return self.ranks[at], self.made[at]

    def count_long(self, sym: list[int]) -> int:
        """Tokens of one long sequence of symbols."""
        n, pair_of = len(sym), self.pair_of
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        rank = [NO_RANK] * n  # of the pair that starts here

        def look(i: int) -> None:
            j = after[i]
            found = pair_of.get(sym[i] << 22 | sym[j]) if j >= 0 else None
            rank[i] = found[0] if found else NO_RANK
            if found:
                heapq.heappush(heap, found[0] << 40 | i)

        heap: list[int] = []
        for i in range(n - 1):
            look(i)
        while heap:
            entry = heapq.heappop(heap)
            i = entry & (1 << 40) - 1
            if rank[i] != entry >> 40:
                continue  # the pair is gone
            j = after[i]
            sym[i] = pair_of[sym[i] << 22 | sym[j]][1]
            sym[j], rank[j] = -1, NO_RANK
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            look(i)
            if before[i] >= 0:
                look(before[i])
        return int(self.weigh(np.array([s for s in sym if s >= 0], np.int64)).sum())

    def count(self, tokens: pa.Array) -> np.ndarray:
        """Tokens of each pre-token (large strings)."""
        lengths = pc.utf8_length(tokens).to_numpy(zero_copy_only=False).astype(np.int64)
        _, offsets, data = tokens.buffers()
        at = np.frombuffer(offsets, np.int64)[tokens.offset:tokens.offset + len(tokens) + 1]
        points = np.frombuffer(bytes(data[int(at[0]):int(at[-1])]).decode().encode("utf-32-le"), "<u4").astype(np.int64)
        sym, seq = self.symbols(points), np.repeat(np.arange(len(lengths)), lengths)
        if (lengths > LONG).any():
            return self.count_cut(points, sym, seq, lengths)
        return self.count_rounds(sym, seq, len(lengths))

    def count_cut(self, points: np.ndarray, sym: np.ndarray, seq: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """As ``count_rounds``; sequences of more than LONG symbols in parts that no merge leaves."""
        edge = np.concatenate(([True], seq[1:] != seq[:-1]))
        both = points[:-1] << 21 | points[1:]
        at = np.minimum(np.searchsorted(self.neighbours, both), len(self.neighbours) - 1)
        edge[1:] |= (self.neighbours[at] != both) & (lengths[seq[1:]] > LONG)
        heads = np.flatnonzero(edge)
        sizes = np.diff(np.concatenate((heads, [len(sym)])))
        counts = np.zeros(len(heads), np.int64)
        for k in np.flatnonzero(sizes > LONG).tolist():
            counts[k] = self.count_long(sym[heads[k]:heads[k] + sizes[k]].tolist())
        short = sizes <= LONG
        inside = np.repeat(short, sizes)
        counts[short] = self.count_rounds(sym[inside], np.repeat(np.arange(int(short.sum())), sizes[short]), int(short.sum()))
        return np.bincount(seq[heads], counts, len(lengths)).astype(np.int64)

    def count_rounds(self, sym: np.ndarray, seq: np.ndarray, n: int) -> np.ndarray:
        """Tokens of ``n`` sequences: the symbols of all, and the sequence of each symbol."""
        total = np.zeros(n, np.int64)
        rank, made = self.pairs(sym, seq)
        while len(sym):
            heads = np.flatnonzero(np.concatenate(([True], seq[1:] != seq[:-1])))
            sizes = np.diff(np.concatenate((heads, [len(seq)])))
            best = np.minimum.reduceat(rank, heads)
            live = best < NO_RANK
            if not live.all():  # finished sequences leave the arrays
                over = np.repeat(~live, sizes)
                total += np.bincount(seq[over], self.weigh(sym[over]), n).astype(np.int64)
                sym, seq, rank, made = sym[~over], seq[~over], rank[~over], made[~over]
                if not len(sym):
                    break
                best, sizes = best[live], sizes[live]
                heads = np.concatenate(([0], np.cumsum(sizes)[:-1]))
            hit = np.flatnonzero(rank == np.repeat(best, sizes))
            hit = hit[np.concatenate(([True], seq[hit][1:] != seq[hit][:-1]))]  # leftmost of each sequence
            sym[hit] = made[hit]
            keep = np.ones(len(sym), bool)
            keep[hit + 1] = False
            place = np.cumsum(keep) - 1
            sym, seq, rank, made = sym[keep], seq[keep], rank[keep], made[keep]
            at = place[hit]
            for i in (at, at[at > 0] - 1):  # only the pairs around the new symbols change
                following = np.minimum(i + 1, len(sym) - 1)
                r, m = self.look(sym[i], sym[following])
                rank[i] = np.where((following > i) & (seq[following] == seq[i]), r, NO_RANK)
                made[i] = m
        return total

    def pairs(self, sym: np.ndarray, seq: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rank, made = np.full(len(sym), NO_RANK, np.int32), np.zeros(len(sym), np.int64)
        if len(sym) > 1:
            r, m = self.look(sym[:-1], sym[1:])
            rank[:-1] = np.where(seq[1:] == seq[:-1], r, NO_RANK)
            made[:-1] = m
        return rank, made

    def count_all(self, tokens: pa.Array) -> np.ndarray:
        """As ``count``, in parts of a bounded number of symbols (or one longer pre-token)."""
        sizes = pc.binary_length(tokens).to_numpy(zero_copy_only=False).tolist()
        return np.concatenate([np.zeros(0, np.int64), *[self.count(tokens.slice(a, b - a)) for a, b in row_blocks(sizes, SYMBOLS)]])


def count_batch(texts: pa.Array, merges: Merges) -> np.ndarray:
    """Tokens of each text."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    total = np.zeros(len(texts), np.int64)
    # texts of words between single spaces go through Arrow, the others word by word
    plain = pc.invert(pc.match_substring_regex(texts, f"^ | $|  |{MARK}|^$")).to_numpy(zero_copy_only=False)
    rows = np.flatnonzero(plain)
    words, owner = [], []
    if len(rows):
        lists = pc.split_pattern(texts.take(pa.array(rows)), " ")
        words.append(pc.binary_join_element_wise(pa.scalar(MARK, pa.large_string()), lists.flatten(), pa.scalar("", pa.large_string())))
        owner.append(np.repeat(rows, np.diff(lists.offsets.to_numpy())))
    other = [(i, re.findall(f"{MARK}+[^{MARK}]*", MARK + t.replace(" ", MARK)))
             for i in np.flatnonzero(~plain).tolist() if (t := texts[i].as_py())]
    words.append(pa.array([w for _, ws in other for w in ws], pa.large_string()))
    owner.append(np.repeat(np.array([i for i, _ in other], np.int64), [len(ws) for _, ws in other]))
    coded = pa.concat_arrays(words).dictionary_encode()
    if len(coded):
        counts = merges.count_all(coded.dictionary)[coded.indices.to_numpy(zero_copy_only=False)]
        total += np.bincount(np.concatenate(owner), counts, len(texts)).astype(np.int64)
    return total


def count_tokens(docs: DataFrame, model_file: str, limit: int = LIMIT, text_col: str = "text",
                 carry: list[str] | None = None) -> DataFrame:
    """Every row of ``docs`` with n_bytes, n_tokens, over_limit. ``carry``: the input columns to keep
    (default: all)."""
    def score(texts: pa.Array, merges: Merges) -> dict[str, pa.Array]:
        return {"n": pa.array(count_batch(texts, merges))}

    columns = carried(docs, carry)
    rows = packed(docs, columns, text_col, b=F.coalesce(F.octet_length(col(text_col)), F.lit(0)).cast("long"))
    rows = map_texts(rows, text_col in columns, {"n": T.LongType()}, BLOCK_BYTES, score, shared(docs.sparkSession, Merges(model_file)))
    return unpacked(rows, columns, {"n_bytes": F.col("b"), "n_tokens": F.col("n"), "over_limit": F.col("n") > limit}, text_col)
