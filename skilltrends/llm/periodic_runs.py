r"""Operator 11. Periodic runs of words, by longest common extensions over a difference cover.

A run is a stretch of consecutive words with smallest period q (words q apart are identical), of
``max(least_words, least_powers * q)`` words or more, that no neighbouring word extends.

The texts of a block become one sequence of word numbers, each text closed by a separator of its own.
Only the suffixes at positions of a difference cover modulo 31 (6 of 31) are sorted: by their first 31
words, three a key, then by doubling, and only where still tied. The longest common extension of two
positions compares at most 30 words, until both reach sampled positions, and takes the rest as a range
minimum from a sparse table. A second index over the reversed sequence extends to the left.

For each period q a grid finds the runs: a run of ``least`` words has, in every ``least - q`` positions,
one position i with i and i + q inside; so every (least - q)-th position is tried, n / q at most for a
period, n log n for a text. A stretch found by several periods has the smallest of them.

Every text is judged by itself, so nothing shuffles: a task holds ``BLOCK_BYTES`` of text or one longer
text, and pairs of the grid in pieces of ``PAIRS``.

Defined results: a null or wordless text has no runs, digests of the empty string and nulls for the
longest run; a null id plants nothing (``planted``); repeated rows are judged row by row; an empty table
gives an empty result; input columns named like a result are replaced.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import carried, col, map_texts, packed, unpacked
from .words import NON_SPACE, coded, joined, words_of

LEAST_WORDS, LEAST_POWERS, BLOCK_BYTES, PAIRS = 6, 4, 2 << 20, 1 << 19
#: A perfect difference set: every residue modulo 31 is a difference of two members.
MODULUS, COVER = 31, np.array([0, 1, 3, 8, 12, 18])
CLASS = np.full(MODULUS, -1)
CLASS[COVER] = np.arange(len(COVER))


def _shifts() -> np.ndarray:
    """For two residues the fewest words until both positions are sampled."""
    out = np.empty((MODULUS, MODULUS), np.int64)
    for a in range(MODULUS):
        for b in range(MODULUS):
            out[a, b] = next(d for d in range(MODULUS) if CLASS[(a + d) % MODULUS] >= 0 and CLASS[(b + d) % MODULUS] >= 0)
    return out


SHIFTS = _shifts()


class Extensions:
    """Longest common extensions to the right in a sequence of word numbers, in which each text ends
    with a number that stands nowhere else."""

    def __init__(self, ids: np.ndarray):
        n, self.ids = len(ids), ids
        blocks = n // MODULUS + 1
        self.at = (np.arange(blocks)[:, None] * MODULUS + COVER).ravel()
        self.at = self.at[self.at < n]
        levels = self._sort(n)
        before, after = self.order[:-1], self.order[1:]
        i, j = self.at[before], self.at[after]
        length = np.zeros(len(i), np.int64)
        for k in range(len(levels) - 1, -1, -1):
            same = np.flatnonzero(levels[k][self._sample(i + length)] == levels[k][self._sample(j + length)])
            length[same] += MODULUS << k
        active = np.arange(len(i))
        while len(active):  # fewer than 31 words are left
            active = active[ids[i[active] + length[active]] == ids[j[active] + length[active]]]
            length[active] += 1
        self.table = [length]
        while 2 << len(self.table) - 1 <= len(length):
            low, half = self.table[-1], 1 << len(self.table) - 1
            self.table.append(np.minimum(low[:-half], low[half:]))

    def _sample(self, position: np.ndarray) -> np.ndarray:
        """The number of the sampled suffix at a position of the cover."""
        return position // MODULUS * len(COVER) + CLASS[position % MODULUS]

    def _sort(self, n: int) -> list[np.ndarray]:
        """Ranks and order of the sampled suffixes; their ranks by 31, 62, 124, ... words."""
        base = int(self.ids.max(initial=0)) + 2
        padded = np.concatenate((self.ids + 1, np.zeros(MODULUS + 2, np.int64)))
        per_key = 3 if base < 1 << 20 else 1
        m = len(self.at)
        order, rank, tied = np.arange(m), np.zeros(m, np.int64), np.arange(m)  # tied: slots of the order

        def refine(key: np.ndarray) -> None:
            """Sort the tied slots again, by (rank, key), and keep those still tied."""
            nonlocal tied
            part = order[tied]
            by = np.lexsort((key, rank[part]))
            part, key = part[by], key[by]
            order[tied] = part
            new = np.concatenate(([True], (key[1:] != key[:-1]) | (rank[part][1:] != rank[part][:-1])))[:len(part)]
            rank[part] = tied[np.maximum.accumulate(np.where(new, np.arange(len(part)), 0))]
            tied = tied[~(new & np.concatenate((new[1:], [True])))]

        for first in range(0, MODULUS, per_key):
            if not len(tied):
                break
            at, key = self.at[order[tied]] + first, 0
            for k in range(min(per_key, MODULUS - first)):
                key = key * base + padded[at + k]
            refine(key)
        levels, words = [rank.copy()], MODULUS
        while len(tied):
            refine(rank[self._sample(self.at[order[tied]] + words)])  # tied: no text has ended yet
            levels.append(rank.copy())
            words *= 2
        self.order, self.rank = order, rank
        return levels

    def length(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words from i on equal those from j on (i and j differ)."""
        shift, out = SHIFTS[i % MODULUS, j % MODULUS], np.zeros(len(i), np.int64)
        active = np.arange(len(i))
        step, rest = 0, []
        while len(active):
            arrived = shift[active] == step
            rest.append(active[arrived])
            active = active[~arrived]
            active = active[self.ids[i[active] + step] == self.ids[j[active] + step]]
            step += 1
            out[active] = step
        rest = np.concatenate(rest) if rest else active
        a = self.rank[self._sample(i[rest] + shift[rest])]
        b = self.rank[self._sample(j[rest] + shift[rest])]
        low, high = np.minimum(a, b), np.maximum(a, b)
        level = np.frexp((high - low).astype(float))[1] - 1
        for k in np.unique(level):
            at = level == k
            out[rest[at]] += np.minimum(self.table[k][low[at]], self.table[k][high[at] - (1 << k)])
        return out


def grid(sizes: np.ndarray, least_words: int, least_powers: int, most: int):
    """(text, period, first position) of all points to try, in pieces of about ``most`` (one period's
    points stay together)."""
    by = np.argsort(-sizes, kind="stable")
    ordered = -sizes[by]
    longest = int(sizes.max(initial=0))
    if longest < max(least_words, least_powers):
        return
    periods = np.arange(1, longest // least_powers + 1)
    least = np.maximum(least_words, least_powers * periods)
    texts = np.searchsorted(ordered, -least, "right")  # texts long enough, the longest first
    points = np.concatenate(([0], np.cumsum(-ordered)))[texts] // (least - periods) + texts  # or fewer
    piece = np.cumsum(points) // most
    cuts = np.flatnonzero(np.concatenate(([True], piece[1:] != piece[:-1], [True])))
    for a, b in zip(cuts[:-1], cuts[1:]):
        q = np.repeat(periods[a:b], texts[a:b])
        step = np.repeat((least - periods)[a:b], texts[a:b])
        text = by[np.arange(len(q)) - np.repeat(np.cumsum(texts[a:b]) - texts[a:b], texts[a:b])]
        count = (sizes[text] - q - 1) // step + 1
        which = np.repeat(np.arange(len(q)), count)
        place = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
        yield text[which], q[which], place * step[which]


def find_runs(ids: np.ndarray, at: np.ndarray, least_words: int = LEAST_WORDS, least_powers: int = LEAST_POWERS) -> np.ndarray:
    """All runs of the texts (word numbers ``ids`` from 0; text r has at[r]..at[r+1]): rows of (text,
    start, length, period), by text, start and period."""
    texts, n = len(at) - 1, len(ids)
    sizes = np.diff(at)
    inside = np.ones(n + texts, bool)
    starts = at[:-1] + np.arange(texts)
    inside[at[1:] + np.arange(texts)] = False
    line = np.empty(n + texts, np.int64)
    line[inside] = ids
    line[~inside] = int(ids.max(initial=0)) + 1 + np.arange(texts)
    none = np.zeros((0, 4), np.int64)
    pending: list[tuple] = []
    found: list[np.ndarray] = []
    index: list[Extensions] = []

    def extend() -> None:
        if not pending:
            return
        text, q, i = (np.concatenate([p[k] for p in pending]) for k in range(3))
        pending.clear()
        if not index:
            back = np.concatenate((line[:-1][::-1], line[-1:]))  # the last text's end ends the reversed line too
            index.extend((Extensions(line), Extensions(back)))
        right = index[0].length(i, i + q)
        last = len(line) - 2
        left = np.zeros(len(i), np.int64)
        inner = i > starts[text]
        left[inner] = index[1].length(last - i[inner] + 1, last - i[inner] - q[inner] + 1)
        length = left + right + q
        long = length >= np.maximum(least_words, least_powers * q)
        rows = np.stack([text, i - left - starts[text], length, q], 1)[long]
        if len(rows):
            found.append(np.unique(rows, axis=0))

    waiting = 0
    for text, q, place in grid(sizes, least_words, least_powers, PAIRS):
        i = starts[text] + place
        same = line[i] == line[i + q]
        if same.any():
            pending.append((text[same], q[same], i[same]))
            waiting += len(pending[-1][0])
        if waiting >= PAIRS:
            extend()
            waiting = 0
    extend()
    if not found:
        return none
    rows = np.unique(np.concatenate(found), axis=0)  # by text, start, length, period: the smallest period first
    return rows[np.concatenate(([True], (rows[1:, :3] != rows[:-1, :3]).any(1)))]


def planted(ids: np.ndarray, at: np.ndarray, doc_ids: list) -> np.ndarray:
    """The word numbers after the periods that the contract plants: with h = crc32 of the decimal id and
    g = h div 10, where h mod 10 is 0 the words from a = g mod n on repeat the p words there,
    p = 1 + (n - a) div (3 + g mod 8)."""
    out = ids.copy()
    for r, doc_id in enumerate(doc_ids):
        n = int(at[r + 1] - at[r])
        h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            out[at[r] + a:at[r + 1]] = ids[at[r] + a + np.arange(n - a) % p]
    return out


RUN = T.StructType([T.StructField(k, T.LongType()) for k in ("start", "length", "period")])
RESULTS = {"n_runs": T.LongType(), "start": T.LongType(), "length": T.LongType(), "period": T.LongType(),
           "exponent_milli": T.LongType(), "runs_sha256": T.StringType(), "collapsed_sha256": T.StringType(), "runs": T.ArrayType(RUN)}


def judge(texts: pa.Array, doc_ids: list | None, least_words: int, least_powers: int) -> dict[str, pa.Array]:
    words, at, _, _ = words_of(texts, NON_SPACE)
    ids, vocabulary = coded(words)
    if doc_ids is not None:
        ids = planted(ids, at, doc_ids)
    runs = find_runs(ids, at, least_words, least_powers)
    run_at = np.searchsorted(runs[:, 0], np.arange(len(texts) + 1))
    depth = np.zeros(len(ids) + 1, np.int64)
    np.add.at(depth, at[runs[:, 0]] + runs[:, 1] + runs[:, 3], 1)
    np.add.at(depth, at[runs[:, 0]] + runs[:, 1] + runs[:, 2], -1)
    kept = np.cumsum(depth)[:-1] == 0
    places = np.flatnonzero(kept)
    kept_at = np.searchsorted(places, at)
    spaced, from_byte = joined(vocabulary.take(pa.array(ids[places])), kept_at)
    best, digests, collapsed = [], [], []
    for r in range(len(texts)):
        mine = runs[run_at[r]:run_at[r + 1], 1:]
        if len(mine):
            s, n, q = (int(x) for x in mine[np.lexsort((mine[:, 2], mine[:, 0], -mine[:, 1]))[0]])
            best.append((s, n, q, 1000 * n // q))
        else:
            best.append((None,) * 4)
        digests.append(hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in mine.tolist()).encode()).hexdigest())
        collapsed.append(hashlib.sha256(spaced[from_byte[r]:from_byte[r + 1]][:-1]).hexdigest())
    listed = pa.ListArray.from_arrays(pa.array(run_at, pa.int32()), pa.StructArray.from_arrays(
        [pa.array(np.ascontiguousarray(runs[:, k])) for k in (1, 2, 3)], names=["start", "length", "period"]))
    top = {k: pa.array([b[i] for b in best], pa.int64()) for i, k in enumerate(("start", "length", "period", "exponent_milli"))}
    return {"n_runs": pa.array(np.diff(run_at).astype(np.int64)), **top, "runs_sha256": pa.array(digests, pa.string()),
            "collapsed_sha256": pa.array(collapsed, pa.string()), "runs": listed}


def periodic_runs(docs: DataFrame, least_words: int = LEAST_WORDS, least_powers: int = LEAST_POWERS, text_col: str = "text",
                  plant_by: str | None = None, carry: list[str] | None = None) -> DataFrame:
    """Every row of ``docs`` with its runs: n_runs, the longest one (start, length, period,
    exponent_milli; null where there is none), runs_sha256 over all of them, collapsed_sha256 over the
    words outside every run's repeats, and ``runs`` (start, length, period) by start and period.

    ``plant_by``: an id column whose rows get the contract's planted periods first. ``carry``: the input
    columns to keep (default: all)."""
    columns = carried(docs, carry)
    extra = {} if plant_by is None else {"plant": col(plant_by).cast("string")}
    rows = packed(docs, columns, text_col, **extra)
    if plant_by is None:
        out = map_texts(rows, text_col in columns, RESULTS, BLOCK_BYTES, lambda texts, _: judge(texts, None, least_words, least_powers))
    else:
        out = map_texts(rows, text_col in columns, RESULTS, BLOCK_BYTES,
                        lambda texts, _, ids: judge(texts, ids.to_pylist(), least_words, least_powers), beside="plant")
    return unpacked(out, columns, {k: F.col(k) for k in RESULTS}, text_col)
