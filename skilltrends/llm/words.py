"""Words of Arrow text arrays, by byte tables in numpy."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def byte_table(inside: list[int], lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """(is a word's byte, byte to keep) for each byte value."""
    word, keep = np.zeros(256, bool), np.arange(256, dtype=np.uint8)
    word[inside] = True
    if lower:
        keep[0x41:0x5B] += 32
    return word, keep


#: Letters and digits of ASCII (lower-cased) and every byte of the characters from U+0080 on.
ALNUM = byte_table([*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)], lower=True)
#: All but ASCII white space, unchanged.
NON_SPACE = byte_table([b for b in range(256) if b not in (9, 10, 11, 12, 13, 32)], lower=False)


def raw_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row (null: none), and where each text starts."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8)[at[0]:at[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, at - at[0]


def words_of(texts: pa.Array, table: tuple[np.ndarray, np.ndarray]) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """All words of all texts in a row (a binary array), where each text's words start (one more
    entry than texts), and each word's first byte and the byte after it, within its text."""
    raw, at = raw_of(texts)
    if not len(raw):
        none = np.zeros(0, np.int64)
        return pa.array([], pa.large_binary()), np.zeros(len(texts) + 1, np.int64), none, none
    word = table[0][raw]
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1]
    last[:-1] &= ~word[1:]
    edges = at[(at > 0) & (at < len(raw))]  # a text's end ends its last word
    first[edges] = word[edges]
    last[edges - 1] = word[edges - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    stops = np.concatenate(([0], np.cumsum(ends - starts)))
    out = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(stops), pa.py_buffer(table[1][raw[word]])])
    rows = np.searchsorted(starts, at)
    base = np.repeat(at[:-1], np.diff(rows))
    return out, rows, starts - base, ends - base


#: Class of each byte for tokens: 0 ASCII white space, 1 word, 2 other.
CLASS = np.where(NON_SPACE[0], np.where(ALNUM[0], 1, 2), 0).astype(np.uint8)
CLASS[ord("_")] = 1
POWERS = np.cumprod(np.concatenate(([1], np.full(4095, 0x9E3779B97F4A7C15, np.uint64))).astype(np.uint64))


def run_hashes(values: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte runs that start at ``heads`` (none of them empty)."""
    if not len(heads):
        return np.zeros(0, np.uint64)
    place = np.arange(len(values)) - np.repeat(heads, np.diff(np.concatenate((heads, [len(values)]))))
    return np.add.reduceat((values.astype(np.uint64) + np.uint64(1)) * POWERS[place & 4095], heads)


def hash_words(words: pa.Array) -> np.ndarray:
    """64-bit hashes of non-empty words (large binary)."""
    if not len(words):
        return np.zeros(0, np.uint64)
    _, offsets, data = words.buffers()
    at = np.frombuffer(offsets, np.int64)[words.offset:words.offset + len(words) + 1]
    return run_hashes(np.frombuffer(data, np.uint8)[at[0]:at[-1]], at[:-1] - at[0])


def prefix_hashes(words: pa.Array, lengths: list[int]) -> np.ndarray:
    """64-bit hashes of the prefixes of so many characters of each word, or 0 where the word isn't
    longer. One row per word, one column per length."""
    out = np.zeros((len(words), len(lengths)), np.uint64)
    if not len(words):
        return out
    _, offsets, data = words.buffers()
    at = np.frombuffer(offsets, np.int64)[words.offset:words.offset + len(words) + 1]
    raw = np.frombuffer(data, np.uint8)[at[0]:at[-1]]
    at = at - at[0]
    place = np.arange(len(raw)) - np.repeat(at[:-1], np.diff(at))
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * POWERS[place & 4095])))
    chars = np.append(np.flatnonzero((raw & 0xC0) != 0x80), len(raw))
    first = np.searchsorted(chars, at)
    for k, n in enumerate(lengths):
        longer = first[:-1] + n < first[1:]
        end = chars[first[:-1][longer] + n]
        out[longer, k] = total[end] - total[at[:-1][longer]]
    return out


def token_hashes(texts: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all tokens (runs of one class) of all texts in a row, and where each text's
    tokens start."""
    raw, at = raw_of(texts)
    kind = CLASS[raw]
    first = np.concatenate(([True], kind[1:] != kind[:-1]))[:len(kind)]
    first[at[(at > 0) & (at < len(raw))]] = True
    heads = np.flatnonzero(first)
    if not len(heads):
        return np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    hashes = run_hashes((ALNUM[1] if lower else NON_SPACE[1])[raw], heads)
    token = kind[heads] > 0
    return hashes[token], np.searchsorted(heads[token], at)


def spread_bits(h: np.ndarray, bits: int) -> np.ndarray:
    """A 64-bit hash to ``bits`` bits by multiplication."""
    h = h ^ (h >> np.uint64(29))
    return ((h * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - bits)).astype(np.int64)


class Table:
    """Numbers of distinct 64-bit keys, by open addressing."""

    def __init__(self, keys: np.ndarray):
        self.bits = max(4, int(len(keys) * 4 - 1).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.numbers = np.full(1 << self.bits, -1, np.int64)
        left, slot = np.arange(len(keys)), spread_bits(keys.astype(np.uint64), self.bits)
        while len(left):
            won = np.zeros(len(left), bool)
            won[np.unique(slot, return_index=True)[1]] = True
            won &= self.numbers[slot] < 0
            self.keys[slot[won]], self.numbers[slot[won]] = keys[left[won]], left[won]
            left, slot = left[~won], (slot[~won] + 1) & ((1 << self.bits) - 1)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key, or -1."""
        slot = spread_bits(keys.astype(np.uint64), self.bits)
        there = self.keys[slot]
        out = np.where(there == keys, self.numbers[slot], -1)
        left = np.flatnonzero((there != keys) & (there >= 0))
        while len(left):
            slot[left] = (slot[left] + 1) & ((1 << self.bits) - 1)
            there = self.keys[slot[left]]
            hit = there == keys[left]
            out[left[hit]] = self.numbers[slot[left[hit]]]
            left = left[~hit & (there >= 0)]
        return out


def distinct(keys: np.ndarray) -> np.ndarray:
    """Sorted distinct values."""
    keys = np.sort(keys)
    return keys[np.concatenate(([True], keys[1:] != keys[:-1]))[:len(keys)]]


def coded(words: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Numbers of the words, and the distinct words."""
    d = words.dictionary_encode()
    return d.indices.to_numpy(zero_copy_only=False).astype(np.int64), d.dictionary


def joined(words: pa.Array, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all words (large binary, text r has at[r]..at[r+1]), each followed by one space,
    and where each text's bytes start."""
    if not len(words):
        return np.zeros(0, np.uint8), np.zeros(len(at), np.int64)
    _, offsets, data = words.buffers()
    ends = np.frombuffer(offsets, np.int64)[words.offset:words.offset + len(words) + 1]
    out = np.full(int(ends[-1] - ends[0]) + len(words), 32, np.uint8)
    inside = np.ones(len(out), bool)
    inside[ends[1:] - ends[0] + np.arange(len(words))] = False
    out[inside] = np.frombuffer(data, np.uint8)[ends[0]:ends[-1]]
    return out, ends[at] - ends[0] + at


def ranges(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges low..high-1, and the range that each belongs to."""
    count = high - low
    which = np.repeat(np.arange(len(low)), count)
    return low[which] + np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count), which
