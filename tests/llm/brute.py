"""Plain statements of the contracts, one text or row at a time."""

import re
import zlib

import xxhash

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def metrics(text):
    text = text or ""
    w = SPACED.findall(text)
    lines = [x for x in text.split("\n") if SPACED.search(x)]
    places = {}
    for i in range(len(w) - 2):
        places.setdefault(tuple(w[i:i + 3]), []).append(i)
    covered = {i + k for at in places.values() if len(at) > 1 for i in at for k in range(3)}
    return {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered),
            "base_failed": len(w) < 50 or 100 * len(covered) > 50 * len(w)}


def fingerprint(text, n=3):
    w = SPACED.findall((text or "").translate(UPPER))
    if not w:
        return 0
    shingles = [" ".join(w[i:i + n]) for i in range(len(w) - n + 1)] or [" ".join(w)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(codes, most=3):
    """Smallest position that each position reaches."""
    root = list(range(len(codes)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, a in enumerate(codes):
        for j in range(i):
            if (a ^ codes[j]).bit_count() <= most:
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(codes))]


def contamination(text, items, window=13):
    """(words, hit words, sorted names of the items found)."""
    def words(t):
        return PLAIN.findall((t or "").translate(UPPER))

    phrases = {}
    for name, t in items:
        x = words(t)
        k = min(window, len(x))
        for i in range(len(x) - k + 1 if x else 0):
            phrases.setdefault(tuple(x[i:i + k]), set()).add(name)
    w, hit, names = words(text), set(), set()
    for k in {len(p) for p in phrases}:
        for i in range(len(w) - k + 1):
            if found := phrases.get(tuple(w[i:i + k])):
                hit |= set(range(i, i + k))
                names |= found
    return len(w), len(hit), sorted(names)


def fold(doc_id, n):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % n
