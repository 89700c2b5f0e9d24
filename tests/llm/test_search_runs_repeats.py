"""Periodic runs, lexical search and substring removal against plain statements, and their edge cases."""

import hashlib
import math
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from skilltrends.llm import lexical_search, periodic_runs, substring_dedup

from .brute import SPACED, UPPER

TERM = __import__("re").compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- 11 -------------------------------------------------------------------------------------------

def runs_of(w, least_words=6, powers=4):
    found = {}
    for q in range(1, len(w) // powers + 1):
        i = 0
        while i + q < len(w):
            s = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            if i - s + q >= max(least_words, powers * q):
                found.setdefault((s, i - s + q), q)
            i += 1
    return sorted((s, n, q) for (s, n), q in found.items())


def planted(w, doc_id):
    h = zlib.crc32(str(doc_id).encode())
    n, g = len(w), h // 10
    if doc_id is None or h % 10 or not n:
        return w
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


def judged(text, doc_id=None):
    w = planted(SPACED.findall(text or ""), doc_id)
    runs = runs_of(w)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    top = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    return (len(runs), *((*top, 1000 * top[1] // top[2]) if top else (None,) * 4), sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)),
            sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def digest(r):
    return (r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256, r.collapsed_sha256)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.tuples(st.lists(st.integers(0, 2), max_size=7), st.integers(1, 9)), max_size=8), min_size=1, max_size=5))
def test_runs_of_word_numbers(parts):
    docs = [[x for unit, times in d for x in unit * times] for d in parts]
    at = np.concatenate(([0], np.cumsum([len(d) for d in docs])))
    got = periodic_runs.find_runs(np.array([x for d in docs for x in d], np.int64), at)
    assert [[tuple(r) for r in got[got[:, 0] == k][:, 1:].tolist()] for k in range(len(docs))] == [runs_of(d) for d in docs]


def test_runs_when_pairs_come_in_pieces(monkeypatch):
    monkeypatch.setattr(periodic_runs, "PAIRS", 50)
    rng = random.Random(3)
    for _ in range(20):
        d = [rng.randrange(3) for _ in range(rng.randrange(200))] + [rng.randrange(4) for _ in range(9)] * 7
        got = periodic_runs.find_runs(np.array(d, np.int64), np.array([0, len(d)]))
        assert [tuple(r) for r in got[:, 1:].tolist()] == runs_of(d)


def test_long_repeats_end_in_time():
    n = 200_000
    got = periodic_runs.find_runs(np.zeros(n, np.int64), np.array([0, n]))
    assert got.tolist() == [[0, 0, n, 1]]


ROWS = [(1, "a b " * 200), (1, "a b " * 200), (2, None), (3, ""), (4, " \n\t"), (None, "x " * 20), (None, None), (10, "one two three " * 9 + "end"),
        (11, "é\U0001F600 " * 8), *[(i, " ".join(random.Random(i).choices("abcdefgh", k=90))) for i in range(20, 60)]]


def test_runs_query_rows(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string").select("*", *[F.lit("x").alias(c) for c in ("row", "t", "plant", "period", "N_RUNS")]).repartition(3)
    got = periodic_runs.periodic_runs(docs, plant_by="doc_id")
    assert got.columns[:5] == ["doc_id", "text", "row", "t", "plant"] and "N_RUNS" not in got.columns
    rows = got.collect()
    assert sorted(((r.doc_id, r.text, *digest(r)) for r in rows), key=repr) == sorted(((i, t, *judged(t, i)) for i, t in ROWS), key=repr)
    for r in rows:
        assert [tuple(x) for x in r.runs] == runs_of(planted(SPACED.findall(r.text or ""), r.doc_id))
    plain = periodic_runs.periodic_runs(docs, carry=["doc_id"]).filter("doc_id = 10").first()
    assert (plain.start, plain.length, plain.period) == (0, 27, 3)
    assert periodic_runs.periodic_runs(docs.limit(0)).collect() == []


# --- 12 -------------------------------------------------------------------------------------------

def ranked(docs, items, top=10):
    words = [TERM.findall((t or "").translate(UPPER)) for _, t in docs]
    n, total = sum(map(bool, words)), sum(map(len, words))
    df = {}
    for w in words:
        for t in set(w):
            df[t] = df.get(t, 0) + 1
    out = []
    for item, text in set(items):
        scored = []
        for (doc_id, _), w in zip(docs, words):
            m = 10 + (90 * len(w) * n) // total if total else 0
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1_000_000_000 * w.count(t) // (1000 * w.count(t) + 8 * m))
                    for t in set(TERM.findall((text or "").translate(UPPER))) if t in w)
            if s > 0:
                scored.append((-s, doc_id is None, doc_id))
        for k, (s, _, doc_id) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:top]):
            out.append((item, k + 1, doc_id, -s))
    return sorted(out, key=repr)


def corpus(seed, n=120):
    rng = random.Random(seed)
    vocabulary = [f"w{int(rng.paretovariate(0.7))}" for _ in range(400)] + ["Été", "A9", "a9"]
    docs = [(i, " ".join(rng.choices(vocabulary, k=rng.randrange(1, 60)))) for i in range(n)]
    docs += [(500 + i, docs[3][1]) for i in range(30)] + [(7, docs[7][1]), (None, docs[3][1]), (901, None), (902, ""), (903, " ,.! "), (None, None)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randrange(1, 25)))) for i in range(25)]
    return docs, items + [items[0], (0, "other text A9"), (None, items[4][1]), (77, None), (78, "..."), (79, "absent")]


@pytest.mark.parametrize("block_bytes", [1 << 20, 400])
def test_search_against_plain_scores(spark, block_bytes):
    docs, items = corpus(1)
    d = spark.createDataFrame(docs, "doc_id long, text string").select("*", F.lit(1).alias("score"), F.lit("x").alias("t")).repartition(5)
    i = spark.createDataFrame(items, "item_id long, text string").select("*", F.lit(1).alias("rank"), F.lit("x").alias("block"))
    got = lexical_search.search(d, i, block_bytes=block_bytes)
    assert got.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == ranked(docs, items)
    assert lexical_search.search(d.limit(0), i).collect() == [] and lexical_search.search(d, i.limit(0)).collect() == []


def test_sharing_graph_sums_are_the_items():
    rng = random.Random(5)
    sets = [sorted({f"t{int(rng.paretovariate(0.6))}".encode() for _ in range(rng.randrange(30))}) for _ in range(60)] + [[], [b"only"]]
    graph = lexical_search.SharingGraph(sets)
    value = {t: rng.randrange(1 << 30) for t in graph.terms}
    sums = [value[t] for t in graph.terms] + [0] * len(graph.pairs)
    for node, left, right in graph.levels():
        for n, a, b in zip(node, left, right):
            sums[n] = sums[a] + sums[b]
    assert [sum(sums[n] for n in line) for line in graph.items] == [sum(value[t] for t in s) for s in sets]
    adds = len(graph.pairs) + sum(max(0, len(x) - 1) for x in graph.items)
    assert adds < 0.8 * sum(max(0, len(s) - 1) for s in sets)  # shared sums are made once


def test_impacts_beyond_64_bits():
    tf, size = np.array([1, 3]), np.array([5, 10 ** 9])
    n, total = 10 ** 11, 10 ** 14
    want = [10 ** 9 * t // (1000 * t + 8 * (10 + 90 * s * n // total)) for t, s in ((1, 5), (3, 10 ** 9))]
    assert lexical_search.impacts(tf, size, n, total).tolist() == want


# --- 13 -------------------------------------------------------------------------------------------

def without_repeats(docs, window):
    words = [SPACED.findall(t or "") for _, t in docs]
    first = {}
    for (doc_id, _), w in zip(docs, words):
        if doc_id is not None:
            for i in range(len(w) - window + 1):
                s = tuple(w[i:i + window])
                first[s] = min(first.get(s, doc_id), doc_id)
    out = []
    for (doc_id, _), w in zip(docs, words):
        gone = set()
        for i in range(len(w) - window + 1):
            if doc_id is not None and first[tuple(w[i:i + window])] < doc_id:
                gone |= set(range(i, i + window))
        out.append((doc_id, len(w), len(gone), sha(" ".join(x for i, x in enumerate(w) if i not in gone))))
    return sorted(out, key=repr)


def passages(seed, window):
    rng = random.Random(seed)

    def text(n, k=30):
        return [f"w{rng.randrange(k)}" for _ in range(n)]

    shared = [text(rng.randrange(window - 3, 3 * window)) for _ in range(6)] + [["z"] * (2 * window), ["a", "b"] * window]
    docs = []
    for i in range(80):
        w = text(rng.randrange(0, window))
        for _ in range(rng.randrange(4)):
            p = list(rng.choice(shared))
            if rng.random() < 0.4 and p:
                p[rng.randrange(len(p))] = "edit"
            a = rng.randrange(len(p))
            w += (p[a:] if rng.random() < 0.3 else p) + text(rng.randrange(0, 6))
        docs.append((rng.randrange(70), " ".join(w)))
    docs += [(100 + i, docs[5][1]) for i in range(10)] + [docs[6], docs[6], (None, docs[5][1]), (None, None), (200, None), (201, ""), (202, " \n")]
    return docs


@pytest.mark.parametrize("seed, window, anchor", [(1, 12, 4), (2, 12, 1), (3, 8, 8), (4, 50, 10), (5, 20, 3)])
def test_repeats_against_all_windows(spark, seed, window, anchor):
    docs = passages(seed, window)
    d = spark.createDataFrame(docs, "doc_id long, text string").select("*", *[F.lit("x").alias(c) for c in ("key", "t", "found", "A", "N_words")]).repartition(4)
    got = substring_dedup.remove_repeats(d, window, anchor, with_text=True)
    assert got.columns[:6] == ["doc_id", "text", "key", "t", "found", "A"]
    rows = got.collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in rows), key=repr) == without_repeats(docs, window)
    for r in rows:
        w = SPACED.findall(r.text or "")
        gone = {i for s in r.spans for i in range(s.start, s.stop)}
        assert r.n_removed == len(gone) and r.kept_text == " ".join(x for i, x in enumerate(w) if i not in gone)
        assert all(a.stop < b.start for a, b in zip(r.spans, r.spans[1:]))  # maximal: none touch
    assert substring_dedup.remove_repeats(d.limit(0)).collect() == []
