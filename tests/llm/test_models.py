"""Held-out accuracy of the trained operators, and their parts against direct statements."""

import itertools
import math

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from skilltrends.llm import langid, quality_model, toxicity
from skilltrends.llm.common import read
from skilltrends.llm.queries import QUERIES

from . import brute

SF = "/root/testdata/sf0.01"
MODEL = public_tokenizers.path("piece_bpe_32k.model")


def test_forward_pass_sums_all_segmentations():
    pieces = ["▁", "a", "b", "ab", "ba", "aba", "▁a", "bb"]
    p = np.random.default_rng(0).random(len(pieces))
    scaled = np.append(p * langid.SCALE ** np.array([len(x) for x in pieces]), 1.0)[:, None]
    of = dict(zip(pieces, p))
    for word in ("", "a", "ab", "abab", "babba", "aabba"):
        w, total = "▁" + word, 0.0
        for cuts in itertools.product([0, 1], repeat=len(w) - 1):
            parts, at = [], 0
            for i, c in enumerate((*cuts, 1), 1):
                if c:
                    parts.append(w[at:i])
                    at = i
            total += math.prod(of.get(x, 0.0) for x in parts)
        got = langid.Lattice(langid.Trie(pieces), pa.array([word], pa.large_string())).log_words(scaled)
        assert got[0, 0] == pytest.approx(math.log(total))


def test_expected_counts_add_up_to_the_characters():
    pieces = ["▁", "a", "b", "ab", "ba", "aba"]
    sizes = np.array([len(x) for x in pieces] + [1.0])
    scaled = langid.scaled(np.ones(len(pieces)), sizes[:-1])
    words = ["abab", "b", "aXb", "ab" * 40]
    lattice = langid.Lattice(langid.Trie(pieces), pa.array(words, pa.large_string()))
    used = lattice.expected(scaled, np.array([1.0, 2.0, 3.0, 1.0]))
    assert used @ sizes == pytest.approx(5 + 2 * 2 + 3 * 4 + 81)


def test_long_words_are_summed_whole():
    pieces = ["▁", "a", "b", "ab", "ba", "aba", "bb"]
    p = np.random.default_rng(3).random(len(pieces)) / 50
    sizes = np.array([len(x) for x in pieces], float)
    scaled = np.append(p * langid.SCALE ** sizes, 1.0)[:, None]
    words = ["ab" * 16 + "ba", "abba" * 900, "ab"]
    log, of = [], dict(zip(pieces, np.log(p)))
    for word in words:
        w = "▁" + word
        alpha = [0.0]
        for i in range(1, len(w) + 1):
            alpha.append(np.logaddexp.reduce([alpha[j] + of[w[j:i]] for j in range(max(0, i - 3), i) if w[j:i] in of]))
        log.append(alpha[-1])
    trie, got, used = langid.Trie(pieces), np.zeros(len(words)), 0.0
    for k, x in langid.lattices(trie, pa.array(words)):
        got[k] = x.log_words(scaled)[:, 0]
        used += x.expected(scaled, np.ones(len(k)))[:-1] @ sizes
    assert got == pytest.approx(np.array(log))
    assert used == pytest.approx(sum(len(w) + 1 for w in words))


def test_any_number_of_languages(spark):
    rows = [(n * 8 + i, f"{chr(97 + n % 26)}{chr(97 + n // 26)}q " * 20, f"l{n:03d}") for n in range(150) for i in range(8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    out = langid.identify(docs, MODEL).collect()
    assert len(out) == len(rows) and sum(r["lang_pred"] == r["lang"] for r in out) > 0.95 * len(rows)


def test_blocks_of_languages_score_as_one():
    pieces = ["▁", "a", "b", "ab", "ba", "aba"]
    trie, rng = langid.Trie(pieces), np.random.default_rng(2)
    p, names = rng.random((len(pieces) + 1, 7)), [f"l{i}" for i in range(7)]
    p[:, 4] = p[:, 1]  # a tie goes to the first name
    texts = pa.array(["ab ba", "aba b", "", None, "bbb aab"])
    blocks = lambda n: [langid.Model(trie, names[a:a + n], p[:, a:a + n]) for a in range(0, 7, n)]
    one, got = langid.score_texts(texts, blocks(7)), langid.score_texts(texts, blocks(2))
    assert got[0] == one[0] and got[1] == pytest.approx(one[1])


def test_language_of_held_out_documents(spark):
    langs = {r["doc_id"]: r["lang"] for r in read(spark, SF, "documents").select("doc_id", "lang").collect()}
    rows = QUERIES["op4_language_id"](spark, SF).collect()
    assert len(rows) == len(langs) and all(0 <= r["score"] <= 1 for r in rows)
    assert all(r["held_out"] == (brute.fold(r["doc_id"], 5) == 0) for r in rows)
    held = [r["lang_pred"] == langs[r["doc_id"]] for r in rows if r["held_out"]]
    assert sum(held) / len(held) > 0.97


@pytest.mark.parametrize("query, label, folds, rest, least", [("op6_quality_classifier", "quality", 4, 2, 0.9), ("op8_toxicity", "toxic", 3, 1, 0.9)])
def test_held_out_labels(spark, query, label, folds, rest, least):
    labels = {r["doc_id"]: r[label] for r in read(spark, SF, "labels").collect()}
    rows = QUERIES[query](spark, SF).collect()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in rows)
    assert all(r["held_out"] == (brute.fold(r["doc_id"], folds) == rest) for r in rows)
    held = [(r["predicted"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert sum(a == b for a, b in held) / len(held) > least


def test_held_out_labels_are_not_learned(spark):
    docs, labels = read(spark, SF, "documents"), read(spark, SF, "labels")
    flipped = labels.selectExpr("doc_id", "CASE WHEN crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 4 = 2 THEN 1 - quality ELSE quality END AS quality")
    one, two = ({r["doc_id"]: r["score"] for r in quality_model.score_quality(docs, x).collect()} for x in (labels, flipped))
    assert one == two


def test_dual_descent_separates():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(80, 6))
    y = np.where(x @ np.array([1, -2, 0.5, 0, 0, 1]) > 0, 1.0, -1.0)
    w, b = quality_model.descend([(np.arange(6), r) for r in x], y, 6, cost=100.0, epochs=200)
    assert (np.sign(x @ w + b) == y).mean() > 0.97


def test_marginals_of_a_chain():
    rng = np.random.default_rng(1)
    u, t = rng.normal(size=5), rng.normal(size=(2, 2))
    head = np.array([True, False, False, True, False])
    z, p, pairs = 0.0, np.zeros(5), np.zeros((2, 2))
    for states in itertools.product([0, 1], repeat=5):
        moves = [(0, 1), (1, 2), (3, 4)]
        w = math.exp(sum(u[i] * s for i, s in enumerate(states)) + sum(t[states[a], states[b]] for a, b in moves))
        z += w
        p += w * np.array(states)
        for a, b in moves:
            pairs[states[a], states[b]] += w
    got, moved = toxicity.Chains(head).marginals(u, t)
    assert got == pytest.approx(p / z) and moved == pytest.approx(pairs / z)


def test_toxic_spans_are_offsets_of_the_words(spark):
    docs = read(spark, SF, "documents").select("doc_id", "text")
    rows = toxicity.score_toxicity(docs, read(spark, SF, "labels")).filter("predicted = 1").collect()
    assert rows
    words = [r["text"].encode()[s["start"]:s["stop"]].decode().lower() for r in rows for s in r["spans"]]
    assert any(w.startswith(("idiot", "moron", "stupid", "pathetic", "trash")) for w in words)


def test_long_chains_in_pieces_give_the_marginals_of_the_whole(monkeypatch):
    rng = np.random.default_rng(8)
    head = rng.random(400) < 0.02
    head[0] = True
    u, t = rng.normal(0, 2, 400), rng.normal(0, 1.5, (2, 2))
    want = toxicity.Chains(head).marginals(u, t)  # pieces of 200
    for piece in (1, 2, 3, 7, 10_000):
        monkeypatch.setattr(toxicity, "PIECE", piece)
        got = toxicity.Chains(head).marginals(u, t)
        assert np.allclose(got[0], want[0]) and np.allclose(got[1], want[1])


def test_a_long_text_without_sentences_is_one_chain():
    _, _, head, _, _ = toxicity.tokens(pa.array(["word " * 50_000]))
    assert head.sum() == 1
    p, pairs = toxicity.Chains(head).marginals(np.zeros(50_000), np.zeros((2, 2)))
    assert np.allclose(p, 0.5) and np.isclose(pairs.sum(), 49_999)


def test_a_label_takes_one_text(spark):
    from pyspark.sql import functions as F

    from skilltrends.llm import labelled
    copies = spark.range(20_000).select(F.lit(1).cast("long").alias("doc_id"), F.concat(F.lit("copy "), F.col("id").cast("string")).alias("text"))
    docs = copies.unionAll(spark.createDataFrame([(2, "x" * 2_000_000), (3, "short"), (4, "other"), (5, None)], "doc_id long, text string"))
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 1), (3, 0), (4, 0), (5, 1), (None, 1)], "doc_id long, quality int")
    rows, counts = labelled.labelled_sample(docs, labels, "quality", 10, 11, 100)
    assert sorted(r.id for r in rows.collect()) == [1, 3, 4, 5] and counts == {0: 2, 1: 3}  # a text beyond the bound isn't learned from
    few, _ = labelled.labelled_sample(docs, labels, "quality", 10, 11, 100, most_bytes=64 * 9)
    assert sum(len(r.t) for r in few.collect()) <= 64 * 9


def test_quality_margins_are_plain_sums():
    """The margin of a text is the dot product of its scaled 1- and 2-gram indicators with the weights."""
    import re
    rng = np.random.default_rng(4)
    size = 1 << quality_model.HASH_BITS
    model = quality_model.Model(rng.normal(0, 1, size), rng.normal(0, 1, size), 0.25, 1.0, 0.0)
    texts = ["the river and the river", "", None, "a", "A b! a-b \u00e9t\u00e9 12", " \n ", "x y " * 50]

    def column(h):
        return int(quality_model.spread_bits(np.array([h], np.uint64), quality_model.HASH_BITS)[0])

    for text, got in zip(texts, model.margins(pa.array(texts)).tolist()):
        words = re.findall(r"[0-9A-Za-z_\u0080-\U0010FFFF]+|[^\x09-\x0D\x200-9A-Za-z_\u0080-\U0010FFFF]+", text or "")
        h = [int(quality_model.token_hashes(pa.array([w]))[0][0]) for w in words]
        grams = {column(x) for x in h} | {column((a * 0x5BD1E9955BD1E995 + b) % 2 ** 64) for a, b in zip(h, h[1:])}
        norm = sum(model.ratio[c] ** 2 for c in grams) ** 0.5
        want = sum(model.ratio[c] * model.weight[c] for c in grams) / norm + 0.25 if grams else 0.25
        assert abs(got - want) < 1e-9
