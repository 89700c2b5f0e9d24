"""Operators against plain statements, on whole smallest tables and on planted cases."""

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from skilltrends.llm import decontaminate, feistel, mix, quality_rules, shard, simhash, token_count
from skilltrends.llm.common import read

from . import brute

SMOKE = "/root/testdata/sf0.001"
MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def texts(spark):
    return {r["doc_id"]: r["text"] for r in read(spark, SMOKE, "documents").select("doc_id", "text").collect()}


# --- 1 --------------------------------------------------------------------------------------------

def test_rule_metrics(spark, texts):
    got = quality_rules.score_documents(read(spark, SMOKE, "documents"), carry=["doc_id"]).collect()
    assert len(got) == len(texts)
    for r in got:
        want = brute.metrics(texts[r["doc_id"]])
        assert {k: r[k] for k in want} == want


def test_windows_that_share_hash_bits_are_told_apart(spark, monkeypatch):
    monkeypatch.setattr(quality_rules, "POSITION_BITS", 60)  # 4 bits of hash are left: nearly every text has a clash
    rows = [(i, " ".join(random.Random(i).choices("abcdefgh", k=60))) for i in range(40)]
    got = quality_rules.base_metrics(spark.createDataFrame(rows, "i int, x string"), F.col("x")).collect()
    assert [r["n_repeat_words"] for r in sorted(got)] == [brute.metrics(t)["n_repeat_words"] for _, t in rows]


def test_rule_order_is_rejection_per_cost():
    hits = {(True, False, False): 10, (False, True, True): 6, (False, False, True): 3, (False, False, False): 81}
    assert quality_rules.order_rules(["a", "b", "c"], {"a": 10.0, "b": 1.0, "c": 2.0}, hits) == ["b", "c", "a"]
    assert quality_rules.order_rules(["a", "b", "c"], {"a": 1.0, "b": 1.0, "c": 1.0}, hits) == ["a", "c", "b"]


def test_verdict_does_not_depend_on_the_order(spark):
    docs = read(spark, SMOKE, "documents")
    one, two = ({r["doc_id"]: r["kept"] for r in quality_rules.score_documents(docs, costs=c).collect()}
                for c in (dict.fromkeys(quality_rules.RULES, 1.0), {k: 10.0 ** i for i, k in enumerate(quality_rules.RULES)}))
    assert one == two and 0 < sum(one.values()) < len(one)


# --- 2 --------------------------------------------------------------------------------------------

@pytest.mark.parametrize("n", [1, 2, 3, 7, 10, 97, 100, 1000])
def test_permutation_is_one_and_inverts(spark, n):
    forth, back = (feistel.longest_walk(spark, n, 5, inverse=i) for i in (False, True))
    df = spark.range(n).select("id", feistel.permute(F.col("id"), n, 5, forth).alias("to"))
    df = df.select("id", "to", feistel.permute(F.col("to"), n, 5, back, inverse=True).alias("again"))
    rows = df.collect()
    assert sorted(r["to"] for r in rows) == list(range(n))
    assert all(r["id"] == r["again"] for r in rows)


def test_shards_hold_equal_rows_without_gaps_and_repeat(spark, texts):
    docs = read(spark, SMOKE, "documents")
    one = {r["doc_id"]: (r["shard"], r["slot"]) for r in shard.shard_documents(docs).collect()}
    two = {r["doc_id"]: (r["shard"], r["slot"]) for r in shard.shard_documents(docs.repartition(7)).collect()}
    assert one == two
    sizes = [sorted(t for s, t in one.values() if s == k) for k in range(24)]
    assert all(x == list(range(len(x))) for x in sizes) and max(map(len, sizes)) - min(map(len, sizes)) <= 1
    place = spark.createDataFrame([v for v in one.values()], "shard long, slot long")
    numbers = place.select(shard.row_number_at(spark, F.col("shard"), F.col("slot"), len(one)).alias("n")).collect()
    assert sorted(r["n"] for r in numbers) == list(range(len(one)))


# --- 3 --------------------------------------------------------------------------------------------

@settings(max_examples=10, deadline=None)
@given(votes=st.lists(st.integers(0, 1000), min_size=1, max_size=8), seats=st.integers(0, 60))
def test_apportionment_by_highest_quotients(spark, votes, seats):
    parties = spark.createDataFrame([(1, i, v, seats) for i, v in enumerate(votes)], "g int, i int, votes long, seats long")
    got = {r["i"]: r["quota"] for r in mix.sainte_lague(parties, ["g"], ["i"], "votes", "seats").collect()}
    bids = sorted(((-v / (2 * k - 1), i) for i, v in enumerate(votes) if v for k in range(1, seats + 1)))[:seats]
    assert got == {i: sum(b[1] == i for b in bids) for i in range(len(votes))}


def test_mix_takes_near_targets_and_no_more_than_twice(spark):
    docs = read(spark, SMOKE, "documents")
    rows = mix.mix_sources(docs).collect()
    assert len(rows) == docs.count() and all(0 <= r["taken"] <= 2 * r["size"] for r in rows)
    total = sum(r["size"] for r in rows)
    of = {}
    for r in rows:
        of.setdefault(r["source"], []).append(r)
    assert abs(sum(x[0]["target"] for x in of.values()) - 1.5 * total) < 1e-6 * total
    for x in of.values():
        assert x[0]["source_size"] == sum(r["size"] for r in x) and x[0]["target"] <= 2 * x[0]["source_size"]
        assert abs(sum(r["taken"] for r in x) - x[0]["target"]) <= max(0.02 * x[0]["target"], 2 * mix.BLOCK_TOKENS)
    again = mix.mix_sources(docs.repartition(5)).collect()
    assert sorted((r["doc_id"], r["taken"]) for r in again) == sorted((r["doc_id"], r["taken"]) for r in rows)


def test_mixed_documents_hold_the_words_taken(spark, texts):
    docs = read(spark, SMOKE, "documents")
    taken = {r["doc_id"]: r["taken"] for r in mix.mix_sources(docs).collect()}
    found, cut = dict.fromkeys(taken, 0), 0
    for r in mix.mixed_documents(docs).collect():
        assert r["text"] in texts[r["doc_id"]]
        found[r["doc_id"]] += len(brute.SPACED.findall(r["text"]))
        cut += r["text"] != texts[r["doc_id"]]
    assert found == taken
    assert cut <= 2 * 20 * mix.STREAMS


# --- 7 --------------------------------------------------------------------------------------------

def test_contamination_on_whole_tables(spark, texts):
    items = [(str(r["item_id"]), r["text"]) for r in read(spark, SMOKE, "benchmark").collect()]
    rows = {}
    for size in (decontaminate.BLOCK_BYTES, 3000):  # one block of items, and many
        got = decontaminate.find_contamination(read(spark, SMOKE, "documents"), read(spark, SMOKE, "benchmark"), block_bytes=size).drop("text", "lang", "source")
        rows[size] = sorted(tuple(r) for r in got.collect())
    assert rows[3000] == rows[decontaminate.BLOCK_BYTES]
    for r in got.collect():
        n, hit, names = brute.contamination(texts[r["doc_id"]], items)
        assert (r["n_words"], r["n_hit"], r["n_items"]) == (n, hit, len(names))
        assert r["contaminated"] == (hit > 0 and 20 * hit >= n)


@settings(max_examples=60, deadline=None)
@given(docs=st.lists(st.text("ab AB.é", max_size=60), min_size=1, max_size=6), items=st.lists(st.text("ab é", max_size=12), max_size=4), window=st.integers(1, 4))
def test_index_finds_every_window(docs, items, window):
    named = [(str(i), t) for i, t in enumerate(items)]
    got = decontaminate.search_batch(pa.array(docs), decontaminate.Phrases(named, window))
    for text, n, spans, names in zip(docs, got["n"].to_pylist(), got["s"].to_pylist(), got["i"].to_pylist()):
        want = brute.contamination(text, named, window)
        assert (n, sum(s["stop"] - s["start"] for s in spans), sorted(names)) == want


def test_long_text_in_overlapping_pieces(monkeypatch):
    monkeypatch.setattr(decontaminate, "SHARD_WORDS", 50)
    rng = random.Random(3)
    text = " ".join(rng.choices("abcd", k=2000))
    items = [(str(i), " ".join(text.split()[k:k + 9])) for i, k in enumerate(range(3, 1900, 41))]
    got = decontaminate.search_batch(pa.array([text]), decontaminate.Phrases(items, 6))
    n, hit, names = brute.contamination(text, items, 6)
    assert got["n"].to_pylist() == [n] and sorted(got["i"].to_pylist()[0]) == names
    assert sum(s["stop"] - s["start"] for s in got["s"].to_pylist()[0]) == hit


def test_cutting_spans_leaves_the_rest(spark):
    df = spark.createDataFrame([("One, two three. Four five!",)], "t string")
    spans = F.array(F.struct(F.lit(1).alias("start"), F.lit(3).alias("stop")))
    assert df.select(decontaminate.without_spans(F.col("t"), spans)).first()[0] == "One. Four five!"


# --- 9 --------------------------------------------------------------------------------------------

def test_fingerprints_and_components_on_a_whole_table(spark, texts):
    rows = {r["doc_id"]: r for r in simhash.near_duplicates(read(spark, SMOKE, "documents")).collect()}
    ids = sorted(rows)
    codes = [brute.fingerprint(texts[i]) for i in ids]
    assert [int(rows[i]["fingerprint"], 16) for i in ids] == codes
    assert [rows[i]["component_id"] for i in ids] == [ids[k] for k in brute.components(codes)]
    kept = sorted(r["doc_id"] for r in simhash.one_of_each(read(spark, SMOKE, "documents")).collect())
    assert kept == sorted({rows[i]["component_id"] for i in ids})


def near_codes(n, seed):
    """Random codes, clusters within few bits, chains of small steps, and codes that share whole blocks."""
    rng = random.Random(seed)
    codes = [rng.getrandbits(64) for _ in range(n)]
    for _ in range(n):
        c = rng.choice(codes)
        for _ in range(rng.randint(0, 5)):
            c ^= 1 << rng.randrange(64)
        codes.append(c)
    return list(dict.fromkeys(codes + [rng.getrandbits(16) << 48 | 0xABCDEF for _ in range(n)] + [0]))


@pytest.mark.parametrize("cell_rows", [50_000, 40, 8])
def test_links_in_small_large_and_tiled_cells(spark, cell_rows):
    codes = near_codes(150, cell_rows)
    df = spark.createDataFrame([(int(np.uint64(c).view(np.int64)),) for c in codes], "fp long")
    roots = {r["node"]: r["root"] for r in simhash.components(simhash.link_fingerprints(df, 3, cell_rows)).collect()}
    signed = [int(np.uint64(c).view(np.int64)) for c in codes]
    want = {}
    for i, k in enumerate(brute.components(codes)):
        want.setdefault(k, []).append(signed[i])
    assert {min(g): sorted(g) for g in want.values() if len(g) > 1} == \
        {r: sorted([k for k, v in roots.items() if v == r] + [r]) for r in set(roots.values())}


def test_gray_ranks_order_the_reflected_sequence():
    codes = np.array([i ^ i >> 1 for i in range(64)], np.uint64)
    assert simhash.gray_rank(codes).tolist() == list(range(64))


# --- 10 -------------------------------------------------------------------------------------------

def test_token_counts_are_the_librarys(spark, texts):
    lib = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    for r in token_count.count_tokens(read(spark, SMOKE, "documents"), MODEL, carry=["doc_id"]).collect():
        t = texts[r["doc_id"]]
        assert (r["n_bytes"], r["n_tokens"]) == (len(t.encode()), len(lib.encode(t)))
        assert r["over_limit"] == (r["n_tokens"] > 4096)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.one_of(st.sampled_from(" ▁abeht0.\n<s>/"), st.characters(exclude_categories=["Cs"])), max_size=40), min_size=1, max_size=5))
def test_token_counts_of_any_text(merges, texts):
    lib = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    assert token_count.count_batch(pa.array(texts), merges).tolist() == [len(x) for x in lib.encode(texts)]


@pytest.fixture(scope="module")
def merges():
    return token_count.Merges(MODEL)
