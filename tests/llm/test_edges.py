"""Nulls, blank and long texts, ties, repeated rows, clashing columns and empty tables."""

import random
import time

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from skilltrends.llm import decontaminate, langid, mix, quality_model, quality_rules, shard, simhash, token_count, toxicity, url_filter

MODEL = public_tokenizers.path("piece_bpe_32k.model")
GOOD = "The little house stood near a wide river and the people of the town came to see it. "
ROWS = [
    (1, GOOD * 5, "en", "a"), (2, GOOD * 5, "en", "a"), (2, GOOD * 5, "en", "a"),  # a copy and a repeated row
    (3, None, "en", None), (None, "word", None, "a"), (None, None, None, None), (4, "", "en", ""), (5, " \n\t ", "de", "b"),
    (6, "x" * 50_000, "en", "b"), (7, "long text " * 30_000, "en", "c"), (8, "\u00e9\u4e2d\U0001F600 <s> \u2581", "fr", "c"), (9, "12 34 !!", "en", "c"),
]
SCHEMA = "doc_id long, text string, lang string, source string"
CLASH = ["row", "t", "id", "fp", "size", "SHARD", "bucket", "words", "score", "n0", "m0", "host", "spans", "label", "n_words", "a", "full"]


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    return df.select("*", *[F.lit("x").alias(c) for c in CLASH]).repartition(3)


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(i, i % 2, (i + 1) % 2) for i in range(1, 10)] + [(None, 1, 1), (3, None, None), (4, 7, 7)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([(1, "Long TEXT long"), (1, "long text"), (None, "near a wide river"), (2, None), (3, "..."), (4, "absent words")],
                                 "item_id long, text string")


def operators(labels, benchmark):
    return {
        "rules": lambda d: quality_rules.score_documents(d),
        "shard": lambda d: shard.shard_documents(d),
        "mix": lambda d: mix.mix_sources(d),
        "langid": lambda d: langid.identify(d, MODEL),
        "quality": lambda d: quality_model.score_quality(d, labels),
        "decontaminate": lambda d: decontaminate.find_contamination(d, benchmark),
        "toxicity": lambda d: toxicity.score_toxicity(d, labels),
        "simhash": lambda d: simhash.near_duplicates(d),
        "tokens": lambda d: token_count.count_tokens(d, MODEL),
    }


@pytest.fixture(scope="module")
def results(docs, labels, benchmark):
    return {k: f(docs).collect() for k, f in operators(labels, benchmark).items()}


def by(rows, doc_id, text=...):
    return [r for r in rows if r["doc_id"] == doc_id and (text is ... or r["text"] == text)]


@pytest.mark.parametrize("name", ["rules", "shard", "mix", "langid", "quality", "decontaminate", "toxicity", "simhash", "tokens"])
def test_every_row_comes_back_whole(results, name):
    got = sorted(((r["doc_id"], r["text"], r["lang"], r["source"], r["label"]) for r in results[name]), key=repr)
    assert got == sorted([(*r, "x") for r in ROWS], key=repr)


def test_empty_tables(spark, docs, labels, benchmark):
    for name, f in operators(labels, benchmark).items():
        out = f(docs.limit(0))
        assert out.count() == 0 and "doc_id" in out.columns, name
    assert simhash.one_of_each(docs.limit(0)).count() == 0
    assert mix.mixed_documents(docs.limit(0)).count() == 0
    none = operators(labels.limit(0), benchmark.limit(0))
    assert {r["score"] for r in none["quality"](docs).collect()} == {1.0}
    assert {r["score"] for r in none["toxicity"](docs).collect()} == {0.0}
    assert not any(r["contaminated"] for r in none["decontaminate"](docs).collect())
    assert {r["lang_pred"] for r in langid.identify(docs.withColumn("lang", F.lit(None).cast("string")), MODEL).collect()} == {"und"}


def test_blank_texts(results):
    for r in by(results["rules"], 3) + by(results["rules"], 4) + by(results["rules"], 5):
        assert (r["n_words"], r["n_repeat_words"], r["base_failed"], r["kept"]) == (0, 0, True, False)
    assert {r["fingerprint"] for i in (3, 4, 5) for r in by(results["simhash"], i)} == {"0" * 16}
    assert {r["component_id"] for i in (3, 4, 5) for r in by(results["simhash"], i)} == {3}
    assert by(results["simhash"], None, None)[0]["component_id"] == 3  # a null id is ignored
    assert by(results["simhash"], None, "word")[0]["component_id"] is None
    assert [(r["lang_pred"], r["score"]) for i in (3, 4, 5, 9) for r in by(results["langid"], i)] == [("und", 0.0)] * 4
    assert all(not r["contaminated"] and r["n_words"] == 0 for i in (3, 4, 5) for r in by(results["decontaminate"], i))
    assert [(r["n_bytes"], r["n_tokens"]) for i in (3, 4) for r in by(results["tokens"], i)] == [(0, 0)] * 2
    assert all(r["taken"] == 0 for i in (3, 4, 5) for r in by(results["mix"], i))
    assert [(r["size"], r["text_crc32"]) for r in by(results["shard"], 3)] == [(8, 0)]


def test_repeated_rows_and_long_texts(results):
    assert {r["component_id"] for i in (1, 2) for r in by(results["simhash"], i)} == {1}
    assert len({r["n_tokens"] for r in by(results["tokens"], 2)}) == 1
    (long,) = by(results["decontaminate"], 7)
    assert (long["n_words"], long["n_hit"], long["n_items"], long["contaminated"]) == (60_000, 60_000, 1, True)
    (rules,) = by(results["rules"], 7)
    assert (rules["n_words"], rules["n_repeat_words"], rules["kept"]) == (60_000, 60_000, False)
    assert [r["n_items"] for r in by(results["decontaminate"], 1)] == [1]  # the item without an id


def test_shards_and_slots(results):
    rows = results["shard"]
    assert sorted(r["slot"] * 24 + r["shard"] for r in rows) == list(range(len(ROWS)))
    assert {r["law"] for r in rows} == {"rows"} and all(r["grown_shard"] is None for r in rows)


def test_block_edges_of_large_streams(spark):
    rows = [(b, w, n) for w, n in ((10**13 + 7, 10**10 - 1), (10**18 + 11, 10**15 + 3), (17, 5)) for b in (0, 1, n // 3, n - 1, n)]
    df = spark.createDataFrame(rows, "block long, words long, n long")
    assert [r[0] for r in df.select(mix.edge(F.col("block"))).collect()] == [b * w // n for b, w, n in rows]


def test_only_a_text_column(spark):
    only = spark.createDataFrame([("a b",), (None,)], "text string").withColumn("doc_id", F.lit(1).cast("long"))
    assert token_count.count_tokens(only, MODEL, carry=["text"]).columns == ["text", "n_bytes", "n_tokens", "over_limit"]
    assert token_count.count_tokens(only, MODEL, carry=[]).count() == 2


def test_urls(spark):
    urls = [None, "", "no host", "http://", "http://Example.COM/en/x?y#z", "http://www.example.com/en/", "http://a.www.example.com/en/b/c",
            "https://example.com/english", "x://example.com", "http://shop.net/es/", "http://net/fr/1", "http://net/fr", "http://a.b/p?http://x.com/",
            "http://example.com?q=/en/"]
    df = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)], "page_id long, url string, host string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.filter_urls(df).collect()}
    assert [got[i] for i in range(4)] == [("", "", None, "allow")] * 4
    assert got[4] == ("example.com", "/en/x", "example.com/en/", "block")
    assert got[5][2:] == ("www.example.com/en/", "allow") and got[6][2:] == ("www.example.com/en/", "allow")
    assert got[7] == ("example.com", "/english", "com/", "allow")
    assert got[8] == ("example.com", "", None, "allow")
    assert got[9][2:] == ("net/es/", "block") and got[10][2:] == ("net/fr/", "block") and got[11][2:] == (None, "allow")
    assert got[12] == ("a.b", "/p", None, "allow")
    assert got[13] == ("example.com", "", None, "allow")
    one_by_one = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.filter_urls(df, block_rules=1).collect()}
    assert one_by_one == got
    assert url_filter.filter_urls(df.limit(0)).count() == 0


def brute_rule(host, path, rules):
    """The longest rule that fits, by trying each: more host labels, then the longer path, then block."""
    fits = [(len(h.split(".")) if h else 0, len(p), v, h + p) for v, h, p in rules
            if (not h or host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits, default=None)


def test_random_rules_equal_trying_each(spark):
    rng = random.Random(5)
    hosts = ["", "com", "a.com", "b.a.com", "org", "x.org"]
    rules = list({(h, p): (rng.choice(["allow", "block"]), h, p) for h in hosts for p in
                  ("/" + "".join(rng.choices("ab/", k=rng.randrange(5))) for _ in range(25))}.values())
    rules += [("block", "com", "/ab"), ("allow", "com", "/ab"), ("allow", "org", ""), ("block", "org", "")]
    urls = [f"http://{rng.choice(['', 'c.'])}{rng.choice(hosts[1:])}{rng.choice(['', '/'])}{''.join(rng.choices('ab/', k=rng.randrange(8)))}" for _ in range(400)]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    for block in (url_filter.BLOCK_RULES, 7):
        for r in url_filter.filter_urls(df, rules, block_rules=block).collect():
            want = brute_rule(r["host"], r["path"], rules)
            assert (r["rule"], r["verdict"]) == ((want[3], want[2]) if want else (None, "allow"))


def test_many_rules_of_one_host_and_very_long_urls(spark):
    rules = [("block", "shop.net", f"/item{i}") for i in range(100_000)] + [("allow", "shop.net", "/item1/ok")]
    urls = [f"http://shop.net/item{i}x" for i in range(3000)] + ["http://shop.net/" + "i" * 1_000_000, "http://shop.net/item7" + "/a" * 500_000,
                                                                 "http://" + "a." * 200_000 + "shop.net/item5", "http://shop.net/item1/okay"]
    ids = [None, *[7] * 10, *range(len(urls) - 11)]
    df = spark.createDataFrame(list(zip(ids, urls)), "page_id long, url string")
    df = df.unionAll(df.limit(50))
    began = time.perf_counter()
    got = [(r["page_id"], r["rule"], r["verdict"]) for r in url_filter.filter_urls(df, rules, carry=["page_id"]).collect()]
    assert time.perf_counter() - began < 30
    assert len(got) == len(urls) + 50 and sum(i is None for i, _, _ in got) == 2
    assert sorted(r for _, r, _ in got if r)[:2] == ["shop.net/item0"] * 2 and sum(v == "block" for _, _, v in got) == 3000 + 50 + 2
    assert [(r, v) for _, r, v in got[len(urls) - 4:len(urls)]] == [(None, "allow"), ("shop.net/item7", "block"), ("shop.net/item5", "block"), ("shop.net/item1/ok", "allow")]


def test_repeated_benchmark_rows_are_one_item_of_a_block(spark, benchmark):
    many = benchmark.unionAll(spark.range(5000).selectExpr("1L AS item_id", "'Long TEXT long' AS text"))
    n, blocks = decontaminate.blocks_of(many, "item_id", "text", 60)
    items = [i for block in blocks for i in block]
    assert n < 4 and len(items) == len(set(items)) == benchmark.distinct().count()
    df = spark.createDataFrame([(1, "a long text long text"), (2, "none of it")], "doc_id long, text string")
    results = [sorted((r["doc_id"], r["n_hit"], r["n_items"], r["items_sha256"]) for r in decontaminate.find_contamination(df, b).collect()) for b in (benchmark, many)]
    assert results[0] == results[1]
