"""Hostile texts in time near their length."""

import random
import string
import time

import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F

from skilltrends.llm import quality_rules, token_count

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def merges():
    return token_count.Merges(MODEL)


@pytest.mark.parametrize("unit", ["A", "A!", "!A", "AB!c", "x", "!?"])
def test_a_megabyte_of_one_pattern_through_the_rules(spark, unit):
    def run(times):
        docs = spark.range(1).select(F.expr(f"repeat('{unit}', {times})").alias("t"))
        quality_rules.base_metrics(docs, F.col("t")).select(*[F.expr(c).alias(k) for k, c in quality_rules.RULES.items()]).collect()

    run(10)  # the session's first job and the code's compilation don't count
    began = time.perf_counter()
    run(1_000_000 // len(unit))
    assert time.perf_counter() - began < 5


def test_shouting_counts_what_its_pattern_says(spark):
    rng = random.Random(2)
    rows = [("".join(rng.choices("AAB!!a x9\n", k=rng.randrange(40))),) for _ in range(3000)]
    slow = r"10 * regexp_count(text, '[A-Z]{2,}[^\\x20\\x09-\\x0Da-z]*!') > 3 * n_words"
    df = spark.createDataFrame(rows, "text STRING").crossJoin(spark.range(0, 7).select(F.col("id").alias("n_words")))
    assert df.filter(F.expr(slow) != F.expr(quality_rules.RULES["shouting"])).count() == 0


def test_long_unspaced_texts_count_like_the_library(merges):
    rng, sp = random.Random(1), sentencepiece.SentencePieceProcessor(model_file=MODEL)
    words = "the river and people came from town ation ing er est".split()
    texts = ["".join(rng.choices(string.ascii_letters + "+/0123456789", k=200_000)), "a" * 100_001, "ab" * 60_000, "aab" * 50_000,
             "".join(rng.choices(words, k=40_000)), "".join(rng.choices("éàü中文字日本語한국\U0001F600", k=60_000)),
             "".join(rng.choices("ACGT", k=100_000)), "x" * 257 + "▁" * 300 + " " * 400 + "the" * 200]
    texts += ["".join(rng.choices("abthe i", k=rng.randrange(2000))) for _ in range(50)]
    began = time.perf_counter()
    got = token_count.count_batch(pa.array(texts), merges).tolist()
    assert time.perf_counter() - began < 15
    assert got == [len(sp.encode(t)) for t in texts]


def test_a_megabyte_of_letters(merges):
    text = "".join(random.Random(3).choices(string.ascii_lowercase, k=1_000_000))
    began = time.perf_counter()
    assert token_count.count_batch(pa.array([text]), merges)[0] > 100_000
    assert time.perf_counter() - began < 12


def test_costs_of_two_measurements_agree(spark):
    """Rules well above the floor; the machine may be busy, so the closest of three tries counts."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    sample = quality_rules.base_metrics(docs.select("text"), F.col("text")).cache()
    sample.count()
    names = ["few_letters", "exclaiming"]
    rules = {k: quality_rules.RULES[k] for k in names}
    runs = [quality_rules.measure(sample, rules)[0] for _ in range(4)]
    for k in names:
        assert min(abs(a[k] - b[k]) / max(a[k], b[k]) for a, b in zip(runs, runs[1:])) < 0.2
    sample.unpersist()
