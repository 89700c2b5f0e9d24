"""The pipeline's stages, each against a plain statement on its own input."""

import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402
from skilltrends.llm import mix, quality_model  # noqa: E402
from skilltrends.llm.common import read, stored  # noqa: E402

from . import brute  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs = [read(spark, SF, "documents")]
    for name, f in corpus_pipeline.STAGES:
        docs.append(stored(f(spark, docs[-1], SF), f"test-{name}"))
    return docs


def rows(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_columns_stay_those_of_documents(steps):
    assert all(d.columns == steps[0].columns for d in steps[1:-1])


def test_rejected_documents_go(spark, steps):
    scored = rows(quality_model.score_quality(steps[0], read(spark, SF, "labels")))
    assert rows(steps[1]).keys() == {k for k, r in scored.items() if r["predicted"] == 1}
    good = {r["doc_id"] for r in read(spark, SF, "labels").filter("quality = 1").collect()}
    assert len(good & rows(steps[1]).keys()) > 0.9 * len(good)


def test_one_of_each_group_stays(steps):
    before = rows(steps[1])
    ids = sorted(before)
    groups = brute.components([brute.fingerprint(before[i]["text"]) for i in ids])
    assert rows(steps[2]).keys() == {ids[k] for k in groups}


def test_contaminated_documents_go(spark, steps):
    items = [(str(r["item_id"]), r["text"]) for r in read(spark, SF, "benchmark").collect()]
    clean = set()
    for k, r in rows(steps[2]).items():
        n, hit, _ = brute.contamination(r["text"], items)
        if not (hit > 0 and 20 * hit >= n):
            clean.add(k)
    assert rows(steps[3]).keys() == clean


def test_the_mix_holds_whole_documents(steps):
    texts = {r["doc_id"]: r["text"] for r in steps[3].collect()}
    taken = {r["doc_id"]: (r["taken"], r["size"]) for r in mix.mix_sources(steps[3]).collect()}
    found = dict.fromkeys(taken, 0)
    for r in steps[4].collect():
        assert r["text"] == texts[r["doc_id"]]
        found[r["doc_id"]] += 1
    # the nearer number of whole copies
    assert found == {k: 0 if not n else t // n + (t % n > 0 and 2 * (t % n) >= n) for k, (t, n) in taken.items()}


def test_shards_hold_all_rows(spark, steps):
    out = steps[5].collect()
    assert sorted(r["slot"] * 24 + r["shard"] for r in out) == list(range(steps[4].count()))
    assert sorted((r["doc_id"], r["text"]) for r in out) == sorted((r["doc_id"], r["text"]) for r in steps[4].collect())


def test_run_is_all_stages(spark, steps):
    again = corpus_pipeline.run(spark, SF)
    assert sorted(map(tuple, again.collect()), key=repr) == sorted(map(tuple, steps[5].collect()), key=repr)


CLASH = ["score", "predicted", "held_out", "n_words", "n_hit", "spans", "contaminated", "rest", "row", "t", "c0", "size", "copy", "fp", "uid", "a.b"]


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    """Nulls, empty and long texts, repeated rows and columns with the operators' names."""
    docs = read(spark, SF, "documents")
    more = spark.createDataFrame([(9001, None, "en", None, 0), (None, "", None, "web", 0), (None, None, None, None, None), (9002, "word " * 200_000, "en", "web", 1)],
                                 docs.schema)
    return docs.unionAll(docs.filter("doc_id < 20")).unionAll(more).select("*", *[F.concat(F.lit(c), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))).alias(c) for c in CLASH])


def test_every_column_comes_through_unchanged(spark, odd):
    docs = odd
    for name, f in corpus_pipeline.STAGES[:-1]:
        docs = stored(f(spark, docs, SF), f"odd-{name}")
        assert docs.columns == odd.columns
        assert docs.distinct().exceptAll(odd.distinct()).count() == 0, name  # every row is one of the input's
    out = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert out.count() == docs.count() > 0


def test_empty_tables(spark, odd):
    docs = odd.limit(0)
    for _, f in corpus_pipeline.STAGES:
        docs = stored(f(spark, docs, SF), "empty")
        assert docs.count() == 0
