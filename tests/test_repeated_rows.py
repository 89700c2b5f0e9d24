"""Repeated rows, and rows that share a key, through passage selection: row by row."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from skilltrends import session as S
from skilltrends.operators import extract as EX
from skilltrends.operators import select_text as ST
from skilltrends.plans import analogues as A
from skilltrends.plans import daily as D

from .conftest import SMOKE

KEYS = ("doc_id", ST.UNIT, "pos")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SMOKE}/documents.parquet").select("doc_id", "text")


@pytest.fixture(scope="module")
def repeated(docs):
    """Every tenth document twice, and all texts of one document again under another's id."""
    return docs.unionAll(docs.filter("doc_id % 10 = 0")).unionAll(docs.filter("doc_id = 3").select(F.lit(4).cast("long").alias("doc_id"), "text"))


def times(doc_id, other):
    return 0 if other else 2 if doc_id % 10 == 0 else 1


def test_selected_text_row_by_row(spark, docs, repeated):
    idf, coef = ST.fit_idf(ST.passages(docs)), A.coef_frame(spark)
    one, many = ({"rows": Counter(map(tuple, ST.select_relevant(d, idf, coef, A.RELEVANCE_INTERCEPT, A.RELEVANCE_THRESHOLD).collect()))}["rows"]
                 for d in (docs, repeated))
    want = Counter({r: n * (2 if r[0] % 10 == 0 else 1) for r, n in one.items()})
    want += Counter({(4, t): n for (i, t), n in one.items() if i == 3})
    assert many == want
    once = ST.select_relevant(repeated, idf, coef, A.RELEVANCE_INTERCEPT, A.RELEVANCE_THRESHOLD, every_row=False).collect()
    assert Counter(map(tuple, once)) == Counter(want.keys())


def test_weights_of_repeated_rows(spark, docs, repeated):
    idf = ST.fit_idf(ST.passages(docs))

    def weights(d):
        w = ST.tfidf(ST.term_frequencies(ST.passages(d, unit=True), KEYS), idf, KEYS)
        return Counter((r.doc_id, r.pos, r.token, r.tf, round(r.weight, 9)) for r in w.collect())

    one, many = weights(docs), weights(repeated)
    want = Counter({r: n * (2 if r[0] % 10 == 0 else 1) for r, n in one.items()})
    want += Counter({(4, *r[1:]): n for r, n in one.items() if r[0] == 3})
    assert many == want


def test_scores_without_a_known_token(spark):
    p = ST.passages(spark.createDataFrame([(1, "unknown words"), (2, "the the")], "doc_id LONG, text STRING"), unit=True)
    idf = spark.createDataFrame([("the", 1.0)], "token STRING, idf DOUBLE")
    s = ST.linear_scores(ST.term_frequencies(p, KEYS), idf, A.coef_frame(spark), -0.3, KEYS)
    assert {r.doc_id: round(r.score, 9) for r in s.collect()} == {1: -0.3, 2: 1.2}


def test_repeated_lines_of_a_posting_file(spark):
    landing, sink = S.scratch_path(spark, "t-landing"), S.scratch_path(spark, "t-clean")
    line = '{"job_key": "a", "keyword": ["k"], "job_description": "python alpha beta\\nplain words"}'
    spark.createDataFrame([(line,), (line,), (line.replace('"a"', '"b"'),)], "value STRING").coalesce(1).write.text(f"{landing}/jobs_01_02_2024.json")
    coef = spark.createDataFrame([("python", 6.0)], "token STRING, coef DOUBLE")
    dictionary = EX.dictionary_frame(spark, {"python": ["python"]})
    clean = D.daily_run(spark, landing, sink, coef, -1.0, 0.5, dictionary).collect()
    assert Counter((r.job_key, r.split_jd, tuple(r.cleaned_techs)) for r in clean) == Counter(
        {("a", "python alpha beta plain words", ("python",)): 2, ("b", "python alpha beta plain words", ("python",)): 1})
    hooked = D.enrich(spark.read.parquet(sink).select("job_key", "keyword", "job_description", "source_file"), coef, -1.0, 0.5,
                      extractor=lambda t: ["x"]).collect()
    assert sorted(r.job_key for r in hooked) == ["a", "a", "b"]


def test_a_null_field_of_a_response_wins(spark):
    base = spark.createDataFrame([(1, "a", 5), (2, "b", 6)], "k INT, x STRING, y INT")
    response = spark.createDataFrame([(1, None)], "k INT, x STRING")
    assert sorted(map(tuple, EX.merge_response(base, response, "k").collect())) == [(1, None, 5), (2, "b", 6)]
