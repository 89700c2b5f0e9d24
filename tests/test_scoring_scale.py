"""Scores, weights and verdicts: the frequent tokens' rows stay in their task, and the cut of the model changes no result."""

import pytest

from skilltrends.operators import extract as EX
from skilltrends.operators import select_text as ST
from skilltrends.plans import analogues as A

KEYS = ("doc_id", ST.UNIT, "pos")
LINES = "the cat of the hill\nand the dog und der hund\n12 !\nla la la casa\nis that the one\nde la que\n" * 2
TEXTS = [(1, LINES), (1, LINES), (1, "the other text"), (2, "!"), (3, None), (None, "der und der und"), (4, "the of and"), (5, "")]


@pytest.fixture
def docs(spark):
    return spark.createDataFrame(TEXTS, "doc_id LONG, text STRING")


def rows(df):
    return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.na.fill(-1, ["doc_id"]).collect())


@pytest.mark.parametrize("most", [0, 5, 9])
def test_a_cut_model_gives_the_same_sums(spark, docs, most):
    counted = ST.counted_passages(ST.passages(docs, unit=True), KEYS)
    idf, coef = ST.fit_idf(counted), A.coef_frame(spark)
    frequent, rare = ST.frequent_tokens(idf, most)
    assert frequent.count() <= most and frequent.count() + rare.count() == idf.count()
    tf = ST.term_rows(counted, KEYS)
    assert rows(ST.linear_scores(tf, idf, coef, -0.3, KEYS, most)) == rows(ST.linear_scores(tf, idf, coef, -0.3, KEYS))
    whole = rows(ST.tfidf(tf, idf, KEYS))
    assert rows(ST.tfidf(tf, idf, KEYS, most)) == whole and rows(ST.tfidf(counted, idf, KEYS, most)) == whole
    assert len(whole) == tf.count()


def test_model_from_counted_passages_equals_the_model_from_texts(docs):
    p = ST.passages(docs, unit=True)
    assert rows(ST.fit_idf(ST.counted_passages(p, KEYS)).selectExpr("1L doc_id", "*")) == rows(ST.fit_idf(p).selectExpr("1L doc_id", "*"))


@pytest.mark.parametrize("intercept", [-0.3, 0.4])
def test_selected_text_equals_the_joined_relevant_passages(spark, docs, intercept):
    p = ST.passages(docs, unit=True)
    s = ST.linear_scores(ST.term_frequencies(p, KEYS), ST.fit_idf(p), A.coef_frame(spark), intercept, KEYS)
    score = {(r.doc_id, r[ST.UNIT], r.pos): r.score for r in s.collect()}
    parts = {}
    for r in sorted(set(p.collect()), key=lambda r: r.pos):
        if 1 / (1 + 2.718281828459045 ** -score.get((r.doc_id, r[ST.UNIT], r.pos), intercept)) >= 0.45:
            parts.setdefault((r.doc_id, r[ST.UNIT]), []).append(r.passage)
    unit = {(d, t): u for d, t, u in docs.selectExpr("doc_id", "text", "xxhash64(text)").collect()}
    want = [(d, " ".join(" ".join(parts[d, unit[d, t]]).split("\n")).strip("\n")) for d, t in TEXTS if t and (d, unit[d, t]) in parts]
    want = sorted((-1 if d is None else d, x) for d, x in want if len(x) > 1)
    got = rows(ST.select_relevant(docs, None, A.coef_frame(spark), intercept, 0.45))
    assert [(d, x.strip()) for d, x in got] == [(d, x.strip()) for d, x in want]
    plan = ST.select_relevant(docs, ST.fit_idf(p), A.coef_frame(spark), intercept, 0.45)._jdf.queryExecution().executedPlan().toString()
    assert not any("passage" in line for line in plan.splitlines() if "Exchange" in line)


def test_terms_of_a_row_equal_the_shuffled_ones(spark, docs):
    d = EX.dictionary_frame(spark, A.TERM_DICTIONARY)
    texts = docs.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    want = {}
    for r in EX.extract_by_dictionary(texts, d).collect():
        want.setdefault(r.doc_id, set()).add(r.term)
    for block in (2, 1_000_000):
        out = EX.with_dictionary_terms(texts, d, block_words=block)
        assert "Exchange hashpartitioning" not in out.drop("text")._jdf.queryExecution().executedPlan().toString().replace("Exchange hashpartitioning(doc_id", "")
        assert {r.doc_id: r.terms for r in out.collect()} == {r.doc_id: sorted(want.get(r.doc_id, ())) for r in texts.collect()}
    empty = EX.with_dictionary_terms(texts, EX.dictionary_frame(spark, {"a": ["the"]}).where("alias = ''"))
    assert {tuple(r.terms) for r in empty.collect()} == {()}
