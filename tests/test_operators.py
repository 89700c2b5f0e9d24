"""Unit tests of operators not covered by golden vectors."""

from pyspark.sql import functions as F

from skilltrends.operators import extract as EX
from skilltrends.operators import normalize as NZ
from skilltrends.operators import planning as PL
from skilltrends.operators import quality as QA
from skilltrends.sources import jsonl as J


def test_extractor_hook_retries_and_keeps_errors(spark):
    def flaky(text):
        if text == "bad":
            raise RuntimeError("service unavailable")
        return [w for w in text.split() if w.isalpha()]

    df = spark.createDataFrame([(1, "aws and sql"), (2, "bad")], "id INT, split_jd STRING")
    rows = {r.id: r for r in EX.extract_with(df, EX.each(flaky), "id", max_attempts=3).collect()}
    assert rows[1].cleaned_techs == ["aws", "and", "sql"] and rows[1].result is None
    assert rows[2].cleaned_techs is None and len(rows[2].result) == 3
    assert "service unavailable" in rows[2].result[0]


def test_batch_extractor_is_asked_again_only_for_failed_texts(spark):
    def batch(texts):
        return [ValueError(t) if t == "no" else [str(len(texts))] for t in texts]

    df = spark.createDataFrame([(1, "a"), (2, "no"), (3, "b")], "id INT, split_jd STRING").coalesce(1)
    rows = {r.id: r for r in EX.extract_with(df, batch, "id", max_attempts=2).collect()}
    assert rows[1].cleaned_techs == rows[3].cleaned_techs == ["3"] and rows[2].result == ["ValueError: no"] * 2


def test_merge_response_response_wins_and_metadata_dropped(spark):
    base = spark.createDataFrame([(1, "posting", "t")], "k INT, source STRING, title STRING")
    resp = spark.createDataFrame([(1, "model", "m")], "k INT, source STRING, metadata STRING")
    out = EX.merge_response(base, resp, "k")
    assert sorted(out.columns) == ["k", "source", "title"] and out.first().source == "model"


def test_merge_response_keeps_postings_without_one_and_repeats_none(spark):
    base = spark.createDataFrame([(1, "p", ["e"]), (2, "p", ["e2"]), (None, "p", None)], "k INT, source STRING, result ARRAY<STRING>")
    resp = spark.createDataFrame([(1, "m", "x"), (1, "n", "y"), (None, "z", "z")], "k INT, source STRING, content STRING")
    out = sorted(map(tuple, EX.merge_response(base, resp, "k").collect()), key=repr)
    assert out == sorted([(1, "m", ["e"], "x"), (2, "p", ["e2"], None), (None, "p", None, None)], key=repr)


def test_dictionary_extraction_counts_unigrams_and_bigrams(spark):
    d = spark.createDataFrame([(1, "Power BI and power bi; Excel")], "doc_id INT, text STRING")
    dic = EX.dictionary_frame(spark, {"powerbi": ["power bi"], "excel": ["excel"]})
    got = {r.term: r.n_mentions for r in EX.extract_by_dictionary(d, dic).collect()}
    assert got == {"powerbi": 2, "excel": 1}


def test_production_aliases_of_any_length_and_marks(spark):
    from skilltrends import rules as R
    texts = [(1, "Natural language\nprocessing with Microsoft Power BI."), (2, "C++, node.js and c# on AWS"), (3, None)]
    d = spark.createDataFrame(texts, "doc_id INT, text STRING")
    dic = EX.dictionary_frame(spark, {**R.ALIASES, "cpp": ["c++"], "node": ["node.js"], "csharp": ["C#"]})
    got = {(r.doc_id, r.term) for r in EX.extract_by_dictionary(d, dic).collect()}
    assert got == {(1, "nlp"), (1, "powerbi"), (2, "cpp"), (2, "node"), (2, "csharp"), (2, "aws")}


def test_keyword_union_sorted_and_filled(spark):
    items = spark.createDataFrame([("j1", "b"), ("j1", "a"), ("j1", "a"), ("j2", "c")], "job_key STRING, keyword STRING")
    out = {r.job_key: r.keyword for r in NZ.fill_keywords(items).collect()}
    assert out == {"j1": ["a", "b"], "j2": ["c"]}


def test_first_seen_keeps_whole_first_row(spark):
    df = spark.createDataFrame([(1, 5, None), (1, 3, "x"), (1, 3, "y"), (2, 1, "z")],
                               "k INT, t INT, v STRING")
    out = {r.k: (r.t, r.v) for r in NZ.first_seen(df, "k", ["t", "v"]).collect()}
    assert out == {1: (3, "x"), 2: (1, "z")}


def test_budget_minutes(spark):
    df = spark.createDataFrame([(59999, 0), (60000, 1), (10, 500)], "cum LONG, idx LONG")
    got = [r[0] for r in df.select(PL.budget_minutes("cum", "idx")).collect()]
    assert got == [0, 1, 1]


def test_reconcile_and_status(spark):
    a = spark.createDataFrame([("d1",), ("d1",), ("d2",)], "day STRING")
    b = spark.createDataFrame([("d1",), ("d1",)], "day STRING")
    rec = {r.day: (r.n_in, r.n_out, r.consistent) for r in QA.reconcile(a, b, "day").collect()}
    assert rec == {"d1": (2, 2, True), "d2": (1, 0, False)}
    ev = spark.createDataFrame([("d1", "ok"), ("d1", "error")], "day STRING, t STRING")
    st = QA.run_status(ev, "day", F.col("t") == "error").first()
    assert (st.started, st.succeeded, st.failed, st.other_errors) == (2, 1, 1, 1)
    kinds = spark.createDataFrame([("d", x) for x in ("ok", "429", "429", "500", "boom", None)], "day STRING, t STRING")
    st = QA.run_status(kinds, "day", F.col("t") != "ok", F.col("t") == "429", F.col("t") == "500").first()
    assert tuple(st)[1:] == (6, 2, 4, 2, 1, 1)


def test_union_by_name_fills_missing(spark):
    a = spark.createDataFrame([(1,)], "id INT")
    b = spark.createDataFrame([(2, "x")], "id INT, extra STRING")
    rows = sorted(map(tuple, J.union_by_name([a, b]).collect()))
    assert rows == [(1, None), (2, "x")]


def test_lemmatize_keeps_unknown_tokens(spark):
    from skilltrends.operators import select_text as ST
    toks = spark.createDataFrame([(1, "running"), (1, "sql"), (2, "ran")], "doc_id INT, token STRING")
    lem = spark.createDataFrame([("running", "run"), ("ran", "run")], "token STRING, lemma STRING")
    got = sorted(map(tuple, ST.lemmatize(toks, lem).collect()))
    assert got == [(1, "run"), (1, "sql"), (2, "run")]


def test_relational_scoring_equals_mllib_margin(spark):
    from pyspark.ml.functions import vector_to_array

    from skilltrends.operators import relevance as RV
    from skilltrends.operators import select_text as ST

    from .conftest import SMOKE
    docs = spark.read.parquet(f"{SMOKE}/documents.parquet").select("doc_id", "text")
    lab = spark.read.parquet(f"{SMOKE}/labels.parquet").select("doc_id", F.col("quality").cast("double").alias("label"))
    train = docs.join(lab, "doc_id")
    from skilltrends import session as S
    # reloaded: a loaded model carries no training summary (see plans.daily.daily_run)
    model = RV.load(RV.save(RV.train(train, width=4096, max_iter=10), S.scratch_path(spark, "t-model")))
    margin = {r.doc_id: r.m for r in model.transform(train).select(
        "doc_id", F.get(vector_to_array("rawPrediction"), 1).alias("m")).collect()}

    idf, coef, intercept = RV.model_tables(spark, model)
    units = train.select("doc_id", F.lit(0).alias("pos"), F.col("text").alias("passage"))
    tf = ST.term_frequencies(units)
    place = RV.columns_of(tf.select("token").distinct(), 4096)
    tf = tf.join(place, "token").groupBy("doc_id", "pos", "column").agg(F.sum("tf").alias("tf")).withColumnRenamed("column", "token")
    idf, coef = (x.withColumnRenamed("column", "token") for x in (idf, coef))
    scores = ST.linear_scores(tf, idf, coef, intercept)
    got = {r.doc_id: r.score for r in scores.collect()}
    assert got.keys() == margin.keys()
    assert max(abs(got[k] - margin[k]) for k in got) < 1e-9


def test_threshold_for_recall_is_the_highest_that_holds(spark):
    from skilltrends.operators import quality as QA
    rng = __import__("random").Random(5)
    rows = [(round(rng.random(), 2), int(rng.random() < 0.5)) for _ in range(9000)] + [(None, 1), (0.5, None)]
    df = spark.createDataFrame(rows, "s DOUBLE, y INT").repartition(4)
    rated = [(s, y) for s, y in rows if s is not None and y is not None]
    n = sum(y for _, y in rated)
    for recall in (0.0, 0.5, 0.95, 1.0):
        t = QA.threshold_for_recall(df, "s", "y", recall).first()
        want = max(c for c, _ in rated if sum(y for s, y in rated if s >= c) >= recall * n)
        kept = [y for s, y in rated if s >= want]
        assert (t.threshold, t.n_positive, t.n_kept) == (want, n, len(kept))
        assert abs(t.recall - sum(kept) / n) < 1e-12 and abs(t.precision - sum(kept) / len(kept)) < 1e-12
    assert QA.threshold_for_recall(df.filter("y = 0"), "s", "y", 0.9).collect() == []
