"""Property tests against plain-Python statements of the semantics."""

import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from skilltrends import rules as R
from skilltrends.functions import terms as T
from skilltrends.operators import planning as PL
from skilltrends.operators import select_text as ST

WORDS = ["aws", "amazon", "excel", "skills", "ai", "data", "analysis", "google", "gcp", "tools", "x"]
term = st.lists(st.sampled_from(WORDS), min_size=1, max_size=3).map(" ".join)


@settings(max_examples=25, deadline=None)
@given(st.lists(st.lists(term, max_size=6), min_size=1, max_size=8))
def test_remove_and_map_match_python(spark, lists):
    df = spark.createDataFrame([(x,) for x in lists], "t ARRAY<STRING>")
    rows = df.select(T.remove_matching("t", R.REMOVE_PATTERNS).alias("r"),
                     T.map_first_match("t", R.MAP_RULES).alias("m")).collect()
    for src, row in zip(lists, rows):
        removed = [s for s in src if not any(re.search(p, s, re.I) for p in R.REMOVE_PATTERNS)]
        assert row.r == removed and set(row.r) <= set(src)

        def map_one(s):
            for p, rep in R.MAP_RULES:
                if re.search(p, s, re.I):
                    return rep
            return s
        assert row.m == [map_one(s) for s in src] and len(row.m) == len(src)


line = st.text(alphabet="ab c", min_size=0, max_size=6)


@settings(max_examples=40, deadline=None)
@given(st.lists(line, min_size=1, max_size=30), st.integers(min_value=1, max_value=4))
def test_passage_blocks_equal_findall(spark, lines, k):
    text = "\n".join(lines)
    df = spark.createDataFrame([(text, k)], "text STRING, k INT")
    got, whole = df.select(ST.passage_blocks("text", "k", "drop"), ST.passage_blocks("text", "k")).first()
    assert got == re.findall("\n".join(["[^\n]+"] * k), text)
    assert whole == re.findall("[^\n]+" + "(?:\n[^\n]+)?" * (k - 1), text)


@settings(max_examples=10, deadline=None)
@given(st.lists(st.integers(min_value=0, max_value=5000), min_size=1, max_size=60),
       st.integers(min_value=0, max_value=6))
def test_running_totals_match_cumsum(spark, values, parts):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id LONG, v LONG")
    out = PL.running_totals(df, "id", "v", num_partitions=parts or None, sum_col="cum", index_col="rn")
    rows = sorted(out.collect(), key=lambda r: r.id)
    run = 0
    for i, r in enumerate(rows):
        run += values[i]
        assert (r.rn, r.cum) == (i, float(run))


def test_tfidf_rows_are_unit_norm(spark):
    df = spark.createDataFrame([(1, "a b\nc d\nalpha beta beta\nx y\nalpha\nq r s t u v w")],
                               "doc_id INT, text STRING")
    p = ST.passages(df, n=1, short_docs="whole")
    w = ST.tfidf(ST.term_frequencies(p), ST.fit_idf(p))
    norms = w.groupBy("doc_id", "pos").agg(F.sum(F.col("weight") * F.col("weight")).alias("n2")).collect()
    assert norms and all(abs(r.n2 - 1.0) < 1e-9 for r in norms)


def py_parse_list(s):
    if s is None or not s.startswith("["):
        return []
    return [item.strip() for item in s.strip("[]").split(",")]


@settings(max_examples=30, deadline=None)
@given(st.lists(st.text(alphabet='[], a"\t', max_size=12), min_size=1, max_size=20))
def test_parse_list_matches_python(spark, answers):
    df = spark.createDataFrame([(a,) for a in answers], "c STRING")
    got = [r[0] for r in df.select(T.parse_bracket_list("c")).collect()]
    assert got == [py_parse_list(a) for a in answers]


@settings(max_examples=20, deadline=None)
@given(st.lists(st.integers(min_value=0, max_value=3000), min_size=1, max_size=20))
def test_page_offsets_match_python(spark, hits):
    from skilltrends.operators import normalize as NZ
    df = spark.createDataFrame([(h,) for h in hits], "n INT")
    got = df.select(NZ.page_offsets("n"), NZ.page_offsets("n", threshold=1000)).collect()
    assert [r[0] for r in got] == [list(range(0, h + 10, 10)) for h in hits]
    assert [r[1] for r in got] == [list(range(0, (50 if h > 1000 else h) + 10, 10)) for h in hits]
