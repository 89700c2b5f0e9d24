"""Golden vectors: the reference's two unit tests and cases derived from its code."""

from pyspark.sql import functions as F

from skilltrends import rules as R
from skilltrends.functions import terms as T
from skilltrends.operators import clean as C
from skilltrends.operators import normalize as NZ
from skilltrends.operators import select_text as ST
from skilltrends.operators import views as V
from skilltrends.sources import jsonl as J


def one_array(spark, items):
    return spark.createDataFrame([(items,)], "t ARRAY<STRING>")


def test_remove_terms_vector_a(spark):
    patterns = [r"\bskills\b", r"\banalyst\b", r"\bdocumentation\b", r"\bprototyping tools\b"]
    df = one_array(spark, ["excel skills", "powerbi analyst", "documentation guide", "prototype", "test"])
    assert df.select(T.remove_matching("t", patterns)).first()[0] == ["prototype", "test"]


def test_map_terms_vector_b(spark):
    items = ["ai tech", "gcp", "rgoogleey", "laws", "aws lambda", "ms excel", "excellant", '"ai"', '["ai"]']
    expected = ["ai", "google", "rgoogleey", "laws", "aws", "excel", "excellant", "ai", "ai"]
    df = one_array(spark, items)
    assert df.select(T.map_first_match("t", R.MAP_RULES)).first()[0] == expected


def test_both_vectors_with_rules_loaded_from_files(spark):
    from skilltrends import session as S
    from skilltrends.sources import rulefiles as RF
    words, maps = S.scratch_path(spark, "t-words"), S.scratch_path(spark, "t-maps")
    RF.stage_text(spark, "skills\nanalyst\n\ndocumentation\nprototyping tools\n", words)
    RF.stage_text(spark, "\n".join(f"{p}, {r}" for p, r in R.MAP_RULES), maps)
    patterns = [r["pattern"] for r in sorted(C.inline_rows(RF.load_word_patterns(spark, words)))]
    df = one_array(spark, ["excel skills", "powerbi analyst", "documentation guide", "prototype", "test"])
    assert df.select(T.remove_matching("t", patterns)).first()[0] == ["prototype", "test"]
    items = ["ai tech", "gcp", "rgoogleey", "laws", "aws lambda", "ms excel", "excellant", '"ai"', '["ai"]']
    terms = spark.createDataFrame(list(enumerate(items)), "i INT, term STRING")
    rules = RF.load_mapping_rules(spark, maps)
    got = [r.mapped for r in sorted(C.map_terms_by_table(terms, rules).collect())]
    assert got == ["ai", "google", "rgoogleey", "laws", "aws", "excel", "excellant", "ai", "ai"]


def test_ranks_are_unique_over_a_folder_of_rule_files(spark):
    from skilltrends import session as S
    from skilltrends.sources import rulefiles as RF
    root = S.scratch_path(spark, "t-folder")
    for name, text in (("a", "x, 1\ny, 2"), ("b", "x, 3\nz, 4")):
        RF.stage_text(spark, text, f"{root}/{name}")
    rules = RF.load_mapping_rules(spark, f"{root}/*")
    assert [tuple(r) for r in sorted(rules.collect())] == [(0, "x", "1"), (1, "y", "2"), (2, "x", "3"), (3, "z", "4")]


def test_unicode_case_and_word_boundaries(spark):
    df = one_array(spark, ["\u00c9COLE", "caf\u00e9s", "caf\u00e9 x"])
    assert df.select(T.remove_matching("t", [r"\b\u00e9cole\b", r"\bcaf\b"])).first()[0] == ["caf\u00e9s", "caf\u00e9 x"]


def test_options_for_pay_types_and_blank_items(spark):
    df = spark.createDataFrame([(10.0, None, "MONTHLY"), (1.0, 2.0, "HOURLY")], "salary_min DOUBLE, salary_max DOUBLE, salary_type STRING")
    assert [tuple(r) for r in NZ.annualize(df, factors={"MONTHLY": 12}).collect()] == [(120.0, None, "YEARLY"), (2080.0, 4160.0, "YEARLY")]
    df = spark.createDataFrame([("[]",), ("[a,, b]",)], "c STRING")
    assert [r[0] for r in df.select(T.parse_bracket_list("c", drop_blank=True)).collect()] == [[], ["a", "b"]]


def test_remove_then_map_order(spark):
    # removal runs first; a mapped term is not re-tested for removal
    df = spark.createDataFrame([(["amazon analytics", "amazon", "visualization"],)], "cleaned_techs ARRAY<STRING>")
    out = C.clean_terms(df).first()["cleaned_techs"]
    assert out == ["aws"]


def test_map_does_not_dedupe(spark):
    df = one_array(spark, ["amazon", "aws"])
    assert df.select(T.map_first_match("t", R.MAP_RULES)).first()[0] == ["aws", "aws"]


def test_null_terms_row_dropped_and_null_item_untouched(spark):
    df = spark.createDataFrame([(None,), (["aws", None],)], "cleaned_techs ARRAY<STRING>")
    rows = C.clean_terms(df).collect()
    assert [r["cleaned_techs"] for r in rows] == [["aws", None]]


def test_parse_list_cases(spark):
    df = spark.createDataFrame([("[a, b]",), ("[]",), (" [a]",), ("none",), ('["a","b"]',), (None,)], "c STRING")
    got = [r[0] for r in df.select(T.parse_bracket_list("c")).collect()]
    assert got == [["a", "b"], [""], [], [], ['"a"', '"b"'], []]


def test_stoplist_and_alias(spark):
    df = one_array(spark, ["Data Analysis", "python skills", "MS Excel", "Azure"])
    kept = df.select(T.drop_stoplisted("t", R.STOP_EXACT, R.STOP_PARTIAL).alias("t"))
    assert kept.first()[0] == ["MS Excel", "Azure"]
    assert kept.select(T.canonicalize("t", R.alias_pairs())).first()[0] == ["excel", "azure"]


def test_passages_k2_with_blank_line(spark):
    text = "a\nb\n\nd\ne\nf\ng\nh"
    df = spark.createDataFrame([(1, text)], "doc_id INT, text STRING")
    k = 2
    for remainder, more in (("drop", []), ("keep", ["h"])):
        got = df.select(F.posexplode(ST.passage_blocks("text", F.lit(k), remainder))).orderBy("pos").collect()
        assert [r["col"] for r in got] == ["a\nb", "d\ne", "f\ng", *more]


def test_passages_short_doc_kept_or_dropped(spark):
    df = spark.createDataFrame([(1, "one\ntwo"), (2, "a\nb\nc\nd\ne\nf")], "doc_id INT, text STRING")
    assert ("one\ntwo",) in {(r.passage,) for r in ST.passages(df).collect()}
    rows = ST.passages(df, short_docs="drop").collect()
    # doc 1 has k = 0 (dropped); doc 2 has 5 newlines -> k = 1 -> one passage per line
    assert sorted((r.doc_id, r.pos, r.passage) for r in rows) == [(2, i, c) for i, c in enumerate("abcdef")]


def test_salary_choice_and_annualize(spark):
    rows = [((10.0, 20.0, "HOURLY"), (1.0, 2.0, "YEARLY")), (None, (90000.0, None, "YEARLY")), (None, None)]
    schema = "info STRUCT<min: DOUBLE, max: DOUBLE, type: STRING>, est STRUCT<min: DOUBLE, max: DOUBLE, type: STRING>"
    df = spark.createDataFrame(rows, schema)
    chosen = df.select(NZ.choose_salary("info", "est").alias("s")).select("s.*")
    out = [tuple(r) for r in NZ.annualize(chosen).collect()]
    assert out == [(20800.0, 41600.0, "YEARLY", 0), (90000.0, None, "YEARLY", 1), (None, None, None, 0)]


def test_page_offsets(spark):
    df = spark.createDataFrame([(45,), (0,), (1001,)], "n INT")
    got = [r[0] for r in df.select(NZ.page_offsets("n")).collect()]
    assert got == [[0, 10, 20, 30, 40, 50], [0], list(range(0, 1011, 10))]
    capped = [r[0] for r in df.select(NZ.page_offsets("n", threshold=R.HIT_THRESHOLD)).collect()]
    assert capped == [[0, 10, 20, 30, 40, 50], [0], [0, 10, 20, 30, 40, 50]]


def test_date_from_file_name(spark):
    df = spark.createDataFrame([("/shared/landing/postings_19_02_2024.json",), ("x/no_date.json",)], "p STRING")
    d, m, y = J.date_from_path("p")
    assert [tuple(r) for r in df.select(d, m, y).collect()] == [(19, 2, 2024), (None, None, None)]


def test_view_fanout_cases(spark):
    posts = spark.createDataFrame(
        [("k", ["aws", "sql"], 2024, 2, 19), ("e", [], 2024, 2, 19), ("n", None, 2024, 2, 19),
         ("d", ["aws"], 2024, 2, 19), ("d", ["aws"], 2024, 2, 20)],
        "job_key STRING, cleaned_techs ARRAY<STRING>, year INT, month INT, day INT")
    kws = spark.createDataFrame(
        [("k", ["k1", "k2"]), ("e", ["k1"]), ("n", ["k1"]), ("d", ["k1"]), ("d", ["k2"])],
        "job_key STRING, keyword ARRAY<STRING>")
    rows = V.jobs_view(posts, kws).collect()
    by_key = {}
    for r in rows:
        by_key.setdefault(r.job_key, []).append(r)
    assert len(by_key["k"]) == 4
    assert "e" not in by_key and "n" not in by_key
    # one term on two days, two keywords -> one row per (day, keyword): 4 rows
    assert len(by_key["d"]) == 4


def test_a_keyword_seen_on_two_days_counts_twice_in_the_weights(spark):
    posts = spark.createDataFrame([("d", ["aws", "aws"], 2024, 2, 19), ("d", ["aws"], 2024, 2, 20)],
                                  "job_key STRING, cleaned_techs ARRAY<STRING>, year INT, month INT, day INT")
    kws = spark.createDataFrame([("d", ["k1"]), ("d", ["k1", "k2"]), (None, ["k1"])], "job_key STRING, keyword ARRAY<STRING>")
    view = V.jobs_view_weighted(posts, kws)
    assert sorted((r.kw, str(r.job_date), r.weight) for r in view.collect()) == [
        ("k1", "2024-02-19", 2), ("k1", "2024-02-19", 2), ("k1", "2024-02-20", 2),
        ("k2", "2024-02-19", 1), ("k2", "2024-02-19", 1), ("k2", "2024-02-20", 1)]
    # a plain un-nest join has 3 terms x 3 keyword rows
    assert view.agg(F.sum("weight")).first()[0] == 9
    assert V.jobs_view(posts, kws).count() == 6
    audit = {(r.kw, r.job_date.day): r.n_rows for r in V.fanout_audit(view).collect()}
    assert audit == {("k1", 19): 4, ("k1", 20): 2, ("k2", 19): 2}
