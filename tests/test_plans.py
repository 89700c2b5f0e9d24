"""Plan shape: per-row stages add no exchange, scans read only needed columns, the
view joins before it un-nests, skewed keys still give whole results."""

from pyspark.sql import functions as F

from skilltrends.operators import clean as C
from skilltrends.operators import views as V
from skilltrends.plans import analogues as A
from skilltrends.plans.queries import clean_layer

from .conftest import SMOKE


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_term_cleaning_is_per_row(spark):
    df = spark.read.parquet(f"{SMOKE}/part.parquet").select(F.array("p_name", "p_type").alias("cleaned_techs"))
    p = plan(C.clean_terms(df, patterns=A.REMOVE_PATTERNS, rules=A.MAP_RULES))
    assert "Exchange" not in p


def test_view_prunes_columns_and_unnests_after_join(spark):
    view = V.jobs_view(clean_layer(spark, SMOKE), A.keywords(spark, SMOKE))
    view.write.format("noop").mode("overwrite").save()
    p = plan(view)
    for unused in ("l_quantity", "l_extendedprice", "l_discount", "o_totalprice", "o_custkey", "p_retailprice"):
        assert unused not in p
    # both explodes sit above the join
    top = p.split("Join")[0]
    assert top.count("Generate explode") == 2


def test_view_with_one_hot_key_is_whole(spark):
    # one posting key holds a third of the rows: all its rows must be in the output
    rows = [("hot", ["t1", "t2"], 2024, 1, d % 28 + 1) for d in range(300)]
    rows += [(f"k{i}", ["t1"], 2024, 1, 1) for i in range(600)]
    posts = spark.createDataFrame(rows, "job_key STRING, cleaned_techs ARRAY<STRING>, year INT, month INT, day INT")
    kws = spark.createDataFrame([("hot", ["a", "b"])] + [(f"k{i}", ["a"]) for i in range(600)],
                                "job_key STRING, keyword ARRAY<STRING>")
    out = V.jobs_view(posts, kws)
    counts = dict(out.groupBy("job_key").count().collect())
    assert counts["hot"] == 300 * 2 * 2 and len(counts) == 601


def hot_rows(spark, n=40_000):
    """Half the rows on one key."""
    return spark.range(n).select(F.when(F.col("id") % 2 == 0, "hot").otherwise(F.col("id").cast("string")).alias("job_key"),
                                 F.uuid().alias("pad"), F.array(F.uuid()).alias("cleaned_techs"), F.lit(2024).alias("year"),
                                 F.lit(1).alias("month"), F.lit(1).alias("day"), F.lit("k").alias("keyword")).repartition(4)


def test_hot_keys_are_split_in_aggregated_joins(spark):
    from skilltrends.operators import extract as EX
    from skilltrends.operators import normalize as NZ
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        hot = hot_rows(spark)
        words = hot.select("job_key", F.array("keyword").alias("keyword"))
        V.register_sql_views(spark, hot, words)
        frames = {"view": (V.jobs_view(hot, words), 40_000), "weighted": (V.jobs_view_weighted(hot, words), 40_000),
                  "sql": (spark.table("jobs_view"), 40_000), "keywords": (NZ.fill_keywords(hot), 40_000),
                  "merge": (EX.merge_response(hot, hot.select("job_key", F.lit(1).alias("x")), "job_key"), 40_000)}
        for name, (df, n) in frames.items():
            rows = df.select(*df.columns[:2]).collect() if name != "keywords" else df.collect()
            assert len(rows) == n, name
            df.write.format("noop").mode("overwrite").save()
        for name, (df, _) in frames.items():
            df.collect()
            assert "skew=true" in plan(df), name
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_text_stays_out_of_the_scoring_shuffles(spark):
    from skilltrends.operators import select_text as ST
    docs = spark.read.parquet(f"{SMOKE}/documents.parquet").select("doc_id", "text")
    p = ST.passages(docs)
    for df in (p, ST.term_frequencies(p)):
        assert "Exchange" not in plan(df)
    idf = ST.fit_idf(p)
    for line in plan(ST.linear_scores(ST.term_frequencies(p), idf, A.coef_frame(spark), 0.0)).splitlines():
        assert "Exchange" not in line or "passage" not in line


def test_rule_table_in_chunks_and_through_the_index(spark, monkeypatch):
    rules = C.rules_frame(spark, A.MAP_RULES)
    terms = spark.createDataFrame([("hot bolt",), ("red widget",), ("new plate",), ("cold gear",)], "term STRING")
    expected = {"hot bolt": "fastener", "red widget": "mechanism", "new plate": "new plate", "cold gear": "thermal"}
    for per_case in (100, 3, 1):  # one expression, two, one per rule
        out = C.map_terms_by_table(terms, rules, per_case=per_case)
        assert "Join" not in plan(out) and "Exchange" not in plan(out)
        assert {r.term: r.mapped for r in out.collect()} == expected
    monkeypatch.setattr(C.RI, "INLINE", 3)  # a larger table
    assert {r.term: r.mapped for r in C.map_terms_by_table(terms, rules).collect()} == expected


def test_no_query_caps_or_samples_rows(spark):
    """Every registered query runs over whole tables: no LIMIT, no sampling in any plan
    (the per-group top-k of ``top_terms`` is its feature, not a row cap)."""
    import re

    from skilltrends.plans.queries import QUERIES
    for name, fn in QUERIES.items():
        plan = fn(spark, SMOKE)._jdf.queryExecution().optimizedPlan().toString()
        assert not re.search(r"\b(GlobalLimit|LocalLimit|Sample)\b", plan), name
