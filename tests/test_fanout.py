"""The fan-out audit counts before the keywords multiply the rows."""

from skilltrends.operators import views as V


def test_counts_before_the_keywords_equal_the_grouped_view(spark):
    p = spark.createDataFrame([("a", ["x", "y", "x"], 2024, 1, 2), ("a", ["x"], 2024, 1, 2), ("a", ["x", None], 2024, 2, 31), (None, ["x"], 2024, 1, 2),
                               ("b", [], 2024, 1, 2), ("c", ["z"], 2024, 1, 2), ("c", ["z"], 2024, 1, 2)],
                              "job_key STRING, cleaned_techs ARRAY<STRING>, year INT, month INT, day INT")
    k = spark.createDataFrame([("a", ["k", "l"]), ("a", ["k", None]), ("b", ["k"]), ("c", ["k"]), (None, ["k"])], "job_key STRING, keyword ARRAY<STRING>")
    want = sorted(map(repr, V.fanout_audit(V.jobs_view_weighted(p, k)).collect()))
    out = V.fanout_of(p, k)
    assert sorted(map(repr, out.collect())) == want and len(want) == 6
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate inline") < plan.index("Aggregate")  # nothing is grouped above the un-nest
