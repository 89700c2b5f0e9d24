"""End to end over landed posting files: select -> extract -> clean -> day layer -> SQL view."""

from pyspark.sql import functions as F

from skilltrends import session as S
from skilltrends.operators import extract as EX
from skilltrends.plans import daily as D

DESC_A = "\n".join(["We use python and sql daily", "Team lunch on fridays", "Parking available",
                    "Python and amazon cloud", "Free coffee", "Gym on site"])
DESC_B = "\n".join(["Great team", "Nice office", "Flexible hours", "Good pay", "Free coffee", "Gym"])


def land(spark, root, name, rows):
    df = spark.createDataFrame(rows, "job_key STRING, keyword ARRAY<STRING>, job_description STRING")
    df.coalesce(1).write.mode("overwrite").json(f"{root}/{name}")


def test_daily_run_to_sql_view(spark):
    landing = S.scratch_path(spark, "t-postings")
    land(spark, landing, "postings_19_02_2024.json",
         [("a", ["data engineer"], DESC_A), ("b", ["data analyst"], DESC_B)])
    land(spark, landing, "postings_20_02_2024.json", [("a", ["data scientist"], DESC_A)])
    coef = spark.createDataFrame([("python", 6.0)], "token STRING, coef DOUBLE")
    dictionary = EX.dictionary_frame(spark, {"python": ["python"], "sql": ["sql"], "aws": ["amazon", "aws"]})
    metrics: dict = {}
    clean = D.daily_run(spark, landing, S.scratch_path(spark, "t-clean"), coef, -1.0, 0.5, dictionary,
                        metrics=metrics)
    assert metrics["lines_read"] == 3 and metrics["corrupt_lines"] == 0 and metrics["rows_written"] == 2

    rows = sorted((r.job_key, r.day, r.split_jd, tuple(r.cleaned_techs)) for r in clean.collect())
    split = "We use python and sql daily Python and amazon cloud"
    assert rows == [("a", 19, split, ("aws", "python", "sql")), ("a", 20, split, ("aws", "python", "sql"))]

    view = D.jobs_view_sql(spark, clean)
    got = sorted((r.tech, str(r.job_date), r.kw) for r in view.collect())
    assert len(got) == 12
    assert ("python", "2024-02-19", "data scientist") in got and ("sql", "2024-02-20", "data engineer") in got
    n = spark.sql("SELECT count(DISTINCT job_key) AS n FROM jobs_view WHERE tech = 'aws'").first().n
    assert n == 1


def job_page(desc, company="  ACME Corp ", title="Data Engineer ", info=None, est=None, header=True):
    import json
    blob = {"jobInfoWrapperModel": {"jobInfoModel": {
                "sanitizedJobDescription": desc,
                "jobInfoHeaderModel": {"companyName": company, "jobTitle": title} if header else None}},
            "salaryInfoModel": info,
            "salaryGuideModel": {"estimatedSalaryModel": est}}
    return f"<html><script>window._initialData={json.dumps(blob)};</script><body>x</body></html>"


def test_collect_stage_from_pages(spark):
    pages = spark.createDataFrame([
        ("k1", "data engineer", job_page("<p>Use <b>python</b></p>\n<p>and sql</p>",
                                        info={"salaryMin": 10, "salaryMax": 20, "salaryType": "HOURLY"},
                                        est={"min": 1, "max": 2, "type": "YEARLY"})),
        ("k1", "data analyst", job_page("<p>Use python</p>", est={"min": 90000, "max": None, "type": "YEARLY"})),
        ("k2", "data engineer", job_page("", header=False)),
        ("k3", "data engineer", "<html>no blob here</html>"),
    ], "job_key STRING, keyword STRING, html STRING")
    pages = pages.selectExpr("*", "1 AS from_age", "'remote' AS location", "1 AS page", "0 AS position",
                             "concat('u/', job_key) AS url")
    from skilltrends.plans import daily as D
    postings, bad = D.collect_stage(pages)
    rows = sorted(postings.collect(), key=lambda r: (r.job_key, r.job_description))
    assert [r.job_key for r in bad.collect()] == ["k3"]
    k1a, k1b, k2 = rows
    assert (k1a.salary_min, k1a.salary_max, k1a.salary_type, k1a.salary_estimated_flag) in {
        (20800.0, 41600.0, "YEARLY", 0), (90000.0, None, "YEARLY", 1)}
    assert {(r.salary_min, r.salary_estimated_flag) for r in (k1a, k1b)} == {(20800.0, 0), (90000.0, 1)}
    assert k1a.keyword == ["data analyst", "data engineer"] and k1b.keyword == k1a.keyword
    assert k1a.company == "acme corp" and k1a.job_title == "data engineer"
    # text nodes joined by one space: "Use ", "python", "\n", "and sql"
    assert {k1a.job_description, k1b.job_description} == {"Use python", "Use  python \n and sql"}
    assert (k2.company, k2.job_title, k2.job_description, k2.salary_min, k2.salary_estimated_flag) == \
        ("", "", "", None, 0)


def test_stream_run_equals_batch_run(spark):
    from skilltrends.operators import select_text as ST
    from skilltrends.schemas import POSTING
    from skilltrends.sources import jsonl as J
    from skilltrends.sources import versioned as VS
    landing = S.scratch_path(spark, "t-stream-postings")
    land(spark, landing, "postings_19_02_2024.json",
         [("a", ["data engineer"], DESC_A), ("b", ["data analyst"], DESC_B)])
    land(spark, landing, "postings_20_02_2024.json", [("a", ["data scientist"], DESC_A)])
    coef = spark.createDataFrame([("python", 6.0)], "token STRING, coef DOUBLE")
    dictionary = EX.dictionary_frame(spark, {"python": ["python"], "sql": ["sql"], "aws": ["amazon", "aws"]})
    texts = J.scan_jsonl(spark, landing, POSTING).select(F.col("job_description").alias("text"),
                                                          F.lit(0).alias("doc_id"))
    idf = ST.fit_idf(ST.passages(texts))  # the fitted model both runs score with

    batch = D.daily_run(spark, landing, S.scratch_path(spark, "t-b"), coef, -1.0, 0.5, dictionary, idf=idf)
    sink, ckpt = S.scratch_path(spark, "t-s"), S.scratch_path(spark, "t-s-ckpt")
    D.stream_run(spark, landing, sink, ckpt, coef, -1.0, 0.5, idf, dictionary)
    D.stream_run(spark, landing, sink, ckpt, coef, -1.0, 0.5, idf, dictionary)  # rerun: no new files
    cols = ["job_key", "day", "split_jd", "cleaned_techs"]
    as_set = lambda df: sorted((r.job_key, r.day, r.split_jd, tuple(r.cleaned_techs)) for r in df.select(cols).collect())
    assert as_set(VS.read_live(spark, sink)) == as_set(batch) and len(as_set(batch)) == 2


def test_broken_blobs_are_quarantined(spark):
    pages = spark.createDataFrame([("k1", "a", "<script>_initialData={\"x\": };</script>"), ("k2", "a", job_page("<p>caf&eacute; &mdash; it&#8217;s</p>"))],
                                  "job_key STRING, keyword STRING, html STRING")
    pages = pages.selectExpr("*", "1 AS from_age", "'r' AS location", "1 AS page", "0 AS position", "'u' AS url")
    good, bad = D.collect_stage(pages)
    assert [(r.job_key, r.result) for r in bad.collect()] == [("k1", ["data blob is not a JSON object"])]
    assert [r.job_description for r in good.collect()] == ["caf\u00e9 \u2014 it\u2019s"]
