"""The daily flow over real posting files, stage by stage.

landed postings (JSON lines, one file per day)
  -> relevant passages of each description (``split_jd``; postings without any dropped)
  -> technology terms (dictionary extraction, or a pluggable extractor with retries)
  -> cleaned terms (removal, then mapping) and the day from the file name
  -> clean layer, written by day (a re-delivered day replaces that day)
  -> ``jobs_view`` for SQL.

Each posting line gets a deterministic row id (a 128-bit digest of the line's fields and its file), so
the per-posting aggregations do not merge two different postings that share a key, and a
recomputed task produces the same ids. The lines are parsed once, into a table below the shared
checkpoint folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import rules as R
from .. import session as S
from ..operators import clean as C
from ..operators import extract as EX
from ..operators import pages as PG
from ..operators import select_text as ST
from ..operators import views as V
from ..functions import text as X
from ..operators import normalize as NZ
from ..schemas import JOB_PAGE_BLOB, POSTING, with_corrupt
from ..sources import jsonl as J
from ..sources import sinks as SK
from ..streaming import ingest as IN

RID = "_rid"

# FIXED VALUE (set by the site): what stands before the data blob of a job page, the object assigned to the
# page's initial-data variable.
JOB_PAGE_BLOB_MARKER = "_initialData="


def with_row_id(postings: DataFrame) -> DataFrame:
    cols = [F.col(c).cast("string") for c in postings.columns if c != RID]
    return postings.withColumn(RID, F.md5(F.to_json(F.array(*cols))))


def staged(df: DataFrame) -> DataFrame:
    """``df`` as a table below the shared checkpoint folder."""
    path = S.scratch_path(df.sparkSession, "postings")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def collect_stage(pages: DataFrame, html_col: str = "html") -> tuple[DataFrame, DataFrame]:
    """Landed job pages -> (postings, quarantined pages).

    ``pages`` carries the request fields (job_key, keyword, location, page, position,
    from_age, url) and the page ``html``. The embedded blob is parsed with an explicit
    schema; pay is the employer figure (flag 0), else the site estimate (flag 1), else
    NULL (flag 0), annualised; title and company lower-cased and stripped ('' when the
    header is missing); the description HTML becomes text. Every posting then carries
    the sorted union of the keywords it was found under. A page without a parsable blob
    is quarantined with its error instead of failing the run."""
    raw = PG.object_after(html_col, JOB_PAGE_BLOB_MARKER)
    # a permissive from_json gives a struct of NULLs for broken JSON, so validity is tested on its own
    valid = F.coalesce(F.schema_of_variant(F.try_parse_json("_raw")).startswith("OBJECT"), F.lit(False))
    parsed = pages.withColumn("_raw", raw).withColumn("_valid", valid).withColumn("_blob", F.from_json("_raw", JOB_PAGE_BLOB))
    reason = F.when(F.col("_raw").isNull(), "no data blob in page").otherwise("data blob is not a JSON object")
    bad = parsed.where(~F.col("_valid")).withColumn("result", F.array(reason)).drop("_blob", "_raw", "_valid")
    ok = parsed.where("_valid")
    job = F.col("_blob.jobInfoWrapperModel.jobInfoModel")
    header = job["jobInfoHeaderModel"]
    info, est = F.col("_blob.salaryInfoModel"), F.col("_blob.salaryGuideModel.estimatedSalaryModel")
    pay = NZ.choose_salary(
        F.when(info.isNotNull(), NZ.salary_struct(info["salaryMin"], info["salaryMax"], info["salaryType"])),
        F.when(est.isNotNull(), NZ.salary_struct(est["min"], est["max"], est["type"])))
    items = ok.select(
        "job_key", F.array("keyword").alias("keyword") if dict(ok.dtypes)["keyword"] == "string" else "keyword",
        "from_age", "location", "page", "position", "url",
        F.when(header.isNull(), F.lit("")).otherwise(header["jobTitle"]).alias("job_title"),
        F.when(header.isNull(), F.lit("")).otherwise(header["companyName"]).alias("company"),
        F.coalesce(job["sanitizedJobDescription"], F.lit("")).alias("job_description"),
        pay.alias("_pay")).select("*", "_pay.*").drop("_pay")
    items = NZ.normalize_posting(items)
    return NZ.fill_keywords(items, "job_key", "keyword"), bad


def select_stage(postings: DataFrame, coef: DataFrame, intercept: float, threshold: float,
                 idf: DataFrame | None = None, n: int = 5) -> DataFrame:
    """Postings with ``split_jd``; those without a relevant passage are dropped."""
    p = postings if RID in postings.columns else with_row_id(postings)
    # a posting without a description counts as an empty passage, and is dropped like one
    texts = p.withColumn("job_description", F.coalesce("job_description", F.lit("")))
    return ST.select_relevant(texts, idf, coef, intercept, threshold, key=RID, text_col="job_description", n=n, keep=tuple(p.columns))


def extract_stage(selected: DataFrame, dictionary: DataFrame | None = None,
                  extractor: Callable[[str], list[str]] | None = None,
                  max_attempts: int = R.MAX_ATTEMPTS) -> DataFrame:
    """Add ``cleaned_techs``: sorted distinct dictionary terms of ``split_jd`` (per-posting
    state bounded by the dictionary), or the answer of ``extractor`` (failed rows carry
    ``result`` instead)."""
    if extractor is not None:
        answers = EX.extract_with(selected.select(RID, "split_jd").dropDuplicates([RID]), EX.each(extractor), RID, "split_jd", max_attempts)
        return selected.join(answers, RID)
    return EX.with_dictionary_terms(selected, dictionary, "split_jd", "cleaned_techs")


def clean_stage(extracted: DataFrame, patterns: list[str] = R.REMOVE_PATTERNS,
                rules: list[tuple[str, str]] = R.MAP_RULES, path_col: str = "source_file") -> DataFrame:
    """Cleaned terms plus ``day, month, year`` from the posting file's name."""
    return J.with_file_date(C.clean_terms(extracted, patterns=patterns, rules=rules), path_col)


def enrich(postings: DataFrame, coef: DataFrame, intercept: float, threshold: float,
           dictionary: DataFrame | None = None, extractor: Callable[[str], list[str]] | None = None,
           patterns: list[str] = R.REMOVE_PATTERNS, rules: list[tuple[str, str]] = R.MAP_RULES,
           idf: DataFrame | None = None) -> DataFrame:
    """Stages 2-4 on scanned postings (with ``source_file``): select, extract, clean."""
    p = staged(with_row_id(postings))
    if J.CORRUPT_COL in p.columns:
        p = p.where(F.col(J.CORRUPT_COL).isNull()).drop(J.CORRUPT_COL)
    selected = select_stage(p, coef, intercept, threshold, idf)
    return clean_stage(extract_stage(selected, dictionary, extractor), patterns, rules).drop(RID)


def stream_run(spark: SparkSession, landing: str, sink: str, checkpoint: str | None, coef: DataFrame,
               intercept: float, threshold: float, idf: DataFrame, dictionary: DataFrame | None = None,
               extractor: Callable[[str], list[str]] | None = None, available_now: bool = True):
    """Each newly landed or changed posting file flows through stages 2-4 into the clean layer (a versioned
    sink, read with ``sources.versioned.read_live``); a rerun adds nothing, a file delivered again under its own
    path or a higher number replaces its rows. Scoring uses the fitted ``idf`` model, so a pass gives the same
    rows as a batch run over the same files."""
    def transform(batch: DataFrame) -> DataFrame:
        return enrich(batch, coef, intercept, threshold, dictionary, extractor, idf=idf)
    return IN.ingest(spark, landing, with_corrupt(POSTING), transform, sink, checkpoint,
                     available_now=available_now)


def daily_run(spark: SparkSession, landing: str, sink: str, coef: DataFrame, intercept: float,
              threshold: float, dictionary: DataFrame | None = None,
              extractor: Callable[[str], list[str]] | None = None,
              patterns: list[str] = R.REMOVE_PATTERNS, rules: list[tuple[str, str]] = R.MAP_RULES,
              metrics: dict | None = None, idf: DataFrame | None = None) -> DataFrame:
    """Run every stage over the landed files and write the clean layer by day.

    Returns the clean layer as read back from ``sink``. With ``metrics`` (a dict), the
    run's reconciliation is filled in from observations taken by the jobs themselves
    (no extra pass): lines read, corrupt lines, rows written, rows with an empty list.

    Note (Spark 4.1): once a session has used an ``Observation``, a freshly fitted
    logistic-regression model (which keeps a training summary referring to the session)
    fails to serialise its prediction closure; models loaded from storage carry no
    summary and are unaffected, which is how ``operators.relevance`` models are used."""
    from pyspark.sql import Observation
    seen, wrote = Observation("lines_read"), Observation("rows_written")
    postings = staged(with_row_id(J.scan_jsonl(spark, landing, POSTING)).observe(
        seen, F.count(F.lit(1)).alias("lines_read"),
        F.count_if(F.col(J.CORRUPT_COL).isNotNull()).alias("corrupt_lines")))
    good = postings.where(F.col(J.CORRUPT_COL).isNull()).drop(J.CORRUPT_COL)
    selected = select_stage(good, coef, intercept, threshold, idf)
    extracted = extract_stage(selected, dictionary, extractor)
    clean = clean_stage(extracted, patterns, rules).drop(RID).observe(
        wrote, F.count(F.lit(1)).alias("rows_written"),
        F.count_if(F.size("cleaned_techs") == 0).alias("empty_term_lists"))
    SK.write_daily(clean, sink)
    if metrics is not None:
        metrics.update(seen.get)
        metrics.update(wrote.get)
    return spark.read.parquet(sink)


def jobs_view_sql(spark: SparkSession, clean: DataFrame) -> DataFrame:
    """Register ``data`` / ``keywords_raw`` / ``jobs_view`` over the clean layer (the
    keyword table reads the same data, two columns) and return ``jobs_view``."""
    V.register_sql_views(spark, clean, clean.select("job_key", "keyword"))
    return spark.table("jobs_view")
