"""The skills view and the questions it answers.

``jobs_view`` is the Spark form of the SQL view: terms of each posting-day joined to
the search keywords of the posting, both un-nested, with the day as a date.

Plan shape: the join runs *before* the un-nest, so the shuffle moves one row per
posting-day and one row per (posting, keyword) instead of terms x keywords rows.
The keyword side is reduced to distinct (posting, keyword) pairs first: a posting
seen on many days contributes each keyword once, so no key ever produces all pairs
of its day-rows, and every output row is bounded by the keyword vocabulary.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .joins import split_join


def date_from_parts(year="year", month="month", day="day"):
    """Calendar date from integer parts (NULL for impossible dates)."""
    y, m, d = (F.col(c) if isinstance(c, str) else c for c in (year, month, day))
    return F.try_make_timestamp_ntz(y, m, d, F.lit(0), F.lit(0), F.lit(0)).cast("date")


def keyword_sets(keywords: DataFrame, key: str = "job_key", kw_col: str = "keyword") -> DataFrame:
    """(key, _kws): the distinct keywords of each key, one row per key.

    ``collect_set`` is a partial aggregate: per-key state is bounded by the keyword
    vocabulary, and the result is already hash-partitioned on the key for the join."""
    pairs = keywords.select(key, F.explode(kw_col).alias("_kw")).where(F.col("_kw").isNotNull())
    return pairs.groupBy(key).agg(F.collect_set("_kw").alias("_kws"))


def jobs_view(postings: DataFrame, keywords: DataFrame, key: str = "job_key",
              terms_col: str = "cleaned_techs", kw_col: str = "keyword", nested: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """(job_key, tech, job_date, kw): one row per term x keyword of each posting-day.

    ``postings`` has (key, terms array, year, month, day); ``keywords`` has
    (key, keyword array). Empty or NULL arrays yield no rows, like an inner un-nest.
    ``nested``: (job_key, techs, job_date, kws) and the columns of ``keep``, one row per posting-day, not un-nested.
    """
    p = (postings
         .where(F.size(terms_col) > 0)
         .select(key, F.col(terms_col).alias("_terms"),
                 date_from_parts("year", "month", "day").alias("job_date"), *keep))
    joined = split_join(p, keyword_sets(keywords, key, kw_col), key)
    if nested:
        return joined.select(key, F.col("_terms").alias("techs"), "job_date", F.col("_kws").alias("kws"), *keep)
    return (joined
            .select(key, F.explode("_terms").alias("tech"), "job_date", "_kws")
            .select(key, "tech", "job_date", F.explode("_kws").alias("kw")))


def weighted_keywords(keywords: DataFrame, key: str = "job_key", kw_col: str = "keyword") -> DataFrame:
    """(key, _kws): the distinct keywords of each key with the number of rows that name them."""
    pairs = keywords.select(key, F.explode(kw_col).alias("kw")).where(F.col("kw").isNotNull())
    counted = pairs.groupBy(key, "kw").agg(F.count(F.lit(1)).alias("weight"))
    return counted.groupBy(key).agg(F.collect_list(F.struct("kw", "weight")).alias("_kws"))


def jobs_view_weighted(postings: DataFrame, keywords: DataFrame, key: str = "job_key",
                       terms_col: str = "cleaned_techs", kw_col: str = "keyword") -> DataFrame:
    """:func:`jobs_view` with ``weight``: how many keyword rows of the posting name the keyword (the days on
    which it was seen). A plain un-nest join gives each row of this view ``weight`` times, so sums of
    weights are its counts, without a row for every pair of days."""
    per_key = weighted_keywords(keywords, key, kw_col)
    p = (postings.where(F.size(terms_col) > 0)
         .select(key, F.col(terms_col).alias("_terms"), date_from_parts("year", "month", "day").alias("job_date")))
    return (split_join(p, per_key, key)
            .select(key, F.explode("_terms").alias("tech"), "job_date", "_kws")
            .select(key, "tech", "job_date", F.inline("_kws")))


def demand_by_keyword(view: DataFrame) -> DataFrame:
    """Postings per (kw, tech). The distinct count is planned as a two-level aggregate,
    so a hot (kw, tech) pair is spread over its postings before the final count."""
    return view.groupBy("kw", "tech").agg(F.count_distinct("job_key").alias("n_postings"))


def demand_trend(postings: DataFrame, keywords: DataFrame, key: str = "job_key",
                 terms_col: str = "cleaned_techs", kw_col: str = "keyword") -> DataFrame:
    """Daily postings per tech with the previous day's figure, for postings found by any keyword.

    Which keyword it was doesn't matter, so the keyword side is a semi join. The window runs on the
    aggregated (tech, day) rows: one row per day per tech."""
    named = keywords.where(F.exists(kw_col, lambda k: k.isNotNull())).select(key)
    seen = (postings.where(F.size(terms_col) > 0).join(named, key, "left_semi")
            .select(key, F.explode(terms_col).alias("tech"), date_from_parts("year", "month", "day").alias("job_date")))
    daily = seen.groupBy("tech", "job_date").agg(F.count_distinct("job_key").alias("n_postings"))
    w = Window.partitionBy("tech").orderBy("job_date")
    return (daily
            .withColumn("prev_n_postings", F.lag("n_postings").over(w))
            .withColumn("prev_date", F.lag("job_date").over(w)))


def top_terms(view: DataFrame, k: int = 3) -> DataFrame:
    """The k most demanded techs per keyword (ties broken by tech name).

    Rank-filtered windows are planned with a group limit below the shuffle."""
    counts = demand_by_keyword(view)
    w = Window.partitionBy("kw").orderBy(F.desc("n_postings"), F.asc("tech"))
    return (counts.withColumn("rank", F.row_number().over(w))
            .where(F.col("rank") <= k))


def fanout_audit(view: DataFrame) -> DataFrame:
    """(job_key, tech, kw, job_date) that a plain un-nest join would give more than once, with how
    often: sums of the weights of :func:`jobs_view_weighted`."""
    return (view.groupBy("job_key", "tech", "kw", "job_date")
            .agg(F.sum("weight").alias("n_rows"))
            .where(F.col("n_rows") > 1))


def fanout_of(postings: DataFrame, keywords: DataFrame, key: str = "job_key",
              terms_col: str = "cleaned_techs", kw_col: str = "keyword") -> DataFrame:
    """:func:`fanout_audit` of :func:`jobs_view_weighted`, without grouping the view's rows: a (key, tech, day) comes as often
    as the postings hold it, times the keyword's weight, so it is counted before the keywords multiply it."""
    p = (postings.where(F.size(terms_col) > 0)
         .select(key, F.explode(terms_col).alias("tech"), date_from_parts("year", "month", "day").alias("job_date")))
    times = p.where(F.col(key).isNotNull()).groupBy(key, "tech", "job_date").agg(F.count(F.lit(1)).alias("_times"))
    return (split_join(times, weighted_keywords(keywords, key, kw_col), key)
            .select(key, "tech", "job_date", "_times", F.inline("_kws"))
            .select(key, "tech", "kw", "job_date", (F.col("_times") * F.col("weight")).alias("n_rows"))
            .where(F.col("n_rows") > 1))


# The view as Spark SQL, for users who query it with SQL. Same plan shape as
# jobs_view(): one keyword set per posting joined before both un-nests (see joins.py for the struct).
JOBS_VIEW_SQL = """
CREATE OR REPLACE TEMPORARY VIEW jobs_view AS
WITH t2 AS (
  SELECT job_key, collect_set(kw) AS kws
  FROM keywords_raw LATERAL VIEW explode(keyword) k AS kw
  WHERE kw IS NOT NULL
  GROUP BY job_key
),
t1 AS (
  SELECT job_key, cleaned_techs AS terms,
         CAST(try_make_timestamp_ntz(year, month, day, 0, 0, 0) AS DATE) AS job_date
  FROM data
  WHERE size(cleaned_techs) > 0
)
SELECT t1.job_key, tech, t1.job_date, kw
FROM t1 JOIN t2 ON struct(t1.job_key) = struct(t2.job_key) AND t1.job_key IS NOT NULL
LATERAL VIEW explode(t1.terms) a AS tech
LATERAL VIEW explode(t2.kws) b AS kw
"""


def register_sql_views(spark, clean: DataFrame, keywords: DataFrame) -> None:
    """Register ``data`` (clean layer), ``keywords_raw`` and ``jobs_view`` as temp views."""
    clean.createOrReplaceTempView("data")
    keywords.select("job_key", "keyword").createOrReplaceTempView("keywords_raw")
    spark.sql(JOBS_VIEW_SQL)
