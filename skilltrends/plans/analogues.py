"""Posting-shaped inputs built from the test tables, and rule sets over their words.

The test tables hold no job postings, so each stage runs on an analogue:

* a *posting-day* is a lineitem row: key ``l_orderkey``, day ``l_shipdate``, and its
  term list ``[p_name, lower(p_type)]`` from the part it names (a per-row array: no
  grouping is needed to build it);
* the search *keywords* of a posting are ``[o_orderpriority, o_orderstatus]`` of the order;
* job descriptions are ``documents.text``, raw pages are ``pages.html``;
* chat requests are ``conversations`` turns.

The production rule values live in :mod:`skilltrends.rules`; the rule sets below use
words that occur in the part vocabulary so that every rule fires on the test data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import table

# Rule sets over the part vocabulary (colours/sizes x widget names, part types).
REMOVE_PATTERNS = [r"\bgizmo\b", r"\bpromo\b", r"\bold anvil\b"]
MAP_RULES = [
    (r"\b(bolt|rod)\b", "fastener"),
    (r"\b(hot|cold)\b", "thermal"),
    (r"\b(gear|widget)\b", "mechanism"),
    (r"\b(small|large)\b", "sized"),
]
STOP_EXACT = ["small ring", "economy", "new plate"]
STOP_PARTIAL = ["anvil", "blue"]
ALIASES = {"size class": ["small", "medium", "large"],
           "price class": ["economy", "standard", "promo"]}


def postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(job_key, line_no, cleaned_techs, year, month, day) — one row per posting-day."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
    pa = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
    j = li.join(pa, li.l_partkey == pa.p_partkey, "inner")
    return j.select(
        F.col("l_orderkey").alias("job_key"),
        F.col("l_linenumber").alias("line_no"),
        F.array(F.col("p_name"), F.lower("p_type")).alias("cleaned_techs"),
        F.year("l_shipdate").alias("year"),
        F.month("l_shipdate").alias("month"),
        F.dayofmonth("l_shipdate").alias("day"),
    )


def keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(job_key, keyword) — the search keywords that found each posting."""
    o = table(spark, sf_dir, "orders")
    return o.select(F.col("o_orderkey").alias("job_key"),
                    F.array("o_orderpriority", "o_orderstatus").alias("keyword"))


def keywords_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(job_key, keyword) with a row for each day on which a search found the posting: here each
    lineitem's ship mode and its order's status, so a posting names a keyword several times."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_returnflag", "l_linestatus")
    return li.select(F.col("l_orderkey").alias("job_key"), F.array("l_returnflag", "l_linestatus").alias("keyword"))


# Token -> lemma over frequent description words.
LEMMAS = [("an", "a"), ("are", "be"), ("is", "be"), ("was", "be"), ("der", "die"), ("das", "die"), ("les", "le"), ("la", "le"), ("los", "el")]


def lemma_frame(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(LEMMAS, "token STRING, lemma STRING")


# Pre-fitted relevance model over frequent description words (token, coefficient).
RELEVANCE_COEF = [
    ("the", 1.5), ("of", 1.0), ("and", 0.8), ("is", 0.6), ("that", 0.9),
    ("de", -0.5), ("der", -1.2), ("la", -0.7), ("und", -1.0), ("que", -0.4),
]
RELEVANCE_INTERCEPT = -0.3
RELEVANCE_THRESHOLD = 0.4

# Endpoint patterns tried in order against page URLs (secure first, then plain).
URL_PATTERNS = [r"^https://[^/]+/[a-z]{2}/(.+)$", r"^http://[^/]+/[a-z]{2}/(.+?)(\?|$)"]

# Embedded blob in a page: the argument of the tracking call.
BLOB_PATTERN = r"track\((.+?)\);"
TITLE_PATTERN = r"(?is)<title>(.*?)</title>"


def coef_frame(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(RELEVANCE_COEF, "token STRING, coef DOUBLE")


# Pay analogue: order priority stands for the pay type, total price for the amount.
PAY_TYPE_SQL = ("CASE o_orderpriority WHEN '1-URGENT' THEN 'HOURLY' WHEN '3-MEDIUM' THEN 'MONTHLY' "
                "WHEN '4-NOT SPECIFIED' THEN NULL ELSE 'YEARLY' END")

# Search grid: keywords are nation names, hits are the customers of the nation.
SEARCH_BASE = "https://jobs.example.com/jobs"
SEARCH_LOCATIONS = ["remote", "onsite"]

# Search result list inside a page: the navigation links.
RESULT_LINK_PATTERN = r'<li><a href="/([^"]*)"'
PAGE_PARAM_PATTERN = r"[?&]page=(\d+)"

# Chat request analogue.
PROMPT_SYSTEM = "You list the technologies a job description asks for, as [a, b, c]."
PROMPT_EXAMPLES = [("Experience with cloud storage and spreadsheets.", "[aws, excel]"),
                   ("Build dashboards for reporting.", "[powerbi]")]
PROMPT_QUESTION = "List the technologies in:"
PROMPT_MODEL = "term-extractor"
PROMPT_TEMPERATURE = 0.0

# Model answers built from part rows (bracketed list, malformed, empty, missing).
ANSWER_SQL = ("CASE WHEN p_size < 5 THEN ' [' || p_name || ']' WHEN p_size > 47 THEN 'none' "
              "WHEN p_size = 10 THEN '[]' "
              "ELSE '[' || replace(p_name, ' ', ', ') || ', ' || lower(p_type) || ']' END")

# Dictionary over frequent description words (canonical -> aliases of one to three words).
TERM_DICTIONARY = {
    "three-words": ["of the and", "the and of", "Is and the"],
    "of-the": ["of the"],
    "in-the": ["in the"],
    "conjunction": ["and", "und", "et", "y"],
    "article": ["der", "die", "la", "le", "el", "les"],
    "that": ["that"],
}

RECENT_DAYS = 7
