"""Posting normalisation, keyword union, search paging. Mostly per-row expressions;
the keyword union is one aggregation whose state per key is bounded by the keyword
vocabulary (partial aggregation de-duplicates before the shuffle)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import rules as R
from ..functions import text as X
from .joins import split_join


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- single postings -----------------------------------------------------------

def salary_struct(min_col, max_col, type_col) -> Column:
    return F.struct(_col(min_col).cast("double").alias("min"), _col(max_col).cast("double").alias("max"),
                    _col(type_col).cast("string").alias("type"))


def choose_salary(info, estimate) -> Column:
    """Employer figure (flag 0) if present, else the site estimate (flag 1), else NULLs (flag 0).

    ``info`` / ``estimate`` are NULL or struct(min, max, type)."""
    info, estimate = _col(info), _col(estimate)
    return (F.when(info.isNotNull(), F.struct(info["min"].alias("salary_min"), info["max"].alias("salary_max"),
                                              info["type"].alias("salary_type"),
                                              F.lit(0).alias("salary_estimated_flag")))
            .when(estimate.isNotNull(), F.struct(estimate["min"].alias("salary_min"),
                                                 estimate["max"].alias("salary_max"),
                                                 estimate["type"].alias("salary_type"),
                                                 F.lit(1).alias("salary_estimated_flag")))
            .otherwise(F.struct(F.lit(None).cast("double").alias("salary_min"),
                                F.lit(None).cast("double").alias("salary_max"),
                                F.lit(None).cast("string").alias("salary_type"),
                                F.lit(0).alias("salary_estimated_flag"))))


def annualize(df: DataFrame, min_col: str = "salary_min", max_col: str = "salary_max",
              type_col: str = "salary_type", factor: float = R.HOURS_PER_YEAR,
              factors: dict[str, float] | None = None) -> DataFrame:
    """Any non-NULL pay type other than YEARLY: amounts x factor, type := YEARLY.
    A NULL amount stays NULL. ``factors`` gives pay types factors of their own (say MONTHLY: 12); other
    types keep ``factor``."""
    t = F.col(type_col)
    convert = t.isNotNull() & (t != F.lit("YEARLY"))
    times = F.lit(float(factor))
    for name, x in sorted((factors or {}).items()):
        times = F.when(t == F.lit(name), F.lit(float(x))).otherwise(times)
    return (df.withColumn(min_col, F.when(convert, F.col(min_col) * times).otherwise(F.col(min_col)))
              .withColumn(max_col, F.when(convert, F.col(max_col) * times).otherwise(F.col(max_col)))
              .withColumn(type_col, F.when(convert, F.lit("YEARLY")).otherwise(t)))


def normalize_posting(df: DataFrame) -> DataFrame:
    """Title and company lower-cased and stripped; description HTML -> text; pay annualised."""
    out = df
    for c in ("job_title", "company"):
        if c in df.columns:
            out = out.withColumn(c, X.lower_strip(c))
    if "job_description" in df.columns:
        out = out.withColumn("job_description", X.html_to_text(F.coalesce(F.col("job_description"), F.lit(""))))
    if "salary_type" in df.columns:
        out = annualize(out)
    return out


def nested_sum(arr, field: str) -> Column:
    """Sum of ``field`` over an array of structs (0 for an empty array)."""
    return F.aggregate(_col(arr), F.lit(0).cast("bigint"),
                       lambda acc, x: acc + F.coalesce(x[field].cast("bigint"), F.lit(0).cast("bigint")))


# --- keywords of a posting ----------------------------------------------------

def keyword_union(items: DataFrame, key: str = "job_key", kw_col: str = "keyword") -> DataFrame:
    """(key, keywords): sorted distinct keywords seen for each key.

    ``kw_col`` may be a string or an array of strings."""
    is_array = dict(items.dtypes)[kw_col].startswith("array")
    kw = F.explode(kw_col) if is_array else F.col(kw_col)
    pairs = items.select(key, kw.alias("_kw")).where(F.col("_kw").isNotNull())
    return pairs.groupBy(key).agg(F.array_sort(F.collect_set("_kw")).alias("keywords"))


def fill_keywords(items: DataFrame, key: str = "job_key", kw_col: str = "keyword") -> DataFrame:
    """Replace each item's keyword list by the union over all items with its key."""
    union = keyword_union(items, key, kw_col)
    own = F.col(kw_col) if dict(items.dtypes)[kw_col].startswith("array") else F.array(kw_col)
    return (split_join(items, union, key, "left")
            .withColumn(kw_col, F.coalesce(F.col("keywords"), own)).drop("keywords"))


def first_seen(df: DataFrame, key: str, order_cols: list[str]) -> DataFrame:
    """One row per key: the whole first row by ``order_cols`` (NULL fields kept).

    ``min_by`` over a struct is a partial aggregate: each task keeps one row per key."""
    rest = [c for c in df.columns if c != key]
    best = F.min_by(F.struct(*rest), F.struct(*order_cols))
    return df.groupBy(key).agg(best.alias("_r")).select(key, *[F.col("_r")[c].alias(c) for c in rest])


# --- search paging ------------------------------------------------------------

def page_offsets(num_results, page_size: int = R.PAGE_SIZE, threshold: int | None = None,
                 capped: int = R.CAPPED_HITS) -> Column:
    """Offsets 0, 10, ... < n + 10. With ``threshold`` (the reference passes ``R.HIT_THRESHOLD``) a number
    of hits above it counts as ``capped``; without it every page is planned."""
    n = _col(num_results)
    if threshold is not None:
        n = F.when(n > F.lit(threshold), F.lit(capped)).otherwise(n)
    return F.sequence(F.lit(0), n + F.lit(page_size - 1), F.lit(page_size))


def search_url(base: str, keyword, location, offset, from_age=1) -> Column:
    def enc(c):
        return F.url_encode(_col(c).cast("string"))
    return F.concat(F.lit(base), F.lit("?q="), enc(keyword), F.lit("&l="), enc(location),
                    F.lit("&filter=0&start="), _col(offset).cast("string"),
                    F.lit("&fromage="), F.lit(str(from_age)))


def search_grid(keywords: DataFrame, locations: list[str], base: str, kw_col: str = "keyword",
                n_col: str = "num_results") -> DataFrame:
    """One request per keyword x location x page offset.

    Locations are a configuration list, expanded per row (no join)."""
    loc = F.explode(F.array(*[F.lit(x) for x in locations]))
    g = keywords.select(kw_col, n_col, loc.alias("location"))
    g = g.select(kw_col, "location", F.explode(page_offsets(n_col)).alias("page_offset"))
    return g.withColumn("url", search_url(base, kw_col, "location", "page_offset"))


def result_positions(pages: DataFrame, results_col: str, offset_col: str,
                     keep: tuple[str, ...] = ()) -> DataFrame:
    """(…, page, position, job_key) for results with a key; page = offset div 10 + 1."""
    ex = pages.select(*keep, offset_col, F.posexplode(results_col).alias("position", "job_key"))
    ex = ex.where(F.col("job_key").isNotNull() & (F.col("job_key") != F.lit("")))
    return ex.withColumn("page", (F.col(offset_col) / F.lit(R.PAGE_SIZE)).cast("int") + F.lit(1))
