"""Raw pages: visible text, embedded data blobs, URL parts. Per-row, no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X


def page_text(df: DataFrame, html_col: str = "html", out_col: str = "text") -> DataFrame:
    return df.withColumn(out_col, X.html_to_text(html_col))


def embedded_blob(html, pattern: str) -> Column:
    """The first capture of ``pattern`` in the page parsed as JSON (a VARIANT).

    No match or unparsable text gives NULL (such rows go to the quarantine sink
    instead of failing the job)."""
    raw = F.nullif(F.regexp_extract(X._col(html), pattern, 1), F.lit(""))
    return F.try_parse_json(raw)


def object_after(html, marker: str) -> Column:
    """The text of the JSON object that follows the first match of ``marker`` (a pattern that ends before its ``{``).

    The text from there is cut into escapes, quotes, braces and runs of all else, and depth and being in a string are
    folded over these, so a brace or ``;`` in a string ends nothing. Linear in the page, without recursion. An object that the
    page doesn't close comes with the whole rest (no JSON); no match gives NULL."""
    rest = F.nullif(F.regexp_extract(X._col(html), rf"(?s){marker}(\{{.*+)", 1), F.lit(""))
    atoms = F.regexp_extract_all(rest, F.lit(r'(?s)\\.|["{}\\]|[^"{}\\]++'), F.lit(0))

    def step(s, atom):
        quote = atom == F.lit('"')
        depth = s["depth"] + F.when(s["quoted"], 0).when(atom == F.lit("{"), 1).when(atom == F.lit("}"), -1).otherwise(0)
        return F.when(s["closed"], s).otherwise(F.struct(
            depth.alias("depth"), (s["quoted"] != quote).alias("quoted"), (s["chars"] + F.length(atom)).alias("chars"), (depth == 0).alias("closed")))

    start = F.struct(F.lit(0).alias("depth"), F.lit(False).alias("quoted"), F.lit(0).alias("chars"), F.lit(False).alias("closed"))
    return F.left(rest, F.aggregate(atoms, start, step, lambda s: s["chars"]))


def endpoint_from_url(url, patterns: list[str]) -> Column:
    """Group 1 of the first of ``patterns`` matching the URL, else NULL."""
    return X.first_group(url, patterns, 1)
