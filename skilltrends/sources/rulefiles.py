"""Rule files: ``pattern, replacement`` lines, plain word lists, and JSON maps of names to lists.

A rule file is read whole (one row per file), so line order is kept; in a folder of files, those
whose path sorts first rank first. Rule files are configuration, a few KB each, on shared storage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import py_strip


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(rank, line): rank is unique over all files of ``path``."""
    whole = spark.read.text(path, wholetext=True).withColumn("file", F.col("_metadata.file_path"))
    lines = whole.select("file", F.posexplode(F.split("value", r"\r?\n", -1)).alias("pos", "line")).where(py_strip("line") != "")
    return lines.withColumn("rank", F.row_number().over(Window.orderBy("file", "pos")) - F.lit(1)).select("rank", "line")


def load_mapping_rules(spark: SparkSession, path: str) -> DataFrame:
    """(rank, pattern, replacement): each non-blank line split on its first comma."""
    parts = _lines(spark, path).select("rank", F.split("line", ",", 2).alias("p"))
    return parts.select(
        "rank",
        py_strip(F.get("p", 0)).alias("pattern"),
        py_strip(F.get("p", 1)).alias("replacement"),
    ).where(F.col("replacement").isNotNull())


def load_word_patterns(spark: SparkSession, path: str) -> DataFrame:
    """(rank, pattern): ``\\bword\\b`` for each non-blank line (no escaping)."""
    return _lines(spark, path).select(
        "rank", F.concat(F.lit(r"\b"), py_strip("line"), F.lit(r"\b")).alias("pattern"))


def load_json_lists(spark: SparkSession, path: str) -> DataFrame:
    """(name, item): one row per item of each list in a JSON object of lists, such as an alias map
    (canonical term -> aliases) or a set of stop-lists (kind -> terms)."""
    whole = spark.read.text(path, wholetext=True)
    lists = F.from_json("value", "map<string, array<string>>", {"mode": "FAILFAST"})
    return whole.select(F.explode(lists).alias("name", "items")).select("name", F.explode("items").alias("item"))


def stage_text(spark: SparkSession, text: str, path: str) -> str:
    """Write a driver-side text (e.g. a packaged rule file) to shared storage as one file."""
    (spark.createDataFrame([(text,)], "value STRING").coalesce(1)
     .write.mode("overwrite").text(path))
    return path
