"""JSON-lines sources: daily files ``<prefix>_DD_MM_YYYY.json`` on shared storage.

* scans use an explicit schema, ``PERMISSIVE`` mode and a corrupt-record column, so a
  bad line becomes a flagged row instead of a failed job;
* the day comes from the file path (``_metadata.file_path``) — no listing on the driver;
* a narrow schema reads only the named keys (the JSON parser skips the rest);
* drifting daily schemas are combined by name, missing columns as NULL.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import CORRUPT_COL, with_corrupt

DATE_IN_NAME_RX = r"_(\d{1,2})_(\d{1,2})_(\d{4})\.json"
TS_NTZ_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def scan_jsonl(spark: SparkSession, path: str, schema: T.StructType, corrupt: bool = True,
               with_path: bool = True) -> DataFrame:
    """Read JSON lines below ``path`` (recursively) with ``schema``."""
    s = with_corrupt(schema) if corrupt else schema
    reader = (spark.read.schema(s)
              .option("mode", "PERMISSIVE")
              .option("recursiveFileLookup", "true")
              .option("timestampNTZFormat", TS_NTZ_FORMAT))
    if corrupt:
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT_COL)
    df = reader.json(path)
    if with_path:
        df = df.withColumn("source_file", F.col("_metadata.file_path"))
    return df


def date_from_path(path_col) -> tuple[Column, Column, Column]:
    """(day, month, year) integers from a ``…_DD_MM_YYYY.json`` path; NULL if absent."""
    c = F.col(path_col) if isinstance(path_col, str) else path_col
    parts = [F.regexp_extract(c, DATE_IN_NAME_RX, i).try_cast("int") for i in (1, 2, 3)]
    return parts[0], parts[1], parts[2]


def with_file_date(df: DataFrame, path_col: str = "source_file") -> DataFrame:
    d, m, y = date_from_path(path_col)
    return df.withColumn("day", d).withColumn("month", m).withColumn("year", y)


def daily_file_name(prefix: str, ts_col: str) -> Column:
    return F.concat(F.lit(prefix + "_"), F.date_format(F.col(ts_col), "dd_MM_yyyy"), F.lit(".json"))


def write_daily_jsonl(df: DataFrame, root: str, prefix: str, ts_col: str, mode: str = "overwrite") -> str:
    """Land ``df`` as one folder per day named ``<prefix>_DD_MM_YYYY.json`` (one write job)."""
    (df.withColumn("file", daily_file_name(prefix, ts_col))
       .hint("rebalance", F.col("file"))
       .write.mode(mode)
       .option("timestampNTZFormat", TS_NTZ_FORMAT)
       .partitionBy("file")
       .json(root))
    return root


def union_by_name(frames: list[DataFrame]) -> DataFrame:
    """Union of frames with drifting columns: matched by name, missing columns NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def json_field_counts(df: DataFrame, json_col: str) -> DataFrame:
    """(field, n_rows): how many rows carry each top-level key — a drift report."""
    keys = F.json_object_keys(F.col(json_col))
    return (df.select(F.explode(keys).alias("field"))
            .groupBy("field").agg(F.count(F.lit(1)).alias("n_rows")))


def schema_diff(df: DataFrame, json_col: str, declared: T.StructType) -> DataFrame:
    """(field, declared_type, found_types, n_rows, status): each top-level key of the JSON values or of the
    declared schema; status is ``same``, ``new`` (not declared), ``missing`` (never found) or ``other type``.
    A NULL value says nothing about the type; integers count as numbers of any declared width."""
    v = F.try_parse_json(F.col(json_col))
    pairs = df.select(F.explode(F.json_object_keys(F.col(json_col))).alias("field"), v.alias("v"))
    kind = F.lower(F.schema_of_variant(F.try_variant_get("v", F.concat(F.lit("$['"), F.col("field"), F.lit("']")), "variant")))
    found = (pairs.select("field", F.regexp_replace(kind, r"[(<].*$", "").alias("kind")).groupBy("field")
             .agg(F.count(F.lit(1)).alias("n_rows"), F.array_sort(F.collect_set(F.when(F.col("kind") != "void", F.col("kind")))).alias("kinds")))
    names = {"long": "bigint", "integer": "int"}
    told = df.sparkSession.createDataFrame([(f.name, names.get(f.dataType.typeName(), f.dataType.typeName())) for f in declared.fields],
                                           "field STRING, declared_type STRING")
    numbers = F.array(*[F.lit(x) for x in ("tinyint", "smallint", "int", "bigint", "decimal", "float", "double")])
    fits = F.forall("kinds", lambda k: (k == F.col("declared_type"))
                    | (F.array_contains(numbers, k) & F.array_contains(numbers, F.col("declared_type")))
                    | ((k == "string") & F.col("declared_type").startswith("timestamp")))
    out = told.join(found, "field", "full_outer")
    return out.select("field", "declared_type", F.array_join("kinds", "|").alias("found_types"), F.coalesce("n_rows", F.lit(0)).alias("n_rows"),
                      F.when(F.col("declared_type").isNull(), "new").when(F.col("n_rows").isNull(), "missing")
                      .when(fits, "same").otherwise("other type").alias("status"))


def merged_schema(df: DataFrame, json_col: str) -> DataFrame:
    """One row: the merged schema of all JSON values (a distributed aggregate)."""
    return df.select(F.schema_of_variant_agg(F.try_parse_json(F.col(json_col))).alias("schema"))
