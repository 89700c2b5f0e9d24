"""Explicit stage schemas. JSON layers are read with these, never inferred per run."""

from __future__ import annotations

from pyspark.sql import types as T

S, I, D, L = T.StringType(), T.IntegerType(), T.DoubleType(), T.LongType()
ARR_S = T.ArrayType(S)

POSTING = T.StructType([
    T.StructField("job_key", S), T.StructField("keyword", ARR_S), T.StructField("from_age", I),
    T.StructField("location", S), T.StructField("page", I), T.StructField("position", I),
    T.StructField("job_title", S), T.StructField("company", S), T.StructField("job_description", S),
    T.StructField("salary_estimated_flag", I), T.StructField("salary_min", D),
    T.StructField("salary_max", D), T.StructField("salary_type", S), T.StructField("url", S),
])

SELECTED = T.StructType(POSTING.fields + [T.StructField("split_jd", S)])

CHOICES = T.ArrayType(T.StructType([
    T.StructField("message", T.StructType([T.StructField("content", S)]))]))

EXTRACTED = T.StructType(SELECTED.fields + [
    T.StructField("choices", CHOICES), T.StructField("cleaned_techs", ARR_S),
    T.StructField("result", ARR_S)])

CLEAN = T.StructType(EXTRACTED.fields + [
    T.StructField("day", I), T.StructField("month", I), T.StructField("year", I)])

KEYWORDS_RAW = T.StructType([T.StructField("job_key", S), T.StructField("keyword", ARR_S)])

# The events test table as landed JSON lines.
EVENT = T.StructType([
    T.StructField("event_id", L), T.StructField("ts", T.TimestampNTZType()), T.StructField("user_id", L),
    T.StructField("event_type", S), T.StructField("value", D), T.StructField("props", S),
])

CORRUPT_COL = "_corrupt_record"


def with_corrupt(schema: T.StructType, col: str = CORRUPT_COL) -> T.StructType:
    return T.StructType(schema.fields + [T.StructField(col, S)])


# The data blob embedded in a landed job page (only the fields the postings use).
_SAL = T.StructType([T.StructField("salaryMin", D), T.StructField("salaryMax", D), T.StructField("salaryType", S)])
_EST = T.StructType([T.StructField("min", D), T.StructField("max", D), T.StructField("type", S)])
JOB_PAGE_BLOB = T.StructType([
    T.StructField("jobInfoWrapperModel", T.StructType([
        T.StructField("jobInfoModel", T.StructType([
            T.StructField("sanitizedJobDescription", S),
            T.StructField("jobInfoHeaderModel", T.StructType([
                T.StructField("companyName", S), T.StructField("jobTitle", S)])),
        ])),
    ])),
    T.StructField("salaryInfoModel", _SAL),
    T.StructField("salaryGuideModel", T.StructType([T.StructField("estimatedSalaryModel", _EST)])),
])
