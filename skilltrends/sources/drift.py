"""Drift of nested JSON: which paths came, went or changed their kind, and on which day.

A day's state is a row per path with the kinds of its values as a bit set and their number. States are
merged with ``bit_or`` and ``sum``, in any order and grouping, so the state of a day is replaced alone when the
day is delivered again, and a report over any days reads states and no values.

The kinds form a lattice: ``integer`` lies below ``number`` (a number field may hold whole values), a null says nothing."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import measured

#: Bit set of each kind; a number covers an integer.
KINDS = {"array": 1, "boolean": 2, "integer": 4, "number": 12, "object": 16, "string": 32, "not json": 64}
ROOT = "$"


def kind_bits(v) -> Column:
    """Bits of the kind of one VARIANT; NULL (no value could be parsed) is ``not json``, a JSON null is 0."""
    head = F.regexp_extract(F.schema_of_variant(v), "^[A-Z]+", 0)
    names = {"OBJECT": "object", "ARRAY": "array", "STRING": "string", "BOOLEAN": "boolean", "BIGINT": "integer", "DECIMAL": "number", "DOUBLE": "number"}
    bits = F.when(head.isNull(), F.lit(KINDS["not json"]))
    for sql_name, kind in names.items():
        bits = bits.when(head == sql_name, F.lit(KINDS[kind]))
    return bits.otherwise(F.lit(0))


def kind_names(bits) -> Column:
    """The kinds of a bit set, sorted and joined by ``|``; an integer beside a number is a number."""
    b = F.col(bits) if isinstance(bits, str) else bits
    return F.array_join(F.filter(F.array(*[F.when(b.bitwiseAND(F.lit(n)) == n, F.lit(k)) for k, n in KINDS.items()]),
                                 lambda k: k.isNotNull() & ~((k == "integer") & (b.bitwiseAND(F.lit(KINDS["number"])) == KINDS["number"]))), "|")


def children(boxes: DataFrame, by: str) -> DataFrame:
    """(by, path, v): every member of each object and every element of each array."""
    member = boxes.lateralJoin(boxes.sparkSession.tvf.variant_explode(F.col("v").outer()))
    plain = F.col("key").rlike(r"\A\w+\z")
    step = (F.when(F.col("key").isNull(), F.lit("[]")).when(plain, F.concat(F.lit("."), "key"))
            .otherwise(F.concat(F.lit("['"), F.regexp_replace("key", r"(['\\])", r"\\$1"), F.lit("']"))))
    return member.select(by, F.concat("path", step).alias("path"), F.col("value").alias("v"))


def path_states(df: DataFrame, json_col: str, by: str) -> DataFrame:
    """(by, path, kinds, n): the state of each ``by`` (a day) over the JSON texts of ``json_col``.

    Objects and arrays are opened a level at a time, so the number of jobs is the depth of the deepest value and not
    of the rows; only objects and arrays inside others are written between levels, below the shared folder. Every level
    is counted with a map-side combine. A NULL text has no value; one that isn't JSON counts at the root as ``not json``."""
    level = df.where(F.col(json_col).isNotNull()).select(by, F.lit(ROOT).alias("path"), F.try_parse_json(json_col).alias("v"))
    found, deep = [], False
    while True:
        counted = level.select(by, "path", kind_bits("v").alias("kinds")).groupBy(by, "path")
        found.append(measured(counted.agg(F.bit_or("kinds").alias("kinds"), F.count(F.lit(1)).alias("n")), "paths"))
        bits = kind_bits("v")
        boxes = level.where((bits == KINDS["object"]) | (bits == KINDS["array"]))
        if deep:
            boxes = measured(boxes, "nested")
        if boxes.isEmpty():
            return merge_states(reduce(DataFrame.unionAll, found), by)
        level, deep = children(boxes, by), True


def merge_states(states: DataFrame, by: str) -> DataFrame:
    """States of one ``by`` and path joined to one."""
    return states.groupBy(by, "path").agg(F.bit_or("kinds").alias("kinds"), F.sum("n").alias("n"))


def drift_report(states: DataFrame, by: str) -> DataFrame:
    """(path, status, first_day, before, after), read from the states of the days in order:

    * ``new``: the first day of a path, where that isn't the first day of all;
    * ``missing``: the first day without a path that the day before had (each time it goes);
    * ``changed``: a day with a kind that no day before had at this path, where one had any.

    ``before`` and ``after`` name the kinds up to that day and on it. Windows run over a path's days; the days
    are numbered in one small window of a row a day."""
    days = states.where(F.col("path") == ROOT).select(by).distinct()
    in_order = Window.orderBy(F.col(by).asc_nulls_first())
    days = days.select(by, F.row_number().over(in_order).alias("d"), F.lead(by).over(in_order).alias("next_day"))
    rows = states.join(days.withColumnRenamed(by, "_by"), F.col(by).eqNullSafe(F.col("_by"))).drop("_by")
    w = Window.partitionBy("path").orderBy("d")
    rows = rows.select("*", F.lag("d").over(w).alias("prev"), F.lead("d").over(w).alias("next"),
                       F.coalesce(F.bit_or("kinds").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("known"))
    more = F.col("kinds").bitwiseAND(F.bitwise_not("known"))

    def event(when, status, day, before, after):
        return F.when(when, F.struct(F.lit(status).alias("status"), day.alias("first_day"), before.alias("before"), after.alias("after")))

    known, now = kind_names("known"), kind_names("kinds")
    last = F.col("next_day").isNotNull() & (F.col("next").isNull() | (F.col("next") > F.col("d") + 1))
    events = F.array(
        event(F.col("prev").isNull() & (F.col("d") > 1), "new", F.col(by), F.lit(""), now),
        event((F.col("known") != 0) & (more != 0), "changed", F.col(by), known, now),
        event(last, "missing", F.col("next_day"), kind_names(F.col("known").bitwiseOR(F.col("kinds"))), F.lit("")))
    return rows.select("path", F.explode(F.array_compact(events)).alias("e")).select("path", "e.*")
