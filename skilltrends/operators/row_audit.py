"""Reconciliation that names the rows: what a stage lost, doubled, changed or made up.

Every row has a digest of all its columns, and its key a bucket. The rows of a bucket are summed up as a
multiset, in any order: their number and the sums of four 32-bit pieces of two digests, so repeats count and nothing cancels
out. The buckets form a tree of ``FANOUT`` children a node. Equal tables cost one aggregate a side over at most
``FANOUT`` groups; only buckets that differ are opened, and only rows below differing ones are shuffled and named."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Children of a node; two levels above the rows.
FANOUT = 4096
_BITS = FANOUT.bit_length() - 1
_SUMS = ["_n", "_a", "_b", "_c", "_d"]


def _piece(h: str, high: bool) -> Column:
    c = F.shiftright(h, 32) if high else F.col(h)
    return F.sum(c.bitwiseAND(F.lit(0xFFFFFFFF)).cast("decimal(20,0)"))


def _node(level: int) -> Column:
    """The child that a row's key falls into at ``level``: the next bits of the key's digest."""
    return F.shiftrightunsigned("_bucket", _BITS * level).bitwiseAND(F.lit(FANOUT - 1)).cast("int")


def digested(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """(keys..., _bucket, _h1, _h2): the key's digest and two of the whole row. Values are hashed as JSON of the row, where a NULL
    and an empty text, and the borders between columns, differ."""
    row = F.to_json(F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(columns)]), {"ignoreNullFields": "false"})
    key = F.to_json(F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)]), {"ignoreNullFields": "false"})
    staged = df.select(*keys, row.alias("_row"), key.alias("_key"))
    return staged.select(*keys, F.xxhash64("_key").alias("_bucket"), F.xxhash64("_row").alias("_h1"), F.xxhash64(F.lit("second"), "_row").alias("_h2"))


def sums(rows: DataFrame, *nodes: str) -> DataFrame:
    """The multiset digest of each group of ``nodes``; partially summed before the shuffle."""
    return rows.groupBy(*nodes).agg(F.count(F.lit(1)).alias("_n"), _piece("_h1", True).alias("_a"), _piece("_h1", False).alias("_b"),
                                    _piece("_h2", True).alias("_c"), _piece("_h2", False).alias("_d"))


def differing(a: DataFrame, b: DataFrame, *nodes: str) -> DataFrame:
    """Nodes whose digests differ between two sides or that only one side has."""
    sides = sums(a, *nodes).unionAll(sums(b, *nodes))
    return sides.groupBy(*nodes).agg(F.count(F.lit(1)).alias("sides"), F.count_distinct(F.struct(*_SUMS)).alias("kinds")).where("sides = 1 OR kinds > 1").select(*nodes)


def reconcile_rows(inputs: DataFrame, outputs: DataFrame, keys: list[str], columns: list[str] | None = None) -> DataFrame:
    """(keys..., status, n_in, n_out): every key whose rows differ between the sides in ``columns`` (default: all of the
    inputs' columns; the outputs must have them). Status:

    * ``lost``: no output row; ``added``: no input row;
    * ``doubled``: the same different rows, none less often and one more often; ``thinned``: none more often and one less;
    * ``changed``: all else.

    NULL keys and values are values like any other. Equal sides, and empty ones, give no row. A key of very many rows is
    counted per different row before it meets its task."""
    from ..session import measured
    columns = columns or inputs.columns
    a, b = (digested(x, keys, columns).withColumn("_l0", _node(0)).withColumn("_l1", _node(1)) for x in (inputs, outputs))
    top = [r[0] for r in differing(a, b, "_l0").collect()]  # at most FANOUT numbers
    a, b = (x.where(F.col("_l0").isin(top) if 0 < len(top) < FANOUT else F.lit(bool(top))) for x in (a, b))
    nodes = measured(differing(a, b, "_l0", "_l1"), "differing")
    both = a.select("*", F.lit(1).alias("_in"), F.lit(0).alias("_out")).unionAll(b.select("*", F.lit(0).alias("_in"), F.lit(1).alias("_out")))
    rows = both.join(nodes, ["_l0", "_l1"], "left_semi").groupBy(*keys, "_h1", "_h2").agg(F.sum("_in").alias("i"), F.sum("_out").alias("o"))
    per = rows.groupBy(*keys).agg(F.sum("i").alias("n_in"), F.sum("o").alias("n_out"), F.count_if(F.col("i") != F.col("o")).alias("off"),
                                  F.count_if((F.col("i") == 0) | (F.col("o") == 0)).alias("alone"),
                                  F.count_if(F.col("i") > F.col("o")).alias("less"), F.count_if(F.col("o") > F.col("i")).alias("more"))
    status = (F.when(F.col("n_out") == 0, "lost").when(F.col("n_in") == 0, "added")
              .when((F.col("alone") == 0) & (F.col("less") == 0), "doubled").when((F.col("alone") == 0) & (F.col("more") == 0), "thinned").otherwise("changed"))
    return per.where("off > 0").select(*keys, status.alias("status"), "n_in", "n_out")
