"""A keyed permutation of 0..n-1 in Spark SQL: an alternating Feistel network over a
rectangle of a x b cells (a * b >= n, fewer than a cells left over) with cycle walking.

Even rounds add F(round, right) to the left half modulo a, odd rounds add F(round, left) to
the right half modulo b; each round is invertible, so the whole is. F takes 60 bits of an MD5
digest, which every SQL engine has."""

from __future__ import annotations

import math

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

ROUNDS = 6


def rectangle(n: int) -> tuple[int, int]:
    a = max(1, math.isqrt(max(n, 1) - 1) + 1)
    return a, max(1, -(-n // a))


def mix(seed: int, j: Column, v: Column) -> Column:
    digest = F.md5(F.concat_ws(":", F.lit(seed).cast("string"), j.cast("string"), v.cast("string")))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def permute_once(v: Column, n: int, seed: int, inverse: bool = False) -> Column:
    """One pass of the network over the rectangle; values from n on are possible."""
    a, b = rectangle(n)
    sign = -1 if inverse else 1

    def step(s: Column, j: Column) -> Column:
        left = F.pmod(s["l"] + sign * (mix(seed, j, s["r"]) % a), F.lit(a).cast("long"))
        right = F.pmod(s["r"] + sign * (mix(seed, j, s["l"]) % b), F.lit(b).cast("long"))
        even = j % 2 == 0
        return F.struct(F.when(even, left).otherwise(s["l"]).alias("l"),
                        F.when(even, s["r"]).otherwise(right).alias("r"))

    rounds = list(range(ROUNDS))
    start = F.struct(F.pmod(v, F.lit(a).cast("long")).alias("l"), F.floor(v / F.lit(a)).cast("long").alias("r"))
    if n > 1 << 52:
        raise ValueError("more rows than a double can number")
    return F.aggregate(F.array(*[F.lit(j) for j in (rounds[::-1] if inverse else rounds)]), start, step,
                       lambda s: s["l"] + a * s["r"])


def longest_walk(spark: SparkSession, n: int, seed: int, inverse: bool = False) -> int:
    """The most passes any value can need. A walk leaves 0..n-1 only through the left-over
    cells, of which there are fewer than a (about the root of n); follow those alone."""
    if n < 2:
        return 1
    a, b = rectangle(n)
    left = spark.range(n, max(n, a * b)).select(F.col("id").alias("v"))
    passes = 1
    while True:
        left = left.select(permute_once(F.col("v"), n, seed, inverse).alias("v")).filter(F.col("v") >= n)
        rows = left.collect()  # fewer than a rows, and fewer each time
        if not rows:
            return passes + (a * b > n)
        passes += 1
        left = spark.createDataFrame(rows, "v long")


def permute(v: Column, n: int, seed: int, passes: int, inverse: bool = False) -> Column:
    """The permutation of 0..n-1. ``passes``: from ``longest_walk``."""
    def again(x: Column, _: Column) -> Column:
        return F.when(x < n, x).otherwise(permute_once(x, n, seed, inverse))

    first = permute_once(v, n, seed, inverse)
    return first if passes <= 1 else F.aggregate(F.sequence(F.lit(2), F.lit(passes)), first, again)
