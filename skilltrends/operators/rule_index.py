"""The first matching rule of a rule table of any size, through an index from literals to rules.

Nearly every pattern holds text that each of its matches must hold: ``\\b(aws|amazon)\\b`` one of ``aws`` and
``amazon``. Those literals, taken from the parsed pattern, are looked up in the distinct terms by an Aho-Corasick
automaton (in blocks of bounded size, each a broadcast), so a term meets only rules that may match it; those
few are then tested as patterns by Spark, and the lowest rank stands. Rules without a literal are tried on
all distinct terms, in batches of literal expressions.

Case is ignored as Java does with ``(?iU)``: a literal is ASCII, and the four other characters that fold
to ASCII are folded in the terms."""

from __future__ import annotations

import re
import sys
import warnings
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import terms as T
from ..session import measured

# tasks get this module's functions with their closures; executors need no copy of it
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Rules up to this number become literal expressions, which need no shuffle; more go through the index.
INLINE = 1000
BLOCK_BYTES, PER_CASE, PER_BATCH = 8 << 20, 200, 2000

# FIXED VALUES: characters beyond ASCII whose simple case folding is an ASCII letter.
FOLDED = ("ſKİı", "skii")
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def folded(c: Column) -> Column:
    return F.translate(c, UPPER + FOLDED[0], UPPER.lower() + FOLDED[1])


def required_literals(pattern: str) -> list[str] | None:
    """Lower-case ASCII texts of which every match of ``pattern`` holds one, or None where no such set is
    known (patterns with flags or syntax that only Java knows among them)."""
    from re import _constants as C
    from re import _parser as P

    if re.search(r"\(\?(?!:|i\)|i:)|\\[QEpPhHRXGzZ]|&&", pattern):
        return None
    try:
        with warnings.catch_warnings():
            warnings.simplefilter("error")
            tree = P.parse(pattern)
    except Exception:
        return None

    def best(found: list[list[str]]) -> list[str] | None:
        return max(found, key=lambda x: (min(map(len, x)), -len(x)), default=None)

    def of(sequence) -> list[str] | None:
        found, run = [], ""
        for op, value in sequence:
            if op is C.LITERAL and value < 128:
                run += chr(value).lower()
                continue
            if run:
                found.append([run])
                run = ""
            inner = None
            if op is C.SUBPATTERN and value[1] in (0, int(re.I)) and not value[2]:
                inner = of(value[3])
            elif op in (C.MAX_REPEAT, C.MIN_REPEAT, C.POSSESSIVE_REPEAT) and value[0] >= 1:
                inner = of(value[2])
            elif op is C.ATOMIC_GROUP:
                inner = of(value)
            elif op is C.BRANCH:
                sides = [of(x) for x in value[1]]
                inner = None if None in sides else sorted({x for side in sides for x in side})
            if inner:
                found.append(inner)
        return best(found + ([[run]] if run else []))

    return of(tree)


def with_literals(rules: DataFrame) -> DataFrame:
    """``rules`` with ``literals`` (an array; NULL: none known)."""
    @F.pandas_udf("array<string>")
    def literals(patterns: pd.Series) -> pd.Series:
        return patterns.map(lambda p: None if p is None else required_literals(p))

    return rules.withColumn("literals", literals("pattern"))


def held_literals(terms: DataFrame, literals: list[str]) -> DataFrame:
    """(term, literal): the literals that each ``term`` holds."""
    held = terms.sparkSession.sparkContext.broadcast(literals)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ahocorasick

        automaton = ahocorasick.Automaton()
        for x in held.value:
            automaton.add_word(x, x)
        automaton.make_automaton()
        for batch in batches:
            place, found = [], []
            for i, t in enumerate(batch.column("low").to_pylist()):
                for x in {x for _, x in automaton.iter(t)}:
                    place.append(i)
                    found.append(x)
            yield pa.RecordBatch.from_arrays([batch.column("term").take(pa.array(place, pa.int64())), pa.array(found, pa.string())], names=["term", "literal"])

    return terms.select("term", folded(F.col("term")).alias("low")).mapInArrow(run, "term string, literal string")


def union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionAll(f)
    return out


def first_rules(terms: DataFrame, rules: DataFrame) -> DataFrame:
    """(term, rule): for each distinct non-NULL ``term`` that a rule matches, the rule of lowest rank, as a struct
    (rank, pattern, replacement). ``rules``: rank, pattern, replacement."""
    terms = measured(terms.select("term").where("term IS NOT NULL").distinct(), "distinct-terms")
    rules = measured(with_literals(rules.select("rank", "pattern", "replacement").where("pattern IS NOT NULL")), "rule-literals")
    rule = F.struct("rank", "pattern", "replacement")
    by_literal = rules.where("literals IS NOT NULL").select(F.explode("literals").alias("literal"), rule.alias("rule"))
    names = by_literal.select("literal").distinct()
    total = names.agg(F.sum(F.length("literal"))).first()[0] or 0
    blocks = -(-total // BLOCK_BYTES)
    found = []
    for i in range(blocks):
        block = names if blocks == 1 else names.where(F.pmod(F.xxhash64("literal"), F.lit(blocks)) == i)
        held = held_literals(terms, [r.literal for r in block.collect()])
        pairs = held.join(by_literal, "literal")
        found.append(pairs.where(F.rlike(F.col("term"), F.concat(F.lit(T.FLAGS), F.col("rule.pattern")))).select("term", "rule"))
    last = None  # rules without a literal, by rank
    while batch := sorted(rules.where("literals IS NULL" if last is None else F.col("literals").isNull() & (F.struct("rank", "pattern", "replacement") > last))
                          .orderBy("rank", "pattern", "replacement").limit(PER_BATCH).collect(), key=lambda r: (r["rank"], r["pattern"])):
        cases = []
        for k in range(0, len(batch), PER_CASE):
            case = None
            for r in batch[k:k + PER_CASE]:
                hit, made = F.col("term").rlike(T.FLAGS + r["pattern"]), F.struct(*[F.lit(r[c]).cast(rules.schema[c].dataType).alias(c) for c in ("rank", "pattern", "replacement")])
                case = F.when(hit, made) if case is None else case.when(hit, made)
            cases.append(case)
        found.append(terms.select("term", F.coalesce(*cases).alias("rule")).where("rule IS NOT NULL"))
        r = batch[-1]
        last = F.struct(*[F.lit(r[c]).cast(rules.schema[c].dataType).alias(c) for c in ("rank", "pattern", "replacement")])
        if len(batch) < PER_BATCH:
            break
    if not found:
        return terms.limit(0).select("term", F.lit(None).cast("struct<rank:int,pattern:string,replacement:string>").alias("rule"))
    return union(found).groupBy("term").agg(F.min("rule").alias("rule"))
