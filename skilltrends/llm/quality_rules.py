r"""Operator 1. Quality rules: a short-circuit cascade ordered by rejection per cost.

``base_metrics`` computes the counts that every document gets. ``cascade`` measures, on a bounded
sample, what each rule costs and which sampled documents it rejects; then it orders the rules
greedily by (share of the documents still alive that the rule rejects) / (its cost). The order is
compiled into one CASE expression, whose branches Spark evaluates only until one holds. The verdict
is the same in any order, so results do not depend on the sample or on the clock.

n_repeat_words counts the words covered by 3-word windows that occur twice or more in the text.
Windows are packed as 44 bits of a hash with a 20-bit position and sorted as plain longs; neighbours
that share the hash bits are compared word by word. Where two different windows share them, or
the text has 2**20 words or more, the windows themselves are sorted instead, so the count is exact.

Defined results: a null or blank text has zero words, all counts 0, base_failed true, kept false;
null ids and repeated rows are scored row by row; an empty table gives an empty result; input
columns named like a result are replaced.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE_RX, carried, col, packed, unpacked

SPACES = " \t\n\x0b\x0c\r"
MIN_WORDS, SAMPLE_ROWS, POSITION_BITS = 50, 500, 20
MEASURED, MOST_TURNS = 0.1, 256

#: Rules of the cascade: name -> SQL condition that rejects, on the columns text (never null), words,
#: n_words, word_chars, n_symbols, n_dup_lines, n_lines. Each compares integers only.
RULES = {
    "symbol_heavy": "10 * n_symbols > n_words",
    "word_length": "word_chars < 2 * n_words OR word_chars > 15 * n_words",
    "dup_lines": "n_dup_lines >= 3 AND 10 * n_dup_lines > 3 * n_lines",
    "few_letters": r"10 * regexp_count(text, '[A-Za-z\\u0080-\\uFFFF][^\\x20\\x09-\\x0D]*') < 7 * n_words",
    # from two capitals on a match takes the rest of its run without blanks and a-z, so no start reads it again;
    # it counts where an exclamation mark follows
    "shouting": r"10 * size(filter(regexp_extract_all(text, '[A-Z]{2}[^\\x20\\x09-\\x0Da-z!]*+(!?)[^\\x20\\x09-\\x0Da-z]*+', 1), x -> x = '!')) > 3 * n_words",
    "exclaiming": r"10 * regexp_count(text, '[!?]{2,}') > 3 * n_words",
}


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, wherever the optimizer moves the expression."""
    return F.transform(F.array(value), body)[0]


def neighbours(s: Column, same: Callable[[Column, Column], Column], place: Callable[[Column], Column]) -> Column:
    """Neighbours in the sorted array ``s`` that ``same`` finds alike, as an array of (p, q)."""
    pairs = F.zip_with(s, F.slice(s, 2, F.greatest(F.size(s), F.lit(1))),
                       lambda a, b: F.when(same(a, b), F.struct(place(a).alias("p"), place(b).alias("q"))))
    return F.filter(pairs, lambda x: x.isNotNull())


def repeat_words(w: Column) -> Column:
    """Words of the array ``w`` inside 3-word windows that ``w`` holds twice or more."""
    mask = (1 << POSITION_BITS) - 1
    starts = F.when(F.size(w) >= 3, F.sequence(F.lit(0), F.size(w) - 3)).otherwise(F.expr("cast(array() as array<int>)"))
    packed_windows = F.sort_array(F.transform(
        starts, lambda i: F.xxhash64(w[i], w[i + 1], w[i + 2]).bitwiseAND(F.lit(~mask)).bitwiseOR(i.cast("long").bitwiseAND(F.lit(mask)))))
    likely = bind(packed_windows, lambda s: neighbours(
        s, lambda a, b: F.shiftright(a, POSITION_BITS) == F.shiftright(b, POSITION_BITS),
        lambda x: x.bitwiseAND(F.lit(mask)).cast("int")))
    exactly = bind(F.sort_array(F.transform(starts, lambda i: F.struct(
        F.concat_ws(" ", w[i], w[i + 1], w[i + 2]).alias("s"), i.alias("i")))),
        lambda s: neighbours(s, lambda a, b: a["s"] == b["s"], lambda x: x["i"]))

    def unlike(pairs: Column) -> Column:
        return F.exists(pairs, lambda x: (w[x["p"]] != w[x["q"]]) | (w[x["p"] + 1] != w[x["q"] + 1])
                        | (w[x["p"] + 2] != w[x["q"] + 2]))

    pairs = F.when(F.size(w) > mask, exactly).otherwise(
        bind(likely, lambda ps: F.when(unlike(ps), exactly).otherwise(ps)))
    at = bind(pairs, lambda ps: F.sort_array(F.array_distinct(F.concat(
        F.transform(ps, lambda x: x["p"]), F.transform(ps, lambda x: x["q"])))))
    return F.aggregate(at, F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end")),
                       lambda s, p: F.struct((s["n"] + p + 3 - F.greatest(p, s["end"])).alias("n"), (p + 3).alias("end")),
                       lambda s: s["n"])


def base_metrics(rows: DataFrame, text: Column) -> DataFrame:
    """Add text (never null) and the base counts to ``rows``."""
    rows = rows.withColumn("text", F.coalesce(text, F.lit("")))
    words = F.array_remove(F.split("text", f"{SPACE_RX}+"), "")
    lines = F.filter(F.split("text", "\n"), lambda x: F.trim(x, F.lit(SPACES)) != "")
    counts = bind(words, lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        repeat_words(w).alias("n_repeat_words")))
    by_line = bind(lines, lambda x: F.struct(
        F.size(x).cast("long").alias("n_lines"),
        (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")))
    symbols = F.regexp_count("text", F.lit(r"[#*$%&|<>]")).cast("long")
    return (rows.withColumns({"by_word": counts, "by_line": by_line, "n_symbols": symbols})
            .select(*[F.col(c) for c in rows.columns], "by_word.*", "by_line.*", "n_symbols"))


BASE_FAILED = f"n_words < {MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words"


def measure(sample: DataFrame, rules: dict[str, str]) -> tuple[dict[str, float], dict[tuple, int]]:
    """Seconds that each rule takes for the sample, and how many sampled documents each combination of
    rejecting rules holds for (2 ** rules rows at the most).

    A rule is evaluated over and over in one job, eight times as often until it adds ``MEASURED`` seconds to a
    job that does nothing else (which then is several times what a job's own time varies by), or
    ``MOST_TURNS`` times: two measurements differ by some 20 %, and a rule too cheap for that
    counts as the cheapest measurable one."""
    def seconds(turns: int, condition: str) -> float:
        again = f"aggregate(sequence(1, {turns}), 0, (held, turn) -> held + IF(turn > 0 AND ({condition}), 1, 0))"
        best = float("inf")
        for _ in range(2):
            began = time.perf_counter()
            sample.select(F.sum(F.expr(f"IF({BASE_FAILED}, 0, {again})"))).collect()
            best = min(best, time.perf_counter() - began)
        return best

    empty, cost = {}, {}
    for name, condition in rules.items():
        turns = 4
        while True:
            if turns not in empty:
                empty[turns] = seconds(turns, "n_words < 0")
            added = seconds(turns, condition) - empty[turns]
            if added >= MEASURED or turns >= MOST_TURNS:
                break
            turns *= 8
        cost[name] = max(added, MEASURED / 10) / turns
    hits = sample.filter(f"NOT ({BASE_FAILED})").groupBy(*[F.expr(c).alias(f"r{i}") for i, c in enumerate(rules.values())]).count().collect()
    return cost, {tuple(bool(x) for x in r[:-1]): r[-1] for r in hits}


def order_rules(names: list[str], cost: dict[str, float], hits: dict[tuple, int]) -> list[str]:
    """Greedy: next comes the rule that rejects most of what is still alive per unit of cost."""
    left, order = list(names), []
    while left:
        alive = {k: n for k, n in hits.items() if not any(k[names.index(r)] for r in order)}
        rejects = {r: sum(n for k, n in alive.items() if k[names.index(r)]) for r in left}
        best = max(left, key=lambda r: (rejects[r] / cost[r], -cost[r]))
        order.append(best)
        left.remove(best)
    return order


def score_documents(docs: DataFrame, rules: dict[str, str] = RULES, sample_rows: int = SAMPLE_ROWS,
                    costs: dict[str, float] | None = None, text_col: str = "text",
                    carry: list[str] | None = None) -> DataFrame:
    """Every row of ``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept, failed_rule. ``sample_rows``: expected rows of the sample that orders the
    rules (chosen by a hash of the whole row); ``costs`` replaces the measured ones;
    ``carry``: the input columns to keep (default: all)."""
    text = F.coalesce(col(text_col), F.lit(""))
    total = docs.count()
    share = min(1.0, sample_rows / max(total, 1))
    whole = [F.to_json(F.struct(col(c))) if "map<" in kind or "variant" in kind else col(c) for c, kind in docs.dtypes]
    chosen = docs.filter(F.pmod(F.xxhash64(*whole, F.lit(1)), F.lit(1 << 20)) < int(share * (1 << 20)))
    sample = base_metrics(chosen.select(text.alias("text")), F.col("text")).cache()
    try:
        cost, hits = measure(sample, rules)
    finally:
        sample.unpersist()
    order = order_rules(list(rules), costs or cost, hits)
    case = " ".join([f"WHEN {BASE_FAILED} THEN 'base'", *[f"WHEN {rules[r]} THEN '{r}'" for r in order]])
    columns = carried(docs, carry)
    rows = base_metrics(packed(docs, columns, text_col), F.col("t"))
    rows = rows.withColumn("failed_rule", F.expr(f"CASE {case} END"))
    return unpacked(rows, columns, {
        **{k: F.col(k) for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")},
        "base_failed": F.expr(BASE_FAILED), "kept": F.col("failed_rule").isNull(), "failed_rule": F.col("failed_rule")}, text_col)
