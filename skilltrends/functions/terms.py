"""Column expressions over term arrays (ARRAY<STRING>).

All of these are per-row higher-order functions: no shuffle, rule patterns are
literals so each regex is compiled once per task.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import py_strip


# Case folding, classes and \\b in Unicode, whatever the JDK's default.
FLAGS = "(?iU)"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def any_pattern(patterns: list[str]) -> str:
    """One case-insensitive alternation equivalent to trying each pattern in turn."""
    return FLAGS + "(?:" + "|".join(f"(?:{p})" for p in patterns) + ")"


def has_null_item(arr) -> Column:
    return F.exists(_col(arr), lambda x: x.isNull())


def remove_matching(arr, patterns: list[str]) -> Column:
    """Drop every item matched (search, case-insensitive) by any pattern.

    A list holding a NULL item is passed through unchanged, as a failed row-level
    clean leaves the list as it was.
    """
    arr = _col(arr)
    if not patterns:
        return arr
    rx = any_pattern(patterns)
    kept = F.filter(arr, lambda x: ~x.rlike(rx))
    return F.when(has_null_item(arr), arr).otherwise(kept)


def first_match_case(x: Column, rules: list[tuple[str, str]], default: Column | None = ...) -> Column:
    """The replacement of the first rule whose pattern is found in ``x``, else ``default`` (``x``)."""
    expr = None
    for pattern, replacement in rules:
        cond = x.rlike(FLAGS + pattern)
        expr = F.when(cond, F.lit(replacement)) if expr is None else expr.when(cond, F.lit(replacement))
    other = x if default is ... else F.lit(default)
    return other if expr is None else expr.otherwise(other)


def map_first_match(arr, rules: list[tuple[str, str]]) -> Column:
    """Replace each item by the replacement of its first matching rule; keeps length and order."""
    arr = _col(arr)
    mapped = F.transform(arr, lambda x: first_match_case(x, rules))
    return F.when(has_null_item(arr), arr).otherwise(mapped)


def drop_stoplisted(arr, exact: list[str], partial: list[str]) -> Column:
    """Drop items equal (case-insensitive) to an exact entry or containing a partial entry."""
    arr = _col(arr)
    exact_arr = F.array(*[F.lit(e.lower()) for e in exact]) if exact else None
    partial_arr = F.array(*[F.lit(p.lower()) for p in partial]) if partial else None

    def keep(x: Column) -> Column:
        lx = F.lower(x)
        cond = F.lit(True)
        if exact_arr is not None:
            cond = cond & ~F.array_contains(exact_arr, lx)
        if partial_arr is not None:
            cond = cond & ~F.exists(partial_arr, lambda p: F.instr(lx, p) > 0)
        return cond

    return F.filter(arr, lambda x: F.coalesce(keep(x), F.lit(True)))


def alias_map_expr(pairs: list[tuple[str, str]]) -> Column:
    """Lower-case alias -> canonical term; of several canonical terms for one alias the first stands."""
    first: dict[str, str] = {}
    for alias, canonical in pairs:
        first.setdefault(alias.lower(), canonical)
    return F.create_map(*[F.lit(x) for kv in first.items() for x in kv])


def canonicalize(arr, pairs: list[tuple[str, str]]) -> Column:
    """Replace each item whose lower-case form is a known alias by its canonical term."""
    arr = _col(arr)
    if not pairs:
        return arr
    m = alias_map_expr(pairs)
    return F.transform(arr, lambda x: F.coalesce(F.try_element_at(m, F.lower(x)), x))


def parse_bracket_list(c, drop_blank: bool = False) -> Column:
    """Parse a model answer of the form ``[a, b, c]``.

    Must start with ``[`` (no leading blank); all leading/trailing ``[``/``]`` are
    stripped, the rest split on ``,`` and each item stripped of whitespace. Anything
    else (or NULL) gives an empty list. ``[]`` gives one empty string; ``drop_blank`` leaves blank
    items out.
    """
    c = _col(c)
    inner = F.regexp_replace(c, r"^[\[\]]++|(?<![\[\]])[\[\]]++\z", "")
    items = F.transform(F.split(inner, ",", -1), py_strip)
    if drop_blank:
        items = F.filter(items, lambda x: x != F.lit(""))
    return F.when(c.startswith("["), items).otherwise(F.array().cast("array<string>"))
