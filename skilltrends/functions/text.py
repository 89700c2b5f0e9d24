"""Column expressions over text. All JVM-side regex / string functions."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Python's whitespace set (str.isspace), spelled out so Java and RE2 agree on it.
# Spark's trim removes spaces only.
PY_WS = r"[\t\n\x0b\x0c\r\x1c-\x1f\x85\p{Z}]"
# The look-behind lets a run of blanks be tried from its first character only, and possessive loops never
# give anything back: linear in the text, whatever it holds.
STRIP_RX = rf"^{PY_WS}++|(?<!{PY_WS}){PY_WS}++\z"

# Blanks without the newline, then the newline and all blanks after it: a whole run, once.
NEWLINE_RUN_RX = rf"(?<!{PY_WS})[\t\x0b\x0c\r\x1c-\x1f\x85\p{{Z}}]*+\n{PY_WS}*+"

# One construct of markup that produces no text, by the states of an HTML tokenizer. Every construct runs to
# its end or to the end of the text, so a scan reads each character once. Loops are possessive: Java's
# matcher runs those without recursion.
#   the rest of a tag: a quoted value after ``=`` may hold ``>``
TAG_REST = r"""(?:[^>=]|=[\t\n\f\r ]*+(?:"[^"]*+(?:"|\z)|'[^']*+(?:'|\z))?)*+(?:>|\z)"""
MARKUP_RX = "(?is)" + "|".join([
    r"<!--(?:-?>|.*?(?:--!?>|\z))",  # a comment
    # script, style and template with their bodies, which may hold tag-like strings
    rf"<(script|style|template)(?=[\t\n\f\r />]|\z){TAG_REST}.*?(?:</\1(?=[\t\n\f\r />]|\z){TAG_REST}|\z)",
    rf"</?[a-z]{TAG_REST}",
    r"<(?:[!?]|/(?=[^a-z]))[^>]*+(?:>|\z)",  # a declaration or a bogus comment
])
# Stands for one construct until runs of them become one space; a noncharacter, never in a text.
MARK = "\ufdd0"


def py_strip(c) -> Column:
    return F.regexp_replace(_col(c), STRIP_RX, "")


def lower_strip(c) -> Column:
    return py_strip(F.lower(_col(c)))


def _unescape(c: Column) -> Column:
    @F.pandas_udf("string")
    def unescape(s: pd.Series) -> pd.Series:
        import html
        return s.map(lambda x: None if x is None else html.unescape(x))

    return unescape(c)


def decode_entities(c) -> Column:
    """Every named and numeric character reference decoded by the standard library, in Arrow batches;
    only texts that hold an ``&`` are sent there."""
    c = _col(c)
    return F.coalesce(_unescape(F.when(F.contains(c, F.lit("&")), c)), c)


def html_to_text(c) -> Column:
    """Visible text of an HTML fragment: text nodes joined by one space, entities decoded, then stripped.

    Newlines inside text nodes are kept (passage splitting depends on them)."""
    marked = F.regexp_replace(_col(c), MARKUP_RX, MARK)
    return py_strip(decode_entities(F.regexp_replace(marked, f"{MARK}++", " ")))


def squeeze_newlines(c) -> Column:
    """Each newline run with its surrounding blanks becomes one space."""
    return F.regexp_replace(_col(c), NEWLINE_RUN_RX, " ")


def count_newlines(c) -> Column:
    c = _col(c)
    return F.length(c) - F.length(F.replace(c, F.lit("\n"), F.lit("")))


def first_group(c, patterns: list[str], idx: int = 1) -> Column:
    """Group ``idx`` of the first pattern that matches (NULL when none does)."""
    c = _col(c)
    cands = [F.nullif(F.regexp_extract(c, p, idx), F.lit("")) for p in patterns]
    return F.coalesce(*cands)


def last_path_segment(c) -> Column:
    return F.element_at(F.split(_col(c), "/"), -1)


# Default token counter: words, numbers and single punctuation marks.
TOKEN_RX = r"\p{L}+|\p{N}+|[^\p{L}\p{N}\s]"


def token_count(c, pattern: str = TOKEN_RX) -> Column:
    c = _col(c)
    return F.coalesce(F.size(F.regexp_extract_all(c, F.lit(pattern), 0)), F.lit(0))

