"""Text functions in linear time on hostile texts, and markup against a plain state machine."""

import re
import time

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from skilltrends.functions import terms as TM
from skilltrends.functions import text as X
from skilltrends.operators import extract as EX

SPACE = "\t\n\f\r "


def tokenized(html: str) -> str:
    """Text of a page by the states of an HTML tokenizer, one character at a time: each construct is one mark."""
    out, i, n = [], 0, len(html)

    def tag_end(i: int) -> int:
        """After a tag's ``>``, from behind its first letter."""
        while i < n and html[i] != ">":
            if html[i] == "=":
                i += 1
                while i < n and html[i] in SPACE:
                    i += 1
                if i < n and html[i] in "\"'":
                    close = html.find(html[i], i + 1)
                    i = n if close < 0 else close + 1
            else:
                i += 1
        return min(n, i + 1)

    def named(i: int, name: str) -> bool:
        return html[i:i + len(name)].lower() == name and (i + len(name) >= n or html[i + len(name)] in SPACE + "/>")

    while i < n:
        if html[i] != "<":
            out.append(html[i])
            i += 1
            continue
        nxt = html[i + 1:i + 2]
        raw = next((x for x in ("script", "style", "template") if named(i + 1, x)), None)
        if html.startswith("<!--", i):
            i += 4
            if m := re.compile("-?>").match(html, i):
                i = m.end()
            else:
                m = re.compile("--!?>").search(html, i)
                i = m.end() if m else n
        elif raw:
            i = tag_end(i + 2)
            while i < n and not (html.startswith("</", i) and named(i + 2, raw)):
                i += 1
            i = tag_end(i + 3) if i < n else n
        elif re.match("[a-zA-Z]", nxt) or (nxt == "/" and re.match("[a-zA-Z]", html[i + 2:i + 3])):
            i = tag_end(i + (3 if nxt == "/" else 2))
        elif nxt and nxt in "!?" or (nxt == "/" and i + 2 < n):
            close = html.find(">", i + 2)
            i = n if close < 0 else close + 1
        else:
            out.append("<")
            i += 1
            continue
        out.append(X.MARK)
    return "".join(out)


PIECES = ["<", ">", "</", "<!--", "-->", "--!>", "-", "!", "?", "<a ", "<b>", "</b>", "<script", "</script>", "</script ", "<STYLE>", "</style>",
          "<template>", "</template>", "=", '"', "'", " ", "\n", "x", "a=\"", "b='", "/", "&amp;", "é"]


def test_markup_equals_the_state_machine(spark):
    import random
    rng = random.Random(11)
    rows = [(i, "".join(rng.choices(PIECES, k=rng.randrange(1, 25)))) for i in range(4000)]
    got = spark.createDataFrame(rows, "i INT, html STRING").select("html", F.regexp_replace("html", X.MARKUP_RX, X.MARK).alias("t")).collect()
    for r in got:
        assert r.t == tokenized(r.html), r.html


BLANKS = ["a", "b", " ", "\t", "\n", "\r", " ", "\x1c", " ", "\x85"]


def test_blank_runs_equal_python(spark):
    import random
    rng = random.Random(4)
    rows = [(i, "".join(rng.choices(BLANKS, k=rng.randrange(0, 14)))) for i in range(3000)]
    got = spark.createDataFrame(rows, "i INT, t STRING").select("t", X.py_strip("t").alias("s"), X.squeeze_newlines("t").alias("q")).collect()
    for r in got:
        assert r.s == r.t.strip() and r.q == re.sub(r"\s*\n+\s*", " ", r.t), repr(r.t)


@pytest.mark.parametrize("name, unit", [("comment", "<!--"), ("tag", "<a "), ("script", "<script"), ("closed script", "<script></script "),
                                        ("declaration", "<!"), ("less", "<"), ("end", "</"), ("quote", "<a b=\"'"), ("equals", "<a ="), ("blank", " ")])
def test_ten_megabytes_of_markup(spark, name, unit):
    df = spark.range(1).select(F.expr(f"repeat({chr(39)}{unit.replace(chr(39), chr(92) + chr(39))}{chr(39)}, {10_000_000 // len(unit)})").alias("html"))
    df = df.select(F.concat(F.lit("x"), "html", F.when(F.lit(name == "blank"), "y").otherwise("")).alias("html"))
    began = time.perf_counter()
    text = df.select(X.html_to_text("html").alias("t")).first().t
    assert time.perf_counter() - began < 12
    assert text[0] == "x"


def test_a_megabyte_of_blanks_brackets_and_dots(spark):
    n = 1_000_000
    df = spark.range(1).select(F.concat(F.lit("a"), F.expr(f"repeat(' ', {n})"), F.lit("b")).alias("blanks"),
                               F.concat(F.lit("[a"), F.expr(f"repeat(']', {n})"), F.lit("b")).alias("brackets"),
                               F.expr(f"repeat('a.', {n})").alias("dots"))
    began = time.perf_counter()
    r = df.select(X.squeeze_newlines("blanks").alias("q"), X.py_strip("blanks").alias("s"), TM.parse_bracket_list("brackets").alias("p"),
                  F.size(EX.words("dots")).alias("w")).first()
    assert time.perf_counter() - began < 12
    assert len(r.q) == len(r.s) == n + 2 and r.p == ["a" + "]" * n + "b"] and r.w == 1


def test_alias_of_two_canonical_terms_takes_the_first(spark):
    df = spark.createDataFrame([(["ML", "x", None],)], "t ARRAY<STRING>")
    got = df.select(TM.canonicalize("t", [("ml", "machine learning"), ("ML", "markup"), ("x", "y")]).alias("t")).first().t
    assert got == ["machine learning", "y", None]


@settings(max_examples=30, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="[],a \t\n", max_size=12), min_size=1, max_size=30))
def test_bracket_lists_equal_python(spark, texts):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i INT, t STRING")
    for r in rows.select("t", TM.parse_bracket_list("t").alias("p")).collect():
        assert r.p == ([x.strip() for x in r.t.strip("[]").split(",")] if r.t.startswith("[") else [])
