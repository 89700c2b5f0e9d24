"""Spark results against plain-Python statements of the same semantics, on the whole
smallest tables (independent of the SQL oracle)."""

import re
from html.parser import HTMLParser

import duckdb
from pyspark.sql import functions as F

from skilltrends import rules as R
from skilltrends.functions import text as X
from skilltrends.operators import clean as C
from skilltrends.operators import select_text as ST
from skilltrends.operators import views as V
from skilltrends.plans import analogues as A

from .conftest import SMOKE


class _Text(HTMLParser):
    """Text nodes outside script/style/template, entities decoded."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.parts, self.skip = [], 0

    def handle_starttag(self, tag, attrs):
        if tag in ("script", "style", "template"):
            self.skip += 1

    def handle_endtag(self, tag):
        if tag in ("script", "style", "template") and self.skip:
            self.skip -= 1

    def handle_data(self, data):
        if not self.skip:
            self.parts.append(data)


def visible_text(html: str) -> str:
    p = _Text()
    p.feed(html)
    p.close()
    return " ".join(p.parts).strip()


def rows(sql: str):
    return duckdb.sql(sql).fetchall()


def test_html_text_equals_parser_text(spark):
    got = {r.page_id: r.t for r in spark.read.parquet(f"{SMOKE}/pages.parquet")
           .select("page_id", X.html_to_text("html").alias("t")).collect()}
    for pid, html in rows(f"SELECT page_id, html FROM '{SMOKE}/pages.parquet'"):
        assert got[pid] == visible_text(html), pid


def test_passages_and_squeeze_equal_python(spark):
    docs = dict(rows(f"SELECT doc_id, text FROM '{SMOKE}/documents.parquet'"))
    df = spark.read.parquet(f"{SMOKE}/documents.parquet").select("doc_id", "text")

    def cut(**options):
        got: dict[int, list[tuple]] = {}
        for r in ST.passages(df, **options).collect():
            got.setdefault(r.doc_id, []).append((r.pos, r.passage))
        return {k: [p for _, p in sorted(v)] for k, v in got.items()}

    whole, part = cut(), cut(short_docs="drop", remainder="drop")
    for doc_id, text in docs.items():
        k = text.count("\n") // 5
        assert part.get(doc_id, []) == (re.findall("\n".join(["[^\n]+"] * k), text) if k > 0 else []), doc_id
        lines = [x for x in text.split("\n") if x]
        assert [x for p in whole.get(doc_id, []) for x in p.split("\n") if x] == lines, doc_id  # no line is lost
    squeezed = {r.doc_id: r.t for r in df.select("doc_id", X.squeeze_newlines("text").alias("t")).collect()}
    for doc_id, text in docs.items():
        assert squeezed[doc_id] == re.sub(r"\s*\n+\s*", " ", text), doc_id


def py_clean(terms, patterns, rules):
    kept = [t for t in terms if not any(re.search(p, t, re.I) for p in patterns)]
    out = []
    for t in kept:
        for p, rep in rules:
            if re.search(p, t, re.I):
                t = rep
                break
        out.append(t)
    return out


def test_clean_and_view_equal_python(spark):
    posts = A.postings(spark, SMOKE)
    clean = C.clean_terms(posts.withColumn("src", F.col("cleaned_techs")),
                          patterns=A.REMOVE_PATTERNS, rules=A.MAP_RULES)
    for r in clean.collect():  # input and output of the same row
        assert list(r.cleaned_techs) == py_clean(list(r.src), A.REMOVE_PATTERNS, A.MAP_RULES)

    kws = {k: set(v) for k, v in ((r.job_key, r.keyword) for r in A.keywords(spark, SMOKE).collect())}
    expected = sum(len(r.cleaned_techs) * len(kws.get(r.job_key, ())) for r in clean.collect())
    assert V.jobs_view(clean, A.keywords(spark, SMOKE)).count() == expected


def test_production_rules_on_every_part_name(spark):
    # the production rule set applied to real strings agrees with the Python statement
    parts = spark.read.parquet(f"{SMOKE}/part.parquet").select(
        F.array("p_name", "p_type").alias("cleaned_techs"), F.array("p_name", "p_type").alias("src"))
    for r in C.clean_terms(parts).collect():
        assert list(r.cleaned_techs) == py_clean(list(r.src), R.REMOVE_PATTERNS, R.MAP_RULES)


def test_full_entity_decoding_matches_parser(spark):
    pages = ["<p>It&rsquo;s &#39;remote&#39; &amp;&#x2019; caf&eacute;</p><p>&lt;b&gt; &nbsp;x</p>",
             "<div>no entities</div>", "&amp;lt;kept&amp;gt;"]
    df = spark.createDataFrame([(i, h) for i, h in enumerate(pages)], "i INT, html STRING")
    got = [r.t for r in df.orderBy("i").select(X.html_to_text("html").alias("t")).collect()]
    assert got == [visible_text(h) for h in pages]


def test_every_named_entity_and_long_runs_of_markup(spark):
    import html.entities
    names = sorted(n for n in html.entities.html5 if n.endswith(";"))
    rows = [(i, f"x&{n}y") for i, n in enumerate(names)]
    rows += [(-1, "<br>" * 100_000 + "end"), (-2, "a" + "<p></p>" * 100_000 + "b" + "<!-- x -->" * 50_000)]
    df = spark.createDataFrame(rows, "i INT, html STRING")
    got = {r.i: r.t for r in df.select("i", X.html_to_text("html").alias("t")).collect()}
    assert all(got[i] == f"x{html.entities.html5[n]}y" for i, n in enumerate(names))
    assert got[-1] == "end" and got[-2] == "a b"
