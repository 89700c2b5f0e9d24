"""Rule, word and alias tables of any size give what the literal expressions give; dictionaries through the automaton."""

import random
import re
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from skilltrends.functions import terms as T
from skilltrends.operators import clean as C
from skilltrends.operators import extract as EX
from skilltrends.operators import rule_index as RI

RULES = "rank INT, pattern STRING, replacement STRING"


@pytest.mark.parametrize("pattern, want", [
    (r"\b(word|office)\b", ["office", "word"]), (r"\bSkills\b", ["skills"]), (r"a?b+cd", ["cd"]), (r"\d+", None), (r"x|\d", None), (r"(ab)?", None),
    (r"(?i)aB", ["ab"]), (r"(?s)ab", None), (r"\Qa.b\E", None), (r"café", ["caf"]), (r"a\.b", ["a.b"]), (r"[ab]long", ["long"]), (r"(?:abc|d.)ef", ["ef"]), (r"x{2,}", ["x"]),
    (r"\p{L}+ab", None), (r"(", None), ("", None)])
def test_required_literals(pattern, want):
    assert RI.required_literals(pattern) == want


ATOMS = ["a", "b", "ab", "Kelvin", "s", r"\b", r"\d", ".", "[ab]", "(ab|s)", "(a|)", "x?", "i+", "(?:ba){2}", "^", "$", "é"]


def test_every_match_holds_a_required_literal():
    rng = random.Random(6)
    fold = str.maketrans(RI.UPPER + RI.FOLDED[0], RI.UPPER.lower() + RI.FOLDED[1])
    seen = 0
    for _ in range(4000):
        p = "".join(rng.choices(ATOMS, k=rng.randrange(1, 5)))
        p = p if rng.random() < 0.7 else f"{p}|{''.join(rng.choices(ATOMS, k=2))}"
        literals = RI.required_literals(p)
        for _ in range(5):
            t = "".join(rng.choices(["a", "b", "ab", "KELVIN", "S", "ſ", "s", "1", "İ", "i", "ba", " ", "x", "é"], k=rng.randrange(1, 8)))
            if literals is not None and re.search(p, t, re.I):
                seen += 1
                assert any(x in t.translate(fold) for x in literals), (p, t)
    assert seen > 500


def table(rng, n):
    words = ["".join(rng.choices("abcdefghijks", k=rng.randrange(3, 8))) for _ in range(n)]
    shapes = [r"\b{}\b", "{}", r"\b({}|zz)\b", "^{}", r"{}\d*$", r"(?i:{})"]
    rules = [(i, rng.choice(shapes).format(w), f"r{i}") for i, w in enumerate(words)]
    return rules + [(n, r"^\d+$", "number"), (n + 1, r"^.{12,}$", "long"), (n // 2, "^[xyz]+$", "xyz")]


def test_twenty_thousand_rules_equal_first_match_in_order(spark):
    rng = random.Random(1)
    rules = table(rng, 20_000)
    terms = ["".join(rng.choices("abcdefghijks Kſxyz12", k=rng.randrange(1, 14))) for _ in range(200)]
    terms += [rng.choice(["", "the ", "X"]) + re.sub(r"[^a-z]|zz", "", p).upper() + rng.choice(["", "1", " x"]) for _, p, _ in rng.sample(rules, 200)]
    terms += ["aws", None, "", "xyz", "123", "KELVIN"]
    compiled = [(r, re.compile(p, re.I), x) for r, p, x in sorted(rules)]

    def first(t):
        return None if t is None else next((x for _, p, x in compiled if p.search(t)), t)

    rows = [(i, t) for i, t in enumerate(terms * 3)]
    out = C.map_terms_by_table(spark.createDataFrame(rows, "i INT, term STRING"), spark.createDataFrame(rules, RULES))
    got = out.collect()
    assert len(got) == len(rows)
    for r in got:
        if r.term is None or "ſ" not in r.term:  # Python folds that letter as Java does; its \b and \d agree on the rest
            assert r.mapped == first(r.term), r.term


def test_large_tables_equal_the_literal_expressions(spark, monkeypatch):
    rng = random.Random(3)
    rules = spark.createDataFrame(table(rng, 60), RULES)
    words = spark.createDataFrame([(i, rf"\b{x}\b") for i, x in enumerate(["ab", "skills", "c d", "e.e", "K"])], "rank INT, pattern STRING")
    aliases = spark.createDataFrame([("one", "AB"), ("two", "ab"), ("three", "cd"), ("one", "e k")], "name STRING, item STRING")
    stops = spark.createDataFrame([("exact", "AB"), ("exact", "dd"), ("partial", "k."), ("partial", "cD"), ("partial", "b")], "name STRING, item STRING")
    items = [["".join(rng.choices("abcdeKs .", k=rng.randrange(1, 6))) for _ in range(rng.randrange(5))] for _ in range(400)]
    items += [None, [], ["ab", None], ["ab", "AB", "cd", "K."], ["skills ab"]]
    df = spark.createDataFrame(list(enumerate(items)), "i INT, cleaned_techs ARRAY<STRING>").repartition(3)
    terms = df.select("i", F.explode("cleaned_techs").alias("term"))

    def results():
        lists = [C.remove_terms_by_table(df, words), C.alias_terms_by_table(df, aliases), C.drop_stoplisted_by_table(df, stops)]
        return [Counter(map(repr, x.collect())) for x in (*lists, C.map_terms_by_table(terms, rules))]

    inline = results()
    monkeypatch.setattr(RI, "INLINE", 1)
    monkeypatch.setattr(RI, "PER_BATCH", 2)
    monkeypatch.setattr(RI, "BLOCK_BYTES", 100)
    indexed = results()
    assert inline == indexed


def test_a_rule_table_of_a_hundred_thousand(spark):
    rules = spark.range(100_000).select(F.col("id").cast("int").alias("rank"), F.concat(F.lit(r"\b"), F.md5(F.col("id").cast("string")), F.lit(r"\b")).alias("pattern"),
                                        F.concat(F.lit("r"), F.col("id").cast("string")).alias("replacement"))
    terms = spark.range(0, 200_000, 7).select("id", F.concat(F.lit("the "), F.upper(F.md5(F.col("id").cast("string")))).alias("term"))
    began = time.perf_counter()
    out = C.map_terms_by_table(terms, rules)
    bad = out.filter(F.col("mapped") != F.when(F.col("id") < 100_000, F.concat(F.lit("r"), F.col("id").cast("string"))).otherwise(F.col("term"))).count()
    assert bad == 0 and time.perf_counter() - began < 120


@pytest.mark.parametrize("block_words", [1_000_000, 40])
def test_dictionary_counts_equal_plain_counts(spark, block_words):
    rng = random.Random(9)
    words = ["a", "b", "c", "node.js", "c++", "d"]
    aliases = [(" ".join(rng.choices(words, k=rng.randrange(1, 11))), f"t{rng.randrange(20)}") for _ in range(200)] + [("A  b", "t1"), ("a b", "t2"), ("!", "t3")]
    texts = [(i % 40, " ".join(rng.choices([*words, "zzz", "C++"], k=rng.randrange(0, 60)))) for i in range(60)] + [(7, None), (None, "a b"), (50, "")]
    want = Counter()
    tokens = {a: re.findall(r"\w+(?:[.]\w+)*(?:[+]+|#)?", a.lower()) for a, _ in aliases}
    pairs = {(tuple(tokens[a]), t) for a, t in aliases if tokens[a]}
    for key, text in texts:
        w = re.findall(r"\w+(?:[.]\w+)*(?:[+]+|#)?", (text or "").lower())
        for a, t in pairs:
            want[key, t] += sum(tuple(w[i:i + len(a)]) == a for i in range(len(w)))
    got = EX.extract_by_dictionary(spark.createDataFrame(texts, "doc_id INT, text STRING").repartition(3),
                                   spark.createDataFrame(aliases, "alias STRING, term STRING"), block_words=block_words)
    assert "Generate" not in got._jdf.queryExecution().executedPlan().toString()  # no row per n-gram
    assert {(r.doc_id, r.term): r.n_mentions for r in got.collect()} == {k: n for k, n in want.items() if n}


def test_an_empty_dictionary(spark):
    none = spark.createDataFrame([], "alias STRING, term STRING")
    assert EX.extract_by_dictionary(spark.createDataFrame([(1, "a")], "doc_id INT, text STRING"), none).collect() == []
