"""States, rules and audits: drift of nested JSON, document frequencies by delivery, suffix rules, row audits, and the
scan for a page's object."""

import json
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from skilltrends.operators import idf_state as IS
from skilltrends.operators import lemma_rules as LR
from skilltrends.operators import pages as PG
from skilltrends.operators import row_audit as RA
from skilltrends.operators import select_text as ST
from skilltrends.session import scratch_path
from skilltrends.sources import drift as DR
from skilltrends.sources import versioned as VS


# --- nested drift ------------------------------------------------------------

def brute_paths(day, value, out):
    def kind(v):
        for t, k in ((bool, "boolean"), (int, "integer"), (float, "number"), (str, "string"), (list, "array"), (dict, "object")):
            if isinstance(v, t):
                return k
        return None

    def walk(path, v):
        out.setdefault((day, path), []).append(kind(v))
        if isinstance(v, dict):
            for k, x in v.items():
                walk(f"{path}.{k}", x)
        if isinstance(v, list):
            for x in v:
                walk(f"{path}[]", x)

    walk("$", value)


def random_value(rng, depth):
    r = rng.random()
    if depth and r < 0.35:
        return {rng.choice("abcd"): random_value(rng, depth - 1) for _ in range(rng.randint(0, 3))}
    if depth and r < 0.55:
        return [random_value(rng, depth - 1) for _ in range(rng.randint(0, 3))]
    return rng.choice([1, 2.5, "x", "", True, None])


def test_path_states_equal_a_plain_walk(spark):
    rng = random.Random(4)
    rows = [(rng.randint(1, 4), random_value(rng, 5)) for _ in range(300)]
    want = {}
    for day, v in rows:
        brute_paths(day, v, want)
    df = spark.createDataFrame([(d, json.dumps(v)) for d, v in rows], "day INT, value STRING")
    got = {(r.day, r.path): (set(r.k.split("|")) - {""}, r.n) for r in
           DR.path_states(df, "value", "day").select("day", "path", DR.kind_names("kinds").alias("k"), "n").collect()}

    def joined(kinds):
        kinds = set(kinds) - {None}
        return kinds - {"integer"} if "number" in kinds else kinds

    assert got == {k: (joined(v), len(v)) for k, v in want.items()}


def test_states_merge_in_any_grouping(spark):
    rows = [(1, '{"a": {"b": 1}}'), (1, '{"a": {"b": 2.5}}'), (2, '{"a": [1, {"c": null}]}'), (2, "no json"), (2, None)]
    df = spark.createDataFrame(rows, "day INT, value STRING")
    parts = [DR.path_states(df.where(c), "value", "day") for c in ("value LIKE '%2.5%'", "value NOT LIKE '%2.5%'")]
    whole = sorted(map(tuple, DR.path_states(df, "value", "day").collect()))
    assert sorted(map(tuple, DR.merge_states(parts[0].unionAll(parts[1]), "day").collect())) == whole
    assert (2, "$", DR.KINDS["not json"] | DR.KINDS["object"], 2) in whole


def test_drift_report_names_first_days(spark):
    lines = {1: ['{"u": {"id": 1}, "n": 1}'], 2: ['{"u": {"id": 1, "new": "x"}, "n": 2.5}'], 3: ['{"u": {"id": "t"}, "n": 3}'],
             5: ['{"u": null, "n": 3}'], 6: ['{"u": {"id": 7}, "n": 3}']}
    df = spark.createDataFrame([(d, x) for d, xs in lines.items() for x in xs], "day INT, value STRING")
    got = {tuple(r) for r in DR.drift_report(DR.path_states(df, "value", "day"), "day").collect()}
    assert got == {("$.u.new", "new", 2, "", "string"), ("$.u.new", "missing", 3, "string", ""), ("$.n", "changed", 2, "integer", "number"),
                   ("$.u.id", "changed", 3, "integer", "string"), ("$.u.id", "missing", 5, "integer|string", "")}


def test_drift_of_empty_and_null_days(spark):
    empty = spark.createDataFrame([], "day INT, value STRING")
    assert DR.drift_report(DR.path_states(empty, "value", "day"), "day").count() == 0
    df = spark.createDataFrame([(None, '{"a": 1}'), (1, '{"a": 1, "b": 2}')], "day INT, value STRING")
    assert [tuple(r) for r in DR.drift_report(DR.path_states(df, "value", "day"), "day").collect()] == [("$.b", "new", 1, "", "integer")]


# --- document frequencies as a state ------------------------------------------

def texts(spark, rows):
    return spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "doc_id INT, passage STRING")


def model(df):
    return {r.token: (r.df, round(r.idf, 12)) for r in df.collect()}


def test_deliveries_added_and_subtracted_equal_a_full_fit(spark):
    state = scratch_path(spark, "idf-test")
    assert model(IS.current_idf(spark, state)) == {}
    a, b, b2, c = ["red blue", "red red"], ["green blue", None, ""], ["blue blue", "black"], ["red"]
    for name, part in (("a", a), ("b", b), ("c", c), ("b", b2)):
        IS.deliver(spark, state, name, texts(spark, part))
    assert model(IS.current_idf(spark, state)) == model(ST.fit_idf(texts(spark, a + b2 + c)))
    assert model(IS.current_idf(spark, state, version=3)) == model(ST.fit_idf(texts(spark, a + b + c)))
    IS.deliver(spark, state, "a", texts(spark, a).limit(0))
    assert model(IS.current_idf(spark, state)) == model(ST.fit_idf(texts(spark, b2 + c)))


def test_a_second_writer_of_a_version_gets_a_conflict(spark, monkeypatch):
    state = scratch_path(spark, "idf-race")
    IS.deliver(spark, state, "a", texts(spark, ["one two"]))
    monkeypatch.setattr(VS, "last_version", lambda *_: 0)  # a writer that read the log before the commit
    with pytest.raises(VS.CommitConflict):
        IS.deliver(spark, state, "b", texts(spark, ["three"]))
    monkeypatch.undo()
    assert set(model(IS.current_idf(spark, state))) == {"one", "two"}


# --- suffix rules -------------------------------------------------------------

def brute_lemma(pairs, word, context=LR.CONTEXT, max_strip=LR.MAX_STRIP):
    votes = {}
    for token, lemma, n in pairs:
        same = next((i for i, (x, y) in enumerate(zip(token, lemma)) if x != y), min(len(token), len(lemma)))
        strip = len(token) - same
        for k in range(strip, min(len(token), strip + context) + 1) if strip <= max_strip else ():
            votes.setdefault(token[len(token) - k:], Counter())[strip, lemma[same:]] += n
    for k in range(min(len(word), context + max_strip), -1, -1):
        edits = votes.get(word[len(word) - k:])
        if edits:
            strip, append = min(edits, key=lambda e: (-edits[e], *e))
            return word[:len(word) - strip] + append or word
    return word


def test_rules_equal_brute_force_and_generalise(spark):
    pairs = [("running", "run", 3), ("walking", "walk", 5), ("talking", "talk", 2), ("studies", "study", 4), ("bodies", "body", 1), ("cats", "cat", 7),
             ("was", "be", 9), ("gas", "gas", 2), ("cafés", "café", 1), ("\U0001f600s", "\U0001f600", 1), ("x" * 40, "y", 8), ("s", "", 1)]
    words = ["stalking", "ladies", "dogs", "was", "gas", "s", "ing", "", "zzz", "és", "x" * 50, "\U0001f600\U0001f600s", "walking"]
    p = spark.createDataFrame([*pairs, (None, "a", 1), ("", "a", 1), ("q", None, 1)], "token STRING, lemma STRING, n INT")
    w = spark.createDataFrame([(x,) for x in [*words, *words, None]], "token STRING")
    got = {r.token: (r.lemma, r.known) for r in LR.complete_lemmas(w, p).collect()}
    table = {t: x for t, x, _ in pairs}
    assert got == {x: (table[x], True) if x in table else (brute_lemma(pairs, x), False) for x in words if x}
    assert got["stalking"] == ("stalk", False) and got["ladies"] == ("lady", False) and got["dogs"] == ("dog", False)


def test_held_out_accuracy_on_regular_english_plurals(spark):
    rng = random.Random(2)
    stems = sorted({"".join(rng.choice("bcdfglmnprt") + rng.choice("aeiou") for _ in range(3)) + rng.choice(["n", "t", "y", "ch"]) for _ in range(800)})
    plural = {(s[:-1] + "ies" if s.endswith("y") else s + ("es" if s.endswith("ch") else "s")): s for s in stems}
    held = set(list(plural)[::4])
    p = spark.createDataFrame([(t, x, 1) for t, x in plural.items() if t not in held] + [(x, x, 1) for x in stems], "token STRING, lemma STRING, n INT")
    got = {r.token: r.lemma for r in LR.complete_lemmas(spark.createDataFrame([(t,) for t in held], "token STRING"), p).collect()}
    assert sum(got[t] == plural[t] for t in held) >= 0.98 * len(held)


def test_lemmatize_all_keeps_rows_and_columns(spark):
    p = spark.createDataFrame([("cats", "cat", 1)], "token STRING, lemma STRING, n INT")
    t = spark.createDataFrame([(1, "cats", "x"), (1, "bats", "y"), (2, "bats", "y"), (2, None, "z")], "doc_id INT, token STRING, lemma STRING")
    assert sorted(map(tuple, LR.lemmatize_all(t, p).collect()), key=repr) == [(1, "bat", "y"), (1, "cat", "x"), (2, "bat", "y"), (2, None, "z")]


# --- row audit ----------------------------------------------------------------

def brute_audit(a, b):
    out = {}
    for key in {r[0] for r in a + b}:
        x, y = (Counter(r for r in side if r[0] == key) for side in (a, b))
        if x != y:
            status = ("lost" if not y else "added" if not x else "changed" if set(x) != set(y) else
                      "doubled" if not x - y else "thinned" if not y - x else "changed")
            out[key] = (status, x.total(), y.total())
    return out


def test_audit_equals_plain_multisets(spark):
    rng = random.Random(7)
    a = [(rng.choice([None, *range(60)]), rng.choice([None, "", "a", "b"]), rng.choice([None, 0.0, 1.5])) for _ in range(300)]
    b = [r for r in a if rng.random() > 0.1] + rng.sample(a, 10) + [(99, "a", None), (100, None, None)]
    schema = "k INT, s STRING, x DOUBLE"
    got = {r.k: (r.status, r.n_in, r.n_out) for r in RA.reconcile_rows(spark.createDataFrame(a, schema), spark.createDataFrame(b, schema), ["k"]).collect()}
    assert got == brute_audit(a, b) and {s for s, _, _ in got.values()} >= {"added", "changed"}


def test_audit_of_equal_empty_and_column_wise_shifted_tables(spark):
    a = spark.createDataFrame([(1, "ab", "c"), (1, "ab", "c"), (2, None, "")], "k INT, s STRING, t STRING")
    assert RA.reconcile_rows(a, a.orderBy(F.desc("k")), ["k"]).count() == 0
    assert RA.reconcile_rows(a.limit(0), a.limit(0), ["k"]).count() == 0
    b = spark.createDataFrame([(1, "a", "bc"), (1, "ab", "c"), (2, "", None)], "k INT, s STRING, t STRING")
    assert sorted(map(tuple, RA.reconcile_rows(a, b, ["k"]).collect())) == [(1, "changed", 2, 2), (2, "changed", 1, 1)]
    assert sorted(map(tuple, RA.reconcile_rows(a, a.distinct(), ["k"]).collect())) == [(1, "thinned", 2, 1)]
    assert sorted(map(tuple, RA.reconcile_rows(a, b, ["k"], ["k"]).collect())) == []


def test_audit_of_a_hot_key_shuffles_counts(spark):
    a = spark.range(200_000).select(F.lit(1).alias("k"), (F.col("id") % 5).alias("v"))
    b = a.unionAll(a.limit(1))
    assert [tuple(r) for r in RA.reconcile_rows(a, b, ["k"]).collect()] == [(1, "doubled", 200_000, 200_001)]


# --- the object in a page ------------------------------------------------------

def test_object_ends_at_its_own_brace(spark):
    values = [{"a": 'x};y"{', "b": {"c": "\\"}}, {"a": "\\\"}"}, {}, {"deep": {"d": [{"e": "}"}]}}, {"s": "\U0001f600};\n"}]
    pages = [(i, f"<p>}} \"</p><script>v={json.dumps(v, ensure_ascii=False)}; w={{\"z\": 1}};</script>") for i, v in enumerate(values)]
    pages += [(10, "no object"), (11, None), (12, 'v={"a": "open}'), (13, "v=[1]"), (14, 'v={"a":\n 1}')]
    got = {r.i: r.o for r in spark.createDataFrame(pages, "i INT, html STRING").select("i", PG.object_after("html", "v=").alias("o")).collect()}
    assert [json.loads(got[i]) for i in range(len(values))] == values
    assert got[10] is None and got[11] is None and got[12] == '{"a": "open}' and got[13] is None and json.loads(got[14]) == {"a": 1}


@pytest.mark.parametrize("part", ['\\"', "{", '"};"', "a"])
def test_long_objects_in_linear_time(spark, part):
    import time
    start = time.time()
    body = part * (400_000 // len(part))
    df = spark.range(1).select(F.concat(F.lit('v={"a": "'), F.lit(body), F.lit('"};')).alias("html"))
    df.select(F.length(PG.object_after("html", "v="))).collect()
    assert time.time() - start < 20
