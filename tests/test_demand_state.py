"""The demand state: days' bitmaps, added and replaced, against plain sets."""

import datetime as dt
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from skilltrends.operators import demand_state as DS
from skilltrends.operators import views as V
from skilltrends.session import scratch_path
from skilltrends.sources import versioned as VS

VIEW = "job_key STRING, tech STRING, job_date DATE, kw STRING"


def day(n):
    return None if n is None else dt.date(2024, 1, 1) + dt.timedelta(days=n)


def frame(spark, rows):
    return spark.createDataFrame([(k, t, day(d), w) for k, t, d, w in rows], VIEW)


def brute(rows, low=None, high=None):
    sets = defaultdict(set)
    for k, t, d, w in rows:
        if k is not None and (low is None or (d is not None and low <= d <= high)):
            sets[w, t].add(k)
    return {p: len(s) for p, s in sets.items()}


def counts(df):
    return {(r.kw, r.tech): r.n_postings for r in df.collect()}


def rows_of(rnd, days, n=400):
    return [(rnd.choice([None, *[f"job {rnd.randrange(150)}"] * 20]), rnd.choice([None, "a", "b", "c"]), rnd.choice(days), rnd.choice([None, "x", "y"]))
            for _ in range(n)]


def test_any_range_equals_sets_after_days_come_again(spark):
    rnd, state = random.Random(3), scratch_path(spark, "demand-test")
    assert DS.partials(spark, state).count() == 0
    one, two, three = rows_of(rnd, range(5)), rows_of(rnd, range(5, 8)), rows_of(rnd, [None, 8, 9])
    again = rows_of(rnd, [3, 4], 60)
    for part in (one, two, three, again):
        DS.deliver(spark, state, frame(spark, part))
    stands = [r for r in one if r[2] not in (3, 4)] + again + two + three
    assert counts(DS.demand(DS.partials(spark, state))) == brute(stands)
    assert counts(DS.demand(DS.partials(spark, state, version=3))) == brute(one + two + three)
    assert counts(DS.demand(DS.partials(spark, state, day(2), day(6)))) == brute(stands, 2, 6)
    got = {(r.tech, r.job_date): r.n_postings for r in DS.trend(DS.partials(spark, state)).collect()}
    want = defaultdict(set)
    for k, t, d, _ in stands:
        if k is not None:
            want[t, day(d)].add(k)
    assert got == {p: len(s) for p, s in want.items()}


def test_common_terms_need_a_bit_a_posting(spark):
    state = scratch_path(spark, "demand-dense")
    DS.deliver(spark, state, frame(spark, [(f"{i:05d}", "a", 0, "x") for i in range(6400)] * 2))
    DS.deliver(spark, state, frame(spark, [(f"{i:05d}", "a", 1, "x") for i in range(3000, 6401)]))
    words = DS.partials(spark, state)
    assert counts(DS.demand(words)) == {("x", "a"): 6401}
    tasks = words.where("job_date = '2024-01-01'").select(F.shiftright("word", 27)).distinct().count()
    assert words.where("job_date = '2024-01-01'").count() <= 100 + tasks


def test_an_empty_delivery_empties_its_days_and_leaves_others(spark):
    state = scratch_path(spark, "demand-empty")
    rows = [("j", "a", 0, "x"), ("k", "a", 1, "x")]
    DS.deliver(spark, state, frame(spark, rows))
    DS.deliver(spark, state, frame(spark, rows[:0]))
    assert counts(DS.demand(DS.partials(spark, state))) == {("x", "a"): 2}
    DS.deliver(spark, state, frame(spark, rows[:0]), days=spark.createDataFrame([(day(1),)], "job_date DATE"))
    assert counts(DS.demand(DS.partials(spark, state))) == {("x", "a"): 1}


def test_only_the_delivered_days_are_written(spark):
    state = scratch_path(spark, "demand-touched")
    rows = [(f"j{i}", "a", i % 10, "x") for i in range(100)]
    DS.deliver(spark, state, frame(spark, rows))
    v = DS.deliver(spark, state, frame(spark, [r for r in rows if r[2] == 4]))
    changed = VS.state(spark, state, v).where(F.col("path").startswith(DS.DAY)).groupBy(F.col("files")[0]).count().collect()
    assert sorted(r["count"] for r in changed) == [1, 9]
    view = frame(spark, rows).withColumn("job_key", F.col("job_key"))
    keys = spark.createDataFrame([("j4",), ("j17",), ("j17",)], "job_key STRING")
    assert {r.job_date for r in DS.touched_days(view, keys).collect()} == {day(4), day(7)}


def test_a_second_writer_gets_a_conflict_and_keys_keep_one_number(spark, monkeypatch):
    state = scratch_path(spark, "demand-race")
    DS.deliver(spark, state, frame(spark, [("j", "a", 0, "x")]))
    monkeypatch.setattr(VS, "last_version", lambda *_: 0)
    with pytest.raises(VS.CommitConflict):
        DS.deliver(spark, state, frame(spark, [("k", "a", 1, "x")]))
    monkeypatch.undo()
    DS.deliver(spark, state, frame(spark, [("k", "a", 1, "x"), ("j", "a", 1, "x")]))
    assert counts(DS.demand(DS.partials(spark, state))) == {("x", "a"): 2}


def exchanged(df):
    df.write.format("noop").mode("overwrite").save()
    p = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan")[0]
    return [i for i, line in enumerate(p.splitlines()) if "Exchange hashpartitioning" in line], [i for i, line in enumerate(p.splitlines()) if "Generate explode" in line]


def test_a_nested_view_equals_the_un_nested_and_costs_a_row_a_posting_day(spark):
    rnd, flat, nested = random.Random(5), scratch_path(spark, "demand-flat"), scratch_path(spark, "demand-nested")
    posts = [(rnd.choice([None, *[f"job {rnd.randrange(60)}"] * 9]), rnd.choice([None, [], ["a"], ["a", "b", "a"], [None, "c"], list("abcdefgh")]),
              2024, rnd.choice([1, 1, None]), rnd.randrange(1, 5)) for _ in range(300)]
    kws = [(f"job {i}", rnd.choice([None, [], ["x"], ["y", "x"], ["x", None, "y"]])) for i in range(50)] * 2
    p = spark.createDataFrame(posts, "job_key STRING, cleaned_techs ARRAY<STRING>, year INT, month INT, day INT")
    k = spark.createDataFrame(kws, "job_key STRING, keyword ARRAY<STRING>")
    parts = [p, p.where("day = 2 AND month = 1")]  # the second comes again
    for part in parts:
        DS.deliver(spark, flat, V.jobs_view(part, k))
        DS.deliver(spark, nested, V.jobs_view(part, k, nested=True))
    for of in (DS.demand, DS.trend):
        one, two = (sorted(map(repr, of(DS.partials(spark, state)).collect())) for state in (flat, nested))
        assert one == two and one
    want = sorted(map(repr, V.demand_by_keyword(V.jobs_view(p, k)).collect()))
    assert want == sorted(map(repr, DS.demand(DS.partials(spark, nested)).select("kw", "tech", "n_postings").collect()))
    days = V.jobs_view(p, k, nested=True).where("job_key IS NOT NULL").select("job_key", "job_date", "techs").distinct().count()
    assert DS.partials(spark, nested).count() <= days


def test_no_row_for_each_keyword_and_term_is_shuffled(spark):
    state = scratch_path(spark, "demand-plan")
    DS.deliver(spark, state, frame(spark, rows_of(random.Random(9), range(5))))
    shuffles, explodes = exchanged(DS.demand(DS.partials(spark, state)))
    # plans are written from the result down: only the counted groups are shuffled above the un-nest
    assert len(explodes) == 2 and len([s for s in shuffles if s < min(explodes)]) == 1 and any(s > max(explodes) for s in shuffles)
