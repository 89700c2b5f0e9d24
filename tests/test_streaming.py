"""Incremental ingestion = batch result; a rerun changes nothing; a delivery that comes again, under its own
path or a higher number, replaces its rows in one commit."""

import pytest

from pyspark.sql import functions as F

from skilltrends import session as S
from skilltrends.plans.queries import land_events
from skilltrends.schemas import EVENT
from skilltrends.sources import jsonl as J
from skilltrends.sources import sinks as SK
from skilltrends.sources import versioned as VS
from skilltrends.streaming import ingest as IN

from .conftest import SMOKE


def transform(batch):
    cols = ["event_id", "event_type", "year", "month", "day"]
    return J.with_file_date(batch).select(*cols, *[c for c in ("delivery",) if c in batch.columns])


def land_file(spark, landing, drop, name, ids):
    spark.createDataFrame([(i, "e") for i in ids], "event_id LONG, event_type STRING").coalesce(1).write.json(f"{landing}/{drop}/{name}")


def test_two_files_of_a_day_and_a_second_delivery(spark):
    landing, sink, ckpt = (S.scratch_path(spark, x) for x in ("t-landing", "t-sink", "t-ckpt"))

    def ids():
        return sorted(r.event_id for r in VS.read_live(spark, sink).collect())

    land_file(spark, landing, "d1", "am_01_02_2024.json", [1, 2])
    land_file(spark, landing, "d1", "pm_01_02_2024.json", [3])
    IN.ingest(spark, landing, EVENT, transform, sink, ckpt, max_files_per_trigger=1)  # two micro-batches
    assert ids() == [1, 2, 3]
    land_file(spark, landing, "d2", "eve_01_02_2024.json", [4])  # between runs
    IN.ingest(spark, landing, EVENT, transform, sink, ckpt)
    assert ids() == [1, 2, 3, 4]
    land_file(spark, landing, "d3", "am_01_02_2024.json", [10])  # delivered again
    IN.ingest(spark, landing, EVENT, transform, sink, ckpt)
    assert ids() == [3, 4, 10]
    land_file(spark, landing, "d4", "pm_01_02_2024.json", [30])  # twice in one micro-batch: the last folder wins
    land_file(spark, landing, "d5", "pm_01_02_2024.json", [31])
    IN.ingest(spark, landing, EVENT, transform, sink, ckpt)
    assert ids() == [4, 10, 31]


def test_parts_and_equal_names_over_micro_batches(spark):
    landing, sink, ckpt = (S.scratch_path(spark, x) for x in ("t-landing", "t-sink", "t-ckpt"))

    def land(folder, name, ids, parts=1):
        rows = spark.createDataFrame([(i, "e") for i in ids], "event_id LONG, event_type STRING")
        rows.repartition(parts).write.mode("append").json(f"{landing}/{folder}/{name}")

    def ids():
        return sorted(r.event_id for r in VS.read_live(spark, sink).collect())

    def run():
        IN.ingest(spark, landing, EVENT, transform, sink, ckpt, max_files_per_trigger=1)

    land("siteA", "jobs_01_02_2024.json", range(9), parts=3)
    land("siteB", "jobs_01_02_2024.json", range(20, 23))
    run()
    assert ids() == [*range(9), 20, 21, 22]
    land("siteA", "jobs_01_02_2024.json", [9])  # a part that lands after the run
    run()
    assert ids() == [*range(10), 20, 21, 22]
    land("siteA/d10", "jobs_01_02_2024.json", range(30, 36), parts=2)  # delivered again in two parts
    run()
    assert ids() == [20, 21, 22, *range(30, 36)]
    land("siteA/d9", "jobs_01_02_2024.json", [40])  # an earlier delivery comes late
    run()
    assert ids() == [20, 21, 22, *range(30, 36)]


def test_files_per_day_are_few(spark):
    import glob
    df = spark.range(20_000).selectExpr("id", "2024 AS year", "1 AS month", "CAST(id % 5 + 1 AS INT) AS day").repartition(16)
    path = SK.write_daily(df, S.scratch_path(spark, "t-files"))
    for day in range(1, 6):
        assert len(glob.glob(path.removeprefix("file:") + f"/year=2024/month=1/day={day}/*.parquet")) == 1


def test_ingest_equals_batch_and_rerun_is_noop(spark):
    landing = land_events(spark, SMOKE)
    sink, ckpt = S.scratch_path(spark, "t-sink"), S.scratch_path(spark, "t-ckpt")
    IN.ingest(spark, landing, EVENT, transform, sink, ckpt)
    first = sorted(map(tuple, VS.read_live(spark, sink).select("event_id", "day").collect()))
    batch = transform(J.scan_jsonl(spark, landing, EVENT)).select("event_id", "day")
    assert first == sorted(map(tuple, batch.collect()))
    assert IN.ingest(spark, landing, EVENT, transform, sink, ckpt) == []
    again = sorted(map(tuple, VS.read_live(spark, sink).select("event_id", "day").collect()))
    assert again == first


def test_redelivered_day_replaces_only_that_day(spark):
    df = spark.createDataFrame([(1, 2024, 1, 1, 1.0), (2, 2024, 1, 2, 2.0)],
                               "id INT, year INT, month INT, day INT, v DOUBLE")
    path = SK.write_daily(df, S.scratch_path(spark, "t-daily"))
    SK.write_daily(spark.createDataFrame([(3, 2024, 1, 2, 9.0)], df.schema), path)
    got = sorted(map(tuple, spark.read.parquet(path).select("id", "day", "v").collect()))
    assert got == [(1, 1, 1.0), (3, 2, 9.0)]


def test_corrupt_lines_are_flagged_not_fatal(spark):
    root = land_events(spark, SMOKE, broken_errors=True)
    rows = J.scan_jsonl(spark, root, EVENT).select("event_id", "_corrupt_record").collect()
    n_bad = sum(r["_corrupt_record"] is not None for r in rows)
    n_err = spark.read.parquet(f"{SMOKE}/events.parquet").where(F.col("event_type") == "error").count()
    assert n_bad == n_err and len(rows) > n_bad


def put(spark, path, ids, end=""):
    """One JSON-lines file, over what is there."""
    fs, p = VS.hadoop_path(spark, path)
    out = fs.create(p, True)
    out.write("".join(f'{{"event_id": {i}, "event_type": "e"}}\n' for i in ids).encode() + end.encode())
    out.close()
    tick = spark._jvm.java.lang.System.currentTimeMillis()
    put.clock = max(tick, getattr(put, "clock", 0) + 1)
    fs.setTimes(p, put.clock, -1)


def live(spark, sink, version=None):
    return sorted(r.event_id for r in VS.read_live(spark, sink, version=version, schema=None).collect())


def test_a_file_delivered_again_under_its_own_path(spark):
    landing, sink = S.scratch_path(spark, "t-landing"), S.scratch_path(spark, "t-sink")
    put(spark, f"{landing}/a b/jobs_01_02_2024.json", [1])
    put(spark, f"{landing}/jobs_02_02_2024.json", [5])
    assert IN.ingest(spark, landing, EVENT, transform, sink) == [1]
    put(spark, f"{landing}/a b/jobs_01_02_2024.json", [2, 3])
    assert IN.ingest(spark, landing, EVENT, transform, sink) == [2]
    assert live(spark, sink) == [2, 3, 5] and live(spark, sink, version=1) == [1, 5]
    put(spark, f"{landing}/jobs_02_02_2024.json", [])  # an empty file is no delivery
    assert IN.ingest(spark, landing, EVENT, transform, sink) == []
    put(spark, f"{landing}/jobs_02_02_2024.json", [], end="\n")  # a delivery without rows
    assert IN.ingest(spark, landing, EVENT, transform, sink) == [3]
    assert live(spark, sink) == [2, 3]
    assert VS.vacuum(spark, sink, keep=1) == 2 and live(spark, sink) == [2, 3]
    assert IN.ingest(spark, landing, EVENT, transform, sink) == []


def test_readers_between_the_steps_of_a_commit(spark, monkeypatch):
    landing, sink = S.scratch_path(spark, "t-landing"), S.scratch_path(spark, "t-sink")
    put(spark, f"{landing}/1/jobs_01_02_2024.json", [1])
    IN.ingest(spark, landing, EVENT, transform, sink)
    put(spark, f"{landing}/2/jobs_01_02_2024.json", [2])  # a higher number
    seen, commit = [], VS.write_commit

    def stopped(*a):
        seen.append(live(spark, sink))
        raise KeyboardInterrupt

    monkeypatch.setattr(VS, "write_commit", stopped)
    with pytest.raises(KeyboardInterrupt):  # rows are written, the commit never comes
        IN.ingest(spark, landing, EVENT, transform, sink)
    assert seen == [[1]] and live(spark, sink) == [1]
    monkeypatch.setattr(VS, "write_commit", lambda *a: seen.append(live(spark, sink)) or commit(*a))
    assert IN.ingest(spark, landing, EVENT, transform, sink) == [2]
    assert seen[1] == [1] and live(spark, sink) == [2]


def test_two_writers_and_snapshots(spark, monkeypatch):
    landing, sink = S.scratch_path(spark, "t-landing"), S.scratch_path(spark, "t-sink")
    monkeypatch.setattr(VS, "SNAPSHOT_EVERY", 3)
    for i in range(1, 5):
        put(spark, f"{landing}/jobs_0{i}_02_2024.json", [i])
    versions = VS.last_version

    def late(spark, sink, other=[True]):
        version = versions(spark, sink)
        if other and other.pop():  # another writer commits right after this one has looked
            VS.write_commit(spark, sink, version + 1, [])
        return version

    monkeypatch.setattr(VS, "last_version", late)
    assert IN.ingest(spark, landing, EVENT, transform, sink, max_files_per_trigger=1) == [2, 3, 4, 5]
    assert live(spark, sink) == [1, 2, 3, 4] and VS.log_files(spark, sink) == ([1, 2, 3, 4, 5], [3])
    put(spark, f"{landing}/jobs_01_02_2024.json", [10])
    IN.ingest(spark, landing, EVENT, transform, sink)
    assert live(spark, sink) == [2, 3, 4, 10] and live(spark, sink, version=4) == [1, 2, 3]
    with pytest.raises(VS.CommitConflict):
        VS.write_commit(spark, sink, 5, [])


def test_parts_that_are_gone_go_with_the_next_delivery(spark):
    landing, sink = S.scratch_path(spark, "t-landing"), S.scratch_path(spark, "t-sink")
    folder = f"{landing}/jobs_01_02_2024.json"
    put(spark, f"{folder}/part-0.json", [1])
    put(spark, f"{folder}/part-1.json", [2])
    IN.ingest(spark, landing, EVENT, transform, sink)
    fs, p = VS.hadoop_path(spark, f"{folder}/part-1.json")
    fs.delete(p, False)
    assert IN.ingest(spark, landing, EVENT, transform, sink) == [] and live(spark, sink) == [1, 2]  # an emptied landing folder takes nothing back
    put(spark, f"{folder}/part-2.json", [3])
    IN.ingest(spark, landing, EVENT, transform, sink)
    assert live(spark, sink) == [1, 3]


def test_the_stream_form_makes_passes(spark):
    import time
    landing, sink, ckpt = (S.scratch_path(spark, x) for x in ("t-landing", "t-sink", "t-ckpt"))
    put(spark, f"{landing}/jobs_01_02_2024.json", [1])
    q = IN.ingest(spark, landing, EVENT, transform, sink, ckpt, available_now=False, every="1 second")

    def wait(want):
        for _ in range(120):
            if VS.last_version(spark, sink) and live(spark, sink) == want:
                return
            assert q.exception() is None
            time.sleep(0.5)
        raise AssertionError(want)

    try:
        wait([1])
        put(spark, f"{landing}/jobs_01_02_2024.json", [2])
        wait([2])
    finally:
        q.stop()
