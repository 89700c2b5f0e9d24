"""Cluster sizing rule and the shared checkpoint folder."""

import pytest

from skilltrends import session as S
from skilltrends.plans.queries import QUERIES
from skilltrends.session import measured, scratch_scope
from skilltrends.sources.versioned import hadoop_path

from .conftest import SMOKE


def test_scale_conf_for_100_tb():
    conf = S.scale_conf(100 * 2**40, executor_cores_total=8000)
    assert int(conf["spark.sql.shuffle.partitions"]) == 100 * 2**40 // (256 << 20)  # ~256 MB each
    assert conf["spark.sql.adaptive.skewJoin.enabled"] == "true"
    small = S.scale_conf(10 << 20, executor_cores_total=64)
    assert int(small["spark.sql.shuffle.partitions"]) == 128  # at least two tasks per core


def test_scratch_paths_live_under_the_checkpoint_folder(spark):
    base = S.checkpoint_dir(spark)
    a, b = S.scratch_path(spark, "x"), S.scratch_path(spark, "x")
    assert a.startswith(base) and b.startswith(base) and a != b


def test_a_scope_removes_its_scratch_tables_only(spark):
    outside = measured(spark.range(3), "kept")
    with scratch_scope(spark) as made:
        df = measured(spark.range(5), "outer")
        with scratch_scope(spark) as inner:
            assert measured(spark.range(7), "inner").count() == 7
        assert [exists(spark, p) for p in inner] == [False] and df.count() == 5
        assert exists(spark, made[0]) and len(made) == 1
    assert not exists(spark, made[0]) and outside.count() == 3
    with pytest.raises(ValueError), scratch_scope(spark) as made:
        measured(spark.range(5), "failed")
        raise ValueError
    assert [exists(spark, p) for p in made] == [False]


def test_a_query_leaves_no_scratch_table_behind(spark):
    with scratch_scope(spark) as made:
        rows = QUERIES["tfidf"](spark, SMOKE).count()
    assert rows and made and not any(exists(spark, p) for p in made)


def exists(spark, path):
    fs, p = hadoop_path(spark, path)
    return fs.exists(p)
