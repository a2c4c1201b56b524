"""Versions behind one name: readers, stops at any call, going back, clean-up."""

import datetime as dt
import threading
from pathlib import Path

import pytest
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paylake.operators.reports import in_range
from paylake.sinks import versions as v
from paylake.sinks.tables import replace_parquet, replace_table

DAY = dt.date(2023, 1, 1)


def generation(spark, g, rows=40):
    """Rows that all say which generation they are; later ones have more of them."""
    return spark.range(rows + g).select(
        F.col("id").alias("Record_ID"),
        F.lit(g).alias("generation"),
        F.date_add(F.lit(DAY), (F.col("id") % 3).cast("int")).alias("payment_date"),
    )


def state(df):
    """The generation, if the table is whole and of one generation."""
    low, high, n = df.agg(F.min("generation"), F.max("generation"), F.count("*")).first()
    assert low == high and n == 40 + low
    return low


def drop(spark, name):
    if spark.catalog.tableExists(name):
        kind = spark.catalog.getTable(name).tableType
        spark.sql(f"DROP {'VIEW' if kind == 'VIEW' else 'TABLE'} {name}")
    for version in v.versions(spark, name):
        spark.sql(f"DROP TABLE {version.table}")


@pytest.mark.parametrize("partition_by", [None, "payment_date"])
def test_readers_never_fail_and_see_whole_versions(spark, tmp_path, partition_by):
    name, stop, seen, failures = "versions_read", threading.Event(), [], []
    more = {"path": str(tmp_path / "t"), "partition_by": partition_by}
    v.publish_table(generation(spark, 0), name, **more)

    def read():
        while not stop.is_set():
            try:
                seen.append(state(spark.table(name)))
            except Exception as e:  # noqa: BLE001
                failures.append(e)

    readers = [threading.Thread(target=read, daemon=True) for _ in range(2)]
    for r in readers:
        r.start()
    try:
        for g in range(1, 21):
            v.publish_table(generation(spark, g), name, **more)
    finally:
        stop.set()
        for r in readers:
            r.join(60)
    assert not failures, failures[0]
    assert len(set(seen)) > 3 and seen[-1] >= 19
    assert len(list((tmp_path / "t").iterdir())) == 1 + v.KEEP
    drop(spark, name)


class Stop(Exception):
    pass


@pytest.mark.parametrize("taken_over", [False, True])
def test_a_stop_between_any_two_calls_leaves_a_readable_table(spark, tmp_path, monkeypatch, taken_over):
    name, sql, insert = "versions_stop", SparkSession.sql, None
    if taken_over:
        # A plain table of that name: its take-over itself is done before, see the module.
        replace_table(generation(spark, 0), name, path=str(tmp_path / "t"))
        v._take_over(spark, name)
    else:
        v.publish_table(generation(spark, 0), name, path=str(tmp_path / "t"))
    done, call = False, 0
    while not done:
        call += 1
        assert call < 40
        left = [call]

        def counted(self, *args, _left=left, **kwargs):
            _left[0] -= 1
            if _left[0] == 0:
                raise Stop
            return sql(self, *args, **kwargs)

        with monkeypatch.context() as m:
            m.setattr(type(spark), "sql", counted)
            try:
                v.publish_table(generation(spark, call), name, path=str(tmp_path / "t"), keep=1)
                done = True
            except Stop:
                pass
        assert state(spark.table(name)) <= call
    assert call > 6 and state(spark.table(name)) == call
    drop(spark, name)


def test_failed_write_changes_nothing(spark, tmp_path):
    name = "versions_failed"
    v.publish_table(generation(spark, 1), name, path=str(tmp_path / "t"))
    bad = generation(spark, 2).withColumn("generation", F.raise_error(F.lit("no")).cast("int"))
    with pytest.raises(Exception, match="no"):
        v.publish_table(bad, name, path=str(tmp_path / "t"))
    assert state(spark.table(name)) == 1 and len(v.versions(spark, name)) == 1
    assert len(list((tmp_path / "t").iterdir())) == 1
    drop(spark, name)


def test_going_back_and_on(spark, tmp_path):
    name = "versions_back"
    for g in (1, 2, 3):
        v.publish_table(generation(spark, g), name, comment=f"it's {g}", keep=5)
    assert state(v.switch_back(spark, name)) == 2
    assert state(v.switch_back(spark, name)) == 1
    assert spark.catalog.getTable(name).description == "it's 1"
    with pytest.raises(ValueError, match="an earlier one"):
        v.switch_back(spark, name)
    newest = v.versions(spark, name)[-1].table
    assert state(v.switch_back(spark, name, newest)) == 3
    with pytest.raises(ValueError, match="nothing__v"):
        v.switch_back(spark, name, "nothing__v1")
    # What is newer than the version in use is not cleaned away, only what is before it.
    v.switch_back(spark, name)
    assert v.prune(spark, name, keep=0) and [x.current for x in v.versions(spark, name)] == [True, False]
    drop(spark, name)


def test_unfinished_versions_are_kept_for_a_day(spark, tmp_path):
    name = "versions_unfinished"
    old = dt.datetime.now(dt.timezone.utc) - dt.timedelta(days=2)
    for at in (old, dt.datetime.now(dt.timezone.utc)):
        spark.sql(f"CREATE TABLE {name}__v{at:%Y%m%d%H%M%S%f}_00000000 (a INT) USING parquet")
    v.publish_table(generation(spark, 1), name)
    there = v.versions(spark, name)
    assert [x.complete for x in there] == [False, True] and there[-1].current
    drop(spark, name)


def test_versions_of_similar_names_are_apart(spark):
    v.publish_table(generation(spark, 1), "versions_a")
    v.publish_table(generation(spark, 2), "versions_a__v2")
    assert len(v.versions(spark, "versions_a")) == len(v.versions(spark, "versions_a__v2")) == 1
    drop(spark, "versions_a__v2")
    drop(spark, "versions_a")


def test_day_filter_prunes_through_the_view(spark, tmp_path):
    name = "versions_prune"
    v.publish_table(generation(spark, 1), name, path=str(tmp_path / "t"), partition_by="payment_date")
    plan = in_range(spark.table(name), DAY, DAY)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(payment_date" in plan
    drop(spark, name)


def test_folders_and_versions_under_one_name(spark, tmp_path):
    name = "versions_folder"
    replace_parquet(generation(spark, 5), str(tmp_path / "a`b"))
    before = sorted(Path(tmp_path / "a`b").iterdir())
    assert state(v.publish_folder(spark, name, str(tmp_path / "a`b"))) == 5
    assert state(v.publish_table(generation(spark, 6), name, path=str(tmp_path / "t"))) == 6
    assert state(v.publish_folder(spark, name, str(tmp_path / "a`b"))) == 5
    assert sorted(Path(tmp_path / "a`b").iterdir()) == before
    drop(spark, name)


def test_a_plain_table_is_taken_over(spark, tmp_path):
    name = "versions_taken"
    replace_table(generation(spark, 1), name, path=str(tmp_path / "t"), partition_by="payment_date")
    got = v.publish_table(generation(spark, 2), name, path=str(tmp_path / "t"))
    assert isinstance(got, DataFrame) and state(got) == 2
    assert state(v.switch_back(spark, name)) == 1
    drop(spark, name)
