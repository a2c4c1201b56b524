"""Stored layout: pruning, clustering, skew, replacement."""

import datetime as dt
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from paylake.operators.reports import count_by, in_range, where_equals
from paylake.sinks import tables
from paylake.sinks.tables import cluster_rows, register_parquet, replace_parquet, replace_table

DAY = dt.date(2023, 1, 1)


def day_rows(spark, n, days=31):
    """Rows of which a third fall on one day."""
    i = F.col("id")
    day = F.when(i % 3 == 0, 0).otherwise(i % days).cast("int")
    return spark.range(0, n, 1, 8).select(
        F.concat(F.lit("r"), i).alias("Record_ID"),
        F.date_add(F.lit(DAY), day).alias("payment_date"),
        F.concat(F.lit("S"), i % 7).alias("recipient_state"),
        F.when(i % 5 != 0, F.concat(F.lit("N"), i % 5)).alias("payment_nature"),
        (i % 100).cast("decimal(38,9)").alias("payment_amount_usd"),
        F.sha2(i.cast("string"), 256).alias("payer_name"),
    )


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("gold") / "t")
    table = replace_table(
        day_rows(spark, 20_000),
        "layout_gold",
        path=path,
        partition_by="payment_date",
        cluster_by=("recipient_state", "payment_nature"),
        comment="it's a \\ comment",
    )
    return table, Path(path)


def test_rows_of_small_files_are_sorted_by_many_tasks(spark, monkeypatch):
    """Files may be far smaller than their rows: the bytes alone would ask for a task per core."""
    monkeypatch.setattr(tables, "TARGET_ROWS", 1_000, raising=False)
    rows = day_rows(spark, 20_000)
    out = cluster_rows(rows, "payment_date", ("recipient_state", "payment_nature"))
    sizes = [n for n in out.rdd.mapPartitions(lambda part: [sum(1 for _ in part)]).collect() if n]
    assert len(sizes) > 15 and max(sizes) < 2_000 and sum(sizes) == 20_000


def test_one_folder_per_day(stored):
    _, path = stored
    assert len(list(path.glob("version-*/payment_date=*"))) == 31


def test_partition_column_reads_as_date(stored):
    table, _ = stored
    assert table.schema["payment_date"].dataType.simpleString() == "date"
    assert table.columns[-1] == "payment_date"


def test_comment(spark, stored):
    rows = {r.col_name: r.data_type for r in spark.sql("DESCRIBE EXTENDED layout_gold").collect()}
    assert rows["Comment"] == "it's a \\ comment"


def test_date_range_reads_only_its_folders(stored):
    table, _ = stored
    few = in_range(table, DAY + dt.timedelta(1), DAY + dt.timedelta(3))
    scan = few._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(payment_date" in scan
    assert few.select("payment_date").distinct().count() == 3


def test_state_filter_reaches_the_files(stored):
    table, _ = stored
    plan = where_equals(table, "recipient_state", "S3")._jdf.queryExecution().toString()
    assert "EqualTo(recipient_state,S3)" in plan


def test_report_reads_only_its_column(stored):
    table, _ = stored
    plan = count_by(table, "payment_nature")._jdf.queryExecution().toString()
    assert "ReadSchema: struct<payment_nature:string>" in plan


def test_rows_are_clustered_inside_files(stored):
    _, path = stored
    for file in path.rglob("*.parquet"):
        rows = pq.ParquetFile(file).read(["recipient_state", "payment_nature"]).to_pylist()
        keys = [(r["recipient_state"], r["payment_nature"] or "") for r in rows]
        assert keys == sorted(keys)


def hot_day_files(spark, tmp_path, rows, **more):
    """Row counts and (lowest, highest) states of each file, by day."""
    replace_parquet(rows, str(tmp_path / "in"))
    source = spark.read.parquet(str(tmp_path / "in"))
    size = sum(f.stat().st_size for f in (tmp_path / "in").glob("*.parquet"))
    spread = cluster_rows(source, "payment_date", ("recipient_state", "payment_nature"), **more)
    spread.write.partitionBy("payment_date").parquet(str(tmp_path / "out"))
    files = {}
    for folder in (tmp_path / "out").glob("payment_date=*"):
        for file in folder.glob("*.parquet"):
            states = pq.ParquetFile(file).read(["recipient_state"])["recipient_state"].to_pylist()
            files.setdefault(folder.name, []).append((len(states), min(states), max(states)))
    return files, size


def test_hot_day_is_cut_into_files_that_a_state_filter_skips(spark, tmp_path):
    files, size = hot_day_files(spark, tmp_path, day_rows(spark, 200_000), target_bytes=500_000)
    hot = files.pop(f"payment_date={DAY}")
    assert len(hot) >= 8
    assert max(n for n, _, _ in hot) < sum(n for n, _, _ in hot) / 4
    for state in {f"S{i}" for i in range(7)}:
        assert sum(low <= state <= high for _, low, high in hot) <= 3
    # An ordinary day keeps one file.
    assert all(len(day) == 1 for day in files.values())
    assert sum(n for day in [hot, *files.values()] for n, _, _ in day) == 200_000


def test_one_hot_day_state_and_kind_is_cut_too(spark, tmp_path):
    one = day_rows(spark, 200_000).withColumns(
        {
            "payment_date": F.lit(DAY),
            "recipient_state": F.lit("S1"),
            "payment_nature": F.lit(None).cast("string"),
        }
    )
    files, _ = hot_day_files(spark, tmp_path, one, target_bytes=500_000)
    counts = [n for n, _, _ in files[f"payment_date={DAY}"]]
    assert len(counts) >= 8 and max(counts) < 200_000 / 4 and sum(counts) == 200_000


@pytest.mark.parametrize("path", [True, False])
@pytest.mark.parametrize("day", ["payment_date", None])
def test_failed_replacement_leaves_the_old_table(spark, tmp_path, path, day):
    name = f"layout_failed_{path}_{day}"
    more = {"path": str(tmp_path / "t") if path else None, "partition_by": day}
    rows = day_rows(spark, 300)
    old = sorted(map(repr, replace_table(rows, name, **more).collect()))
    bad = rows.withColumn(
        "payer_name", F.when(F.col("Record_ID") == "r17", F.raise_error(F.lit("no"))).otherwise("x")
    )
    with pytest.raises(Exception, match="no"):
        replace_table(bad, name, **more)
    assert sorted(map(repr, spark.table(name).collect())) == old
    assert not [t.name for t in spark.catalog.listTables() if "_new_" in t.name]
    if path:
        assert len(list((tmp_path / "t").iterdir())) == 1
    fewer = replace_table(rows.filter("payment_date < DATE '2023-01-05'"), name, **more)
    assert 0 < fewer.count() == rows.filter("payment_date < DATE '2023-01-05'").count()
    if path:
        assert len(list((tmp_path / "t").iterdir())) == 1
    spark.sql(f"DROP TABLE {name}")


def test_replace_twice(spark, tmp_path):
    for n in (300, 200):
        t = replace_table(
            day_rows(spark, n), "layout_twice", path=str(tmp_path / "t"), partition_by="payment_date"
        )
        assert t.count() == n
    for n in (300, 200):
        replace_parquet(day_rows(spark, n), str(tmp_path / "p"))
        assert spark.read.parquet(str(tmp_path / "p")).count() == n


def test_register_moves_no_data_and_replaces(spark, tmp_path):
    for name, n in (("a", 30), ("b", 20)):
        replace_parquet(day_rows(spark, n), str(tmp_path / name))
        before = sorted((tmp_path / name).iterdir())
        assert register_parquet(spark, "layout_registered", str(tmp_path / name)).count() == n
        assert sorted((tmp_path / name).iterdir()) == before
    assert (tmp_path / "a").exists()
