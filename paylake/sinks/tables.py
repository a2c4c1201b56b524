"""Sinks. All replace, so a rerun of the same input leaves the same state."""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# Size of a table's files, before compression of what the input's columns leave out.
TARGET_BYTES = 256 << 20
# Rows of a task that sorts them, where files are much smaller than what they hold.
TARGET_ROWS = 1 << 20


def replace_parquet(df: DataFrame, path: str) -> None:
    """Write a Parquet folder in place of what is there. No shuffle: files follow the input."""
    df.write.mode("overwrite").parquet(path)


def input_bytes(df: DataFrame) -> int:
    """The planner's estimate of a query's size; for files read, that of the columns used."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def cluster_rows(
    df: DataFrame,
    partition_by: str,
    cluster_by: Sequence[str],
    target_bytes: int = TARGET_BYTES,
) -> DataFrame:
    """Bring each partition value together, sorted by the cluster columns, in ranges.

    Tasks get ranges of (partition value, cluster columns). A value with more than a task's
    share of the rows is cut into ranges of the cluster columns, and where these are equal
    by a hash, so its files hold few cluster values each and a filter skips the others. Any
    other value is in one range, so it gets one file.

    Costs an aggregation by partition value, which brings one row for each folder to be
    written to the driver, and the sampling pass of the range shuffle.
    """
    spark = df.sparkSession
    counts = df.groupBy(partition_by).agg(F.count(F.lit(1)).alias("n")).collect()
    rows = sum(r["n"] for r in counts)
    wanted = max(math.ceil(input_bytes(df) / target_bytes), math.ceil(rows / TARGET_ROWS))
    tasks = max(spark.sparkContext.defaultParallelism, wanted)
    share = rows / tasks
    hot = [r[0] for r in counts if r["n"] > share and r[0] is not None]
    keys: list[Column] = [F.col(partition_by)]
    if hot:
        cut = F.col(partition_by).isin(hot)
        spread = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
        keys += [F.when(cut, F.col(c)) for c in cluster_by] + [F.when(cut, spread)]
    return df.repartitionByRange(tasks, *keys).sortWithinPartitions(partition_by, *cluster_by)


def _bloom_filters(columns: Sequence[str]) -> dict[str, str]:
    """Settings of the Parquet writer; each file's filter is as large as its values need."""
    if not columns:
        return {}
    each = {f"parquet.bloom.filter.enabled#{c}": "true" for c in columns}
    # Twelve sizes, each half the one before: from a megabyte to 512 bytes.
    sizes = {"adaptive.enabled": "true", "candidates.number": "12"}
    return each | {f"parquet.bloom.filter.{k}": v for k, v in sizes.items()}


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings for a write; an insert takes the writer's options from nowhere else."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def fill_table(
    df: DataFrame,
    table: str,
    folder: str,
    *,
    partition_by: str | None = None,
    cluster_by: Sequence[str] = (),
    comment: str | None = None,
    written: Observation | None = None,
    lookup: Sequence[str] = (),
    target_bytes: int = TARGET_BYTES,
) -> None:
    """Declare a new Parquet table over a new folder and fill it; a failure leaves neither.

    The table is declared first and then filled, because an insert registers the
    partitions it wrote; a create-as-select lists all their folders to find them.
    Files get Bloom filters on the ``lookup`` columns, each as large as its values need.
    """
    spark = df.sparkSession
    if partition_by:
        df = df.select(*[c for c in df.columns if c != partition_by], partition_by)
        df = cluster_rows(df, partition_by, cluster_by, target_bytes)
    elif cluster_by:
        df = df.sortWithinPartitions(*cluster_by)
    if written is not None:
        df = df.observe(written, F.count(F.lit(1)).alias("n"))
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    declaration = [f"CREATE TABLE {table} ({columns}) USING parquet"]
    if partition_by:
        declaration.append(f"PARTITIONED BY (`{partition_by}`)")
    declaration.append(f"LOCATION {sql_text(folder)}")
    if comment:
        declaration.append(f"COMMENT {sql_text(comment)}")
    spark.sql(" ".join(declaration))
    try:
        with _settings(spark, _bloom_filters(lookup)):
            df.write.insertInto(table)
    except BaseException:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        delete_folder(spark, folder)
        raise


def replace_table(
    df: DataFrame,
    table: str,
    *,
    path: str | None = None,
    partition_by: str | None = None,
    cluster_by: Sequence[str] = (),
    comment: str | None = None,
    written: Observation | None = None,
    target_bytes: int = TARGET_BYTES,
) -> DataFrame:
    """Create or replace a Parquet table from a query and return it.

    The new files go to a folder of their own under ``path`` (by default under the
    warehouse), and a table under a working name is declared over them and filled. Only
    when that has succeeded does it take the old table's place, and the old files go. A
    failed write leaves the old table as it was. The swap is two catalog entries, so a
    reader may for a moment see no table, never a part of one. The partition column moves
    to the end of the schema. ``written`` gets the row count of the write as ``n``.
    """
    spark = df.sparkSession
    version = uuid.uuid4().hex[:12]
    working = f"{table}_new_{version}"
    base = table_folder(spark, table, path)
    fill_table(
        df,
        working,
        f"{base}/version-{version}",
        partition_by=partition_by,
        cluster_by=cluster_by,
        comment=comment,
        written=written,
        target_bytes=target_bytes,
    )
    old = table_location(spark, table)
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(f"ALTER TABLE {working} RENAME TO {table}")
    # Only folders that this function made: a registered table's files are not its own.
    if old and "/version-" in old:
        delete_folder(spark, old)
    return spark.table(table)


def register_parquet(spark: SparkSession, table: str, path: str) -> DataFrame:
    """Point a table at an existing Parquet folder, replacing the entry; moves no data."""
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    return spark.catalog.createTable(table, path=path, source="parquet")


def table_folder(spark: SparkSession, table: str, path: str | None) -> str:
    """Where the folders of a table's versions are."""
    return (path or f"{spark.conf.get('spark.sql.warehouse.dir')}/{table}").rstrip("/")


def table_location(spark: SparkSession, table: str) -> str | None:
    """The folder of a table's files; None if there is no such table."""
    if not spark.catalog.tableExists(table):
        return None
    rows = spark.sql(f"DESCRIBE EXTENDED {table}").filter("col_name = 'Location'").collect()
    return rows[0]["data_type"] if rows else None


def delete_folder(spark: SparkSession, folder: str) -> None:
    """Deletes a folder in whatever store it is, through Spark's own file systems."""
    jvm, context = spark._jvm, spark.sparkContext._jsc
    path = jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(context.hadoopConfiguration()).delete(path, True)


def sql_text(text: str) -> str:
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"
