"""Tables that are replaced without their readers noticing.

The name that readers use is a view over one version: a table of its own, in a folder of its
own, under a name that is never used again. A new version is written in full beside the others
and becomes the one that is read by a single catalog call, ``ALTER VIEW ... AS``. (Spark's
``CREATE OR REPLACE VIEW`` drops the view before it makes the new one.) Before that call every
reader sees all of the old version, after it all of the new; a job that stops anywhere leaves
one of the two. The last versions before the one in use stay, so that queries that began on
them end on them, and so that one can go back.

One exception: a plain table that already has the name is taken over as the first version. That
renames it and then makes the view, and between the two, once, there is nothing to read.
"""

from __future__ import annotations

import datetime as dt
import re
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession

from paylake.sinks.tables import (
    TARGET_BYTES,
    delete_folder,
    fill_table,
    sql_text,
    table_folder,
    table_location,
)

# Versions kept behind the one in use, and how long an unfinished one may take.
KEEP = 2
UNFINISHED = dt.timedelta(days=1)

_COMPLETE, _ORIGIN = "paylake.complete", "paylake.made-from"
_STAMP = "%Y%m%d%H%M%S%f"
_VERSION = re.compile(r"(.*)__v(\d{20})_[0-9a-f]{8}")
_QUERY = re.compile(r"SELECT \* FROM (\S+)")


@dataclass(frozen=True)
class Version:
    """One version: its own table, when it was begun (UTC), and whether it is the one in use."""

    table: str
    begun: dt.datetime
    complete: bool
    current: bool


def publish_table(
    df: DataFrame,
    name: str,
    *,
    path: str | None = None,
    partition_by: str | None = None,
    cluster_by: Sequence[str] = (),
    comment: str | None = None,
    written: Observation | None = None,
    keep: int = KEEP,
    made_from: str | None = None,
    lookup: Sequence[str] = (),
    target_bytes: int = TARGET_BYTES,
) -> DataFrame:
    """Write a query's rows as a new version of ``name``, switch to it, and return it.

    Version folders go under ``path``, by default under the warehouse. ``keep`` versions
    behind the new one stay, older ones go with their files. ``made_from`` is said of the
    version, for ``origin`` to tell: what its rows come from. ``lookup`` names columns that
    are looked up by value: their Bloom filters let a reader skip row groups.
    """
    spark = df.sparkSession
    version = _new_version(name)
    folder = f"{table_folder(spark, name, path)}/version-{version.rpartition('__')[2]}"
    fill_table(
        df,
        version,
        folder,
        partition_by=partition_by,
        cluster_by=cluster_by,
        comment=comment,
        written=written,
        lookup=lookup,
        target_bytes=target_bytes,
    )
    said = f", '{_ORIGIN}' = {sql_text(made_from)}" if made_from else ""
    spark.sql(f"ALTER TABLE {version} SET TBLPROPERTIES ('{_COMPLETE}' = 'true'{said})")
    _take_over(spark, name)
    show_query(spark, name, f"SELECT * FROM {version}", comment)
    prune(spark, name, keep)
    return spark.table(name)


def publish_folder(spark: SparkSession, name: str, path: str) -> DataFrame:
    """Make ``name`` read an existing Parquet folder; moves no data. Its versions stay."""
    _take_over(spark, name)
    quoted = path.replace("`", "``")
    show_query(spark, name, f"SELECT * FROM parquet.`{quoted}`")
    return spark.table(name)


def versions(spark: SparkSession, name: str) -> list[Version]:
    """All versions of ``name`` that there are, oldest first."""
    shown, found = current_version(spark, name), []
    database, _, own = name.rpartition(".")
    within = f"IN {database} " if database else ""
    for row in spark.sql(f"SHOW TABLE EXTENDED {within}LIKE {sql_text(own + '__v*')}").collect():
        match = _VERSION.fullmatch(row["tableName"])
        if match and match.group(1) == own.lower():
            table = f"{database}.{row['tableName']}" if database else row["tableName"]
            begun = dt.datetime.strptime(match.group(2), _STAMP).replace(tzinfo=dt.timezone.utc)
            complete = f"{_COMPLETE}=true" in row["information"]
            found.append(Version(table, begun, complete, table == shown))
    return sorted(found, key=lambda v: v.table)


def switch_back(spark: SparkSession, name: str, table: str | None = None) -> DataFrame:
    """Show an earlier version again: the one before that in use, or the one named."""
    there = versions(spark, name)
    at = next((i for i, v in enumerate(there) if v.current), len(there))
    usable = [v.table for v in there if v.complete] if table else [
        v.table for v in there[:at] if v.complete
    ]
    if not usable or (table and table not in usable):
        raise ValueError(f"{name} has no such complete version: {table or 'an earlier one'}")
    chosen = table or usable[-1]
    show_query(spark, name, f"SELECT * FROM {chosen}", spark.catalog.getTable(chosen).description)
    return spark.table(name)


def prune(spark: SparkSession, name: str, keep: int = KEEP) -> list[str]:
    """Drop all but the last ``keep`` complete versions before the one in use.

    Newer ones stay: they may be another job's. Unfinished ones stay for a day, then go.
    Returns what was dropped.
    """
    there = versions(spark, name)
    current = next((v for v in there if v.current), None)
    if current is None:
        return []
    before = [v for v in there if v.complete and v.table < current.table]
    stale = dt.datetime.now(dt.timezone.utc) - UNFINISHED
    gone = before[: max(len(before) - keep, 0)]
    gone += [v for v in there if not v.complete and v.begun < stale]
    for version in gone:
        folder = table_location(spark, version.table)
        spark.sql(f"DROP TABLE IF EXISTS {version.table}")
        if folder and "/version-" in folder:
            delete_folder(spark, folder)
    return [v.table for v in gone]


def _new_version(name: str) -> str:
    now = dt.datetime.now(dt.timezone.utc)
    return f"{name}__v{now:{_STAMP}}_{uuid.uuid4().hex[:8]}".lower()


def show_query(spark: SparkSession, name: str, query: str, comment: str | None = None) -> None:
    """Readers pass from what they read to another query, in one call."""
    said = f"COMMENT {sql_text(comment)} " if comment else ""
    if not spark.catalog.tableExists(name):
        spark.sql(f"CREATE VIEW {name} {said}AS {query}")
        return
    spark.sql(f"ALTER VIEW {name} AS {query}")
    if comment and spark.catalog.getTable(name).description != comment:
        spark.sql(f"ALTER VIEW {name} SET TBLPROPERTIES ('comment' = {sql_text(comment)})")


def _take_over(spark: SparkSession, name: str) -> None:
    """A plain table of that name becomes the first version."""
    if not spark.catalog.tableExists(name) or spark.catalog.getTable(name).tableType == "VIEW":
        return
    first = f"{name}__v{dt.datetime(2000, 1, 1):{_STAMP}}_{uuid.uuid4().hex[:8]}".lower()
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{_COMPLETE}' = 'true')")
    spark.sql(f"ALTER TABLE {name} RENAME TO {first}")
    show_query(spark, name, f"SELECT * FROM {first}")


def view_query(spark: SparkSession, name: str) -> str | None:
    """The query of a view; None if there is no view of that name."""
    if not spark.catalog.tableExists(name) or spark.catalog.getTable(name).tableType != "VIEW":
        return None
    rows = spark.sql(f"DESCRIBE EXTENDED {name}").filter("col_name = 'View Text'").collect()
    return rows[0]["data_type"] if rows else None


def current_version(spark: SparkSession, name: str) -> str | None:
    """The version that a view reads; None for a folder, or if there is no view."""
    query = _QUERY.fullmatch(view_query(spark, name) or "")
    return query.group(1) if query and _VERSION.fullmatch(query.group(1)) else None


def origin(spark: SparkSession, name: str) -> str | None:
    """What the version that a view reads was made from, where that was said."""
    version = current_version(spark, name)
    if version is None:
        return None
    rows = spark.sql(f"SHOW TBLPROPERTIES {version}").filter(f"key = '{_ORIGIN}'").collect()
    return rows[0]["value"] if rows else None
