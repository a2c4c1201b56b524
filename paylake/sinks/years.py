"""Tables of several years under one name, each of which is replaced alone.

Every year is a published name of its own. The name over all of them is a view with one branch
for each year and the year as a column, so a filter on it leaves the other branches out. A new
version of one year is shown by that year's own switch; files, versions and readers of the
other years are not touched, and the view over all is changed only when a year comes or goes.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from paylake.sinks.versions import show_query, view_query

YEAR = "year"
_BRANCH = re.compile(rf"CAST\((-?\d+) AS INT\) AS `{YEAR}` FROM (\S+)")


def years(spark: SparkSession, name: str) -> dict[int, str]:
    """The years that a name has, and the table of each."""
    query = view_query(spark, name) or ""
    return {int(year): table for year, table in _BRANCH.findall(query)}


def show_years(
    spark: SparkSession, name: str, tables: dict[int, str], columns: Sequence[str]
) -> DataFrame:
    """Make ``name`` read these columns of these tables, and the year, in one step."""
    if not tables:
        raise ValueError(f"{name} needs a year to show")
    if YEAR in {c.lower() for c in columns}:
        raise ValueError(f"a column is called {YEAR} already")
    listed = ", ".join("`" + c.replace("`", "``") + "`" for c in columns)
    branches = [
        f"SELECT {listed}, CAST({year:d} AS INT) AS `{YEAR}` FROM {table}"
        for year, table in sorted(tables.items())
    ]
    show_query(spark, name, " UNION ALL ".join(branches))
    return spark.table(name)


def add_year(
    spark: SparkSession, name: str, year: int, table: str, columns: Sequence[str]
) -> DataFrame:
    """Show a year's table under ``name`` too; nothing is done if it is there already."""
    there = years(spark, name)
    if there.get(year) == table:
        return spark.table(name)
    return show_years(spark, name, {**there, year: table}, columns)


def drop_year(spark: SparkSession, name: str, year: int, columns: Sequence[str]) -> DataFrame:
    """No longer show a year; its own table stays."""
    there = years(spark, name)
    return show_years(spark, name, {y: t for y, t in there.items() if y != year}, columns)
