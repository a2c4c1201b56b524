"""Reports from a small cube of gold: counts and amounts by day, state and kind of payment.

Counts and sums add up, so a report over any of the cube's columns is a sum over its rows. A
report that needs another column reads gold itself. Both give the same rows and types.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paylake.functions.scalars import month_of
from paylake.operators import reports
from paylake.schema import CLUSTER_COLUMNS, PARTITION_COLUMN

DIMENSIONS = (PARTITION_COLUMN, *CLUSTER_COLUMNS)
ROWS, AMOUNT = "record_count", "total_amount_usd"


def summarize(gold: DataFrame) -> DataFrame:
    """One row for each day, state and kind that occur together; NULLs are values of their own."""
    return gold.groupBy(*DIMENSIONS).agg(
        F.count(F.lit(1)).alias(ROWS), F.sum("payment_amount_usd").alias(AMOUNT)
    )


@dataclass(frozen=True)
class Where:
    """Days from ``first`` to ``last``, both included, and values that columns must equal."""

    first: dt.date | None = None
    last: dt.date | None = None
    equals: dict[str, str] = field(default_factory=dict)

    def columns(self) -> set[str]:
        days = {PARTITION_COLUMN} if self.first or self.last else set()
        return days | set(self.equals)

    def __call__(self, df: DataFrame) -> DataFrame:
        if self.first:
            df = df.filter(F.col(PARTITION_COLUMN) >= F.lit(self.first))
        if self.last:
            df = df.filter(F.col(PARTITION_COLUMN) <= F.lit(self.last))
        for column, value in self.equals.items():
            df = reports.where_equals(df, column, value)
        return df


EVERYTHING = Where()


@dataclass(frozen=True)
class Reports:
    """The reports over a gold table, and its summary if there is one that fits it."""

    gold: DataFrame
    summary: DataFrame | None = None

    def _from_summary(self, where: Where, needed: Iterable[str]) -> DataFrame | None:
        if self.summary is None or not (where.columns() | set(needed)) <= set(DIMENSIONS):
            return None
        return where(self.summary)

    def row_count(self, where: Where = EVERYTHING) -> DataFrame:
        rows = self._from_summary(where, ())
        if rows is None:
            return reports.row_count(where(self.gold))
        # A sum over no rows is NULL, a count is 0.
        return rows.agg(_total(F.coalesce(F.sum(ROWS), F.lit(0))).alias(ROWS))

    def count_by(self, dimension: str, where: Where = EVERYTHING) -> DataFrame:
        rows = self._from_summary(where, [dimension])
        if rows is None:
            return reports.count_by(where(self.gold), dimension)
        return rows.groupBy(dimension).agg(_total(F.sum(ROWS)).alias(ROWS))

    def monthly_total(self, where: Where = EVERYTHING) -> DataFrame:
        rows = self._from_summary(where, [PARTITION_COLUMN])
        if rows is None:
            return reports.monthly_total(where(self.gold))
        month = month_of(F.col(PARTITION_COLUMN)).alias("payment_month")
        return rows.groupBy(month).agg(F.sum(AMOUNT).alias(AMOUNT))


def _total(n: Column) -> Column:
    return n.cast("long")
