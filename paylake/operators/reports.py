"""Reports over gold. Each is one scan with map-side partial aggregation, so a
dimension value that holds most of the rows still shuffles one row per task."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paylake.functions.scalars import month_of


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("record_count"))


def count_by(df: DataFrame, dimension: str) -> DataFrame:
    """Records per value; NULL is a group of its own."""
    return df.groupBy(dimension).agg(F.count(F.lit(1)).alias("record_count"))


def monthly_total(
    df: DataFrame, day: str | Column = "payment_date", amount: str | Column = "payment_amount_usd"
) -> DataFrame:
    day = F.col(day) if isinstance(day, str) else day
    amount = F.col(amount) if isinstance(amount, str) else amount
    return df.groupBy(month_of(day).alias("payment_month")).agg(
        F.sum(amount).alias("total_amount_usd")
    )


def in_range(df: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    """Both ends included. On the stored table this prunes day partitions."""
    return df.filter(F.col("payment_date").between(F.lit(first), F.lit(last)))


def where_equals(df: DataFrame, dimension: str, value: str) -> DataFrame:
    return df.filter(F.col(dimension) == F.lit(value))


def preview(df: DataFrame, n: int = 5, *order: Column) -> DataFrame:
    """First n rows. With an order it is a distributed top-n, not a full sort."""
    return (df.orderBy(*order) if order else df).limit(n)
