"""Keys that occur on more than one row: found by fingerprint, confirmed by the key itself.

A fingerprint is the 64-bit hash of a key. Equal keys have equal ones, so a fingerprint of a
single row proves its key unique, and clean input shuffles eight bytes a row, whatever the key
is. Only rows under a fingerprint of several rows are compared by key, which sets keys apart
that share a fingerprint by chance. Both countings add up before their shuffle, so one key on
very many rows costs each task one row.

Missing keys are no keys: they are counted elsewhere and never equal.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paylake.operators.quality import QualityError
from paylake.schema import KEY

NAMED = 5  # keys that an error names


def fingerprint(key: Column) -> Column:
    return F.xxhash64(key)


def duplicate_keys(df: DataFrame, key: str = KEY) -> DataFrame:
    """Each key on several rows, under its own name, with its ``row_count``."""
    keys = df.select(F.col(f"`{key}`").alias("_key")).filter(F.col("_key").isNotNull())
    marked = keys.select("_key", fingerprint(F.col("_key")).alias("_mark"))
    # The suspects are broadcast only if they turn out small when the first shuffle is done.
    suspects = (
        marked.groupBy("_mark")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .filter(F.col("_rows") > 1)
        .select("_mark")
    )
    return (
        marked.join(suspects, "_mark", "left_semi")
        .groupBy(F.col("_key").alias(key))
        .agg(F.count(F.lit(1)).alias("row_count"))
        .filter(F.col("row_count") > 1)
    )


def key_uniqueness(df: DataFrame, key: str = KEY) -> DataFrame:
    """One row: keys on several rows, their rows beyond one each, and the most rows of a key."""
    rows = F.col("row_count")
    return duplicate_keys(df, key).agg(
        F.count(F.lit(1)).alias("double_keys"),
        F.coalesce(F.sum(rows - 1), F.lit(0)).alias("surplus_rows"),
        F.coalesce(F.max(rows), F.lit(0)).alias("most_rows"),
    )


def require_unique(df: DataFrame, key: str = KEY) -> None:
    """Raise if a key stands on several rows, naming those with the most rows."""
    worst = duplicate_keys(df, key).orderBy(F.desc("row_count"), key).limit(NAMED).collect()
    if worst:
        named = ", ".join(f"{row[0]} ({row[1]} rows)" for row in worst)
        raise QualityError(f"{key} is not unique: {named}")
