"""Labelled rows for the classifiers: a bounded sample, none of it held out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paylake.llm.common import keyed_text

# At most so many labelled rows are learned from, chosen by a hash of their id.
SAMPLE_ROWS = 20_000
HELD_OUT = 5


def held_out(doc_id: Column) -> Column:
    """Whether a row is only for measuring: crc32 of its id as text divides by 5. Null: yes."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % HELD_OUT == 0, F.lit(True))


def sample(
    docs: DataFrame, labels: DataFrame, label: str, rows: int = SAMPLE_ROWS
) -> DataFrame:
    """Texts and labels (0 or 1) of at most ``rows`` labelled rows that are not held out.

    An id that is labelled twice counts once, by its larger label. The sample is small by
    its limit, so it is broadcast to the texts instead of the texts being shuffled.
    """
    chosen = (
        labels.select(F.col("doc_id").cast("long"), F.col(label).cast("int").alias("label"))
        .filter(F.col("label").isin(0, 1) & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )
    return keyed_text(docs).join(F.broadcast(chosen), "doc_id")
