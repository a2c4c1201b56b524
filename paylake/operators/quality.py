"""Quality counts per layer, each in one pass, and the gate that uses them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from paylake.functions.scalars import safe_cast_numeric, safe_parse_date
from paylake.schema import KEY


class QualityError(RuntimeError):
    """A layer has too many unusable rows."""


def silver_quality(df: DataFrame) -> DataFrame:
    """Rows, missing keys, unparseable dates and uncastable amounts of silver-shaped rows."""
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(F.col(KEY).isNull()).alias("missing_key"),
        F.count_if(safe_parse_date(F.col("payment_date_str")).isNull()).alias("bad_date"),
        F.count_if(safe_cast_numeric(F.col("payment_amount_usd")).isNull()).alias("bad_amount"),
    )


def gold_quality(df: DataFrame) -> DataFrame:
    """The same counts of gold rows, whose date and amount are typed; all but the first are 0."""
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(F.col(KEY).isNull()).alias("missing_key"),
        F.count_if(F.col("payment_date").isNull()).alias("bad_date"),
        F.count_if(F.col("payment_amount_usd").isNull()).alias("bad_amount"),
    )


def _unusable() -> tuple[Column, Column]:
    date = safe_parse_date(F.col("payment_date_str")).isNull()
    return date, safe_cast_numeric(F.col("payment_amount_usd")).isNull()


def observe_raw(projected: DataFrame, into: Observation) -> DataFrame:
    """Silver columns before the key filter: rows and missing keys, counted as they pass."""
    rows = F.count(F.lit(1)).alias("raw")
    return projected.observe(into, rows, F.count_if(F.col(KEY).isNull()).alias("missing_key"))


def observe_silver(silver: DataFrame, into: Observation) -> DataFrame:
    """Silver rows, and those that gold will reject, counted as they are written."""
    date, amount = _unusable()
    return silver.observe(
        into,
        F.count(F.lit(1)).alias("silver"),
        F.count_if(date).alias("bad_date"),
        F.count_if(amount).alias("bad_amount"),
        F.count_if(date | amount).alias("rejected"),
    )


def require_balance(metrics: dict[str, int]) -> None:
    """Raise unless every raw row is accounted for in silver, and every silver row in gold."""
    refused = metrics.get("refused", metrics.get("missing_key"))
    lost = {
        "raw": metrics["raw"] - refused - metrics["silver"],
        "silver": metrics["silver"] - metrics["rejected"] - metrics["gold"],
    }
    if any(lost.values()):
        raise QualityError(f"rows unaccounted for: {lost} of {metrics}")


def layer_balance(projected: DataFrame, silver: DataFrame, gold: DataFrame) -> DataFrame:
    """The same counts from layers read back, as one row."""
    date, amount = _unusable()
    rows = F.count(F.lit(1))
    raw = projected.agg(
        rows.alias("raw"), F.count_if(F.col(KEY).isNull()).alias("missing_key")
    )
    kept = silver.agg(rows.alias("silver"), F.count_if(date | amount).alias("rejected"))
    return raw.crossJoin(kept).crossJoin(gold.agg(rows.alias("gold")))


def require_quality(metrics: dict[str, int], max_bad_share: float) -> None:
    """Raise when any count of bad rows exceeds its allowed share of ``row_count``."""
    rows = metrics["row_count"]
    over = {
        name: n for name, n in metrics.items() if name != "row_count" and n > max_bad_share * rows
    }
    if over:
        raise QualityError(f"over {max_bad_share:.2%} of {rows} rows unusable: {over}")
