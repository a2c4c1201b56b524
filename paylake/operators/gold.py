"""Silver to gold: typed date and amount, rows without either dropped."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylake.functions.scalars import safe_cast_numeric, safe_parse_date
from paylake.schema import GOLD_COLUMNS


def to_gold(silver: DataFrame) -> DataFrame:
    """Zero and negative amounts stay; only NULL is rejected.

    ``inline`` settles both values once per row: a filter on plain expressions would be
    moved below the projection and have them worked out again.
    """
    typed = F.struct(
        safe_parse_date(F.col("payment_date_str")).alias("payment_date"),
        safe_cast_numeric(F.col("payment_amount_usd")).alias("payment_amount_usd"),
    )
    others = [c for c in silver.columns if c not in ("payment_date_str", "payment_amount_usd")]
    return (
        silver.select(*others, F.inline(F.array(typed)))
        .filter(F.col("payment_date").isNotNull() & F.col("payment_amount_usd").isNotNull())
        .select(*GOLD_COLUMNS)
    )
