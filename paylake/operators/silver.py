"""Raw records to silver: keep 14 columns, rename, require the key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylake.schema import KEY, SILVER_FROM_RAW


def project_silver(raw: DataFrame) -> DataFrame:
    return raw.select([F.col(src).alias(name) for name, src in SILVER_FROM_RAW.items()])


def require_key(df: DataFrame) -> DataFrame:
    return df.filter(F.col(KEY).isNotNull())


def to_silver(raw: DataFrame) -> DataFrame:
    return raw.transform(project_silver).transform(require_key)
