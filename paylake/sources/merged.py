"""Parquet files of differing schemas as one table.

Columns are matched by name. A column that a file lacks is NULL there. Where types differ, the
column gets the narrowest type that holds the values of both:

- whole numbers: the longer; whole numbers and decimals: a decimal with room for both;
- ``float`` and ``double``: ``double``; whole numbers up to 32 bits and ``double``: ``double``;
- ``date`` and ``timestamp``: ``timestamp``; anything and a column of NULLs: the other type.

Any other pair is a conflict: it raises, or, where asked to, becomes text. Of decimals and
numbers of which no type holds all values (more than 38 digits, 64 bits and ``double``), too.
"""

from __future__ import annotations

from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Footers are read by so many threads of the driver.
_THREADS = 16
_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 20}


class SchemaConflict(ValueError):
    """A column has types in two files of which neither holds the other's values."""


def wider(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The narrowest type that holds the values of both; None if there is none."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    kinds = {type(a), type(b)}
    if kinds <= set(_DIGITS):
        return max((a, b), key=lambda t: _DIGITS[type(t)])
    if kinds <= {T.FloatType, T.DoubleType, T.ByteType, T.ShortType, T.IntegerType}:
        # A float holds whole numbers up to 24 bits only.
        return T.DoubleType()
    if kinds <= {T.DecimalType, *_DIGITS}:
        sizes = [
            (t.precision - t.scale, t.scale) if isinstance(t, T.DecimalType) else (_DIGITS[type(t)], 0)
            for t in (a, b)
        ]
        whole, scale = max(x for x, _ in sizes), max(y for _, y in sizes)
        return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else None
    if kinds == {T.DateType, T.TimestampType}:
        return T.TimestampType()
    return None


def merged_schema(schemas: Iterable[T.StructType], *, conflicts_as_text: bool = False) -> T.StructType:
    """All columns in the order in which they are first met, each of the wider type."""
    out: dict[str, T.DataType] = {}
    for schema in schemas:
        for f in schema:
            if f.name not in out:
                out[f.name] = f.dataType
                continue
            both = wider(out[f.name], f.dataType)
            if both is None:
                if not conflicts_as_text:
                    raise SchemaConflict(
                        f"column {f.name} is {out[f.name].simpleString()} in one file and"
                        f" {f.dataType.simpleString()} in another"
                    )
                both = T.StringType()
            out[f.name] = both
    return T.StructType([T.StructField(name, kind) for name, kind in out.items()])


def files_by_schema(spark: SparkSession, path: str | list[str]) -> list[tuple[T.StructType, list[str]]]:
    """The files under a path by the schema of their footers, in order of the files' names."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    files = sorted(r["path"] for r in listed.select("path").collect())
    with ThreadPoolExecutor(_THREADS) as pool:
        schemas = list(pool.map(lambda f: spark.read.parquet(f).schema, files))
    found: dict[str, tuple[T.StructType, list[str]]] = {}
    for file, schema in zip(files, schemas, strict=True):
        found.setdefault(schema.json(), (schema, []))[1].append(file)
    return list(found.values())


def read_merged(
    spark: SparkSession, path: str | list[str], *, conflicts_as_text: bool = False
) -> DataFrame:
    """All files as one table; one scan for each schema that was met, not for each file."""
    groups = files_by_schema(spark, path)
    if not groups:
        raise FileNotFoundError(f"no Parquet files under {path}")
    target = merged_schema((s for s, _ in groups), conflicts_as_text=conflicts_as_text)
    parts = []
    for schema, files in groups:
        rows = spark.read.schema(schema).parquet(*files)
        there = set(schema.names)
        columns = [
            F.col(f"`{f.name}`") if f.name in there else F.lit(None).cast(f.dataType)
            for f in target
        ]
        parts.append(
            rows.select(*[c.cast(f.dataType).alias(f.name) for c, f in zip(columns, target, strict=True)])
        )
    return reduce(DataFrame.union, parts)
