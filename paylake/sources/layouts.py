"""Record files of several layout generations, bound by the names in their headers.

A layout says which columns a generation of files has, their types where they are not text,
and under which name the present layout knows a column that was renamed. Layouts are JSON files,
one each, in a folder: ``{"version": "2019", "columns": [...], "types": {"Amount": "double"},
"renames": {"Old_Name": "New_Name"}}``. They are ordered by file name; the present layout, the
declared one, comes last.

Each file's header picks its layout: the one with the fewest columns added or lost, then the
fewest moved, then the newest. What differs is reported; a file that lacks a column that is
needed, or names one twice, is refused. Files with the same header are read together, so there
is one scan for each header, not for each file.
"""

from __future__ import annotations

import csv
import json
from collections.abc import Collection, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paylake.schema import RAW_COLUMNS, RAW_TYPES, SILVER_FROM_RAW
from paylake.sources.records import read_records

PRESENT = "present"
KINDS = ("added", "lost", "moved", "renamed", "retyped")
# Headers are read by so many threads of the driver, a line of each file.
_THREADS = 16


class LayoutError(ValueError):
    """A header that no layout explains well enough."""


@dataclass(frozen=True)
class Layout:
    version: str
    columns: tuple[str, ...]
    types: dict[str, str] = field(default_factory=dict)
    renames: dict[str, str] = field(default_factory=dict)

    def present_name(self, column: str) -> str:
        return self.renames.get(column, column)


@dataclass(frozen=True)
class Change:
    """How a file's header differs from its layout, or its layout from the present one."""

    kind: str
    column: str
    detail: str


@dataclass(frozen=True)
class Binding:
    """A header, the layout it was found to be of, and the differences."""

    header: tuple[str, ...]
    layout: Layout
    changes: tuple[Change, ...]


def present_layout() -> Layout:
    types = {name: t.simpleString() for name, t in RAW_TYPES.items()}
    return Layout(PRESENT, tuple(RAW_COLUMNS), types)


def load_layouts(spark: SparkSession, folder: str) -> list[Layout]:
    """The layouts of a folder in order of their file names, and the present one."""
    rows = spark.read.text(folder, wholetext=True).select("value", F.col("_metadata.file_name"))
    out = []
    for text, name in sorted(map(tuple, rows.collect()), key=lambda r: r[1]):
        said = json.loads(text)
        unknown = set(said) - {"version", "columns", "types", "renames"}
        if unknown or not {"version", "columns"} <= set(said):
            raise LayoutError(f"{name}: a layout has version, columns, types, renames; not {unknown}")
        layout = Layout(
            str(said["version"]), tuple(said["columns"]), said.get("types", {}), said.get("renames", {})
        )
        strange = (set(layout.types) | set(layout.renames)) - set(layout.columns)
        if strange or len(set(layout.columns)) < len(layout.columns):
            raise LayoutError(f"{name}: columns named twice, or not at all: {sorted(strange)}")
        out.append(layout)
    return [*out, present_layout()]


def resolve(
    header: Sequence[str],
    layouts: Sequence[Layout],
    needed: Iterable[str] = tuple(SILVER_FROM_RAW.values()),
) -> Binding:
    """The layout of a header, and what differs. ``needed`` are names of the last layout."""
    names = tuple(name.strip().removeprefix("﻿") for name in header)
    twice = sorted({n for n in names if names.count(n) > 1})
    if twice:
        raise LayoutError(f"columns named twice: {twice}")

    def differences(layout: Layout) -> tuple[list[str], list[str], list[str]]:
        added = [n for n in names if n not in layout.columns]
        lost = [n for n in layout.columns if n not in names]
        here = [n for n in names if n in layout.columns]
        there = [n for n in layout.columns if n in names]
        return added, lost, [a for a, b in zip(here, there, strict=True) if a != b]

    def distance(i: int) -> tuple[int, int, int]:
        added, lost, moved = differences(layouts[i])
        return len(added) + len(lost), len(moved), -i

    layout, last = layouts[min(range(len(layouts)), key=distance)], layouts[-1]
    added, lost, moved = differences(layout)
    changes = [Change("added", n, f"not in layout {layout.version}") for n in added]
    changes += [Change("lost", n, f"in layout {layout.version}") for n in lost]
    changes += [Change("moved", n, f"now column {names.index(n) + 1}") for n in moved]
    for name in (n for n in names if n in layout.columns):
        now = layout.present_name(name)
        if now != name:
            changes.append(Change("renamed", name, f"now {now}"))
        was, wanted = layout.types.get(name, "string"), last.types.get(now, "string")
        if now in last.columns and was != wanted:
            changes.append(Change("retyped", name, f"from {was} to {wanted}"))
    bound = [layout.present_name(n) for n in names]
    missing = sorted(set(needed) - set(bound))
    if missing:
        raise LayoutError(f"layout {layout.version} fits best, but columns are missing: {missing}")
    clashing = sorted({n for n in bound if bound.count(n) > 1})
    if clashing:
        raise LayoutError(f"several columns are now called {clashing}")
    return Binding(names, layout, tuple(changes))


def read_headers(spark: SparkSession, path: str | list[str]) -> dict[tuple[str, ...], list[str]]:
    """The files under a path by their header; one line of each file is read."""
    files = spark.read.format("binaryFile").load(path).select("path").collect()

    def header(file: str) -> tuple[str, ...]:
        jvm, context = spark._jvm, spark.sparkContext._jsc
        place = jvm.org.apache.hadoop.fs.Path(file)
        stream = place.getFileSystem(context.hadoopConfiguration()).open(place)
        try:
            reader = jvm.java.io.InputStreamReader(stream, "UTF-8")
            line = jvm.java.io.BufferedReader(reader).readLine()
        finally:
            stream.close()
        return tuple(next(csv.reader([line]))) if line else ()

    names = [r["path"] for r in files]
    out: dict[tuple[str, ...], list[str]] = {}
    with ThreadPoolExecutor(_THREADS) as pool:
        for file, found in zip(names, pool.map(header, names), strict=True):
            out.setdefault(found, []).append(file)
    # A file without any text has no header and no records.
    out.pop((), None)
    return out


def read_layouts(
    spark: SparkSession,
    path: str | list[str],
    layouts: Sequence[Layout],
    *,
    multi_line: bool = True,
    refuse: Collection[str] = (),
    needed: Iterable[str] = tuple(SILVER_FROM_RAW.values()),
) -> tuple[DataFrame, list[tuple[Binding, list[str]]]]:
    """All files as one table in the last layout, and each header's binding and files.

    Columns bind by name. One that a file does not have is NULL, one that the last layout does
    not have is left out, and one of another type is converted, or NULL. ``refuse`` names
    kinds of change that raise instead.
    """
    last = layouts[-1]
    needed, found = tuple(needed), read_headers(spark, path)
    if not found:
        raise LayoutError(f"no file with a header under {path}")
    bindings = [(resolve(h, layouts, needed), files) for h, files in sorted(found.items())]
    for binding, files in bindings:
        unwanted = [c for c in binding.changes if c.kind in refuse]
        if unwanted:
            raise LayoutError(f"{files[0]} and files like it: {unwanted}")
    parts = []
    for binding, files in bindings:
        of = binding.layout
        quoted = {n: "`" + n.replace("`", "``") + "`" for n in binding.header}
        declared = ", ".join(f"{q} {of.types.get(n, 'string')}" for n, q in quoted.items())
        schema = T.StructType.fromDDL(declared)
        rows = read_records(spark, files, schema, multi_line=multi_line)
        there = {of.present_name(n): F.col(q) for n, q in quoted.items()}
        missing = F.lit(None).cast("string")
        parts.append(
            rows.select(
                *[
                    there.get(c, missing).try_cast(last.types.get(c, "string")).alias(c)
                    for c in last.columns
                ]
            )
        )
    return reduce(DataFrame.union, parts), bindings


def report(
    spark: SparkSession, bindings: Sequence[tuple[Binding, list[str]]]
) -> DataFrame:
    """(version, files, kind, column, detail): what differs, for each header that was met."""
    rows = [
        (b.layout.version, len(files), c.kind, c.column, c.detail)
        for b, files in bindings
        for c in b.changes
    ]
    return spark.createDataFrame(
        rows, "version string, files int, kind string, column string, detail string"
    )
