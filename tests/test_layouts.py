"""Layout generations: which one a header is of, what differs, and one silver from all."""

import json

import pytest

from paylake.operators.silver import to_silver
from paylake.plans.bindings import raw_payments, write_csv
from paylake.plans.stages import process_records
from paylake.schema import RAW_COLUMNS, SILVER_FROM_RAW, raw_schema
from paylake.sources import layouts
from paylake.sources.layouts import Layout, LayoutError, resolve
from paylake.sources.records import read_records

SF_DIR = "/root/testdata/sf0.001"
OLD = Layout("1", ("Id", "Sum", "Day", "Gone"), {"Sum": "int"}, {"Id": "Key"})
MID = Layout("2", ("Key", "Sum", "Day", "State"), {"Sum": "double"})
NOW = Layout("3", ("Key", "State", "Day", "Sum", "Note"), {"Sum": "double"})
ALL = [OLD, MID, NOW]


def kinds(binding):
    return sorted((c.kind, c.column) for c in binding.changes)


@pytest.mark.parametrize(
    "header, version, changes",
    [
        (("Key", "State", "Day", "Sum", "Note"), "3", []),
        (("Key", "Sum", "Day", "State"), "2", []),
        (("Id", "Sum", "Day", "Gone"), "1", [("renamed", "Id"), ("retyped", "Sum")]),
        (("﻿Key", "Sum ", "Day", "State", "New"), "2", [("added", "New")]),
        (("Key", "State", "Sum", "Day", "Note"), "3", [("moved", "Day"), ("moved", "Sum")]),
        (("Key", "State", "Day", "Sum"), "2", [("moved", "State"), ("moved", "Sum")]),
        (("Id", "Sum", "Day"), "1", [("lost", "Gone"), ("renamed", "Id"), ("retyped", "Sum")]),
    ],
)
def test_header_picks_its_layout(header, version, changes):
    binding = resolve(header, ALL, needed=("Key", "Sum", "Day"))
    assert binding.layout.version == version
    assert sorted(x for x in kinds(binding) if x[0] != "moved" or version != "2") == sorted(
        x for x in changes if x[0] != "moved" or version != "2"
    )


def test_unusable_headers_are_refused():
    with pytest.raises(LayoutError, match="missing.*Sum"):
        resolve(("Key", "Day", "State"), ALL, needed=("Key", "Sum"))
    with pytest.raises(LayoutError, match="twice.*Key"):
        resolve(("Key", "Sum", "Key"), ALL, needed=())
    with pytest.raises(LayoutError, match="several.*Key"):
        resolve(("Id", "Key", "Sum", "Day", "Gone"), ALL, needed=())


def test_layout_files(spark, tmp_path):
    (tmp_path / "2.json").write_text(json.dumps({"version": 2, "columns": ["a"]}))
    (tmp_path / "1.json").write_text(
        json.dumps({"version": "1", "columns": ["b"], "types": {"b": "int"}, "renames": {"b": "a"}})
    )
    read = layouts.load_layouts(spark, str(tmp_path))
    assert [x.version for x in read] == ["1", "2", layouts.PRESENT]
    assert read[0] == Layout("1", ("b",), {"b": "int"}, {"b": "a"})
    assert read[-1].columns == RAW_COLUMNS
    (tmp_path / "3.json").write_text(json.dumps({"version": "3", "columns": ["b"], "types": {"c": "int"}}))
    with pytest.raises(LayoutError, match="3.json"):
        layouts.load_layouts(spark, str(tmp_path))
    (tmp_path / "3.json").write_text(json.dumps({"version": "3", "colums": ["b"]}))
    with pytest.raises(LayoutError, match="3.json"):
        layouts.load_layouts(spark, str(tmp_path))


def test_files_of_three_layouts_are_one_table(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Id,Sum,Day,Gone\n1,5,d1,x\n2,5.5,d2,x\n")
    (tmp_path / "b.csv").write_text('Key,Sum,Day,State\n3,6.5,"d\n3",CA\n')
    (tmp_path / "c.csv").write_text("Key,State,Day,Sum,Note\n4,NY,d4,7,n\n")
    (tmp_path / "d.csv").write_text("Note,Extra,Key,State,Day,Sum\nn5,e,5,TX,d5,8\n")
    (tmp_path / "e.csv").write_text("")
    got, bindings = layouts.read_layouts(spark, str(tmp_path), ALL, needed=("Key", "Sum", "Day"))
    assert got.columns == list(NOW.columns)
    assert sorted(map(tuple, got.collect())) == [
        ("1", None, "d1", 5.0, None),
        ("2", None, "d2", None, None),
        ("3", "CA", "d\n3", 6.5, None),
        ("4", "NY", "d4", 7.0, "n"),
        ("5", "TX", "d5", 8.0, "n5"),
    ]
    told = layouts.report(spark, bindings).collect()
    assert {(r.version, r.kind, r.column) for r in told if r.kind != "moved"} == {
        ("1", "renamed", "Id"), ("1", "retyped", "Sum"), ("3", "added", "Extra"),
    }
    with pytest.raises(LayoutError, match="d.csv"):
        layouts.read_layouts(spark, str(tmp_path), ALL, needed=(), refuse=("added",))


def test_files_of_one_header_are_one_scan(spark, tmp_path):
    for i in range(12):
        (tmp_path / f"{i}.csv").write_text(f"Key,Sum,Day,State\n{i},1,d,s\n")
    got, bindings = layouts.read_layouts(spark, str(tmp_path), ALL, needed=())
    assert len(bindings) == 1 and len(bindings[0][1]) == 12 and got.count() == 12
    assert got._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_no_header_at_all(spark, tmp_path):
    (tmp_path / "e.csv").write_text("")
    with pytest.raises(LayoutError, match="no file"):
        layouts.read_layouts(spark, str(tmp_path), ALL)


def test_the_stage_binds_by_name(spark, tmp_path):
    """Files whose columns are in another order give the silver of the declared order."""
    raw = raw_payments(spark, SF_DIR).limit(200)
    raw.write.parquet(str(tmp_path / "rows"))
    raw = spark.read.parquet(str(tmp_path / "rows"))
    plain = write_csv(raw, str(tmp_path / "plain"))
    turned = write_csv(raw.select(*reversed(raw.columns)), str(tmp_path / "turned"))
    (tmp_path / "layouts").mkdir()
    (tmp_path / "layouts" / "1.json").write_text(json.dumps({"version": "1", "columns": ["x"]}))
    counts = process_records(
        spark, turned, str(tmp_path / "silver"), layouts_path=str(tmp_path / "layouts")
    )
    want = to_silver(read_records(spark, plain, raw_schema()))
    got = spark.read.parquet(str(tmp_path / "silver"))
    assert got.columns == list(SILVER_FROM_RAW)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    assert counts["raw"] == 200
    for more in ({"quarantine_path": str(tmp_path / "q")}, {"strict_header": True}):
        with pytest.raises(ValueError, match="layouts"):
            process_records(
                spark, turned, str(tmp_path / "s"), layouts_path=str(tmp_path / "layouts"), **more
            )
