"""The raw layout, and the edge records through all layers."""

import csv
import datetime as dt
import math
from collections import Counter
from decimal import Decimal
from pathlib import Path

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paylake.operators.gold import to_gold
from paylake.operators.reports import count_by, monthly_total
from paylake.operators.silver import to_silver
from paylake.plans import bindings, catalog
from paylake.schema import GOLD_COLUMNS, RAW_COLUMNS, SILVER_FROM_RAW, raw_schema
from paylake.sources.records import RecordsCrossLines, read_records

# key, amount text, date text, silver amount, gold (date, amount) or None
EDGE = [
    ("1", "12.50", "01/05/2023", 12.5, (dt.date(2023, 1, 5), "12.5")),
    ("2", "$1,000", "01/05/2023", None, None),
    ("3", "NaN", "01/05/2023", math.nan, None),
    ("4", "Inf", "01/05/2023", math.inf, None),
    ("", "7.0", "01/05/2023", None, None),
    ("6", "8.0", "02/30/2023", 8.0, None),
    ("7", "1e30", "01/05/2023", 1e30, None),
    ("8", "1.005", "1/5/2023", 1.005, (dt.date(2023, 1, 5), "1.005")),
    ("9", "-3.25", " 01/05/2023 ", -3.25, (dt.date(2023, 1, 5), "-3.25")),
    ("10", "", "01/05/2023", None, None),
    ("11", "2.0", "", 2.0, None),
    ("12", "0", "02/29/2024", 0.0, (dt.date(2024, 2, 29), "0")),
    ("13", "4", "2023-01-05", 4.0, None),
    ("14", "4", "01/05/23", 4.0, (dt.date(23, 1, 5), "4")),
]


def edge_record(key, amount, date):
    values = {
        "Record_ID": key,
        "Total_Amount_of_Payment_USDollars": amount,
        "Date_of_Payment": date,
        "Contextual_Information": 'says "hi",\nline two',
        "Recipient_Zip_Code": "01234",
        "Recipient_State": "" if key == "9" else "CA",
        "Nature_of_Payment_or_Transfer_of_Value": "Food and Beverage",
        "Program_Year": "2023",
        "Number_of_Payments_Included_in_Total_Amount": "1",
    }
    return [values.get(c, "") for c in RAW_COLUMNS]


@pytest.fixture(scope="module")
def edge_dir(tmp_path_factory):
    folder = tmp_path_factory.mktemp("edge")
    for n in range(2):
        with open(folder / f"part{n}.csv", "w", newline="") as f:
            out = csv.writer(f, lineterminator="\n")
            out.writerow(RAW_COLUMNS)
            out.writerows(edge_record(*e[:3]) for e in EDGE[n * 7 : n * 7 + 7])
    return str(folder)


@pytest.fixture(scope="module")
def raw(spark, edge_dir):
    return read_records(spark, edge_dir, raw_schema())


def test_raw_schema():
    schema = raw_schema()
    assert tuple(schema.names) == RAW_COLUMNS and len(set(RAW_COLUMNS)) == 91
    assert Counter(f.dataType.simpleString() for f in schema) == {"string": 89, "double": 1, "int": 1}
    assert all(f.nullable for f in schema)
    assert schema["Total_Amount_of_Payment_USDollars"].dataType.simpleString() == "double"


def test_raw_rows(raw):
    rows = raw.collect()
    assert len(rows) == 14
    assert {r.Contextual_Information for r in rows} == {'says "hi",\nline two'}
    assert {r.Recipient_Zip_Code for r in rows} == {"01234"}
    assert {r.Number_of_Payments_Included_in_Total_Amount for r in rows} == {1}


def test_silver(raw):
    silver = to_silver(raw)
    assert silver.columns == list(SILVER_FROM_RAW)
    # As text, since NaN equals nothing.
    got = {r.Record_ID: repr(r.payment_amount_usd) for r in silver.collect()}
    assert got == {e[0]: repr(e[3]) for e in EDGE if e[0]}


def test_gold_and_reports(raw):
    gold = to_gold(to_silver(raw))
    assert gold.columns == list(GOLD_COLUMNS)
    got = {r.Record_ID: (r.payment_date, r.payment_amount_usd) for r in gold.collect()}
    assert got == {e[0]: (e[4][0], Decimal(e[4][1])) for e in EDGE if e[4]}
    assert dict(count_by(gold, "recipient_state").collect()) == {"CA": 4, None: 1}
    assert dict(monthly_total(gold).collect()) == {
        dt.date(23, 1, 1): Decimal(4),
        dt.date(2023, 1, 1): Decimal("10.255"),
        dt.date(2024, 2, 1): Decimal(0),
    }


def test_short_and_long_records(spark, tmp_path):
    (tmp_path / "a.csv").write_text("h1,h2\n1\n2,x,extra\n")
    two = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])
    rows = sorted(read_records(spark, str(tmp_path), two).collect())
    assert [tuple(r) for r in rows] == [(1, None), (2, "x")]


TWO = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.StringType())])


@pytest.mark.parametrize("multi_line", [True, False])
def test_odd_bytes_and_text_after_a_quote(spark, tmp_path, multi_line):
    """Both ways of reading give the same, for files of any size."""
    records = b'h1,h2\ncaf\xe9,"caf\xe9"\nnul\x00in,x\n"closed" tail,y\n5,"a ""b"" c"\n'
    (tmp_path / "a.csv").write_bytes(records)
    got = read_records(spark, str(tmp_path), TWO, multi_line=multi_line).collect()
    want = read_records(spark, str(tmp_path), TWO).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))
    assert ("caf\ufffd", "caf\ufffd") in map(tuple, got) and ("5", 'a "b" c') in map(tuple, got)
    assert len(got) == 4


def test_records_that_cross_lines_must_be_declared(spark, edge_dir, tmp_path):
    with pytest.raises(RecordsCrossLines):
        read_records(spark, edge_dir, raw_schema(), multi_line=False)
    (tmp_path / "a.csv").write_text('h1,h2\n1,"last field\ngoes on"\n')
    with pytest.raises(RecordsCrossLines):
        read_records(spark, str(tmp_path), TWO, multi_line=False)


def test_a_quote_inside_a_plain_field_hides_no_crossing(spark, tmp_path):
    (tmp_path / "a.csv").write_text('h1,h2,h3\n1,5" pipe,"first\nsecond",5" x\n')
    three = T.StructType([*TWO, T.StructField("c", T.StringType())])
    with pytest.raises(RecordsCrossLines):
        read_records(spark, str(tmp_path), three, multi_line=False)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text('a",\n ', max_size=9), min_size=1, max_size=5))
def test_what_passes_the_line_check_reads_as_records_do(spark, tmp_path_factory, parts):
    """Any text: either the check refuses it, or both ways of reading give the same rows.

    Lines of blanks are left aside: Spark skips them unless fields may hold line breaks.
    """
    folder = tmp_path_factory.mktemp("any")
    (folder / "a.csv").write_text("h1,h2\n" + "\n".join(parts) + "\n")
    want = read_records(spark, str(folder), TWO).collect()
    try:
        got = read_records(spark, str(folder), TWO, multi_line=False).collect()
    except RecordsCrossLines:
        return

    def full(rows):
        return sorted(repr(r) for r in rows if (r.a or "").strip() or r.b is not None)

    assert full(got) == full(want)


def test_long_quoted_lines_pass_the_check(spark, tmp_path):
    long = "x" * 200_000 + '""' * 50_000
    (tmp_path / "a.csv").write_text(f'h1,h2\n1,"{long}"\n')
    assert read_records(spark, str(tmp_path), TWO, multi_line=False).count() == 1


def test_single_lines_are_split_into_blocks(spark, tmp_path):
    (tmp_path / "a.csv").write_text("h1,h2\n" + "".join(f"{i},x\n" for i in range(20_000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        rows = read_records(spark, str(tmp_path), TWO, multi_line=False)
        assert rows.rdd.getNumPartitions() > 5
        assert rows.distinct().count() == rows.count() == 20_000
        assert read_records(spark, str(tmp_path), TWO).rdd.getNumPartitions() == 1
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize("key", ["id", "7", "null"])
def test_more_rows_make_more_files_not_larger_ones(spark, tmp_path, monkeypatch, key):
    """A file with line breaks in fields is one task; keys may be all alike or missing."""
    monkeypatch.setattr(bindings, "FILE_BYTES", 100_000, raising=False)
    for n in (2_000, 8_000):
        orders = spark.range(n).selectExpr(
            f"cast({key} as long) o_orderkey",
            "1L o_custkey",
            "'F' o_orderstatus",
            "1.5d o_totalprice",
            "timestamp '1996-01-02' o_orderdate",
            "'5-LOW' o_orderpriority",
        )
        orders.write.parquet(str(tmp_path / f"{n}" / "orders.parquet"))
        folder = Path(catalog._raw_csv(spark, str(tmp_path / f"{n}")))
        sizes = [f.stat().st_size for f in folder.glob("*.csv")]
        assert max(sizes) < 200_000 and len(sizes) >= n // 500
        raw = read_records(spark, str(folder), raw_schema())
        got = raw.groupBy("Covered_Recipient_Profile_ID", "Contextual_Information").count().collect()
        assert sum(r["count"] for r in got) == n and len(got) == (n if key == "id" else 1)
        assert {r.Contextual_Information for r in got} == {bindings.CONTEXT}


def test_column_pruning_and_key_filter_reach_the_csv_scan(spark, edge_dir):
    plan = to_silver(read_records(spark, edge_dir, raw_schema()))._jdf.queryExecution().toString()
    scan = next(line for line in plan.splitlines() if "FileScan csv" in line)
    assert "IsNotNull(Record_ID)" in scan
    assert "Teaching_Hospital" not in scan and "Contextual_Information" not in scan


def test_gold_converts_each_value_once(spark, edge_dir):
    silver = to_silver(read_records(spark, edge_dir, raw_schema()))
    typed = to_gold(silver).filter("payment_date >= DATE '2023-01-01' AND recipient_state = 'CA'")
    plan = typed._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("gettimestamp") + plan.count("to_date") <= 1 or plan.count("M/d/y") == 1
    scan = typed._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(Recipient_State,CA)" in scan


def test_gold_keeps_only_typed_rows(spark):
    df = spark.createDataFrame([("x", 1.0)], "payment_date_str string, payment_amount_usd double")
    others = [c for c in SILVER_FROM_RAW if c not in df.columns]
    assert to_gold(df.select("*", *[F.lit("v").alias(c) for c in others])).count() == 0
