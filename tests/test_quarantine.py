"""Refused records: each fault, text kept, and nothing lost between the layers."""

import pytest
from pyspark.sql import functions as F

from paylake.operators import quarantine
from paylake.operators.gold import to_gold
from paylake.operators.quality import QualityError
from paylake.plans.stages import process_records
from paylake.schema import RAW_COLUMNS, SILVER_FROM_RAW, raw_schema
from paylake.sources.records import read_records

# id, amount text, count text, date text, fields (91 when whole), refused by, faults
RECORDS = [
    ("1", "12.50", "1", "01/05/2023", 91, None, []),
    ("2", "$1,000", "1", "01/05/2023", 91, "gold", ["bad_value:Total_Amount_of_Payment_USDollars", "bad_amount"]),
    ("3", "5", "x", "01/05/2023", 91, None, ["bad_value:Number_of_Payments_Included_in_Total_Amount"]),
    ("", "5", "1", "01/05/2023", 91, "silver", ["missing_key"]),
    ("5", "5", "1", "02/30/2023", 91, "gold", ["bad_date"]),
    ("6", "", "1", "", 91, "gold", ["bad_date", "bad_amount"]),
    ("7", "5", "1", "01/05/2023", 93, None, ["malformed"]),
    ("8", "5", "x", "01/05/2023", 90, None, ["malformed", "bad_value:Number_of_Payments_Included_in_Total_Amount"]),
    ("", "NaN", "y", "13/01/2023", 92, "silver",
     ["missing_key", "malformed", "bad_value:Number_of_Payments_Included_in_Total_Amount", "bad_date", "bad_amount"]),
]


def line(record):
    key, amount, count, day, fields = record[:5]
    values = dict.fromkeys(RAW_COLUMNS, "v")
    values |= {
        "Record_ID": key,
        "Total_Amount_of_Payment_USDollars": amount,
        "Number_of_Payments_Included_in_Total_Amount": count,
        "Date_of_Payment": day,
        "Contextual_Information": 'says "hi",\nline two',
    }
    cells = [*values.values(), "extra", "more"][:fields]
    return ",".join('"' + c.replace('"', '""') + '"' for c in cells) + "\n"


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    place = tmp_path_factory.mktemp("refused")
    for n, part in enumerate((RECORDS[:4], RECORDS[4:])):
        (place / f"f{n}.csv").write_text(",".join(RAW_COLUMNS) + "\n" + "".join(map(line, part)))
    return place


def judged(spark, folder, **more):
    raw = read_records(spark, str(folder), raw_schema(), with_record=True)
    return quarantine.judge(raw, raw_schema(), **more)


def test_each_fault_is_told(spark, folder):
    got = [(r.Record_ID, r.refused_by, r.faults) for r in judged(spark, folder).collect()]
    want = [(r[0] or None, r[5], r[6]) for r in RECORDS]
    assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_malformed_records_are_refused_where_asked(spark, folder):
    got = {r.Record_ID: r.refused_by for r in judged(spark, folder, refuse_malformed=True).collect()}
    assert (got["7"], got["8"], got["1"], got["5"]) == ("silver", "silver", None, "gold")


def test_text_and_file_are_kept(spark, folder):
    rows = {r.Record_ID: r for r in judged(spark, folder).collect()}
    assert rows["1"].record is None and rows["1"].source_file.endswith("f0.csv")
    assert rows["7"].record.endswith('"extra","more"') and "line two" in rows["7"].record
    assert rows["7"].source_file.endswith("f1.csv")


@pytest.mark.parametrize("refuse", [False, True])
def test_silver_and_quarantine_are_raw(spark, folder, tmp_path, refuse):
    counts = process_records(
        spark, str(folder), str(tmp_path / "s"), quarantine_path=str(tmp_path / "q"), refuse_malformed=refuse
    )
    silver, kept = spark.read.parquet(str(tmp_path / "s")), spark.read.parquet(str(tmp_path / "q"))
    assert silver.columns == list(SILVER_FROM_RAW)
    raw = read_records(spark, str(folder), raw_schema())
    row = quarantine.balance(raw, silver, to_gold(silver), kept).first()
    assert (row.raw, row.raw_left, row.silver_left) == (9, 0, 0)
    assert row.refused_by_silver == (4 if refuse else 2)
    assert counts["refused"] == row.refused_by_silver and counts["rejected"] == row.refused_by_gold
    assert (counts["raw"], counts["silver"]) == (9, row.silver)
    if not refuse:
        plain = process_records(spark, str(folder), str(tmp_path / "plain"))
        assert plain == counts
        same = spark.read.parquet(str(tmp_path / "plain"))
        assert sorted(map(repr, same.collect())) == sorted(map(repr, silver.collect()))
    # Only the two folders stay.
    assert sorted(p.name for p in tmp_path.iterdir()) == (["q", "s"] if refuse else ["plain", "q", "s"])


def test_a_rerun_replaces_the_quarantine(spark, folder, tmp_path):
    for _ in range(2):
        process_records(spark, str(folder), str(tmp_path / "s"), quarantine_path=str(tmp_path / "q"))
    assert spark.read.parquet(str(tmp_path / "q")).count() == 5


def test_faults_by_file(spark, folder):
    counts = quarantine.faults_by_file(quarantine.refused(judged(spark, folder)))
    got = {(r.source_file[-6:], r.refused_by, r.fault): r.record_count for r in counts.collect()}
    assert got[("f0.csv", "silver", "missing_key")] == 1
    assert got[("f1.csv", "gold", "bad_date")] == 2
    assert sum(got.values()) == 1 + 2 + 1 + 2 + 5


def test_the_csv_is_parsed_once(spark, folder, tmp_path, monkeypatch):
    from paylake.plans import stages

    reads = []
    monkeypatch.setattr(stages, "read_records", lambda *a, **k: reads.append(a) or read_records(*a, **k))
    process_records(spark, str(folder), str(tmp_path / "s"), quarantine_path=str(tmp_path / "q"))
    assert len(reads) == 1


def test_balance_tells_of_lost_rows(spark, folder, tmp_path):
    judged(spark, folder).write.parquet(str(tmp_path / "judged"))
    rows = spark.read.parquet(str(tmp_path / "judged"))
    silver = quarantine.accepted(rows)
    row = quarantine.balance(rows, silver.limit(3), to_gold(silver), quarantine.refused(rows)).first()
    assert row.raw_left == 4 and row.silver_left != 0
    with pytest.raises(QualityError):
        from paylake.operators.quality import require_balance

        require_balance({"raw": 9, "refused": 2, "silver": 6, "rejected": 3, "gold": 3})


def test_no_records(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text(",".join(RAW_COLUMNS) + "\n")
    counts = process_records(spark, str(tmp_path / "in"), str(tmp_path / "s"), quarantine_path=str(tmp_path / "q"))
    assert counts["raw"] == counts["silver"] == counts["refused"] == 0
    assert spark.read.parquet(str(tmp_path / "s")).agg(F.count("*")).first()[0] == 0
