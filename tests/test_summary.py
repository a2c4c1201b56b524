"""Reports from the cube give what gold gives, and read no more than the cube."""

import datetime as dt
import itertools

import pytest
from pyspark.sql import functions as F

from paylake.operators.summary import DIMENSIONS, Reports, Where, summarize
from paylake.plans.stages import build_gold, build_summary, open_reports, summary_name

DAY = dt.date(2023, 1, 1)


def silver(spark, n=600):
    i = F.col("id")
    columns = {
        "Record_ID": i.cast("string"),
        "Covered_Recipient_Type": F.lit("t"),
        "recipient_npi": (i % 50).cast("string"),
        "recipient_first_name": F.lit("f"),
        "recipient_last_name": F.lit("l"),
        "recipient_state": F.when(i % 7 != 0, F.concat(F.lit("S"), i % 3)),
        "recipient_city": F.lit("c"),
        "physician_specialty": F.lit("p"),
        "payer_name": F.concat(F.lit("p"), i % 4),
        "payment_amount_usd": ((i % 100) / 4).cast("double"),
        "payment_date_str": F.date_format(F.date_add(F.lit(DAY), (i % 9 * 9).cast("int")), "MM/dd/yyyy"),
        "payment_form": F.lit("x"),
        "payment_nature": F.when(i % 5 != 0, F.concat(F.lit("N"), i % 2)),
        "program_year": F.lit("2023"),
    }
    return spark.range(n).select(*[c.alias(n) for n, c in columns.items()])


@pytest.fixture(scope="module")
def gold(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("summary")
    build_gold(silver(spark), "summary_gold", str(path / "g"))
    build_summary(spark, "summary_gold", str(path / "s"))
    return "summary_gold"


WHERE = [
    Where(),
    Where(DAY, DAY + dt.timedelta(40)),
    Where(first=DAY + dt.timedelta(20)),
    Where(last=DAY, equals={"payment_nature": "N1"}),
    Where(equals={"recipient_state": "S1"}),
    Where(equals={"payer_name": "p3"}),
    Where(equals={"recipient_state": "nowhere"}),
    Where(DAY, DAY + dt.timedelta(40), {"recipient_npi": "7", "recipient_state": "S2"}),
]
REPORTS = [
    lambda r, w: r.row_count(w),
    lambda r, w: r.monthly_total(w),
    *[lambda r, w, d=d: r.count_by(d, w) for d in (*DIMENSIONS, "payer_name", "recipient_npi")],
]


@pytest.mark.parametrize("where, report", list(itertools.product(range(len(WHERE)), range(len(REPORTS)))))
def test_same_rows_and_types_as_gold(spark, gold, where, report):
    opened = open_reports(spark, gold)
    assert opened.summary is not None
    got = REPORTS[report](opened, WHERE[where])
    want = REPORTS[report](Reports(opened.gold), WHERE[where])
    assert got.schema.simpleString() == want.schema.simpleString()
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def test_plan_reads_the_cube_only_unless_a_filter_needs_gold(spark, gold):
    opened = open_reports(spark, gold)

    def scans(df):
        plan = df._jdf.queryExecution().executedPlan().toString()
        return {"summary" if "summary_gold_summary" in x else "gold" for x in plan.split("FileScan")[1:]}

    assert scans(opened.count_by("payment_nature", WHERE[1])) == {"summary"}
    assert scans(opened.monthly_total(WHERE[4])) == {"summary"}
    assert scans(opened.count_by("payment_nature", WHERE[5])) == {"gold"}
    assert scans(opened.count_by("payer_name")) == {"gold"}


def test_cube_has_one_row_for_each_combination(spark, gold):
    opened = open_reports(spark, gold)
    assert opened.summary.count() == opened.gold.select(*DIMENSIONS).distinct().count()
    assert summarize(opened.gold.limit(0)).count() == 0


def test_a_summary_of_another_version_is_not_used(spark, tmp_path):
    name = "summary_stale"
    build_gold(silver(spark), name, str(tmp_path / "g"))
    assert open_reports(spark, name).summary is None
    build_summary(spark, name, str(tmp_path / "s"))
    assert open_reports(spark, name).summary is not None
    old = open_reports(spark, name)
    build_gold(silver(spark, 60), name, str(tmp_path / "g"))
    new = open_reports(spark, name)
    assert new.summary is None and new.row_count().first()[0] == 60
    assert old.row_count().first()[0] == 600 and old.gold.count() == 600
    build_summary(spark, name, str(tmp_path / "s"))
    assert open_reports(spark, name).summary.agg(F.sum("record_count")).first()[0] == 60
    assert spark.catalog.tableExists(summary_name(name))
