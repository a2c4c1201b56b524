"""Years side by side, look-ups by Bloom filter, and files of differing schemas."""

import datetime as dt
import itertools
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paylake.plans.stages import JobConfig, run_stages
from paylake.sinks import years
from paylake.sinks.versions import publish_table
from paylake.sources import merged
from paylake.sources.merged import SchemaConflict, wider

COLUMNS = ("id", "day")


def rows(spark, year, n=30):
    day = F.date_add(F.lit(dt.date(year, 1, 1)), (F.col("id") % 5).cast("int"))
    return spark.range(n).select("id", day.alias("day"))


def files(folder):
    return {p: p.stat().st_mtime_ns for p in folder.rglob("*.parquet")}


def test_a_year_is_replaced_alone(spark, tmp_path):
    name = "years_all"
    for year, n in ((2022, 30), (2023, 20)):
        publish_table(rows(spark, year, n), f"{name}_{year}", path=str(tmp_path / str(year)), partition_by="day")
        years.add_year(spark, name, year, f"{name}_{year}", COLUMNS)
    assert spark.table(name).columns == [*COLUMNS, years.YEAR]
    assert dict(spark.table(name).groupBy("year").count().collect()) == {2022: 30, 2023: 20}
    before = files(tmp_path / "2022")
    # Fewer days than before: none of the old ones stays.
    publish_table(rows(spark, 2023, 2), f"{name}_2023", path=str(tmp_path / "2023"), partition_by="day")
    assert dict(spark.table(name).groupBy("year").count().collect()) == {2022: 30, 2023: 2}
    assert spark.table(name).filter("year = 2023").select("day").distinct().count() == 2
    assert files(tmp_path / "2022") == before
    assert years.years(spark, name) == {2022: f"{name}_2022", 2023: f"{name}_2023"}
    assert years.drop_year(spark, name, 2022, COLUMNS).count() == 2
    with pytest.raises(ValueError, match="needs a year"):
        years.drop_year(spark, name, 2023, COLUMNS)
    with pytest.raises(ValueError, match="already"):
        years.add_year(spark, name, 2024, "t", ("id", "Year"))


def test_a_filter_on_the_year_reads_only_its_table(spark, tmp_path):
    name = "years_pruned"
    for year in (2021, 2022, 2023):
        publish_table(rows(spark, year), f"{name}_{year}", path=str(tmp_path / str(year)), partition_by="day")
        years.add_year(spark, name, year, f"{name}_{year}", COLUMNS)
    plan = spark.table(name).filter("year = 2022")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "years_pruned_2022" in plan


def test_runs_of_two_years_share_a_name(spark, tmp_path):
    from paylake.plans.bindings import raw_payments, write_csv

    raw = raw_payments(spark, "/root/testdata/sf0.001").filter("Date_of_Payment LIKE '0%/1%/%'")
    counts = {}
    for year in (1995, 1996):
        part = raw.filter(F.col("Program_Year") == str(year))
        write_csv(part.coalesce(1), str(tmp_path / "raw" / str(year)))
        cfg = JobConfig.for_year(str(tmp_path), year, all_years="years_runs", gold_path=str(tmp_path / f"g{year}"))
        counts[year] = run_stages(spark, cfg).gold
    assert dict(spark.table("years_runs").groupBy("year").count().collect()) == counts
    with pytest.raises(ValueError, match="needs the year"):
        run_stages(spark, JobConfig("a", "b", all_years="x"))


def test_a_look_up_reads_few_row_groups(spark, tmp_path):
    i = F.col("id")
    df = spark.range(60_000).select(
        F.sha2(i.cast("string"), 256).alias("Record_ID"), (i % 24).alias("part"), F.lit("x" * 20).alias("pad")
    )
    key = df.first()["Record_ID"]
    read = {}
    for lookup in ((), ("Record_ID",)):
        name = f"lookup_{len(lookup)}"
        publish_table(df, name, path=str(tmp_path / name), partition_by="part", lookup=lookup)
        one = spark.table(name).filter(F.col("Record_ID") == key)
        assert one.count() == 1
        query = one._jdf.queryExecution()
        one._jdf.collectToPython()
        scan = query.executedPlan()
        while "FileScan" not in scan.nodeName() and scan.children().size():
            scan = scan.children().apply(0)
        found = [x for x in (scan.metrics().get("numOutputRows"),) if x.isDefined()]
        read[bool(lookup)] = found[0].get().value()
        read[name] = sum(p.stat().st_size for p in (tmp_path / name).rglob("*.parquet"))
    assert read[False] == 60_000 and read[True] <= 2 * 2500
    assert read["lookup_1"] < 1.5 * read["lookup_0"]
    assert spark.conf.get("parquet.bloom.filter.enabled#Record_ID", None) is None


TYPES = {
    "byte": T.ByteType(), "int": T.IntegerType(), "long": T.LongType(), "float": T.FloatType(),
    "double": T.DoubleType(), "dec10": T.DecimalType(10, 2), "dec38": T.DecimalType(38, 30),
    "date": T.DateType(), "time": T.TimestampType(), "text": T.StringType(), "null": T.NullType(),
    "list": T.ArrayType(T.LongType()),
}


@pytest.mark.parametrize(
    "a, b, want",
    [
        ("byte", "int", T.IntegerType()), ("int", "long", T.LongType()), ("float", "double", T.DoubleType()),
        ("int", "float", T.DoubleType()), ("int", "double", T.DoubleType()), ("long", "double", None),
        ("int", "dec10", T.DecimalType(12, 2)), ("long", "dec10", T.DecimalType(22, 2)), ("long", "dec38", None),
        ("dec10", "double", None), ("date", "time", T.TimestampType()), ("text", "int", None),
        ("null", "list", TYPES["list"]), ("list", "text", None),
    ],
)
def test_wider(a, b, want):
    assert wider(TYPES[a], TYPES[b]) == wider(TYPES[b], TYPES[a]) == want


def test_wider_holds_for_all_pairs():
    for a, b in itertools.product(TYPES.values(), repeat=2):
        both = wider(a, b)
        assert both == wider(b, a)
        if both is not None:
            assert wider(both, a) == both and wider(both, b) == both


def test_old_and_new_files_are_read_together(spark, tmp_path):
    spark.sql("SELECT 1 AS a, 1.5f AS b, DATE '2020-01-01' AS d").write.parquet(str(tmp_path / "1"))
    spark.sql("SELECT 2L AS a, 2.5d AS b, 'new' AS c, TIMESTAMP '2021-01-01 01:00:00' AS d").write.parquet(
        str(tmp_path / "2")
    )
    spark.sql("SELECT CAST(3 AS DECIMAL(30,1)) AS a").write.parquet(str(tmp_path / "3"))
    got = merged.read_merged(spark, [str(tmp_path / x) for x in "123"])
    assert got.schema.simpleString() == "struct<a:decimal(30,1),b:double,d:timestamp,c:string>"
    assert [tuple(r) for r in got.orderBy("a").collect()] == [
        (Decimal(1), 1.5, dt.datetime(2020, 1, 1), None),
        (Decimal(2), 2.5, dt.datetime(2021, 1, 1, 1), "new"),
        (Decimal(3), None, None, None),
    ]
    plan = got.filter("a = 2")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 3


def test_conflicts_raise_or_become_text(spark, tmp_path):
    spark.sql("SELECT 1 AS a").write.parquet(str(tmp_path / "1"))
    spark.sql("SELECT 'x' AS a").write.parquet(str(tmp_path / "2"))
    with pytest.raises(SchemaConflict, match="column a is int.*string"):
        merged.read_merged(spark, str(tmp_path / "*"))
    got = merged.read_merged(spark, str(tmp_path / "*"), conflicts_as_text=True)
    assert sorted(r.a for r in got.collect()) == ["1", "x"]
    with pytest.raises(FileNotFoundError):
        (tmp_path / "none").mkdir()
        merged.read_merged(spark, str(tmp_path / "none"))


def test_files_of_one_schema_are_one_scan(spark, tmp_path):
    spark.range(20).repartition(6).write.parquet(str(tmp_path / "p"))
    got = merged.read_merged(spark, str(tmp_path / "p"))
    assert got.count() == 20
    assert got._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
