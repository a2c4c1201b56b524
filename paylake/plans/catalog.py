"""The registered queries: one per operator, each over the whole of its tables."""

from __future__ import annotations

import datetime as dt
import hashlib
import json
import uuid
from collections.abc import Callable
from contextlib import suppress
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paylake.functions.scalars import safe_cast_numeric, safe_parse_date
from paylake.operators import quality, quarantine, reports, uniqueness
from paylake.operators.gold import to_gold
from paylake.operators.silver import project_silver, require_key, to_silver
from paylake.operators.summary import Reports, Where
from paylake.plans import runlog
from paylake.plans.bindings import payments, raw_payments, table, write_csv
from paylake.plans.stages import (
    JobConfig,
    build_gold,
    build_summary,
    load_staging,
    open_reports,
    process_records,
    run_stages,
)
from paylake.schema import (
    CLUSTER_COLUMNS,
    GOLD_COLUMNS,
    PARTITION_COLUMN,
    SILVER_FROM_RAW,
    raw_schema,
)
from paylake.session import scratch_dir
from paylake.sinks import years
from paylake.sinks.tables import replace_parquet, replace_table
from paylake.sinks.versions import publish_table, versions
from paylake.sources import layouts, merged
from paylake.sources.records import read_records
from paylake.sources.tables import read_parquet, read_table

Query = Callable[[SparkSession, str], DataFrame]

FIRST_DAY, LAST_DAY = dt.date(1996, 1, 1), dt.date(1996, 12, 31)

# Written once per session and data folder, then shared by the queries that read them.
_written: dict[tuple[str, str], object] = {}


def _tag(sf_dir: str) -> str:
    return hashlib.md5(sf_dir.encode()).hexdigest()[:8]


def _place(spark: SparkSession, sf_dir: str, name: str) -> str:
    return f"{scratch_dir(spark)}/{_tag(sf_dir)}/{name}"


def _once(spark: SparkSession, sf_dir: str, name: str, make: Callable[[str], object]) -> object:
    place = _place(spark, sf_dir, name)
    key = (spark.sparkContext.applicationId, place)
    if key not in _written:
        _written[key] = make(place)
    return _written[key]


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return require_key(payments(spark, sf_dir))


def _gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_gold(_silver(spark, sf_dir))


def _raw_csv(spark: SparkSession, sf_dir: str) -> str:
    return _once(
        spark,
        sf_dir,
        "raw_csv",
        lambda place: write_csv(raw_payments(spark, sf_dir), place, deal=True),
    )


def _documents_csv(spark: SparkSession, sf_dir: str) -> str:
    return _once(
        spark,
        sf_dir,
        "documents_csv",
        lambda place: write_csv(table(spark, sf_dir, "documents"), place, deal=True),
    )


def _stored_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The day-partitioned gold table."""
    name = f"gold_by_day_{_tag(sf_dir)}"

    def make(place: str) -> str:
        build_gold(_silver(spark, sf_dir), name, place)
        return name

    return read_table(spark, _once(spark, sf_dir, "gold_by_day", make)).select(*GOLD_COLUMNS)


def _run(spark: SparkSession, sf_dir: str) -> JobConfig:
    """All stages, from the CSV files of the whole table; where each layer is."""

    def make(place: str) -> JobConfig:
        cfg = JobConfig(
            input_path=_raw_csv(spark, sf_dir),
            silver_path=f"{place}/silver",
            staging_table=f"run_staging_{_tag(sf_dir)}",
            gold_table=f"run_gold_{_tag(sf_dir)}",
            gold_path=f"{place}/gold",
            max_bad_share=0.2,
        )
        run_stages(spark, cfg)
        return cfg

    return _once(spark, sf_dir, "run", make)


# Sources


def csv_multiline_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = table(spark, sf_dir, "documents").schema
    return read_records(spark, _documents_csv(spark, sf_dir), schema)


def csv_line_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table without line breaks in its fields, its files split into blocks."""
    columns = (
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        "o_totalprice",
        "o_orderdate",
        "o_orderpriority",
    )
    orders = table(spark, sf_dir, "orders").select(*columns)
    orders = orders.withColumn("o_orderdate", F.col("o_orderdate").cast("date"))
    path = _once(
        spark,
        sf_dir,
        "orders_csv",
        lambda place: write_csv(orders, place, deal=True),
    )
    return read_records(spark, path, orders.schema, multi_line=False)


def csv_bad_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_records(spark, _raw_csv(spark, sf_dir), raw_schema()).select(
        F.col("Covered_Recipient_Profile_ID").alias("profile_id"),
        F.col("Total_Amount_of_Payment_USDollars").alias("amount"),
        F.col("Number_of_Payments_Included_in_Total_Amount").alias("n_payments"),
        F.col("Contextual_Information").alias("context"),
        F.col("Recipient_Zip_Code").alias("zip_code"),
    )


# Silver and staging


def silver_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Projection and renames from the 91-column shape, then the key filter."""
    raw = raw_payments(spark, sf_dir)
    typed = {f.name: F.col(f.name).try_cast(f.dataType) for f in raw_schema()}
    return to_silver(raw.select([c.alias(n) for n, c in typed.items()]))


def silver_from_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_silver(read_records(spark, _raw_csv(spark, sf_dir), raw_schema()))


# Two earlier generations of the record layout: names that were changed since, fewer columns,
# the amount as text; and the same columns as today from the last to the first, and one more.
_RENAMED = {
    "Covered_Recipient_Profile_ID": "Profile_ID",
    "Covered_Recipient_NPI": "NPI",
    "Covered_Recipient_First_Name": "First_Name",
    "Covered_Recipient_Last_Name": "Last_Name",
}


def silver_from_layouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three generations of record files, each bound by its header, as one silver."""

    def make(place: str) -> str:
        raw = raw_payments(spark, sf_dir)
        of = F.pmod(F.col("Covered_Recipient_Profile_ID").cast("long"), F.lit(3))
        old = [c for c in raw.columns if c in (*SILVER_FROM_RAW.values(), *_RENAMED)]
        first = raw.filter(of == 0).select(*[F.col(c).alias(_RENAMED.get(c, c)) for c in old])
        second = raw.filter(of == 1).select(*reversed(raw.columns), F.lit("new").alias("Added_Column"))
        for n, part in enumerate((first, second, raw.filter(of == 2))):
            write_csv(part, f"{place}/raw/{n}", deal=True)
        said = {"version": "1", "columns": first.columns, "renames": {v: k for k, v in _RENAMED.items()}}
        text = spark.createDataFrame([(json.dumps(said),)], "value string").coalesce(1)
        text.write.mode("overwrite").text(f"{place}/layouts")
        return place

    place = _once(spark, sf_dir, "generations", make)
    known = layouts.load_layouts(spark, f"{place}/layouts")
    return to_silver(layouts.read_layouts(spark, [f"{place}/raw/{n}" for n in range(3)], known)[0])


def silver_overwrite_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, place = _raw_csv(spark, sf_dir), _place(spark, sf_dir, "silver_twice")
    for _ in range(2):
        process_records(spark, source, place)
    return read_parquet(spark, place)


def _stage(spark: SparkSession, sf_dir: str, copy: bool) -> DataFrame:
    place = _place(spark, sf_dir, f"silver_staged_{copy}")
    replace_parquet(_silver(spark, sf_dir), place)
    name = f"{'copied' if copy else 'registered'}_{_tag(sf_dir)}"
    target = _place(spark, sf_dir, "silver_copied") if copy else None
    return load_staging(spark, place, name, copy=copy, path=target)


# Gold


def gold_replace_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    gold, place = _gold(spark, sf_dir), _place(spark, sf_dir, "gold_twice")
    for _ in range(2):
        stored = replace_table(gold, f"gold_twice_{_tag(sf_dir)}", path=place)
    return stored


def gold_replace_fewer_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The partitioned table replaced by a query with fewer days: no old day stays."""
    gold, name = _gold(spark, sf_dir), f"gold_fewer_{_tag(sf_dir)}"
    for rows in (gold, _range(gold)):
        stored = replace_table(
            rows,
            name,
            path=_place(spark, sf_dir, "gold_fewer"),
            partition_by=PARTITION_COLUMN,
            cluster_by=CLUSTER_COLUMNS,
        )
    return stored.select(*GOLD_COLUMNS)


def _shown_twice(spark: SparkSession, sf_dir: str) -> str:
    """A name that showed one year of gold and now shows all of it."""
    gold, name = _gold(spark, sf_dir), f"gold_shown_{_tag(sf_dir)}_{uuid.uuid4().hex[:8]}"
    for rows in (_range(gold), gold):
        publish_table(
            rows,
            name,
            path=_place(spark, sf_dir, name),
            partition_by=PARTITION_COLUMN,
            cluster_by=CLUSTER_COLUMNS,
        )
    return name


def gold_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, _shown_twice(spark, sf_dir)).select(*GOLD_COLUMNS)


def gold_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of each version behind a name, oldest first, and which of them is shown."""
    there = versions(spark, _shown_twice(spark, sf_dir))
    counts = [
        reports.row_count(read_table(spark, v.table)).select(
            F.lit(i).alias("version"), F.lit(v.current).alias("shown"), "record_count"
        )
        for i, v in enumerate(there, 1)
    ]
    return reduce(DataFrame.union, counts)


def gold_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold by program year under one name; one year was wrong at first and replaced alone."""
    name, silver = f"gold_years_{_tag(sf_dir)}", _silver(spark, sf_dir)

    def make(place: str) -> str:
        every = [int(r[0]) for r in silver.select("program_year").distinct().collect()]
        for year in (min(every), *sorted(every)):
            rows = silver.filter(F.col("program_year") == str(year))
            first = not years.years(spark, name)
            own = f"{name}_{year}"
            build_gold(rows.limit(10) if first else rows, own, f"{place}/{year}")
            years.add_year(spark, name, year, own, GOLD_COLUMNS)
        return name

    return read_table(spark, _once(spark, sf_dir, "gold_years", make))


def gold_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold with Bloom filters on the recipient, and the payments to one of them."""
    name = f"gold_lookup_{_tag(sf_dir)}"

    def make(place: str) -> str:
        build_gold(_silver(spark, sf_dir), name, place, lookup=("Record_ID", "recipient_npi"))
        return name

    stored = read_table(spark, _once(spark, sf_dir, "gold_lookup", make))
    return reports.where_equals(stored.select(*GOLD_COLUMNS), "recipient_npi", "7")


def parquet_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver files of three generations, with other types and without a column, as one."""
    place, silver = _place(spark, sf_dir, "silver_merged"), _silver(spark, sf_dir)
    of = F.pmod(F.col("Record_ID").cast("long"), F.lit(3))
    npi = F.col("recipient_npi").cast("int")
    first = silver.filter(of == 0).withColumn("recipient_npi", npi).drop("payment_form")
    second = silver.filter(of == 1).withColumn("recipient_npi", npi.cast("long"))
    third = silver.filter(of == 2).withColumn("recipient_npi", npi.cast("decimal(12,0)"))
    for n, part in enumerate((first, second, third)):
        replace_parquet(part, f"{place}/{n}")
    return merged.read_merged(spark, [f"{place}/{n}" for n in range(3)])


def gold_from_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, _run(spark, sf_dir).gold_table).select(*GOLD_COLUMNS)


def gold_comment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored table's comment beside its row count."""
    name = _run(spark, sf_dir).gold_table
    described = spark.sql(f"DESCRIBE EXTENDED {name}").filter("col_name = 'Comment'")
    rows = reports.row_count(read_table(spark, name))
    return described.select(F.col("data_type").alias("table_comment")).crossJoin(rows)


def _layers(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """What a run left behind, read back."""
    cfg = _run(spark, sf_dir)
    raw = read_records(spark, cfg.input_path, raw_schema())
    return raw, read_parquet(spark, cfg.silver_path), read_table(spark, cfg.gold_table)


def layer_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = [
        reports.row_count(df).select(F.lit(name).alias("layer"), "record_count")
        for name, df in zip(("raw", "silver", "gold"), _layers(spark, sf_dir), strict=True)
    ]
    return counts[0].union(counts[1]).union(counts[2])


def layer_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw, silver, gold = _layers(spark, sf_dir)
    return quality.layer_balance(project_silver(raw), silver, gold)


def _quarantined(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """The CSV files parsed once into silver and a quarantine: their folders."""

    def make(place: str) -> tuple[str, str]:
        silver, kept = f"{place}/silver", f"{place}/quarantine"
        process_records(spark, _raw_csv(spark, sf_dir), silver, quarantine_path=kept)
        return silver, kept

    return _once(spark, sf_dir, "guarded", make)


def quarantined_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every refused record, by which layer, and its faults."""
    kept = read_parquet(spark, _quarantined(spark, sf_dir)[1])
    return kept.select(
        *SILVER_FROM_RAW,
        quarantine.REFUSED_BY,
        F.array_join(quarantine.FAULTS, ",").alias(quarantine.FAULTS),
    )


def quarantine_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of raw, silver, gold and quarantine, and what is left over between them."""
    silver_path, kept = _quarantined(spark, sf_dir)
    raw = read_records(spark, _raw_csv(spark, sf_dir), raw_schema())
    silver = read_parquet(spark, silver_path)
    return quarantine.balance(raw, silver, to_gold(silver), read_parquet(spark, kept))


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stages of three runs: one stopped by its limit of bad rows, the next goes on from there
    with a wider one, and the last finds all done."""

    def make(place: str) -> str:
        cfg = JobConfig(
            input_path=_raw_csv(spark, sf_dir),
            silver_path=f"{place}/silver",
            staging_table=f"logged_staging_{_tag(sf_dir)}",
            gold_table=f"logged_gold_{_tag(sf_dir)}",
            gold_path=f"{place}/gold",
            run_log=f"{place}/log",
            manifest=f"{place}/done",
        )
        with suppress(quality.QualityError):
            run_stages(spark, replace(cfg, max_bad_share=0.0001))
        for _ in range(2):
            run_stages(spark, replace(cfg, max_bad_share=0.2))
        return cfg.run_log

    runs = runlog.read_runs(spark, _once(spark, sf_dir, "logged", make))
    numbered = runs.withColumn("run", F.row_number().over(Window.orderBy("started_at")))
    each = numbered.select("run", F.col("status").alias("run_status"), F.explode("stages").alias("s"))
    return each.select(
        "run",
        "run_status",
        "s.stage",
        F.col("s.status").alias("stage_status"),
        *[F.col("s.rows")[m].alias(m) for m in ("raw", "refused", "silver", "rejected", "gold")],
    )


def raw_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The declared schema as rows, and in how many records each column has a value."""
    raw = read_records(spark, _raw_csv(spark, sf_dir), raw_schema())
    counts = raw.agg(*[F.count(c).alias(c) for c in raw.columns])
    rows = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(f.name).alias("name"),
            F.lit(f.dataType.simpleString()).alias("type"),
            F.col(f.name).alias("n_values"),
        )
        for i, f in enumerate(raw.schema, 1)
    ]
    return counts.select(F.inline(F.array(*rows)))


def preview_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = read_records(spark, _raw_csv(spark, sf_dir), raw_schema())
    first = reports.preview(raw, 5, F.col("Covered_Recipient_Profile_ID").cast("long"))
    return first.select(
        "Covered_Recipient_Profile_ID",
        "Record_ID",
        "Contextual_Information",
        "Recipient_Zip_Code",
        "Program_Year",
    )


# Reports


def _summed(spark: SparkSession, sf_dir: str) -> Reports:
    """Reports from the cube of the gold table that a whole run made."""
    table = _run(spark, sf_dir).gold_table
    _once(spark, sf_dir, "summary", lambda place: build_summary(spark, table, place) and table)
    return open_reports(spark, table)


def gold_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _summed(spark, sf_dir).summary


def _summary_report(report: Callable[[Reports], DataFrame]) -> Query:
    return lambda spark, sf_dir: report(_summed(spark, sf_dir))


def _on(source: Query, *steps: Callable[[DataFrame], DataFrame]) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = source(spark, sf_dir)
        for step in steps:
            df = df.transform(step)
        return df

    return query


def _lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem")


def _double_orders(df: DataFrame) -> DataFrame:
    return uniqueness.duplicate_keys(df, "l_orderkey")


def key_uniqueness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Double keys of silver, which has none, and of silver with some days delivered twice."""
    silver = _silver(spark, sf_dir)
    twice = silver.unionByName(silver.filter(F.col("payment_date_str").endswith("1995")))
    named = {"silver": silver, "delivered_twice": twice}
    parts = [
        uniqueness.key_uniqueness(df).select(F.lit(name).alias("rows_of"), "*")
        for name, df in named.items()
    ]
    return parts[0].unionByName(parts[1])


def _lineitem_months(df: DataFrame) -> DataFrame:
    return reports.monthly_total(
        df, F.to_date("l_shipdate"), safe_cast_numeric(F.col("l_extendedprice"))
    )


def _by(dimension: str) -> Callable[[DataFrame], DataFrame]:
    return lambda df: reports.count_by(df, dimension)


def _range(df: DataFrame) -> DataFrame:
    return reports.in_range(df, FIRST_DAY, LAST_DAY)


def _state_f(df: DataFrame) -> DataFrame:
    return reports.where_equals(df, "recipient_state", "F")


def _preview(df: DataFrame) -> DataFrame:
    return reports.preview(df, 5, F.col("Record_ID").cast("long"))


def _dates(df: DataFrame) -> DataFrame:
    parsed = safe_parse_date(F.col("payment_date_str")).alias("payment_date")
    return df.select("payment_date_str", parsed)


def _amounts(df: DataFrame) -> DataFrame:
    amount = safe_cast_numeric(F.col("payment_amount_usd")).alias("payment_amount_usd")
    return df.select("Record_ID", "recipient_npi", amount)


def queries() -> dict[str, Query]:
    return {
        "csv_multiline_scan": csv_multiline_scan,
        "csv_line_scan": csv_line_scan,
        "csv_bad_values": csv_bad_values,
        "silver_transform": silver_transform,
        "silver_from_csv": silver_from_csv,
        "silver_from_layouts": silver_from_layouts,
        "silver_overwrite_roundtrip": silver_overwrite_roundtrip,
        "parquet_glob_stage": lambda spark, sf_dir: _stage(spark, sf_dir, copy=True),
        "parquet_register_stage": lambda spark, sf_dir: _stage(spark, sf_dir, copy=False),
        "safe_parse_date": _on(payments, _dates),
        "safe_cast_numeric": _on(payments, _amounts),
        "gold_transform": _gold,
        "gold_replace_idempotent": gold_replace_idempotent,
        "gold_partitioned_table": _stored_gold,
        "gold_replace_fewer_days": gold_replace_fewer_days,
        "gold_years": gold_years,
        "gold_lookup": gold_lookup,
        "parquet_merged": parquet_merged,
        "gold_published": gold_published,
        "gold_versions": gold_versions,
        "gold_from_csv": gold_from_csv,
        "raw_count": _on(payments, reports.row_count),
        "gold_count": _on(_gold, reports.row_count),
        "layer_counts": layer_counts,
        "layer_balance": layer_balance,
        "gold_comment": gold_comment,
        "run_log": run_log,
        "quarantined_records": quarantined_records,
        "quarantine_balance": quarantine_balance,
        "count_by_nature": _on(_gold, _by("payment_nature")),
        "count_by_state": _on(_gold, _by("recipient_state")),
        "monthly_total": _on(_gold, reports.monthly_total),
        "monthly_total_lineitem": _on(_lineitem, _lineitem_months),
        "count_by_status_lineitem": _on(_lineitem, _by("l_linestatus")),
        "date_range_filter": _on(_gold, _range),
        "count_by_nature_in_range": _on(_gold, _range, _by("payment_nature")),
        "monthly_total_in_range": _on(_gold, _range, reports.monthly_total),
        "state_filter": _on(_gold, _state_f),
        "stored_count_by_nature": _on(_stored_gold, _by("payment_nature")),
        "stored_count_by_state": _on(_stored_gold, _by("recipient_state")),
        "stored_monthly_total": _on(_stored_gold, reports.monthly_total),
        "stored_count_by_nature_in_range": _on(_stored_gold, _range, _by("payment_nature")),
        "stored_monthly_total_in_range": _on(_stored_gold, _range, reports.monthly_total),
        "stored_state_filter": _on(_stored_gold, _state_f),
        "gold_summary": gold_summary,
        "summary_count": _summary_report(lambda r: r.row_count()),
        "summary_count_by_nature": _summary_report(lambda r: r.count_by("payment_nature")),
        "summary_count_by_state_in_range": _summary_report(
            lambda r: r.count_by("recipient_state", Where(FIRST_DAY, LAST_DAY))
        ),
        "summary_monthly_total": _summary_report(lambda r: r.monthly_total()),
        "summary_monthly_total_of_state": _summary_report(
            lambda r: r.monthly_total(Where(equals={"recipient_state": "F"}))
        ),
        "preview_raw": preview_raw,
        "raw_columns": raw_columns,
        "preview_rows": _on(_gold, _preview),
        "dq_metrics": _on(payments, quality.silver_quality),
        "dq_metrics_gold": _on(_gold, quality.gold_quality),
        "duplicate_keys": _on(_lineitem, _double_orders),
        "key_uniqueness": key_uniqueness,
    }


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages from the CSV files, then records by kind of payment on the stored table."""
    return reports.count_by(gold_from_csv(spark, sf_dir), "payment_nature")
