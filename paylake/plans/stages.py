"""The three stages, in order: records to silver, silver to staging, staging to gold.

Each stage replaces its target, so a rerun gives the same state. An error in one
stage stops the chain.
"""

from __future__ import annotations

import logging
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession

from paylake.operators import quarantine
from paylake.operators.gold import to_gold
from paylake.operators.quality import (
    observe_raw,
    observe_silver,
    require_balance,
    require_quality,
)
from paylake.operators.silver import project_silver, require_key
from paylake.operators.summary import DIMENSIONS, Reports, summarize
from paylake.operators.uniqueness import require_unique
from paylake.plans.manifest import Manifest, is_complete, signature
from paylake.plans.runlog import Stage, recorded
from paylake.schema import CLUSTER_COLUMNS, GOLD_COLUMNS, PARTITION_COLUMN, raw_schema
from paylake.sinks.tables import delete_folder, replace_parquet
from paylake.sinks.versions import KEEP, current_version, origin, publish_folder, publish_table
from paylake.sinks.years import add_year
from paylake.sources.layouts import load_layouts, read_layouts
from paylake.sources.records import RECORD, read_records
from paylake.sources.tables import read_parquet, read_table

log = logging.getLogger(__name__)

GOLD_COMMENT = "Cleaned payment records for reporting, one row per payment"


@dataclass(frozen=True)
class JobConfig:
    """Every path, name and setting of a run."""

    input_path: str
    silver_path: str
    staging_table: str = "payments_staging"
    gold_table: str = "payments"
    gold_path: str | None = None
    # Columns of gold that are looked up by value: they get Bloom filters.
    lookup: tuple[str, ...] = ()
    # A name that shows the gold of all years, and the year of this run.
    all_years: str | None = None
    year: int | None = None
    # Whether gold's cube for reports is made too, and the folder of its files.
    summary: bool = False
    summary_path: str | None = None
    # Versions of gold that stay behind the one in use.
    keep_versions: int = KEEP
    # Staging is a pure copy of silver: by default the table points at its files.
    copy_staging: bool = False
    strict_header: bool = False
    # Whether fields may hold line breaks; if not, big files are split into blocks.
    multi_line: bool = True
    show_sample: bool = False
    # Folders of the records that silver or gold refuse, of the runs, and of what is done.
    quarantine_path: str | None = None
    refuse_malformed: bool = False
    # Folder of layout files: columns then bind by the names in each file's header.
    layouts_path: str | None = None
    run_log: str | None = None
    manifest: str | None = None
    # Largest share of rows with a bad date or amount; None sets no limit.
    max_bad_share: float | None = None
    # Whether a record key on several rows of silver stops the run before gold is replaced.
    unique_key: bool = False

    @classmethod
    def for_year(cls, base: str, year: int, **settings) -> JobConfig:
        """Folders and tables of one program year under a common base folder."""
        named = {
            "input_path": f"{base}/raw/{year}",
            "silver_path": f"{base}/silver/{year}",
            "staging_table": f"payments_staging_{year}",
            "gold_table": f"payments_{year}",
            "year": year,
        }
        return cls(**{**named, **settings})


@dataclass(frozen=True)
class RunCounts:
    """Rows per layer of one run."""

    raw: int
    silver: int
    gold: int


def process_records(
    spark: SparkSession,
    input_path: str,
    output_path: str,
    *,
    show_sample: bool = False,
    strict_header: bool = False,
    multi_line: bool = True,
    quarantine_path: str | None = None,
    refuse_malformed: bool = False,
    layouts_path: str | None = None,
) -> dict[str, int]:
    """CSV folder to silver Parquet; returns what the write counted.

    ``raw``, ``missing_key``, ``refused`` (by silver), ``silver``, ``bad_date``,
    ``bad_amount`` and ``rejected`` (by gold: bad in either) come out of the write itself,
    which has no shuffle: records are parsed once, and a task that runs again is not counted
    twice.

    With ``quarantine_path`` the records that silver or gold refuse are kept there, with what
    is wrong with them. The one parse then goes to a folder beside silver first, from which
    silver and the quarantine are written, and which goes at the end.

    With ``layouts_path`` columns bind by the names in each file's header, which picks one of
    the layouts in that folder or the declared one. Records are then not judged by their text.
    """
    if layouts_path and (quarantine_path or strict_header):
        raise ValueError("with layouts, headers are resolved: no strict header, no quarantine")
    try:
        if layouts_path:
            known = load_layouts(spark, layouts_path)
            raw, bindings = read_layouts(spark, input_path, known, multi_line=multi_line)
            for binding, files in bindings:
                log.info("%d files of layout %s", len(files), binding.layout.version)
                for change in binding.changes:
                    log.warning("%s: %s %s", change.column, change.kind, change.detail)
        else:
            raw = read_records(
                spark,
                input_path,
                raw_schema(),
                strict_header=strict_header,
                multi_line=multi_line,
                with_record=quarantine_path is not None,
            )
    except AnalysisException:
        log.error("no CSV records could be read under %s; is it a folder of CSV files?", input_path)
        raise
    if show_sample:
        shown = raw.drop(RECORD)
        shown.printSchema()
        shown.show(5, truncate=False)
    if refuse_malformed and quarantine_path is None:
        raise ValueError("malformed records are refused into a quarantine: name its path")
    raw_seen, silver_seen = Observation(), Observation()
    if quarantine_path is None:
        silver = observe_raw(project_silver(raw), raw_seen).transform(require_key)
        replace_parquet(observe_silver(silver, silver_seen), output_path)
        counts = {**raw_seen.get, **silver_seen.get}
        return {**counts, "refused": counts["missing_key"]}
    parsed_path = f"{output_path.rstrip('/')}_parsed"
    judged = quarantine.judge(raw, raw_schema(), refuse_malformed=refuse_malformed)
    refused_seen = Observation()
    judged = quarantine.observe_refused(observe_raw(judged, raw_seen), refused_seen)
    replace_parquet(judged, parsed_path)
    parsed = read_parquet(spark, parsed_path)
    replace_parquet(quarantine.refused(parsed), quarantine_path)
    replace_parquet(observe_silver(quarantine.accepted(parsed), silver_seen), output_path)
    delete_folder(spark, parsed_path)
    return {**raw_seen.get, **refused_seen.get, **silver_seen.get}


def load_staging(
    spark: SparkSession, silver_path: str, table: str, *, copy: bool, path: str | None = None
) -> DataFrame:
    """Make silver readable under a name, in place of what that stood for.

    A copy's files go under ``path``, by default under the warehouse; the copy before stays
    while queries may still read it.
    """
    if copy:
        files = read_parquet(spark, f"{silver_path.rstrip('/')}/*.parquet")
        return publish_table(files, table, path=path, keep=1)
    return publish_folder(spark, table, silver_path)


def build_gold(
    staging: DataFrame,
    table: str,
    path: str | None = None,
    written: Observation | None = None,
    keep: int = KEEP,
    lookup: Sequence[str] = (),
) -> DataFrame:
    """Typed, filtered rows as a table of day partitions, clustered inside each.

    Readers of ``table`` pass from the version before to this one in one step.
    """
    return publish_table(
        to_gold(staging),
        table,
        path=path,
        partition_by=PARTITION_COLUMN,
        cluster_by=CLUSTER_COLUMNS,
        comment=GOLD_COMMENT,
        written=written,
        keep=keep,
        lookup=lookup,
    ).select(*GOLD_COLUMNS)


def build_summary(spark: SparkSession, gold_table: str, path: str | None = None) -> DataFrame:
    """The cube of a gold table, beside it, made from the version that is shown now."""
    version = current_version(spark, gold_table)
    return publish_table(
        summarize(read_table(spark, version or gold_table)),
        summary_name(gold_table),
        path=path,
        cluster_by=DIMENSIONS,
        made_from=version,
    )


def summary_name(gold_table: str) -> str:
    return f"{gold_table}_summary"


def open_reports(spark: SparkSession, gold_table: str) -> Reports:
    """Reports over a gold table, from its summary if that is of the version shown now.

    Gold is read by that version's own name, so both stay as they are while one reports.
    """
    version, name = current_version(spark, gold_table), summary_name(gold_table)
    gold = read_table(spark, version or gold_table)
    summary = current_version(spark, name)
    if version is None or summary is None or origin(spark, name) != version:
        return Reports(gold)
    return Reports(gold, read_table(spark, summary))


def run_stages(spark: SparkSession, cfg: JobConfig) -> RunCounts:
    """All stages. Too many bad rows stop the run before gold is replaced.

    With ``cfg.run_log`` the run is recorded, also if it fails. With ``cfg.manifest`` a stage
    is skipped that a run before has finished for the same input files and settings, if what
    it made is still in place.
    """
    if cfg.all_years is not None and cfg.year is None:
        raise ValueError("a name for all years needs the year of the run")
    manifest = Manifest(spark, cfg.manifest)
    with recorded(spark, cfg.run_log, cfg.gold_table) as run:
        with run.stage("silver") as stage:
            metrics, silver_id = _silver_stage(spark, cfg, manifest, stage)
        log.info("silver: %s", metrics)
        with run.stage("quality"):
            if cfg.max_bad_share is not None:
                bad = {name: metrics[name] for name in ("bad_date", "bad_amount")}
                require_quality({"row_count": metrics["silver"], **bad}, cfg.max_bad_share)
            if cfg.unique_key:
                require_unique(read_parquet(spark, cfg.silver_path))
        with run.stage("staging"):
            load_staging(spark, cfg.silver_path, cfg.staging_table, copy=cfg.copy_staging)
        with run.stage("gold") as stage:
            metrics["gold"] = _gold_stage(spark, cfg, manifest, stage, silver_id)
            require_balance(metrics)
        if cfg.all_years is not None:
            with run.stage("years"):
                add_year(spark, cfg.all_years, cfg.year, cfg.gold_table, GOLD_COLUMNS)
        if cfg.summary:
            with run.stage("summary") as stage:
                if origin(spark, summary_name(cfg.gold_table)) == current_version(
                    spark, cfg.gold_table
                ):
                    stage.skip()
                else:
                    build_summary(spark, cfg.gold_table, cfg.summary_path)
        log.info("gold: %d rows", metrics["gold"])
    return RunCounts(metrics["raw"], metrics["silver"], metrics["gold"])


def _silver_stage(
    spark: SparkSession, cfg: JobConfig, manifest: Manifest, stage: Stage
) -> tuple[dict[str, int], str]:
    """What silver's write counted, and the event that stands for this silver."""
    settings = {
        "strict_header": cfg.strict_header,
        "multi_line": cfg.multi_line,
        "quarantine_path": cfg.quarantine_path,
        "refuse_malformed": cfg.refuse_malformed,
        "layouts_path": cfg.layouts_path,
    }
    inputs = ""
    if cfg.manifest:
        inputs = signature(spark, cfg.input_path, silver_path=cfg.silver_path, **settings)
        done = manifest.finished("silver", inputs)
        folders = [f for f in (cfg.silver_path, cfg.quarantine_path) if f]
        if done and all(is_complete(spark, f) for f in folders):
            stage.skip()
            stage.counted(done.rows)
            return done.rows, done.event_id
    manifest.start("silver", inputs)
    metrics = process_records(
        spark, cfg.input_path, cfg.silver_path, show_sample=cfg.show_sample, **settings
    )
    stage.counted(metrics)
    return metrics, manifest.finish("silver", inputs, cfg.silver_path, metrics)


def _gold_stage(
    spark: SparkSession, cfg: JobConfig, manifest: Manifest, stage: Stage, silver_id: str
) -> int:
    """Gold's rows; made anew unless the version shown was made from this silver."""
    done = manifest.finished("gold", silver_id)
    if done and current_version(spark, cfg.gold_table) == done.made:
        stage.skip()
        stage.counted(done.rows)
        return done.rows["gold"]
    manifest.start("gold", silver_id)
    written = Observation()
    staging = read_table(spark, cfg.staging_table)
    build_gold(staging, cfg.gold_table, cfg.gold_path, written, cfg.keep_versions, cfg.lookup)
    rows = {"gold": written.get["n"]}
    stage.counted(rows)
    manifest.finish("gold", silver_id, current_version(spark, cfg.gold_table), rows)
    return rows["gold"]
