"""A table of runs: one row for each, good or failed, with times and rows by stage.

The table is a Parquet folder that is only appended to, one small file a run, written when the
run ends. A stage that fails is the last of its run and has what it had counted by then.
"""

from __future__ import annotations

import datetime as dt
import logging
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

log = logging.getLogger(__name__)

SCHEMA = (
    "run_id string, job string, started_at timestamp, seconds double, status string,"
    " failed_stage string, error string, stages array<struct<stage:string,"
    " started_at:timestamp, seconds:double, status:string, rows:map<string,bigint>>>"
)
DONE, FAILED, SKIPPED = "done", "failed", "skipped"
# An error's text is cut to so many characters.
_ERROR_CHARS = 2000


class Stage:
    """What a stage says of itself while it runs."""

    def __init__(self, name: str):
        self.name, self.status = name, DONE
        self.started = dt.datetime.now(dt.timezone.utc)
        self._clock = time.monotonic()
        self.rows: dict[str, int] = {}

    def counted(self, rows: dict[str, int]) -> None:
        self.rows.update({k: int(v) for k, v in rows.items()})

    def skip(self) -> None:
        """Nothing was done: the result of an earlier run stands."""
        self.status = SKIPPED

    def row(self) -> tuple:
        return (self.name, self.started, time.monotonic() - self._clock, self.status, self.rows)


class Run:
    """One run; its stages are added as they end."""

    def __init__(self, job: str, run_id: str | None = None):
        self.job, self.run_id = job, run_id or uuid.uuid4().hex
        self.started = dt.datetime.now(dt.timezone.utc)
        self._clock = time.monotonic()
        self.stages: list[tuple] = []
        self.failed_stage: str | None = None

    @contextmanager
    def stage(self, name: str) -> Iterator[Stage]:
        own = Stage(name)
        try:
            yield own
        except BaseException:
            own.status, self.failed_stage = FAILED, name
            raise
        finally:
            self.stages.append(own.row())

    def row(self, error: BaseException | None) -> tuple:
        status = FAILED if error else DONE
        text = f"{type(error).__name__}: {error}"[:_ERROR_CHARS] if error else None
        seconds = time.monotonic() - self._clock
        return (self.run_id, self.job, self.started, seconds, status, self.failed_stage, text, self.stages)


@contextmanager
def recorded(spark: SparkSession, path: str | None, job: str) -> Iterator[Run]:
    """A run that is appended to the table under ``path`` when it ends, however it ends.

    Without a path nothing is written. If a failed run cannot be recorded, its own error is
    the one that is raised.
    """
    run = Run(job)
    try:
        yield run
    except BaseException as error:
        if path:
            try:
                append(spark, path, run.row(error))
            except Exception:
                log.exception("the failed run %s could not be recorded", run.run_id)
        raise
    if path:
        append(spark, path, run.row(None))


def append(spark: SparkSession, path: str, row: tuple) -> None:
    spark.createDataFrame([row], SCHEMA).coalesce(1).write.mode("append").parquet(path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(path)


def stage_rows(runs: DataFrame) -> DataFrame:
    """(run_id, started_at, stage, status, seconds, measure, row_count), one for each count."""
    each = runs.select("run_id", "started_at", F.explode("stages").alias("s"))
    return each.select(
        "run_id",
        "started_at",
        "s.stage",
        "s.status",
        "s.seconds",
        F.explode_outer("s.rows").alias("measure", "row_count"),
    )


def changes(runs: DataFrame) -> DataFrame:
    """Each good run of a job beside the good run before it: rows of raw, silver and gold."""
    from pyspark.sql import Window

    def total(measure: str):
        maps = F.transform("stages", lambda s: s["rows"][measure])
        return F.array_max(F.array_compact(maps))

    layers = ("raw", "silver", "gold")
    before = Window.partitionBy("job").orderBy("started_at", "run_id")
    good = runs.filter(F.col("status") == DONE).select(
        "run_id", "job", "started_at", "seconds", *[total(x).alias(x) for x in layers]
    )
    return good.select(
        "*", *[(F.col(x) - F.lag(x).over(before)).alias(f"{x}_change") for x in layers]
    )
