"""What was read and which stages are done, so that a rerun goes on where the last one failed.

A folder of small Parquet files that is only appended to: an event when a stage starts and one
when it is finished. Of each stage the last event counts. A stage may be skipped if that is
``finished``, for the same inputs and settings, and what it made is still there. Inputs are the
files' names, sizes and times, taken from the folder's listing; nothing of them is read.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = (
    "event_id string, at timestamp, stage string, status string, inputs string,"
    " made string, rows map<string,bigint>"
)
STARTED, FINISHED = "started", "finished"


@dataclass(frozen=True)
class Done:
    """A finished stage: its event, what it made, and the rows it counted."""

    event_id: str
    made: str
    rows: dict[str, int]


def list_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(path, length, modified) of the files under a folder or wildcard; reads none of them."""
    files = spark.read.format("binaryFile").load(path)
    return files.select("path", "length", F.col("modificationTime").alias("modified"))


def signature(spark: SparkSession, path: str | list[str], **settings: object) -> str:
    """A digest of a folder's files and of settings; the order of the listing does not matter."""
    one = F.xxhash64("path", "length", F.unix_micros("modified"))
    row = (
        list_files(spark, path)
        .agg(F.count(F.lit(1)), F.sum("length"), F.bit_xor(one), F.sum(one.bitwiseAND(0xFFFFFFFF)))
        .first()
    )
    said = json.dumps([list(map(str, row)), settings], sort_keys=True, default=str)
    return hashlib.sha256(said.encode()).hexdigest()


def is_complete(spark: SparkSession, folder: str) -> bool:
    """Whether a writer has committed the folder."""
    jvm, context = spark._jvm, spark.sparkContext._jsc
    path = jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/_SUCCESS")
    return path.getFileSystem(context.hadoopConfiguration()).exists(path)


class Manifest:
    """The manifest under a path; without a path nothing is remembered and all is done anew."""

    def __init__(self, spark: SparkSession, path: str | None):
        self.spark, self.path = spark, path

    def events(self) -> DataFrame:
        return self.spark.read.schema(SCHEMA).parquet(self.path)

    def finished(self, stage: str, inputs: str) -> Done | None:
        """The stage's last event, if it finished for these inputs."""
        if self.path is None or not self._exists():
            return None
        own = self.events().filter(F.col("stage") == stage)
        # Two events may have one time; a stage never finishes before it starts.
        last = own.orderBy(F.desc("at"), F.desc(F.col("status") == STARTED)).limit(1).collect()
        if not last or last[0]["status"] != FINISHED or last[0]["inputs"] != inputs:
            return None
        return Done(last[0]["event_id"], last[0]["made"], dict(last[0]["rows"]))

    def start(self, stage: str, inputs: str) -> None:
        self._append(stage, STARTED, inputs, None, {})

    def finish(self, stage: str, inputs: str, made: str, rows: dict[str, int]) -> str:
        return self._append(stage, FINISHED, inputs, made, rows)

    def _append(self, stage, status, inputs, made, rows) -> str:
        event = uuid.uuid4().hex
        if self.path is not None:
            row = (event, dt.datetime.now(dt.timezone.utc), stage, status, inputs, made, rows)
            one = self.spark.createDataFrame([row], SCHEMA).coalesce(1)
            one.write.mode("append").parquet(self.path)
        return event

    def _exists(self) -> bool:
        jvm, context = self.spark._jvm, self.spark.sparkContext._jsc
        path = jvm.org.apache.hadoop.fs.Path(self.path)
        return path.getFileSystem(context.hadoopConfiguration()).exists(path)
