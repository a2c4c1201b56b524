"""Session settings and the scratch folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# What the engine relies on or gains from; everything else is Spark's default.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    # Size of a rebalanced write task, and with it of a day's files.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
}

_local_scratch: dict[str, str] = {}


def build_session(app_name: str = "paylake", **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession) -> str:
    """This application's folder under the shared ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a local folder.
    """
    app = spark.sparkContext.applicationId
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/paylake-{app}"
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if app not in _local_scratch:
        _local_scratch[app] = tempfile.mkdtemp(prefix="paylake-")
    return _local_scratch[app]
