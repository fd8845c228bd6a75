"""Session settings and the shared folder that jobs may write to."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Named query terms reach the row group filter as such and not as one range.
    "spark.sql.parquet.pushdown.inFilterThreshold": "2000",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app_name: str = "termweave", master: str | None = None, **settings: str) -> SparkSession:
    """A session with the adaptive settings the jobs expect; `settings` override them."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, taken from `spark.checkpoint.dir`.

    Where that is unset a local session gets a temporary folder (tests), which is removed
    when the program ends; a cluster session is refused, since a machine-local folder is
    lost with its machine. Results may be read from it at any time, so on a shared folder
    tables stay until its owner removes them.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if configured is None and current is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        configured = tempfile.mkdtemp(prefix="termweave-")
        atexit.register(shutil.rmtree, configured, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", configured)
    if current is None:
        spark.sparkContext.setCheckpointDir(configured)
    return configured or current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
