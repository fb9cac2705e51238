"""Session settings and the shared scratch location."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job wants: runtime re-planning with skew handling, and dates
# that mean the same on every executor.
SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Python's names for legacy codepages (cp437, big5, windows-1252 ...) are
    # Java charset names too, once Spark is told to accept more than UTF/ASCII.
    "spark.sql.legacy.javaCharsets": "true",
    # A byte the codepage does not define becomes U+FFFD instead of failing the job.
    "spark.sql.legacy.codingErrorAction": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session that already exists."""
    for key, value in SESSION_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str = "tideline", master: str | None = None, **settings: str) -> SparkSession:
    """A session with the library's settings; extra settings win."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh path for intermediate tables in the cluster's shared folder.

    The folder is ``spark.checkpoint.dir``.  Where the session names none a
    temporary folder is made, but only in local mode: on a cluster the executors
    would not see it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="tideline-")
    return f"{base.rstrip('/')}/tideline-{purpose}-{uuid.uuid4().hex}"


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder that a run made for itself."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
