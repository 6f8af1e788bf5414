"""Session settings the results depend on, and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that change results or plans, and one for listing. Sizes (shuffle partitions, memory,
# split bytes) belong to the cluster and are left alone.
RUNTIME_SETTINGS = {
    # The timestamp pattern has no zone of its own: the wall clock is UTC.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # Duplicate JSON keys: the last one wins.
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.json.enablePartialResults": "true",
    # Runtime sizes decide on broadcasts, splits and merges.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # HotSpot never compiles a longer method; the wide staging projection would
    # run interpreted instead of falling back to split methods.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Many folders are listed by a Spark job with a task for each; a task of its own costs far more than
    # a folder's listing, so a task takes many.
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "64",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings above to a session made elsewhere."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(master: str | None = None, app: str = "callmill", **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in extra.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local session (a test) that names none gets a folder of its own: on a
    cluster that would be one machine's disk.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "")):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="callmill-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root


def scratch(spark: SparkSession, label: str) -> str:
    """A new path under the shared folder; nothing else writes there."""
    return f"{shared_dir(spark).rstrip('/')}/callmill/{label}-{uuid.uuid4().hex}"
