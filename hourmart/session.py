"""Session settings the library relies on, and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Correctness: naive timestamps are UTC, and an upsert replaces only the
# partitions it touches.  Scale: let AQE size, coalesce and split partitions.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

# Settings of a new session only.  PySpark records a call site for every column
# by default, which takes half of the time to build a plan.
START_CONF = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def build_session(
    app: str = "hourmart",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A session with the library's settings; the cluster decides the rest."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**START_CONF, **RUNTIME_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return prepare(builder.getOrCreate())


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a work folder that is no longer read."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder path below the shared folder named in ``spark.checkpoint.dir``.

    The context's checkpoint folder is taken where the setting is missing.  Only a
    local run may have neither: it gets a temporary folder, recorded in the
    session so that later calls share it.  On a cluster every executor would
    write to its own disk, so there the setting is required.
    """
    context = spark.sparkContext
    base = (
        spark.conf.get("spark.checkpoint.dir", None)
        or context.getConf().get("spark.checkpoint.dir")
        or context.getCheckpointDir()
    )
    if not base:
        if not (context.master == "local" or context.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="hourmart-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/hourmart/{purpose}-{uuid.uuid4().hex}"
