"""Session settings and the shared working folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# Runtime settings the operators rely on; all may be overridden by the cluster.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The stage table has over 200 derived columns; inferring constraints for
    # every alias combination of a range filter costs minutes of planning.
    "spark.sql.constraintPropagation.enabled": "false",
}

# Fixed when a session starts. Recording the Python call site of each of tens of
# thousands of column expressions is most of the time in which a plan is built.
START_CONF = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for k, v in RUNTIME_CONF.items():
        spark.conf.set(k, v)
    return spark


def build_session(app: str = "fleethealth", master: str | None = None, **conf) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in {**RUNTIME_CONF, **START_CONF, **conf}.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``.

    Where that is unset, a folder below the warehouse, which is shared as well.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        current = spark.sparkContext._jsc.sc().getCheckpointDir()
        base = current.get() if current.isDefined() else None
    if base is None:
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/scratch"
    return base.rstrip("/")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """Fresh path below the shared folder."""
    return f"{shared_dir(spark)}/fleethealth/{name}-{uuid.uuid4().hex[:12]}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(shared_dir(spark))


def release(spark: SparkSession) -> None:
    """Let shuffle files of plans that are done be deleted: Spark's cleaner follows
    the JVM's garbage collection, which a driver with a large heap rarely needs."""
    spark.sparkContext._jvm.System.gc()
