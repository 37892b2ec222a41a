"""Session helpers: UTC time zone, AQE, and a shared checkpoint folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"


def use_utc(spark: SparkSession) -> SparkSession:
    """Pin the session time zone to UTC (all panel times are UTC) and turn
    off constraint propagation: wide feature projections over a many-column
    complete-case filter make the optimizer's constraint sets grow
    combinatorially (planning, not execution, then dominates)."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    if spark.conf.get("spark.sql.constraintPropagation.enabled", "true") != "false":
        spark.conf.set("spark.sql.constraintPropagation.enabled", "false")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    The folder comes from ``spark.checkpoint.dir``. Only a local-mode
    session without one (tests) gets a fresh scratch folder; on a cluster a
    missing setting is an error, never a machine-local folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get(_CHECKPOINT_KEY, None) or sc.getConf().get(_CHECKPOINT_KEY, None)
    if not configured:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a shared folder (HDFS/S3/...) on a cluster")
        configured = tempfile.mkdtemp(prefix="gridcast-ckpt-")  # local runs and tests only
        spark.conf.set(_CHECKPOINT_KEY, configured)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app: str = "gridcast", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session configured for panel work."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        # checkpoint files go when their frame is no longer referenced
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.constraintPropagation.enabled": "false",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master and master.startswith("local"):
        conf["spark.driver.memory"] = "8g"  # local mode: the driver JVM runs the tasks
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    use_utc(spark)
    checkpoint_dir(spark)
    return spark


def materialize(df):
    """Write ``df`` to the shared checkpoint folder and continue from there.

    Used where a sorted, positioned frame feeds several branches of a plan:
    the branches then scan the written result instead of re-running the
    sort, and the lineage is cut, so a lost executor re-reads files rather
    than recomputing upstream stages. ``localCheckpoint`` is never used.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
