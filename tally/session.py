"""Session helpers: scale-oriented defaults and the shared checkpoint folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings the jobs are written for.  On a cluster they belong in the cluster's
# spark-defaults; `get_session` applies them for local runs and tests.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    # remove reliable-checkpoint files once their DataFrames are garbage-collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # long sessions run many small jobs: keep bounded execution/job/stage history on the driver
    "spark.sql.ui.retainedExecutions": "50",
    "spark.ui.retainedJobs": "200",
    "spark.ui.retainedStages": "200",
}

# Driver heap for local sessions (all executors live in the driver JVM there).
LOCAL_DRIVER_MEMORY = "8g"


def get_session(master: str | None = None, app: str = "tally", shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in SCALE_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if (master or "").startswith("local") and "spark.driver.memory" not in (extra or {}):
        builder = builder.config("spark.driver.memory", LOCAL_DRIVER_MEMORY)
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, configuring it only when unset.

    The cluster names a shared folder in ``spark.checkpoint.dir``; that is used
    as is.  Only a local-mode session with no setting (a test) gets a fresh
    scratch folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
    elif sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="run-", dir="/tmp"))
    else:
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder for job outputs next to the shared checkpoint folder."""
    import uuid

    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tally-{name}-{uuid.uuid4().hex[:12]}"


POSITION_PARTITIONS_CONF = "spark.tally.positionPartitions"


def shuffle_partitions(spark: SparkSession) -> int:
    """Range partitions for the ordered (position) steps.

    ``spark.tally.positionPartitions`` when set, else ``spark.sql.shuffle.partitions``.
    AQE can merge small partitions but never splits a range partition, so on a
    large input set it to about input bytes / 1 GB (e.g. 100000 for 100 TB).
    """
    v = spark.conf.get(POSITION_PARTITIONS_CONF, None)
    return int(v) if v else int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
