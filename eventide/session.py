"""Session helpers: one place that builds a local session for tests/bench and
resolves the shared scratch folder (``spark.checkpoint.dir``) for jobs that
must materialise data (round trips, sinks, streaming checkpoints)."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.executorEnv.PYTHONWARNINGS": "ignore::FutureWarning",
    "spark.driver.memory": "16g",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def get_session(master: str | None = None, app: str = "eventide", **extra) -> SparkSession:
    """Local session for tests and the bench; on a cluster use the provided one."""
    master = master or f"local[{os.environ.get('BENCH_CPUS', '*')}]"
    b = SparkSession.builder.master(master).appName(app)
    for k, v in {**DEFAULT_CONF, **extra}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_utc(spark: SparkSession) -> None:
    """Event times are zone-less (TIMESTAMP_NTZ); conversions to and from
    epoch numbers are defined in UTC."""
    if spark.conf.get("spark.sql.session.timeZone", "UTC") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    On a cluster ``spark.checkpoint.dir`` points at shared storage and is
    used as is.  Only where it is unset and the master is local (tests) a
    private folder is created; elsewhere executors could not see one, so that
    is an error.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="eventide-ckpt-")
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub-path of the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def fork_point(df):
    """Materialise a DataFrame that feeds several branches: a reliable
    checkpoint in the shared checkpoint folder (survives executor loss, cuts
    lineage), so each branch reads it instead of recomputing the shuffles
    that produced it."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
