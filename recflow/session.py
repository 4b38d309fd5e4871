"""Session construction and the shared working folder.

On a cluster the working folder is the one the cluster names in
``spark.checkpoint.dir`` (a shared file system); without that setting a cluster
run is refused.  A local run (one machine) gets a fresh local folder instead.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app: str = "recflow", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a fresh local one only when none is set."""
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir is not set: on a cluster it must name a folder that "
                               "the driver and all executors share")
        # local runs and tests only
        configured = tempfile.mkdtemp(prefix="recflow-ckpt-")
    spark.sparkContext.setCheckpointDir(configured)
    return spark.sparkContext.getCheckpointDir() or configured


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new, unique folder next to the checkpoints for written tables/streams."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/recflow/{name}-{uuid.uuid4().hex[:12]}"


#: How tables of whole texts are compressed: half of what the default takes, as texts go.
TEXTS = {"compression": "zstd"}


def stored(df: DataFrame, name: str, **options: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: what is used several times is
    computed once, and a lost executor costs no recomputation of what led there."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
