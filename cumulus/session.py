"""Session construction and cluster-safe settings."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings every job wants: AQE re-plans at runtime (coalesces small shuffle
# partitions, splits skewed join partitions), ANSI on, UTC session clock.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
}


def build_session(master: str | None = None, app: str = "cumulus",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the folder is set by the deployment and is read, never
    replaced; a cluster session without it is an error (a machine-local
    folder would not survive the loss of an executor or be visible to the
    others).  Only a ``local[...]`` session (tests, a laptop) gets a scratch
    folder of its own.
    """
    sc = spark.sparkContext
    conf_dir = (spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
                or sc.getCheckpointDir())
    if not conf_dir:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("spark.checkpoint.dir must name a shared folder (e.g. on the cluster file system)")
        conf_dir = tempfile.mkdtemp(prefix="cumulus-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(conf_dir)
    return conf_dir


def shared_path(spark: SparkSession, name: str) -> str:
    """A path for intermediate tables under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tables/{name}"
