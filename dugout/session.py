"""SparkSession construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every dugout job relies on. AQE re-plans joins and coalesces shuffle partitions
# at runtime; skew-join splitting handles a hot team/season/player key.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "dugout",
                  shuffle_partitions: int | None = None, conf: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    merged = dict(BASE_CONF)
    if shuffle_partitions:
        merged["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    merged.update(conf or {})
    for k, v in merged.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder for lineage cuts, rebuilt tables and streaming state.

    Read from ``spark.checkpoint.dir`` (or the context's checkpoint dir).  Only a *local* session
    (tests, laptops) may fall back to a scratch folder; on a cluster an unset setting is an error,
    because a machine-local folder would not survive losing that machine.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3/ABFS/GCS)")
        d = tempfile.mkdtemp(prefix="dugout-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d
