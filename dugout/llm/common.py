"""Helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dugout.session import shared_dir

# A side is broadcast only when its counted rows stay within this bound; beyond it the same join
# is shuffled. Rows broadcast by these operators are a few machine words each (< 100 bytes).
BROADCAST_ROWS = 200_000


def run_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder for one run's intermediate or output files, under the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/dugout-llm/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors."""
    path = run_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Mark a *staged* side for broadcast when its counted rows are within ``rows``."""
    return F.broadcast(df) if df.count() <= rows else df


def text_or_empty(col: str | Column = "text") -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


# Rows that pass between the JVM and Python at once. Documents are long, so Spark's 10,000 would be tens of
# MB in each of several buffers per task; the results do not depend on it.
BATCH_ROWS = 1_000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def ship_package(spark: SparkSession) -> None:
    """Prepare a session for operators that run Python in tasks: bounded batches, and this package on the
    workers (once per context), for clusters where it isn't installed."""
    if not 0 < int(spark.conf.get(_BATCH)) <= BATCH_ROWS:
        spark.conf.set(_BATCH, str(BATCH_ROWS))
    sc = spark.sparkContext
    if getattr(sc, "_dugout_shipped", False):
        return
    root = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="dugout-ship-")) / "dugout.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(str(archive))
    sc._dugout_shipped = True
