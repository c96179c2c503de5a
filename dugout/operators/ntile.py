"""NTILE that does not funnel a hot group through one task.

``F.ntile(n).over(Window.partitionBy(g).orderBy(v, k))`` shuffles every row of a group to one
task and sorts it there; a league-season holding a third of all rows would make that task the
whole job.  Here the rows are ranked by one range partitioning instead:

* rows are range-partitioned and sorted by (group, value, tie-break), so a hot group, or a value that very many
  rows share, lies across several tasks; each row's place in its partition comes from
  ``monotonically_increasing_id`` and the ranked rows are written once,
* (group, partition) counts of the written rows, a row or two for each partition beyond one a group, are summed over a
  group's partitions; the row number is that offset plus the place in the partition.

The input is read once and no row is joined to other rows. The bucket then follows arithmetically from the row
number and the group size, exactly as NTILE assigns it: the first ``size % n`` buckets get one extra row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dugout.sources.sinks import materialize

PLACE_BITS = 33                         # of monotonically_increasing_id: the place in the partition


def ranked(df: DataFrame, partition_by: Sequence[str], value: str, tiebreak: Sequence[str]) -> DataFrame:
    """``df`` with _row (ROW_NUMBER() OVER (PARTITION BY partition_by ORDER BY value, *tiebreak), nulls first) and _size (rows of the group)."""
    keys = list(partition_by)
    order = [F.col(x).asc_nulls_first() for x in [*keys, value, *tiebreak]]
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = materialize(df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
                       .withColumn("_at", F.monotonically_increasing_id()), "ranked")
    part = F.shiftright("_at", PLACE_BITS)
    counts = rows.groupBy(*keys, part.alias("_part")).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_c"))
    group = Window.partitionBy(*keys)
    before = F.coalesce(F.sum("_c").over(group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select(*[F.col(k).alias(f"_g_{k}") for k in keys], "_part", (before - F.col("_first") + 1).alias("_off"),
                            F.sum("_c").over(group).alias("_size"))
    on = [F.col(k).eqNullSafe(F.col(f"_g_{k}")) for k in keys] + [part == F.col("_part")]
    return rows.join(offsets, on).select(*[f"`{x}`" for x in df.columns], (F.col("_at") + F.col("_off")).alias("_row"), "_size")


def ntile(df: DataFrame, n: int, partition_by: Sequence[str], value: str,
          tiebreak: Sequence[str], out_col: str = "ntile") -> DataFrame:
    """NTILE(n) OVER (PARTITION BY partition_by ORDER BY value ASC, *tiebreak ASC).

    ``(partition_by, value, tiebreak)`` must identify rows uniquely for a deterministic order.
    """
    if n < 1:
        raise ValueError("n must be >= 1")
    rows = ranked(df, partition_by, value, tiebreak)
    r = F.col("_row")
    q = F.floor(F.col("_size") / n).cast("long")
    rem = (F.col("_size") % n).cast("long")
    big = rem * (q + 1)                            # rows held by the (q+1)-sized buckets
    bucket = F.when(r <= big, F.floor((r - 1) / (q + 1)) + 1).otherwise(
        rem + F.floor((r - big - 1) / q) + 1)
    return rows.select(*[f"`{x}`" for x in df.columns], bucket.cast("int").alias(out_col))
