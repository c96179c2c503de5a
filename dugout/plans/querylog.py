"""Statement-statistics rollup over a raw execution log.

The reference reads pre-aggregated server counters; here the counters are *computed* from log
rows (statement text, execution ms) with one grouped aggregate — partial sums map-side, so a
statement that accounts for a third of the log is combined before the shuffle.
Block-cache counters are summed from the log's own columns, where it has them.
Counters are per whole normalised statement; the 90-character cut is only the display label.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dugout.functions.aggregates import mean_half_up, moments, with_stddev
from dugout.functions.numeric import ratio
from dugout.functions.text import normalize_ws
from dugout.operators.topk import top_k

c = F.col
MS_SCALE = 9


def statement_stats(log: DataFrame, text_col: str = "event_type", ms_col: str = "value",
                    exclude: str | None = "%pg_stat_statements%", k: int = 15,
                    width: int = 90, hit_col: str | None = None, read_col: str | None = None) -> DataFrame:
    """Per normalised statement: calls, mean / population-stddev ms, total seconds, block hits and
    reads and their hit share (null without those columns); slowest mean first, top k.

    ``ms`` is summed exactly at 9 decimals (picoseconds) and rounded after aggregating."""
    df = log
    if exclude:
        df = df.where(~c(text_col).ilike(exclude))
    ms = c(ms_col).cast(f"decimal(28,{MS_SCALE})")
    blocks = [(c(x) if x else F.lit(None)).cast("bigint").alias(n) for x, n in ((hit_col, "_hit"), (read_col, "_read"))]
    # counters are kept per whole (normalised) statement; only the label is cut to `width`
    stats = (df.select(normalize_ws(c(text_col)).alias("_stmt"), ms.alias("ms"), *blocks)
             .groupBy("_stmt")
             .agg(F.count(F.lit(1)).alias("calls"),
                  mean_half_up(c("ms"), MS_SCALE, 2, 18, wide=True).alias("mean_ms"),
                  *moments(c("ms"), MS_SCALE, "stddev_ms"),
                  ratio(F.sum("ms"), F.lit(1000), 2, 18, num_scale=MS_SCALE, wide=True).alias("total_s"),
                  F.sum("_hit").alias("blk_hit"), F.sum("_read").alias("blk_read"),
                  # ranking uses the unrounded mean, a double as in the counters
                  (F.sum("ms").cast("double") / F.count("ms")).alias("_mean"))
             .withColumn("cache_hit_pct", ratio(c("blk_hit") * 100, c("blk_hit") + c("blk_read"), 1, 6, wide=True)))
    stats = with_stddev(stats, "stddev_ms", MS_SCALE, 2, 18, population=True)
    top = top_k(stats, [c("_mean").desc_nulls_last(), c("_stmt")], k)
    return top.select(F.left(c("_stmt"), F.lit(width)).alias("query"), "calls", "mean_ms", "stddev_ms",
                      "total_s", "blk_hit", "blk_read", "cache_hit_pct")
