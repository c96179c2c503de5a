"""Exact interpolated medians per group (PERCENTILE_CONT(0.5)) that no single task gathers.

Spark's ``percentile`` merges each group's value -> count map in one task's memory, and a sort of the
group's distinct values puts a hot group (a team-season with a third of all salaries, nearly all
distinct) into one task as well.  Here a group is cut into *value ranges* first:

1. one (group, column, range, value) histogram of all columns asked for is built with partial aggregation and
   written, so the input is read once whatever the number of columns and statistics; the range of a value
   is the value with all but its ``RANGE_BITS`` leading bits cleared, so a group has at most some thousands of
   ranges whatever its size, and ranges are in the order of their values,
2. a running count over the group's ranges (a small window) picks the one or two ranges that hold the
   middle positions,
3. only inside those ranges a running count over exact values finds the middle ones.

Counts, sums and sums of squares come from the same histogram (``histogram_moments``).
Values are exact integer units (``decimals`` places), so the midpoint is exact before the single
division back to the column's unit; the result is DOUBLE like the reference's median.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dugout.functions.numeric import LONG, WIDE, scaled
from dugout.operators.joins import attach
from dugout.sources.sinks import materialize

RANGE_BITS = 10
ROWS = "*"                          # the histogram's entry that counts all rows of a group


def value_range(col: str) -> Column:
    """The first value of the range of an integer: monotone in it, 2^RANGE_BITS ranges per doubling."""
    drop = f"greatest(length(bin(abs({col}))) - {RANGE_BITS}, 0)"
    return F.expr(f"sign({col}) * shiftleft(shiftright(abs({col}), {drop}), {drop})").cast("bigint")


def value_histogram(df: DataFrame, keys: Sequence[str], values: Mapping[str, tuple[str, int]]) -> DataFrame:
    """(keys, _col, _range, _u, _c): how often each value of each column stands in each group, NULLs left out, and
    an entry ``ROWS`` for the group's rows. ``values``: name -> (column, decimals). One pass, written."""
    entries = [F.struct(F.lit(ROWS).alias("_col"), F.lit(0).cast(LONG).alias("_u")),
               *[F.struct(F.lit(name).alias("_col"), scaled(F.col(col), decimals).alias("_u")) for name, (col, decimals) in values.items()]]
    long = (df.select(*keys, F.explode(F.array(*entries)).alias("_e")).select(*keys, "_e._col", "_e._u").where(F.col("_u").isNotNull())
            .withColumn("_range", value_range("_u")))
    return materialize(long.groupBy(*keys, "_col", "_range", "_u").agg(F.count(F.lit(1)).alias("_c")), "histogram")


def histogram_moments(hist: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    """(keys, _rows, and for each name _n_, _s_, _q_, _max_): rows, count, sum, sum of squares and largest value in units."""
    wide = lambda x: x.cast(WIDE)
    u, c = F.col("_u"), F.col("_c")
    cols = [F.coalesce(F.sum(F.when(F.col("_col") == ROWS, c)), F.lit(0)).alias("_rows")]
    for name in names:
        of = F.col("_col") == name
        cols += [F.coalesce(F.sum(F.when(of, c)), F.lit(0)).alias(f"_n_{name}"), F.sum(F.when(of, wide(u) * wide(c)).cast(WIDE)).cast(WIDE).alias(f"_s_{name}"),
                 F.sum(F.when(of, wide(wide(u) * wide(u)) * wide(c)).cast(WIDE)).cast(WIDE).alias(f"_q_{name}"), F.max(F.when(of, u)).alias(f"_max_{name}")]
    return hist.groupBy(*keys).agg(*cols)


def histogram_medians(hist: DataFrame, keys: Sequence[str], out: Mapping[str, tuple[str, int]]) -> DataFrame:
    """(keys, medians): ``out``: output column -> (histogram name, decimals). Groups without values are left out."""
    keys, names = list(keys), sorted({name for name, _ in out.values()})
    by = [*keys, "_col"]
    hist = hist.where(F.col("_col").isin(names))
    along = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = (hist.groupBy(*by, "_range").agg(F.sum("_c").alias("_c"))
              .withColumn("_before", F.coalesce(F.sum("_c").over(along), F.lit(0)))
              .withColumn("_n", F.sum("_c").over(Window.partitionBy(*by))))
    lo = F.floor((F.col("_n") - 1) / 2)            # 0-based middle positions
    hi = F.ceil((F.col("_n") - 1) / 2)
    covers = lambda p: (F.col("_before") <= p) & (p < F.col("_before") + F.col("_c"))
    held = ranges.where(covers(lo) | covers(hi)).select(
        *[F.col(k).alias(f"_h_{k}") for k in by], F.col("_range").alias("_held_range"), F.col("_before").alias("_start"), "_n")
    same = [hist[k].eqNullSafe(held[f"_h_{k}"]) for k in by] + [hist["_range"] == held["_held_range"]]
    inside = hist.join(held, same)
    order = Window.partitionBy(*by, "_range").orderBy("_u").rowsBetween(Window.unboundedPreceding, -1)
    placed = inside.withColumn("_before", F.col("_start") + F.coalesce(F.sum("_c").over(order), F.lit(0)))
    middle = placed.where(covers(lo) | covers(hi)).groupBy(*by).agg(
        ((F.max(F.when(covers(lo), F.col("_u"))) + F.max(F.when(covers(hi), F.col("_u")))).cast("double") / 2).alias("_m"))
    return middle.groupBy(*keys).agg(*[
        (F.max(F.when(F.col("_col") == name, F.col("_m"))) / F.lit(float(10 ** decimals))).alias(col) for col, (name, decimals) in out.items()])


def median_by(df: DataFrame, keys: Sequence[str], value: str, decimals: int = 0, out_col: str = "median") -> DataFrame:
    """Median of one column by group; groups without values are left out."""
    return histogram_medians(value_histogram(df, keys, {value: (value, decimals)}), keys, {out_col: (value, decimals)})


def summaries(df: DataFrame, keys: Sequence[str], values: Mapping[str, tuple[str, int]], medians: Mapping[str, str]) -> DataFrame:
    """``histogram_moments`` and medians (output column -> name) of all ``values`` from one histogram."""
    hist = value_histogram(df, keys, values)
    return attach(histogram_moments(hist, keys, list(values)),
                  histogram_medians(hist, keys, {out: (name, values[name][1]) for out, name in medians.items()}), keys)
