"""Running counts and exclusive-or sums within a key, for keys of any size.

Rows are range-sorted by (key, order), so a large key is dealt out over several tasks; each task runs over its own
rows, and the few keys that lie across a border get what stood before them in earlier ranges.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dugout.llm.common import shuffle_partitions, staged


def running(rows: DataFrame, key: str, order: list[Column], xor: dict[str, str], keep: list[str], name: str) -> DataFrame:
    """``key``, ``keep``, ``nth`` (1, 2, ... within the key) and for each name of ``xor`` the running exclusive-or of its
    column, all longs. Rows of equal ``order`` come in any order; ``key`` must not be null. Written to the shared folder."""
    wide = list(dict.fromkeys([key, *keep, *xor.values()]))
    sums = list(xor.items())
    out = [key, *keep, "nth", *xor, "range"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, count, sofar = TaskContext.get().partitionId(), None, 0, [0] * len(sums)
        for b in batches:
            n = b.num_rows
            if not n:
                continue
            k = b.column(key).to_numpy()
            new = np.ones(n, bool)
            new[1:] = k[1:] != k[:-1]
            first = np.flatnonzero(new)
            goes_on = last is not None and k[0] == last
            of = np.cumsum(new) - 1
            nth = np.arange(n) - first[of] + 1
            if goes_on:
                nth[of == 0] += count
            columns = []
            for i, (_, source) in enumerate(sums):
                acc = np.bitwise_xor.accumulate(b.column(source).to_numpy())
                before = np.where(first > 0, acc[first - 1], sofar[i] if goes_on else 0)
                columns.append(acc ^ before[of])
            last, count, sofar = k[-1], int(nth[-1]), [int(c[-1]) for c in columns]
            yield pa.RecordBatch.from_arrays([b.column(key), *[b.column(c) for c in keep], pa.array(nth),
                                              *[pa.array(c) for c in columns], pa.array(np.full(n, part, np.int64))], out)

    spark = rows.sparkSession
    sort = [F.col(key), *order]
    schema = ", ".join([f"{c} long" for c in out])
    local = staged(rows.repartitionByRange(shuffle_partitions(spark), *sort).sortWithinPartitions(*sort)
                   .select(*wide).mapInArrow(run, schema), name)
    # one key at most lies across each border of two ranges
    ends = local.groupBy("range").agg(F.min(key).alias("lo"), F.max(key).alias("hi"))
    across = (ends.select("range", F.explode(F.array_distinct(F.array("lo", "hi"))).alias(key)).groupBy(key)
              .agg(F.count("*").alias("m")).where("m > 1").select(key))
    earlier = Window.partitionBy(key).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    # the last row of a range holds the range's count and exclusive-or
    tops = local.join(F.broadcast(across), key).groupBy(key, "range").agg(
        F.max("nth").alias("n"), *[F.max_by(c, "nth").alias(f"all_{c}") for c in xor])
    offsets = staged(tops.select(key, "range", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("skip"),
                                 *[F.coalesce(F.bit_xor(f"all_{c}").over(earlier), F.lit(0)).alias(f"off_{c}") for c in xor]), f"{name}-across")
    # two rows for each range at most
    joined = local.join(F.broadcast(offsets), [key, "range"], "left")
    return joined.select(key, *keep, (F.col("nth") + F.coalesce("skip", F.lit(0))).alias("nth"),
                         *[F.col(c).bitwiseXOR(F.coalesce(f"off_{c}", F.lit(0))).alias(c) for c in xor])

