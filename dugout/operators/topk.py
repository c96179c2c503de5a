"""Ordering operators: top-k, rank filters, bounded k parameters.

``top_k`` compiles to ``TakeOrderedAndProject`` (per-partition heaps of k rows, then one merge
of k x partitions rows), so no full sort or single-partition shuffle of the input happens.
``rank_filter`` with ``rank <= k`` is planned by Spark as a partial ``WindowGroupLimit`` before the
window's exchange, so only candidate rows travel.
``top_k_inner`` answers ORDER BY .. LIMIT k over an inner join without joining every row.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

SLACK = 40                  # rows that a slice of top_k_inner has beyond k

# (column, ascending, nulls first) of an ordering
Order = Sequence[tuple[str, bool, bool]]


def check_k(k: int, lo: int = 1, hi: int | None = 100) -> int:
    """Bind-parameter validation (``ge=lo``, ``le=hi``)."""
    if not isinstance(k, int) or k < lo or (hi is not None and k > hi):
        raise ValueError(f"k must be an integer in [{lo}, {hi}], got {k!r}")
    return k


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """ORDER BY order LIMIT k.  Append natural-key columns to ``order`` for deterministic ties."""
    check_k(k, 1, None)
    return df.orderBy(*order).limit(k)


def rank_filter(df: DataFrame, order: Sequence[Column], max_rank: int = 1,
                partition_by: Sequence[str] = (), rank_col: str = "rank") -> DataFrame:
    """Rows whose RANK() OVER (PARTITION BY .. ORDER BY order) <= max_rank; ties share a rank."""
    w = Window.partitionBy(*partition_by).orderBy(*order) if partition_by else Window.orderBy(*order)
    return (df.withColumn(rank_col, F.rank().over(w))
            .where(F.col(rank_col) <= max_rank))


def first_rank(df: DataFrame, order: Sequence[tuple[str, bool]], rank_col: str = "rank") -> DataFrame:
    """Rows with RANK() = 1 under ``order`` ((column, ascending) pairs), without a global window.

    The best key is a top-1 (per-partition heaps, one tiny merge); the tied rows are then picked
    with a left-semi join against that one-row key (null-safe), so even when a large share of the
    input ties for first no single task has to sort it.
    """
    cols = [c for c, _ in order]
    best = top_k(df.select(*cols), [F.col(c).asc() if a else F.col(c).desc() for c, a in order], 1)
    best = best.select(*[F.col(c).alias(f"_best_{c}") for c in cols])
    cond = reduce(lambda a, b: a & b, [df[c].eqNullSafe(best[f"_best_{c}"]) for c in cols])
    return df.join(best, cond, "left_semi").withColumn(rank_col, F.lit(1))


def ordering(order: Order) -> list[Column]:
    how = {(True, True): "asc_nulls_first", (True, False): "asc_nulls_last", (False, True): "desc_nulls_first", (False, False): "desc_nulls_last"}
    return [getattr(F.col(c), how[up, first])() for c, up, first in order]


def from_key_on(order: Order, key: dict) -> Column:
    """Rows that stand at ``key`` or after it in ``order``."""
    same, out = F.lit(True), F.lit(False)
    for name, up, nulls_first in order:
        col, v = F.col(name), key[name]
        if v is None:
            after = col.isNotNull() if nulls_first else F.lit(False)
        else:
            after = col > F.lit(v) if up else col < F.lit(v)
            after = F.coalesce(after, F.lit(not nulls_first))
        out = out | (same & after)
        same = same & (col.isNull() if v is None else col.eqNullSafe(F.lit(v)))
    return out | same


def top_k_inner(rows: DataFrame, dim: DataFrame, on: str, order: Order, k: int, tied: Sequence[str] = (), slack: int = SLACK) -> DataFrame:
    """ORDER BY order LIMIT k over ``rows`` INNER JOIN ``dim`` USING (on), exactly, in that order.

    The first k + ``slack`` rows are taken, and only their keys are looked up in ``dim`` (an IN filter that reaches its scan).
    Only while fewer than k of them have a match is a further, larger slice fetched: the rows from the last order
    key on, less those of that key already seen. ``order`` should end with a key of ``rows``. With ``tied``, rows count only
    while those columns equal the first row's (rank 1 of all rows, matched or not). The driver holds one slice."""
    check_k(k, 1, None)
    by, names = ordering(order), [c for c, _, _ in order]
    schema = StructType([*rows.schema.fields, *[f for f in dim.schema.fields if f.name != on]])
    n, part, skip, best, kept = k + slack, rows, 0, None, []
    while len(kept) < k:
        got = [r.asDict() for r in top_k(part, by, n + skip).collect()]
        seen, got = got[:skip], got[skip:]
        last = len(got) < n
        if tied and got:
            best = best or [got[0][c] for c in tied]
            cut = next((i for i, r in enumerate(got) if [r[c] for c in tied] != best), None)
            got, last = got[:cut], last or cut is not None
        found: dict = {}
        for d in dim.where(F.col(on).isin(list({r[on] for r in got if r[on] is not None}))).collect() if got else ():
            found.setdefault(d[on], []).append(d.asDict())
        kept += [r | d for r in got for d in found.get(r[on], ())]
        if last:
            break
        key = {c: got[-1][c] for c in names}
        skip = sum([r[c] for c in names] == list(key.values()) for r in [*seen, *got])
        part = rows.where(from_key_on(order, key))
        n *= 4
    return rows.sparkSession.createDataFrame(pa.Table.from_pylist(kept[:k], to_arrow_schema(schema)))
