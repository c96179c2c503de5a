"""Join helpers.

No broadcast hints are hard-coded: with AQE on, a join side is broadcast only after its
shuffle stage has run and its *measured* size is under
``spark.sql.adaptive.autoBroadcastJoinThreshold``; above that the join stays sort-merge
(and skewed partitions are split).  ``lookup_after_top`` exploits 1:0..1 lookups: the limit
runs first so the dimension join sees k rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup(df: DataFrame, dim: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """USING-style join on ``keys`` (key columns appear once)."""
    return df.join(dim, list(keys), how)


def orphans(child: DataFrame, parent: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Child rows with no parent (LEFT JOIN .. WHERE parent.key IS NULL), as a left-anti join.

    Child rows whose key is NULL never match and are counted, as in the reference.
    """
    return child.join(parent.select(*keys), list(keys), "left_anti")


def orphan_counts(children: dict[str, DataFrame], parent: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: for each child table, a column of its name with its rows that have no parent.

    The keys of all children and of the parent are counted together (one row a key after the map-side combine), so there is
    one exchange whatever the number of children, and no fact rows are shuffled for it. It is an aggregate and no
    anti-join, which Catalyst would push below the union and so plan once a child. Keys with a NULL part have no parent."""
    parts = [df.select(*keys, F.lit(name).alias("_from")) for name, df in children.items()]
    parts.append(parent.select(*keys, F.lit(None).cast("string").alias("_from")).dropna(subset=list(keys)))
    counts = reduce(DataFrame.unionByName, parts).groupBy(*keys).agg(
        F.count_if(F.col("_from").isNull()).alias("_parents"), *[F.count_if(F.col("_from") == name).alias(name) for name in children])
    return counts.where("_parents = 0").agg(*[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in children])


def attach(df: DataFrame, extra: DataFrame, keys: Sequence[str]) -> DataFrame:
    """LEFT join of per-key columns onto ``df`` with NULL-safe key equality (grouping keys may be
    NULL, and a NULL group must still find its own row); the key columns appear once."""
    e = extra.select(*[extra[k].alias(f"_x_{k}") for k in keys],
                     *[extra[c] for c in extra.columns if c not in keys])
    cond = reduce(lambda a, b: a & b, [df[k].eqNullSafe(e[f"_x_{k}"]) for k in keys])
    return df.join(e, cond, "left").drop(*[f"_x_{k}" for k in keys])
