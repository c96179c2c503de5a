"""Declarative column/table expectations (not_null, unique, relationships, accepted_range,
expression_is_true, unique_combination_of_columns) evaluated as failing-row counts.

All row-level expectations of one model are evaluated in a *single* conditional-aggregate pass;
grouping expectations (unique, unique combination) add one grouped aggregate each, and the
relationships of all models one count of keys for each parent key.  The result is a small DataFrame
(model, test_name, column_name, failures, status).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dugout.operators.joins import orphan_counts


@dataclass(frozen=True)
class Expect:
    kind: str                       # not_null | unique | relationships | accepted_range |
                                    # expression_is_true | unique_combination
    column: str | None = None
    columns: tuple[str, ...] = ()
    min_value: float | None = None
    max_value: float | None = None
    expression: str | None = None
    where: str | None = None
    to: str | None = None           # parent model name (relationships)
    field: str | None = None        # parent column (relationships)

    @property
    def name(self) -> str:
        if self.kind == "unique_combination":
            return f"unique_combination_of_columns({','.join(self.columns)})"
        if self.kind == "accepted_range":
            return f"accepted_range({self.min_value},{self.max_value})"
        if self.kind == "expression_is_true":
            w = f" where {self.where}" if self.where else ""
            return f"expression_is_true({self.expression}{w})"
        if self.kind == "relationships":
            return f"relationships({self.to}.{self.field})"
        return self.kind


def not_null(col): return Expect("not_null", col)
def unique(col): return Expect("unique", col)
def relationships(col, to, fld): return Expect("relationships", col, to=to, field=fld)
def accepted_range(col, lo=None, hi=None): return Expect("accepted_range", col, min_value=lo, max_value=hi)
def expression_is_true(col, expression, where=None):
    return Expect("expression_is_true", col, expression=expression, where=where)
def unique_combination(*cols): return Expect("unique_combination", columns=tuple(cols))


def _q(col: str) -> Column:
    return F.col(f"`{col}`")


def _row_failure(e: Expect) -> Column:
    """Predicate that is TRUE exactly for a failing row (NULL/FALSE otherwise)."""
    if e.kind == "not_null":
        return _q(e.column).isNull()
    if e.kind == "accepted_range":
        ok = F.lit(True)
        if e.min_value is not None:
            ok = ok & (_q(e.column) >= F.lit(e.min_value))
        if e.max_value is not None:
            ok = ok & (_q(e.column) <= F.lit(e.max_value))
        return ~ok                                   # NULL column -> NULL -> not a failure
    if e.kind == "expression_is_true":
        fail = ~F.expr(f"`{e.column}` {e.expression}")
        return (F.expr(e.where) & fail) if e.where else fail
    raise ValueError(e.kind)


ROW_LEVEL = {"not_null", "accepted_range", "expression_is_true"}


def _result(model: str, rows: DataFrame) -> DataFrame:
    return rows.select(F.lit(model).alias("model"), "test_name", "column_name", F.col("failures").cast("bigint").alias("failures"))


def _own_rows(model: str, df: DataFrame, expectations: Sequence[Expect]) -> list[DataFrame]:
    """Result rows of a model's expectations that need no other model."""
    parts: list[DataFrame] = []
    row_level = [e for e in expectations if e.kind in ROW_LEVEL]
    if row_level:
        counts = df.agg(*[F.count(F.when(_row_failure(e), F.lit(1))).alias(f"f{i}")
                          for i, e in enumerate(row_level)])
        entries = F.array(*[F.struct(F.lit(e.name).alias("test_name"), F.lit(e.column).cast("string").alias("column_name"),
                                     F.col(f"f{i}").alias("failures"))
                            for i, e in enumerate(row_level)])
        parts.append(_result(model, counts.select(F.inline(entries))))
    for e in expectations:
        if e.kind in ROW_LEVEL or e.kind == "relationships":
            continue
        if e.kind == "unique":
            bad = df.where(_q(e.column).isNotNull()).groupBy(_q(e.column)).count().where("count > 1")
        elif e.kind == "unique_combination":
            bad = df.groupBy(*[_q(x) for x in e.columns]).count().where("count > 1")
        else:
            raise ValueError(e.kind)
        col = e.column if e.column else ",".join(e.columns)
        parts.append(_result(model, bad.agg(F.count(F.lit(1)).alias("failures")).select(
            F.lit(e.name).alias("test_name"), F.lit(col).alias("column_name"), "failures")))
    return parts


def _relationship_rows(suite: dict[str, Sequence[Expect]], models: dict[str, DataFrame]) -> list[DataFrame]:
    """Result rows of all relationships expectations: one exchange for each parent key, of the distinct keys of all its
    children together (children whose keys differ in type meet the parent apart, each by its own cast)."""
    by_parent: dict[tuple, list[tuple[str, Expect]]] = {}
    for model, expectations in suite.items():
        for e in expectations:
            if e.kind == "relationships":
                kind = models[model].schema[e.column].dataType.simpleString()
                by_parent.setdefault((e.to, e.field, kind), []).append((model, e))
    parts = []
    for (to, fld, _), asked in by_parent.items():
        keys = {f"r{i}": models[model].select(_q(e.column).alias("_k")).where(F.col("_k").isNotNull())
                for i, (model, e) in enumerate(asked)}
        counts = orphan_counts(keys, models[to].select(_q(fld).alias("_k")), ["_k"])
        entries = F.array(*[F.struct(F.lit(model).alias("model"), F.lit(e.name).alias("test_name"),
                                     F.lit(e.column).alias("column_name"), F.col(f"r{i}").cast("bigint").alias("failures"))
                            for i, (model, e) in enumerate(asked)])
        parts.append(counts.select(F.inline(entries)))
    return parts


def evaluate(model_name: str, df: DataFrame, expectations: Sequence[Expect],
             models: dict[str, DataFrame] | None = None) -> DataFrame:
    return evaluate_all({**(models or {}), model_name: df}, {model_name: expectations})


def evaluate_all(models: dict[str, DataFrame], suite: dict[str, Sequence[Expect]]) -> DataFrame:
    parts = [p for name, expectations in suite.items() for p in _own_rows(name, models[name], expectations)]
    out = reduce(DataFrame.unionByName, parts + _relationship_rows(suite, models))
    return out.withColumn("status", F.when(F.col("failures") == 0, "pass").otherwise("fail"))


def gate(results: DataFrame) -> None:
    """Raise if any expectation failed (the CI gate)."""
    bad = results.where(F.col("status") == "fail").collect()       # a row per expectation
    if bad:
        raise AssertionError(f"{len(bad)} failed expectations: " + "; ".join(
            f"{r.model}.{r.column_name} {r.test_name} ({r.failures})" for r in bad))
