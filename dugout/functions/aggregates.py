"""Aggregate-expression helpers with the reference's numeric semantics."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dugout.functions.numeric import WIDE, div_half_up_sql, ratio, scaled


def _only(col: Column, cond: Column | None) -> Column:
    return col if cond is None else F.when(cond, col)


def mean_half_up(col: Column | str, decimals: int, scale: int, precision: int = 18,
                 cond: Column | str | None = None, wide: bool = False) -> Column:
    """AVG(col) [FILTER (WHERE cond)] cast to numeric(precision, scale), exactly rounded.

    ``decimals`` is the scale of ``col`` (0 for integers).  Spark's ``avg(decimal)`` rounds to
    scale+4 before any narrowing, so the mean is formed as an exact SUM / COUNT instead.
    ``col``/``cond`` may be SQL text, which builds the whole aggregate as one expression.
    """
    if isinstance(col, str) and (cond is None or isinstance(cond, str)):
        v = f"CASE WHEN {cond} THEN {col} END" if cond else col
        t = "DECIMAL(38,0)" if wide else "BIGINT"
        num = f"CAST(sum({v}) * {10 ** decimals} AS {t})" if decimals else f"sum({v})"
        den = f"count({v}) * {10 ** decimals}" if decimals else f"count({v})"
        return F.expr(div_half_up_sql(num, den, scale, precision, wide))
    col = F.expr(col) if isinstance(col, str) else col
    cond = F.expr(cond) if isinstance(cond, str) else cond
    v = _only(col, cond)
    return ratio(F.sum(v), F.count(v), scale, precision, num_scale=decimals, wide=wide)


def moments(col: Column, decimals: int, name: str, cond: Column | None = None) -> list[Column]:
    """Exact count, sum and sum of squares of a column in integer units, for ``with_stddev``."""
    u = scaled(_only(col, cond), decimals, wide=True)
    return [F.count(u).alias(f"_n_{name}"), F.sum(u).alias(f"_s_{name}"), F.sum((u * u).cast(WIDE)).alias(f"_q_{name}")]


def with_stddev(df: DataFrame, name: str, decimals: int, scale: int, precision: int = 18, population: bool = False) -> DataFrame:
    """``df`` with STDDEV_SAMP (or _POP) of the column whose ``moments`` it has, as ``name`` numeric(precision, scale).

    The root of the exact rational variance is rounded half away from zero: a double gives a candidate, and
    exact integers decide between it and its neighbours. With mean q + r/n, S = sum of (u - q)^2 and d = n - 1 (or n), a
    root of c units or more means (2c - 1)^2 d <= 4 (S - r^2/n), in units of the wanted scale. NULL for n < 2 (or 1)."""
    n, s, q2 = f"_n_{name}", f"_s_{name}", f"_q_{name}"
    shift = scale - decimals
    up, down = 10 ** max(2 * shift, 0), 10 ** max(-2 * shift, 0)
    wide = lambda x: f"CAST({x} AS {WIDE})"
    df = df.selectExpr("*", f"CASE WHEN {n} > {0 if population else 1} THEN {wide(n)} END AS _n", f"{wide(s)} AS _t")
    df = df.selectExpr("*", f"_n - {0 if population else 1} AS _d", f"{wide('_t % _n')} AS _r")
    df = df.selectExpr("*", wide("(_t - _r) / _n") + " AS _m")
    df = df.selectExpr("*", f"{wide(f'{q2} - _m * (_t + _r)')} AS _v")
    df = df.selectExpr("*", f"CAST(round(sqrt(greatest((CAST(_v AS DOUBLE) - CAST(_r AS DOUBLE) * CAST(_r AS DOUBLE) / CAST(_n AS DOUBLE))"
                            f" / CAST(_d AS DOUBLE), 0D)) * {10.0 ** shift!r}D) AS BIGINT) AS _c")
    df = df.selectExpr("*", *[f"{wide(f'4 * {up} * _v')} - {wide(f'(2 * {wide(x)} - 1) * (2 * {wide(x)} - 1) * _d * {down}')} AS _{k}"
                              for k, x in (("up", "(_c + 1)"), ("at", "_c"))])
    reaches = lambda g: f"({g} >= 4 * {up} * _n OR ({g} >= 0 AND {wide(f'{g} * _n')} >= {wide(f'4 * {up} * _r * _r')}))"
    units = f"CASE WHEN {reaches('_up')} THEN _c + 1 WHEN _c <= 0 OR {reaches('_at')} THEN _c ELSE _c - 1 END"
    one = format(Decimal(1).scaleb(-scale), "f")
    out = f"CAST(CASE WHEN _n IS NOT NULL THEN CAST(greatest({units}, 0) AS DECIMAL(18,0)) * {one} END AS DECIMAL({precision},{scale})) AS `{name}`"
    return df.selectExpr("*", out).drop(n, s, q2, "_n", "_t", "_d", "_r", "_m", "_v", "_c", "_up", "_at")


def count_if(cond: Column) -> Column:
    """COUNT(*) FILTER (WHERE cond) as BIGINT (0 when nothing matches)."""
    return F.count(F.when(cond, F.lit(1)))
