"""Exact decimal arithmetic helpers.

The reference computes in arbitrary-precision ``numeric`` and rounds half away from zero.
Spark's decimal division truncates its scale when precision runs out, so a value a hair
below a rounding tie can be pushed onto it.  ``div_half_up`` therefore rounds with integral
division on integer-valued operands: the result is the exactly rounded rational, independent
of operand magnitude (an overflow raises under ANSI mode instead of silently rounding).
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

WIDE = "decimal(38,0)"
LONG = "bigint"


def _int_type(scale: int, wide: bool) -> str:
    """Decimal type for the rounded integer before it is scaled by 10^-scale.

    Spark sizes a product as p1 + p2 + 1 digits and, above 38, cuts the *scale* (down to 6).
    Keeping the integer at 37 - scale digits makes ``int * 10^-scale`` fit exactly."""
    if not wide:
        return "DECIMAL(18,0)"
    return f"DECIMAL({37 - scale if scale else 38},0)"


def div_half_up_sql(num: str, den: str, scale: int = 0, precision: int = 18, wide: bool = False) -> str:
    """SQL-text form of :func:`div_half_up` over SQL operand expressions (one parse, no per-node
    driver round trips); identical semantics."""
    t = "DECIMAL(38,0)" if wide else "BIGINT"
    n = f"(CAST(({num}) AS {t}) * {10 ** scale})" if scale else f"CAST(({num}) AS {t})"
    d = f"NULLIF(CAST(({den}) AS {t}), 0)"
    a, b = f"(abs({n}) * 2 + abs({d}))", f"(abs({d}) * 2)"
    # `div` yields a 64-bit integer (and wraps silently for decimal operands); the wide path
    # divides exactly instead: (a - a % b) / b is an integer-valued decimal
    q = f"(({a} - {a} % {b}) / {b})" if wide else f"({a} div {b})"
    signed = f"CAST(CASE WHEN ({n} < 0) != ({d} < 0) THEN -{q} ELSE {q} END AS {_int_type(scale, wide)})"
    if scale:
        # a plain decimal literal ('0.000001'); exponent notation would parse as DOUBLE
        signed = f"({signed} * {format(Decimal(1).scaleb(-scale), 'f')})"
    return f"CAST({signed} AS DECIMAL({precision},{scale}))"


def div_half_up(num: Column, den: Column, scale: int = 0, precision: int = 18,
                wide: bool = False) -> Column:
    """``num / den`` rounded half away from zero to ``scale`` decimals, as DECIMAL(precision, scale).

    ``num`` and ``den`` must be integer-valued. NULL if either is NULL or ``den`` is 0
    (the NULLIF guard of the reference).  The default works on 64-bit integers (primitive
    arithmetic inside whole-stage codegen; an overflow raises under ANSI mode, it never wraps);
    ``wide=True`` uses 38-digit decimals for products of several sums (FIP-style constants).
    """
    t = WIDE if wide else LONG
    n = num.cast(t)
    if scale:
        n = n * (10 ** scale)
    d = F.nullif(den.cast(t), F.lit(0))
    ad = F.abs(d)
    a, b = F.abs(n) * 2 + ad, ad * 2
    # `div` yields a 64-bit integer (and wraps silently for decimal operands); the wide path
    # divides exactly instead: (a - a % b) / b is an integer-valued decimal
    q = (a - a % b) / b if wide else F.call_function("div", a, b)
    signed = F.when((n < 0) != (d < 0), -q).otherwise(q).cast(_int_type(scale, wide))
    if scale:
        signed = signed * F.lit(Decimal(1).scaleb(-scale))
    return signed.cast(f"decimal({precision},{scale})")


def scaled(col: Column, decimals: int, wide: bool = False) -> Column:
    """Exact integer units of a decimal column (e.g. dollars with 2 decimals -> cents)."""
    return (col * (10 ** decimals) if decimals else col).cast(WIDE if wide else LONG)


def ratio(num: Column | str, den: Column | str, scale: int, precision: int = 18,
          num_scale: int = 0, den_scale: int = 0, wide: bool = False) -> Column:
    """Guarded ratio ``ROUND(num::numeric / NULLIF(den, 0), scale)`` (the reference's metric shape).

    ``num_scale``/``den_scale`` declare how many decimals the operands carry so that they can be
    turned into exact integers first.  Operands given as SQL text build one expression.
    """
    if isinstance(num, str) and isinstance(den, str):
        t = WIDE if wide else LONG
        n = f"CAST(({num}) * {10 ** num_scale} AS {t})" if num_scale else f"({num})"
        d = f"CAST(({den}) * {10 ** den_scale} AS {t})" if den_scale else f"({den})"
        n = f"{n} * {10 ** den_scale}" if den_scale else n
        d = f"{d} * {10 ** num_scale}" if num_scale else d
        return F.expr(div_half_up_sql(n, d, scale, precision, wide))
    n = scaled(num, num_scale, wide)
    d = scaled(den, den_scale, wide)
    if den_scale:
        n = n * (10 ** den_scale)
    if num_scale:
        d = d * (10 ** num_scale)
    return div_half_up(n, d, scale, precision, wide)


def round_to_bigint(col: Column) -> Column:
    """numeric -> bigint as the reference casts it (rounds half away from zero, not truncation)."""
    return F.round(col, 0).cast("bigint")
