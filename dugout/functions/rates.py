"""Derived rate columns stored at load time (pitching, batting, people).

Each function takes column *names* and returns one Column built from a single SQL expression
(``dugout.functions.numeric.div_half_up_sql``), which keeps plan construction cheap.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dugout.functions.numeric import div_half_up_sql


def _q(name: str) -> str:
    return f"`{name}`"


def _z(name: str) -> str:
    return f"coalesce({_q(name)}, 0)"


def innings_pitched(ipouts: str = "ipouts") -> Column:
    """ipouts / 3 as numeric(12,1) — decimal thirds (33.3), not the '33.1' box-score notation."""
    return F.expr(div_half_up_sql(_q(ipouts), "3", 1, 12))


def per_nine(stat: str, ipouts: str = "ipouts") -> Column:
    """stat * 27 / ipouts as numeric(6,2); NULL unless ipouts > 0 (K/9, BB/9)."""
    return F.expr(f"CASE WHEN {_q(ipouts)} > 0 THEN "
                  f"{div_half_up_sql(f'CAST({_q(stat)} AS BIGINT) * 27', _q(ipouts), 2, 6)} END")


def plate_appearances() -> Column:
    """AB + BB + HBP + SH + SF, each NULL counted as 0."""
    return F.expr(f"CAST({_z('ab')} + {_z('bb')} + {_z('hbp')} + {_z('sh')} + {_z('sf')} AS BIGINT)")


OBP_NUM = f"({_z('h')} + {_z('bb')} + {_z('hbp')})"
OBP_DEN = f"({_z('ab')} + {_z('bb')} + {_z('hbp')} + {_z('sf')})"
SLG_NUM = (f"({_z('h')} - {_z('2b')} - {_z('3b')} - {_z('hr')} + 2 * {_z('2b')} + 3 * {_z('3b')} "
           f"+ 4 * {_z('hr')})")
SLG_DEN = "`ab`"                        # AB itself is not coalesced


def on_base_pct() -> Column:
    """(H+BB+HBP) / NULLIF(AB+BB+HBP+SF, 0) as numeric(5,3)."""
    return F.expr(div_half_up_sql(OBP_NUM, OBP_DEN, 3, 5))


def slugging_pct() -> Column:
    """Total bases / NULLIF(AB, 0) as numeric(5,3)."""
    return F.expr(div_half_up_sql(SLG_NUM, SLG_DEN, 3, 5))


def on_base_plus_slugging() -> Column:
    """COALESCE(obp,0) + COALESCE(slg,0) rounded once (never NULL).

    Summed as one exact fraction n1/d1 + n2/d2 so the single rounding sees the exact value;
    adding the two rounded columns would give e.g. 0.666 instead of 0.667.
    """
    def exact(wide: bool) -> str:
        t = "DECIMAL(38,0)" if wide else "BIGINT"
        d1, d2 = f"NULLIF(CAST({OBP_DEN} AS {t}), 0)", f"NULLIF(CAST({SLG_DEN} AS {t}), 0)"
        t1 = f"CASE WHEN {d1} IS NOT NULL THEN CAST({OBP_NUM} AS {t}) * coalesce({d2}, 1) ELSE 0 END"
        t2 = f"CASE WHEN {d2} IS NOT NULL THEN CAST({SLG_NUM} AS {t}) * coalesce({d1}, 1) ELSE 0 END"
        return div_half_up_sql(f"{t1} + {t2}", f"coalesce({d1}, 1) * coalesce({d2}, 1)", 3, 5, wide)

    # products of counts up to this size fit 64-bit integers; larger ones take 38 digits, with the same result
    fits = f"greatest({OBP_NUM}, {OBP_DEN}, {SLG_NUM}, coalesce({SLG_DEN}, 0)) < 20000000"
    return F.expr(f"CASE WHEN {fits} THEN {exact(False)} ELSE {exact(True)} END")


def full_name(first: str = "name_first", last: str = "name_last") -> Column:
    """TRIM(COALESCE(first,'') || ' ' || COALESCE(last,'')) — never NULL, may be ''."""
    return F.expr(f"trim(concat(coalesce({_q(first)}, ''), ' ', coalesce({_q(last)}, '')))")


def with_pitching_rates(pitching: DataFrame) -> DataFrame:
    return pitching.select("*", innings_pitched().alias("innings_pitched"),
                           per_nine("so").alias("k_per_9"), per_nine("bb").alias("bb_per_9"))


BATTING_INPUTS = ("ab", "h", "2b", "3b", "hr", "bb", "hbp", "sh", "sf")


def with_batting_rates(batting: DataFrame) -> DataFrame:
    missing = [k for k in BATTING_INPUTS if k not in batting.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return batting.select("*", plate_appearances().alias("pa"), on_base_pct().alias("obp"),
                          slugging_pct().alias("slg"), on_base_plus_slugging().alias("ops"))


def with_full_name(people: DataFrame) -> DataFrame:
    return people.select("*", full_name().alias("full_name"))
