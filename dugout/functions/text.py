"""Text helpers: chart labels, percent strings, name search, statement fingerprints."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def season_label(name: Column, year: Column, fallback: Column | None = None) -> Column:
    """``coalesce(name, fallback) || ' (' || year || ')'`` — the chart label of a team/player season."""
    base = F.coalesce(name, fallback) if fallback is not None else name
    return F.concat(base, F.lit(" ("), year.cast("string"), F.lit(")"))


def millions(col: Column) -> Column:
    """Unit scaling for charts: value / 1e6 as DOUBLE."""
    return col.cast("double") / F.lit(1e6)


def percent_text(pct: Column) -> Column:
    """numeric(., 2) rendered as '12.34%'."""
    return F.concat(pct.cast("string"), F.lit("%"))


def like_escape(s: str) -> str:
    return s.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_")


def contains_ci(col: Column, needle: str) -> Column:
    """Case-insensitive substring match (ILIKE '%needle%'), wildcards in needle escaped."""
    return col.ilike(f"%{like_escape(needle)}%")


def normalize_ws(text: Column) -> Column:
    """Whitespace-normalised statement text: regexp_replace(q, '\\s+', ' ', 'g')."""
    return F.regexp_replace(text, r"\s+", " ")


def fingerprint(text: Column, width: int = 90) -> Column:
    """Display label of a statement: LEFT(whitespace-normalised text, width)."""
    return F.left(normalize_ws(text), F.lit(width))
