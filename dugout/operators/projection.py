"""Renaming projections (staging layer)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rename_select(df: DataFrame, mapping: Iterable[tuple[str | Column, str]]) -> DataFrame:
    """Project ``(source, alias)`` pairs in order.

    A string source names an input column; a source that ``df`` lacks is an error.
    """
    pairs = list(mapping)
    missing = [src for src, _ in pairs if isinstance(src, str) and src not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df.select(*[(F.col(f"`{src}`") if isinstance(src, str) else src).alias(alias) for src, alias in pairs])
