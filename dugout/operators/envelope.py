"""Award envelope: ``{award, winner{...}, metric{...}}`` as struct columns (JSON on demand)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def award_title(title: str, year: int | None) -> str:
    """The title gains ' (year)' when a season parameter was given."""
    return f"{title} ({year})" if year is not None else title


def award_envelope(df: DataFrame, title: str, winner: Sequence[str], metric: Sequence[str]) -> DataFrame:
    """One envelope row per input row; an empty input means "no winner" (the 404 case)."""
    return df.select(F.lit(title).alias("award"),
                     F.struct(*[F.col(c) for c in winner]).alias("winner"),
                     F.struct(*[F.col(c) for c in metric]).alias("metric"))


def as_json(envelope: DataFrame) -> DataFrame:
    return envelope.select(F.to_json(F.struct("award", "winner", "metric")).alias("json"))


def flatten(envelope: DataFrame) -> DataFrame:
    """award, winner_<field>..., metric_<field>... (for tabular consumers and the SQL oracle)."""
    w = envelope.schema["winner"].dataType.fieldNames()
    m = envelope.schema["metric"].dataType.fieldNames()
    return envelope.select("award", *[F.col(f"winner.{f}").alias(f"winner_{f}") for f in w],
                           *[F.col(f"metric.{f}").alias(f"metric_{f}") for f in m])


def require_winner(envelope: DataFrame):
    """The single envelope row, or ``LookupError`` when nothing matched (the HTTP 404 case).

    Fetches at most one row to the driver."""
    rows = envelope.take(1)
    if not rows:
        raise LookupError("No row matched.")
    return rows[0]
