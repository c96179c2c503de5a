"""The raw layer: five typed tables with their stored derived columns.

Tables are built lazily on first access, so a query only pays for the tables it reads
(plan construction is not free: every DataFrame step is analysed on the driver).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dugout.functions.rates import with_batting_rates, with_full_name, with_pitching_rates

TABLE_NAMES = ("people", "teams", "batting", "pitching", "salaries")
_DERIVE = {"people": with_full_name, "batting": with_batting_rates, "pitching": with_pitching_rates}


class Warehouse:
    def __init__(self, tables: dict[str, DataFrame | Callable[[], DataFrame]]):
        self._src = dict(tables)
        self._built: dict[str, DataFrame] = {}

    def _get(self, name: str) -> DataFrame:
        if name not in self._built:
            src = self._src[name]
            self._built[name] = src() if callable(src) else src
        return self._built[name]

    people = property(lambda self: self._get("people"))
    teams = property(lambda self: self._get("teams"))
    batting = property(lambda self: self._get("batting"))
    pitching = property(lambda self: self._get("pitching"))
    salaries = property(lambda self: self._get("salaries"))

    @staticmethod
    def derive(raw: dict[str, DataFrame | Callable[[], DataFrame]]) -> "Warehouse":
        """Add the load-time generated columns (IP, K/9, BB/9, PA, OBP, SLG, OPS, full_name)."""
        def lazy(name):
            src = raw[name]
            get = src if callable(src) else (lambda: src)
            fn = _DERIVE.get(name)
            return (lambda: fn(get())) if fn else get
        return Warehouse({n: lazy(n) for n in TABLE_NAMES})

    @staticmethod
    def from_testdata(spark: SparkSession, sf_dir: str) -> "Warehouse":
        from dugout.sources.fixtures import raw_tables
        return Warehouse.derive(raw_tables(spark, sf_dir))

    @staticmethod
    def from_parquet(spark: SparkSession, root: str, tables: dict[str, str] | None = None) -> "Warehouse":
        """Tables written by ``dugout.sources.loader.load_all`` (derived columns already stored), all of one load: the
        current one, or that of ``tables``, a set read before."""
        from dugout.sources.sinks import read_layer, read_set
        current = read_set(spark, root, "raw") if tables is None else tables
        return Warehouse({t: (lambda t=t: read_layer(spark, root, "raw", t, current)) for t in TABLE_NAMES})

    @staticmethod
    def from_bucketed(spark: SparkSession, root: str, buckets: int) -> "Warehouse":
        """Tables written by ``fixtures.persist_raw(..., buckets=n)``: player-keyed tables bucketed
        on ``player_id`` (shuffle-free player joins), teams as plain Parquet."""
        from dugout.sources.sinks import read_bucketed, read_layer, read_set
        current = read_set(spark, root, "raw")

        def src(t):
            if t == "teams":
                return lambda: read_layer(spark, root, "raw", t, current)
            return lambda: read_bucketed(spark, root, "raw", t, buckets, tables=current)
        return Warehouse({t: src(t) for t in TABLE_NAMES})

    def of_seasons(self, seasons: list[int]) -> "Warehouse":
        """The same warehouse with the facts of some seasons only (whole folders of a written one)."""
        of = lambda t: (lambda: self._get(t).where(F.col("year_id").isin(seasons)))
        return Warehouse({t: of(t) if t in ("batting", "pitching", "salaries") else (lambda t=t: self._get(t)) for t in TABLE_NAMES})

    def tables(self) -> dict[str, DataFrame]:
        return {n: self._get(n) for n in TABLE_NAMES}
