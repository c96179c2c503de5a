"""Run parameters (thresholds, season, team list) shared by every plan."""

from __future__ import annotations

from dataclasses import dataclass, field, replace


@dataclass(frozen=True)
class Params:
    """Frozen bag of the knobs the queries expose.

    Defaults are the reference warehouse's values; ``Params.fixture()`` gives the values used
    with the synthetic TESTDATA-derived tables (season 2000, teams T3/T7).
    """

    ip_floor: int = 162            # ipouts >= 162 (54 innings) qualifies a pitcher
    pa_floor: int = 502            # plate appearances >= 502 qualifies a batter
    gs_floor: int = 10             # games started >= 10 qualifies a starter
    season: int = 2010             # cost-per-win target season
    team_list: tuple[str, ...] = ("TOR", "MON")   # "Canadian" franchises
    woba_scale: str = "1.20"       # wOBA scale for the batting WAR proxy
    # data-quality row-count floors, per table
    row_floors: dict = field(default_factory=lambda: {
        "people": 18000, "teams": 2800, "batting": 100000, "pitching": 47000, "salaries": 26000})

    @staticmethod
    def fixture() -> "Params":
        return Params(season=2000, team_list=("T3", "T7"))

    def with_(self, **kw) -> "Params":
        return replace(self, **kw)
