"""League-season constants as written tables.

The metrics compare each player-season with constants of its league-season (FIP sums, mean FIP, mean wOBA, ERA
baseline, mart league values).  Each is a grouped aggregate of a few rows per season.  Written first and read
back, its size is known from its files, so Spark broadcasts it when it is below the broadcast threshold
and the player-seasons stay where they are; computed inside the same plan its size is unknown and the
player-seasons would be shuffled on few, skewed (year, league) keys.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame

from dugout.params import Params
from dugout.plans import aggregates as A
from dugout.plans import marts
from dugout.plans import sabermetrics as K
from dugout.plans import staging as S
from dugout.sources.sinks import materialize
from dugout.sources.warehouse import Warehouse


class LeagueConstants:
    """The constants of one warehouse and parameter set, each written when it is first asked for.

    ``keep(df, name)`` writes a table and returns it as read back: a run folder by default, a
    published version in the jobs."""

    def __init__(self, wh: Warehouse, params: Params = Params(), keep: Callable[[DataFrame, str], DataFrame] = materialize):
        self.wh, self.params, self._keep = wh, params, keep

    @cached_property
    def fip_sums(self) -> DataFrame:
        return self._keep(K.fip_league_sums(self.wh.pitching, self.params), "league_fip_sums")

    @cached_property
    def fip_mean(self) -> DataFrame:
        return self._keep(K.league_fip(K.fip(self.wh.pitching, self.params, self.fip_sums)), "league_fip_mean")

    @cached_property
    def woba_mean(self) -> DataFrame:
        return self._keep(K.league_woba(K.woba(self.wh.batting, self.params)), "league_woba_mean")

    @cached_property
    def baseline(self) -> DataFrame:
        return self._keep(A.league_pitching_baseline(self.wh.pitching, self.params), "league_baseline")

    @cached_property
    def mart_league(self) -> DataFrame:
        return self._keep(marts.pitcher_league(S.stg_pitching(self.wh.pitching), self.params), "mart_league")

    # the metrics over these constants
    def fip(self) -> DataFrame:
        return K.fip(self.wh.pitching, self.params, self.fip_sums)

    def fip_leaderboard(self, k: int = 10) -> DataFrame:
        return K.fip_leaderboard(self.wh, self.params, k, self.fip_sums)

    def era_adjusted(self) -> DataFrame:
        return K.era_adjusted(self.wh.pitching, self.params, self.baseline)

    def era_plus_leaderboard(self, k: int = 10) -> DataFrame:
        return K.era_plus_leaderboard(self.wh, self.params, k, self.baseline)

    def pitching_war(self) -> DataFrame:
        return K.pitching_war(self.wh.pitching, self.params, self.fip_sums, self.fip_mean)

    def batting_war(self) -> DataFrame:
        return K.batting_war(self.wh.batting, self.params, self.woba_mean)

    def war_leaderboard(self, k: int = 10) -> DataFrame:
        return K.war_leaderboard(self.wh, self.params, k, self.fip_sums, self.fip_mean, self.woba_mean)

    def mart_pitcher(self) -> DataFrame:
        return marts.mart_pitcher_advanced(S.stg_pitching(self.wh.pitching), S.stg_people(self.wh.people), self.params, self.mart_league)
