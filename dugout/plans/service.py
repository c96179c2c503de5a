"""The parameterised answer surface: one envelope per award, and bounded leaderboards.

Each function returns a lazy DataFrame: envelopes have one row ``(award, winner, metric)`` or
none (no match); leaderboards validate ``limit`` in [1, 100] and return at most that many rows.
``operators.envelope.require_winner`` / ``as_json`` turn an envelope into the single answer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dugout.operators.envelope import award_envelope, award_title
from dugout.operators.topk import check_k
from dugout.params import Params
from dugout.plans import awards as J
from dugout.plans import sabermetrics as K
from dugout.sources.warehouse import Warehouse

c = F.col


def heaviest_hitters(wh: Warehouse, physiques: DataFrame | None = None) -> DataFrame:
    return award_envelope(J.heaviest_hitters(wh, physiques=physiques), "Heaviest Hitters",
                          ["team_id", "year_id", "team_name"],
                          ["avg_weight_lbs", "batter_appearances"])


def shortest_sluggers(wh: Warehouse, physiques: DataFrame | None = None) -> DataFrame:
    return award_envelope(J.shortest_sluggers(wh, physiques=physiques), "Shortest Sluggers",
                          ["team_id", "year_id", "team_name"],
                          ["avg_height_in", "batter_appearances"])


def biggest_spenders(wh: Warehouse, year: int | None = None, payroll: DataFrame | None = None) -> DataFrame:
    return award_envelope(J.biggest_spenders(wh, year=year, payroll=payroll),
                          award_title("Biggest Spenders", year),
                          ["team_id", "year_id", "team_name"], ["total_payroll_usd"])


def bang_for_buck(wh: Warehouse, year: int = Params().season, payroll: DataFrame | None = None) -> DataFrame:
    return award_envelope(J.bang_for_buck(wh, year, payroll=payroll),
                          award_title("Most Bang for the Buck", year),
                          ["team_id", "team_name", "year_id"],
                          ["wins", "total_payroll_usd", "cost_per_win_usd"])


def priciest_starter(wh: Warehouse, year: int | None = None, params: Params = Params()) -> DataFrame:
    return award_envelope(J.priciest_starter(wh, params, year=year),
                          award_title("Priciest Starter", year),
                          ["player_id", "pitcher", "team_id", "year_id"],
                          ["games_started", "salary_usd", "cost_per_start_usd"])


def team_ace(wh: Warehouse, min_ipouts: int | None = None, params: Params = Params()) -> DataFrame:
    ace = J.team_ace(wh, params, min_ipouts, with_id=True).select(
        "player_id", "pitcher", c("canadian_team").alias("team_id"), c("season").alias("year_id"),
        c("earned_run_average").alias("era"), "innings_pitched", "k_per_9", "bb_per_9")
    return award_envelope(ace, "Canadian Ace", ["player_id", "pitcher", "team_id", "year_id"],
                          ["era", "innings_pitched", "k_per_9", "bb_per_9"])


def fip_leaderboard(wh: Warehouse, limit: int = 10, params: Params = Params()) -> DataFrame:
    return K.fip_leaderboard(wh, params, check_k(limit))


def woba_leaderboard(wh: Warehouse, limit: int = 10, params: Params = Params()) -> DataFrame:
    return K.woba_leaderboard(wh, params, check_k(limit)).drop("ops")


def era_plus_leaderboard(wh: Warehouse, limit: int = 10, params: Params = Params()) -> DataFrame:
    return K.era_plus_leaderboard(wh, params, check_k(limit)).select(
        "pitcher", "year_id", "team_id", "innings_pitched", "era", "era_plus")
