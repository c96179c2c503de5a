"""Staging models: renamed, lightly derived views over the raw layer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dugout.functions.numeric import div_half_up
from dugout.operators.projection import rename_select
from dugout.params import Params


def stg_people(people: DataFrame) -> DataFrame:
    return rename_select(people, [
        ("player_id", "player_id"), ("full_name", "full_name"), ("name_first", "name_first"),
        ("name_last", "name_last"), ("name_given", "name_given"), ("weight", "weight_lbs"),
        ("height", "height_in"), ("bats", "bats"), ("throws", "throws"), ("debut", "debut_date"),
        ("final_game", "final_game_date"), ("birth_year", "birth_year"),
        ("birth_country", "birth_country"),
        (F.col("death_year").isNotNull(), "is_deceased"),
    ])


def stg_teams(teams: DataFrame, params: Params = Params()) -> DataFrame:
    is_listed = F.coalesce(F.col("team_id").isin(*params.team_list), F.lit(False))
    return rename_select(teams, [
        ("year_id", "year_id"), ("team_id", "team_id"), ("lg_id", "lg_id"),
        ("franch_id", "franch_id"), ("div_id", "div_id"), ("name", "team_name"),
        ("park", "park_name"), ("g", "games"), ("w", "wins"), ("l", "losses"),
        (div_half_up(F.col("w"), F.col("g"), 3, 6), "win_pct"),
        ("r", "runs_scored"), ("ra", "runs_allowed"), ("era", "team_era"),
        ("attendance", "attendance"), (is_listed, "is_canadian"),
    ])


def stg_batting(batting: DataFrame) -> DataFrame:
    return rename_select(batting, [
        ("player_id", "player_id"), ("year_id", "year_id"), ("stint", "stint"),
        ("team_id", "team_id"), ("lg_id", "lg_id"), ("g", "games"), ("ab", "at_bats"),
        ("r", "runs"), ("h", "hits"), ("2b", "doubles"), ("3b", "triples"), ("hr", "home_runs"),
        ("rbi", "rbi"), ("sb", "stolen_bases"), ("cs", "caught_stealing"), ("bb", "walks"),
        ("so", "strikeouts"), ("ibb", "intentional_walks"), ("hbp", "hit_by_pitch"),
        ("sh", "sac_hits"), ("sf", "sac_flies"), ("gidp", "gidp"),
        ("pa", "pa"), ("obp", "obp"), ("slg", "slg"), ("ops", "ops"),
    ])


def stg_pitching(pitching: DataFrame) -> DataFrame:
    return rename_select(pitching, [
        ("player_id", "player_id"), ("year_id", "year_id"), ("stint", "stint"),
        ("team_id", "team_id"), ("lg_id", "lg_id"), ("w", "wins"), ("l", "losses"),
        ("g", "games"), ("gs", "games_started"), ("cg", "complete_games"), ("sho", "shutouts"),
        ("sv", "saves"), ("ipouts", "ipouts"), ("innings_pitched", "innings_pitched"),
        ("h", "hits_allowed"), ("er", "earned_runs"), ("hr", "home_runs_allowed"),
        ("bb", "walks"), ("so", "strikeouts"), ("baopp", "opponent_batting_avg"), ("era", "era"),
        ("k_per_9", "k_per_9"), ("bb_per_9", "bb_per_9"), ("hbp", "hit_batters"),
    ])


def stg_salaries(salaries: DataFrame) -> DataFrame:
    return rename_select(salaries, [
        ("year_id", "year_id"), ("team_id", "team_id"), ("lg_id", "lg_id"),
        ("player_id", "player_id"), ("salary", "salary_usd"),
    ])
