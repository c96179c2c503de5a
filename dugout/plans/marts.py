"""Curated marts built from the staging models."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dugout.functions.aggregates import mean_half_up, moments, with_stddev
from dugout.functions.numeric import div_half_up_sql, ratio
from dugout.params import Params
from dugout.plans.aggregates import team_payroll, team_physiques

c = F.col


def mart_team_payroll(stg_salaries: DataFrame, stg_teams: DataFrame) -> DataFrame:
    """Payroll per (year, team, league) with the team record and efficiency ratios.

    Pre-aggregated first, then LEFT-joined to the record (one row per team-season)."""
    payroll = team_payroll(stg_salaries, salary_col="salary_usd", with_max=False)
    record = stg_teams.select("year_id", "team_id", "team_name", "wins", "losses", "win_pct")
    return (payroll.join(record, ["year_id", "team_id"], "left")
            .select("year_id", "team_id", "lg_id", "team_name", "roster_size", "total_payroll_usd",
                    "avg_salary_usd", "median_salary_usd", "wins", "losses", "win_pct",
                    ratio("total_payroll_usd", "wins", 2, 20).alias("cost_per_win_usd"),
                    ratio("total_payroll_usd", "wins + losses", 2, 20).alias("cost_per_game_usd")))


def mart_team_physiques(stg_batting: DataFrame, stg_people: DataFrame) -> DataFrame:
    return team_physiques(stg_batting, stg_people, weight="weight_lbs", height="height_in",
                          with_median=True)


def _pitcher_base(stg_pitching: DataFrame, params: Params) -> DataFrame:
    """Qualified rows with the FIP numerator, innings in tenths and their ratio (12 decimals), each computed once."""
    base = stg_pitching.where((c("ipouts") >= params.ip_floor) & c("era").isNotNull() & (c("era") > 0))
    raw = "CAST(13 * home_runs_allowed + 3 * (walks + hit_batters) - 2 * strikeouts AS BIGINT)"
    base = base.select("*", F.expr(raw).alias("_raw"), F.expr("CAST(innings_pitched * 10 AS BIGINT)").alias("_ip10"))
    return base.select("*", F.expr(div_half_up_sql("_raw * 10", "_ip10", 12, 30, wide=True)).alias("_per_ip"))


def pitcher_league(stg_pitching: DataFrame, params: Params = Params()) -> DataFrame:
    """(year_id, lg_id, league_era, league_era_stddev, lg_raw_fip): the mart's league values.

    The per-pitcher ratios are averaged at 12 decimals; each is off by at most 5e-13, and so is their
    mean, which is rounded to 3: it can differ from the mean of unrounded ratios only where
    that lies within 5e-13 of a rounding tie."""
    out = (_pitcher_base(stg_pitching, params).groupBy("year_id", "lg_id")
            .agg(mean_half_up("era", 2, 3, 6, wide=True).alias("league_era"),
                 *moments(c("era"), 2, "league_era_stddev"),
                 mean_half_up("_per_ip", 12, 3, 6, wide=True).alias("lg_raw_fip")))
    return with_stddev(out, "league_era_stddev", 2, 3, 6).select("year_id", "lg_id", "league_era", "league_era_stddev", "lg_raw_fip")


def mart_pitcher_advanced(stg_pitching: DataFrame, stg_people: DataFrame, params: Params = Params(),
                          league: DataFrame | None = None) -> DataFrame:
    """Qualified pitchers with FIP, ERA z-score, ERA+, K/9, BB/9 and their league ERA stats.

    This FIP differs from ``sabermetrics.fip`` on purpose: its constant uses the *mean of
    per-pitcher ratios* over 1-decimal innings (each ratio kept to 12 decimals), the inputs are
    rounded numeric(6,3) league values, HBP is not coalesced, and the base excludes era = 0.
    """
    base = _pitcher_base(stg_pitching, params)
    league = (pitcher_league(stg_pitching, params) if league is None else league).select(
        "*", F.expr("CAST(league_era * 1000 AS BIGINT) - CAST(lg_raw_fip * 1000 AS BIGINT)").alias("_c_milli"))
    names = stg_people.select("player_id", c("full_name").alias("pitcher"))
    j = base.join(league, ["year_id", "lg_id"]).join(names, "player_id")
    e, m, s = "CAST(era * 100 AS BIGINT)", "CAST(league_era * 1000 AS BIGINT)", \
        "CAST(league_era_stddev * 1000 AS BIGINT)"
    # fip = 10*raw/ip10 + c_milli/1000 = (10000*raw + ip10*c_milli) / (1000*ip10)
    fip = div_half_up_sql("_raw * 10000 + _ip10 * _c_milli", "_ip10 * 1000", 2, 8)
    return j.select("player_id", "year_id", "team_id", "lg_id", "pitcher", "games_started",
                    "innings_pitched", "era", F.expr(fip).alias("fip"),
                    F.expr(div_half_up_sql(f"{e} * 10 - {m}", s, 3, 10)).alias("era_z_score"),
                    F.expr(f"CAST({div_half_up_sql(f'{m} * 10', e, 0, 10)} AS INT)").alias("era_plus"),
                    "k_per_9", "bb_per_9", "league_era", "league_era_stddev")
