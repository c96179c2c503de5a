"""The six awards (top-1), their chart lists (top-k) and the two time series.

Pattern: aggregate -> filter -> top-k -> *then* look up names.  The name lookups are
1:0..1 on the dimension's key, so running them after the limit joins k rows instead of the
whole aggregate.  Every ordering ends with the natural key so ties resolve deterministically.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dugout.functions.numeric import ratio
from dugout.functions.text import millions, season_label
from dugout.operators.joins import lookup
from dugout.operators.topk import top_k, top_k_inner
from dugout.params import Params
from dugout.plans.aggregates import team_payroll, team_physiques
from dugout.sources.warehouse import Warehouse

c = F.col


def _team_names(wh: Warehouse) -> DataFrame:
    return wh.teams.select("team_id", "year_id", c("name").alias("team_name"))


def _names(wh: Warehouse, alias: str) -> DataFrame:
    return wh.people.select("player_id", c("full_name").alias(alias))


# ---- J1 / J2: roster physiques -------------------------------------------------------------

def heaviest_hitters(wh: Warehouse, k: int = 1, physiques: DataFrame | None = None) -> DataFrame:
    p = physiques if physiques is not None else team_physiques(wh.batting, wh.people)
    top = top_k(p, [c("avg_weight_lbs").desc_nulls_last(), c("team_id"), c("year_id")], k)
    return (lookup(top, _team_names(wh), ["team_id", "year_id"])
            .select("team_id", "year_id", "team_name", "avg_weight_lbs", "stddev_weight_lbs",
                    "batter_appearances"))


def shortest_sluggers(wh: Warehouse, k: int = 1, physiques: DataFrame | None = None) -> DataFrame:
    p = physiques if physiques is not None else team_physiques(wh.batting, wh.people)
    top = top_k(p, [c("avg_height_in").asc_nulls_last(), c("team_id"), c("year_id")], k)
    return (lookup(top, _team_names(wh), ["team_id", "year_id"])
            .select("team_id", "year_id", "team_name", "avg_height_in", "stddev_height_in",
                    "batter_appearances"))


def heaviest_list(wh: Warehouse, k: int = 20) -> DataFrame:
    """Chart feed: top-k heaviest rosters with a 'Team (year)' label."""
    d = heaviest_hitters(wh, k)
    return d.select("team_id", "year_id", "team_name", "avg_weight_lbs",
                    season_label(c("team_name"), c("year_id"), c("team_id")).alias("label"))


def shortest_list(wh: Warehouse, k: int = 20) -> DataFrame:
    d = shortest_sluggers(wh, k)
    return d.select("team_id", "year_id", "team_name", "avg_height_in",
                    season_label(c("team_name"), c("year_id"), c("team_id")).alias("label"))


# ---- J3 / J4: payroll ------------------------------------------------------------------------

def biggest_spenders(wh: Warehouse, year: int | None = None, k: int = 1,
                     payroll: DataFrame | None = None) -> DataFrame:
    """Largest team payroll, all-time or in ``year`` (DESC puts a NULL total first, as the reference)."""
    p = payroll if payroll is not None else team_payroll(wh.salaries)
    if year is not None:
        p = p.where(c("year_id") == year)
    top = top_k(p, [c("total_payroll_usd").desc_nulls_first(), c("year_id"), c("team_id"),
                    c("lg_id")], k)
    return (lookup(top, _team_names(wh), ["team_id", "year_id"])
            .select("year_id", "team_id", "team_name", "total_payroll_usd", "roster_size",
                    "median_salary_usd", "max_salary_usd"))


def cost_per_win(wh: Warehouse, year: int, payroll: DataFrame | None = None) -> DataFrame:
    """Every team of ``year`` with wins > 0: payroll / wins.  The season filter is written once;
    Catalyst infers it for the teams side of the join."""
    p = payroll if payroll is not None else team_payroll(wh.salaries)
    t = wh.teams.select("team_id", "year_id", c("name").alias("team_name"), c("w").alias("wins"))
    return (p.where(c("year_id") == year)
            .join(t.where(c("wins") > 0), ["team_id", "year_id"])
            .select("team_id", "year_id", "lg_id", "team_name", "wins", "total_payroll_usd",
                    ratio("total_payroll_usd", "wins", 2, 20).alias("cost_per_win_usd")))


def bang_for_buck(wh: Warehouse, year: int, k: int = 1, payroll: DataFrame | None = None) -> DataFrame:
    cpw = cost_per_win(wh, year, payroll)
    return (top_k(cpw, [c("cost_per_win_usd").asc_nulls_last(), c("team_id"), c("lg_id")], k)
            .select("team_id", "year_id", "team_name", "wins", "total_payroll_usd", "cost_per_win_usd"))


def bang_for_buck_list(wh: Warehouse, year: int) -> DataFrame:
    """Chart feed: every team of the season, cheapest win first, with cost in millions."""
    cpw = cost_per_win(wh, year)
    return (cpw.select("team_id", "team_name", "wins", "total_payroll_usd",
                       c("cost_per_win_usd").alias("cost_per_win"),
                       millions(c("cost_per_win_usd")).alias("cost_per_win_m"))
            .orderBy(c("cost_per_win").asc_nulls_last(), "team_id"))


# ---- J5: priciest starter ------------------------------------------------------------------

def starter_costs(wh: Warehouse, params: Params = Params(), year: int | None = None) -> DataFrame:
    """Pitching stints with gs >= floor joined to the same player-season-team salary."""
    pi = wh.pitching.where(c("gs") >= params.gs_floor)
    s = wh.salaries.select("player_id", "year_id", "team_id", "salary")
    if year is not None:
        pi = pi.where(c("year_id") == year)
    return (pi.select("player_id", "year_id", "team_id", "stint", "gs", "innings_pitched")
            .join(s, ["player_id", "year_id", "team_id"])
            .withColumn("cost_per_start_usd", ratio("salary", "gs", 2, 20, num_scale=2)))


def priciest_starter(wh: Warehouse, params: Params = Params(), year: int | None = None,
                     k: int = 1) -> DataFrame:
    # a stint without a person row is not a candidate
    top = top_k_inner(starter_costs(wh, params, year), _names(wh, "pitcher"), "player_id",
                      [("cost_per_start_usd", False, False), ("player_id", True, True), ("year_id", True, True),
                       ("team_id", True, True), ("stint", True, True)], k)
    return (top
            .select("pitcher", "player_id", "year_id", "team_id", c("gs").alias("games_started"),
                    "innings_pitched", c("salary").alias("salary_usd"), "cost_per_start_usd"))


def starter_list(wh: Warehouse, params: Params = Params(), k: int = 15) -> DataFrame:
    d = priciest_starter(wh, params, None, k)
    return d.select("pitcher", "year_id", "team_id", c("games_started").alias("gs"),
                    c("salary_usd").alias("salary"), c("cost_per_start_usd").alias("cost_per_start"),
                    season_label(c("pitcher"), c("year_id")).alias("label"),
                    millions(c("cost_per_start_usd")).alias("cps_m"))


# ---- J6: team-list ace ---------------------------------------------------------------------

def _ace_pool(wh: Warehouse, params: Params, min_ipouts: int | None) -> DataFrame:
    floor = params.ip_floor if min_ipouts is None else min_ipouts
    if floor < 1:
        raise ValueError("min_ipouts must be >= 1")
    return wh.pitching.where(c("team_id").isin(*params.team_list) & c("era").isNotNull()
                             & (c("era") > 0) & (c("ipouts") >= floor))


def _ace_top(wh: Warehouse, params: Params, min_ipouts: int | None, k: int, tied=()) -> DataFrame:
    pool = _ace_pool(wh, params, min_ipouts).select("player_id", "team_id", "year_id", "stint", "era", "ipouts", "innings_pitched", "k_per_9", "bb_per_9")
    return top_k_inner(pool, _names(wh, "pitcher"), "player_id",
                       [("era", True, True), ("ipouts", False, False), ("player_id", True, True), ("year_id", True, True), ("stint", True, True)], k, tied)


def team_ace(wh: Warehouse, params: Params = Params(), min_ipouts: int | None = None, with_id: bool = False) -> DataFrame:
    """Lowest qualified ERA among the listed teams: RANK() by (era ASC, ipouts DESC) = 1."""
    # rank over all qualifiers, then the inner people join, then one row of rank 1
    top = _ace_top(wh, params, min_ipouts, 1, ("era", "ipouts"))
    ids = ["player_id"] if with_id else []
    return (top.withColumn("canadian_era_rank", F.lit(1))
            .select(*ids, "pitcher", c("team_id").alias("canadian_team"), c("year_id").alias("season"),
                    "innings_pitched", c("era").alias("earned_run_average"), "k_per_9", "bb_per_9",
                    "canadian_era_rank"))


def ace_list(wh: Warehouse, params: Params = Params(), k: int = 15) -> DataFrame:
    return (_ace_top(wh, params, None, k)
            .select("pitcher", "year_id", "team_id", "era", "innings_pitched",
                    F.concat(c("pitcher"), F.lit(" ("), c("team_id"), F.lit(" "),
                             c("year_id").cast("string"), F.lit(")")).alias("label")))


# ---- J9 / J10: series ----------------------------------------------------------------------

def max_payroll_by_year(wh: Warehouse, payroll: DataFrame | None = None) -> DataFrame:
    p = payroll if payroll is not None else team_payroll(wh.salaries)
    return (p.groupBy("year_id").agg(F.max("total_payroll_usd").alias("max_payroll"))
            .orderBy("year_id"))


def league_era_by_year(baseline: DataFrame) -> DataFrame:
    """Mean of the league ERA means per season, plus the grand mean of that series.

    The series has one row per season, so the grand mean's window (one partition) is bounded
    by the number of seasons, not by data volume.
    """
    by_year = baseline.groupBy("year_id").agg(
        ratio(F.sum("league_era_mean"), F.count("league_era_mean"), 6, 12, num_scale=3).alias("lg_era"))
    everything = Window.partitionBy()
    grand = ratio(F.sum("lg_era").over(everything), F.count("lg_era").over(everything), 6, 12,
                  num_scale=6)
    return by_year.withColumn("grand_mean", grand).orderBy("year_id")
