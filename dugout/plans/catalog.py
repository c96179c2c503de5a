"""Named query catalogue: every inventory operator as ``fn(spark, sf_dir) -> DataFrame``.

Each entry rebuilds the raw layer from the TESTDATA parquet (``Warehouse.from_testdata``) with
the fixture parameters, so its work grows with the input tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dugout.functions.text import contains_ci
from dugout.operators.envelope import award_envelope, award_title, flatten
from dugout.params import Params
from dugout.plans import aggregates as A
from dugout.plans import awards as J
from dugout.plans import quality as M
from dugout.plans import querylog as N
from dugout.plans import sabermetrics as K
from dugout.plans import service as V
from dugout.plans import staging as S
from dugout.plans.constants import LeagueConstants
from dugout.plans.names import indexed_search
from dugout.sources.fixtures import read
from dugout.sources.loader import key_report, row_counts
from dugout.sources.warehouse import Warehouse

P = Params.fixture()
NAME_NEEDLE = "ding cust"
INDEXED_NEEDLE = "R#00000012"
c = F.col

Query = Callable[[SparkSession, str], DataFrame]


def _wh(spark: SparkSession, sf: str) -> Warehouse:
    return Warehouse.from_testdata(spark, sf)


def _drop_stint(df: DataFrame) -> DataFrame:
    return df.drop("stint")


def _league(fn) -> Query:
    """A query over league-season constants, which are written to the shared folder first (their size is then known)."""
    return lambda s, d: fn(LeagueConstants(_wh(s, d), P))


def _stg(fn) -> Query:
    return lambda s, d: fn(_wh(s, d))


QUERIES_EXACT: dict[str, Query] = {
    # B: derived columns and staging
    "pitching_rates": lambda s, d: _wh(s, d).pitching.select(
        "player_id", "year_id", "stint", "team_id", "ipouts", "so", "bb", "innings_pitched",
        "k_per_9", "bb_per_9"),
    "batting_rates": lambda s, d: _wh(s, d).batting.select(
        "player_id", "year_id", "stint", "ab", "h", "bb", "pa", "obp", "slg", "ops"),
    "people_full_name": lambda s, d: _wh(s, d).people.select("player_id", "name_first", "name_last",
                                                              "full_name"),
    "name_search": lambda s, d: _wh(s, d).people.where(contains_ci(c("full_name"), NAME_NEEDLE))
        .select("player_id", "full_name"),
    "name_search_indexed": lambda s, d: indexed_search(_wh(s, d).people, INDEXED_NEEDLE),
    "stg_people": _stg(lambda w: S.stg_people(w.people)),
    "stg_teams": _stg(lambda w: S.stg_teams(w.teams, P)),
    "stg_batting": _stg(lambda w: S.stg_batting(w.batting)),
    "stg_pitching": _stg(lambda w: S.stg_pitching(w.pitching)),
    "stg_salaries": _stg(lambda w: S.stg_salaries(w.salaries)),
    # L1-L3 aggregates
    "team_payroll": _stg(lambda w: A.team_payroll(w.salaries)),
    "team_physiques": _stg(lambda w: A.team_physiques(w.batting, w.people)),
    "league_baseline": _stg(lambda w: A.league_pitching_baseline(w.pitching, P)),
    # J awards
    "award_heaviest": _stg(lambda w: J.heaviest_hitters(w)),
    "award_shortest": _stg(lambda w: J.shortest_sluggers(w)),
    "award_spender": _stg(lambda w: J.biggest_spenders(w)),
    "award_spender_year": _stg(lambda w: J.biggest_spenders(w, year=P.season)),
    "award_bang": _stg(lambda w: J.bang_for_buck(w, P.season)),
    "award_starter": _stg(lambda w: J.priciest_starter(w, P)),
    "award_starter_year": _stg(lambda w: J.priciest_starter(w, P, year=P.season)),
    "award_ace": _stg(lambda w: J.team_ace(w, P)),
    "award_bang_list": _stg(lambda w: J.bang_for_buck_list(w, P.season)),
    "starter_top15": _stg(lambda w: J.starter_list(w, P, 15)),
    "heaviest_top20": _stg(lambda w: J.heaviest_list(w, 20)),
    "shortest_top20": _stg(lambda w: J.shortest_list(w, 20)),
    "ace_top15": _stg(lambda w: J.ace_list(w, P, 15)),
    "payroll_max_by_year": _stg(lambda w: J.max_payroll_by_year(w)),
    "league_era_by_year": _stg(lambda w: J.league_era_by_year(A.league_pitching_baseline(w.pitching, P))),
    "award_envelope": _stg(lambda w: flatten(award_envelope(
        J.bang_for_buck(w, P.season), award_title("Most Bang for the Buck", P.season),
        ["team_id", "team_name", "year_id"], ["wins", "total_payroll_usd", "cost_per_win_usd"]))),
    # K sabermetrics
    "fip_constants": _stg(lambda w: K.fip_constants(w.pitching, P)),
    "fip": _league(lambda x: _drop_stint(x.fip())),
    "fip_top10": _league(lambda x: x.fip_leaderboard(10)),
    "woba": _stg(lambda w: _drop_stint(K.woba(w.batting, P))),
    "woba_top10": _stg(lambda w: K.woba_leaderboard(w, P, 10)),
    "era_adjusted": _league(lambda x: _drop_stint(x.era_adjusted())),
    "era_plus_top10": _league(lambda x: x.era_plus_leaderboard(10)),
    "pitching_war": _league(lambda x: _drop_stint(x.pitching_war())),
    "batting_war": _league(lambda x: _drop_stint(x.batting_war())),
    "war_top10": _league(lambda x: x.war_leaderboard(10)),
    # L4-L6 marts
    "mart_payroll": _stg(lambda w: M.mart_models(w, P)["mart_team_payroll"]),
    "mart_physiques": _stg(lambda w: M.mart_models(w, P)["mart_team_physiques"]),
    "mart_pitcher": _league(lambda x: x.mart_pitcher()),
    # M data quality
    "dq_ledger": _stg(lambda w: M.dq_ledger(w, P)),
    "dq_summary": _stg(lambda w: M.dq_summary(M.dq_ledger(w, P))),
    "expect_sources": _stg(lambda w: M.expect_sources(w)),
    "expect_staging": _stg(lambda w: M.expect_staging(w, P)),
    "expect_marts": _stg(lambda w: M.expect_marts(w, P)),
    "award_checks": _stg(lambda w: M.award_checks(w, P)),
    "structure_checks": _stg(lambda w: M.structure_checks(w, P)),
    # J7 answer surface
    "envelope_heaviest": _stg(lambda w: flatten(V.heaviest_hitters(w))),
    "envelope_shortest": _stg(lambda w: flatten(V.shortest_sluggers(w))),
    "envelope_spender": _stg(lambda w: flatten(V.biggest_spenders(w))),
    "envelope_spender_year": _stg(lambda w: flatten(V.biggest_spenders(w, year=P.season))),
    "envelope_starter": _stg(lambda w: flatten(V.priciest_starter(w, params=P))),
    "envelope_ace": _stg(lambda w: flatten(V.team_ace(w, params=P))),
    "envelope_ace_min_ipouts": _stg(lambda w: flatten(V.team_ace(w, 300, P))),
    "service_fip": _stg(lambda w: V.fip_leaderboard(w, 25, P)),
    "service_woba": _stg(lambda w: V.woba_leaderboard(w, 25, P)),
    "service_era_plus": _stg(lambda w: V.era_plus_leaderboard(w, 25, P)),
    # A / N
    "row_counts": _stg(lambda w: row_counts(w.tables())),
    "key_violations": _stg(lambda w: key_report(w.tables())),
    "querylog_stats": lambda s, d: N.statement_stats(
        read(s, d, "events").withColumn("blks_read", c("event_id") % 7), hit_col="user_id", read_col="blks_read"),
}


def as_double(df: DataFrame) -> DataFrame:
    """Present DECIMAL columns as DOUBLE (the exact rounded decimal, correctly rounded to binary).

    The library computes in exact decimals; the registered queries hand DOUBLE to consumers so that
    a comparison does not depend on how each engine's client renders decimals."""
    from pyspark.sql.types import DecimalType
    return df.select(*[F.col(f"`{f.name}`").cast("double").alias(f.name)
                       if isinstance(f.dataType, DecimalType) else F.col(f"`{f.name}`")
                       for f in df.schema.fields])


def _presented(fn: Query) -> Query:
    return lambda spark, sf_dir: as_double(fn(spark, sf_dir))


QUERIES: dict[str, Query] = {name: _presented(fn) for name, fn in QUERIES_EXACT.items()}
