"""Data-quality ledger (18 checks, PASS/WARN/FAIL), summary, FAIL gate, expectation suites and
the award invariants.

The reference scans each table once per check; here each table is read in one conditional
aggregate pass (people: 6 measures, pitching: 3, salaries: 3, batting/teams: 1), plus one
count of keys a parent for orphans and one grouped aggregate for stint density.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dugout.functions.aggregates import count_if
from dugout.functions.numeric import div_half_up
from dugout.functions.text import percent_text
from dugout.operators import expectations as X
from dugout.operators.joins import orphan_counts, orphans
from dugout.params import Params
from dugout.sources.sinks import materialize
from dugout.sources.warehouse import Warehouse

c = F.col
LEDGER_COLS = ["category", "check_name", "status", "observed", "expected", "note"]


def _q(v: str | None) -> str:
    return "CAST(NULL AS STRING)" if v is None else "'" + v.replace("'", "''") + "'"


def _ledger_rows(agg: DataFrame, rows: list[tuple[str, str, str, str, str, str | None]]) -> DataFrame:
    """Unpivot one aggregate row into ledger rows with a single ``stack`` expression.

    Each row is (category, check_name, status SQL, observed SQL, expected, note); the measures it
    refers to are columns of ``agg``.  One SQL expression keeps plan construction cheap."""
    body = ", ".join(f"{_q(cat)}, {_q(chk)}, {status}, CAST({obs} AS STRING), {_q(exp)}, {_q(note)}"
                     for cat, chk, status, obs, exp, note in rows)
    return agg.selectExpr(f"stack({len(rows)}, {body}) AS ({', '.join(LEDGER_COLS)})")


def _pf(cond: str, bad: str = "FAIL") -> str:
    return f"CASE WHEN {cond} THEN 'PASS' ELSE '{bad}' END"


def _band(nulls: str, warn_below: int | None) -> str:
    # the unrounded ratio is compared: 100 * nulls / rows < pct  <=>  100 * nulls < pct * rows
    if warn_below is None:
        return f"CASE WHEN {nulls} * 100 < c * 10 THEN 'PASS' ELSE 'WARN' END"
    return (f"CASE WHEN {nulls} * 100 < c * 5 THEN 'PASS' WHEN {nulls} * 100 < c * {warn_below} "
            f"THEN 'WARN' ELSE 'FAIL' END")


def _pct(nulls: str) -> Column:
    """'12.34%': 100 * nulls / rows rounded to 2 decimals (NULL on an empty table) — display only."""
    return percent_text(div_half_up(c(nulls) * 100, c("c"), 2, 12)).alias(f"{nulls}_pct")


def dq_ledger(wh: Warehouse, params: Params = Params()) -> DataFrame:
    fl = params.row_floors
    n_all = F.count(F.lit(1))
    people = (wh.people.agg(
        n_all.alias("c"), F.count_distinct("player_id").alias("nd"),
        count_if(c("weight").isNull()).alias("nw"), count_if(c("height").isNull()).alias("nh"),
        count_if(~c("weight").between(100, 400)).alias("wr"),
        count_if(~c("height").between(50, 90)).alias("hr"))
        .select("*", _pct("nw"), _pct("nh")))
    pitching = (wh.pitching.agg(n_all.alias("c"), count_if(c("era").isNull()).alias("ne"),
                                count_if(c("gs") < 0).alias("gs"))
                .select("*", _pct("ne")))
    salaries = wh.salaries.agg(n_all.alias("c"), count_if(c("salary").isNull()).alias("sn"),
                               count_if(c("salary") <= 0).alias("sl"))

    # The ledger's check names, expected texts, notes and status bands are the
    # reference ledger's output text and thresholds (row floors come from Params).
    def rowcount(t: str, note: str | None):
        return ("rowcount", t, _pf(f"c > {fl[t]}"), "c", f"> {fl[t]}", note)

    parts = [
        _ledger_rows(people, [
            rowcount("people", "Lahman 2023 carries ~20k people"),
            ("uniqueness", "people.player_id", _pf("nd = c"), "concat(nd, ' / ', c)", "equal", None),
            ("nullratio", "people.weight", _band("nw", 25), "nw_pct", "< 5%", "Pre-1900 records often missing"),
            ("nullratio", "people.height", _band("nh", 25), "nh_pct", "< 5%", None),
            ("range", "people.weight ∈ [100, 400]", _pf("wr = 0", "WARN"), "wr", "0", None),
            ("range", "people.height ∈ [50, 90]", _pf("hr = 0", "WARN"), "hr", "0", None),
        ]),
        _ledger_rows(wh.teams.agg(n_all.alias("c")), [rowcount("teams", "One row per team-year since 1871")]),
        _ledger_rows(pitching, [
            rowcount("pitching", None),
            ("nullratio", "pitching.era", _band("ne", None), "ne_pct", "< 10%", "NULL when no batters faced"),
            ("range", "pitching.gs >= 0", _pf("gs = 0"), "gs", "0", None),
        ]),
        _ledger_rows(salaries, [
            rowcount("salaries", "Salaries only from 1985 onward"),
            ("nullratio", "salaries.salary", _pf("sn = 0"), "sn", "0", "Salaries must be present"),
            ("range", "salaries.salary > 0", _pf("sl = 0"), "sl", "0", None),
        ]),
    ]
    people_keys = orphan_counts({"batting": wh.batting, "pitching": wh.pitching}, wh.people, ["player_id"])
    team_keys = orphan_counts({"salaries": wh.salaries}, wh.teams, ["team_id", "year_id"])
    parts.append(_ledger_rows(people_keys, [
        ("refintegrity", f"{t}.player_id → people", _pf(f"{t} = 0"), t, "0", None) for t in ("batting", "pitching")]))
    parts.append(_ledger_rows(team_keys, [
        ("refintegrity", "salaries.(team_id,year_id) → teams",
         "CASE WHEN salaries = 0 THEN 'PASS' WHEN salaries < 50 THEN 'WARN' ELSE 'FAIL' END", "salaries", "0",
         "Some lg_id mismatches are historical (e.g., 1994 strike year)")]))
    # one grouped pass over batting gives its row count and its stint gaps
    stints = wh.batting.groupBy("player_id", "year_id").agg(F.max("stint").alias("max_s"), n_all.alias("n"))
    parts.append(_ledger_rows(stints.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("c"), count_if(c("max_s") != c("n")).alias("n")), [
        rowcount("batting", None),
        ("logic", "batting stint sequencing", _pf("n = 0", "WARN"), "n", "0",
         "Stints should be dense 1..N per player-year")]))
    ledger = parts[0]
    for p in parts[1:]:
        ledger = ledger.unionByName(p)
    severity = F.when(c("status") == "FAIL", 0).when(c("status") == "WARN", 1).otherwise(2)
    return ledger.orderBy(severity, "category", "check_name")


def dq_summary(ledger: DataFrame) -> DataFrame:
    return ledger.groupBy("status").agg(F.count(F.lit(1)).alias("checks")).orderBy("status")


def dq_gate(ledger: DataFrame) -> None:
    """Raise when any check FAILs (collects at most the 18 ledger rows' FAIL subset)."""
    n = ledger.where(c("status") == "FAIL").count()
    if n > 0:
        raise AssertionError(f"Data-quality FAILures: {n}")


# ---- declarative expectation suites ---------------------------------------------------------

SOURCE_SUITE = {
    "people": [X.not_null("player_id"), X.unique("player_id")],
    "teams": [X.not_null("team_id"), X.not_null("year_id"), X.not_null("w"),
              X.accepted_range("w", 0, 162)],
    "batting": [X.not_null("player_id"), X.relationships("player_id", "people", "player_id"),
                X.not_null("year_id"), X.not_null("team_id")],
    "pitching": [X.not_null("player_id"), X.relationships("player_id", "people", "player_id")],
    "salaries": [X.not_null("salary"), X.expression_is_true("salary", "> 0")],
}

STAGING_SUITE = {
    "stg_people": [X.not_null("player_id"), X.unique("player_id"), X.not_null("full_name")],
    "stg_teams": [X.not_null("team_id"), X.not_null("year_id"), X.accepted_range("win_pct", 0, 1)],
    "stg_batting": [X.not_null("player_id"), X.relationships("player_id", "stg_people", "player_id")],
    "stg_pitching": [X.not_null("player_id"), X.relationships("player_id", "stg_people", "player_id"),
                     X.expression_is_true("era", ">= 0", where="era IS NOT NULL")],
    "stg_salaries": [X.not_null("salary_usd"), X.expression_is_true("salary_usd", "> 0")],
}

MART_SUITE = {
    "mart_team_payroll": [X.not_null("year_id"), X.not_null("team_id"),
                          X.not_null("total_payroll_usd"),
                          X.expression_is_true("total_payroll_usd", "> 0"),
                          X.expression_is_true("cost_per_win_usd", ">= 0",
                                               where="cost_per_win_usd IS NOT NULL"),
                          X.unique_combination("year_id", "team_id")],
    "mart_pitcher_advanced": [X.not_null("player_id"), X.not_null("era"),
                              X.accepted_range("fip", 0, 15), X.accepted_range("era_plus", 0, 500),
                              X.unique_combination("player_id", "year_id", "team_id")],
    "mart_team_physiques": [X.accepted_range("avg_weight_lbs", 150, 280),
                            X.accepted_range("avg_height_in", 60, 80),
                            X.unique_combination("team_id", "year_id")],
}


class LazyModels(dict):
    """name -> DataFrame mapping whose values are built on first lookup (plans are not free)."""

    def __init__(self, builders):
        super().__init__()
        self._builders = builders

    def __missing__(self, key):
        self[key] = self._builders[key]()
        return self[key]

    def keys(self):  # noqa: D401 - all model names, built or not
        return self._builders.keys()


def staging_models(wh: Warehouse, params: Params = Params()) -> LazyModels:
    from dugout.plans import staging as S
    return LazyModels({"stg_people": lambda: S.stg_people(wh.people),
                       "stg_teams": lambda: S.stg_teams(wh.teams, params),
                       "stg_batting": lambda: S.stg_batting(wh.batting),
                       "stg_pitching": lambda: S.stg_pitching(wh.pitching),
                       "stg_salaries": lambda: S.stg_salaries(wh.salaries)})


def mart_models(wh: Warehouse, params: Params = Params(), league: DataFrame | None = None) -> LazyModels:
    from dugout.plans import marts as M
    st = staging_models(wh, params)
    return LazyModels({
        "mart_team_payroll": lambda: M.mart_team_payroll(st["stg_salaries"], st["stg_teams"]),
        "mart_pitcher_advanced": lambda: M.mart_pitcher_advanced(st["stg_pitching"], st["stg_people"], params, league),
        "mart_team_physiques": lambda: M.mart_team_physiques(st["stg_batting"], st["stg_people"])})


def expect_sources(wh: Warehouse) -> DataFrame:
    return X.evaluate_all(wh.tables(), SOURCE_SUITE)


def expect_staging(wh: Warehouse, params: Params = Params()) -> DataFrame:
    return X.evaluate_all(staging_models(wh, params), STAGING_SUITE)


def expect_written_marts(models: dict[str, DataFrame]) -> DataFrame:
    """The mart expectations on marts that are already written."""
    return X.evaluate_all(models, MART_SUITE)


def expect_marts(wh: Warehouse, params: Params = Params()) -> DataFrame:
    """The mart expectations; each mart is written once and all its checks read that."""
    models = mart_models(wh, params)
    return expect_written_marts({name: materialize(models[name], name) for name in models.keys()})


# ---- award invariants (the imperative assertions, as expectation rows) -----------------------

def _assertions(df: DataFrame, checks: list[tuple[str, Column]]) -> DataFrame:
    """One (check_name, passed) row per check over a 0/1-row DataFrame; a missing row or a NULL
    condition counts as failed (``IF cond THEN ok ELSE raise``)."""
    agg = df.agg(*[F.coalesce(F.bool_and(F.coalesce(cond, F.lit(False))), F.lit(False)).alias(f"c{i}")
                   for i, (_, cond) in enumerate(checks)])
    return agg.select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("check_name"), F.col(f"c{i}").alias("passed"))
        for i, (name, _) in enumerate(checks)])))


def award_checks(wh: Warehouse, params: Params = Params(), years: tuple[int, int] = (1871, 2030)) -> DataFrame:
    """The 23 winner/structure assertions; ``passed`` is false wherever an invariant fails."""
    from dugout.operators.topk import top_k
    from dugout.plans import aggregates as A
    from dugout.plans import awards as J
    from dugout.plans import sabermetrics as K
    phys = A.team_physiques(wh.batting, wh.people)
    pay = A.team_payroll(wh.salaries)
    heavy = top_k(phys, [c("avg_weight_lbs").desc_nulls_last(), c("team_id"), c("year_id")], 1)
    short = top_k(phys, [c("avg_height_in").asc_nulls_last(), c("team_id"), c("year_id")], 1)
    spend = top_k(pay, [c("total_payroll_usd").desc_nulls_first(), c("year_id"), c("team_id")], 1)
    bang = top_k(J.cost_per_win(wh, params.season, pay),
                 [c("cost_per_win_usd").asc_nulls_last(), c("team_id"), c("lg_id")], 1)
    start = top_k(J.starter_costs(wh, params),
                  [c("cost_per_start_usd").desc_nulls_last(), c("player_id"), c("year_id"), c("stint")], 1)
    ace = top_k(J._ace_pool(wh, params, None),
                [c("era").asc(), c("ipouts").desc(), c("player_id"), c("year_id"), c("stint")], 1)
    parts = [
        _assertions(heavy, [("heaviest hitters: team_id present", c("team_id").isNotNull()),
                            ("heaviest hitters: year in range", c("year_id").between(*years)),
                            ("heaviest hitters: >= 5 batters", c("batter_appearances") >= 5),
                            ("heaviest hitters: realistic weight", c("avg_weight_lbs").between(150, 280))]),
        _assertions(short, [("shortest sluggers: team_id present", c("team_id").isNotNull()),
                            ("shortest sluggers: realistic height", c("avg_height_in").between(60, 80)),
                            ("shortest sluggers: >= 5 batters", c("batter_appearances") >= 5)]),
        _assertions(spend, [("biggest spenders: > $1M payroll", c("total_payroll_usd") > 1000000),
                            ("biggest spenders: from salary era", c("year_id") >= 1985),
                            ("biggest spenders: roster_size > 0", c("roster_size") > 0)]),
        _assertions(bang, [(f"bang for buck: year = {params.season}", c("year_id") == params.season),
                           ("bang for buck: wins > 0", c("wins") > 0),
                           ("bang for buck: cost_per_win > 0", c("cost_per_win_usd") > 0)]),
        _assertions(start, [(f"priciest starter: gs >= {params.gs_floor} enforced", c("gs") >= params.gs_floor),
                            ("priciest starter: salary > 0", c("salary") > 0),
                            ("priciest starter: cost_per_start > 0", c("cost_per_start_usd") > 0)]),
        _assertions(ace, [("canadian ace: team in list", c("team_id").isin(*params.team_list)),
                          ("canadian ace: era > 0 (no zero-noise)", c("era") > 0),
                          (f"canadian ace: ipouts >= {params.ip_floor}", c("ipouts") >= params.ip_floor)]),
    ]
    for name, df in [("v_fip", K.fip(wh.pitching, params)), ("v_woba", K.woba(wh.batting, params)),
                     ("v_era_adjusted", K.era_adjusted(wh.pitching, params)),
                     ("v_pitching_war_proxy", K.pitching_war(wh.pitching, params))]:
        parts.append(df.agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(f"sabermetrics: {name} returns rows").alias("check_name"), (c("n") > 0).alias("passed")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def structure_checks(wh: Warehouse, params: Params = Params(), known_ipouts: int = 300) -> DataFrame:
    """The structure assertions that do not concern indexes, as (check_name, passed) rows: the five raw tables are
    there, the three aggregates are populated, a known row has its stored innings, no orphan batters, no
    non-positive salaries.  A check on a row that the data lacks fails, as the reference's does."""
    from dugout.plans import aggregates as A
    one = wh.people.sparkSession.range(1)
    present = one.select(F.lit("all 5 raw.* tables exist").alias("check_name"), F.lit(len(wh.tables()) == 5).alias("passed"))

    def rows(name: str, df: DataFrame) -> DataFrame:
        return df.agg((F.count(F.lit(1)) > 0).alias("passed")).select(F.lit(f"{name} has rows").alias("check_name"), "passed")

    def none(name: str, df: DataFrame) -> DataFrame:
        return df.agg((F.count(F.lit(1)) == 0).alias("passed")).select(F.lit(name).alias("check_name"), "passed")

    known = wh.pitching.where(c("ipouts") == known_ipouts).agg(
        F.coalesce(F.bool_and(c("innings_pitched") * 3 == c("ipouts")), F.lit(False)).alias("passed"))
    parts = [rows("mv_team_payroll", A.team_payroll(wh.salaries)), rows("mv_team_physiques", A.team_physiques(wh.batting, wh.people)),
             rows("mv_league_pitching_baseline", A.league_pitching_baseline(wh.pitching, params)),
             known.select(F.lit(f"generated col: ipouts={known_ipouts}").alias("check_name"), "passed"),
             none("no orphan batting.player_id", orphans(wh.batting.select("player_id"), wh.people, ["player_id"])),
             none("no non-positive salaries", wh.salaries.where(c("salary") <= 0))]
    out = present
    for p in parts:
        out = out.unionByName(p)
    return out
