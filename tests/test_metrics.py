"""Metric, award and mart semantics on hand-made rows (FIXTURES.md §3)."""

from conftest import D

from dugout.params import Params
from dugout.plans import aggregates as A
from dugout.plans import awards as J
from dugout.plans import marts as L
from dugout.plans import quality as M
from dugout.plans import sabermetrics as K

PAR = Params(team_list=("T3", "T7"), season=2000)


def P(pid, ipouts, era, lg="L0", team="T0", year=2000, stint=1, gs=0, hr=1, bb=1, so=1, hbp=0):
    return (pid, year, stint, team, lg, gs, ipouts, 0, hr, bb, so, hbp, D(era))


def person(pid, w=200, h=70):
    return (pid, "F", pid.upper(), w, h, None, "X")


def test_woba_null_bb_kept_and_sorted_last(make_wh):
    bat = [("a", 2000, 1, "T0", "L0", 600, 100, 20, 2, 10, None, 0, 0, 0, 0),
           ("b", 2000, 1, "T0", "L0", 500, 150, 30, 3, 20, 50, 5, 5, 0, 5)]
    wh = make_wh(people=[person("a"), person("b")], batting=bat)
    w = {r.player_id: r.woba for r in K.woba(wh.batting, PAR).collect()}
    assert w["a"] is None and w["b"] is not None
    board = K.woba_leaderboard(wh, PAR, 10).collect()
    assert [r.batter for r in board] == ["F B", "F A"]


def test_zero_era_in_fip_constants_not_in_era_adjusted(make_wh):
    rows = [P("z", 200, 0), P("q", 300, "3.50"), P("r", 300, "4.50")]
    wh = make_wh(people=[person("z"), person("q"), person("r")], pitching=rows)
    consts = K.fip_constants(wh.pitching, PAR).collect()[0]
    assert consts.lg_era == D("2.666667")            # (0 + 3.5 + 4.5) / 3
    adj = {r.player_id for r in K.era_adjusted(wh.pitching, PAR).collect()}
    assert adj == {"q", "r"}
    ace_pool = make_wh(people=[person("z")], pitching=[P("z", 200, 0, team="T3")])
    assert J.team_ace(ace_pool, PAR).count() == 0


def test_single_member_league_and_null_league(make_wh):
    rows = [P("a", 300, "3.00", lg="L1"), P("b", 300, "3.00", lg=None)]
    wh = make_wh(people=[person("a"), person("b")], pitching=rows)
    got = K.era_adjusted(wh.pitching, PAR).collect()
    assert len(got) == 1                               # NULL league dropped by the baseline join
    r = got[0]
    assert r.league_era_stddev is None and r.era_z_score is None and r.era_plus == 100


def test_baseline_counts_unqualified_rows(make_wh):
    rows = [P("a", 300, "3.00"), P("b", 10, "5.00"), P("c", 20, "6.00"), P("d", 300, 0)]
    wh = make_wh(pitching=rows)
    r = A.league_pitching_baseline(wh.pitching, PAR).collect()[0]
    assert r.qualified_pitchers == 3 and r.league_era_mean == D("3.000")


def test_ace_rank_ties(make_wh):
    rows = [P("a", 300, "2.00", team="T3"), P("b", 400, "2.00", team="T7"),
            P("c", 400, "2.00", team="T7", year=1999), P("d", 500, "9.00", team="T1")]
    wh = make_wh(people=[person(x) for x in "abcd"], pitching=rows)
    from pyspark.sql import functions as F

    from dugout.operators.topk import rank_filter
    ranked = rank_filter(wh.pitching.where("team_id IN ('T3','T7')"),
                         [F.col("era").asc(), F.col("ipouts").desc()], 1).collect()
    assert sorted(r.player_id for r in ranked) == ["b", "c"]     # full tie: both rank 1
    ace = J.team_ace(wh, PAR).collect()
    assert len(ace) == 1 and ace[0].pitcher == "F B" and ace[0].canadian_era_rank == 1


def test_same_team_stints_both_join_salary(make_wh):
    rows = [P("a", 300, "3.00", gs=10, stint=1), P("a", 300, "3.00", gs=20, stint=2)]
    sal = [(2000, "T0", "L0", "a", D("1000.00"))]
    wh = make_wh(people=[person("a")], pitching=rows, salaries=sal)
    got = sorted(r.cost_per_start_usd for r in J.starter_costs(wh, PAR).collect())
    assert got == [D("50.00"), D("100.00")]


def test_zero_wins_and_two_leagues(make_wh):
    teams = [(2000, "L0", "T0", "Zero Club", 162, 0, 162), (2000, "L0", "T1", "One Club", 162, 10, 152)]
    sal = [(2000, "T0", "L0", "a", D("100.00")), (2000, "T1", "L0", "b", D("100.00")),
           (2000, "T1", "L1", "c", D("300.00"))]
    wh = make_wh(teams=teams, salaries=sal)
    cpw = J.cost_per_win(wh, 2000).collect()
    assert {r.team_id for r in cpw} == {"T1"} and len(cpw) == 2        # one row per lg_id
    st = M.staging_models(wh, PAR)
    mart = {(r.team_id, r.lg_id): r.cost_per_win_usd
            for r in L.mart_team_payroll(st["stg_salaries"], st["stg_teams"]).collect()}
    assert mart[("T0", "L0")] is None
    exp = {r.test_name: r.failures for r in M.expect_marts(wh, PAR).where("model = 'mart_team_payroll'").collect()}
    assert exp["unique_combination_of_columns(year_id,team_id)"] == 1


def test_weight_only_row_counted_and_median(make_wh):
    people = [("a", "F", "A", 200, None, None, "X"), ("b", "F", "B", 180, 70, None, "X"),
              ("c", "F", "C", None, None, None, "X")]
    bat = [(p, 2000, 1, "T0", "L0", 1, 1, 0, 0, 0, 0, 0, 0, 0, 0) for p in "abc"]
    wh = make_wh(people=people, batting=bat)
    r = A.team_physiques(wh.batting, wh.people, with_median=True).collect()[0]
    assert r.batter_appearances == 2 and r.avg_height_in == D("70.00") and r.avg_weight_lbs == D("190.00")
    sal = [(2000, "T0", "L0", p, D(v)) for p, v in zip("abcd", [1, 2, 3, 10])]
    pay = A.team_payroll(make_wh(salaries=sal).salaries).collect()[0]
    assert pay.median_salary_usd == 2.5 and pay.total_payroll_usd == 16 and pay.avg_salary_usd == D("4.00")


def test_dq_bands_orphans_ranges_stints(make_wh):
    def people(n, null_w):
        return [(f"p{i}", "F", "L", None if i < null_w else 200, 70, None, "X") for i in range(n)]

    def status(wh, name):
        return {r.check_name: (r.status, r.observed) for r in M.dq_ledger(wh, PAR).collect()}[name]

    assert status(make_wh(people=people(100, 4)), "people.weight")[0] == "PASS"
    assert status(make_wh(people=people(100, 10)), "people.weight") == ("WARN", "10.00%")
    assert status(make_wh(people=people(100, 30)), "people.weight")[0] == "FAIL"
    teams = [(2000, "L0", "T0", "Club", 162, 81, 81)]
    for n, want in [(0, "PASS"), (49, "WARN"), (50, "FAIL")]:
        sal = [(2000, "T0", "L0", f"ok{i}", D(1)) for i in range(3)] + \
              [(1990, "T9", "L0", f"x{i}", D(1)) for i in range(n)]
        assert status(make_wh(teams=teams, salaries=sal), "salaries.(team_id,year_id) → teams")[0] == want
    rng = make_wh(people=[("a", "F", "L", None, 70, None, "X"), ("b", "F", "L", 99, 70, None, "X"),
                          ("c", "F", "L", 400, 70, None, "X")])
    assert status(rng, "people.weight ∈ [100, 400]") == ("WARN", "1")
    bat = [("a", 2000, s, "T0", "L0", 1, 1, 0, 0, 0, 0, 0, 0, 0, 0) for s in (1, 3)]
    assert status(make_wh(batting=bat), "batting stint sequencing") == ("WARN", "1")


def test_dq_gate_raises_on_fail(make_wh):
    import pytest
    wh = make_wh(people=[("a", "F", "L", 200, 70, None, "X")])
    ledger = M.dq_ledger(wh, PAR)
    with pytest.raises(AssertionError):
        M.dq_gate(ledger)
    summary = {r.status: r.checks for r in M.dq_summary(ledger).collect()}
    assert sum(summary.values()) == 18


def test_war_union_roles(make_wh):
    bat = [("a", 2000, 1, "T0", "L0", 500, 150, 30, 3, 20, 50, 5, 5, 0, 5),
           ("b", 2000, 1, "T0", "L0", 520, 120, 20, 1, 10, 40, 0, 2, 0, 3)]
    pit = [P("c", 300, "3.00", hr=5, bb=20, so=60), P("d", 300, "5.00", hr=15, bb=40, so=30)]
    wh = make_wh(people=[person(x) for x in "abcd"], batting=bat, pitching=pit)
    rows = K.war_leaderboard(wh, PAR, 10).collect()
    assert {r.role for r in rows} == {"B", "P"}
    assert all((r.ip is None) == (r.role == "B") for r in rows)
    wars = [r.war_proxy for r in rows]
    assert wars == sorted(wars, reverse=True)
