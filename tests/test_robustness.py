"""Hot keys, wide sums, CSV dialect, versions and roots."""

import datetime
from decimal import Decimal
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from dugout.operators.projection import rename_select
from dugout.params import Params
from dugout.plans import aggregates as A
from dugout.plans import jobs
from dugout.plans.constants import LeagueConstants
from dugout.plans.querylog import statement_stats
from dugout.sources import fixtures, loader, sinks
from dugout.sources.schemas import SCHEMAS
from dugout.sources.warehouse import Warehouse


def test_missing_column_is_an_error(spark):
    df = spark.createDataFrame([(1,)], "a int")
    with pytest.raises(ValueError, match="missing columns: b"):
        rename_select(df, [("a", "x"), ("b", "y")])


def test_statements_round_after_aggregating(spark):
    log = spark.createDataFrame([("q", x, 3, 1) for x in (0.016, 0.016, 0.012, 0.012)], "event_type string, value double, hit long, miss long")
    row = statement_stats(log, hit_col="hit", read_col="miss").first()
    assert row.mean_ms == Decimal("0.01") and row.calls == 4
    assert (row.blk_hit, row.blk_read, row.cache_hit_pct) == (12, 4, Decimal("75.0"))
    assert statement_stats(log).first().cache_hit_pct is None


def test_large_payroll(spark):
    sal = spark.range(60_000).select(F.lit(2000).alias("year_id"), F.lit("A").alias("team_id"), F.lit("L").alias("lg_id"),
                                     F.concat(F.lit("p"), "id").alias("player_id"), F.lit(Decimal("9000000000.00")).cast("decimal(12,2)").alias("salary"))
    row = A.team_payroll(sal).first()
    assert row.total_payroll_usd == 540_000_000_000_000 and row.avg_salary_usd == Decimal("9000000000.00") and row.median_salary_usd == 9e9


def test_one_customer_with_a_third_of_all_orders(spark):
    day = datetime.datetime(1998, 5, 5)
    n = 60_000
    orders = spark.range(n).select(F.col("id").alias("o_orderkey"), F.when(F.col("id") % 3 == 0, 4).otherwise(F.col("id") % 50 + 5).alias("o_custkey"),
                                   F.lit(day).alias("o_orderdate"), F.lit(250000.0).alias("o_totalprice"))
    lines = spark.range(n * 3).select((F.col("id") % n).alias("l_orderkey"), (F.col("id") % 7 + 1).alias("l_linenumber"), F.lit(25.0).alias("l_quantity"),
                                      F.lit("R").alias("l_returnflag"), F.lit("F").alias("l_linestatus"))
    customer = spark.range(60).select(F.col("id").alias("c_custkey"), (F.col("id") % 25).alias("c_nationkey"))
    s = fixtures.season(orders, lines, customer)
    wh = Warehouse.derive({"pitching": fixtures.pitching(s), "batting": fixtures.batting(s), "people": None, "teams": None,
                           "salaries": fixtures.salaries(orders, customer)})
    hot = wh.pitching.where("player_id = 'p4'").orderBy("stint").collect()
    # its true sums: 20,000 orders of three lines of quantity 25, half of them with even keys
    assert [(r.gs, r.ipouts, r.innings_pitched) for r in hot] == [(30_000, 750_000, Decimal("250000.0"))] * 2
    bat = wh.batting.where("player_id = 'p4'").collect()
    assert len(bat) == 2 and all((r.ab, r.h, r.hr) == (3_000_000, 750_000, 60_000) for r in bat)
    for r in bat:
        b = {k: v or 0 for k, v in r.asDict().items()}
        obp = Fraction(b["h"] + b["bb"] + b["hbp"], b["ab"] + b["bb"] + b["hbp"] + b["sf"])
        slg = Fraction(b["h"] + b["2b"] + 2 * b["3b"] + 3 * b["hr"], b["ab"])
        assert abs(Fraction(r.ops) - (obp + slg)) <= Fraction(1, 2000)
    x = LeagueConstants(wh, Params.fixture())
    assert x.fip().count() == wh.pitching.where("ipouts >= 162").count()
    assert {r.salary for r in wh.salaries.where("player_id = 'p4'").collect()} == {Decimal("2500000000.00")}
    assert A.team_payroll(wh.salaries).agg(F.sum("total_payroll_usd")).first()[0] == n * 250_000


def csv_row(table, **values):
    return ",".join(values.get(f.name, "") for f in SCHEMAS[table].fields)


def test_csv_dialect(spark, tmp_path):
    head = ",".join(f.name for f in SCHEMAS["people"].fields)
    rows = [csv_row("people", player_id="a", name_last='"Joe ""Shoeless"" X"', name_given='""', weight="180"),
            csv_row("people", player_id="b", name_last='"two\nlines, one field"', bats="NA")]
    (tmp_path / "people.csv").write_text(head + "\n" + "\n".join(rows) + "\n")
    got = {r.player_id: r for r in loader.read_csv(spark, str(tmp_path / "people.csv"), "people").collect()}
    assert got["a"].name_last == 'Joe "Shoeless" X' and got["a"].name_given == "" and got["a"].bats is None and got["a"].weight == 180
    assert got["b"].name_last == "two\nlines, one field" and got["b"].weight is None and got["b"].bats == "NA"
    assert spark.conf.get("spark.sql.csv.parser.columnPruning.enabled") == "true"
    (tmp_path / "wide.csv").write_text(head + "\n" + rows[0] + ",extra\n")
    with pytest.raises(Exception):
        loader.read_csv(spark, str(tmp_path / "wide.csv"), "people").select("player_id").collect()


def test_failed_load_keeps_the_previous_tables(spark, tmp_path):
    paths, root = {}, str(tmp_path / "root")
    keys = {"people": {"player_id": "a"}, "teams": {"year_id": "2000", "team_id": "T"}, "batting": {"player_id": "a", "year_id": "2000", "stint": "1"},
            "pitching": {"player_id": "a", "year_id": "2000", "stint": "1"}, "salaries": {"year_id": "2000", "team_id": "T", "lg_id": "L", "player_id": "a", "salary": "5"}}
    for t in loader.TABLES:
        paths[t] = str(tmp_path / f"{t}.csv")
        (tmp_path / f"{t}.csv").write_text(",".join(f.name for f in SCHEMAS[t].fields) + "\n" + csv_row(t, **keys[t]) + "\n")
    loader.load_all(spark, paths, root)
    assert [r.rows for r in loader.row_counts(Warehouse.from_parquet(spark, root).tables()).collect()] == [1] * 5
    assert all(r.null_keys == r.duplicate_keys == 0 for r in loader.key_report(Warehouse.from_parquet(spark, root).tables()).collect())
    with open(paths["people"], "a") as f:
        f.write(csv_row("people", player_id="a") + "\n" + csv_row("people", player_id="a") + "\n")
    with pytest.raises(ValueError, match="violated 1 times"):
        loader.load_all(spark, paths, root)
    assert Warehouse.from_parquet(spark, root).people.count() == 1
    assert list((tmp_path / "root" / "raw" / "salaries").glob("v*/year_id=2000"))


def test_bucketed_tables_of_two_roots(spark, tmp_path):
    for name, value in (("a", 1), ("b", 2)):
        sinks.write_bucketed(spark.createDataFrame([("p", value)], "player_id string, v int"), str(tmp_path / name), "raw", "people", 2)
    assert [sinks.read_bucketed(spark, str(tmp_path / x), "raw", "people", 2).first().v for x in "ab"] == [1, 2]
    with pytest.raises(ValueError):
        sinks.read_bucketed(spark, str(tmp_path / "a"), "raw", "people", 4)


def test_old_versions_go(spark, tmp_path):
    for i in range(6):
        sinks.publish(spark.range(i + 1), str(tmp_path), "analytics", "t")
    assert sinks.read_layer(spark, str(tmp_path), "analytics", "t").count() == 6
    assert len(list((tmp_path / "analytics" / "t").glob("v*"))) == sinks.KEEP


def test_failing_expectation_leaves_the_previous_marts(spark, tmp_path, make_wh):
    pit = [("p1", 2000, 1, "T1", "L1", 20, 300, 30, 5, 20, 100, 2, Decimal("2.70")), ("p2", 2000, 1, "T1", "L1", 20, 300, 40, 5, 20, 100, 2, Decimal("3.60"))]
    people = [("p1", "A", "B", 200, 70, None, "X"), ("p2", "C", "D", 210, 71, None, "X")]
    bat = [("p1", 2000, 1, "T1", "L1", 600, 150, 30, 5, 20, 50, 5, 5, 3, 3), ("p2", 2000, 1, "T1", "L1", 600, 150, 30, 5, 20, 50, 5, 5, 3, 3)]
    good = make_wh(people=people, teams=[(2000, "L1", "T1", "Club", 162, 80, 82)], batting=bat, pitching=pit,
                   salaries=[(2000, "T1", "L1", "p1", Decimal("5.00"))])
    marts, _ = jobs.build_marts(good, str(tmp_path))
    bad = make_wh(people=people, teams=[(2000, "L1", "T1", "Club", 162, 80, 82)], batting=bat, pitching=pit,
                  salaries=[(2000, "T1", "L1", "p1", Decimal("-5.00"))])
    with pytest.raises(AssertionError, match="failed expectations"):
        jobs.build_marts(bad, str(tmp_path))
    assert sinks.read_layer(spark, str(tmp_path), "marts", "mart_team_payroll").first().total_payroll_usd == 5


def test_player_seasons_stay_in_place(spark, tmp_path):
    """With written constants no metric shuffles the player-seasons, even under a low broadcast threshold."""
    pit = fixtures.pitching(fixtures.season(*[fixtures.read(spark, "/root/testdata/sf0.001", t) for t in ("orders", "lineitem", "customer")]))
    path = str(tmp_path / "pitching")
    Warehouse.derive({"pitching": pit, "people": None, "teams": None, "batting": None, "salaries": None}).pitching.write.parquet(path)
    wh = Warehouse({"pitching": spark.read.parquet(path), "people": None, "teams": None, "batting": None, "salaries": None})
    x = LeagueConstants(wh, Params.fixture())
    x.fip_mean, x.baseline, x.mart_league       # noqa: B018  (written here)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20k")
    try:
        for df in (x.fip(), x.pitching_war()):
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_ops_of_counts_beyond_64_bit_products(spark):
    from dugout.functions.rates import with_batting_rates
    counts = {"ab": 4_000_000_000, "h": 1_000_000_001, "2b": 7, "3b": 5, "hr": 3, "bb": 1_000_000_000, "hbp": None, "sh": 0, "sf": 1}
    row = with_batting_rates(spark.createDataFrame([tuple(counts.values())], ", ".join(f"`{c}` long" for c in counts))).first()
    ops = Fraction(1_000_000_001 + 1_000_000_000, 5_000_000_001) + Fraction(1_000_000_001 + 7 + 10 + 9, 4_000_000_000)
    assert row.ops == Decimal(round(ops * 1000)).scaleb(-3) and row.pa == 5_000_000_001
