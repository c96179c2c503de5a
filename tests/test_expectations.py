"""Declarative expectations, envelope, name search and statement rollup on deliberate bad rows."""

import json

from pyspark.sql import functions as F

from dugout.functions.text import contains_ci, fingerprint
from dugout.operators import expectations as X
from dugout.operators.envelope import as_json, award_envelope, award_title, flatten, require_winner
from dugout.plans.querylog import statement_stats


def test_expectation_failing_counts(spark):
    parent = spark.createDataFrame([("a",), ("b",)], "pid string")
    df = spark.createDataFrame(
        [("a", 1, 5.0, "x"), ("a", 1, -1.0, "x"), ("c", None, None, "y"), (None, 3, 200.0, "y"),
         ("c", 4, 0.0, "y")], "pid string, n int, v double, g string")
    suite = [X.not_null("pid"), X.unique("pid"), X.relationships("pid", "parent", "pid"),
             X.accepted_range("v", 0, 100), X.expression_is_true("n", "> 1"),
             X.expression_is_true("v", ">= 0", where="v IS NOT NULL"), X.unique_combination("pid", "n")]
    res = {r.test_name: (r.column_name, r.failures, r.status) for r in
           X.evaluate("m", df, suite, {"parent": parent}).collect()}
    assert res["not_null"] == ("pid", 1, "fail")
    assert res["unique"] == ("pid", 2, "fail")                  # 'a' and 'c' are duplicated
    assert res["relationships(parent.pid)"] == ("pid", 2, "fail")   # two 'c' rows; NULL ignored
    assert res["accepted_range(0,100)"] == ("v", 2, "fail")      # -1 and 200; NULL passes
    assert res["expression_is_true(> 1)"] == ("n", 2, "fail")    # 1, 1; NULL passes
    assert res["expression_is_true(>= 0 where v IS NOT NULL)"] == ("v", 1, "fail")
    assert res["unique_combination_of_columns(pid,n)"] == ("pid,n", 1, "fail")
    import pytest
    with pytest.raises(AssertionError):
        X.gate(X.evaluate("m", df, suite, {"parent": parent}))
    X.gate(X.evaluate("ok", parent, [X.not_null("pid"), X.unique("pid")]))


def test_envelope_shapes(spark):
    df = spark.createDataFrame([("T1", "One", 2000, 10, 5)], "team_id string, team_name string, year_id int, wins int, total long")
    env = award_envelope(df, award_title("Most Bang for the Buck", 2000), ["team_id", "team_name", "year_id"],
                         ["wins", "total"])
    doc = json.loads(as_json(env).first().json)
    assert doc == {"award": "Most Bang for the Buck (2000)",
                   "winner": {"team_id": "T1", "team_name": "One", "year_id": 2000},
                   "metric": {"wins": 10, "total": 5}}
    assert award_title("Biggest Spenders", None) == "Biggest Spenders"
    assert flatten(env).columns == ["award", "winner_team_id", "winner_team_name", "winner_year_id",
                                    "metric_wins", "metric_total"]
    assert award_envelope(df.limit(0), "x", ["team_id"], ["wins"]).count() == 0
    assert require_winner(env).winner.team_id == "T1"
    import pytest
    with pytest.raises(LookupError):
        require_winner(award_envelope(df.limit(0), "x", ["team_id"], ["wins"]))


def test_name_search_escapes_wildcards(spark):
    df = spark.createDataFrame([("100% Pure",), ("100 Pure",), ("a_b",), ("axb",)], "n string")
    assert [r.n for r in df.where(contains_ci(F.col("n"), "0% p")).collect()] == ["100% Pure"]
    assert [r.n for r in df.where(contains_ci(F.col("n"), "A_B")).collect()] == ["a_b"]


def test_statement_rollup_normalises_and_excludes(spark):
    log = spark.createDataFrame(
        [("SELECT  1\n FROM t", 10.0), ("SELECT 1 FROM t", 20.0), ("select * from pg_stat_statements", 99.0),
         ("x" * 200, 1.5), ("x" * 200 + "y", 2.5)], "q string, ms double")
    rows = {r.query: r for r in statement_stats(log, "q", "ms").collect()}
    assert set(rows) == {"SELECT 1 FROM t", "x" * 90}
    # two statements sharing their first 90 characters keep separate counters
    assert statement_stats(log, "q", "ms").where(F.col("query") == "x" * 90).count() == 2
    r = rows["SELECT 1 FROM t"]
    assert (r.calls, str(r.mean_ms), str(r.stddev_ms), str(r.total_s)) == (2, "15.00", "5.00", "0.03")
    assert [x.query for x in statement_stats(log, "q", "ms", k=1).collect()] == ["SELECT 1 FROM t"]
    assert log.select(fingerprint(F.col("q"), 5).alias("f")).first().f == "SELEC"


def test_relationships_meet_their_parent_once(spark):
    parent = spark.createDataFrame([("1",), ("2",)], "pid string")
    a = spark.createDataFrame([("1",), ("3",), ("3",), (None,)], "pid string")
    b = spark.createDataFrame([("2",), ("4",)], "k string")
    n = spark.createDataFrame([(1,), (5,), (6,), (6,)], "pid int")
    models = {"a": a, "b": b, "n": n, "parent": parent, "empty": a.limit(0)}
    rel = X.relationships
    suite = {"a": [rel("pid", "parent", "pid"), X.not_null("pid")], "b": [rel("k", "parent", "pid")], "n": [rel("pid", "parent", "pid")],
             "empty": [rel("pid", "parent", "pid")]}
    res = X.evaluate_all(models, suite)
    keys = [line for line in res._jdf.queryExecution().executedPlan().toString().split("\n") if "Exchange hashpartitioning(_k" in line]
    assert {(r.model, r.test_name): (r.column_name, r.failures, r.status) for r in res.collect()} == {
        ("a", "relationships(parent.pid)"): ("pid", 2, "fail"), ("a", "not_null"): ("pid", 1, "fail"),
        ("b", "relationships(parent.pid)"): ("k", 1, "fail"), ("n", "relationships(parent.pid)"): ("pid", 3, "fail"),
        ("empty", "relationships(parent.pid)"): ("pid", 0, "pass")}
    assert len(keys) == 2                                      # one for text keys, one for numbers


def test_source_suite_has_one_exchange_a_parent(spark):
    """Checked on the physical plan: an anti-join would be pushed below the union of the children and planned for each."""
    from dugout.plans.quality import dq_ledger, expect_sources
    from dugout.sources.warehouse import Warehouse
    wh = Warehouse.from_testdata(spark, "/root/testdata/sf0.001")
    plan = expect_sources(wh)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(_k") == 1 and "LeftAnti" not in plan
    plan = dq_ledger(wh)._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" not in plan


def test_orphans_with_null_and_hot_keys(spark):
    from dugout.operators.joins import orphan_counts, orphans
    parent = spark.createDataFrame([("a", 1), ("a", 1), (None, 2), ("b", None)], "t string, y int")
    child = spark.createDataFrame([("a", 1)] * 50 + [("a", 2)] * 30 + [(None, 2), ("b", None), (None, None)], "t string, y int")
    got = orphan_counts({"x": child, "none": child.limit(0)}, parent, ["t", "y"]).first()
    assert (got.x, got.none) == (33, 0) and orphans(child, parent, ["t", "y"]).count() == 33
    assert orphan_counts({"x": child}, parent.limit(0), ["t", "y"]).first().x == 83
