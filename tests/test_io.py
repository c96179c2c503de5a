"""CSV loading, key enforcement, sinks, refresh and table presence (A1-A14)."""

import os
import tempfile

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import D
from dugout.sources import loader, sinks
from dugout.sources.warehouse import Warehouse

HEADER = "year_id,team_id,lg_id,player_id,salary\n"


def _csv(text):
    d = tempfile.mkdtemp(prefix="dugout-csv-", dir="/tmp")
    p = os.path.join(d, "salaries.csv")
    with open(p, "w") as f:
        f.write(text)
    return p


def test_csv_empty_is_null_and_na_stays_text(spark):
    p = _csv(HEADER + "2000,T1,L1,NA,10.50\n2001,T2,L1,p2,\n")
    rows = sorted(loader.load_csv(spark, p, "salaries").collect(), key=lambda r: r.year_id)
    assert rows[0].player_id == "NA" and rows[0].salary == D("10.50")
    assert rows[1].salary is None


@pytest.mark.parametrize("bad", ["2000,T1,L1,p1,1.00,extra\n", "2000,T1,L1\n", "x2000,T1,L1,p1,1.00\n"])
def test_csv_malformed_row_fails_the_load(spark, bad):
    p = _csv(HEADER + "2001,T2,L1,p2,2.00\n" + bad)
    with pytest.raises((PySparkException, Exception)):
        loader.load_csv(spark, p, "salaries").select("year_id").collect()


def test_primary_key_duplicates_and_nulls_abort(spark):
    p = _csv(HEADER + "2000,T1,L1,p1,1.00\n2000,T1,L1,p1,2.00\n")
    with pytest.raises(ValueError, match="primary key"):
        loader.load_csv(spark, p, "salaries")
    p2 = _csv(HEADER + "2000,T1,L1,,1.00\n")
    with pytest.raises(ValueError, match="null key"):
        loader.load_csv(spark, p2, "salaries")


def test_row_counts_sorted(make_wh):
    wh = make_wh(salaries=[(2000, "T0", "L0", "a", D(1))])
    rows = loader.row_counts(wh.tables()).collect()
    assert [r.table_name for r in rows] == sorted(r.table_name for r in rows)
    assert {r.table_name: r.rows for r in rows}["salaries"] == 1


def test_write_read_publish_and_require(spark, make_wh):
    root = tempfile.mkdtemp(prefix="dugout-wh-", dir="/tmp")
    wh = make_wh(people=[("a", "F", "A", 200, 70, None, "X")],
                 teams=[(2000, "L0", "T0", "Club", 162, 81, 81)],
                 batting=[("a", 2000, 1, "T0", "L0", 3, 1, 0, 0, 0, 0, 0, 0, 0, 0)],
                 pitching=[("a", 2000, 1, "T0", "L0", 10, 300, 0, 1, 1, 1, 0, D("3.00"))],
                 salaries=[(2000, "T0", "L0", "a", D("5.00"))])
    with pytest.raises(RuntimeError):
        loader.require_tables(spark, root)
    for t, df in wh.tables().items():
        sinks.write_layer(df, root, "raw", t)
    loader.require_tables(spark, root)
    back = Warehouse.from_parquet(spark, root)
    assert back.batting.first().ops == D("0.667")        # derived columns persisted
    first = sinks.refresh_aggregates(back, root)
    v1 = sinks.read_layer(spark, root, "analytics", "mv_team_payroll").first().total_payroll_usd
    second = sinks.refresh_aggregates(back, root)
    assert first["mv_team_payroll"] != second["mv_team_payroll"]      # new version folder
    assert sinks.current_version(spark, root, "analytics", "mv_team_payroll") == second["mv_team_payroll"].split("/")[-1]
    assert sinks.read_layer(spark, root, "analytics", "mv_team_payroll").first().total_payroll_usd == v1 == 5
    # a newer folder that no manifest names is ignored by readers
    os.makedirs(os.path.join(root, "analytics", "mv_team_payroll", "v999999999999999-zzzz"))
    assert sinks.current_version(spark, root, "analytics", "mv_team_payroll") == second["mv_team_payroll"].split("/")[-1]


def test_load_all_end_to_end(spark):
    root = tempfile.mkdtemp(prefix="dugout-load-", dir="/tmp")
    d = tempfile.mkdtemp(prefix="dugout-csvs-", dir="/tmp")
    from dugout.sources.schemas import SCHEMAS
    rows = {"salaries": "2000,T0,L0,a,5.00", "people": "a" + "," * 23, "teams": "2000,L0,T0" + "," * 45,
            "batting": "a,2000,1,T0,L0" + "," * 17, "pitching": "a,2000,1,T0,L0" + "," * 25}
    paths = {}
    for t, r in rows.items():
        p = os.path.join(d, f"{t}.csv")
        with open(p, "w") as f:
            f.write(",".join(SCHEMAS[t].fieldNames()) + "\n" + r + "\n")
        paths[t] = p
    tables = loader.load_all(spark, paths, root)
    assert {t: df.count() for t, df in tables.items()} == {t: 1 for t in rows}
    back = Warehouse.from_parquet(spark, root)
    assert back.people.select(F.col("full_name")).first()[0] == ""


def _today(spark, path, table):
    from dugout.sources.schemas import SCHEMAS
    return (spark.read.schema(SCHEMAS[table]).option("header", True).option("enforceSchema", True).option("columnPruning", False).option("escape", '"')
            .option("multiLine", True).option("emptyValue", "").option("nullValue", "\u0000").option("mode", "FAILFAST").csv(path))


@pytest.mark.parametrize("size", [64, 257, 1000])
def test_quoted_line_breaks_at_range_bounds(spark, tmp_path, size):
    import random
    rng = random.Random(size)
    text = lambda: rng.choice(["plain", '"two\nlines"', '"a ""quoted""\n\n\n, word"', '""', "", '"' + "\n".join(["x"] * rng.randint(1, 60)) + '"'])
    for n in range(2):
        rows = [f"{1990 + i % 9},{text()},{text()},{text()},{i}.50" for i in range(150)]
        (tmp_path / f"{n}.csv").write_text(HEADER + "\n".join(rows) + "\n" * n, newline="")
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        got = loader.read_csv(spark, str(tmp_path), "salaries")
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 10
        assert sorted(map(str, got.collect())) == sorted(map(str, _today(spark, str(tmp_path), "salaries").collect()))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_a_quote_that_is_never_closed_is_an_error(spark):
    with pytest.raises(Exception, match="never closed"):
        loader.read_csv(spark, _csv(HEADER + '2000,"T1,L1,p,1.00\n2001,T2,L1,p2,\n'), "salaries").collect()


def test_tables_of_a_layer_switch_together(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    both = lambda n: {t: sinks.stage(spark.range(n), root, "raw", t) for t in ("a", "b")}
    sizes = lambda: [sinks.read_layer(spark, root, "raw", t).count() for t in ("a", "b")]
    sinks.commit(spark, root, "raw", both(1))
    second = both(2)                                                     # a crash here: staged, no manifest
    assert sizes() == [1, 1]
    (tmp_path / "raw" / "_sets" / "000000000002.json").write_text('{"a": "v0')   # a crash while the manifest is written
    assert sizes() == [1, 1]
    held = sinks.read_set(spark, root, "raw")
    sinks.commit(spark, root, "raw", second)
    assert sizes() == [2, 2] and (tmp_path / "raw" / "_sets" / "000000000003.json").exists()
    assert sinks.read_layer(spark, root, "raw", "a", held).count() == 1      # a reader keeps the set it resolved


def test_concurrent_commits_keep_each_other(spark, tmp_path, monkeypatch):
    root, real = str(tmp_path), sinks._put
    one, two = (sinks.stage(spark.range(n), root, "raw", t) for n, t in ((1, "a"), (2, "b")))

    def put(spark, path, text):
        monkeypatch.setattr(sinks, "_put", real)                           # another job commits just before
        sinks.commit(spark, root, "raw", {"b": two})
        return real(spark, path, text)

    monkeypatch.setattr(sinks, "_put", put)
    sinks.commit(spark, root, "raw", {"a": one})
    assert sorted(sinks.read_set(spark, root, "raw")) == ["a", "b"]


def test_season_year_ignores_session_time_zone(spark):
    """Zone-aware reading of the wall-clock timestamps must not move New-Year orders."""
    from dugout.sources.fixtures import raw_tables
    keys = ("spark.sql.parquet.inferTimestampNTZ.enabled", "spark.sql.session.timeZone")
    old = {k: spark.conf.get(k) for k in keys}
    try:
        spark.conf.set(keys[0], "false")
        spark.conf.set(keys[1], "America/Los_Angeles")
        t = raw_tables(spark, "/root/testdata/sf0.001")
        assert sorted(r.year_id for r in t["teams"]().select("year_id").distinct().collect()) == list(range(1995, 2002))
        assert t["salaries"]().count() == 1069 and t["batting"]().count() == 1058
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_bucketed_layout_joins_without_shuffle(spark, make_wh):
    root = tempfile.mkdtemp(prefix="dugout-bkt-", dir="/tmp")
    wh = make_wh(people=[(f"p{i}", "F", "L", 200, 70, None, "X") for i in range(40)],
                 batting=[(f"p{i % 40}", 2000, 1 + i // 40, "T0", "L0", 3, 1, 0, 0, 0, 0, 0, 0, 0, 0)
                          for i in range(120)])
    sinks.write_bucketed(wh.people, root, "raw", "people", 4)
    sinks.write_bucketed(wh.batting, root, "raw", "batting", 4)
    spark.sql("DROP TABLE IF EXISTS dugout_raw_people")            # external: files stay; re-attach below
    people = sinks.read_bucketed(spark, root, "raw", "people", 4)
    batting = sinks.read_bucketed(spark, root, "raw", "batting", 4)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = batting.join(people.select("player_id", "weight"), "player_id")
        assert joined.count() == 120
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange hashpartitioning" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_bucketed_warehouse_gives_same_answers(spark):
    from dugout.params import Params
    from dugout.plans import aggregates as A
    from dugout.plans import awards as J
    from dugout.sources.fixtures import persist_raw
    p = Params.fixture()
    root = tempfile.mkdtemp(prefix="dugout-bwh-", dir="/tmp")
    persist_raw(spark, "/root/testdata/sf0.001", root, buckets=4)
    for t in ("people", "batting", "pitching", "salaries"):
        spark.sql(f"DROP TABLE IF EXISTS dugout_raw_{t}")
    bw = Warehouse.from_bucketed(spark, root, 4)
    plain = Warehouse.from_testdata(spark, "/root/testdata/sf0.001")
    for q in (lambda w: A.team_physiques(w.batting, w.people), lambda w: J.priciest_starter(w, p, k=5)):
        assert sorted(map(tuple, q(bw).collect())) == sorted(map(tuple, q(plain).collect()))
