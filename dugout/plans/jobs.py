"""End-to-end jobs: load -> aggregates -> marts -> quality gates (the warehouse's `all` target)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from dugout.params import Params
from dugout.operators.expectations import gate as exp_gate
from dugout.plans import quality as M
from dugout.sources.sinks import commit, materialize, read_layer, refresh_aggregates, stage
from dugout.sources.warehouse import Warehouse


@dataclass
class RunReport:
    root: str
    aggregates: dict[str, str]
    marts: dict[str, str]
    ledger: DataFrame
    expectations: DataFrame


def stage_marts(wh: Warehouse, root: str, params: Params = Params(), league=None) -> dict[str, str]:
    """Write a new version of the three marts under ``root/marts``; readers do not see it yet."""
    models = M.mart_models(wh, params, league)
    return {name: stage(models[name], root, "marts", name) for name in models.keys()}


def build_marts(wh: Warehouse, root: str, params: Params = Params(), gate: bool = True, league=None) -> tuple[dict[str, str], DataFrame]:
    """Write the marts, evaluate their expectations on what was written, and only then show them.

    With ``gate`` a failing expectation raises and the previous marts stay current."""
    spark = wh.people.sparkSession
    staged = stage_marts(wh, root, params, league)
    written = {name: spark.read.parquet(path) for name, path in staged.items()}
    results = materialize(M.expect_written_marts(written), "expect-marts")
    if gate:
        exp_gate(results)
    return commit(spark, root, "marts", staged), results


def run_all(spark: SparkSession, root: str, params: Params = Params(), csv_paths: dict | None = None,
            sf_dir: str | None = None, gate: bool = True) -> RunReport:
    """Load the raw layer (from CSV files or from TESTDATA), publish the aggregates, build the marts,
    then evaluate the DQ ledger and all expectation suites; with ``gate`` raise on any FAIL."""
    from dugout.sources import loader
    if csv_paths:
        loader.load_all(spark, csv_paths, root)
    elif sf_dir:
        from dugout.sources.fixtures import persist_raw
        persist_raw(spark, sf_dir, root)
    loader.require_tables(spark, root)
    wh = Warehouse.from_parquet(spark, root)
    aggs = refresh_aggregates(wh, root, params)
    ledger = M.dq_ledger(wh, params)
    exp = M.expect_sources(wh).unionByName(M.expect_staging(wh, params))
    if gate:
        M.dq_gate(ledger)
        exp_gate(exp)
    marts, mart_exp = build_marts(wh, root, params, gate, read_layer(spark, root, "analytics", "mart_league"))
    return RunReport(root, aggs, marts, ledger, exp.unionByName(mart_exp))
