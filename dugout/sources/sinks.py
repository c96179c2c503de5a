"""Layered table sinks: raw / analytics / marts under one root folder.

Every version of a table is written to a fresh folder that no reader sees (``stage``). ``commit`` then shows any number
of tables of a layer at once: it puts one small manifest that names the current folder of every table of the layer.
Manifests are numbered, put only where that number is absent (a concurrent commit takes the next one), and a reader
takes the newest one that is whole, once for all tables it reads. So a crash between, before or while putting it leaves
the old set whole, and tables of one load or refresh are never mixed with those of another.
The ``KEEP`` newest manifests stay; folders that only older ones name are removed.
"""

from __future__ import annotations

import hashlib
import json
import time
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dugout.session import shared_dir

SETS = "_sets"                      # a layer's folder of manifests


def _path(root: str, layer: str, name: str) -> str:
    return f"{root.rstrip('/')}/{layer}/{name}"


KEEP = 3


def write_layer(df: DataFrame, root: str, layer: str, name: str,
                partition_by: tuple[str, ...] = ()) -> str:
    """Write a table and make it current. Partitioned tables are rebalanced first, so a partition is a few
    files of the advisory size and not one from every task."""
    return publish(df, root, layer, name, partition_by)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a run folder in the shared folder and read it back (its size is then known)."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/dugout-run/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _jvm_fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hp = jvm.org.apache.hadoop.fs.Path(path)
    return hp.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hp


def layer_exists(spark: SparkSession, root: str, layer: str, name: str) -> bool:
    """Whether a table has a committed version."""
    return name in read_set(spark, root, layer)


def _fresh(root: str, layer: str, name: str, kind: str = "") -> str:
    return f"{_path(root, layer, name)}/v{int(time.time() * 1000):015d}-{uuid.uuid4().hex[:8]}{kind}"


def stage(df: DataFrame, root: str, layer: str, name: str, partition_by: tuple[str, ...] = (), folder: str | None = None) -> str:
    """Write a version that no manifest names yet; returns its folder (``folder``: its name, a fresh one if not given)."""
    target = f"{_path(root, layer, name)}/{folder}" if folder else _fresh(root, layer, name)
    w = df.hint("rebalance", *partition_by).write if partition_by else df.write
    w = w.partitionBy(*partition_by) if partition_by else w
    w.mode("errorifexists").parquet(target)
    return target


def _manifests(spark: SparkSession, root: str, layer: str) -> list[tuple[int, dict[str, str] | None]]:
    """(number, folder of each table) of a layer's manifests, newest first; None for one that is not whole."""
    fs, hp = _jvm_fs(spark, _path(root, layer, SETS))
    if not fs.exists(hp):
        return []
    out = []
    for st in fs.listStatus(hp):
        stem, _, kind = st.getPath().getName().partition(".")
        if kind == "json" and stem.isdigit():
            stream = fs.open(st.getPath())
            try:
                text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
            finally:
                stream.close()
            try:
                out.append((int(stem), json.loads(text)))
            except ValueError:
                out.append((int(stem), None))
    return sorted(out, key=lambda x: -x[0])


def read_set(spark: SparkSession, root: str, layer: str) -> dict[str, str]:
    """The current folder of every table of a layer, from its newest whole manifest."""
    return next((tables for _, tables in _manifests(spark, root, layer) if tables is not None), {})


def _put(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file with this text unless it is there."""
    fs, hp = _jvm_fs(spark, path)
    if fs.exists(hp):
        return False
    try:
        stream = fs.create(hp, False)
    except Py4JJavaError as e:
        if "FileAlreadyExists" in str(e.java_exception):
            return False
        raise
    stream.write(bytearray(text.encode()))
    stream.close()
    return True


def commit(spark: SparkSession, root: str, layer: str, staged: dict[str, str], keep: int = KEEP) -> dict[str, str]:
    """Show staged versions (table -> folder) to readers together, by one manifest; the layer's other tables stay as they are."""
    while True:
        known = _manifests(spark, root, layer)
        tables = next((t for _, t in known if t is not None), {})
        tables = tables | {name: path.rstrip("/").rpartition("/")[2] for name, path in staged.items()}
        if _put(spark, f"{_path(root, layer, SETS)}/{(known[0][0] if known else 0) + 1:012d}.json", json.dumps(tables)):
            break
    whole = [(n, t) for n, t in _manifests(spark, root, layer) if t is not None]
    held = {place for _, t in whole[:keep] for place in t.items()}
    fs, _ = _jvm_fs(spark, root)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for n, t in whole[keep:]:
        for name, folder in set(t.items()) - held:
            fs.delete(path(f"{_path(root, layer, name)}/{folder}"), True)
        fs.delete(path(f"{_path(root, layer, SETS)}/{n:012d}.json"), False)
    return staged


def publish(df: DataFrame, root: str, layer: str, name: str, partition_by: tuple[str, ...] = ()) -> str:
    """Write a new version and show it."""
    return commit(df.sparkSession, root, layer, {name: stage(df, root, layer, name, partition_by)})[name]


def current_version(spark: SparkSession, root: str, layer: str, name: str) -> str | None:
    """The current folder of a table (None if it was never published)."""
    return read_set(spark, root, layer).get(name)


def read_layer(spark: SparkSession, root: str, layer: str, name: str, tables: dict[str, str] | None = None) -> DataFrame:
    """Read the current version of a table; ``tables``: a set that was read before, for several tables of one set."""
    version = (read_set(spark, root, layer) if tables is None else tables).get(name)
    if version is None:
        raise FileNotFoundError(f"{_path(root, layer, name)} has no committed version")
    return spark.read.parquet(f"{_path(root, layer, name)}/{version}")


def refresh_aggregates(wh, root: str, params=None, seasons: list[int] | None = None) -> dict[str, str]:
    """Rebuild the three analytical aggregates and the league constants from the raw layer and show all seven together.

    With ``seasons`` only the facts of those seasons are read (their folders of the raw layer): every table is a row or more
    for each season of its own, so the new version is the current one's other seasons and the rebuilt ones. That equals
    a full rebuild if no other season's facts, and no ``params``, changed since (``refresh_changed`` finds the seasons)."""
    from dugout.params import Params
    from dugout.plans import aggregates as A
    from dugout.plans.constants import LeagueConstants
    params = params or Params()
    places: dict[str, str] = {}
    spark = wh.people.sparkSession
    current = {} if seasons is None else read_set(spark, root, "analytics")
    if seasons is not None:
        wh = wh.of_seasons(seasons)

    def keep(df: DataFrame, name: str) -> DataFrame:
        if seasons is not None:
            held = read_layer(spark, root, "analytics", name, current)
            df = df.unionByName(held.where(~held["year_id"].isin(seasons)))
        places[name] = stage(df, root, "analytics", name)
        return spark.read.schema(df.schema).parquet(places[name])

    constants = LeagueConstants(wh, params, keep)
    for name in ("fip_sums", "fip_mean", "woba_mean", "mart_league"):
        getattr(constants, name)
    keep(A.team_payroll(wh.salaries), "mv_team_payroll")
    keep(A.team_physiques(wh.batting, wh.people), "mv_team_physiques")
    keep(A.league_pitching_baseline(wh.pitching, params), "mv_league_pitching_baseline")
    return commit(spark, root, "analytics", places)


def changed_seasons(old, new) -> list[int]:
    """Seasons whose aggregates can differ between two warehouses: those of which any batting, pitching or salary row
    differs, and those in which a player bats whose weight or height differs.

    A season's rows are compared by their number and the sum of their 64-bit hashes, one row a season after the map-side
    combine; only the list of seasons comes to the driver."""
    def mark(df: DataFrame, columns: list[str], by: str) -> DataFrame:
        whole = F.xxhash64(*[x for c in columns for x in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))])   # nulls count by their place
        return df.groupBy(by).agg(F.count("*").alias("n"), F.sum(whole.cast("decimal(38,0)")).alias("h"))

    def differ(a: DataFrame, b: DataFrame, columns: list[str], by: str) -> DataFrame:
        both = mark(a, columns, by).unionByName(mark(b, columns, by))
        return both.groupBy(by).agg(F.count("*").alias("sides"), F.count_distinct("n", "h").alias("marks")).where("sides < 2 OR marks > 1").select(by)

    found = None
    for t in ("batting", "pitching", "salaries"):
        a, b = getattr(old, t), getattr(new, t)
        part = differ(a, b, sorted(b.columns), "year_id")
        found = part if found is None else found.unionByName(part)
    players = differ(old.people, new.people, ["weight", "height"], "player_id")
    found = found.unionByName(new.batting.select("player_id", "year_id").join(players, "player_id", "left_semi").select("year_id"))
    return sorted(r["year_id"] for r in found.where("year_id IS NOT NULL").distinct().collect())     # a row a season


def refresh_changed(spark: SparkSession, root: str, before: dict[str, str], params=None) -> list[int]:
    """Refresh the aggregates for the seasons that a load changed; returns them. ``before``: the raw layer's set
    (``read_set``) of the last refresh, whose folders are kept for ``KEEP`` loads."""
    from dugout.sources.warehouse import Warehouse
    new = Warehouse.from_parquet(spark, root)
    seasons = changed_seasons(Warehouse.from_parquet(spark, root, before), new)
    if seasons:
        refresh_aggregates(new, root, params, seasons)
    return seasons


def _table_name(root: str, layer: str, name: str, folder: str) -> str:
    """Catalog name of a version of a bucketed table; root and folder are part of it, so two never meet."""
    return f"dugout_{hashlib.sha1(f'{root.rstrip("/")}/{folder}'.encode()).hexdigest()[:12]}_{layer}_{name}"


def stage_bucketed(df: DataFrame, root: str, layer: str, name: str, buckets: int, by: tuple[str, ...] = ("player_id",)) -> str:
    """Write a version hash-bucketed (and sorted) on ``by``; no manifest names it yet.

    Joins between tables bucketed the same way on their join key (e.g. batting, pitching and
    people on ``player_id``) then run as sort-merge joins without any shuffle.  The files live in
    the shared folder; the catalog entry is an external table that ``read_bucketed`` re-creates in
    any session, so nothing depends on one driver's metastore.
    """
    target = _fresh(root, layer, name, f"-b{buckets}")
    (df.write.mode("errorifexists").bucketBy(buckets, *by).sortBy(*by)
     .option("path", target).saveAsTable(_table_name(root, layer, name, target.rpartition("/")[2])))
    return target


def write_bucketed(df: DataFrame, root: str, layer: str, name: str, buckets: int, by: tuple[str, ...] = ("player_id",)) -> str:
    """Write a bucketed version and show it."""
    return commit(df.sparkSession, root, layer, {name: stage_bucketed(df, root, layer, name, buckets, by)})[name]


def read_bucketed(spark: SparkSession, root: str, layer: str, name: str, buckets: int,
                  by: tuple[str, ...] = ("player_id",), tables: dict[str, str] | None = None) -> DataFrame:
    """Attach the current version of a bucketed table (idempotent) and return it; another number of buckets is an error."""
    folder = (read_set(spark, root, layer) if tables is None else tables).get(name)
    if folder is None:
        raise FileNotFoundError(f"{_path(root, layer, name)} has no committed version")
    if not folder.endswith(f"-b{buckets}"):
        raise ValueError(f"{_path(root, layer, name)}/{folder} has not {buckets} buckets")
    table = _table_name(root, layer, name, folder)
    path = f"{_path(root, layer, name)}/{folder}"
    if not spark.catalog.tableExists(table):
        schema = spark.read.parquet(path).schema                     # footer read only
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        keys = ", ".join(f"`{c}`" for c in by)
        spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet CLUSTERED BY ({keys}) "
                  f"SORTED BY ({keys}) INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(table)
