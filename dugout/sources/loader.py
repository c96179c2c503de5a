"""Typed CSV load of the five raw tables (header row, positional columns, bare empty = NULL,
whole load fails on a malformed row), key enforcement, derived columns, Parquet sink."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dugout.sources.schemas import PRIMARY_KEYS, SCHEMAS, TABLES

NO_TEXT = "\u0000"                          # stands for a bare empty field while parsing; no CSV text holds it
SEASON_TABLES = ("batting", "pitching", "salaries")


OPTIONS = {"escape": '"', "multiLine": "true", "emptyValue": "", "nullValue": NO_TEXT, "mode": "FAILFAST"}


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """(record): the records of CSV files below their header rows, read in byte ranges by many tasks.

    A quoted field may hold line breaks, so a line is a record's start only where the quotes before it in its file are even
    in number. Files are read as lines, in ranges of ``spark.sql.files.maxPartitionBytes``; the parity of each range is
    summed over the ranges before it, and a running parity within a range tells its lines' places. A line that is a
    whole record goes on as it is; only the lines of broken records are gathered, by their record's start. A quote that is
    never closed is an error. Blank lines are no records.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("b"), F.monotonically_increasing_id().alias("i"), "value",
        ((F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))) % 2).alias("odd"))
    along, earlier = Window.partitionBy("f", "b").orderBy("i"), Window.partitionBy("f").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    ranges = lines.groupBy("f", "b").agg(F.sum("odd").alias("quotes"), F.min("i").alias("first"))
    ranges = ranges.withColumns({"before": F.coalesce(F.sum("quotes").over(earlier), F.lit(0)),
                                 "unclosed": F.sum("quotes").over(Window.partitionBy("f")) % 2})           # a row for each range
    checked = F.when(F.col("unclosed") == 1, F.raise_error(F.concat(F.lit("a quote is never closed in "), "f"))).otherwise(F.col("before"))
    ranges = ranges.select("f", "b", "first", checked.alias("before"))
    upto = along.rowsBetween(Window.unboundedPreceding, -1)
    placed = (lines.join(ranges, ["f", "b"])
              .withColumn("starts", (F.col("before") + F.coalesce(F.sum("odd").over(upto), F.lit(0))) % 2 == 0))
    own = F.max(F.when(F.col("starts"), F.col("i"))).over(along.rowsBetween(Window.unboundedPreceding, 0))
    placed = placed.withColumn("start", own)
    whole = placed.where(F.col("starts") & (F.col("odd") == 0) & ~((F.col("b") == 0) & (F.col("i") == F.col("first"))))
    parts = placed.where(~F.col("starts") | (F.col("odd") == 1))
    # a record that came over a range's bound started in the last earlier range that has a start
    last = placed.groupBy("f", "b").agg(F.max(F.when(F.col("starts"), F.col("i"))).alias("_i"))
    last = last.withColumn("_at", F.when(F.col("_i").isNotNull(), F.struct("b", "_i"))).select(
        "f", "b", F.last("_at", ignorenulls=True).over(earlier).alias("over"))
    head = F.struct(F.lit(0).cast("long").alias("b"), F.col("first").alias("_i"))
    parts = (parts.join(last, ["f", "b"])
             .withColumn("at", F.when(F.col("start").isNotNull(), F.struct(F.col("b"), F.col("start").alias("_i"))).otherwise(F.col("over"))))
    joined = (parts.groupBy("f", "at").agg(F.sort_array(F.collect_list(F.struct("b", "i", "value"))).alias("x"),
                                           F.max((F.col("b") == 0) & (F.col("at") == head)).alias("is_header"))
              .where(~F.col("is_header")).select(F.concat_ws("\n", "x.value").alias("record")))
    return (whole.select(F.col("value").alias("record")).unionByName(joined)
            .select(F.regexp_replace("record", "\r$", "").alias("record")).where("record <> ''"))


def read_csv(spark: SparkSession, path: str, table: str) -> DataFrame:
    """Read one table's CSV against its declared schema.

    Columns are matched by position, an empty field is NULL, a quoted empty field is
    an empty text, the text 'NA' stays text, quotes inside quotes are doubled and a quoted field may hold
    line breaks, wherever a file is split (``csv_records``).  FAILFAST makes a bad integer, a short row or an extra column
    abort the load, whichever columns later plans read.
    """
    row = F.from_csv("record", ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in SCHEMAS[table].fields), OPTIONS)
    return csv_records(spark, path).select(row.alias("r")).select("r.*")


def key_violations(df: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Rows proving a primary-key violation: NULL key parts, or duplicated keys (with counts)."""
    null_key = df.where(reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys]))
    dups = df.groupBy(*keys).count().where("count > 1")
    return (null_key.select(*keys).withColumn("count", F.lit(1).cast("bigint"))
            .withColumn("problem", F.lit("null key"))
            .unionByName(dups.withColumn("problem", F.lit("duplicate key"))))


def key_report(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, null_keys, duplicate_keys): rows with a NULL key part, and keys held by several rows."""
    out = None
    for name, df in sorted(tables.items()):
        bad = key_violations(df, PRIMARY_KEYS[name])
        row = bad.agg(F.count(F.when(F.col("problem") == "null key", 1)).alias("null_keys"),
                      F.count(F.when(F.col("problem") == "duplicate key", 1)).alias("duplicate_keys")).select(
            F.lit(name).alias("table_name"), "null_keys", "duplicate_keys")
        out = row if out is None else out.unionByName(row)
    return out


def enforce_key(df: DataFrame, table: str) -> DataFrame:
    """Abort (like a PRIMARY KEY constraint) if the key is NULL or duplicated anywhere.

    The error says how many violations there are and shows a few."""
    bad = key_violations(df, PRIMARY_KEYS[table])
    some = bad.limit(5).collect()
    if some:
        raise ValueError(f"{table}: primary key {PRIMARY_KEYS[table]} violated {bad.count()} times, such as {some}")
    return df


def load_csv(spark: SparkSession, path: str, table: str) -> DataFrame:
    return enforce_key(read_csv(spark, path, table), table)


def load_all(spark: SparkSession, csv_paths: dict[str, str], root: str) -> dict[str, DataFrame]:
    """Load, derive, write, key-check and show all five tables and the name postings under ``root/raw`` (rerunnable).

    Every CSV is read once: keys are checked on the written tables, and only when all five pass do they become
    current, together; otherwise the previous load stays whole.  Seasons are folders of the fact tables."""
    from dugout.plans.names import stage_name_index
    from dugout.sources.sinks import commit, read_layer, read_set, stage
    from dugout.sources.warehouse import Warehouse
    wh = Warehouse.derive({t: read_csv(spark, csv_paths[t], t) for t in TABLES})
    staged = {t: stage(df, root, "raw", t, ("year_id",) if t in SEASON_TABLES else ()) for t, df in wh.tables().items()}
    for t, path in staged.items():
        enforce_key(spark.read.parquet(path), t)
    commit(spark, root, "raw", staged | stage_name_index(spark, root, staged["people"]))
    current = read_set(spark, root, "raw")
    return {t: read_layer(spark, root, "raw", t, current) for t in TABLES}


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One (table_name, rows) row per table, sorted by name."""
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("table_name"), "rows")
             for n, df in sorted(tables.items())]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.orderBy("table_name")


def require_tables(spark: SparkSession, root: str, names=TABLES) -> None:
    """Fail unless every raw table exists under ``root`` (the base-schema presence check)."""
    from dugout.sources.sinks import layer_exists
    missing = [n for n in names if not layer_exists(spark, root, "raw", n)]
    if missing:
        raise RuntimeError(f"missing raw tables: {missing}")
