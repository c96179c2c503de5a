"""The five raw season tables (people, teams, batting, pitching, salaries) derived from the
TPC-H-style TESTDATA parquet.

customer -> people, orders x lineitem -> batting/pitching seasons, orders -> salaries,
nation x order years -> teams.  The derivations are fixed values (see FIXTURES.md §2) that the
DuckDB oracle inlines as CTEs; here they are written as DataFrame plans shaped for scale:

* lineitem is aggregated per order *before* it meets orders (map-side partial aggregation),
* seasons/salaries are aggregated per (customer, year, order parity) *before* the customer join,
  so a customer holding a third of all orders is already one row per season when it is joined,
* the customer join is then 1:1 per aggregated row (no fan-out, no skew).
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TPCH = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def order_year(orders: DataFrame):
    """Calendar year of ``o_orderdate`` independent of the session time zone.

    The files store wall-clock timestamps (not adjusted to UTC), which Spark reads as
    TIMESTAMP_NTZ; if a session reads them as zone-aware TIMESTAMP instead, the UTC date is used so
    a non-UTC session cannot move New-Year orders into the previous season.
    """
    from pyspark.sql.types import TimestampType
    col = F.col("o_orderdate")
    if isinstance(orders.schema["o_orderdate"].dataType, TimestampType):
        col = F.date_from_unix_date(F.floor(F.unix_micros(col) / F.lit(86400000000)).cast("int"))
    return F.year(col).cast("int")


def _pid(col):
    return F.concat(F.lit("p"), col.cast("string"))


def people(customer: DataFrame, nation: DataFrame) -> DataFrame:
    ck = F.col("c_custkey")
    return (customer.join(nation, customer.c_nationkey == nation.n_nationkey)
            .select(
                _pid(ck).alias("player_id"),
                F.when(ck % 37 == 0, F.lit(None).cast("string")).otherwise(F.col("c_mktsegment")).alias("name_first"),
                F.col("c_name").alias("name_last"),
                F.when(ck % 29 == 0, F.lit(None)).otherwise((150 + (ck * 7) % 100).cast("int")).alias("weight"),
                F.when(ck % 31 == 0, F.lit(None)).otherwise((62 + (ck * 13) % 18).cast("int")).alias("height"),
                F.when(ck % 3 == 0, F.lit(None)).otherwise((1900 + ck % 100).cast("int")).alias("death_year"),
                F.col("n_name").alias("birth_country"),
                F.concat_ws(" ", "c_mktsegment", "c_name").alias("name_given"),
                F.when(ck % 5 != 0, F.when(ck % 3 == 0, "L").otherwise("R")).alias("bats"),
                F.when(ck % 4 == 0, "L").otherwise("R").alias("throws"),
                F.date_add(F.lit("1990-01-01").cast("date"), (ck % 3000).cast("int")).alias("debut"),
                F.when(ck % 41 != 0, F.date_add(F.lit("1999-01-01").cast("date"), (ck % 3000).cast("int"))).alias("final_game"),
                (1930 + ck % 60).cast("int").alias("birth_year")))


def _order_keys(orders: DataFrame) -> DataFrame:
    return orders.select(
        F.col("o_orderkey"), F.col("o_custkey").alias("ck"),
        order_year(orders).alias("year_id"),
        (F.col("o_orderkey") % 2).alias("parity"), F.col("o_totalprice"))


def _with_team(df: DataFrame, customer: DataFrame) -> DataFrame:
    cust = customer.select(F.col("c_custkey").alias("ck"), "c_nationkey")
    return (df.join(cust, "ck")
            .withColumn("tk", (F.col("c_nationkey") + F.col("parity")) % 25)
            .withColumn("stint", (1 + F.col("parity")).cast("int")))


def season(orders: DataFrame, lineitem: DataFrame, customer: DataFrame) -> DataFrame:
    """Per (customer, year, team, stint): line counts and sums that feed batting and pitching."""
    is_r = F.col("l_returnflag") == "R"
    per_order = lineitem.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("l_quantity").alias("q"),
        F.sum("l_linenumber").alias("ln"),
        F.sum(F.when(is_r, 1).otherwise(0)).alias("nr"),
        F.sum(F.when(is_r, F.col("l_linenumber")).otherwise(0)).alias("lnr"),
        F.sum(F.when(F.col("l_returnflag") == "A", 1).otherwise(0)).alias("na"),
        F.sum(F.when(F.col("l_linestatus") == "F", 1).otherwise(0)).alias("nf"))
    per_season = (_order_keys(orders)
                  .join(per_order, F.col("o_orderkey") == F.col("l_orderkey"))
                  .groupBy("ck", "year_id", "parity")
                  .agg(F.sum("n").alias("n"), F.sum("q").cast("bigint").alias("q"),
                       F.sum("ln").cast("bigint").alias("ln"), F.sum("nr").alias("nr"),
                       F.sum("lnr").cast("bigint").alias("lnr"), F.sum("na").alias("na"),
                       F.sum("nf").alias("nf")))
    return _with_team(per_season, customer).select("ck", "year_id", "tk", "stint", "n", "q", "ln", "nr", "lnr", "na", "nf")


def _ids(s: DataFrame):
    return [_pid(F.col("ck")).alias("player_id"), F.col("year_id"), F.col("stint"),
            F.concat(F.lit("T"), F.col("tk").cast("string")).alias("team_id"),
            F.concat(F.lit("L"), (F.col("tk") % 5).cast("string")).alias("lg_id")]


def batting(s: DataFrame) -> DataFrame:
    c = F.col
    return s.select(*_ids(s),
                    (c("q") * 4).cast("long").alias("ab"), c("q").cast("long").alias("h"),
                    c("ln").cast("long").alias("2b"), c("nr").cast("long").alias("3b"),
                    (c("n") * 2).cast("long").alias("hr"), (c("ln") * 3).cast("long").alias("bb"),
                    F.when(c("ck") % 19 == 0, F.lit(None)).otherwise(c("na").cast("long")).alias("ibb"),
                    F.when(c("ck") % 17 == 0, F.lit(None)).otherwise(c("nf").cast("long")).alias("hbp"),
                    c("nr").cast("long").alias("sh"), c("na").cast("long").alias("sf"),
                    c("n").cast("long").alias("g"), (c("nr") * 2).cast("long").alias("r"), c("ln").cast("long").alias("rbi"),
                    c("na").cast("long").alias("sb"), c("nf").cast("long").alias("cs"), (c("n") * 3).cast("long").alias("so"),
                    F.when(c("ck") % 23 != 0, c("nr").cast("long")).alias("gidp"))


def pitching(s: DataFrame) -> DataFrame:
    c = F.col
    era = (F.floor((c("lnr") * 5400 + c("q")).cast("double") / (c("q") * 2)).cast("decimal(10,0)")
           * F.lit(Decimal("0.01"))).cast("decimal(6,2)")
    return (s.select(*_ids(s),
                    c("n").cast("long").alias("gs"), c("q").cast("long").alias("ipouts"),
                    c("lnr").cast("long").alias("er"), c("na").cast("long").alias("hr"),
                    c("ln").cast("long").alias("bb"), (c("nf") * 5 + c("n") * 3).cast("long").alias("so"),
                    F.when(c("ck") % 17 == 0, F.lit(None)).otherwise(c("nf").cast("long")).alias("hbp"),
                    F.when(c("ck") % 97 == 0, F.lit(None).cast("decimal(6,2)")).otherwise(era).alias("era"),
                    c("nr").cast("long").alias("w"), c("na").cast("long").alias("l"), (c("n") * 2).cast("long").alias("g"),
                    c("nf").cast("long").alias("cg"), (c("nr") % 3).cast("long").alias("sho"), (c("ln") % 7).cast("long").alias("sv"),
                    c("q").cast("long").alias("h"),
                    (((c("ck") * 37 + c("year_id") * 11) % 1000).cast("decimal(10,0)") * F.lit(Decimal("0.001")))
                    .cast("decimal(5,3)").alias("baopp")))


def salaries(orders: DataFrame, customer: DataFrame) -> DataFrame:
    per_season = (_order_keys(orders).groupBy("ck", "year_id", "parity")
                  .agg(F.sum(F.col("o_totalprice").cast("decimal(12,2)")).alias("paid")))
    return _with_team(per_season, customer).select(
        "year_id",
        F.concat(F.lit("T"), F.col("tk").cast("string")).alias("team_id"),
        F.concat(F.lit("L"), (F.col("tk") % 5).cast("string")).alias("lg_id"),
        _pid(F.col("ck")).alias("player_id"),
        F.col("paid").cast("decimal(18,2)").alias("salary"))


def teams(nation: DataFrame, orders: DataFrame) -> DataFrame:
    """One row per (nation, order year) except (T24, 1999).

    The distinct-year set is a scalar subquery (partial ``collect_set`` of calendar years, so
    bounded by the number of seasons) exploded per nation row — no join is needed.
    """
    years = orders.select(F.array_sort(F.collect_set(order_year(orders))).alias("ys"))
    nk = F.col("n_nationkey")
    y = F.col("year_id")
    wins = ((nk * 37 + y * 11) % 163).cast("int")
    return (nation.select("n_nationkey", "n_name", "n_regionkey",
                          F.explode(years.scalar()).alias("year_id"))
            .where(~((nk == 24) & (y == 1999)))
            .select(y, F.concat(F.lit("L"), F.col("n_regionkey").cast("string")).alias("lg_id"),
                    F.concat(F.lit("T"), nk.cast("string")).alias("team_id"),
                    F.concat(F.col("n_name"), F.lit(" Club")).alias("name"),
                    F.lit(162).cast("int").alias("g"), wins.alias("w"),
                    (F.lit(162) - wins).cast("int").alias("l"),
                    F.concat(F.lit("F"), nk.cast("string")).alias("franch_id"),
                    F.when(nk % 5 != 0, F.when(nk % 2 == 0, "E").otherwise("W")).alias("div_id"),
                    F.concat(F.col("n_name"), F.lit(" Park")).alias("park"),
                    (500 + (nk * 31 + y * 7) % 400).cast("int").alias("r"), (500 + (nk * 17 + y * 13) % 400).cast("int").alias("ra"),
                    ((200 + (nk * 53 + y * 29) % 400).cast("decimal(10,0)") * F.lit(Decimal("0.01"))).cast("decimal(5,2)").alias("era"),
                    F.when(nk % 23 != 0, (1000000 + (nk * 7919 + y * 104729) % 2000000).cast("int")).alias("attendance")))


def raw_tables(spark: SparkSession, sf_dir: str) -> dict:
    """The five raw tables (without derived columns) as lazily built plans over TESTDATA."""
    cache: dict[str, DataFrame] = {}

    def src(name: str) -> DataFrame:
        if name not in cache:
            cache[name] = read(spark, sf_dir, name)
        return cache[name]

    def seasons() -> DataFrame:
        if "_season" not in cache:
            cache["_season"] = season(src("orders"), src("lineitem"), src("customer"))
        return cache["_season"]

    return {
        "people": lambda: people(src("customer"), src("nation")),
        "teams": lambda: teams(src("nation"), src("orders")),
        "batting": lambda: batting(seasons()),
        "pitching": lambda: pitching(seasons()),
        "salaries": lambda: salaries(src("orders"), src("customer")),
    }


def persist_raw(spark: SparkSession, sf_dir: str, root: str, buckets: int | None = None) -> None:
    """Load job: derive the raw layer from TESTDATA and persist it under ``root/raw``.

    The season helper (the only step that reads lineitem) is written once to the shared folder
    and both batting and pitching are derived from that copy, so lineitem is scanned once and a
    lost executor later in the job recomputes from the written table, not from lineitem.
    Fact tables are laid out by season; with ``buckets`` the player-keyed tables (people,
    batting, pitching, salaries) are instead hash-bucketed on ``player_id`` so player joins need
    no shuffle (read back with ``Warehouse.from_bucketed``).
    """
    from dugout.plans.names import stage_name_index
    from dugout.sources.sinks import commit, stage, stage_bucketed, write_layer
    from dugout.sources.warehouse import Warehouse
    t = {n: read(spark, sf_dir, n) for n in ("nation", "customer", "orders", "lineitem")}
    season_path = write_layer(season(t["orders"], t["lineitem"], t["customer"]), root, "work", "season")
    s = spark.read.parquet(season_path)
    wh = Warehouse.derive({
        "people": people(t["customer"], t["nation"]),
        "teams": teams(t["nation"], t["orders"]),
        "batting": batting(s),
        "pitching": pitching(s),
        "salaries": salaries(t["orders"], t["customer"]),
    })
    places = {}
    for name, df in wh.tables().items():
        if buckets and name != "teams":
            places[name] = stage_bucketed(df, root, "raw", name, buckets)
        else:
            places[name] = stage(df, root, "raw", name, ("year_id",) if name in ("batting", "pitching", "salaries") else ())
    commit(spark, root, "raw", places | stage_name_index(spark, root, places["people"]))
