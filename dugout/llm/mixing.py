"""Mixing sources to target weights: hash-random order within a source, cut at its exact budget.

Every document gets a hash-random key, so the documents of one source are in a random but repeatable
order. The order is kept as (key range, key): sizes are pre-aggregated per (source, key range), prefix
sums over those few rows, in two levels, give each range its offset, and only the rows of one range are sorted
together, so a source with a third of the corpus is spread over as many tasks as it has ranges. Rows of equal
(source, doc_id, size) are interchangeable and are placed as one row with a count, so rows without doc_id, which
share one key, are no more rows in their range than they have sizes.

Source targets: sources in code-point order (null last) weigh ``weights`` repeating and share the
whole corpus size by weight; a source stops at ``max_epochs`` times its own size and the excess goes
to the others by weight until none is above (a water level found with integer sums).

Cases: null text has size 0; size-0 documents are never taken (taken 0); a null source is a source of
its own; null or repeated doc_ids are ordinary rows (``mix`` breaks ties by size, equal rows in any order;
``mixed_documents`` orders by doc_id and text); an empty table gives an empty result; extra columns are ignored by ``mix`` and kept
by ``mixed_documents``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from dugout.llm.common import small, staged, text_or_empty

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
RANGE_ROWS = 2_000     # documents that one key range holds on average
COPIES = 1_000         # equal rows that are written out together


def text_size(text: str | Column = "text") -> Column:
    """Words of a text: maximal runs of characters other than ASCII white space."""
    return F.regexp_count(text_or_empty(text), F.lit(WORD)).cast("long")


def random_key(doc_id: str | Column = "doc_id") -> Column:
    """Hash-random order of documents: uniform hex, the same in every run."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.md5(F.concat(F.lit("mix:"), F.coalesce(c.cast("string"), F.lit("null"))).cast("binary"))


def text_key(doc_id: str | Column = "doc_id", text: str | Column = "text") -> Column:
    """Hash-random order of documents that also tells texts of one or no doc_id apart."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.md5(F.concat_ws(":", F.lit("mix"), F.coalesce(c.cast("string"), F.lit("null")),
                             F.xxhash64(text_or_empty(text)).cast("string")).cast("binary"))


def source_targets(sizes: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size) -> + target: one row per source, so these windows stay small."""
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    weight = F.array(*[F.lit(float(w)) for w in weights])
    s = sizes.withColumn("w", F.element_at(weight, ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")))
    s = s.withColumn("cap", F.col("source_size").cast("double") * max_epochs)
    order = W.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    before, whole = order.rowsBetween(W.unboundedPreceding, -1), W.partitionBy()
    s = (s.withColumn("rest", F.sum(F.col("source_size").cast("double")).over(whole)
                      - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
         .withColumn("rest_w", F.sum("w").over(whole) - F.coalesce(F.sum("w").over(before), F.lit(0.0)))
         .withColumn("open", F.col("cap") * F.col("rest_w") >= F.col("w") * F.col("rest")))
    level = F.first(F.when(F.col("open"), F.struct("rest", "rest_w")), ignorenulls=True).over(
        order.rowsBetween(W.unboundedPreceding, W.currentRow))
    s = s.withColumn("level", level)
    target = F.when(F.col("level").isNull(), F.col("cap")).otherwise(
        F.col("w") * F.col("level.rest") / F.col("level.rest_w"))
    return s.select("source", "source_size", target.alias("target"))


def _sized(docs: DataFrame) -> DataFrame:
    """The light rows of the mix: id, source, key, words of one row, number of equal rows, words of all (texts stay behind)."""
    rows = docs.select("doc_id", "source", text_size("text").alias("one"), random_key().alias("key"))
    rows = rows.groupBy("source", "key", "doc_id", "one").agg(F.count("*").alias("n"))
    return staged(rows.withColumn("size", F.col("one") * F.col("n")), "mix-sizes")


def _offsets(ranges: DataFrame, digits: int) -> DataFrame:
    """(source, range, range_size) -> + offset, the words before the range: prefix sums over groups of ranges with a common
    head, then within each, so one task holds about the square root of a source's ranges."""
    ranges = ranges.withColumn("head", F.substring("range", 1, digits // 2))
    before = lambda w: w.rowsBetween(W.unboundedPreceding, -1)
    heads = ranges.groupBy("source", "head").agg(F.sum("range_size").alias("head_size"))
    heads = heads.withColumn("skip", F.coalesce(F.sum("head_size").over(before(W.partitionBy("source").orderBy("head"))), F.lit(0)))
    heads = small(staged(heads.select(F.col("source").alias("_source"), F.col("head").alias("_head"), "skip"), "mix-heads"))
    inside = F.coalesce(F.sum("range_size").over(before(W.partitionBy("source", "head").orderBy("range"))), F.lit(0))
    return (ranges.withColumn("inside", inside)
            .join(heads, F.col("source").eqNullSafe(F.col("_source")) & (F.col("head") == F.col("_head")))
            .select("source", "range", "range_size", (F.col("skip") + F.col("inside")).alias("offset")))


def _placed(rows: DataFrame, weights, max_epochs: int, range_rows: int) -> DataFrame:
    """Rows with their source's size and target and the words of their source that lie before them."""
    digits = 1
    n = rows.count()
    while 16 ** digits * range_rows < n:
        digits += 1
    rows = rows.withColumn("range", F.substring("key", 1, digits))
    ranges = rows.groupBy("source", "range").agg(F.sum("size").alias("range_size"))
    ranges = staged(_offsets(staged(ranges, "mix-range-sizes"), digits), "mix-ranges")
    sizes = ranges.groupBy("source").agg(F.sum("range_size").alias("source_size"))
    targets = small(staged(source_targets(sizes, weights, max_epochs), "mix-targets"))
    ranges = (ranges.alias("r").join(targets.alias("t"), F.col("r.source").eqNullSafe(F.col("t.source")))
              .select("r.source", "range", "offset", "source_size", "target"))
    placed = (rows.alias("d").join(small(staged(ranges, "mix-offsets")).alias("r"),
                                   F.col("d.source").eqNullSafe(F.col("r.source")) & (F.col("d.range") == F.col("r.range")))
              .select("d.*", "offset", "source_size", "target"))
    in_range = (W.partitionBy("source", "range").orderBy("key", F.col("doc_id").asc_nulls_last(), "size")
                .rowsBetween(W.unboundedPreceding, -1))
    return placed.withColumn("before", F.col("offset") + F.coalesce(F.sum("size").over(in_range), F.lit(0)))


def _taken(placed: DataFrame) -> DataFrame:
    """+ full and rest: how often a source is taken whole, and the words of its budget that then remain."""
    budget, size = F.floor("target").cast("long"), F.col("source_size")
    full = F.when(size > 0, F.floor(budget / size).cast("long")).otherwise(F.lit(0).cast("long"))
    return placed.withColumn("full", full).withColumn("rest", budget - F.col("full") * size)


def _each(placed: DataFrame) -> DataFrame:
    """A row for each of ``n`` equal rows: they stand one after the other, dealt out in runs of COPIES."""
    runs = F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(COPIES).cast("long"))
    many = (placed.where("n > 1").withColumn("run", F.explode(runs)).repartition("key", "one", "run")
            .withColumn("nth", F.explode(F.sequence("run", F.least(F.col("run") + COPIES, "n") - 1)))
            .withColumn("before", F.col("before") + F.col("nth") * F.col("one")).withColumn("size", F.col("one")).drop("run", "nth"))
    return placed.where("n = 1").unionByName(many)


def mix(docs: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS, range_rows: int = RANGE_ROWS) -> DataFrame:
    """(doc_id, text, source) -> doc_id, source, key, size, source_size, target, full, before, rest, taken.

    A document is taken ``full`` times, and once more for as many of its words as fit in what remains
    of the budget (floor of the target) at its place in the source's random order; the words taken
    from a source therefore sum to exactly its budget.
    """
    rows = _sized(docs)
    placed = _taken(_placed(rows, weights, max_epochs, range_rows))
    if not rows.where("n > 1").isEmpty():
        placed = _each(staged(placed, "mix-placed"))
    part = F.least(F.greatest(F.col("rest") - F.col("before"), F.lit(0).cast("long")), F.col("size"))
    return placed.select("doc_id", "source", "key", "size", "source_size", "target", "full", "before", "rest",
                         (F.col("full") * F.col("size") + part).alias("taken"))


def mixed_documents(docs: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS,
                    range_rows: int = RANGE_ROWS) -> DataFrame:
    """The rows of ``docs`` repeated as the mix takes them, in whole documents.

    Every document comes ``full`` times, and once more if it lies before its source's cut: the first
    document in random order of which less than half is within the budget. So each source's total is
    within half a document of its budget and no text is truncated. Equal rows (doc_id and text) are placed
    as one row with a count, and the cut may lie between them. Only one row per source (the cut)
    is joined to the texts; its size is checked before it is broadcast.
    """
    rows = docs.select("source", text_key().alias("key"), text_size("text").alias("one"))
    rows = rows.groupBy("source", "key", "one").agg(F.count("*").alias("n"))
    rows = staged(rows.withColumn("size", F.col("one") * F.col("n")).withColumn("doc_id", F.lit(None).cast("long")), "mix-sizes")
    placed = _taken(_placed(rows, weights, max_epochs, range_rows))
    # copies of which at least half is within the budget
    within = 2 * (F.col("rest") - F.col("before")) - F.col("one")
    inside = F.when(within >= 0, F.least(F.floor(within / (2 * F.greatest("one", F.lit(1)))).cast("long") + 1, F.col("n"))).otherwise(0)
    placed = placed.withColumn("inside", inside.cast("long"))
    out = (F.col("inside") < F.col("n")) & (F.col("size") > 0)
    cuts = placed.groupBy("source").agg(F.max("full").alias("_full"), F.min(F.when(out, F.struct("key", "inside"))).alias("_cut"),
                                        F.max("source_size").alias("_source_size"))
    cuts = staged(cuts.select(F.col("source").alias("_source"), "_full", F.col("_cut.key").alias("_cut_key"),
                              F.coalesce("_cut.inside", F.lit(0)).alias("_inside"), "_source_size"), "mix-cuts")
    divided = not cuts.where("_inside > 0").isEmpty()
    key = text_key(F.col("r.doc_id"), F.col("r.text"))
    found = (docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("r")).withColumn("_key", key)
             .join(small(cuts), F.col("r.source").eqNullSafe(F.col("_source"))))
    extra = F.when((F.col("_source_size") > 0) & (F.col("_cut_key").isNull() | (F.col("_key") < F.col("_cut_key"))), 1).otherwise(0)
    copied = found.withColumn("_copies", F.col("_full") + extra)
    if divided:
        at_cut = F.coalesce((F.col("_key") == F.col("_cut_key")) & (F.col("_inside") > 0), F.lit(False))
        nth = F.row_number().over(W.partitionBy("_source").orderBy("_row"))
        equal = (found.where(at_cut).withColumn("_row", F.monotonically_increasing_id())
                 .withColumn("_copies", F.col("_full") + F.when(nth <= F.col("_inside"), 1).otherwise(0)).drop("_row"))
        copied = copied.where(~at_cut).unionByName(equal)
    return (copied.where("_copies > 0")
            .select("r", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies"))).alias("_copy"))
            .select("r.*"))
