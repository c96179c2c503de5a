"""Substring search through a written posting table of trigrams.

A text contains a needle only if it has every trigram (three code points in a row, lower-cased) of the needle. The posting
table holds a (gram, key) row for each distinct trigram of a text, sorted by gram, so a search reads the row groups of the
needle's rarest trigrams alone, intersects their keys by one aggregate and gives only those rows to the exact
case-insensitive match. A search scans all texts where that is the cheaper or the only way: for needles under three
characters, and for those whose rarest trigram is on more than one row in ``SELECTIVE``.

Cases: null texts have no trigrams and never match; texts of one or two characters have none and cannot hold a longer
needle; repeated keys and null keys are kept as they are; wildcards in the needle are plain characters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dugout.functions.text import contains_ci

RAREST = 4             # trigrams of a needle that are intersected; the exact match sees to the others
SELECTIVE = 10         # rows on each row of the rarest trigram from which the postings are worth reading


def grams(text: Column) -> Column:
    """The distinct trigrams of a text, lower-cased as ILIKE does."""
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit("(?s)(?=(...))"), F.lit(1)))


def posting_rows(rows: DataFrame, key: str, text: str) -> DataFrame:
    """(gram, key): a row for each trigram of each text, range-partitioned and sorted. A trigram that most texts hold lies
    across several partitions."""
    out = rows.select(F.explode(grams(F.col(text))).alias("gram"), F.col(key).alias("key"))
    return out.repartitionByRange("gram", "key").sortWithinPartitions("gram", "key")


def gram_counts(postings: DataFrame, rows: DataFrame) -> DataFrame:
    """(gram, n): the rows that hold each trigram; the empty gram stands for all rows."""
    counts = postings.groupBy("gram").agg(F.count("*").alias("n"))
    return counts.unionByName(rows.agg(F.count("*").alias("n")).select(F.lit("").alias("gram"), "n"))


def rarest_grams(needle: str, counts: DataFrame) -> list[str] | None:
    """The needle's rarest trigrams; an empty list if no text can hold it, None if a scan is the way.

    Reads a count for each trigram of the needle."""
    spark = counts.sparkSession
    wanted = spark.range(1).select(grams(F.lit(needle)).alias("g")).first()["g"]
    if not wanted:
        return None
    held = {r["gram"]: r["n"] for r in counts.where(F.col("gram").isin(["", *wanted])).collect()}
    if any(g not in held for g in wanted):
        return []
    rare = sorted(wanted, key=lambda g: (held[g], g))[:RAREST]
    return None if held[rare[0]] * SELECTIVE > held.get("", 0) else rare


def keys_with(postings: DataFrame, rare: list[str]) -> DataFrame:
    """(key) of the texts that hold all of these trigrams."""
    which = F.bit_or(F.coalesce(*[F.when(F.col("gram") == g, F.lit(1 << i)) for i, g in enumerate(rare)]))
    found = postings.where(F.col("gram").isin(rare)).groupBy("key").agg(which.alias("which"))
    return found.where(F.col("which") == (1 << len(rare)) - 1).select("key")


def search(rows: DataFrame, key: str, text: str, needle: str, postings: DataFrame, counts: DataFrame) -> DataFrame:
    """The rows whose text contains the needle, whatever its case: those of a scan, through the postings."""
    rare = rarest_grams(needle, counts)
    if rare is not None and not rare:
        return rows.where(F.lit(False))
    exact = rows.where(contains_ci(F.col(text), needle))
    if rare is None:
        return exact
    found = keys_with(postings, rare).withColumnRenamed("key", "_key")
    return exact.join(found, F.col(key).eqNullSafe(F.col("_key")), "left_semi")
