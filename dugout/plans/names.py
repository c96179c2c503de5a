"""Name search over the raw layer: trigram postings of ``people.full_name``, written and switched with each load.

The postings' folder bears the name of the people version that they were built from. So a reader sees from the layer's
manifest alone whether they belong to the current people; where they do not (people were written by themselves), it scans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from dugout.functions.text import contains_ci
from dugout.operators import postings as T
from dugout.sources.sinks import materialize, read_layer, read_set, stage

KEY, TEXT = "player_id", "full_name"
POSTINGS, COUNTS = "people_grams", "people_gram_counts"


def stage_name_index(spark: SparkSession, root: str, people_path: str) -> dict[str, str]:
    """Write the postings of a staged people version; they are shown by the commit that shows it."""
    people = spark.read.parquet(people_path)
    folder = people_path.rstrip("/").rpartition("/")[2]
    path = stage(T.posting_rows(people, KEY, TEXT), root, "raw", POSTINGS, folder=folder)
    counts = T.gram_counts(spark.read.parquet(path), people)
    return {POSTINGS: path, COUNTS: stage(counts.coalesce(1).sortWithinPartitions("gram"), root, "raw", COUNTS, folder=folder)}


def name_search(spark: SparkSession, root: str, needle: str) -> DataFrame:
    """(player_id, full_name) of the people whose name contains the needle, whatever its case."""
    current = read_set(spark, root, "raw")
    people = read_layer(spark, root, "raw", "people", current).select(KEY, TEXT)
    if not current["people"] == current.get(POSTINGS) == current.get(COUNTS):
        return people.where(contains_ci(people[TEXT], needle))
    return T.search(people, KEY, TEXT, needle, read_layer(spark, root, "raw", POSTINGS, current),
                    read_layer(spark, root, "raw", COUNTS, current))


def indexed_search(people: DataFrame, needle: str) -> DataFrame:
    """The same over people of any source: their names and postings are written first."""
    people = materialize(people.select(KEY, TEXT), "names")
    postings = materialize(T.posting_rows(people, KEY, TEXT), "name-grams")
    return T.search(people, KEY, TEXT, needle, postings, materialize(T.gram_counts(postings, people), "name-gram-counts"))
