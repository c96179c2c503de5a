"""Substring search through trigram postings equals the scan, and follows the people it was built from."""

import tempfile

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dugout.functions.text import contains_ci
from dugout.operators import postings as T
from dugout.plans.names import COUNTS, POSTINGS, name_search
from dugout.sources.fixtures import persist_raw
from dugout.sources.sinks import current_version, materialize, read_layer, read_set, write_layer

SF = "/root/testdata/sf0.001"
TEXTS = ["Anna Lee", "JOANNA leeds", "100% Pure", "a_b_c", "axbxc", "ab", "", None, "ΟΔΟΣ ΟΔΟΣ", "Straße", "İstanbul", "x😀y😀z", "a\nb\nc",
         "aaaaaaaa", "Lee", "lee lee lee", "back\\slash", "q" * 5000 + "needle"]


@pytest.fixture(scope="module")
def indexed(spark):
    rows = [(f"p{i}", t) for i, t in enumerate(TEXTS)] + [(f"c{i}", f"Customer#{i:05d}") for i in range(300)]
    rows += [("p0", "Anna Lee"), (None, "Anna Nobody"), (None, None)]                 # repeated and null keys
    names = materialize(spark.createDataFrame(rows, "id string, name string"), "names-test")
    postings = materialize(T.posting_rows(names, "id", "name"), "grams-test")
    return names, postings, materialize(T.gram_counts(postings, names), "counts-test")


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("needle", ["anna", "LEE", "0% p", "a_b", "οδο", "ΔΟΣ", "ΔΟΣ ", "straß", "İST", "x😀y", "😀y😀", "a\nb", "k\\sl", "needle", "ee l",
                                    "aaa", "aaaaaaaaa", "omer#0012", "customer", "zzz", "no such", "", "a", "ab", "😀", "anna nobody"])
def test_search_equals_the_scan(indexed, needle):
    names, postings, counts = indexed
    got = found(T.search(names, "id", "name", needle, postings, counts))
    assert got == found(names.where(contains_ci(F.col("name"), needle)))


@given(st.text(alphabet="abAB#0l e%_\\😀Σσ", max_size=6))
@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_any_needle(indexed, needle):
    names, postings, counts = indexed
    assert found(T.search(names, "id", "name", needle, postings, counts)) == found(names.where(contains_ci(F.col("name"), needle)))


def test_path_by_the_rarest_trigram(indexed):
    _, _, counts = indexed
    assert T.rarest_grams("ab", counts) is None                       # under three characters: a scan
    assert T.rarest_grams("customer", counts) is None                 # on nearly all rows: a scan
    assert T.rarest_grams("zzz", counts) == []                        # nowhere
    rare = T.rarest_grams("mer#00123", counts)
    assert len(rare) == T.RAREST and rare[0] == "123"


def test_search_reads_row_groups_of_the_needle(indexed):
    names, postings, counts = indexed
    plan = T.search(names, "id", "name", "mer#00123", postings, counts)._jdf.queryExecution().toString()
    assert "In(gram, [" in plan and "LeftSemi" in plan
    assert "LeftSemi" not in T.search(names, "id", "name", "ab", postings, counts)._jdf.queryExecution().toString()


def test_postings_are_sorted_and_complete(indexed):
    names, postings, counts = indexed
    want = {(g, k) for k, t in names.collect() if t for low in [t.lower()] if t.isascii()
            for g in {low[i:i + 3] for i in range(len(low) - 2)}}
    ascii_keys = {k for k, t in names.collect() if t and t.isascii() and k is not None}
    got = [(r.gram, r.key) for r in postings.collect() if r.key in ascii_keys]
    assert set(got) == {x for x in want if x[1] is not None}
    n = {r.gram: r.n for r in counts.collect()}
    assert n[""] == names.count() and n["cus"] == 300


def test_empty_table(spark, indexed):
    none = spark.createDataFrame([], "id string, name string")
    postings = materialize(T.posting_rows(none, "id", "name"), "grams-none")
    counts = materialize(T.gram_counts(postings, none), "counts-none")
    for needle in ("anna", "a", ""):
        assert T.search(none, "id", "name", needle, postings, counts).count() == 0


def test_index_is_switched_with_its_people(spark):
    root = tempfile.mkdtemp(prefix="dugout-names-", dir="/tmp")
    persist_raw(spark, SF, root)
    current = read_set(spark, root, "raw")
    assert current["people"] == current[POSTINGS] == current[COUNTS]
    people = read_layer(spark, root, "raw", "people")
    want = found(people.where("full_name ILIKE '%r#00000012%'").select("player_id", "full_name"))
    search = name_search(spark, root, "R#00000012")
    assert found(search) == want and len(want) == 10 and "LeftSemi" in search._jdf.queryExecution().toString()
    # people written by themselves: the old postings are not theirs, so names are scanned
    changed = people.withColumn("full_name", F.concat(F.lit("New "), "full_name"))
    write_layer(changed, root, "raw", "people")
    assert current_version(spark, root, "raw", POSTINGS) != current_version(spark, root, "raw", "people")
    search = name_search(spark, root, "new mach")
    assert found(search) == found(changed.where("full_name ILIKE '%new mach%'").select("player_id", "full_name")) != []
    assert "LeftSemi" not in search._jdf.queryExecution().toString()
