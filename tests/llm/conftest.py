import pytest

LONG = "word " * 40_000 + "end"

WEIRD = [
    # doc_id, text, lang, source, n_chars, size, key, r, words, label
    (1, None, "en", "a", 0, 1, "k", "x", "w", "l"),
    (2, "", "en", "a", 0, 1, "k", "x", "w", "l"),
    (3, " \n\t ", None, None, None, None, None, None, None, None),
    (4, "one", "en", "b", 3, 1, "k", "x", "w", "l"),
    (5, "alpha beta gamma delta epsilon zeta eta theta iota kappa", "en", "b", 1, 1, "k", "x", "w", "l"),
    (6, "alpha beta gamma delta epsilon zeta eta theta iota kappa", "en", "b", 1, 1, "k", "x", "w", "l"),
    (6, "alpha beta gamma delta epsilon zeta eta theta iota kappa", "en", "b", 1, 1, "k", "x", "w", "l"),
    (None, "alpha beta gamma delta epsilon zeta eta theta iota kappa", "en", None, 1, 1, "k", "x", "w", "l"),
    (None, None, None, None, None, None, None, None, None, None),
    (7, LONG, "en", "c", 1, 1, "k", "x", "w", "l"),
    (8, "Émile É́ 漢字 😀 ΑΣ ß İ <|endoftext|> K\x0b\x1c x", "xx", "c", 1, 1, "k", "x", "w", "l"),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size int, `key` string, r string, words string, label string"


@pytest.fixture
def weird(spark):
    """Nulls everywhere, empty and very long texts, repeated rows and ids, extra columns of clashing names."""
    return spark.createDataFrame(WEIRD, SCHEMA)


@pytest.fixture
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def small_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def docs_list(spark, small_dir):
    rows = spark.read.parquet(f"{small_dir}/documents.parquet").select("doc_id", "text", "source").orderBy("doc_id").collect()
    return [tuple(r) for r in rows]
