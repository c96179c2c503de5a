"""Language identification: held-out accuracy, what it learns from, its cases, and its counts against plain ones."""

import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from dugout.llm import language_id


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


@pytest.fixture(scope="module")
def model(docs):
    return language_id.fit(docs)


def test_held_out_accuracy(docs, model):
    got = language_id.identify(docs, model).alias("g").join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    held = got[got["held_out"] & got["lang"].notna()]
    assert len(held) > 100 and (held["lang"] == held["lang_pred"]).mean() > 0.95
    assert got["score"].between(0, 1).all() and got["rejected"].mean() < 0.05
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for _, r in got.iterrows())


def test_prediction_sees_the_text_only(spark, docs, model):
    some = docs.where("length(text) < 3000").limit(60)
    blind = some.select((F.col("doc_id") * 0 + 1).alias("doc_id"), "text", F.lit(None).cast("string").alias("lang"), F.lit("s").alias("source"))
    key = lambda rows: sorted((r["score"], r["lang_pred"]) for r in rows)
    assert key(language_id.identify(some, model).collect()) == key(language_id.identify(blind, model).collect())


def test_other_remainder_and_null_lang_are_not_learned(spark):
    rows = [(i, "alpha beta gamma", "aa") for i in range(40)] + [(i, "ομεγα δελτα", None) for i in range(40, 80)]
    rows = [(i, t, lang if zlib.crc32(str(i).encode()) % 5 else "held") for i, t, lang in rows]
    got = language_id.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert got.langs == ["aa"]


def test_noise_is_rejected(spark, docs, model):
    noise = spark.createDataFrame([(-1, "qxzj wkvq zzxq jjkw " * 40, None), (-2, "漢字仮名" * 100, None)], "doc_id long, text string, lang string")
    got = language_id.identify(docs.select("doc_id", "text", "lang").unionByName(noise), model).where("doc_id < 0").collect()
    assert len(got) == 2 and all(r["rejected"] for r in got) and all(r["lang_pred"] in model.langs for r in got)


def test_counts_of_long_texts_and_batches_are_the_same():
    texts = ["Ab c", "", "ÉÉ x2y", None, "a" * 10]
    alone = np.concatenate([next(language_id.count_grams([t]))[1] for t in texts])
    together = next(language_id.count_grams(texts))[1]
    assert (alone == together).all()
    words = sum(len(w) + max(len(w) + 1, 0) + len(w) for w in ["ab", "c"])     # n letters, n + 1 pairs, n triples with the spaces
    assert together[0].sum() == words + 1                                         # and the triple across the inner space
    long = "abc d " * (language_id.SEGMENT // 3)
    assert abs(int(next(language_id.count_grams([long]))[1].sum()) - len(long) // 6 * 16) < 20


def test_idf_is_over_all_learning_documents(spark):
    docs = spark.createDataFrame([(1, "aa", "x"), (2, "aa b", "x"), (3, "b", "y"), (4, "", "y")], "doc_id long, text string, lang string")
    idf = language_id.inverse_frequencies(docs)
    counts = next(language_id.count_grams(["b"]))[1][0]
    assert np.allclose(idf[counts > 0], math.log(4 / 3) + 1)


def test_cases(spark, weird, nothing):
    got = language_id.identify(weird).toPandas()
    assert len(got) == weird.count()
    empty = got[got["doc_id"].isin([1, 2, 3])]
    assert (empty["lang_pred"] == "und").all() and (empty["score"] == 0).all() and empty["rejected"].all()
    assert set(got["lang_pred"]) <= {"en", "xx", "und"}
    assert language_id.identify(nothing).collect() == []
    none = weird.withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in language_id.identify(none).collect()} == {"und"}
