import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from dugout.llm import toxicity as T


def corpus(n, seed):
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        w = [f"tok{rng.randrange(400)}" for _ in range(rng.randrange(5, 60))]
        junk, toxic = rng.random() < 0.3, False
        if junk:
            w += ["$$$!!", "zzjunk"] * 3
        if rng.random() < (0.6 if junk else 0.1):
            toxic = True
            w.insert(rng.randrange(len(w)), rng.choice(["vilest", "vilething", "vilerly", "awfulness"]))
        docs.append((i, " ".join(w)))
        labels.append((i, 0 if junk else 1, int(toxic)))
    return docs, labels


@pytest.fixture(scope="module")
def fitted(spark):
    docs, labels = corpus(600, 1)
    d = spark.createDataFrame(docs, "doc_id long, text string")
    lab = T.with_categories(spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    return T.fit(d, lab)


def test_held_out_accuracy(spark, fitted):
    docs, labels = corpus(400, 2)
    got = {r["doc_id"]: r for r in T.score(spark.createDataFrame(docs, "doc_id long, text string"), fitted).collect()}
    assert np.mean([got[i]["toxic"] == bool(t) for i, _, t in labels]) > 0.97
    assert np.mean([(got[i]["p_low_quality"] >= 0.5) == (q == 0) for i, q, _ in labels]) > 0.97


def test_chain_feeds_earlier_probabilities(fitted):
    f = len(fitted.vocabulary)
    assert [len(w) for w in fitted.weights] == [f + T._DENSE + 1, f + T._DENSE + 2]
    assert fitted.weights[1][f + T._DENSE] > 0          # low quality makes toxicity likelier in this corpus


def test_held_out_on_the_tables(spark):
    d = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    chain = T.fit(docs, T.with_categories(labels.where("doc_id % 3 <> 0")))
    held = labels.where("doc_id % 3 = 0").withColumnRenamed("toxic", "truth")
    rows = T.score(docs, chain).join(held, "doc_id").select("toxic", "truth").collect()
    hits = sum(r["toxic"] and r["truth"] == 1 for r in rows)
    assert hits >= 0.9 * sum(r["truth"] == 1 for r in rows)
    assert sum(r["toxic"] and r["truth"] == 0 for r in rows) <= 0.01 * len(rows)


def test_logistic_matches_gradient_zero():
    rng = np.random.default_rng(0)
    dense = rng.normal(size=(200, 3))
    y = (dense[:, 0] + 0.3 * rng.normal(size=200) > 0).astype(float)
    x = T._Rows(np.zeros(0, int), np.zeros(0, int), np.zeros(0), dense, 0)
    w = T.fit_logistic(x, y)
    p = 1 / (1 + np.exp(-x.dot(w)))
    assert np.abs(dense.T @ (p - y) + T.L2 * w[:-1]).max() < 0.05 and abs((p - y).sum()) < 0.05


def test_odd_rows(spark, weird, nothing):
    labels = spark.createDataFrame([(5, 1, 0), (5, 1, 1), (6, 0, None), (None, 1, 1), (99, 1, 1), (7, None, 0)], "doc_id long, quality int, toxic int")
    chain = T.fit(weird, T.with_categories(labels))
    rows = T.score(weird, chain).collect()
    assert len(rows) == weird.count() and all(0 <= r["p_toxic"] <= 1 for r in rows)
    none = T.with_categories(labels.where("doc_id = 1000"))
    assert not any(r["toxic"] for r in T.score(weird, T.fit(weird, none)).collect())
    out = T.clean_documents(weird, none)
    assert out.columns == weird.columns and out.count() == weird.count()
    assert T.clean_documents(nothing, T.with_categories(labels)).collect() == []


def test_features_do_not_depend_on_batching():
    texts = ["Vile words, here", "", "é漢 x", "The end " * 50]
    whole = T.text_features(texts)
    for i, t in enumerate(texts):
        d, h, dense = T.text_features([t])
        assert sorted(h.tolist()) == sorted(whole[1][whole[0] == i].tolist())
        assert np.allclose(dense[0], whole[2][i])


def plain_features(text):
    """Words and their first 4, 5 and 6 bytes with log(1 + count), and the shares, by regular expressions."""
    raw = text.lower().encode()
    found = re.findall(rb"[0-9A-Za-z\x80-\xff]+", raw)
    count = Counter((None, w) for w in found) + Counter((p, w[:p]) for w in found for p in T.PREFIXES if len(w) > p)
    chars = max(len(text), 1)
    shares = [len(re.findall(rb"[0-9]", raw)) / chars, len(re.findall(rb"[^0-9A-Za-z\x80-\xff\x00-\x20]", raw)) / chars,
              text.count("\n") / chars, sum(map(len, found)) / max(len(found), 1) / 10, math.log1p(len(found)) / 10]
    return {f: math.log1p(n) for f, n in count.items()}, shares


def plain_logistic(x, y):
    """Newton's method on the same convex loss."""
    x = np.column_stack([x, np.ones(len(x))])
    ridge = np.full(x.shape[1], T.L2)
    ridge[-1] = 1e-6
    w = np.zeros(x.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x.T * (p * (1 - p))) @ x + np.diag(ridge), x.T @ (p - y) + ridge * w)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return w


def test_against_a_plain_chain(spark, monkeypatch):
    """Every model, fold and link of the chain recomputed plainly (all features kept, so no choice depends on hashes; both
    sides fitted until they stand still)."""
    real = T.fit_logistic
    monkeypatch.setattr(T, "fit_logistic", lambda x, y: real(x, y, steps=3000, close=1e-14))
    docs, labels = corpus(240, 3)
    new = [(1000 + i, t) for i, t in corpus(120, 4)[0]]
    table = spark.createDataFrame(docs, "doc_id long, text string")
    chain = T.fit(table, T.with_categories(spark.createDataFrame(labels, "doc_id long, quality int, toxic int")), features=1_000_000)
    fold = np.array([r["f"] for r in table.orderBy("doc_id").select(
        T.F.pmod(T.F.xxhash64("doc_id", T.F.lit("fold")), T.F.lit(T.FOLDS)).alias("f")).collect()])
    feats, later = [plain_features(t) for _, t in docs], [plain_features(t) for _, t in new]

    def matrix(rows, train):
        df = Counter(f for i in train for f in feats[i][0])
        place = {f: i for i, f in enumerate(sorted((f for f, n in df.items() if n >= T.LEAST_DOCS), key=str))}
        x = np.zeros((len(rows), len(place) + 5))
        for i, (held, shares) in enumerate(rows):
            for f, v in held.items():
                if f in place:
                    x[i, place[f]] = v
            x[i, -5:] = shares
        return x

    everyone = range(len(docs))
    folded, final, got = np.zeros((len(docs), 0)), np.zeros((len(new), 0)), T.score(spark.createDataFrame(new, "doc_id long, text string"), chain)
    got = {r["doc_id"]: r for r in got.collect()}
    for name, y in (("low_quality", [1 - q for _, q, _ in labels]), ("toxic", [t for _, _, t in labels])):
        y = np.array(y, float)
        use = lambda rows, train, more, w: 1 / (1 + np.exp(-(np.column_stack([matrix(rows, train), more, np.ones(len(rows))]) @ w)))
        p = use(later, everyone, final, plain_logistic(np.column_stack([matrix(feats, everyone), folded]), y))
        assert np.abs(p - [got[d][f"p_{name}"] for d, _ in new]).max() < 1e-3
        oof = np.zeros(len(docs))
        for k in range(T.FOLDS):
            train, out = np.flatnonzero(fold != k), np.flatnonzero(fold == k)
            w = plain_logistic(np.column_stack([matrix(feats, train)[train], folded[train]]), y[train])
            oof[out] = use([feats[i] for i in out], train, folded[out], w)
        folded, final = np.column_stack([folded, oof]), np.column_stack([final, p])


def test_a_fold_has_no_say_in_its_vocabulary(spark):
    docs, labels = corpus(200, 5)
    rows = [(i, t + (" onlyhere" if i % 5 == 2 else ""), float(q == 0), float(i % 5 == 2), i % 5) for (i, t), (_, q, _) in zip(docs, labels)]
    sample = spark.createDataFrame(rows, "doc_id long, text string, low_quality double, toxic double, fold long")
    found = T.vocabularies(sample, features=50)
    _, hashes, _ = T.text_features(["onlyhere"])
    assert np.isin(hashes, found[0]).any() and not np.isin(hashes, found[3]).any() and np.isin(hashes, found[1]).any()
