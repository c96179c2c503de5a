"""Toxicity by a classifier chain: linear models in sequence, each fed the probabilities of those before it.

Categories are label columns in a stated order (here: low quality, then toxic). The model of category c sees the
text's features and, for every earlier category, its probability. In training those are
*out-of-fold*: ``FOLDS`` models are fitted, each without the rows it then predicts and over a vocabulary that was
chosen without them, so a later model learns from earlier predictions as unsure as they will be on new documents.
When documents are scored the chain uses each category's final model (fitted on all sample rows).

Features: words (runs of ASCII letters and digits and of bytes beyond ASCII, lower-cased) and their
first 4, 5 and 6 bytes, as 64-bit hashes with log(1 + count); plus a few shares (digits, punctuation, upper
case, word length, repetition). The vocabulary is the ``FEATURES`` hashes per category whose document
share differs most between the label's classes (z score, at least ``LEAST_DOCS`` documents), so a long
text meets no hash collisions with the weighted words.

The classifier is fitted on a bounded sample: the ``SAMPLE_ROWS`` labelled documents of smallest id hash. All documents
are scored, whole. Fitting happens on the driver on the sample's features (bounded by SAMPLE_ROWS and the vocabulary).

Cases: null or empty texts score by the intercepts and shares; rows with a null label are left out of that
category's fit; repeated label rows count once (the largest label), a label without a document is ignored; with
one class only, or no labels, the probability is the sample's share (0 without rows); null doc_ids
and repeated rows are scored like others; extra columns are ignored (kept by ``clean_documents``).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dugout.llm.common import ship_package, staged, text_or_empty
from dugout.llm.shingles import mix64, prefix_sums

SAMPLE_ROWS = 16_000
FOLDS = 5
FEATURES = 400
LEAST_DOCS = 3
L2 = 0.05
PREFIXES = (4, 5, 6)
THRESHOLD = 0.5
CATEGORIES = ("low_quality", "toxic")

_WORD_BYTE = np.zeros(256, bool)
_WORD_BYTE[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_DENSE = 5


def _runs(texts: list[str], batch_bytes: int = 1 << 20) -> Iterator[tuple[int, int]]:
    at = 0
    while at < len(texts):
        stop, held = at, 0
        while stop < len(texts) and (stop == at or held + len(texts[stop]) <= batch_bytes):
            held += len(texts[stop])
            stop += 1
        yield at, stop
        at = stop


def text_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text of each feature hash, the hash, dense features of each text): with repeats, in text order."""
    lowered = [t.lower().encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b"\n" + b"\n".join(lowered) + b"\n", np.uint8)
    inside = _WORD_BYTE[data]
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    start, end = edge[0::2], edge[1::2]
    prefix, inv = prefix_sums(data)
    size = end - start
    whole = mix64((prefix[end - 1] - prefix[start - 1]) * inv[start] + size.astype(np.uint64))
    ends = np.cumsum([len(r) + 1 for r in lowered])
    n = np.diff(np.searchsorted(start, np.concatenate(([0], ends))))
    text = np.repeat(np.arange(len(texts)), n)
    docs, hashes = [text], [whole]
    for p in PREFIXES:
        long = np.flatnonzero(size > p)
        s = start[long]
        docs.append(text[long])
        hashes.append(mix64((prefix[s + p - 1] - prefix[s - 1]) * inv[s] + np.uint64(p * 1_000_003)))
    chars = np.array([max(len(t), 1) for t in texts], float)
    count = lambda f: np.array([f(t) for t in texts], float)
    cum = np.concatenate(([0], np.cumsum((data >= 48) & (data <= 57))))
    digits = np.diff(cum[np.concatenate(([1], ends + 1))])
    cum = np.concatenate(([0], np.cumsum(~inside & (data > 32))))
    punct = np.diff(cum[np.concatenate(([1], ends + 1))])
    letters = np.bincount(text, weights=size, minlength=len(texts))
    dense = np.stack([digits / chars, punct / chars, count(lambda t: t.count("\n")) / chars,
                      letters / np.maximum(n, 1) / 10, np.log1p(n) / 10], axis=1)
    return np.concatenate(docs), np.concatenate(hashes), dense


def _counted(docs: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text, hash) with counts."""
    order = np.lexsort((hashes, docs))
    docs, hashes = docs[order], hashes[order]
    new = np.ones(len(docs), bool)
    new[1:] = (docs[1:] != docs[:-1]) | (hashes[1:] != hashes[:-1])
    at = np.flatnonzero(new)
    return docs[at], hashes[at], np.diff(np.append(at, len(docs)))


def _probability(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


@dataclass
class Chain:
    """A fitted chain: vocabulary (sorted hashes), and a weight vector per category over
    [vocabulary, dense, earlier probabilities, intercept]."""

    vocabulary: np.ndarray
    categories: tuple[str, ...]
    weights: list[np.ndarray] = field(default_factory=list)

    def __post_init__(self) -> None:
        self._maybe = np.zeros(1 << 20, bool)            # a quick test before the search
        self._maybe[self.vocabulary >> np.uint64(44)] = True

    def known(self, docs: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, vocabulary index, log(1 + count)) of the features that the vocabulary has."""
        some = np.flatnonzero(self._maybe[hashes >> np.uint64(44)])
        docs, hashes = docs[some], hashes[some]
        place = np.minimum(np.searchsorted(self.vocabulary, hashes), max(len(self.vocabulary) - 1, 0))
        ok = self.vocabulary[place] == hashes if len(self.vocabulary) else np.zeros(len(hashes), bool)
        d, v, n = _counted(docs[ok], place[ok])
        return d, v, np.log1p(n)

    def score(self, texts: list[str]) -> np.ndarray:
        """Probabilities [texts, categories], categories in turn."""
        out = np.zeros((len(texts), len(self.categories)))
        for lo, hi in _runs(texts):
            docs, hashes, dense = text_features(texts[lo:hi])
            d, v, x = self.known(docs, hashes)
            earlier: list[np.ndarray] = []
            for c, w in enumerate(self.weights):
                f = len(self.vocabulary)
                z = np.bincount(d, weights=x * w[v], minlength=hi - lo) + dense @ w[f:f + _DENSE] + w[-1]
                for e, p in enumerate(earlier):
                    z = z + p * w[f + _DENSE + e]
                earlier.append(_probability(z))
                out[lo:hi, c] = earlier[-1]
        return out


class _Rows:
    """Sample rows in compressed form, for matrix products."""

    def __init__(self, row: np.ndarray, col: np.ndarray, value: np.ndarray, dense: np.ndarray, n_words: int) -> None:
        self.row, self.col, self.value, self.dense, self.f = row, col, value, dense, n_words

    def take(self, keep: np.ndarray) -> _Rows:
        new = np.cumsum(keep) - 1
        m = keep[self.row]
        return _Rows(new[self.row[m]], self.col[m], self.value[m], self.dense[keep], self.f)

    def within(self, words: np.ndarray) -> _Rows:
        """Only the features whose place is marked, renumbered."""
        m = words[self.col]
        return _Rows(self.row[m], (np.cumsum(words) - 1)[self.col[m]], self.value[m], self.dense, int(words.sum()))

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights=self.value * w[self.col], minlength=len(self.dense)) + self.dense @ w[self.f:-1] + w[-1]

    def back(self, r: np.ndarray) -> np.ndarray:
        return np.concatenate([np.bincount(self.col, weights=self.value * r[self.row], minlength=self.f), self.dense.T @ r, [r.sum()]])


def fit_logistic(x: _Rows, y: np.ndarray, l2: float = L2, steps: int = 60, close: float = 1e-7) -> np.ndarray:
    """Weights of an L2-regularised logistic regression (L-BFGS, until a step gains less than ``close`` of the loss). One class only: its share as intercept."""
    width = x.f + x.dense.shape[1] + 1
    w = np.zeros(width)
    if len(y) == 0 or y.min() == y.max():
        w[-1] = 0.0 if len(y) and 0 < y.mean() < 1 else (30.0 if len(y) and y.mean() == 1 else -30.0)
        return w
    ridge = np.full(width, l2)
    ridge[-1] = 1e-6

    def loss(w: np.ndarray) -> tuple[float, np.ndarray]:
        z = x.dot(w)
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        return float(np.logaddexp(0, z).sum() - (y * z).sum() + 0.5 * (ridge * w * w).sum()), x.back(p - y) + ridge * w

    value, grad = loss(w)
    past: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        q, a = grad.copy(), []
        for s, g in reversed(past):
            a.append((s @ q) / (s @ g))
            q -= a[-1] * g
        q *= (past[-1][0] @ past[-1][1]) / (past[-1][1] @ past[-1][1]) if past else 1 / max(1.0, np.linalg.norm(grad))
        for (s, g), b in zip(past, reversed(a)):
            q += s * (b - (g @ q) / (s @ g))
        step = 1.0
        while step > 1e-8:
            new_value, new_grad = loss(w - step * q)
            if new_value <= value - 1e-4 * step * (grad @ q):
                break
            step /= 2
        else:
            return w
        s, g = -step * q, new_grad - grad
        if s @ g > 1e-12:
            past = [*past[-7:], (s, g)]
        done = value - new_value < close * max(1.0, abs(value))
        w, value, grad = w + s, new_value, new_grad
        if done:
            break
    return w


def sample_rows(docs: DataFrame, labels: DataFrame, categories=CATEGORIES, rows: int = SAMPLE_ROWS) -> DataFrame:
    """(doc_id, text, categories...): the labelled documents of smallest id hash, at most ``rows``."""
    wanted = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(*[F.max(c).cast("double").alias(c) for c in categories])
    texts = docs.select("doc_id", "text").where("doc_id IS NOT NULL")
    there = wanted.join(texts.select("doc_id").distinct(), "doc_id", "left_semi")
    chosen = there.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    return texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", *categories).agg(F.min("text").alias("text"))  # rows <= bound


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts = [t or "" for t in b.column("text").to_pylist()]
        for lo, hi in _runs(texts):
            docs, hashes, _ = text_features(texts[lo:hi])
            d, h, _ = _counted(docs, hashes)
            at = np.searchsorted(d, np.arange(hi - lo + 1))
            part = b.slice(lo, hi - lo).drop_columns(["text"])
            feats = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(h.view(np.int64)))
            yield pa.RecordBatch.from_arrays([*part.columns, feats], [*part.schema.names, "features"])


def vocabularies(sample: DataFrame, categories=CATEGORIES, features: int = FEATURES, folds: int = FOLDS) -> list[np.ndarray]:
    """The hashes whose document share differs most between the classes of a category, sorted: over all rows of the
    sample (with its fold), then over all but each fold's."""
    schema = ", ".join(f"{c} double" for c in categories) + ", fold long, features array<long>"
    rows = sample.select(*categories, F.col("fold").cast("long").alias("fold"), "text").mapInArrow(_feature_rows, schema)
    sums = [F.count("*").alias("df"), *[F.count(c).alias(f"n_{c}") for c in categories], *[F.sum(c).alias(f"p_{c}") for c in categories]]
    names = ["df", *[f"{x}_{c}" for x in "np" for c in categories]]
    total = {r["fold"]: r for r in sample.groupBy("fold").agg(*sums).collect()}          # a row a fold
    by_fold = rows.select(*categories, "fold", F.explode("features").alias("h")).groupBy("h", "fold").agg(*sums)
    # a hash's counts over all rows, and in each fold
    counts = by_fold.groupBy("h").agg(
        *[F.sum(x).alias(x) for x in names],
        *[F.sum(F.when(F.col("fold") == k, F.col(x)).otherwise(0)).alias(f"{x}_{k}") for k in range(folds) for x in names])
    counts = staged(counts.where(F.col("df") >= LEAST_DOCS), "toxicity-counts")
    out = []
    for k in [None, *range(folds)]:
        told = lambda x: F.coalesce(F.col(x), F.lit(0))
        left = counts.select("h", *[(told(x) if k is None else told(x) - told(f"{x}_{k}")).alias(x) for x in names])
        left = left.where(F.col("df") >= LEAST_DOCS)
        found: set[int] = set()
        for c in categories:
            n, p = (float(sum(r[f"{x}_{c}"] or 0 for f, r in total.items() if f != k)) for x in "np")
            if not 0 < p < n:
                continue
            share1, share0 = F.col(f"p_{c}") / p, (F.col(f"n_{c}") - F.col(f"p_{c}")) / (n - p)
            both = (F.col(f"n_{c}") + 1) / (n + 2)
            z = F.abs(share1 - share0) / F.sqrt(both * (1 - both) * (1 / p + 1 / (n - p)))
            found |= {r["h"] for r in left.orderBy(z.desc(), "h").limit(features).select("h").collect()}   # at most FEATURES
        out.append(np.sort(np.array(sorted(found), np.int64).view(np.uint64)))
    return out


def fit(docs: DataFrame, labels: DataFrame, categories=CATEGORIES, rows: int = SAMPLE_ROWS, features: int = FEATURES,
        folds: int = FOLDS) -> Chain:
    """Fit the chain on the bounded sample of labelled documents."""
    ship_package(docs.sparkSession)
    fold = F.pmod(F.xxhash64(F.col("doc_id").cast("long"), F.lit("fold")), F.lit(folds))
    sample = staged(sample_rows(docs, labels, categories, rows).withColumn("fold", fold), "toxicity-sample")
    chosen = vocabularies(sample, categories, features, folds)
    chain = Chain(chosen[0], tuple(categories))
    every = Chain(np.unique(np.concatenate(chosen)), tuple(categories))      # the hashes that any of the models has

    def known(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [t or "" for t in b.column("text").to_pylist()]
            for lo, hi in _runs(texts):
                hashed_docs, hashes, dense = text_features(texts[lo:hi])
                d, v, x = every.known(hashed_docs, hashes)
                at = pa.array(np.searchsorted(d, np.arange(hi - lo + 1)), pa.int32())
                part = b.slice(lo, hi - lo).drop_columns(["text"])
                more = [pa.ListArray.from_arrays(at, pa.array(v.astype(np.int64))), pa.ListArray.from_arrays(at, pa.array(x)),
                        pa.ListArray.from_arrays(pa.array(np.arange(hi - lo + 1) * _DENSE, pa.int32()), pa.array(dense.ravel()))]
                yield pa.RecordBatch.from_arrays([*part.columns, *more], [*part.schema.names, "at", "x", "dense"])

    schema = "doc_id long, fold long, " + ", ".join(f"{c} double" for c in categories) + ", at array<long>, x array<double>, dense array<double>"
    table = (sample.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("fold").cast("long").alias("fold"), *categories, "text")
             .mapInArrow(known, schema)
             .orderBy("doc_id").toArrow())                  # at most ``rows`` rows of the vocabulary's features
    n = table.num_rows
    if n == 0:
        chain.weights = [np.concatenate([np.zeros(len(chain.vocabulary) + _DENSE + c), [-30.0]]) for c in range(len(categories))]
        return chain
    at, x = table.column("at").combine_chunks(), table.column("x").combine_chunks()
    flat = lambda a: (a.chunk(0) if isinstance(a, pa.ChunkedArray) else a)
    row = np.repeat(np.arange(n), np.diff(flat(at).offsets.to_numpy()))
    dense = flat(table.column("dense").combine_chunks()).flatten().to_numpy().reshape(n, _DENSE)
    col, value = flat(at).flatten().to_numpy(), flat(x).flatten().to_numpy()
    fold = table.column("fold").to_numpy()
    marks = [np.isin(every.vocabulary, words) for words in chosen]
    earlier: list[np.ndarray] = []
    for c in categories:
        y = table.column(c).to_numpy(zero_copy_only=False).astype(float)
        x_all = _Rows(row, col, value, np.column_stack([dense, *earlier]) if earlier else dense, len(every.vocabulary))
        told = ~np.isnan(y)
        chain.weights.append(fit_logistic(x_all.within(marks[0]).take(told), y[told]))
        out_of_fold = np.zeros(n)
        for k in range(folds):
            out = fold == k
            if out.any():
                x = x_all.within(marks[k + 1])
                out_of_fold[out] = _probability(x.take(out).dot(fit_logistic(x.take(told & ~out), y[told & ~out])))
        earlier.append(out_of_fold)
    return chain


def score(docs: DataFrame, chain: Chain, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, text_id, p_<category>..., toxic): every document, its whole text. toxic: last category at threshold or more."""
    held = docs.sparkSession.sparkContext.broadcast(chain)      # vocabulary and weights: at most a few hundred KB

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            p = held.value.score([t or "" for t in b.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("text_id"), *[pa.array(p[:, c]) for c in range(p.shape[1])], pa.array(p[:, -1] >= threshold)],
                ["doc_id", "text_id", *[f"p_{c}" for c in chain.categories], "toxic"])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text_or_empty()).alias("text_id"), "text")
            .mapInArrow(scored, "doc_id long, text_id long, " + ", ".join(f"p_{c} double" for c in chain.categories) + ", toxic boolean"))


def with_categories(labels: DataFrame) -> DataFrame:
    """The label table's columns as chain categories: low_quality (quality 0), toxic."""
    return labels.select("doc_id", (1 - F.col("quality")).alias("low_quality"), F.col("toxic"))


def clean_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **options) -> DataFrame:
    """The documents that the chain does not call toxic, all columns as they are. One pass over the texts, no shuffle."""
    chain = fit(docs, labels, **options)
    held = docs.sparkSession.sparkContext.broadcast(chain)

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            p = held.value.score([t or "" for t in b.column("text").to_pylist()])
            yield b.filter(pa.array(p[:, -1] < threshold))

    return docs.mapInArrow(kept, docs.schema)
