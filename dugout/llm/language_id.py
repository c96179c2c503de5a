"""Language identification by nearest centroid over character n-grams.

1. *Features.* Letters and marks (Unicode L, M) lower-cased, everything else one space; character n-grams of 1 to 3,
   hashed to ``DIM`` places; (1 + log count) x idf, scaled to unit length.
2. *Document frequencies* are counted over all learning documents, one row of counts a task and place.
3. *Centroids.* Each language's sample (about ``PER_LANGUAGE`` documents, chosen by hash with the language's own rate, all
   of them if there are fewer) is clustered by spherical k-means into ``CENTROIDS`` unit centroids, a language a task.
4. *Prediction.* Every document, its whole text, against all centroids by cosine: the language of the nearest one.
5. *Rejection.* Distances (1 - cosine) of all learning documents to their own language's nearest centroid are counted in
   bins by language and text size; a document farther off than the bin at ``QUANTILE`` of its predicted language and
   size is rejected.

The learning documents have a lang, a text with a letter, and crc32(doc_id as text) mod 5 other than 0. Predictions
see the text only. The centroids broadcast are 128 KB a language.

Cases: null texts and texts without letters predict ``und`` with score 0 and are rejected; so are all without learning
documents. Null doc_ids are predicted, not learned from, and not held out. Equal cosines go to the first language by
code point. Repeated rows are predicted each; a text is counted as often as it stands, sampled once. Texts of over
``SEGMENT`` characters are counted segment by segment, a cut being a space. Extra columns are ignored.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dugout.llm.common import ship_package, staged

DIM = 1 << 13
GRAMS = (1, 2, 3)
CENTROIDS = 4
PER_LANGUAGE = 600
ITERATIONS = 12
FOLDS = 5
QUANTILE = 0.999
BINS = 1000
SEGMENT = 1 << 20
UNKNOWN = "und"
_ROWS = 128                      # texts counted at once


@cache
def _kinds() -> np.ndarray:
    """For each code point: 1 letter, 2 mark, else 0."""
    kinds = np.zeros(0x110000, np.uint8)
    for c in range(0x110000):
        first = unicodedata.category(chr(c))[0]
        kinds[c] = 1 if first == "L" else 2 if first == "M" else 0
    return kinds


def _gram_counts(pieces: list[str], rows: np.ndarray, n_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """(n-gram counts [n_rows, DIM], whether each row has a letter) of pieces of texts and the rows they belong to."""
    padded = [f" {p.lower()} " for p in pieces]
    code = np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), np.uint32)
    piece = np.repeat(np.arange(len(pieces)), [len(p) for p in padded])
    kind = _kinds()[code]
    inside = kind > 0
    keep = inside.copy()
    keep[1:] |= inside[:-1]                                  # one space after a word
    keep[np.flatnonzero(np.diff(piece, prepend=-1))] = True  # and one before the first
    letter = np.zeros(n_rows, bool)
    letter[rows[piece[kind == 1]]] = True
    code = np.where(inside, code, np.uint32(32))[keep]
    piece = piece[keep]
    row = rows[piece] * DIM
    counts = np.zeros(n_rows * DIM, np.int32)
    shift = np.uint32(32 - DIM.bit_length() + 1)
    h = np.zeros(len(code), np.uint32)
    for n in range(1, max(GRAMS) + 1):
        m = len(code) - n + 1
        if m <= 0:
            break
        h = (h[:m] + code[n - 1:]) * np.uint32(0x9E3779B1)
        h ^= h >> np.uint32(15)
        if n in GRAMS:
            whole = piece[:m] == piece[n - 1:]
            if n == 1:
                whole &= code != 32
            place = ((h * np.uint32(0x85EBCA6B)) >> shift).astype(np.int64)
            counts += np.bincount((place + row[:m])[whole], minlength=len(counts)).astype(np.int32)
    return counts.reshape(n_rows, DIM), letter


def count_grams(texts: list[str | None]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first text, counts, has a letter) for runs of at most 128 texts and about a million characters."""
    at = 0
    while at < len(texts):
        stop, held = at, 0
        while stop < len(texts) and stop - at < _ROWS and (stop == at or held + len(texts[stop] or "") <= SEGMENT):
            held += len(texts[stop] or "")
            stop += 1
        if stop == at + 1 and held > SEGMENT:
            counts, letter = np.zeros((1, DIM), np.int32), np.zeros(1, bool)
            for lo in range(0, held, SEGMENT):
                c, has = _gram_counts([texts[at][lo:lo + SEGMENT]], np.zeros(1, np.int64), 1)
                counts, letter = counts + c, letter | has
        else:
            counts, letter = _gram_counts([t or "" for t in texts[at:stop]], np.arange(stop - at), stop - at)
        yield at, counts, letter
        at = stop


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Unit TF-IDF vectors [texts, DIM]; zero without n-grams."""
    out = np.zeros(counts.shape, np.float32)
    held = np.nonzero(counts)
    out[held] = (1 + np.log(counts[held])) * idf[held[1]]
    size = np.sqrt((out * out).sum(axis=1, keepdims=True))
    return out / np.maximum(size, np.float32(1e-30))


# ---------------------------------------------------------------- learning

def remainder(doc_id: str | Column = "doc_id") -> Column:
    return F.crc32((F.col(doc_id) if isinstance(doc_id, str) else doc_id).cast("string")) % FOLDS


def learning(docs: DataFrame) -> DataFrame:
    """(doc_id, text, lang) of the documents that may be learned from."""
    return docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (remainder() != 0)).select("doc_id", "text", "lang")


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, n = np.zeros(DIM, np.int64), 0
    for b in batches:
        for _, counts, letter in count_grams(b.column("text").to_pylist()):
            total += (counts > 0).sum(axis=0)
            n += int(letter.sum())
    held = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(held, -1), pa.int64()), pa.array(np.append(total[held], n), pa.int64())], ["place", "n"])


def inverse_frequencies(learn: DataFrame) -> np.ndarray:
    """idf of each place over all learning documents."""
    rows = learn.select("text").mapInArrow(_frequencies, "place long, n long").groupBy("place").agg(F.sum("n").alias("n")).collect()  # DIM + 1 rows
    got = {r["place"]: r["n"] for r in rows}
    df = np.array([got.get(i, 0) for i in range(DIM)], float)
    return (np.log((1 + got.get(-1, 0)) / (1 + df)) + 1).astype(np.float32)


def language_sample(learn: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """(lang, doc_id, text): all of a language's documents, or about ``per_language`` of them by hash; repeated rows once."""
    share = learn.groupBy("lang").agg(F.least(F.lit(1.0), F.lit(float(per_language)) / F.count("*")).alias("share"))
    place = F.xxhash64("doc_id", "text")
    hashed = learn.withColumn("place", place).join(F.broadcast(share), "lang")          # a row for each language
    return hashed.where(F.pmod("place", F.lit(1 << 30)) < F.col("share") * float(1 << 30)).dropDuplicates(["lang", "place"]).select("lang", "place", "text")


def _cluster(vectors: np.ndarray, k: int, iterations: int) -> np.ndarray:
    """Unit centroids of spherical k-means; starts at the mean's nearest, then at the farthest from those so far."""
    mean = vectors.mean(axis=0)
    chosen = [int((vectors @ mean).argmax())]
    near = vectors @ vectors[chosen[0]]
    while len(chosen) < k and near.min() < 1 - 1e-6:
        chosen.append(int(near.argmin()))
        near = np.maximum(near, vectors @ vectors[chosen[-1]])
    centres = vectors[chosen]
    for _ in range(iterations):
        of = (vectors @ centres.T).argmax(axis=1)
        new = np.stack([vectors[of == c].sum(axis=0) if (of == c).any() else centres[c] for c in range(len(centres))])
        new /= np.maximum(np.linalg.norm(new, axis=1, keepdims=True), 1e-30)
        if np.allclose(new, centres, atol=1e-7):
            break
        centres = new
    return centres


@dataclass
class Model:
    """Languages in code point order, the language of each centroid, unit centroids, idf."""

    langs: list[str]
    of: np.ndarray
    centres: np.ndarray
    idf: np.ndarray

    def nearest(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(best language of each text, cosine to each language's nearest centroid [texts, langs])."""
        cosine = weighted(counts, self.idf) @ self.centres.T
        by = np.stack([cosine[:, self.of == i].max(axis=1) for i in range(len(self.langs))], axis=1)
        return by.argmax(axis=1), by


def fit(docs: DataFrame, centroids: int = CENTROIDS, per_language: int = PER_LANGUAGE, iterations: int = ITERATIONS) -> Model:
    """Learn idf from all learning documents, centroids from each language's sample."""
    ship_package(docs.sparkSession)
    learn = learning(docs)
    idf = inverse_frequencies(learn)
    sample = staged(language_sample(learn, per_language), "language-sample")

    def cluster(rows: pd.DataFrame) -> pd.DataFrame:
        found = [weighted(c, idf)[has] for _, c, has in count_grams(rows.sort_values("place")["text"].tolist())]
        vectors = np.concatenate(found) if found else np.zeros((0, DIM), np.float32)
        centres = _cluster(vectors, centroids, iterations) if len(vectors) else vectors
        return pd.DataFrame({"lang": [rows["lang"].iloc[0]] * len(centres), "centre": [c.astype(np.float32) for c in centres]})

    rows = sample.groupBy("lang").applyInPandas(cluster, "lang string, centre array<float>").collect()  # CENTROIDS rows a language
    langs = sorted({r["lang"] for r in rows})
    rows.sort(key=lambda r: r["lang"])
    centres = np.array([r["centre"] for r in rows], np.float32).reshape(len(rows), DIM)
    return Model(langs, np.array([langs.index(r["lang"]) for r in rows], np.int64), centres, idf)


# ---------------------------------------------------------------- prediction

def _distances(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang, learned, lang_pred, score, distance, own_distance, size) for every document."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        place = {lang: i for i, lang in enumerate(m.langs)}
        for b in batches:
            texts = b.column("text").to_pylist()
            labels = b.column("label").to_pylist()
            for at, counts, letter in count_grams(texts):
                n = len(letter)
                part = b.slice(at, n)
                told = letter & bool(m.langs)
                best, by = m.nearest(counts) if m.langs else (np.zeros(n, int), np.zeros((n, 1), np.float32))
                cosine = np.where(told, by[np.arange(n), best], 0).astype(float)
                own = [None if not told[i] or labels[at + i] not in place else 1 - float(by[i, place[labels[at + i]]]) for i in range(n)]
                size = np.log2(1 + counts.sum(axis=1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("held_out"), part.column("label"),
                     pa.array([m.langs[k] if t else UNKNOWN for k, t in zip(best, told)], pa.string()),
                     pa.array(np.clip(cosine, 0, 1)), pa.array([float(1 - c) if t else None for c, t in zip(cosine, told)], pa.float64()),
                     pa.array(own, pa.float64()), pa.array(size)],
                    ["doc_id", "held_out", "label", "lang_pred", "score", "distance", "own_distance", "size"])

    label = F.when(F.col("text").isNotNull() & (remainder() != 0), F.col("lang")).alias("label")     # for the thresholds only
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(remainder() == 0, F.lit(False)).alias("held_out"), label, "text")
            .mapInArrow(predict, "doc_id long, held_out boolean, label string, lang_pred string, score double, distance double,"
                                 " own_distance double, size int"))


def identify(docs: DataFrame, model: Model | None = None, quantile: float = QUANTILE) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, distance, rejected): every document.

    lang_pred: language of the nearest centroid. score: its cosine. rejected: farther off than ``quantile`` of the
    learning documents of that language and size, or nothing to compare.
    """
    ship_package(docs.sparkSession)
    found = staged(_distances(docs, model or fit(docs)), "language-distances")
    bins = (found.where("own_distance IS NOT NULL").groupBy(F.col("label").alias("lang_pred"), "size", F.floor(F.col("own_distance") * BINS).alias("bin"))
            .agg(F.count("*").alias("m")))
    # a row for each language, size and bin of distance: as many whatever the input
    upto = F.sum("m").over(_by().orderBy("bin"))
    limits = (bins.withColumn("upto", upto).withColumn("all", F.sum("m").over(_by()))
              .where(F.col("upto") >= F.col("all") * quantile).groupBy("lang_pred", "size").agg(((F.min("bin") + 1) / BINS).alias("farthest")))
    return (found.join(F.broadcast(limits), ["lang_pred", "size"], "left")
            .select("doc_id", "held_out", "lang_pred", "score", "distance",
                    (F.col("distance").isNull() | (F.col("distance") > F.coalesce("farthest", F.lit(2.0)))).alias("rejected")))


def _by():
    from pyspark.sql import Window
    return Window.partitionBy("lang_pred", "size")
