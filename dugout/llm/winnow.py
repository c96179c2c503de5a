"""Document fingerprints by winnowing.

A text's k-grams of code points (k = ``K``) are hashed with a rolling polynomial; of every ``WINDOW`` consecutive
hashes the smallest is marked, the rightmost of equals, with its position. Every common stretch of
``WINDOW + K - 1`` code points therefore shares a marked gram at the same place in both texts, and no
stretch shorter than K is ever matched by chance of layout.

Neighbours: ``edited_pairs`` needs each document and the next by doc_id. Texts are shuffled once (range-partitioned
and sorted by doc_id); each task walks its documents with the next one in hand, and only the first and
last document of every partition are met again in a second, small step.

Cases: null counts as empty; an empty text has no marks and is alike (1.0) only to texts without marks; a
text of fewer than K code points is one gram, one of fewer than WINDOW grams one window; null doc_ids come first;
rows of equal doc_id are ordered by text hash, equal rows are interchangeable; a single document is its own next; an
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from dugout.llm.common import ship_package, shuffle_partitions, staged, text_or_empty
from dugout.llm.shingles import mix64, powers

K = 20
WINDOW = 21


def gram_hashes(text: str, k: int = K) -> np.ndarray:
    """64-bit hash of every k-gram of code points; of the whole text if it is shorter; none if it is empty."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    n = len(points)
    if n == 0:
        return np.zeros(0, np.uint64)
    k = min(k, n)
    fwd, inv = powers(n)
    prefix = np.zeros(n + 1, np.uint64)
    np.cumsum((points.astype(np.uint64) + np.uint64(0x9E37)) * fwd[:n], out=prefix[1:])
    return mix64((prefix[k:] - prefix[:-k]) * inv[:n - k + 1])


def winnow(text: str, k: int = K, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, positions) of the marked grams, by position."""
    hashes = gram_hashes(text, k)
    n = len(hashes)
    if n == 0:
        return hashes, np.zeros(0, np.int64)
    # the upper half of the hash orders grams; below it the position, counted down, puts the rightmost first
    last = np.uint64(0xFFFFFFFF)
    best = (hashes & ~last) | (last - np.arange(n, dtype=np.uint64))
    window, span = min(window, n), 1
    while span < window:
        step = min(span, window - span)
        best = np.minimum(best[:-step], best[step:])
        span += step
    marked = np.unique((last - (best & last)).astype(np.int64))
    return hashes[marked], marked


def digest(hashes: np.ndarray, positions: np.ndarray) -> str:
    """The marks, positions included, as 32 hex digits."""
    return hashlib.blake2b(hashes.astype("<u8").tobytes() + positions.astype("<u8").tobytes(), digest_size=16).hexdigest()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Shared distinct marked hashes over all of them; two texts without marks are alike."""
    a, b = np.unique(a), np.unique(b)
    if not len(a) and not len(b):
        return 1.0
    if not len(a) or not len(b):
        return 0.0
    place = np.minimum(np.searchsorted(a, b), len(a) - 1)
    common = int((a[place] == b).sum())
    return common / (len(a) + len(b) - common)


def edited(text: str, other: str) -> str:
    """``text`` with its last half replaced by as many first code points of ``other`` (or all it has)."""
    half = len(text) // 2
    return text[:len(text) - half] + other[:half]


def _marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        hashes, places = zip(*[winnow(t or "") for t in b.column("text").to_pylist()]) if b.num_rows else ((), ())
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([h.view(np.int64) for h in hashes], pa.list_(pa.int64())),
                                          pa.array(list(places), pa.list_(pa.int64()))], ["doc_id", "hashes", "positions"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, hashes, positions): the marked grams of every whole text."""
    ship_package(docs.sparkSession)
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
            .mapInArrow(_marks, "doc_id long, hashes array<long>, positions array<long>"))


_ROW = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double, n_marks long")
_COLUMNS = [c.split()[0] for c in _ROW.split(", ")]


def _judged(doc_id: int | None, text: str, marks: tuple, other: str, other_marks: tuple) -> tuple:
    new = edited(text, other)
    new_marks = marks if new == text else winnow(new)
    return (doc_id, len(text), hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest(), digest(*marks), digest(*new_marks),
            likeness(marks[0], new_marks[0]), likeness(marks[0], other_marks[0]), len(marks[0]))


def _batch(rows: list[tuple], shard: int, side: str | None = None, texts: list[str] | None = None) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int64()]
    cols = [pa.array([r[i] for r in rows], kinds[i]) for i in range(len(kinds))]
    n = len(rows)
    return pa.RecordBatch.from_arrays([*cols, pa.array([shard] * n, pa.int64()), pa.array([side] * n, pa.string()),
                                       pa.array(texts or [None] * n, pa.string())], [*_COLUMNS, "shard", "side", "text"])


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted documents -> a row for each but the last; the first and last as open rows with their text."""
    shard, held, done = TaskContext.get().partitionId(), None, []
    opened = lambda side, d: _batch([(d[0], None, None, None, None, None, None, None)], shard, side, [d[1]])
    for b in batches:
        for doc_id, text in zip(b.column("doc_id"), b.column("text")):
            now = (doc_id.as_py(), text.as_py(), None)
            now = (now[0], now[1], winnow(now[1]))
            if held is None:
                yield opened("first", now)
            else:
                done.append(_judged(held[0], held[1], held[2], now[1], now[2]))
                if len(done) >= 2000:
                    yield _batch(done, shard)
                    done = []
            held = now
    if done:
        yield _batch(done, shard)
    if held is not None:
        yield opened("last", held)


def _close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = [_judged(r["doc_id"], r["text"], winnow(r["text"]), r["other"], winnow(r["other"])) for r in b.to_pylist()]
        if rows:
            yield _batch(rows, 0).select(_COLUMNS)


def edited_pairs(docs: DataFrame, shards: int | None = None) -> DataFrame:
    """A row per document: its fingerprint, that of its edited text, and likeness to that and to the next document."""
    spark = docs.sparkSession
    ship_package(spark)
    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
            .withColumn("tie", F.xxhash64("text"))
            .repartitionByRange(shards or shuffle_partitions(spark), F.col("doc_id").asc_nulls_first(), "tie")
            .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "tie"))
    walked = staged(rows.select("doc_id", "text").mapInArrow(_walk, f"{_ROW}, shard long, side string, text string"), "winnow-walked")
    first = walked.where("side = 'first'").select(F.col("shard").alias("next"), F.col("text").alias("other"))
    last = walked.where("side = 'last'").select("shard", "doc_id", "text")
    # the next shard that has documents, after the last the first: one row per shard
    order = W.orderBy("shard")
    after = (first.select(F.col("next").alias("shard"))
             .withColumn("next", F.coalesce(F.lead("shard").over(order), F.min("shard").over(order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)))))
    closing = (last.join(after, "shard").join(first, "next").select("doc_id", "text", "other")
               .mapInArrow(_close, _ROW))
    return walked.where("side IS NULL").select(*_COLUMNS).unionByName(closing)
