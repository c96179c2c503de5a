"""N-gram Jaccard self-join with Bayesian candidate pruning.

Documents are sets of word shingles (five words); two are linked when their Jaccard similarity is t or
more. The output is one row per document: its class (connected component), its copy class and its
number of links; copies are never expanded into pairs.

1. *Signatures.* One pass gives each text the key of its shingle set (128 bits) and ``HASHES`` MinHash
   values. Texts of equal sets are one copy class (similarity 1); the rest runs on classes.
2. *Candidates.* MinHash values are cut into bands of four; classes that agree in a band share a
   bucket. Each pair is compared in the first band it shares only. (A pair of similarity 0.8
   shares none of the 32 bands with probability 5e-8.)
3. *Bayesian pruning.* The pair's MinHash values are compared ``STEP`` at a time. After n values, m of them
   equal, the posterior of the similarity under a uniform prior is Beta(m + 1, n - m + 1); the pair is
   dropped when P(similarity >= t) < ``TOLERANCE``.
4. *Exact check.* Survivors are gathered by connected candidate groups; their shingle sets are met in
   tasks, again pruned, and the rest are verified exactly.

No pair is ever a row. A bucket or group is dealt out in blocks of bounded rows and shingles, and each
pair of blocks is a task of its own that returns a row per linked member: its links and one edge of
a spanning forest. So a large group of near copies costs its comparisons, but no memory in proportion; its m members
are copied to all blocks they meet, m * m / BLOCK_ROWS rows that pass the shuffle and are never kept.

Cases: a text of 1-4 words is one shingle; null texts and texts without words link to nothing (a class
each); null doc_ids are linked like others, a class without any doc_id reports null; repeated rows are
copies; extra columns are ignored (kept by ``one_of_each``); an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dugout.llm.common import ship_package, shuffle_partitions, small, staged, text_or_empty
from dugout.llm.components import components
from dugout.llm.shingles import mix64, shingle_hashes, sorted_sets

SIMILARITY = 0.8
HASHES, ROWS, STEP = 128, 4, 16
BANDS = HASHES // ROWS
TOLERANCE = 1e-6
BLOCK_ROWS = 512                # members of a block
BLOCK_SHINGLES = 2_000_000      # shingles of a block, 16 MB
PAIRS_AT_ONCE = 1 << 17

_RNG = np.random.Generator(np.random.PCG64(77))
_MUL = _RNG.integers(1, 1 << 32, HASHES, dtype=np.uint32) | np.uint32(1)
_ADD = _RNG.integers(0, 1 << 32, HASHES, dtype=np.uint32)


def least_matches(t: float = SIMILARITY, tolerance: float = TOLERANCE) -> dict[int, int]:
    """n compared values -> fewest equal ones with P(similarity >= t) >= tolerance.

    For Beta(m + 1, n - m + 1), P(similarity >= t) = P(Binomial(n + 1, t) <= m)."""
    out = {}
    for n in range(STEP, HASHES + 1, STEP):
        total = 0.0
        for m in range(n + 1):
            total += math.comb(n + 1, m) * t ** m * (1 - t) ** (n + 1 - m)
            if total >= tolerance:
                out[n] = m
                break
    return out


# ---------------------------------------------------------------- signatures

def _minhash(sets: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """uint16[n, HASHES]; rows without shingles are zero."""
    out = np.zeros((len(counts), HASHES), np.uint16)
    held = np.flatnonzero(counts)
    starts = (np.cumsum(counts) - counts)[held]
    x = (sets >> np.uint64(32)).astype(np.uint32)
    at = 0
    while at < len(held):                                   # runs of texts of about 32k shingles
        stop = max(at + 1, int(np.searchsorted(starts, starts[at] + 32768)))
        lo, hi = starts[at], starts[stop] if stop < len(held) else len(x)
        part, cuts = x[lo:hi], starts[at:stop] - lo
        for h in range(HASHES):
            v = part * _MUL[h] + _ADD[h]
            out[held[at:stop], h] = (np.minimum.reduceat(v, cuts) * np.uint32(0x85EBCA6B)) >> np.uint32(16)
        at = stop
    return out


def _keys(sets: np.ndarray, counts: np.ndarray) -> list[bytes | None]:
    """16 bytes for each set, whatever order its shingles came in."""
    ends = np.cumsum(counts)
    total = [np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix64(sets ^ np.uint64(s)), dtype=np.uint64)))
             for s in (0x5851F42D4C957F2D, 0x14057B7EF767814F)]
    sums = np.stack([t[ends] - t[ends - counts] for t in total], axis=1) if len(counts) else np.zeros((0, 2), np.uint64)
    return [row.tobytes() if c else None for row, c in zip(sums, counts)]


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts = b.column("text").to_pylist()
        for at, hashes, counts in shingle_hashes(texts):
            sets, counts = sorted_sets(hashes, counts)
            sig = _minhash(sets, counts).view(np.int64)     # a band of four values is one long
            n = len(counts)
            yield pa.RecordBatch.from_arrays([
                b.column("doc_id").slice(at, n), b.column("text_id").slice(at, n), pa.array(_keys(sets, counts), pa.binary()),
                pa.array(counts, pa.int64()),
                pa.ListArray.from_arrays(pa.array(np.arange(0, n * BANDS + 1, BANDS), pa.int32()), pa.array(sig.ravel())),
            ], ["doc_id", "text_id", "key", "n", "sig"])


def signatures(docs: DataFrame) -> DataFrame:
    """(doc_id, text_id, key, n, sig): set key (null without words), set size, MinHash bands."""
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text_or_empty()).alias("text_id"), "text")
            .mapInArrow(_sign, "doc_id long, text_id long, key binary, n long, sig array<long>"))


# ---------------------------------------------------------------- groups of sorted rows

def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Rows sorted by ``keys`` -> (table of whole groups, first row of each group and the end)."""
    rest: pa.Table | None = None

    def bounds(t: pa.Table) -> np.ndarray:
        new = np.zeros(t.num_rows, bool)
        for k in keys:
            c = t.column(k).combine_chunks()
            if pa.types.is_binary(c.type):
                c = c.dictionary_encode().indices
            v = c.to_numpy(zero_copy_only=False)
            new[1:] |= v[1:] != v[:-1]
        new[:1] = True
        return np.flatnonzero(new)

    for b in batches:
        if not b.num_rows:
            continue
        t = pa.Table.from_batches([b])
        t = t if rest is None else pa.concat_tables([rest, t])
        first = bounds(t)
        if len(first) > 1:
            done = int(first[-1])
            yield t.slice(0, done).combine_chunks(), first
            rest = t.slice(done)
        else:
            rest = t
    if rest is not None and rest.num_rows:
        yield rest.combine_chunks(), np.append(bounds(rest), rest.num_rows)


def _pairs(first: np.ndarray, block: np.ndarray, cross: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row pairs of each group, a bounded number at a time; of a cross group only those between its blocks."""
    size = np.repeat(np.diff(first), np.diff(first))
    place = np.arange(first[-1]) - np.repeat(first[:-1], np.diff(first))
    apart = np.repeat(cross, np.diff(first))
    live = np.flatnonzero(size > 1)
    held, count, d = [], 0, 0
    while len(live):
        d += 1
        live = live[place[live] + d < size[live]]
        i = live[~apart[live] | (block[live] != block[live + d])]
        held.append((i, i + d))
        count += len(i)
        if count >= PAIRS_AT_ONCE or (count and not len(live)):
            yield np.concatenate([x[0] for x in held]), np.concatenate([x[1] for x in held])
            held, count = [], 0


def _survivors(sig: np.ndarray, i: np.ndarray, j: np.ndarray, least: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """The pairs that incremental comparison of MinHash values does not drop."""
    values = sig.view(np.uint16).reshape(len(sig), HASHES)
    same = np.zeros(len(i), np.int32)
    for n, fewest in least.items():
        same = same + (values[i, n - STEP:n] == values[j, n - STEP:n]).sum(axis=1)
        keep = same >= fewest
        i, j, same = i[keep], j[keep], same[keep]
    return i, j


def _forest(rows: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest row that each row is connected to."""
    root = np.arange(rows)
    while True:
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _sig_of(t: pa.Table) -> np.ndarray:
    c = t.column("sig").combine_chunks()
    c = c.chunk(0) if isinstance(c, pa.ChunkedArray) else c
    return c.flatten().to_numpy().reshape(-1, BANDS)


def _ints(t: pa.Table, name: str) -> np.ndarray:
    return t.column(name).to_numpy()


def _compare(batches: Iterator[pa.RecordBatch], t_min: float) -> Iterator[pa.RecordBatch]:
    """Buckets -> edges (a, b) of a spanning forest of the pairs that survive pruning."""
    least = least_matches(t_min)
    for t, first in _groups(batches, ["band", "value", "one", "two"]):
        sig, band, key = _sig_of(t), _ints(t, "band"), t.column("key").to_pylist()
        kept_i, kept_j = [], []
        for i, j in _pairs(first, _ints(t, "block"), (_ints(t, "one") != _ints(t, "two"))[first[:-1]]):
            earlier = ((sig[i] == sig[j]) & (np.arange(BANDS) < band[i][:, None])).any(axis=1)
            i, j = _survivors(sig, i[~earlier], j[~earlier], least)
            kept_i.append(i)
            kept_j.append(j)
        if not kept_i or not sum(map(len, kept_i)):
            continue
        root = _forest(len(key), np.concatenate(kept_i), np.concatenate(kept_j))
        linked = np.flatnonzero(root != np.arange(len(key)))
        yield pa.RecordBatch.from_arrays([pa.array([key[x] for x in linked], pa.binary()),
                                          pa.array([key[root[x]] for x in linked], pa.binary())], ["a", "b"])


def _dealt(rows: DataFrame, blocks: str) -> DataFrame:
    """Rows with their number of blocks -> a copy for each pair of blocks (one <= two) that theirs is in."""
    rows = rows.withColumn("block", F.pmod(F.xxhash64("key"), F.col(blocks)).cast("long"))
    others = F.sequence(F.lit(0).cast("long"), F.col(blocks) - 1)
    return (rows.withColumn("other", F.explode(others))
            .withColumn("one", F.least("block", "other")).withColumn("two", F.greatest("block", "other")).drop("other", blocks))


def candidate_groups(classes: DataFrame, t: float = SIMILARITY) -> DataFrame:
    """(key, sig) of copy classes -> (node, root): classes connected by pairs that survive pruning."""
    bands = classes.select("key", F.posexplode("sig").alias("band", "value")).withColumn("band", F.col("band").cast("long"))
    shared = bands.groupBy("band", "value").agg(F.count("*").alias("m")).where("m > 1")
    rows = staged(bands.join(shared, ["band", "value"]).select(
        "band", "value", "key", F.ceil(F.col("m") / BLOCK_ROWS).cast("long").alias("blocks")), "jaccard-buckets")
    dealt = (_dealt(rows.join(classes, "key"), "blocks")
             .repartition(shuffle_partitions(classes.sparkSession), "band", "value", "one", "two")
             .sortWithinPartitions("band", "value", "one", "two"))
    edges = dealt.select("band", "value", "one", "two", "block", "key", "sig").mapInArrow(lambda it: _compare(it, t), "a binary, b binary")
    return components(edges)


# ---------------------------------------------------------------- exact check

def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts of class members -> their shingle sets; rows whose text is not the class's are left out."""
    for b in batches:
        texts, keys = b.column("text").to_pylist(), b.column("key").to_pylist()
        for at, hashes, counts in shingle_hashes(texts):
            sets, counts = sorted_sets(hashes, counts)
            ends = np.cumsum(counts)
            ok = [x for x, k in enumerate(_keys(sets, counts)) if k == keys[at + x]]
            blobs = [sets[ends[x] - counts[x]:ends[x]].tobytes() for x in ok]
            part = b.slice(at, len(counts)).take(pa.array(ok, pa.int64()))
            part = part.drop_columns(["text"])
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(blobs, pa.binary())], [*part.schema.names, "shingles"])


def _verify(batches: Iterator[pa.RecordBatch], t_min: float) -> Iterator[pa.RecordBatch]:
    """Blocks of a candidate group -> (key, root, links) of members that have a verified link."""
    least = least_matches(t_min)
    for t, first in _groups(batches, ["root", "one", "two"]):
        sig, key, copies = _sig_of(t), t.column("key").to_pylist(), _ints(t, "copies")
        blobs = t.column("shingles").combine_chunks()
        sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in (blobs if not isinstance(blobs, pa.ChunkedArray) else blobs.chunk(0))]
        n = np.array([len(s) for s in sets], np.int64)
        links, found_i, found_j = np.zeros(len(key), np.int64), [], []
        for i, j in _pairs(first, _ints(t, "block"), (_ints(t, "one") != _ints(t, "two"))[first[:-1]]):
            i, j = _survivors(sig, i, j, least)
            order = np.argsort(i, kind="stable")
            i, j = i[order], j[order]
            cuts = np.flatnonzero(np.diff(i, prepend=-1))
            for lo, hi in zip(cuts, np.append(cuts[1:], len(i))):
                a, others = i[lo], j[lo:hi]
                mine = sets[a]
                joined = np.concatenate([sets[x] for x in others])
                place = np.minimum(np.searchsorted(mine, joined), len(mine) - 1)
                common = np.add.reduceat((mine[place] == joined).astype(np.int64), np.cumsum(n[others]) - n[others])
                good = others[common >= t_min * (n[a] + n[others] - common) - 1e-9]
                if len(good):
                    links[a] += copies[good].sum()
                    np.add.at(links, good, copies[a])
                    found_i.append(np.full(len(good), a))
                    found_j.append(good)
        if not found_i:
            continue
        root = _forest(len(key), np.concatenate(found_i), np.concatenate(found_j))
        linked = np.flatnonzero(links)
        yield pa.RecordBatch.from_arrays([pa.array([key[x] for x in linked], pa.binary()),
                                          pa.array([key[root[x]] for x in linked], pa.binary()),
                                          pa.array(links[linked])], ["key", "root", "links"])


def verified_links(docs: DataFrame, classes: DataFrame, groups: DataFrame, t: float = SIMILARITY) -> DataFrame:
    """(key, root, links): spanning forest and link counts of the verified pairs, one or more rows per class."""
    nodes = groups.select(F.col("node").alias("key"), "root")
    members = staged(nodes.join(classes, "key"), "jaccard-members")
    sizes = members.groupBy("root").agg(F.greatest(F.ceil(F.count("*") / BLOCK_ROWS), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("long").alias("blocks"))
    sizes = small(staged(sizes, "jaccard-sizes"))            # a row a group: its members stay where they are
    members = small(staged(members.join(sizes, "root").select(
        F.col("doc_id").alias("_doc"), F.col("text_id").alias("_text"), "key", "root", "blocks", "copies", "sig"), "jaccard-wanted"), 50_000)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text_or_empty()).alias("text_id"), "text")
    on = F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("text_id") == F.col("_text"))
    wanted = rows.join(members, on).dropDuplicates(["key"])      # a repeated row counts in ``copies``
    sets = wanted.select("key", "root", "blocks", "copies", "sig", "text").mapInArrow(
        _sets, "key binary, root binary, blocks long, copies long, sig array<long>, shingles binary")
    dealt = (_dealt(sets, "blocks").repartition(shuffle_partitions(docs.sparkSession), "root", "one", "two")
             .sortWithinPartitions("root", "one", "two", "key"))
    return staged(dealt.select("root", "one", "two", "block", "key", "copies", "sig", "shingles")
                  .mapInArrow(lambda it: _verify(it, t), "key binary, root binary, links long"), "jaccard-links")


def similar_documents(docs: DataFrame, t: float = SIMILARITY) -> DataFrame:
    """(doc_id, text_id, class_id, copy_id, n_links): a row for each row of ``docs``.

    class_id: smallest doc_id of the documents it is linked to, directly or through others.
    copy_id: smallest doc_id of the documents of equal shingle sets. n_links: documents, copies
    included, of similarity t or more to it.
    """
    return _rooted(docs, t).drop("root")


def _rooted(docs: DataFrame, t: float) -> DataFrame:
    """similar_documents and the key of each linked document's class (root), which is never null or shared."""
    ship_package(docs.sparkSession)
    light = staged(signatures(docs), "jaccard-signatures")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_id")).alias("first")
    classes = staged(light.where(F.col("key").isNotNull()).groupBy("key")
                     .agg(first, F.count("*").alias("copies"), F.first("n").alias("n"), F.first("sig").alias("sig"))
                     .select("key", F.col("first.doc_id").alias("doc_id"), F.col("first.text_id").alias("text_id"), "copies", "n", "sig"),
                     "jaccard-classes")
    groups = candidate_groups(classes.select("key", "sig"), t)
    links = verified_links(docs, classes, groups, t)
    roots = components(links.select(F.col("key").alias("a"), F.col("root").alias("b"))).select(F.col("node").alias("key"), "root")
    counts = links.groupBy("key").agg(F.sum("links").alias("links"))
    marked = (classes.select("key", F.col("doc_id").alias("copy_id"), "copies").join(roots, "key", "left").join(counts, "key", "left")
              .withColumn("root", F.coalesce("root", "key")))
    marked = staged(marked, "jaccard-classed")
    ids = small(staged(marked.groupBy("root").agg(F.min("copy_id").alias("class_id")), "jaccard-ids"))
    marked = staged(marked.join(ids, "root").select(
        "key", "root", "class_id", "copy_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
        .where((F.col("n_links") > 0)), "jaccard-marked")
    return (light.select("doc_id", "text_id", "key").join(small(marked), "key", "left")
            .select("doc_id", "text_id", F.when(F.col("n_links").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
                    F.when(F.col("n_links").isNull(), F.col("doc_id")).otherwise(F.col("copy_id")).alias("copy_id"),
                    F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), "root"))


def one_of_each(docs: DataFrame, t: float = SIMILARITY) -> DataFrame:
    """The documents, one of each class of linked documents: that of the smallest doc_id."""
    found = staged(_rooted(docs, t), "jaccard-documents")
    linked = found.where("n_links > 0")
    kept = linked.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_id")).alias("w"))
    kept = small(staged(kept, "jaccard-kept"))
    linked_ids = linked.groupBy("root", "doc_id", "text_id").agg(F.count("*").alias("times"))
    judged = (linked_ids.alias("l").join(kept.alias("k"), F.col("l.root") == F.col("k.root"))
              .select(F.col("l.doc_id").alias("_doc"), F.col("l.text_id").alias("_text"), "times",
                      (F.col("l.doc_id").eqNullSafe(F.col("w.doc_id")) & (F.col("l.text_id") == F.col("w.text_id"))).alias("_wins")))
    # those that go, and those that stay but come as repeated rows
    judged = staged(judged.where("NOT _wins OR times > 1").select("_doc", "_text", "_wins"), "jaccard-judged")
    gone, again = small(judged), judged.where("_wins")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("r"))
    on = F.col("r.doc_id").eqNullSafe(F.col("_doc")) & (F.xxhash64(text_or_empty(F.col("r.text"))) == F.col("_text"))
    single = rows.join(gone, on, "left_anti")
    if not again.isEmpty():
        repeated = rows.join(again, on).groupBy("_doc", "_text").agg(F.first("r").alias("r")).select("r")
        single = single.unionByName(repeated)
    return single.select("r.*")
