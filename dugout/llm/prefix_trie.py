"""Prefix trie of conversations, with subtree totals by time-forward processing.

Conversations are rebuilt first: conversation c takes the first h turns of conversation c - c%100 (h = crc32(c)%6) and
then its own turns after its first h. A node is a distinct sequence of first d turns, its members the rebuilt
conversations that start with it.

1. *Ranks* by (turn, null first; role; text) as a running count over range-sorted rows: a conversation of any length is
   dealt out over tasks.
2. *Node keys*: the running exclusive-or of 128-bit hashes of (position, role, text), likewise. Rows are grouped by
   (depth, key) into nodes, combined map-side. A parent's key is the key without the last turn's hash.
3. *Time-forward processing within shards.* Nodes are sorted in reverse level order; each, when met, takes what its
   children sent from a priority queue (ordered by level and key, spilled to sorted runs beyond ``QUEUE``), adds its
   own and sends its totals to its parent's place in the order. A shard holds whole subtrees of
   at most one in ``SHARDS`` of all rows: a node is *light* if so few rows lie below it, and the topmost light
   node on its path names its shard.
4. *Across shard roots.* The tops of the shards send their totals to the heavy nodes above them, summed by
   receiver before they are shuffled. Heavy nodes are few at any depth; they are processed the same way in bands of ``BAND`` levels (a very
   long conversation is a chain of bands): first each band's own totals, then the tree of band roots, then the
   bands again with what comes from below.
5. *Ends.* Ids of the conversations that end at a node are range-sorted, joined to pieces of ``PIECE`` ids, and the
   pieces streamed in order into SHA-256, which keeps no list in memory.

Cases: a null role or text is empty; rows without conv_id are left out; equal turns go by role, then text; repeated
rows are turns of their own; a rebuilt conversation may have no turns and is then a member of the root; % takes the
sign of conv_id; an empty table has no nodes; extra columns are ignored. Two sequences share a key
with probability 2^-128.
"""

from __future__ import annotations

import hashlib
import heapq
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dugout.llm.common import ship_package, shuffle_partitions, small, staged
from dugout.llm.running import running

FAMILY = 100                    # conversations c - c%100 ... share first turns
PREFIXES = 6                    # h is below it
SHARDS = 2048
LEAST_ROWS = 1000               # below so many rows a subtree is never split
BAND = 4096
QUEUE = 200_000                 # entries in memory
PIECE = 4096
KEY = ["depth", "x1", "x2"]


class SpillingQueue:
    """Priority queue of equal-length tuples of integers; beyond ``limit`` entries the later half is written
    to the task's scratch space as a sorted run, read back block by block."""

    def __init__(self, limit: int = QUEUE, block: int = 8192) -> None:
        self.limit, self.block = limit, block
        self.heap: list[tuple[int, ...]] = []
        self.runs: list[tuple[tuple[int, ...], int, Iterator[tuple[int, ...]]]] = []
        self.spilled = 0

    def push(self, entry: tuple[int, ...]) -> None:
        heapq.heappush(self.heap, entry)
        if len(self.heap) > self.limit:
            self.heap.sort()
            half = len(self.heap) // 2
            self._spill(self.heap[half:])
            del self.heap[half:]

    def _spill(self, entries: list[tuple[int, ...]]) -> None:
        width = len(entries[0])
        f = tempfile.TemporaryFile()                        # without a name: gone with the task
        np.array(entries, np.int64).tofile(f)
        f.seek(0)

        def read() -> Iterator[tuple[int, ...]]:
            with f:
                while len(got := np.fromfile(f, np.int64, self.block * width)):
                    yield from map(tuple, got.reshape(-1, width).tolist())

        run = read()
        self.spilled += 1
        heapq.heappush(self.runs, (next(run), self.spilled, run))

    def pop_upto(self, key: tuple[int, ...]) -> Iterator[tuple[int, ...]]:
        """The entries that start with ``key`` or come before it, in order."""
        width = len(key)
        while True:
            from_run = self.runs and (not self.heap or self.runs[0][0] < self.heap[0])
            if not from_run and not self.heap:
                return
            if (self.runs[0][0] if from_run else self.heap[0])[:width] > key:
                return
            if from_run:
                entry, nth, run = self.runs[0]
                after = next(run, None)
                if after is None:
                    heapq.heappop(self.runs)
                else:
                    heapq.heapreplace(self.runs, (after, nth, run))
                yield entry
            else:
                yield heapq.heappop(self.heap)


# ---------------------------------------------------------------- rebuilt conversations

def _h(conv: str = "conv_id") -> Column:
    return F.crc32(F.col(conv).cast("string")) % PREFIXES


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, depth, g1, g2, chars, m), a row for each turn of each rebuilt conversation, and (conv_id, m), its number of turns."""
    rows = (turns.where("conv_id IS NOT NULL")
            .select(F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
            .withColumn("t1", F.xxhash64("role", "text")).withColumn("t2", F.xxhash64(F.lit("turn"), "text", "role"))
            .withColumn("chars", F.length("text").cast("long")))
    # the last key spreads repeated rows, whose order does not matter
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text"), F.monotonically_increasing_id()]
    ranked = running(rows, "conv_id", order, {}, ["t1", "t2", "chars"], "trie-ranked")
    sizes = ranked.groupBy("conv_id").agg(F.max("nth").alias("n"))
    base = F.col("conv_id") - F.col("conv_id") % FAMILY
    bases = sizes.where(F.col("conv_id") % FAMILY == 0).select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    h = _h()
    convs = staged(sizes.withColumn("base", base).join(bases, "base", "left")
                   .select("conv_id", "base", h.alias("h"), F.least(h, F.coalesce("base_n", F.lit(0))).alias("k"), "n")
                   .withColumn("m", F.col("k") + F.greatest(F.col("n") - F.col("h"), F.lit(0))), "trie-conversations")
    known = small(convs.select("conv_id", "h", "k", "m"))
    own = (ranked.where(F.col("nth") > h).join(known, "conv_id")
           .select("conv_id", (F.col("k") + F.col("nth") - F.col("h")).alias("depth"), "t1", "t2", "chars", "m"))
    first = (ranked.where((F.col("conv_id") % FAMILY == 0) & (F.col("nth") < PREFIXES))
             .select(F.col("conv_id").alias("base"), F.col("nth").alias("depth"), "t1", "t2", "chars"))
    given = convs.where("k > 0").join(first, "base").where("depth <= k").select("conv_id", "depth", "t1", "t2", "chars", "m")
    placed = own.unionByName(given).select("conv_id", "depth", F.xxhash64("depth", "t1", "t2").alias("g1"),
                                           F.xxhash64("t2", "t1", "depth").alias("g2"), "chars", "m")
    return placed, convs.select("conv_id", "m")


def paths(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, x1, x2, up1, up2, chars, m): the nodes on the path of each rebuilt conversation, root included."""
    placed, convs = rebuilt(turns)
    keyed = running(placed, "conv_id", [F.col("depth")], {"x1": "g1", "x2": "g2"}, ["depth", "chars", "m", "g1", "g2"], "trie-keys")
    none = F.lit(None).cast("long")
    root = convs.select("conv_id", F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("x1"), F.lit(0).cast("long").alias("x2"),
                        none.alias("up1"), none.alias("up2"), F.lit(0).cast("long").alias("chars"), "m")
    return keyed.select("conv_id", "depth", "x1", "x2", F.col("x1").bitwiseXOR(F.col("g1")).alias("up1"),
                        F.col("x2").bitwiseXOR(F.col("g2")).alias("up2"), "chars", "m").unionByName(root)


# ---------------------------------------------------------------- time-forward processing

_NODE = ["depth", "x1", "x2", "up1", "up2", "conv_id", "n_convs", "chars", "top"]
_IN = ["n_children", "n_leaves", "saved_tokens"]


def _forward(batches: Iterator[pa.RecordBatch], limit: int = QUEUE) -> Iterator[pa.RecordBatch]:
    """Nodes in reverse level order, with what came from other shards -> the same nodes with their subtree's totals."""
    queue = SpillingQueue(limit)
    for b in batches:
        columns = [b.column(c).to_pylist() for c in (*_NODE, *_IN)]
        out: list[tuple[int, int, int]] = []
        for depth, x1, x2, up1, up2, _, n_convs, chars, top, children, leaves, saved in zip(*columns):
            for entry in queue.pop_upto((-depth, x1, x2)):
                children, leaves, saved = children + 1, leaves + entry[3], saved + entry[4]
            leaves = leaves if children else 1
            saved += (n_convs - 1) * chars
            out.append((children, leaves, saved))
            if not top:
                queue.push((1 - depth, up1, up2, leaves, saved))
        yield pa.RecordBatch.from_arrays([*[b.column(c) for c in _NODE], *[pa.array([r[i] for r in out], pa.int64()) for i in range(3)]],
                                         [*_NODE, *_IN])


_SCHEMA = ", ".join(f"{c} {'boolean' if c == 'top' else 'long'}" for c in (*_NODE, *_IN))


def forward(nodes: DataFrame, shard: list[str] | None, limit: int = QUEUE) -> DataFrame:
    """Time-forward processing of ``nodes``, those of a shard in one task (without ``shard``: all of them)."""
    dealt = nodes.repartition(shuffle_partitions(nodes.sparkSession), *shard) if shard else nodes.repartition(1)
    return (dealt.sortWithinPartitions(F.col("depth").desc(), "x1", "x2").select(*_NODE, *_IN)
            .mapInArrow(lambda it: _forward(it, limit), _SCHEMA))


def _sent(tops: DataFrame, totals: bool = True) -> DataFrame:
    """What shard tops send to their parents: a child each and, with ``totals``, their subtree's totals."""
    zero = F.lit(0).cast("long")
    return tops.select((F.col("depth") - 1).alias("depth"), F.col("up1").alias("x1"), F.col("up2").alias("x2"), F.lit(1).cast("long").alias("n_children"),
                       *[F.col(c) if totals else zero.alias(c) for c in _IN[1:]])


def _received(nodes: DataFrame, messages: DataFrame) -> DataFrame:
    """Nodes with the sums of the messages to them (combined map-side)."""
    sums = messages.groupBy(*KEY).agg(*[F.sum(c).alias(c) for c in _IN])
    return nodes.join(sums, KEY, "left").select(*nodes.columns, *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in _IN])


def _heavy_totals(heavy: DataFrame, from_light: DataFrame, rows: DataFrame, band: int, limit: int) -> DataFrame:
    """Totals of the heavy nodes: by bands of levels, then across the roots of the bands, then the bands again."""
    zero = F.lit(0).cast("long")
    deepest = heavy.agg(F.max("depth")).first()[0]
    if deepest < band:
        return forward(_received(heavy.withColumn("top", F.col("depth") == 0), from_light), None, limit)
    places = rows.where(F.col("depth") % band == 0).select("conv_id", F.col("depth").alias("f0"), F.col("x1").alias("f1"), F.col("x2").alias("f2"))
    heavy = staged(heavy.withColumn("f0", F.col("depth") - F.col("depth") % band).join(places, ["conv_id", "f0"])
                   .withColumn("top", F.col("depth") == F.col("f0")), "trie-bands")
    roots = heavy.where("top")
    own = forward(_received(heavy, from_light.unionByName(_sent(roots.where("depth > 0"), False))),
                  ["f0", "f1", "f2"], limit).where("top")
    above = roots.select("depth", "x1", "x2", "conv_id", (F.col("depth") - band).alias("f0")).join(places, ["conv_id", "f0"], "left")
    bands = (own.join(above.select(*KEY, "f1", "f2"), KEY)
             .select((F.col("depth") / band).cast("long").alias("depth"), "x1", "x2", F.col("f1").alias("up1"), F.col("f2").alias("up2"), "conv_id",
                     F.lit(1).cast("long").alias("n_convs"), zero.alias("chars"), (F.col("depth") == 0).alias("top"),
                     F.lit(1).cast("long").alias("n_children"), "n_leaves", "saved_tokens"))
    across = staged(forward(bands, None, limit), "trie-band-totals")
    below = (roots.where("depth > 0").join(across.select((F.col("depth") * band).alias("depth"), "x1", "x2", *_IN), KEY))
    return forward(_received(heavy, from_light.unionByName(_sent(below))), ["f0", "f1", "f2"], limit)


def subtree_totals(rows: DataFrame, nodes: DataFrame, shards: int = SHARDS, least_rows: int = LEAST_ROWS, band: int = BAND,
                   limit: int = QUEUE) -> DataFrame:
    """Nodes with n_children, n_leaves and saved_tokens. ``rows``: paths; ``nodes``: with ``below``, the rows in their subtree."""
    zero = F.lit(0).cast("long")
    total = nodes.agg(F.max("below")).first()[0] or 0
    bound = max(least_rows, total // shards)
    light, heavy = nodes.where(F.col("below") <= bound), nodes.where(F.col("below") > bound)
    if total <= bound:                                       # one shard
        return forward(light.withColumn("top", F.col("depth") == 0).select(*_NODE, *[zero.alias(c) for c in _IN]), None, limit)
    held = staged(heavy.select(*KEY), "trie-heavy")
    lowest = rows.select("conv_id", *KEY).join(small(held), KEY).groupBy("conv_id").agg((F.max("depth") + 1).alias("depth"))
    tops = rows.select("conv_id", *KEY).join(lowest, ["conv_id", "depth"]).select("conv_id", F.col("depth").alias("s0"), F.col("x1").alias("s1"), F.col("x2").alias("s2"))
    sharded = light.join(tops, "conv_id").withColumn("top", F.col("depth") == F.col("s0")).select(*_NODE, "s1", "s2", *[zero.alias(c) for c in _IN])
    done = staged(forward(sharded, ["s1", "s2"], limit), "trie-light")
    upper = _heavy_totals(heavy.drop("below"), _sent(done.where("top")), rows, band, limit)
    return done.unionByName(upper)


# ---------------------------------------------------------------- ends

def _pieces(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Sorted (depth, x1, x2, conv_id) -> comma-joined ids of at most ``size`` conversations of a node."""
    node, ids, names = None, [], [*KEY, "first", "ids"]

    def rows(done: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*[pa.array([r[i] for r in done], pa.int64()) for i in range(4)], pa.array([r[4] for r in done], pa.string())], names)

    for b in batches:
        done = []
        for *key, conv in zip(*[b.column(c).to_pylist() for c in (*KEY, "conv_id")]):
            if key != node or len(ids) == size:
                if ids:
                    done.append((*node, ids[0], ",".join(map(str, ids))))
                node, ids = key, []
            ids.append(conv)
        yield rows(done)
    if ids:
        yield rows([(*node, ids[0], ",".join(map(str, ids)))])


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces in order -> (depth, x1, x2, SHA-256 of the node's pieces)."""
    node, sha = None, None

    def rows(done: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*[pa.array([r[0][i] for r in done], pa.int64()) for i in range(3)], pa.array([r[1] for r in done], pa.string())],
                                          [*KEY, "ends_sha256"])

    for b in batches:
        done = []
        for *key, ids in zip(*[b.column(c).to_pylist() for c in (*KEY, "ids")]):
            if key == node:
                sha.update(b",")
            else:
                if node is not None:
                    done.append((node, sha.hexdigest()))
                node, sha = key, hashlib.sha256()
            sha.update(ids.encode())
        yield rows(done)
    if node is not None:
        yield rows([(node, sha.hexdigest())])


def ends(rows: DataFrame, piece: int = PIECE) -> DataFrame:
    """(depth, x1, x2, ends_sha256) of the nodes at which conversations end."""
    parts = shuffle_partitions(rows.sparkSession)
    order = ["x1", "x2", "depth", "conv_id"]
    pieces = (rows.where("depth = m").select(*KEY, "conv_id").repartitionByRange(parts, *order).sortWithinPartitions(*order)
              .mapInArrow(lambda it: _pieces(it, piece), "depth long, x1 long, x2 long, first long, ids string"))
    return (pieces.repartition(parts, *KEY).sortWithinPartitions(*KEY, "first")
            .mapInArrow(_digest, "depth long, x1 long, x2 long, ends_sha256 string"))


def prefix_trie(turns: DataFrame, piece: int = PIECE, **options) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256): a row for each node."""
    ship_package(turns.sparkSession)
    rows = staged(paths(turns), "trie-rows")
    nodes = staged(rows.groupBy(*KEY).agg(F.min("up1").alias("up1"), F.min("up2").alias("up2"), F.min("conv_id").alias("conv_id"),
                                          F.count("*").alias("n_convs"), F.min("chars").alias("chars"), F.sum(F.col("m") - F.col("depth") + 1).alias("below")),
                   "trie-nodes")
    totals = subtree_totals(rows, nodes, **options)
    up = nodes.select((F.col("depth") + 1).alias("depth"), F.col("x1").alias("up1"), F.col("x2").alias("up2"), F.col("conv_id").alias("parent_conv_id"))
    none = hashlib.sha256(b"").hexdigest()
    return (totals.join(up, ["depth", "up1", "up2"], "left").join(ends(rows, piece), KEY, "left")
            .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                    F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256")))
