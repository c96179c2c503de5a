"""Token-ID output: fixed-width bit packing with block offsets and a document index.

Documents are range-partitioned and sorted by doc_id; every partition writes one shard file. In a shard
every id takes the fewest bits that the vocabulary needs, packed most significant bit first in blocks of
``BLOCK`` ids (a multiple of eight, so every block starts on a byte). Layout, little-endian:

    magic "DTOK" | version u32 | bits u32 | block u32 | packed blocks
    | byte offset of every block u64 | (doc_id i64, null u8) of every document | first id of every document u64, and the end u64
    | n_blocks u64 | n_docs u64 | n_ids u64 | magic

Any document or range of ids is read by unpacking just its blocks with numpy (``Shard.ids``). A shard is written
as a stream (a block at a time) and appears when complete. Shard order is doc_id order, so the place of
an id in the whole corpus is the prefix sum over the shards' sizes (one manifest row per shard).

Cases: null or empty texts have the end id only; null doc_ids come first; repeated rows are written
each, ordered by text hash; a text of any length is encoded whole (its ids are streamed into blocks);
an empty table gives an empty manifest and no file; extra columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from dugout.llm.common import run_folder, ship_package, shuffle_partitions, staged, text_or_empty
from dugout.llm.encoding import encoder
from dugout.llm.files import open_store, published

MAGIC, VERSION, BLOCK = b"DTOK", 1, 1 << 16
END_ID = 1
MANIFEST = "shard long, path string, n_docs long, n_ids long, bits int"
_HEAD, _TAIL = struct.Struct("<4sIII"), struct.Struct("<QQQ4s")


def bits_for(vocabulary: int) -> int:
    """Fewest bits that hold every id below ``vocabulary``."""
    return max(1, int(vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids below 2**bits -> packed bytes; the last byte is filled with zeros."""
    if bits in (8, 16, 32):
        return ids.astype(f">u{bits // 8}").tobytes()
    wide = ids.astype(">u4").view(np.uint8).reshape(-1, 4)
    return np.packbits(np.unpackbits(wide, axis=1)[:, 32 - bits:]).tobytes()


def unpack(data: bytes, bits: int, n: int) -> np.ndarray:
    """The first ``n`` ids of packed bytes."""
    if bits in (8, 16, 32):
        return np.frombuffer(data, f">u{bits // 8}", n).astype("<u4")
    each = np.unpackbits(np.frombuffer(data, np.uint8), count=n * bits).reshape(n, bits)
    wide = np.zeros((n, 32), np.uint8)
    wide[:, 32 - bits:] = each
    return np.packbits(wide, axis=1).view(">u4").ravel().astype("<u4")


class ShardWriter:
    """Streams documents into a shard; holds one block of ids and the index."""

    def __init__(self, out, bits: int) -> None:
        self.out, self.bits = out, bits
        self.offsets, self.ids, self.starts, self.nulls = [], [], [0], []
        self._wait, self._waiting = [], 0
        self.at = out.write(_HEAD.pack(MAGIC, VERSION, bits, BLOCK))

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.ids.append(doc_id or 0)
        self.nulls.append(doc_id is None)
        self.starts.append(self.starts[-1] + len(ids))
        self._wait.append(ids)
        self._waiting += len(ids)
        if self._waiting >= BLOCK:
            joined = np.concatenate(self._wait)
            done = len(joined) // BLOCK * BLOCK
            for lo in range(0, done, BLOCK):
                self._block(joined[lo:lo + BLOCK])
            self._wait, self._waiting = [joined[done:].copy()], len(joined) - done

    def _block(self, ids: np.ndarray) -> None:
        self.offsets.append(self.at)
        data = pack(ids, self.bits)
        self.out.write(data)
        self.at += len(data)

    def finish(self) -> None:
        if self._waiting:
            self._block(np.concatenate(self._wait))
        self.out.write(np.array(self.offsets, "<u8").tobytes() + np.array(self.ids, "<i8").tobytes()
                       + np.array(self.nulls, np.uint8).tobytes() + np.array(self.starts, "<u8").tobytes()
                       + _TAIL.pack(len(self.offsets), len(self.ids), self.starts[-1], MAGIC))


class Shard:
    """Random access to a shard file."""

    def __init__(self, uri: str) -> None:
        store, path = open_store(uri)
        self._file = store.open_input_file(path)
        size = self._file.size()
        magic, version, self.bits, self.block = _HEAD.unpack(self._file.read_at(_HEAD.size, 0))
        n_blocks, n_docs, self.n_ids, end = _TAIL.unpack(self._file.read_at(_TAIL.size, size - _TAIL.size))
        if magic != MAGIC or end != MAGIC or version != VERSION:
            raise ValueError(f"{uri} is no token shard")
        at = size - _TAIL.size - 8 * n_blocks - 9 * n_docs - 8 * (n_docs + 1)
        index = self._file.read_at(size - _TAIL.size - at, at)
        self.offsets = np.frombuffer(index, "<u8", n_blocks)
        self.doc_ids = np.frombuffer(index, "<i8", n_docs, 8 * n_blocks)
        self.nulls = np.frombuffer(index, np.uint8, n_docs, 8 * (n_blocks + n_docs)).astype(bool)
        self.starts = np.frombuffer(index, "<u8", n_docs + 1, 8 * n_blocks + 9 * n_docs).astype(np.int64)
        self._held: tuple[int, np.ndarray] = (-1, np.zeros(0, "<u4"))

    def _block(self, k: int) -> np.ndarray:
        if self._held[0] != k:
            n = min(self.block, self.n_ids - k * self.block)
            self._held = (k, unpack(self._file.read_at((n * self.bits + 7) // 8, int(self.offsets[k])), self.bits, n))
        return self._held[1]

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids start..stop of the shard, from just the blocks that hold them."""
        parts = []
        while start < stop:
            k = start // self.block
            upto = min(stop, (k + 1) * self.block)
            parts.append(self._block(k)[start - k * self.block:upto - k * self.block])
            start = upto
        return np.concatenate(parts) if parts else np.zeros(0, "<u4")


def _writer(tokenizer_path: str, folder: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = (b for b in batches if b.num_rows)
        first = next(batches, None)
        if first is None:
            return
        shard = TaskContext.get().partitionId()
        uri = f"{folder}/shard-{shard:08d}.dtok"
        words = encoder(tokenizer_path)
        end = np.array([END_ID], "<u4")
        with published(uri) as out:
            w = ShardWriter(out, bits_for(words.vocab))
            b: pa.RecordBatch | None = first
            while b is not None:
                for doc_id, text in zip(b.column("doc_id"), b.column("text")):
                    w.add(doc_id.as_py(), np.concatenate((np.frombuffer(words.encode(text.as_py()), "<u4"), end)))
                b = next(batches, None)
            w.finish()
        yield pa.RecordBatch.from_pydict({"shard": [shard], "path": [uri], "n_docs": [len(w.ids)], "n_ids": [w.starts[-1]],
                                          "bits": pa.array([w.bits], pa.int32())})
    return write


def write_shards(docs: DataFrame, tokenizer_path: str, folder: str | None = None, shards: int | None = None) -> DataFrame:
    """Encode and write ``docs``; the manifest, a row per shard, is returned as written to the shared folder."""
    spark = docs.sparkSession
    ship_package(spark)
    folder = folder or run_folder(spark, "token-shards")
    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
            .withColumn("tie", F.xxhash64("text"))
            .repartitionByRange(shards or shuffle_partitions(spark), F.col("doc_id").asc_nulls_first(), "tie")
            .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "tie"))
    return staged(rows.select("doc_id", "text").mapInArrow(_writer(tokenizer_path, folder), MANIFEST), "token-manifest")


def placed_shards(manifest: DataFrame) -> DataFrame:
    """The manifest with ``before``: ids of all shards before it. One row per shard, so the window is small."""
    up_to = W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1)
    return manifest.withColumn("before", F.coalesce(F.sum("n_ids").over(up_to), F.lit(0).cast("long")))


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for row in b.to_pylist():
            s = Shard(row["path"])
            n = len(s.doc_ids)
            for lo in range(0, n, 4096):
                hi = min(n, lo + 4096)
                crc = [zlib.crc32(s.ids(s.starts[d], s.starts[d + 1]).tobytes()) for d in range(lo, hi)]
                yield pa.RecordBatch.from_arrays([
                    pa.array(s.doc_ids[lo:hi], mask=s.nulls[lo:hi]), pa.array(s.starts[lo:hi] + row["before"]),
                    pa.array(np.diff(s.starts[lo:hi + 1])), pa.array(crc, pa.int64()), pa.array([row["shard"]] * (hi - lo), pa.int64())],
                    ["doc_id", "start", "n_tokens", "ids_crc32", "shard"])


def read_documents(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """Per document, from the files: doc_id, start in the corpus, n_tokens, ids_crc32, shard."""
    shards = placed_shards(manifest).select("shard", "path", "before")
    return (shards.repartition(shuffle_partitions(spark), "shard")
            .mapInArrow(_read, "doc_id long, start long, n_tokens long, ids_crc32 long, shard long"))


def pack_documents(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """Write the token files of ``docs`` and return what they hold, a row per document."""
    return read_documents(docs.sparkSession, write_shards(docs, tokenizer_path))
