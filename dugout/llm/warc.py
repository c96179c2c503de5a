"""WARC archives: writing captures and assembling transactions from request, response and metadata records.

*Writing.* Every page is a capture of three records: a request, a response (or, where another page has
the same payload, a revisit of it) and a metadata record, tied by ``WARC-Concurrent-To``. Archives are
``.warc.gz`` files, one gzip member per record, written as streams by tasks into the shared folder.
Of pages with equal payloads of at least ``least_bytes`` the one with the largest page_id is the response; the
others are revisits with the payload's digest, its length in the HTTP header and ``WARC-Refers-To``. Payloads
meet by digest: pages of one digest are reduced map-side to their largest page_id, and a digest on very
many pages is joined over ``SALTS`` salted keys.

*Assembling.* Archives are read record by record; requests and metadata are joined to their response or
revisit through the concurrent-to identifiers, and one nested row per capture comes out. The
identifiers are spread evenly by construction (three records a capture), so no key is hot.

Cases: null html is an empty payload; an empty payload is a payload like others (when least_bytes is 0);
null page_ids are the smallest and are null again when read; repeated rows of one page_id and payload: one of them is the
response (their records' ids differ); payloads of any length are written whole; an empty table gives no archives and no rows; extra
columns are ignored; a null url is written as an empty target. Captures without request or metadata (foreign
archives) have nulls there.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from dugout.llm.common import run_folder, ship_package, shuffle_partitions, small, staged
from dugout.llm.files import open_store, published

LEAST_BYTES = 0
SALTS = 32
HOT = 1000              # pages of one digest from which its join is salted
LEVEL = 1               # gzip level
DATE = "2024-01-01T00:00:00Z"
SOFTWARE = "dugout"
_SPACE = uuid.UUID("6d7f4a52-52c1-4b0e-9d61-3f0f6e8b7a10")     # name space of record ids


def record_id(page_id: int | None, digest: str, copy: int, kind: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, f'{page_id}/{digest}/{copy}/{kind}')}>"


def payload_digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return _base32(hashlib.sha1(payload).digest())


def _base32(raw: bytes) -> str:
    return base64.b32encode(raw).decode()


def record(kind: str, headers: list[tuple[str, str]], block: bytes) -> bytes:
    head = [("WARC-Type", kind), *headers, ("Content-Length", str(len(block)))]
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head) + "\r\n").encode("utf-8", "surrogatepass") + block + b"\r\n\r\n"


def capture_records(page_id: int | None, copy: int, url: str, payload: bytes | None, digest: str, size: int,
                    refers: tuple[int | None] | None) -> Iterator[bytes]:
    """The three records of a capture; ``refers`` holds the page_id of the response that it revisits."""
    url = url.replace("\r", " ").replace("\n", " ")
    me = record_id(page_id, digest, copy, "response")
    common = [("WARC-Date", DATE), ("WARC-Target-URI", url)]
    path = url.partition("://")[2].partition("/")[2]
    yield record("request", [("WARC-Record-ID", record_id(page_id, digest, copy, "request")), *common, ("WARC-Concurrent-To", me),
                             ("Content-Type", "application/http; msgtype=request")],
                 f"GET /{path} HTTP/1.1\r\nUser-Agent: {SOFTWARE}\r\n\r\n".encode("utf-8", "surrogatepass"))
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    main = [("WARC-Record-ID", me), *common, ("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http; msgtype=response")]
    if refers is None:
        yield record("response", main, http + (payload or b""))
    else:
        yield record("revisit", [*main, ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                                 ("WARC-Refers-To", record_id(refers[0], digest, 0, "response"))], http)
    fields = f"page-id: {'' if page_id is None else page_id}\r\n"
    if refers is not None:
        fields += f"revisits-page-id: {'' if refers[0] is None else refers[0]}\r\n"
    yield record("metadata", [("WARC-Record-ID", record_id(page_id, digest, copy, "metadata")), *common, ("WARC-Concurrent-To", me),
                              ("Content-Type", "application/warc-fields")], fields.encode())


def _writer(folder: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = (b for b in batches if b.num_rows)
        b = next(batches, None)
        if b is None:
            return
        uri, records = f"{folder}/part-{TaskContext.get().partitionId():08d}.warc.gz", 0
        with published(uri) as out:
            while b is not None:
                for r in zip(*[b.column(c) for c in ("page_id", "copy", "url", "html", "digest", "size", "revisit", "to_page")]):
                    page_id, copy, url, html, digest, size, revisit, to_page = (x.as_py() for x in r)
                    for data in capture_records(page_id, copy, url, None if revisit else html.encode("utf-8", "surrogatepass"),
                                                _base32(bytes.fromhex(digest)), size, (to_page,) if revisit else None):
                        out.write(gzip.compress(data, LEVEL, mtime=0))
                        records += 1
                b = next(batches, None)
        yield pa.RecordBatch.from_pydict({"path": [uri], "records": [records]})
    return write


def _placed(pages: DataFrame, least_bytes: int) -> DataFrame:
    """Rows of captures with what they are: copy, digest, size, revisit, to_page, to_copy."""
    body = F.coalesce("html", F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce("url", F.lit("")).alias("url"), body.alias("html"),
                        F.sha1(body.cast("binary")).alias("digest"), F.octet_length(body).cast("long").alias("size"))
    light = staged(rows.select("page_id", "digest", "size"), "warc-light")
    groups = (light.where(F.col("size") >= least_bytes).groupBy("digest")
              .agg(F.max(F.struct(F.col("page_id").isNotNull().alias("some"), "page_id")).alias("top"), F.count("*").alias("pages"))
              .where("pages > 1")
              .select(F.col("digest").alias("of"), F.col("top.page_id").alias("to_page"),
                      F.when(F.col("pages") > HOT, SALTS).otherwise(1).alias("salts")))
    groups = staged(groups, "warc-groups")
    hot = small(staged(groups.where("salts > 1").select(F.col("of").alias("hot")), "warc-hot"))
    dealt = small(staged(groups.select("of", "to_page", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("of_salt")), "warc-dealt"))
    salt = F.when(F.col("hot").isNotNull(), F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int")).otherwise(0)
    rows = rows.join(hot, F.col("digest") == F.col("hot"), "left").withColumn("salt", salt).drop("hot")
    rows = rows.join(dealt, (F.col("digest") == F.col("of")) & (F.col("salt") == F.col("of_salt")), "left")
    # rows that share page_id and payload are told apart by a copy number; where there are none, nothing is shuffled
    if light.groupBy("page_id", "digest").agg(F.count("*").alias("n")).where("n > 1").isEmpty():
        rows = rows.withColumn("copy", F.lit(0))
    else:
        rows = rows.withColumn("copy", F.row_number().over(W.partitionBy("page_id", "digest").orderBy("url")) - 1)
    top = F.col("page_id").eqNullSafe(F.col("to_page")) & (F.col("copy") == 0)
    return rows.withColumn("revisit", F.col("of").isNotNull() & ~top)


def write_archives(pages: DataFrame, folder: str | None = None, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """Write a capture per row of (page_id, url, html); returns (path, records), a row per archive."""
    spark = pages.sparkSession
    ship_package(spark)
    folder = folder or run_folder(spark, "warc")
    out = _placed(pages, least_bytes).select(
        "page_id", "copy", "url", F.when(F.col("revisit"), "").otherwise(F.col("html")).alias("html"), "digest", "size", "revisit", "to_page")
    return staged(out.mapInArrow(_writer(folder), "path string, records long"), "warc-manifest")


def parse(stream) -> Iterator[dict]:
    """Records of an uncompressed WARC stream: headers (names in lower case; concurrent-to as a list) and block."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:40]!r}")
        headers: dict = {"warc-concurrent-to": []}
        while (line := stream.readline()).strip():
            name, _, value = line.decode("utf-8", "surrogatepass").partition(":")
            if name.lower() == "warc-concurrent-to":
                headers["warc-concurrent-to"].append(value.strip())
            else:
                headers[name.lower()] = value.strip()
        yield headers | {"block": stream.read(int(headers["content-length"]))}


def _http(block: bytes) -> tuple[dict, bytes]:
    head, _, payload = block.partition(b"\r\n\r\n")
    lines = head.decode("latin-1").split("\r\n")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])} | {"": lines[0]}, payload


def _reader(with_payload: bool):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for path in (p for b in batches for p in b.column("path").to_pylist()):
            store, name = open_store(path)
            rows: list[dict] = []
            held = 0
            with store.open_input_stream(name, compression=None) as raw, gzip.open(raw) as stream:
                for r in parse(io.BufferedReader(stream, 1 << 18)):
                    kind, block = r["warc-type"], r["block"]
                    row = {"record_id": r.get("warc-record-id"), "type": kind, "concurrent_to": r["warc-concurrent-to"],
                           "refers_to": r.get("warc-refers-to"), "url": r.get("warc-target-uri"), "date": r.get("warc-date"),
                           "digest": (r.get("warc-payload-digest") or "").removeprefix("sha1:") or None}
                    if kind in ("response", "revisit") and "http" in r.get("content-type", ""):
                        http, payload = _http(block)
                        row["status"] = http[""]
                        if kind == "response":
                            if row["digest"] and row["digest"] != payload_digest(payload):
                                raise ValueError(f"payload of {row['record_id']} in {path} does not match its digest")
                            row |= {"payload_bytes": len(payload), "digest": payload_digest(payload), "payload": payload if with_payload else None}
                        else:                                   # a revisit has the length of the full payload in its HTTP header
                            row["payload_bytes"] = int(http["content-length"]) if http.get("content-length", "").isdigit() else None
                    else:
                        row["text"] = block.decode("utf-8", "replace")
                    rows.append(row)
                    held += len(block) if with_payload else 0
                    if len(rows) >= 4096 or held >= 1 << 24:
                        yield pa.RecordBatch.from_pylist(rows, _RECORD)
                        rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_pylist(rows, _RECORD)
    return read


_RECORD = pa.schema([("record_id", pa.string()), ("type", pa.string()), ("concurrent_to", pa.list_(pa.string())), ("refers_to", pa.string()),
                     ("url", pa.string()), ("date", pa.string()), ("digest", pa.string()), ("status", pa.string()),
                     ("payload_bytes", pa.int64()), ("text", pa.string()), ("payload", pa.binary())])


def read_records(spark: SparkSession, archives: DataFrame, with_payload: bool = True) -> DataFrame:
    """Records of the archives in column ``path``, a row each. Every response payload is checked against its digest."""
    ship_package(spark)
    return (archives.select("path").repartition(shuffle_partitions(spark), "path")
            .mapInArrow(_reader(with_payload), "record_id string, type string, concurrent_to array<string>, refers_to string, url string, "
                                               "date string, digest string, status string, payload_bytes long, text string, payload binary"))


def captures(records: DataFrame) -> DataFrame:
    """One nested row per response or revisit: its own fields, its request and its metadata records.

    A record belongs to the capture that it names in concurrent-to, or that names it. The records are written to
    the shared folder first: archives are parsed once, and Spark joins on the records' real size instead of
    taking them for as small as the list of archives."""
    records = staged(records, "warc-records")
    main = records.where(F.col("type").isin("response", "revisit"))
    other = records.where(~F.col("type").isin("response", "revisit", "warcinfo"))
    part = F.struct("record_id", "type", "date", "text")
    names = other.select(F.explode("concurrent_to").alias("capture"), part.alias("r"))
    named = main.select(F.col("record_id").alias("capture"), F.explode("concurrent_to").alias("id"))
    named = named.join(other.select(F.col("record_id").alias("id"), part.alias("r")), "id").select("capture", "r")
    parts = (names.unionByName(named).groupBy("capture")
             .agg(F.min(F.when(F.col("r.type") == "request", F.col("r"))).alias("request"),
                  F.array_sort(F.collect_set(F.when(F.col("r.type") == "metadata", F.col("r")))).alias("metadata")))   # a few per capture
    return (main.join(parts, F.col("record_id") == F.col("capture"), "left")
            .select("record_id", "type", "url", "date", "status", "payload_bytes", "digest", "refers_to", "payload", "request", "metadata"))


def field(name: str) -> Column:
    """A warc-fields value of the capture's metadata."""
    return F.nullif(F.regexp_extract(F.array_join(F.transform("metadata", lambda m: m["text"]), "\n"), rf"(?m)^{name}: *(\S*)", 1), F.lit(""))
