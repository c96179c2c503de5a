import base64
import gzip
import hashlib
import io


from dugout.llm import warc

PAGES = [
    (1, "http://a.example/x", "<p>same</p>"), (2, "http://a.example/y", "<p>same</p>"), (3, None, "<p>same</p>"),
    (4, "http://b.example/", None), (5, "http://b.example/\r\nHost: z", ""), (6, "https://c.example/ü?q=1", "é漢😀 " * 20_000),
    (7, "http://d.example", "alone"), (None, "http://e.example", "nobody"), (None, "http://e.example", "nobody"), (8, "u", "twice"), (8, "u", "twice"),
    (8, "u", "WARC/1.1\r\nContent-Length: 3\r\n\r\nabc"),
]


def expected(rows, least=0):
    top, seen, out = {}, set(), []
    for p, _, h in rows:
        h = h or ""
        top[h] = max(top.get(h, -1), -1 if p is None else p)
    for p, _, h in rows:
        h = h or ""
        b = h.encode()
        size = len(b)
        dig = base64.b32encode(hashlib.sha1(b).digest()).decode()
        first = (-1 if p is None else p) == top[h] and h not in seen
        if first:
            seen.add(h)
        if first or size < least:
            out.append((p, size, dig, "response", None))
        else:
            out.append((p, size, dig, "revisit", None if top[h] < 0 else top[h]))
    return sorted(out, key=str)


def digest_rows(spark, pages, **options):
    rows = warc.captures(warc.read_records(spark, warc.write_archives(pages, **options)))
    return rows, sorted(((r[0], r[1], r[2], r[3], r[4]) for r in rows.select(
        warc.field("page-id").cast("long"), "payload_bytes", "digest", "type", warc.field("revisits-page-id").cast("long")).collect()), key=str)


def test_round_trip(spark):
    pages = spark.createDataFrame([(*p, "clash") for p in PAGES], "page_id long, url string, html string, digest string").repartition(3)
    for least in (0, 6):
        rows, got = digest_rows(spark, pages, least_bytes=least)
        assert got == expected(PAGES, least)
    rows = warc.captures(warc.read_records(spark, warc.write_archives(pages))).collect()
    texts = {(h or "").encode() for _, _, h in PAGES}
    assert {bytes(r["payload"]) for r in rows if r["type"] == "response"} == texts
    assert all(r["request"]["text"].startswith("GET /") and len(r["metadata"]) == 1 for r in rows)
    ids = {r["record_id"] for r in rows}
    assert len(ids) == len(PAGES) and all(r["refers_to"] in ids for r in rows if r["type"] == "revisit")


def test_hot_payload_is_salted(spark, monkeypatch):
    monkeypatch.setattr(warc, "HOT", 5)
    rows = [(i, f"http://h/{i}", "hot") for i in range(60)] + [(100 + i, "u", f"p{i}") for i in range(10)]
    _, got = digest_rows(spark, spark.createDataFrame(rows, "page_id long, url string, html string"))
    assert got == expected(rows)


def test_tables(spark, small_dir):
    pages = spark.read.parquet(f"{small_dir}/pages.parquet")
    _, got = digest_rows(spark, pages)
    assert got == expected([tuple(r) for r in pages.select("page_id", "url", "html").collect()])


def test_empty(spark):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    rows, got = digest_rows(spark, none)
    assert got == []


def test_foreign_archive(spark, tmp_path):
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/plain\r\n\r\nhello"
    parts = [warc.record("warcinfo", [("WARC-Record-ID", "<i>")], b"software: x\r\n"),
             warc.record("response", [("WARC-Record-ID", "<r>"), ("WARC-Concurrent-To", "<q>"), ("Content-Type", "application/http; msgtype=response")], block),
             warc.record("request", [("WARC-Record-ID", "<q>")], b"GET / HTTP/1.1\r\n\r\n"),
             warc.record("metadata", [("WARC-Record-ID", "<m>"), ("WARC-Concurrent-To", "<r>")], b"a: 1\r\n"),
             warc.record("response", [("WARC-Record-ID", "<s>"), ("Content-Type", "application/http")], block)]
    path = tmp_path / "f.warc.gz"
    path.write_bytes(b"".join(gzip.compress(p) for p in parts))
    assert [r["warc-type"] for r in warc.parse(io.BytesIO(b"".join(parts)))] == ["warcinfo", "response", "request", "metadata", "response"]
    rows = {r["record_id"]: r for r in warc.captures(warc.read_records(spark, spark.createDataFrame([(str(path),)], "path string"))).collect()}
    assert set(rows) == {"<r>", "<s>"} and bytes(rows["<r>"]["payload"]) == b"hello" and rows["<r>"]["payload_bytes"] == 5
    assert rows["<r>"]["request"]["record_id"] == "<q>" and [m["record_id"] for m in rows["<r>"]["metadata"]] == ["<m>"]
    assert rows["<s>"]["request"] is None
