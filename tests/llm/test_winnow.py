import hashlib

from dugout.llm import winnow as N

from .conftest import WEIRD


def plain(text, k=N.K, w=N.WINDOW):
    h = [int(x) for x in N.gram_hashes(text, k)]
    out = []
    for i in range(max(0, len(h) - min(w, len(h)) + 1) if h else 0):
        m = min(range(i, i + min(w, len(h))), key=lambda j: (h[j] >> 32, -j))
        if not out or out[-1] != m:
            out.append(m)
    return [h[j] for j in out], out


def test_marks(docs_list):
    for text in ["", "a", "ab" * 200, "x" * 500, "漢😀é" * 30] + [t for _, t, _ in docs_list][:25]:
        hashes, positions = N.winnow(text)
        assert (hashes.tolist(), positions.tolist()) == plain(text)


def test_match_guarantee():
    shared = "the shared stretch of forty chars or more"
    assert len(shared) >= N.WINDOW + N.K - 1
    a, b = "0123456789 prefix " + shared + " tail A", "another and longer beginning here " + shared + "!"
    assert set(N.winnow(a)[0].tolist()) & set(N.winnow(b)[0].tolist())


def test_edited_pairs(spark, docs_list, small_dir):
    for shards in (1, 7):
        got = {r["doc_id"]: r for r in N.edited_pairs(spark.read.parquet(f"{small_dir}/documents.parquet"), shards).collect()}
        assert len(got) == len(docs_list)
        for i, (d, text, _) in enumerate(docs_list):
            text, other = text or "", docs_list[(i + 1) % len(docs_list)][1] or ""
            new = text[:len(text) - len(text) // 2] + other[:len(text) // 2]
            r = got[d]
            assert r["n_chars"] == len(text) and r["edited_sha256"] == hashlib.sha256(new.encode()).hexdigest()
            assert r["fingerprint"] == N.digest(*N.winnow(text)) and r["edited_fingerprint"] == N.digest(*N.winnow(new))
            a, b, c = (set(N.winnow(t)[0].tolist()) for t in (text, new, other))
            assert abs(r["near_edited"] - len(a & b) / len(a | b)) < 1e-12 and abs(r["near_next"] - len(a & c) / len(a | c)) < 1e-12


def test_odd_rows(spark, weird, nothing):
    rows = N.edited_pairs(weird).collect()
    assert len(rows) == len(WEIRD)
    same = {r["fingerprint"] for r in rows if r["n_chars"] == len(WEIRD[4][1])}
    assert len(same) == 1
    assert N.edited_pairs(nothing).collect() == []
    one = N.edited_pairs(spark.createDataFrame([(5, "abcdef")], "doc_id long, text string")).collect()
    assert one[0]["edited_sha256"] == hashlib.sha256(b"abcabc").hexdigest()
    marks = N.fingerprints(weird).collect()
    assert len(marks) == len(WEIRD) and all(len(r["hashes"]) == len(r["positions"]) for r in marks)
    assert N.likeness(*[N.winnow("")[0]] * 2) == 1.0 and N.likeness(N.winnow("")[0], N.winnow("abc")[0]) == 0.0
