import hashlib
import re
from collections import defaultdict

from dugout.llm import mixing


def targets(sizes, weights=(5, 2, 1), most=3):
    """Reference: share, cap, share the excess again until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    out, free, rest = {}, set(order), sum(sizes.values())
    while free:
        level = rest / sum(w[s] for s in free)
        over = {s for s in free if w[s] * level > most * sizes[s]}
        if not over:
            out |= {s: w[s] * level for s in free}
            break
        for s in over:
            out[s] = most * sizes[s]
            rest -= out[s]
        free -= over
    return out


def test_targets_and_exact_budget(spark, small_dir, docs_list):
    rows = mixing.mix(spark.read.parquet(f"{small_dir}/documents.parquet"), range_rows=10).collect()
    sizes, taken = defaultdict(int), defaultdict(int)
    for doc_id, text, source in docs_list:
        sizes[source] += len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    want = targets(sizes)
    assert len(rows) == len(docs_list)
    for r in rows:
        assert r["source_size"] == sizes[r["source"]] and abs(r["target"] - want[r["source"]]) < 1e-6
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
    assert all(taken[s] == int(want[s] + 1e-9) for s in sizes)
    again = mixing.mix(spark.read.parquet(f"{small_dir}/documents.parquet").repartition(5), range_rows=1000).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def test_capped_source_and_excess(spark):
    docs = spark.createDataFrame([(1, "a " * 10, "a"), (2, "b " * 100, "b"), (3, "c " * 100, "c")], "doc_id long, text string, source string")
    got = {r["source"]: (r["target"], r["taken"]) for r in mixing.mix(docs).collect()}
    assert got["a"] == (30.0, 30) and abs(got["b"][0] - 120) < 1e-9 and abs(got["c"][0] - 60) < 1e-9
    assert got["b"][1] == 120 and got["c"][1] == 60


def test_odd_rows(weird, nothing):
    rows = mixing.mix(weird).collect()
    assert len(rows) == weird.count()
    assert all(r["taken"] == 0 for r in rows if r["size"] == 0)
    assert mixing.mix(nothing).collect() == []
    assert mixing.mixed_documents(nothing).collect() == []
    out = mixing.mixed_documents(weird)
    assert out.columns == weird.columns
    assert {r["doc_id"] for r in out.collect()} <= {r["doc_id"] for r in weird.collect()}


def test_documents_come_near_targets(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    got = {r["source"]: r["s"] for r in out.groupBy("source").agg({"doc_id": "count"}).withColumnRenamed("count(doc_id)", "s").collect()}
    size = out.groupBy("source").agg(mixing.F.sum(mixing.text_size()).alias("n")).collect()
    want = {r["source"]: r["target"] for r in mixing.mix(docs).select("source", "target").distinct().collect()}
    longest = {r["source"]: r["m"] for r in docs.groupBy("source").agg(mixing.F.max(mixing.text_size()).alias("m")).collect()}
    assert got and all(abs(r["n"] - want[r["source"]]) <= longest[r["source"]] / 2 + 1 for r in size)


def test_null_and_repeated_ids_are_cut_like_others(spark):
    rows = [(None, f"n{i} " * 10, "z") for i in range(300)] + [(7, f"r{i} " * 10, "y") for i in range(300)]
    rows += [(None, "same " * 10, "x")] * 300 + [(i, "a " * 10, "a") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = {r["source"]: r["n"] for r in mixing.mixed_documents(docs, weights=(5, 2, 1, 1), range_rows=50).groupBy("source").agg(mixing.F.sum(mixing.text_size()).alias("n")).collect()}
    want = targets({s: 3000 for s in "axyz"}, weights=(5, 2, 1, 1))
    assert want["z"] < 3000 and all(abs(out[s] - want[s]) <= 6 for s in want)
    spread = mixing._placed(docs.select("doc_id", "source", mixing.text_size().alias("size"), mixing.text_key().alias("key")), (5, 2, 1, 1), 3, 50)
    assert spread.where("source = 'z'").select("range").distinct().count() > 1


def plain_mix(rows, weights=(5, 2, 1)):
    """Reference: (doc_id, size, taken) of rows (doc_id, text, source) in the order md5 of the id, id, size."""
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    by, out = defaultdict(list), []
    for d, text, source in rows:
        key = hashlib.md5(f"mix:{'null' if d is None else d}".encode()).hexdigest()
        by[source].append((key, d is None, d or 0, size(text), d))
    want = targets({s: sum(r[3] for r in part) for s, part in by.items()}, weights)
    for s, part in by.items():
        total, budget = sum(r[3] for r in part), int(want[s] + 1e-9)
        full, rest = divmod(budget, total) if total else (0, 0)
        for _, _, _, n, d in sorted(part):
            out.append((d, n, full * n + min(max(rest, 0), n)))
            rest -= n
    return sorted(out, key=str)


def test_rows_without_id_are_placed_as_counts(spark):
    rows = [(None, f"n{i} " * (1 + i % 7), "z") for i in range(3000)] + [(7, "r " * (1 + i % 5), "y") for i in range(500)]
    rows += [(None, "x " * (1 + i % 3), None) for i in range(200)] + [(i, "a " * (i % 40), "a") for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for ranges in (5, 50, 100_000):
        got = [(r["doc_id"], r["size"], r["taken"]) for r in mixing.mix(docs, range_rows=ranges).collect()]
        assert sorted(got, key=str) == plain_mix(rows)
    assert mixing._sized(docs).where("doc_id IS NULL").count() == 10     # one row a source and size, however many rows


def test_offsets_in_two_levels(spark):
    rows = [(s, f"{i:03x}", (i * 37) % 101) for s in ("a", None) for i in range(0, 4096, 3)]
    got = {(r["source"], r["range"]): r["offset"] for r in mixing._offsets(
        spark.createDataFrame(rows, "source string, range string, range_size long"), 3).collect()}
    for s in ("a", None):
        at = 0
        for _, r, n in sorted(x for x in rows if x[0] == s):
            assert got[s, r] == at
            at += n
