import math
import re
from collections import Counter, defaultdict

from dugout.llm import decontaminate as D


def words(t):
    return [w for w in re.split(r"[\W_]+", (t or "").lower()) if w]


def brute(docs, items, t=0.8, k=5):
    """Every window of an item's length of every document, by plain weighted similarity."""
    item_words = {i: words(x) for i, x in items if words(x)}
    grams = lambda w: Counter(tuple(w[p:p + k]) for p in range(max(1, len(w) - k + 1)))
    counts = {i: grams(w) for i, w in item_words.items()}
    df = Counter(g for c in counts.values() for g in c)
    n = len(counts)
    weight = lambda g: 1 + math.log(n / df.get(g, 1))
    out = {}
    for d, text in docs:
        w = words(text)
        held = defaultdict(list)
        for p in range(len(w) - k + 1):
            held[tuple(w[p:p + k])].append(p)
        for i, c in counts.items():
            size = len(item_words[i])
            if not any(g in held for g in c) and size >= k:
                continue
            best = 0
            for p in range(len(w) - size + 1):
                x = grams(w[p:p + size])
                both = set(x) | set(c)
                s = sum(weight(g) * min(x[g], c[g]) for g in both) / sum(weight(g) * max(x[g], c[g]) for g in both)
                best = max(best, s)
            if best >= t:
                out[d, i] = best
    return out


def test_against_every_window(spark, small_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{small_dir}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{small_dir}/benchmark.parquet").select("item_id", "text").collect()]
    long = max(items, key=lambda x: len(words(x[1])))
    w = words(long[1])
    docs += [(9001, "Before. " + " ".join(w[:-1] + ["changed"]) + " after it all"), (9002, " ".join(w).upper()), (9003, " ".join(w[: len(w) // 2])),
             (9004, "x " * 50 + ", ".join(w) + " y" * 20), (9005, " ".join(["other"] + w[1:]))]
    items += [(9100, "tiny item"), (9101, None), (9102, "")]
    docs += [(9006, "here a Tiny item stands"), (9007, "tiny thing item")]
    want = brute(docs, items)
    got = D.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == set(want)
    assert all(abs(r["similarity"] - want[r["doc_id"], r["item_id"]]) < 1e-9 for r in got)
    assert {9001, 9002, 9004, 9005, 9006} <= {r["doc_id"] for r in got} and not {9003, 9007} & {r["doc_id"] for r in got}


def test_clipped_shortened_and_swapped_items(spark):
    w = [f"w{i}" for i in range(55)]
    pad = [f"p{i}" for i in range(70)]
    items = [(1, " ".join(w)), (2, " ".join(f"v{i}" for i in range(55))), (3, "tiny item")]
    docs = [(1, w[2:] + pad), (2, pad + w[:-2]), (3, w[:-1]), (4, w[1:]), (5, pad + w[28:] + w[:28] + pad), (6, w[28:] + w[:28]),
            (7, pad + w[:20] + ["more"] + w[20:] + pad), (8, w[:30]), (9, w[20:] + pad), (10, w[:3]), (11, w), (12, ["tiny"]), (None, w[2:] + pad)]
    docs = [(d, " ".join(x)) for d, x in docs]
    shorter = [(d, t) for d, t in docs if len(t.split()) < 55]
    want = brute(docs, items)
    for d, t in shorter:                                  # the whole document is the window
        x, c = [Counter(tuple(v[p:p + 5]) for p in range(len(v) - 4)) for v in (t.split(), w)]
        if (s := sum((x & c).values()) / sum((x | c).values())) >= 0.8:   # all shingles weigh the same here
            want[d, 1] = s
    got = D.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == set(want) == {(d, 1) for d in (1, 2, 3, 4, 5, 6, 7, 11, None)}
    assert all(abs(r["similarity"] - want[r["doc_id"], r["item_id"]]) < 1e-9 for r in got)
    assert {r["doc_id"]: r["n_words"] for r in got}[3] == 54


def test_recall_of_edited_items(spark, small_dir):
    """Items cut, swapped and edited at their edges down to the threshold: what the radius leaves out is under 2 %."""
    items = [tuple(r) for r in spark.read.parquet(f"{small_dir}/benchmark.parquet").select("item_id", "text").collect()]
    docs, n = [], 0
    for _, text in items:
        w = words(text)
        for first, last in ((0, 3), (0, 4), (0, 5), (1, 1), (2, 2), (3, 0)):
            edited = [f"x{n}y{i}" for i in range(first)] + w[first:len(w) - last] + [f"z{n}q{i}" for i in range(last)]
            docs.append((n, " ".join(edited)))
            n += 1
        half = len(w) // 2
        docs.append((n, " ".join(w[half:] + w[:half])))
        docs.append((n + 1, " ".join(w[:half] + [f"m{n}"] + w[half + 1:])))
        n += 2
    want = brute(docs, items, 0.8 - 1e-9)              # as contaminated does, for equality up to rounding
    got = D.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    found = {(r["doc_id"], r["item_id"]) for r in got}
    print(f"pairs {len(want)}, found {len(found)}, largest distance {max(r['hamming'] for r in got)}")
    assert want and found <= set(want) and len(found) >= 0.98 * len(want)
    assert all(r["hamming"] <= D.RADIUS for r in got)


def test_only_pairs_of_the_blocks_are_verified(spark, small_dir, monkeypatch):
    docs, items = (spark.read.parquet(f"{small_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    real = D.hamming_join
    monkeypatch.setattr(D, "hamming_join", lambda *a, **b: real(*a, **b).limit(0))
    assert D.contaminated(docs, items).collect() == []


def test_blocks_find_all_within_radius(spark):
    import random
    rng = random.Random(5)
    half = lambda x: x - (1 << 64) if x >> 63 else x
    halves = lambda x: (half(x & (1 << 64) - 1), half(x >> 64))
    base = [rng.getrandbits(128) for _ in range(30)]
    near, prints = [], {}
    for i, b in enumerate(base):
        for d in range(0, 45, 3):
            x = b
            for bit in rng.sample(range(128), d):
                x ^= 1 << bit
            prints[i * 100 + d] = x
            near.append((i * 100 + d, 7, *halves(x)))
    left = spark.createDataFrame(near, "content long, n_words int, print1 long, print2 long")
    right = spark.createDataFrame([(i, 7, *halves(b)) for i, b in enumerate(base)], "item_id long, n_words int, item_print1 long, item_print2 long")
    for radius in (3, 15, 31):
        got = sorted((r["content"], r["item_id"], r["hamming"]) for r in D.hamming_join(left, right, radius).collect())
        want = sorted((c, i, (x ^ y).bit_count()) for c, x in prints.items() for i, y in enumerate(base) if (x ^ y).bit_count() <= radius)
        assert got == want
    assert len(D.near_masks(3)) == 1 + 16 + 120 + 560 and D.BLOCKS * (D.RADIUS // D.BLOCKS + 1) > D.RADIUS


def test_odd_rows(spark, weird, nothing):
    items = spark.createDataFrame([(1, "alpha beta gamma delta epsilon zeta eta theta", "x"), (1, "alpha beta gamma delta epsilon zeta eta theta", "x"),
                                   (2, None, None), (None, "one", "y")], "item_id long, text string, words string")
    got = D.contaminated(weird, items).collect()
    assert sorted(str(r["doc_id"]) for r in got if r["item_id"] == 1) == ["5", "6", "None"]
    out = D.remove_contaminated(weird, items.where("item_id = 1"))
    assert out.columns == weird.columns and sorted(str(r["doc_id"]) for r in out.collect()) == sorted(map(str, [1, 2, 3, 4, None, 7, 8]))
    none = items.where("item_id = 5")
    assert D.contaminated(weird, none).collect() == [] and D.contaminated(nothing, items).collect() == []
    assert D.remove_contaminated(weird, none).count() == weird.count()


def test_no_python_in_plan(spark, small_dir):
    docs, items = (spark.read.parquet(f"{small_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    plan = D.contaminated(docs, items)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
