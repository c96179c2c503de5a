import random
import re
from collections import Counter, defaultdict

import numpy as np

from dugout.llm import jaccard_join as J
from dugout.llm.shingles import shingle_hashes


def shingles(text, k=5):
    w = [x for x in re.split(r"[ \t\n\r\x0b\x0c]+", (text or "").lower()) if x]
    return frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def brute(docs, t=0.8):
    sets, held = [shingles(x) for _, x in docs], defaultdict(list)
    links, root = Counter(), list(range(len(docs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, s in enumerate(sets):
        for j, n in Counter(j for x in s for j in held[x]).items():
            if n >= t * (len(s) + len(sets[j]) - n) - 1e-9:
                links[i] += 1
                links[j] += 1
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
        for x in s:
            held[x].append(i)
    groups = defaultdict(list)
    for i in range(len(docs)):
        groups[find(i)].append(docs[i][0])
    return [(docs[i][0], min(groups[find(i)]), links[i]) for i in range(len(docs))]


def test_against_brute_force(spark, docs_list):
    docs = [(d, t) for d, t, _ in docs_list]
    got = J.similar_documents(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"], r["class_id"], r["n_links"]) for r in got) == sorted(brute(docs))


def test_large_group_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(J, "BLOCK_ROWS", 16)
    rng = random.Random(3)
    base = [f"w{rng.randrange(500)}" for _ in range(150)]
    docs = []
    for i in range(90):
        w = list(base)
        for _ in range(rng.randrange(0, 4)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
        docs.append((i, " ".join(w)))
    docs += [(100 + i, docs[0][1]) for i in range(30)] + [(200, "something else entirely here and there again")]
    got = J.similar_documents(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"], r["class_id"], r["n_links"]) for r in got) == sorted(brute(docs))
    kept = J.one_of_each(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert sorted(r["doc_id"] for r in kept) == sorted({c for _, c, _ in brute(docs)})


def test_pruning_bound():
    least = J.least_matches(0.8, 1e-6)
    assert least[128] < 128 * 0.8 and all(least[n] <= n for n in least)
    assert sum(1 for n in least if least[n] > 0) == len(least)


def test_shingles_equal_plain_ones():
    texts = ["a b c d e f", "A  b\tc\nd e f", "a b", "", None, "é " * 9, "x" * 70_000 + " y z", "a b c d e f g"]
    parts = list(shingle_hashes(texts, batch_bytes=10))
    got, at = [], 0
    for _, h, n in parts:
        ends = np.cumsum(n)
        got += [set(h[e - c:e].tolist()) for e, c in zip(ends, n)]
    for i, a in enumerate(texts):
        assert len(got[i]) == len(shingles(a))
        for j, b in enumerate(texts):
            assert len(got[i] & got[j]) == len(shingles(a) & shingles(b))


def test_odd_rows(weird, nothing):
    rows = J.similar_documents(weird).collect()
    assert len(rows) == weird.count()
    same = [r for r in rows if r["n_links"]]
    assert len(same) == 4 and {r["class_id"] for r in same} == {5} and {r["n_links"] for r in same} == {3}
    assert all(r["class_id"] == r["doc_id"] for r in rows if not r["n_links"])
    out = J.one_of_each(weird)
    assert out.columns == weird.columns
    assert sorted(str(r["doc_id"]) for r in out.collect()) == sorted(map(str, [1, 2, 3, 4, 5, None, 7, 8]))
    assert J.similar_documents(nothing).collect() == [] and J.one_of_each(nothing).collect() == []


def test_repeated_winner_stays_once(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g")] * 3 + [(2, "a b c d e f g"), (3, "other words are here today friends")], "doc_id long, text string")
    assert sorted(r["doc_id"] for r in J.one_of_each(docs).collect()) == [1, 3]


def test_classes_without_or_with_shared_ids_each_keep_one(spark):
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(9)) for x in "abcd")
    docs = spark.createDataFrame([(None, a), (None, a), (None, b), (None, b), (1, c), (1, c), (2, c), (1, d), (3, d)], "doc_id long, text string")
    got = sorted(tuple(r) for r in J.one_of_each(docs).select("text", "doc_id").collect())
    assert got == [(a, None), (b, None), (c, 1), (d, 1)]
