"""The trie against a plain one, its shards and bands, and its queue."""

import hashlib
import random
import zlib

import pytest

from dugout.llm import prefix_trie
from dugout.llm.prefix_trie import SpillingQueue

SCHEMA = "conv_id long, turn long, role string, text string, depth int"


def plain(rows):
    convs = {}
    for c, turn, role, text, *_ in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    convs = {c: [t[2:] for t in sorted(ts)] for c, ts in convs.items()}
    nodes = {}
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        path = tuple(convs.get(c - c % 100, [])[:h] + turns[h:])
        for d in range(len(path) + 1):
            nodes.setdefault(path[:d], [[], []])[0].append(c)
        nodes[path][1].append(c)
    out = []
    kids = {}
    for p in nodes:
        if p:
            kids.setdefault(p[:-1], []).append(p)
    total = {}
    for p in sorted(nodes, key=len, reverse=True):
        leaves = sum(total[k][0] for k in kids.get(p, [])) or 1
        saved = sum(total[k][1] for k in kids.get(p, [])) + ((len(nodes[p][0]) - 1) * len(p[-1][1]) if p else 0)
        total[p] = (leaves, saved)
    for p, (members, ends) in nodes.items():
        sha = hashlib.sha256(",".join(map(str, sorted(ends))).encode()).hexdigest()
        out.append((min(members), len(p), min(nodes[p[:-1]][0]) if p else None, len(members), len(kids.get(p, [])), *total[p], sha))
    return sorted(out, key=str)


def made(spark, rows, **options):
    got = prefix_trie.prefix_trie(spark.createDataFrame(rows, SCHEMA), **options).collect()
    return sorted((tuple(r) for r in got), key=str)


def table(seed, convs=120, most=12):
    r = random.Random(seed)
    rows = []
    for c in range(convs):
        c = c * 7 % 350
        for t in range(r.randint(1, most)):
            rows.append((c, t, r.choice(["user", "assistant"]), r.choice("ab") * (t + 1), 1))
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("options", [{}, {"least_rows": 20, "shards": 1000}, {"least_rows": 3, "shards": 10_000, "band": 2, "limit": 3},
                                     {"least_rows": 1, "shards": 10_000, "band": 3, "limit": 2, "piece": 1}])
def test_equals_a_plain_trie(spark, options):
    rows = table(5)
    assert made(spark, rows, **options) == plain(rows)


def test_one_long_conversation_and_many_equal_ones(spark):
    rows = [(1000, t, "user", f"t{t}", 0) for t in range(400)]                  # a chain of bands
    rows += [(c, t, "user", "same", 0) for c in range(1, 200) for t in range(2)]
    assert made(spark, rows, least_rows=30, shards=10_000, band=16, limit=5, piece=7) == plain(rows)


def test_cases(spark):
    rows = [(None, 1, "user", "lost", 1), (5, None, None, None, None), (5, 1, "user", "é😀", 1), (5, 1, "assistant", "é😀", 1), (5, 1, "assistant", "é😀", 1),
            (105, 0, "user", "x", 1), (100, 0, "user", "y" * 100_000, 1), (100, 1, None, "z", 1), (-3, 0, "user", "x", 1), (207, 3, "user", "", 1),
            (207, None, "user", "", 1)]
    assert made(spark, rows) == plain([(c, *r) for c, *r in rows])
    assert made(spark, []) == []


def test_turnless_conversations_are_members_of_the_root(spark):
    c = next(c for c in range(201, 300) if zlib.crc32(str(c).encode()) % 6 == 5)  # no conversation 200 to take turns from
    got = made(spark, [(c, 0, "user", "x", 1)])
    assert got == [(c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())]


@pytest.mark.parametrize("limit", [2, 7, 1000])
def test_queue_gives_entries_in_order_whatever_is_spilled(limit):
    r = random.Random(limit)
    queue, want, got = SpillingQueue(limit, 3), [], []
    for level in range(20):
        for _ in range(r.randint(0, 30)):
            e = (level + 1, r.randint(-9, 9), r.randint(0, 5), r.randint(0, 99))
            want.append(e)
            queue.push(e)
        got += list(queue.pop_upto((level, 9, 9)))
    got += list(queue.pop_upto((99, 0, 0)))
    assert got == sorted(want)
    assert (queue.spilled > 0) == (limit < 1000)
