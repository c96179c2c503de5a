import random
import re

from dugout.llm import license_scan as S

from .conftest import WEIRD

PHRASES = {p: x for p, x in S.BASE.items()}
UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UP))
    at = [(i, x) for p, x in PHRASES.items() for i in range(len(w)) if w[i:i + len(p.split())] == p.split()]
    starts = [i for i, _ in at]
    return len(w), len(at), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in at}))


TEXTS = ["Licensed under CC BY-NC 4.0.", "CC  by, cc-BY; cc by", "All rights\nreserved. ALL RIGHTS RESERVED all rights", "General Public Licence",
         "GNU General Public License, general public license", "all rightſ reserved", "ALL RIGHTS RESERVED", "all rıghts reserved", "K cc by", "x" * 100_000 + " cc by",
         "Permission is hereby granted, free of charge, to any person obtaining one copy of it",
         "Redistribution and use in source and any binary forms, with or without modification, are permitted", "cc", "by cc by"]


def test_base_contract(spark, docs_list):
    rows = [(d, t) for d, t, _ in docs_list] + [(10_000 + i, t) for i, t in enumerate(TEXTS)]
    got = {r["doc_id"]: r for r in S.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for d, t in rows:
        r = got[d]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == plain(t), t
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1
        assert r["labels"] == ",".join(sorted(set(r["labels"].split(","))))


def test_diagonals_merge(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)]
    found = {(r["doc_id"], r["label"]): r for r in S.spans(spark.createDataFrame(rows, "doc_id long, text string"), S.templates(spark)).collect()}
    assert found[0, "cc-by-nc-4.0"]["score"] == 1.0 and (10, "mit") in found
    moved = found[11, "bsd"]                       # one word put in: two diagonals, one span
    assert 0.8 <= moved["score"] < 1 and moved["first_word"] == 0 and moved["n_words"] == 15
    assert not [k for k in found if k[0] == 3]


def own_labels(text):
    """Plain check of the method's statements: some run of diagonals within reach holds the share of a statement's pairs."""
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.translate(UP))
    found, best = set(), 0.0
    for phrase, label in S.STATEMENTS.items():
        t = phrase.split()
        grams = len(t) - 1
        hits = {(i - j, j) for i in range(len(w) - 1) for j in range(grams) if w[i:i + 2] == t[j:j + 2]}
        for d in {d for d, _ in hits}:
            score = len({j for e, j in hits if d <= e <= d + S.reach(grams)}) / grams
            if score >= S.SHARE:
                found.add(label)
                best = max(best, score)
    return found, best


def noisy(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        at = rng.randrange(1, len(words) - 1)
        kind = rng.choice("iidr")
        if kind == "i":
            words[at:at] = [f"x{rng.randrange(99)}" for _ in range(rng.randint(1, S.GAP))]
        elif kind == "d":
            del words[at]
        else:
            words[at] = f"y{rng.randrange(99)}"
    return words


def test_planted_statements_in_noise(spark):
    rng, rows, planted = random.Random(3), [], {}
    for phrase, label in S.STATEMENTS.items():
        t = phrase.split()
        for edits in (0, 1, 2):
            if edits and len(t) < 12 * edits:
                continue
            # words of the statement itself, again and again, before and after it
            around = [t[:2] * rng.randint(1, 25), [f"z{rng.randrange(50)}" for _ in range(20)], t[-3:] * rng.randint(1, 9)]
            planted[len(rows)] = (label, edits)
            rows.append((len(rows), " ".join(around[rng.randrange(2)] + noisy(rng, t, edits) + around[2 if rng.random() < 0.5 else 1])))
    rows += [(1000, "this source " * 20 + "this source code form is subject to the terms of the famous mozilla public license"),
             (1001, "this source code " * 8 + "this source code form is subject to the terms of the famous mozilla public license"),
             (1002, "this source code form is subject " * 30), (1003, "of the software " * 3000)]
    got = {r["doc_id"]: r for r in S.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for d, text in rows:
        labels, best = own_labels(text)
        r = got[d]
        assert set(filter(None, r["labels"].split(","))) == labels | set(filter(None, r["base_labels"].split(","))), text
        assert abs(r["score"] - (1.0 if r["base_labels"] else best)) < 1e-12
    kept = [label in got[d]["labels"].split(",") for d, (label, edits) in planted.items()]
    print(f"planted statements found: {sum(kept)} of {len(kept)}")
    assert sum(kept) >= 0.97 * len(kept)
    assert "mpl-2.0" in got[1000]["labels"] and "mpl-2.0" in got[1001]["labels"] and got[1002]["labels"] == "" and got[1003]["labels"] == ""


def test_odd_rows(spark, weird, nothing):
    rows = S.scan(weird).collect()
    assert len(rows) == len(WEIRD) and all(r["labels"] == "" and r["score"] == 0.0 and r["first_word"] is None for r in rows)
    twice = S.scan(spark.createDataFrame([(1, "cc by")] * 2 + [(None, "cc by")], "doc_id long, text string")).collect()
    assert [r["n_base"] for r in twice] == [1, 1, 1]
    assert S.scan(nothing).collect() == []
