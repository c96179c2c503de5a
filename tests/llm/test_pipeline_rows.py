"""run()'s rows against the pieces' brute-force versions, chained in the order of the stages."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import xxhash
from tokenizers import Tokenizer

import corpus_pipeline
from dugout.llm import toxicity
from tests.llm.test_decontaminate import brute as windows
from tests.llm.test_jaccard_join import brute as links
from tests.llm.test_mixing import targets


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def plain_mixed(docs):
    """Whole documents of each source in the order of a hash, up to the first less than half of which is within the budget."""
    by, sizes = defaultdict(list), Counter()
    for d, text, source in docs:
        hashed = xxhash.xxh64_intdigest(text or "", seed=42)
        hashed -= (hashed >> 63) << 64
        by[source].append((hashlib.md5(f"mix:{d}:{hashed}".encode()).hexdigest(), d, text))
        sizes[source] += size(text)
    want, out = targets(sizes), []
    for s, rows in by.items():
        full, rest = divmod(int(want[s] + 1e-9), sizes[s])
        cut = False
        for _, d, text in sorted(rows):
            n = size(text)
            cut = cut or (n > 0 and 2 * rest < n)
            rest -= n
            out += [(d, text)] * (full + (not cut))
    return out


def test_rows_of_run(spark, small_dir):
    read = lambda t: spark.read.parquet(f"{small_dir}/{t}.parquet")
    docs = [tuple(r) for r in read("documents").select("doc_id", "text", "source").collect()]
    assert len({d for d, _, _ in docs}) == len(docs)
    # 1: the plain chain is held against the fitted one in test_toxicity
    chain = toxicity.fit(read("documents"), toxicity.with_categories(read("labels")))
    toxic = {d for d, text, _ in docs if chain.score([text or ""])[0, -1] >= toxicity.THRESHOLD}
    docs = [r for r in docs if r[0] not in toxic]
    # 2: the smallest id of each class of linked documents
    stay = {c for _, c, _ in links([(d, t) for d, t, _ in docs])}
    docs = [r for r in docs if r[0] in stay]
    # 3: every window of a benchmark item's length
    items = [tuple(r) for r in read("benchmark").select("item_id", "text").collect()]
    leaked = {d for d, _ in windows([(d, t) for d, t, _ in docs], items, 0.8 - 1e-9)}
    docs = [r for r in docs if r[0] not in leaked]
    # 4
    mixed = plain_mixed(docs)
    # 5: ids by the tokenizer itself, the end id after each
    tokenizer = Tokenizer.from_file(corpus_pipeline.TOKENIZER)
    want, ids_of = Counter(), {}
    for d, text in mixed:
        if d not in ids_of:
            ids_of[d] = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        want[d, len(ids_of[d]), zlib.crc32(ids_of[d].tobytes())] += 1
    got = corpus_pipeline.run(spark, small_dir).collect()
    assert toxic and leaked and len(stay) < 200
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == want
    at, ends = 0, sorted((r["start"], r["n_tokens"], r["doc_id"]) for r in got)
    assert [d for _, _, d in ends] == sorted(d for _, _, d in ends)
    for start, n, _ in ends:
        assert start == at
        at += n
