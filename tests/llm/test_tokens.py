import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from dugout.llm import token_counts as C
from dugout.llm import token_pack as P
from dugout.llm.encoding import WordEncoder

from .conftest import LONG, WEIRD

WORDS = public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
TEXTS = [r[1] for r in WEIRD if r[1]] + ["a\tb\r\n\n c", "J̌ İ ΑΣ ΣΑΣ", "don't... (e.g.) 12345's", "x<|startoftext|>y z", "  lead", "ﬁ ﬀ Å K ẞ é é"]


@pytest.mark.parametrize("bits", [1, 3, 8, 13, 16, 17, 31, 32])
def test_pack_round_trip(bits):
    rng = np.random.default_rng(bits)
    for n in (0, 1, 7, 8, 1000):
        ids = rng.integers(0, 1 << bits, n, dtype=np.uint64).astype("<u4")
        data = P.pack(ids, bits)
        assert len(data) == (n * bits + 7) // 8 and (P.unpack(data, bits, n) == ids).all()


def test_bits():
    assert [P.bits_for(n) for n in (1, 2, 3, 256, 257, 49408, 65536, 65537)] == [1, 1, 2, 8, 9, 16, 16, 17]


def test_words_encode_like_whole_texts(docs_list):
    plain = Tokenizer.from_file(WORDS)
    for held in (1_000_000, 50):            # also with a memory that is emptied all the time
        enc = WordEncoder(WORDS, words_held=held)
        for t in TEXTS + [t for _, t, _ in docs_list][:120]:
            assert np.frombuffer(enc.encode(t), "<u4").tolist() == plain.encode(t or "", add_special_tokens=False).ids


def test_capitals_beside_a_capital_sigma():
    plain, enc = Tokenizer.from_file(WORDS), WordEncoder(WORDS)
    for t in ("The sum Σ over All World", "ΣΑΣ, The END. aB Ab", "the sum over all world", "The World"):
        assert np.frombuffer(enc.encode(t), "<u4").tolist() == plain.encode(t, add_special_tokens=False).ids


def expected(rows):
    plain, at, out = Tokenizer.from_file(WORDS), 0, []
    for doc_id, text in rows:
        ids = plain.encode(text or "", add_special_tokens=False).ids + [1]
        out.append((doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def test_files_hold_the_ids(spark, docs_list, small_dir, monkeypatch, tmp_path):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    manifest = P.write_shards(docs, WORDS, str(tmp_path / "shards"), shards=3)
    got = sorted((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in P.read_documents(spark, manifest).collect())
    assert got == expected([(d, t) for d, t, _ in docs_list])
    shard = P.Shard(manifest.orderBy("shard").first()["path"])
    every = shard.ids(0, shard.n_ids)
    for a, b in ((0, 1), (5, 5), (shard.n_ids - 3, shard.n_ids), (17, min(70_000, shard.n_ids))):
        assert (shard.ids(a, b) == every[a:b]).all()
    assert not list((tmp_path / "shards").glob("*.part"))


def test_blocks_cross_documents(tmp_path):
    from dugout.llm.files import published
    rng, uri = np.random.default_rng(1), str(tmp_path / "s.dtok")
    docs = [rng.integers(0, 5000, n, dtype=np.uint64).astype("<u4") for n in (0, 10, P.BLOCK, 3 * P.BLOCK + 5, 1)]
    with published(uri) as out:
        w = P.ShardWriter(out, 13)
        for i, d in enumerate(docs):
            w.add(None if i == 0 else i, d)
        w.finish()
    s = P.Shard(uri)
    assert s.nulls.tolist() == [True] + [False] * 4 and len(s.offsets) == 5
    assert all((s.ids(s.starts[i], s.starts[i + 1]) == d).all() for i, d in enumerate(docs))


def test_odd_rows_packed(weird, nothing, spark):
    got = P.pack_documents(weird, WORDS).collect()
    assert len(got) == len(WEIRD) and sum(r["doc_id"] is None for r in got) == 2
    order = sorted(got, key=lambda r: r["start"])
    assert [r["start"] for r in order] == np.cumsum([0] + [r["n_tokens"] for r in order])[:-1].tolist()
    assert [r["doc_id"] for r in order if r["doc_id"] is not None] == sorted(r[0] for r in WEIRD if r[0] is not None)
    assert P.pack_documents(nothing, WORDS).collect() == []


def lines(text):
    out, at = [], 0
    for part in text.split("\n"):
        out.append((at, min(at + len(part) + 1, len(text))))
        at += len(part) + 1
    return out[:-1] if len(out) > 1 and out[-1][0] >= len(text) else out


@pytest.mark.parametrize("rule", C.RULES)
def test_attribution(rule, docs_list):
    enc, _ = C.vocabulary(RANKS)
    for text in TEXTS + ["a\n\n\nb", "\n", "é\n漢\n😀😀\n", "x\n"] + [t for _, t, _ in docs_list][:60]:
        if not text or len(text) > 50_000:
            continue
        starts, ends, tokens, crossing = C.count_text(text, RANKS, rule)
        want = lines(text)
        assert list(zip(starts.tolist(), ends.tolist())) == want
        char = [i for i, ch in enumerate(text) for _ in ch.encode()]
        counts, at = [0.0] * len(want), 0
        for i in enc.encode_ordinary(text):
            n = len(enc.decode_single_token_bytes(i))
            a, b = char[at], char[at + n - 1] + 1
            at += n
            share = [(max(0, min(b, y) - max(a, x)), -s) for s, (x, y) in enumerate(want)]
            if rule == "share":
                for c, s in share:
                    counts[-s] += c / (b - a)
            else:
                counts[-max(share)[1] if rule == "most" else next(-s for c, s in share if c)] += 1
        assert np.allclose(tokens, counts) and abs(tokens.sum() - len(enc.encode_ordinary(text))) < 1e-6


def test_odd_rows_counted(weird, nothing):
    got = C.section_tokens(weird, RANKS).collect()
    assert sum(r["section"] == 0 for r in got) == len(WEIRD)
    empty = [r for r in got if r["doc_id"] in (1, 2)]
    assert [(r["n_tokens"], r["end_char"], r["doc_tokens"]) for r in empty] == [(0, 0, 0)] * 2
    assert next(r for r in got if r["doc_id"] == 7)["end_char"] == len(LONG)
    assert C.section_tokens(nothing, RANKS).collect() == []
    with pytest.raises(ValueError):
        C.section_tokens(nothing, RANKS, "half")
