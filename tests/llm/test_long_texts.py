"""Texts beyond the production sizes of chunks, segments, windows and shards, and tables of odd columns."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

public_tokenizers = pytest.importorskip("public_tokenizers")

from confluo.llm import byte_bpe, substring_dedup, token_count, wavelet


def long_texts():
    rnd = random.Random(12)
    pieces = ["word", "naïve", "中文字", "12345", "it's", "...", "<|endoftext|>", "Ünïcödé", "a" * 30, "\n\n", "x=1;", "#tag"]
    mixed = " ".join(rnd.choice(pieces) + str(rnd.randrange(1000)) for _ in range(25_000))
    return [mixed, "z" * 90_000, " " * 80_000 + "end", "é" * 70_000, mixed[1000:60_000] + "\n" + mixed[:70_000], "ab" * 40_000 + " 1", ""]


TEXTS = long_texts()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, 1, "x") for i, t in enumerate(TEXTS)], "doc_id long, text string, n_bytes int, ids string").repartition(3)


def test_token_counts(docs):
    assert max(map(len, TEXTS)) > 4 * token_count.CHUNK
    tok = token_count.tokenizer(path := public_tokenizers.path("byte_bpe_50k.json"))
    got = {r.doc_id: (r.n_bytes, r.n_tokens) for r in token_count.count_tokens(docs, path).collect()}
    assert got == {i: (len(t.encode()), len(tok.encode(t, add_special_tokens=False))) for i, t in enumerate(TEXTS)}


def test_byte_bpe(docs):
    assert max(map(len, TEXTS)) > 2 * byte_bpe.SEGMENT
    enc, sha = byte_bpe.encoding_of(*byte_bpe.production()), lambda b: hashlib.sha256(b).hexdigest()
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in byte_bpe.digest_documents(docs, *byte_bpe.production()).collect()}
    assert got == {i: (len(ids := enc.encode_ordinary(t)), sha(np.array(ids, "<u4").tobytes()), sha(t.encode())) for i, t in enumerate(TEXTS)}


def test_passages(docs):
    """Text 4 holds most of text 0 in another order; brute force counts the windows."""
    split = [t.split() for t in (x.encode() for x in TEXTS)]
    met = {}
    for i, w in enumerate(split):
        for k in range(len(w) - 34):
            met.setdefault(tuple(w[k : k + 35]), []).append((i, k))
    gone = [set() for _ in split]
    for places in met.values():
        if len(places) > 1:
            for i, k in places:
                gone[i].update(range(k, k + 35))
    got = {r.doc_id: (r.n_words, r.n_removed, bytes(r.kept)) for r in substring_dedup.dedup_passages(docs).collect()}
    assert got == {i: (len(w), len(gone[i]), b" ".join(x for k, x in enumerate(w) if k not in gone[i])) for i, w in enumerate(split)}
    assert len(gone[0]) > 5000


@pytest.mark.parametrize("limit", [wavelet.CACHE, 50])
def test_word_encoder(limit):
    """Whole texts by their words' ids, with a cache that holds all and one that is emptied again and again."""
    encoder = wavelet.WordEncoder(path := public_tokenizers.path("word_bpe_49k.json"), limit)
    tok, rnd = token_count.tokenizer(path), random.Random(5)
    odd = ["Straße,", "É", "é", "İ", "ǅ", "a b", "it's", "'s", "...", "x<|endoftext|>y", "ß!!", "ÀÉ#", "12ab", "Σ", "ς.", " ", "ﬁ"]
    for _ in range(20):
        texts = ["".join(rnd.choice([*odd, f"Word{rnd.randrange(99)}", "abc"]) + rnd.choice([" ", "\n", "\t  ", ""]) for _ in range(rnd.randint(0, 60))) for _ in range(4)]
        ids, sizes = encoder.encode([t.encode() for t in texts])
        ends = np.cumsum(sizes)
        for t, a, b in zip(texts, ends - sizes, ends):
            assert ids[a:b].tolist() == tok.encode(t, add_special_tokens=False).ids, t


def test_shards_of_long_texts(spark, docs, tmp_path):
    tok = token_count.tokenizer(path := public_tokenizers.path("word_bpe_49k.json"))
    wavelet.write_shards(docs, path, str(tmp_path / "w"), shard_ids=30_000)
    want, start = {}, 0
    for i, t in enumerate(TEXTS):
        ids = [*tok.encode(t, add_special_tokens=False).ids, 1]
        want[i] = (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in wavelet.read_shards(spark, str(tmp_path / "w")).collect()} == want
    held = spark.read.parquet(str(tmp_path / "w"))
    assert held.count() > 3 and held.agg(F.sum("n_ids")).first()[0] == start
    blob = held.orderBy(F.desc("n_ids")).first()["payload"]
    w = wavelet.WaveletMatrix(blob)
    a, rnd = wavelet.WaveletMatrix(blob).ids(), random.Random(1)
    for i in rnd.sample(range(len(a)), 50):
        token, at = int(a[i]), np.flatnonzero(a == a[i])
        assert w.access(i) == token and w.count(token) == len(at) and w.count(token, 0, i) == (at < i).sum()
        assert w.select(token, int((at < i).sum())) == i
