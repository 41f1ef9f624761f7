"""Byte-level BPE against the tiktoken library."""

import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from farol.llm import byte_bpe, queries

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    ranks = {t: i for i, t in enumerate(byte_bpe.read_ranks(PATH))}
    return tiktoken.Encoding("test", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def expected(library, text):
    ids = library.encode_ordinary(text or "")
    raw = np.array(ids, "<u4").tobytes()
    return len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(library.decode_bytes(ids)).hexdigest()


def test_query_equals_library(spark, base, library):
    got = {r["doc_id"]: tuple(r)[1:] for r in queries.op11_byte_bpe(spark, base).collect()}
    docs = spark.read.parquet(f"{base}/documents.parquet").collect()
    assert got == {r["doc_id"]: expected(library, r["text"]) for r in docs}


def test_odd_rows(odd, none, library):
    v = byte_bpe.Vocabulary(PATH)
    assert byte_bpe.digests(v.decode(v.encode(none))).count() == 0
    got = sorted((tuple(r) for r in byte_bpe.digests(v.decode(v.encode(odd))).collect()), key=str)
    assert got == sorted(((r["doc_id"], *expected(library, r["text"])) for r in odd.collect()), key=str)


def test_random_and_long_texts(library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "LONG_TEXT", 300)
    monkeypatch.setattr(byte_bpe, "RUN", 7)
    monkeypatch.setattr(byte_bpe, "KEPT", 5000)
    bpe = byte_bpe.ByteBPE(*byte_bpe.Vocabulary(PATH).spec)
    rng = random.Random(5)
    signs = [*"aeiou  \n\t'stTHE019.,!", " ", "　", "é", "漢", "😀", "́", "\x1c", "\x85", "<|endoftext|>", "'re"]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randrange(700))) for _ in range(200)] + ["", "a" * 100_000]
    for ids, text in zip(bpe.encode(texts), texts, strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(text)
        assert bpe.decode(ids) == text.encode()


def test_entry_that_merges_do_not_make(tmp_path):
    tokens = [bytes([b]) for b in range(256)] + [b"abc"]
    path = tmp_path / "ranks"
    path.write_bytes(b"".join(base64.b64encode(t) + f" {i}\n".encode() for i, t in enumerate(tokens)))
    bpe = byte_bpe.ByteBPE(*byte_bpe.Vocabulary(str(path)).spec)
    ids = [np.frombuffer(i, "<u4").tolist() for i in bpe.encode(["abc", "abcd"])]
    assert ids == [[256], [*b"abcd"]]
    path.write_bytes(b"YQ== 0\n")
    with pytest.raises(ValueError):
        byte_bpe.read_ranks(str(path))
