"""Row by row: ids that are unknown or repeated, hashes that hold, every stage on odd and empty tables."""

import hashlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from farol.llm import decontaminate, exact_dedup, jaccard_join, suffix_dedup
from farol.llm.shingles import word_hashes


def thue_morse(n, flip=0):
    return "".join("ab"[(i.bit_count() + flip) % 2] for i in range(n))


def test_complementary_words_differ(documents, spark):
    one, other = thue_morse(1024), thue_morse(1024, 1)
    assert word_hashes(one.encode())[0] != word_hashes(other.encode())[0]
    assert np.array_equal(word_hashes(b" The\tend\x0b"), word_hashes(b"the END"))
    tail = "and some more words that follow it here"
    docs = documents([(1, f"{one} {tail}"), (2, f"{other} {tail}"), (3, f"{one} {tail}")])
    got = {r["doc_id"]: r["component_id"] for r in jaccard_join.near_duplicates(docs).collect()}
    assert got == {1: 1, 2: 2, 3: 1}
    items = spark.createDataFrame([(7, one)], "item_id long, text string")
    assert {r["doc_id"] for r in decontaminate.find_leaks(docs, items).collect()} == {1, 3}


def brute_repeats(rows):
    """op2 on (id, text) rows: sorted (id, bytes, removed, spans, digest)."""
    ordered = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, (r[1] or "").encode()))
    seen, out = set(), []
    for i, text in ordered:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for at in range(len(raw) - 99):
            s = raw[at:at + 100]
            if s in seen:
                gone[at:at + 100] = b"\1" * 100
            seen.add(s)
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        spans = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        out.append((i, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def test_repeats_judge_every_row(documents):
    long = " ".join(f"word{i}" for i in range(60))
    rows = [(None, long), (None, "x" * 150), (None, None), (5, "short"), (5, long[30:]), (5, "y" * 130), (2, long[:300]), (2, long[:300])]
    got = sorted((tuple(r) for r in suffix_dedup.remove_repeats(documents(rows)).collect()), key=str)
    assert got == brute_repeats(rows)


def test_one_row_of_a_group_stays(documents):
    rows = [(1, "s"), (1, "s"), (2, "s"), (None, "s "), (None, "s "), (None, "t"), (None, "t"), (4, None), (4, "")]
    got = [tuple(r)[:4] for r in exact_dedup.exact_duplicates(documents(rows)).collect()]
    assert Counter(k for _, _, _, k in got) == {True: 3, False: 6}
    assert sorted((r[0] is None, r[1], r[2]) for r in got if r[3]) == [(False, 4, 2), (True, None, 2), (True, None, 5)]


TEXT = "Ein Dokument mit vielen ganz verschiedenen Wörtern, die man zählen kann, Nummer"


@pytest.fixture(scope="module")
def mixed(documents):
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi".split()
    base = " ".join(words)
    rows = [
        (1, "same text here"), (2, "same text  here"), (1, "another one that stays here"), (None, base), (None, base), (None, "no id but a text of its own"),
        (7, base + " omega"), (8, None), (9, ""), (10, None), (None, None),
    ]
    return rows, documents(rows)


def kept(df):
    return sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=str)


def test_exact_stage_keeps_one_row_each(spark, base, mixed):
    rows, docs = mixed
    out = corpus_pipeline.drop_exact_copies(spark, docs, base)
    assert out.columns == docs.columns
    best = {}
    for i, t in rows:
        key = "".join((t or "").split())
        rank = (-len(t or ""), i is None, i or 0, t or "")
        if key not in best or rank < best[key][0]:
            best[key] = (rank, i)
    got = kept(out)
    assert sorted(("".join((t or "").split()), i) for i, t in got) == sorted(((k, v[1]) for k, v in best.items()), key=str) or len(got) == len(best)
    assert [(i, t) for i, t in got if t and "same" in t] == [(2, "same text  here")]
    assert len(got) == len(best)


def test_near_stage_goes_row_by_row(spark, base, mixed):
    rows, docs = mixed
    got = kept(corpus_pipeline.drop_near_copies(spark, docs, base))
    texts = Counter((t or "") for _, t in got)
    assert texts[""] == 4 and sum(t.startswith("alpha") for t in texts.elements()) == 1
    assert (None, "no id but a text of its own") in got and (1, "another one that stays here") in got
    assert [i for i, t in got if t and t.startswith("alpha")] == [7]


def test_language_stage_keeps_rows_without_id(spark, base, documents):
    real = [(r["doc_id"], r["text"], r["lang"]) for r in spark.read.parquet(f"{base}/documents.parquet").collect()]
    rows = real + [(None, real[0][1], real[0][2]), (None, "   ", "en"), (real[1][0], None, "en")]
    got = Counter(kept(corpus_pipeline.identify_language(spark, documents(rows), base)))
    assert got[None, real[0][1]] == 1 and got[None, "   "] == 0 and got[real[1][0], None] == 0


def test_leak_stage_goes_row_by_row(spark, base, documents):
    item = spark.read.parquet(f"{base}/benchmark.parquet").first()["text"]
    docs = documents([(None, item), (None, "clean words without any leak"), (3, item), (3, "clean"), (4, None)])
    got = kept(corpus_pipeline.drop_contaminated(spark, docs, base))
    assert got == sorted([(None, "clean words without any leak"), (3, "clean"), (4, None)], key=str)


def test_packing_stage_packs_every_row(spark, base, documents):
    docs = documents([(None, "a b c"), (None, "d e"), (3, "f"), (3, "g h"), (5, None)])
    got = Counter(r["doc_id"] for r in corpus_pipeline.pack_documents(spark, docs, base).collect())
    assert got[None] == 2 and got[3] == 2


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_empty_table_stays_empty(spark, base, none, name, stage):
    assert stage(spark, none, base).count() == 0
