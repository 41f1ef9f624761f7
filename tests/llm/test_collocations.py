"""Phrase collocations against brute force."""

import random
import re
from collections import Counter, defaultdict

import pytest

from farol.llm import collocations


def brute(rows, least=10, cover=50, top=2000):
    """Rows (lang, rank, phrase, a, l, r, n, score) from (lang, text) rows."""
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in (1, 2, 3):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i:i + k])] += 1
    found = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= least}
    out = defaultdict(list)
    for (lang, p), a in found.items():
        if any(m == lang and len(q) == 3 and p in (q[:2], q[1:]) and 100 * b >= cover * a for (m, q), b in found.items() if len(p) == 2):
            continue
        cuts = [(1_000_000 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        out[lang].append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return sorted((lang, i + 1, p.decode(), -a, x, y, n[lang], -s)
                  for lang, ranked in out.items() for i, (s, a, p, x, y) in enumerate(sorted(ranked)[:top]))


def run(docs, **settings):
    return sorted(tuple(r) for r in collocations.collocations(docs, **settings).collect())


def texts(seed, n, words):
    rng = random.Random(seed)
    seps = [" ", " ", " ", "  ", "\t", ". ", ", ", "\n", "\r", "\v", "!?", " ; "]
    return [("".join(rng.choice(words) + rng.choice(seps) for _ in range(rng.randrange(60)))) for _ in range(n)]


WORDS = ["the", "The", "of", "a", "b", "ñandú", "漢字", "x\x1cy", "don't", "zeta", "Ä", "ä", "<e>", "q"]


@pytest.mark.parametrize("long, held, block", [(64, 4_000_000, 1 << 24), (2, 4_000_000, 400), (1, 5, 200)])
def test_equals_brute_force(documents, monkeypatch, long, held, block):
    monkeypatch.setattr(collocations, "LONG", long)
    monkeypatch.setattr(collocations, "HELD", held)
    monkeypatch.setattr(collocations, "BLOCK", block)
    monkeypatch.setattr(collocations, "BUCKET", 500)
    langs = ["en", "de", None, "und", "x y"]
    rows = [(i % 70 or None, t, langs[i % 5]) for i, t in enumerate(texts(3, 120, WORDS))] + [(1, None, "en"), (2, "", "fr"), (3, " .\n", "fr")]
    rows.append((9, "hot pair next. " * 300 + " ".join(f"hot pair w{i}." for i in range(200)), "en"))
    got = run(documents(rows), top=40)
    assert got == brute([(r[2], r[1]) for r in rows], top=40)
    assert any(r[2].count(" ") == 2 for r in got)


def test_many_words_of_one_block(documents):
    rows = [(i, " ".join(f"w{i}x{j} alpha beta" for j in range(50)), "en") for i in range(5)]
    assert run(documents(rows)) == brute([(r[2], r[1]) for r in rows])


def test_only_candidates_take_over(documents):
    rows = [(1, "a b c. " * 9 + "a b d. a b. x y z. " + "x y z. " * 9, "en")]
    got = run(documents(rows))
    assert got == brute([(r[2], r[1]) for r in rows]) and {"a b", "x y z"} == {r[2] for r in got}


def test_block_with_more_words_than_one_number_holds(monkeypatch):
    raw = "\n".join(texts(8, 50, WORDS)).encode()
    want = sorted(map(str, collocations.block_stripes(raw, "en", 7)))
    monkeypatch.setattr(collocations, "WIDE", 0)
    assert sorted(map(str, collocations.block_stripes(raw, "en", 7))) == want


def test_odd_and_empty_tables(odd, none):
    assert run(none) == []
    assert run(odd) == brute([(r["lang"], r["text"]) for r in odd.collect()])


def test_score_is_exact_beyond_64_bits(spark):
    from pyspark.sql import functions as F
    a, b, c = 9_007_199_254_740_993, 9_007_199_254_740_999, 9_999_999_999_999_999
    row = spark.createDataFrame([(a, b, c)], "a long, l long, r long").select(collocations._score(F.col("a"), F.col("l"), F.col("r"))).first()
    assert row[0] == 1_000_000 * a * a // (b * c)
