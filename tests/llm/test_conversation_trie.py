"""Conversation prefix trie against brute force, its parentheses against a stack."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import types as T

from farol.llm import conversation_trie as trie

SCHEMA = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()),
    T.StructField("text", T.StringType()), T.StructField("path", T.StringType()), T.StructField("words", T.StringType()),
])


def brute(rows):
    """Nodes of (conv_id, turn, role, text) rows whose turns are told apart within a conversation."""
    own = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            own[c].append((t is not None, t or 0, role or "", text or ""))
    own = {c: [r[2:] for r in sorted(v)] for c, v in own.items()}
    seqs = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        lead = int(c - (abs(c) % 20) * (1 if c >= 0 else -1))
        seqs[c] = tuple(own.get(lead, [])[:h] + turns[h:])
    members = defaultdict(list)
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            members[s[:d]].append(c)
    kids = defaultdict(int)
    for p in members:
        if p:
            kids[p[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, m in members.items():
        gain = (len(m) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += not kids[p]
            saved[p[:d]] += gain
    out = []
    for p, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(seqs[c]) == len(p))
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), kids[p], leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def run(spark, rows):
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(3)
    got = trie.trie(df)
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted((tuple(r) for r in got.collect()), key=str)


def talk(seed, n):
    """Conversations with common starts, copies, gaps and NULLs."""
    rng = random.Random(seed)
    says = ["hello there", "yes", "", None, "no\tway  out", "a b c d", "ñ 漢"]
    rows = []
    for c in range(n):
        if c % 20 and rng.random() < 0.1:
            continue
        k = rng.choice([1, 2, 3, 5, 8, 30 if c % 37 == 0 else 4])
        same = rng.random() < 0.3
        for t in range(k):
            text = says[(t * 3) % 7] if same or t < 2 else rng.choice(says)
            rows.append((c, None if t == 0 and c % 3 == 0 else t * 2, rng.choice(["user", None]) if not same else "user", text))
    return rows + [(None, 0, "user", "lost"), (-3, 0, "user", "x"), (-41, 1, "a", "b"), (900_001, 0, "only", "one"), (900_021, 5, "user", "alone")]


@pytest.mark.parametrize("shard, few, least, chunk", [(1 << 13, 64, 16, 1 << 16), (40, 12, 3, 2), (3, 5, 2, 1), (15, 6, 2, 3)])
def test_equals_brute_force(spark, monkeypatch, shard, few, least, chunk):
    for name, value in (("SHARD", shard), ("FEW", few), ("LEAST_PATHS", least), ("CHUNK", chunk)):
        monkeypatch.setattr(trie, name, value)
    rows = talk(shard, 160)
    assert run(spark, rows) == brute(rows)


def test_copies_ties_and_no_rows(spark):
    assert run(spark, []) == []
    assert run(spark, [(None, 1, "a", "b")]) == []
    same = [(c, t, "user", f"turn {t}") for c in range(0, 400, 20) for t in range(3)]
    assert run(spark, same) == brute(same)
    # A repeated row is a turn of its own; ties within a turn number are settled alike in every conversation.
    twice = [(20, 1, "user", "b"), (20, 1, "user", "a"), (20, 1, "user", "a"), (40, 1, "user", "a"), (40, 1, "user", "b"), (40, 1, "user", "a")]
    assert {(r[1], r[3]) for r in run(spark, twice)} == {(0, 2), (1, 2), (2, 2), (3, 2)}


def test_turnless_conversation_is_a_member_of_the_root(spark):
    c = next(c for c in range(21, 40) if zlib.crc32(str(c).encode()) % 4 == 3)
    rows = [(c, 0, "user", "a"), (c, 1, "user", "b"), (c + 1000 * 20, 0, "u", "x")]
    got = run(spark, rows)
    assert got == brute(rows) and any(r[1] == 0 and r[3] == 2 for r in got)


def test_parentheses(monkeypatch):
    rng = random.Random(2)
    for _ in range(60):
        opens, depth = [True], 1
        for _ in range(rng.randrange(700)):
            up = depth == 1 or rng.random() < rng.choice([0.3, 0.5, 0.9])
            opens.append(up)
            depth += 1 if up else -1
        opens = np.array(opens + [False] * depth)
        stack, want = [], {}
        for i, up in enumerate(opens.tolist()):
            if up:
                stack.append(i)
            else:
                want[stack.pop()] = i
        b = trie.Parentheses(opens)
        at = np.flatnonzero(opens)
        close = b.close(at)
        assert close.tolist() == [want[i] for i in at.tolist()]
        pairs = opens[:-1] & ~opens[1:]
        assert b.leaves(at, close).tolist() == [int(pairs[i:want[i]].sum()) for i in at.tolist()]
