import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from farol.llm import gru_lm
from farol.llm.common import by_bytes, words

TEXTS = ["a b  A\tb", None, "", " \n", "\x0bé\x0c\rÉ x\x1cy\x85z\xa0w ", "c" * 40, "B b b", "漢字 c\x00c Z z"]


@pytest.fixture(scope="module")
def lex(spark):
    counts = spark.range(3000).selectExpr("if(id = 0, '', concat('w', id)) as word", "3000000 div (id + 1) as n")
    return gru_lm.lexicon(counts)


def peak(run):
    """Most bytes held at once in a second run, beyond those that the first one left."""
    run()
    tracemalloc.start()
    run()
    found = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return found


def test_words_and_counts_equal_the_plain_ones(monkeypatch):
    plain = [[w for w in words(t or "") if w] for t in TEXTS]
    assert [gru_lm.tokens(t or "") for t in TEXTS] == plain
    want = Counter(w for p in plain for w in p) + Counter({"": len(TEXTS)})
    for kind in (pa.string(), pa.large_string()):
        for limit in (1, 8, 1 << 20):
            monkeypatch.setattr(gru_lm, "COUNT_CHARS", limit)
            batch = pa.RecordBatch.from_arrays([pa.array(TEXTS, kind)], names=["text"])
            got = Counter()
            for out in gru_lm._counted(iter([batch.slice(0, 3), batch.slice(3), batch.slice(0, 0)])):
                for r in out.to_pylist():
                    got[r["word"]] += r["n"]
            assert got == want
            cut = [(at, [t.as_py() for t in part]) for at, part in gru_lm._slices(batch.column("text"), limit)]
            assert cut == list(by_bytes(TEXTS, limit))


def test_words_are_placed_once_for_each_distinct_one(lex):
    """A text of one word repeated costs the same look-ups as the word: nothing is kept for each word as a Python object."""
    texts = pa.array(["w1 w2 nowhere " * 50_000])
    of, found = gru_lm._split(texts)
    assert peak(lambda: gru_lm._places(gru_lm._split(texts)[1], pa.array([*lex.index]))) < 3 << 20  # 10 MB before
    place, code, distinct = gru_lm._places(found, pa.array([*lex.index]))
    assert distinct.to_pylist() == ["w1", "w2", "nowhere"] and code[:4].tolist() == [0, 1, 2, 0]
    assert place[:3].tolist() == [[*lex.index].index("w1"), [*lex.index].index("w2"), len(lex.index)]
    assert [x.tolist() for x in gru_lm._ended(np.array([1, 1, 3]), np.array([5, 6, 7]), 4)] == [[1], [5, 6, 1], [1], [7, 1]]


def test_windows_use_their_memory_again(lex):
    model, random = gru_lm.GruLm(lex), np.random.default_rng(3)
    grid = random.integers(0, len(lex.unigram), (gru_lm.STEPS, 400))
    live, h, last = np.ones(grid.shape, bool), np.zeros((400, gru_lm.HIDDEN), "f4"), np.full(400, gru_lm.END)
    assert peak(lambda: model.window(grid, live, h, last)) < 3 << 20  # 14 MB of states, gates and gradients before


def test_scoring_holds_a_bounded_number_of_states(lex):
    model, random = gru_lm.GruLm(lex), np.random.default_rng(4)
    docs = [np.append(random.integers(0, len(lex.unigram), n), gru_lm.END) for n in [70] * 4000 + [1000, 0]]
    assert peak(lambda: model.score(docs)) < 16 << 20  # 109 MB of states and logits before
    some = [0, 17, 3999, 4000, 4001]
    assert model.score(docs)[some] == pytest.approx([model.score([docs[i]])[0] for i in some], rel=1e-5)


@pytest.mark.parametrize("scale", [1, 400])
def test_probabilities_and_gradients_with_small_and_large_weights(lex, scale):
    model, random = gru_lm.GruLm(lex), np.random.default_rng(5)
    model.p = {k: a.astype("f8") for k, a in model.p.items()}
    for k in "cw":
        model.p[k][:, :-1] *= scale
    assert model.calm() == (scale == 1)
    h, target = np.tanh(random.normal(size=(50, gru_lm.HIDDEN))), random.integers(0, len(lex.unigram), 50)

    def log_softmax(x):
        x = x - x.max()
        return x - np.log(np.exp(x).sum())

    want, ones = [], np.c_[h, np.ones(50)]
    for s, w in zip(ones, target, strict=True):
        k = lex.class_of[w]
        block = slice(model.first[k], model.first[k + 1])
        want.append(log_softmax(model.p["c"] @ s)[k] + log_softmax(model.p["w"][block] @ s)[lex.place[w]])
    assert model.log_probs(h, target) == pytest.approx(want, rel=1e-9, abs=1e-9)
    words_, live, start, last = target.reshape(5, 10), np.ones((5, 10), bool), np.tanh(random.normal(size=(10, gru_lm.HIDDEN))), target[:10]
    grads = {k: g.copy() for k, g in model.window(words_, live, start, last)[0].items()}
    again = model.window(words_, live, start, last)[0]
    assert all(np.array_equal(again[k], g) for k, g in grads.items())  # nothing is left of the window before

    def loss():
        state, before, total = start, last, 0.0
        for now in words_:
            state, _ = model.step(before, state * (before != gru_lm.END)[:, None])
            total -= model.log_probs(state, now).sum()
            before = now
        return total / words_.size

    for k, g in grads.items():
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        model.p[k][at] += 1e-6
        up = loss()
        model.p[k][at] -= 2e-6
        assert g[at] == pytest.approx((up - loss()) / 2e-6, rel=2e-3)
        model.p[k][at] += 1e-6
