"""Gated recurrent language model and unigram base (operator 3).

Word counts of all training documents come from one distributed count. The
frequent words are split into classes of like probability mass; the model
predicts the class of the next word and then the word within the class, from
the state of a gated recurrent unit. Any other word is told by its smoothed
share among the other training words; as in the base, all words never met
count as one, so both speak of the same events.

Training is truncated backpropagation in numpy inside the tasks: each
partition trains a copy on its own share of documents, the copies are averaged
by a grouped aggregate, and the driver holds one model. Scoring carries the
state across windows, from the first word of a document to its end.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import prod

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farol.llm.common import remainder, staged

HIDDEN = 16            # state of the recurrent unit
WORDS = 1022           # frequent words the model knows at least, beside "other" and the end; they grow with the corpus
GROWTH = 0.4           # twice this power of the training words, so that copies do not outgrow the texts they learn from
HEAD = 100_000         # most frequent words whose counts travel with the job (a few MB); the rest are joined
ROUNDS = 2             # the training documents fall into so many parts; the copies of a round train on one of them
LANES, STEPS = 128, 16 # texts trained side by side at least, and steps of a truncated window
WINDOWS = 256          # updates of a stream, at least, before it gets more lanes
MOST_LANES = 512
BLOCK = 4096           # weights that travel in a row
RATE = 0.02
WINDOW = 1 << 15       # words of a scoring window
CELLS = 1 << 17        # logits worked on at a time, so that they stay in a core's cache
SAFE = 60              # logits whose exponentials neither overflow nor vanish
BATCH_CHARS = 16 << 20  # text scored side by side
COUNT_CHARS = 32 << 20  # text counted at a time
OTHER, END = 0, 1


def _slices(texts: pa.Array, limit: int) -> Iterator[tuple[int, pa.Array]]:
    """(first position, texts) of about ``limit`` characters; NULL becomes the empty text."""
    texts = pc.fill_null(texts, "")
    start, held = 0, 0
    for at, size in enumerate(pc.utf8_length(texts).to_pylist()):
        if at > start and held + size > limit:
            yield start, texts.slice(start, at - start)
            start, held = at, 0
        held += size
    if start < len(texts):
        yield start, texts.slice(start)


def _split(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """The text of each word, and the words: runs without ASCII white space, A-Z lowered."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    of, words = np.repeat(np.arange(len(split)), pc.list_value_length(split).to_numpy(zero_copy_only=False)), split.flatten()
    real = pc.binary_length(words).to_numpy(zero_copy_only=False) > 0
    return (of, words) if real.all() else (of[real], words.filter(pa.array(real)))


def tokens(text: str) -> list[str]:
    """Words of a text, without the end mark."""
    return _split(pa.array([text], pa.string()))[1].to_pylist()


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, texts in _slices(batch.column("text"), COUNT_CHARS):
            counts = _split(texts)[1].value_counts()
            for words, n in ((counts.field("values"), counts.field("counts")), (pa.array([""]), pa.array([len(texts)]))):  # the ends
                yield pa.RecordBatch.from_arrays([words.cast(pa.string()), n.cast(pa.int64())], names=["word", "n"])


@dataclass
class Lexicon:
    """What scoring needs of the corpus: sizes, counts of the frequent words, and the classes."""

    total: int
    distinct: int
    head: dict[str, int]
    index: dict[str, int]
    class_of: np.ndarray
    place: np.ndarray
    sizes: np.ndarray
    unigram: np.ndarray

    def log_base(self, count: int) -> float:
        return float(np.log10((count + 0.5) / self.base_mass))

    def log_other(self, count: int) -> float:
        """log10 probability of a word of this count, given that it is none of the model's."""
        return float(np.log10((count + 0.5) / self.other_mass))

    def __post_init__(self):
        self.base_mass = self.total + 0.5 * (self.distinct + 1)
        known = sum(self.head.get(w, 0) for w in self.index)
        self.other_mass = self.total - known + 0.5 * (max(0, self.distinct - len(self.index)) + 1)


def lexicon(counts: DataFrame) -> Lexicon:
    """Collects at most HEAD words, whatever the corpus."""
    sums = counts.agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("distinct")).first()
    total, distinct = int(sums["total"] or 0), int(sums["distinct"])
    sizes, least = counts.groupBy("n").agg(F.count(F.lit(1)).alias("words")).where("n > 1").orderBy(F.desc("n")).limit(HEAD).collect(), 0
    for row, held in zip(sizes, np.cumsum([r["words"] for r in sizes]), strict=True):
        if held <= HEAD:
            least = row["n"]
    top = counts.where(F.col("n") >= max(least, 2)).orderBy(F.desc("n"), "word").toPandas() if least else counts.limit(0).toPandas()
    head = dict(zip(top["word"], top["n"].astype(int), strict=True))
    known = [w for w in head if w][: max(WORDS, int(2 * total**GROWTH))]
    mass = np.array([0.5, head.get("", 0) + 0.5, *(head[w] for w in known)])
    mass[OTHER] += max(0, total - head.get("", 0) - sum(head[w] for w in known))
    return Lexicon(total, distinct, head, {"": END} | {w: i + 2 for i, w in enumerate(known)}, *_classes(mass), mass / mass.sum())


def _classes(mass: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Class, place in the class and class sizes: about the square root of the words in number, of consecutive words of
    about equal mass, none larger than twice the mean."""
    order = np.argsort(-mass, kind="stable")
    class_of, place, sizes = np.zeros(len(mass), np.int64), np.zeros(len(mass), np.int64), []
    classes = max(32, round(len(mass) ** 0.5))
    most, goal, held, weight = -(-2 * len(mass) // classes), mass.sum() / classes, 0, 0.0
    for w in order:
        if held and (weight >= goal or held >= most):
            sizes.append(held)
            held, weight = 0, 0.0
        class_of[w], place[w] = len(sizes), held
        held, weight = held + 1, weight + mass[w]
    sizes.append(held)
    return class_of, place, np.array(sizes)


class GruLm:
    """Weights: word inputs to the three gates, state to gates, class output, word output of each class; the outputs' last column is their bias."""

    def __init__(self, lex: Lexicon, seed: int = 5):
        rng, v, h = np.random.default_rng(seed), len(lex.unigram), HIDDEN
        self.class_of, self.place, self.sizes = lex.class_of, lex.place, lex.sizes
        self.first = np.concatenate([[0], np.cumsum(lex.sizes)])
        self.row = self.first[lex.class_of] + lex.place   # words in class order
        mass = np.zeros(v)
        mass[self.row] = lex.unigram
        per_class = np.add.reduceat(mass, self.first[:-1])
        x, u, c, w = (rng.normal(0, scale, shape) for scale, shape in
                      ((0.1, (v, 3 * h)), (0.2, (h, 3 * h)), (0.1, (h, len(lex.sizes))), (0.1, (v, h))))
        self.p = {"x": x, "u": u, "b": np.zeros(3 * h), "c": np.c_[c.T, np.log(per_class)],
                  "w": np.c_[w, np.log(mass / np.repeat(per_class, lex.sizes))]}
        self.p = {k: a.astype("f4") for k, a in self.p.items()}
        self.rooms: dict[str, np.ndarray] = {}
        self.met = np.zeros(0, np.int64)

    def room(self, name: str, *shape: int) -> np.ndarray:
        """An array whose memory is used again at each call; fresh memory for each result costs more than most of the sums."""
        size, kind = prod(shape), self.p["u"].dtype
        if name not in self.rooms or self.rooms[name].size < size or self.rooms[name].dtype != kind:
            self.rooms[name] = np.zeros(size, kind)
        return self.rooms[name][:size].reshape(shape)

    def by_row(self, name: str, a: np.ndarray) -> np.ndarray:
        """Steps x rows x lanes as rows x (steps and lanes)."""
        steps, rows, lanes = a.shape
        out = self.room(name, rows, steps, lanes)
        out[:] = a.transpose(1, 0, 2)
        return out.reshape(rows, -1)

    def flat(self) -> np.ndarray:
        return np.concatenate([a.ravel() for a in self.p.values()])

    def load(self, values: np.ndarray) -> GruLm:
        at = 0
        for k, a in self.p.items():
            self.p[k] = values[at : at + a.size].reshape(a.shape).astype("f4")
            at += a.size
        return self

    def step(self, word: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, tuple]:
        """Next states, a row for each lane."""
        state, cache = self._step(word, h.T, *self.turned())
        return state.T, cache

    def _step(self, word: np.ndarray, h: np.ndarray, inputs: np.ndarray, gates: np.ndarray) -> tuple[np.ndarray, tuple]:
        """Next states, a column for each lane, so that every gate is one block of memory; ``inputs`` and ``gates`` are
        the turned weights, the bias with the inputs."""
        n, x, g = HIDDEN, inputs.take(word, 1), gates @ h
        out = np.empty_like(g[:n])
        self._next(x, g, h, out)
        return out, (word, h, x[:n], x[n : 2 * n], x[2 * n :], g[2 * n :])

    def _next(self, x: np.ndarray, g: np.ndarray, h: np.ndarray, out: np.ndarray) -> None:
        """Next states into ``out``; ``x``, the inputs, becomes the two gates and the candidate."""
        n = HIDDEN
        zr, c = x[: 2 * n], x[2 * n :]
        zr += g[: 2 * n]
        np.tanh(zr, out=zr)   # of half the sum, so that this is the logistic function
        zr *= 0.5
        zr += 0.5
        np.multiply(zr[n:], g[2 * n :], out=out)
        c += out
        np.tanh(c, out=c)
        np.subtract(c, h, out=out)
        out *= zr[:n]
        out += h

    def turned(self, words: np.ndarray | slice = slice(None)) -> tuple[np.ndarray, np.ndarray]:
        """Inputs of the words and weights of the state, turned; those of the gates are halved."""
        inputs, gates = np.ascontiguousarray((self.p["x"][words] + self.p["b"]).T), np.ascontiguousarray(self.p["u"].T)
        inputs[: 2 * HIDDEN] *= 0.5
        gates[: 2 * HIDDEN] *= 0.5
        return inputs, gates

    def by_class(self, target: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[tuple[slice, slice]]]:
        """Order of the targets by class, their classes and places in it, and (columns, words) of each class."""
        kind = self.class_of[target].astype(np.uint8 if len(self.sizes) < 256 else np.uint16)
        order = np.argsort(kind, kind="stable")
        kind = kind[order]
        ends = np.searchsorted(kind, np.arange(len(self.sizes) + 1))
        met = np.flatnonzero((np.diff(ends) > 0) & (self.sizes > 1))
        blocks = [(slice(ends[k], ends[k + 1]), slice(self.first[k], self.first[k + 1])) for k in met]
        return order, kind.astype(np.int64), self.place[target[order]], blocks

    def pieces(self, blocks: list[tuple[slice, slice]], n: int) -> Iterator[tuple[str, slice, slice]]:
        """(weights, their rows, columns) of the outputs: all classes for all ``n`` states, then the words of each class, in
        pieces of about CELLS logits."""
        for k, at, rows in [("c", slice(0, n), slice(0, len(self.sizes))), *(("w", *b) for b in blocks)]:
            wide = max(256, CELLS // (rows.stop - rows.start))
            for first in range(at.start, at.stop, wide):
                yield k, rows, slice(first, min(at.stop, first + wide))

    def calm(self) -> bool:
        """Whether no state, being within -1 and 1, leads to logits that must be lowered before they are raised to powers."""
        found = True
        for k, first in (("c", [0]), ("w", self.first[:-1])):
            bias, reach = self.p[k][:, -1], np.abs(self.p[k][:, :-1]).sum(1)
            found &= bool((bias + reach).max() < SAFE and np.maximum.reduceat(bias - reach, first).min() > -SAFE)
        return found

    def log_probs(self, h: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Natural log probability of each target after each state (rows)."""
        return self._log_probs(np.vstack([h.T, np.ones(len(target), h.dtype)]), target, self.calm())

    def _log_probs(self, h: np.ndarray, target: np.ndarray, calm: bool) -> np.ndarray:
        """``h`` has a last row of ones."""
        order, kind, place, blocks = self.by_class(target)
        h, every = h.take(order, 1, out=self.room("sorted", len(h), len(target)), mode="clip"), np.arange(len(target))
        found = np.zeros(len(target))
        for k, rows, at in self.pieces(blocks, len(target)):
            logits = self.room("logits", rows.stop - rows.start, at.stop - at.start)
            np.matmul(self.p[k][rows], h[:, at], out=logits)
            if not calm:
                logits -= logits.max(0)
            found[at] += logits[(kind if k == "c" else place)[at], every[: at.stop - at.start]]
            found[at] -= np.log(np.exp(logits, out=logits).sum(0))
        out = np.empty(len(target))
        out[order] = found
        return out

    def train(self, stream: list[np.ndarray]) -> int:
        """Truncated backpropagation over documents end to end, cut into lanes; the state passes from window to window. Words seen."""
        if not stream:
            return 0
        words = np.concatenate(stream)
        lanes = [x for x in np.array_split(words, min(MOST_LANES, max(LANES, len(words) // (STEPS * WINDOWS)))) if len(x)]
        size = max(map(len, lanes))
        grid, live = np.zeros((size, len(lanes)), np.int64), np.zeros((size, len(lanes)), bool)
        for i, lane in enumerate(lanes):
            grid[: len(lane), i], live[: len(lane), i] = lane, True
        mean = {k: np.zeros_like(a) for k, a in self.p.items()}
        var = {k: np.zeros_like(a) for k, a in self.p.items()}
        h, last = np.zeros((len(lanes), HIDDEN), "f4"), np.full(len(lanes), END)
        for t, at in enumerate(range(0, size, STEPS), 1):
            grads, h, last = self.window(grid[at : at + STEPS], live[at : at + STEPS], h, last)
            for k, g in grads.items():
                m, v, p = mean[k], var[k], self.p[k]
                if k == "x":  # no other word's input has a gradient
                    g, m, v = (a.take(self.met, 0, out=self.room(name, len(self.met), a.shape[1]), mode="clip")
                               for name, a in (("rows of g", g), ("rows of m", m), ("rows of v", v)))
                np.clip(g, -1, 1, out=g)
                move = np.subtract(g, m, out=self.room("move", *g.shape))
                move *= 0.1
                m += move
                g *= g
                g -= v
                g *= 0.01
                v += g
                np.divide(v, 1 - 0.99**t, out=g)
                np.sqrt(g, out=g)
                g += 1e-6
                np.divide(m, g, out=g)
                g *= RATE / t**0.25 / (1 - 0.9**t)
                if k == "x":
                    mean[k][self.met], var[k][self.met] = m, v
                    p[self.met] -= g
                else:
                    p -= g
        return int(live.sum())

    def window(self, words: np.ndarray, live: np.ndarray, h: np.ndarray, last: np.ndarray):
        """Gradients of one window's mean log loss, the state after it and the words read last; they hold until the next
        call. ``self.met`` are the words read here and those of the last step."""
        p, n, (steps, lanes), size = self.p, HIDDEN, words.shape, words.size
        read = np.concatenate([last[None], words[:-1]])
        passed = (read != END).astype(p["u"].dtype)  # a document starts from nothing
        order_in = np.argsort(read.ravel().astype(np.uint16) if len(p["x"]) < 1 << 16 else read.ravel(), kind="stable")
        new = np.diff(read.ravel()[order_in], prepend=-1) != 0
        starts, nth = np.flatnonzero(new), np.empty(size, np.int64)
        nth[order_in] = np.cumsum(new) - 1
        old, met = self.met, read.ravel()[order_in[starts]]
        inputs, gates = self.turned(met)
        # What a step works on is one block of memory.
        x, g = self.room("x", steps, 3 * n, lanes), self.room("g", steps, 3 * n, lanes)
        before, states, h = self.room("before", steps, n, lanes), self.room("states", steps, n, lanes), h.T
        for t, at in enumerate(nth.reshape(steps, lanes)):
            inputs.take(at, 1, out=x[t], mode="clip")
            h = np.multiply(h, passed[t], out=before[t])
            np.matmul(gates, h, out=g[t])
            self._next(x[t], g[t], h, states[t])
            h = states[t]
        z, r, c, gu = x[:, :n], x[:, n : 2 * n], x[:, 2 * n :], g[:, 2 * n :]

        order, kind, place, blocks = self.by_class(words.ravel())
        hs = self.room("sorted", n + 1, size)
        self.by_row("turned states", states).take(order, 1, out=hs[:n], mode="clip")
        hs[n], back_to = 1, np.empty((steps, lanes), np.int64)
        back_to.ravel()[order] = np.arange(size)
        on, every, calm = live.ravel()[order], np.arange(size), self.calm()
        weight = (on / max(1, int(on.sum()))).astype(hs.dtype)
        grads = {"x": self.room("grad x", *p["x"].shape), "c": self.room("grad c", *p["c"].shape), "w": self.room("grad w", *p["w"].shape)}
        grads["x"][old], grads["c"][:], grads["w"][:] = 0, 0, 0
        back = self.room("back", n, size)
        back[:] = 0
        for k, rows, at in self.pieces(blocks, size):
            e, scale, weights = self.room("logits", rows.stop - rows.start, at.stop - at.start), weight[at], p[k][rows]
            np.matmul(weights, hs[:, at], out=e)
            if not calm:
                e -= e.max(0)
            np.exp(e, out=e)
            e *= scale / e.sum(0)
            e[(kind if k == "c" else place)[at], every[: at.stop - at.start]] -= scale
            grads[k][rows] += e @ hs[:, at].T
            back[:, at] += weights[:, :n].T @ e

        # What does not hang on the steps after is done for all steps at once.
        of_n, of_z, of_r, rest = (self.room(name, steps, n, lanes) for name in ("of n", "of z", "of r", "rest"))
        np.subtract(1, z, out=rest)
        np.multiply(c, c, out=of_n)
        np.subtract(1, of_n, out=of_n)
        of_n *= z
        np.subtract(c, before, out=of_z)
        of_z *= z
        of_z *= rest
        np.subtract(1, r, out=of_r)
        of_r *= r
        of_r *= gu
        d = self.room("d", steps, 4 * n, lanes)  # of the candidate, the two gates, the candidate's part of the state
        carry, dh, through = (self.room(name, n, lanes) for name in ("carry", "dh", "through"))
        carry[:] = 0
        for t in range(steps - 1, -1, -1):
            carry += back.take(back_to[t], 1, out=dh, mode="clip")
            dn = np.multiply(carry, of_n[t], out=d[t, :n])
            np.multiply(carry, of_z[t], out=d[t, n : 2 * n])
            np.multiply(dn, of_r[t], out=d[t, 2 * n : 3 * n])
            np.multiply(dn, r[t], out=d[t, 3 * n :])
            carry *= rest[t]
            carry += np.matmul(p["u"], d[t, n:], out=through)
            carry *= passed[t]
        grads["u"] = np.matmul(before, d[:, n:].transpose(0, 2, 1)).sum(0)
        turned = self.by_row("turned d", d[:, : 3 * n]).take(order_in, 1, out=self.room("sorted d", 3 * n, size), mode="clip")
        grads["x"][met] = np.roll(np.add.reduceat(turned, starts, 1).T, 2 * n, 1)
        grads["b"] = grads["x"][met].sum(0)
        self.met = np.union1d(met, words[-1])
        return grads, states[-1].T.copy(), words[-1]

    def score(self, docs: list[np.ndarray]) -> np.ndarray:
        """Natural log probability of each document; each ends with the end mark."""
        sizes = np.array([len(d) for d in docs], np.int64)
        order = np.argsort(-sizes, kind="stable")
        sizes = sizes[order]
        words, starts, out = np.concatenate([docs[i] for i in order]) if docs else np.zeros(0, np.int64), np.cumsum(sizes) - sizes, np.zeros(len(docs))
        (inputs, gates), n, calm, at = self.turned(), HIDDEN, self.calm(), 0
        h, last = np.zeros((n, len(docs)), self.p["u"].dtype), np.full(len(docs), END)
        while at < (int(sizes[0]) if len(sizes) else 0):
            lanes = int(np.searchsorted(-sizes, -at))  # documents that go on
            span = min(max(1, WINDOW // lanes), int(sizes[0]) - at)
            on = np.searchsorted(-sizes, -np.arange(at, at + span))
            ends = np.cumsum(on)
            owner = np.arange(ends[-1]) - np.repeat(ends - on, on)
            target = words[starts[owner] + np.repeat(np.arange(at, at + span), on)]
            states = self.room("states", n + 1, int(ends[-1]))
            states[n] = 1
            for t, (end, wide) in enumerate(zip(ends.tolist(), on.tolist(), strict=True), at):
                x, g, to = self.room("x", 3 * n, wide), self.room("g", 3 * n, wide), self.room(f"to {t % 2}", n, wide)
                inputs.take(last[:wide], 1, out=x, mode="clip")
                np.matmul(gates, h[:, :wide], out=g)
                self._next(x, g, h[:, :wide], to)
                h, last = to, target[end - wide : end]
                states[:n, end - wide : end] = h
            out += np.bincount(owner, self._log_probs(states, target, calm), len(docs))
            at += span
        back = np.zeros(len(docs))
        back[order] = out
        return back


def _ended(of: np.ndarray, words: np.ndarray, texts: int) -> list[np.ndarray]:
    """Words of each text, closed by the end mark; ``of`` is the text of each word."""
    ends = np.cumsum(np.bincount(of, minlength=texts) + 1)
    flat = np.full(len(words) + texts, END, np.int64)
    flat[np.arange(len(words)) + of] = words
    return np.split(flat, ends[:-1])


def _places(words: pa.Array, known: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Place of each word among the known ones, their number if it is none; its number among the distinct words, and these."""
    coded = words.dictionary_encode()
    distinct, code = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False)
    place = pc.fill_null(pc.index_in(distinct, value_set=known.cast(distinct.type)), len(known)).to_numpy(zero_copy_only=False)
    return place[code], code, distinct


def _train_copy(lex: Lexicon, values: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    model, seen = GruLm(lex).load(values), 0
    known, word = pa.array([*lex.index], pa.string()), np.array([*lex.index.values(), OTHER])
    for batch in batches:
        for _, texts in _slices(batch.column("text"), BATCH_CHARS):
            of, words = _split(texts)
            seen += model.train(_ended(of, word[_places(words, known)[0]], len(texts)))
    if seen:
        yield _blocks(model.flat(), seen)


def _blocks(values: np.ndarray, seen: float) -> pa.RecordBatch:
    cut = [values[at : at + BLOCK].astype("f4").tobytes() for at in range(0, values.size, BLOCK)]
    return pa.RecordBatch.from_arrays(
        [pa.array(range(len(cut)), pa.int64()), pa.array(cut, pa.binary()), pa.array([float(seen)] * len(cut))], names=["block", "v", "n"])


def _mean(copies: pa.Table) -> pa.Table:
    """One block of weights, averaged over the copies by the words each has seen."""
    n, total = copies.column("n").to_numpy(), 0.0
    for seen, raw in zip(n, copies.column("v"), strict=True):
        total = total + seen * np.frombuffer(raw.as_py(), "f4").astype("f8")
    return pa.table({"block": copies.column("block")[:1], "v": pa.array([(total / n.sum()).astype("f4").tobytes()], pa.binary())})


def training_part(docs: DataFrame, k: int) -> DataFrame:
    """Texts that the copies of round ``k`` train on; each row falls to one round."""
    return docs.where(F.pmod(F.xxhash64(F.col("doc_id"), F.lit("fit")), F.lit(ROUNDS)) == k).select("text")


def fit(docs: DataFrame, lex: Lexicon) -> GruLm:
    """Copies trained apart and averaged by words seen, in ROUNDS that have all documents between them; the driver receives one model."""
    spark, model = docs.sparkSession, GruLm(lex)
    for k in range(ROUNDS):
        held = spark.sparkContext.broadcast((lex, model.flat()))
        copies = training_part(docs, k).mapInArrow(lambda b, held=held: _train_copy(*held.value, b), "block long, v binary, n double")
        rows = copies.groupBy("block").applyInArrow(_mean, "block long, v binary").collect()
        if rows:
            model.load(np.concatenate([np.frombuffer(r["v"], "f4") for r in sorted(rows, key=lambda r: r["block"])]))
    return model


SCORED_NAMES = ["row", "doc_id", "word", "n", "n_tokens", "n_known", "base", "score"]
SCORED = "row long, doc_id long, word string, n long, n_tokens long, n_known long, base double, score double"


def _scored(lex: Lexicon, values: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per document, and one per word of it that is not among the frequent ones, whose count is still to come."""
    model, log10e = GruLm(lex).load(values), float(np.log10(np.e))
    # One look-up per word: its place among the frequent words leads to its probabilities and its model word.
    known, counts = pa.array([*lex.head], pa.string()), np.array([*lex.head.values()], np.float64)
    word = np.array([*[lex.index.get(w, OTHER) for w in lex.head], OTHER])
    base = np.append(np.log10((counts + 0.5) / lex.base_mass), 0.0)
    other = np.append(np.where(word[:-1] == OTHER, np.log10((counts + 0.5) / lex.other_mass), 0.0), 0.0)
    ends = lex.log_base(lex.head.get("", 0))
    for batch in batches:
        for first, texts in _slices(batch.column("text"), BATCH_CHARS):
            size, (of, words) = len(texts), _split(texts)
            at, code, distinct = _places(words, known)
            rare = at == len(known)
            pair, times = np.unique(of[rare] * len(distinct) + code[rare], return_counts=True)
            row, rare_words = pa.array(first + pair // max(1, len(distinct))), distinct.take(pa.array(pair % max(1, len(distinct))))
            whole, real = pa.nulls(len(pair), pa.int64()), pa.nulls(len(pair), pa.float64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("row").take(row), batch.column("doc_id").take(row), rare_words.cast(pa.string()), pa.array(times, pa.int64()),
                 whole, whole, real, real], names=SCORED_NAMES)
            length = np.bincount(of, minlength=size) + 1
            met = length - np.bincount(of[rare], minlength=size) - ("" not in lex.head)
            scores = model.score(_ended(of, word[at], size)) * log10e + np.bincount(of, other[at], size)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row").slice(first, size), batch.column("doc_id").slice(first, size), pa.nulls(size, pa.string()), pa.nulls(size, pa.int64()),
                 pa.array(length, pa.int64()), pa.array(met, pa.int64()), pa.array(np.bincount(of, base[at], size) + ends, pa.float64()),
                 pa.array(scores, pa.float64())], names=SCORED_NAMES)


def score_documents(docs: DataFrame) -> DataFrame:
    """Unigram and recurrent log10 probability of every row's whole text.

    Words are runs without ASCII white space, A-Z lowered; each text closes
    with an end mark, so a NULL or empty text is one token. Counts and the
    model come from the rows whose crc32(id) mod 5 is not 1; with
    none, every word is unknown and the model stays as it was set up. Repeated
    rows are scored each; an empty table gives none.
    """
    held_out = remainder(F.col("doc_id"), 5) == 1
    train = docs.where(~held_out).select("doc_id", "text")
    counts = staged(train.select("text").mapInArrow(_counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")), "words")
    lex = lexicon(counts)
    model = fit(train, lex)
    held = docs.sparkSession.sparkContext.broadcast((lex, model.flat()))
    scored = staged(
        docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
        .mapInArrow(lambda b: _scored(*held.value, b), SCORED), "scored")
    count = F.coalesce("c", F.lit(0)) + 0.5
    rare = (
        scored.where("word is not null").select("row", "word", "n")
        .join(counts.select("word", F.col("n").alias("c")), "word", "left")
        .groupBy("row").agg(
            F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("r_known"),
            F.sum(F.col("n") * F.log10(count / F.lit(lex.base_mass))).alias("r_base"),
            F.sum(F.col("n") * F.log10(count / F.lit(lex.other_mass))).alias("r_score"))
    )
    rows = scored.where("word is null")
    return rows.join(rare, "row", "left").select(
        "doc_id", F.coalesce(remainder(F.col("doc_id"), 5) == 1, F.lit(False)).alias("held_out"), "n_tokens",
        (F.col("n_known") + F.coalesce("r_known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(lex.total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("r_base", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("r_score", F.lit(0.0))).alias("score"))
