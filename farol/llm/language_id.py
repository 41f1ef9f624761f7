"""Language identification by a convolutional network over bytes (operator 7).

Filters of several widths slide over embedded bytes, the largest answer of
each filter in a window is kept, and a softmax names the language. The network
is trained in numpy on a bounded sample of labelled documents; documents are
then scored window by window inside the tasks, over their whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farol.llm.common import by_bytes, remainder

WINDOW = 256          # bytes of one window, padded with zero bytes
EMBED = 8             # numbers per byte
WIDTHS = (2, 3, 4)    # bytes a filter sees
FILTERS = 16          # filters of each width
DOCS_PER_LANG = 1000  # labelled documents of one language the training sees, on average
WINDOWS_PER_DOC = 4   # windows of one such document, spread over it
STEPS, BATCH, RATE = 500, 64, 0.004
SCORE_WINDOWS = 256   # windows multiplied at a time
NONE = "und"


def cut(data: bytes) -> np.ndarray:
    """Consecutive windows of a text, the last one padded."""
    n = max(1, -(-len(data) // WINDOW))
    return np.frombuffer(data.ljust(n * WINDOW, b"\0"), np.uint8).reshape(n, WINDOW)


def _padded(windows: np.ndarray) -> np.ndarray:
    """Windows with zero bytes after them, so that a filter starts at their last byte too."""
    return np.pad(windows, ((0, 0), (0, max(WIDTHS))))


class ByteCnn:
    """Embedding, filters at every byte, maximum over the window, softmax."""

    def __init__(self, langs: list[str], seed: int = 7):
        rng = np.random.default_rng(seed)
        self.langs, n = langs, FILTERS * len(WIDTHS)
        self.embed = rng.normal(0, 0.5, (256, EMBED)).astype("f4")
        self.mask = np.zeros((max(WIDTHS) * EMBED, n), "f4")
        for k, w in enumerate(WIDTHS):
            self.mask[: w * EMBED, k * FILTERS : (k + 1) * FILTERS] = 1
        self.filters = (rng.normal(0, 0.2, self.mask.shape) * self.mask).astype("f4")
        self.bias = np.zeros(n, "f4")
        self.out = rng.normal(0, 0.1, (n, len(langs))).astype("f4")
        self.out_bias = np.zeros(len(langs), "f4")

    def _answers(self, windows: np.ndarray, shift: int) -> np.ndarray:
        """(window, position, filter) at every second byte from ``shift``, 0 or 1; a position covers four bytes, as two pairs."""
        n = self.filters.shape[1]
        pairs = self.embed[_padded(windows)[:, shift : shift + WINDOW + 2]].reshape(-1, 2 * EMBED)
        half = self.filters.reshape(2, 2 * EMBED, n)
        first = (pairs @ half[0]).reshape(len(windows), WINDOW // 2 + 1, n)[:, :-1]
        first += (pairs @ half[1]).reshape(len(windows), WINDOW // 2 + 1, n)[:, 1:]
        return first

    def _pooled(self, windows: np.ndarray) -> np.ndarray:
        """Largest answer of each filter over all bytes."""
        return np.maximum(self._answers(windows, 0).max(1), self._answers(windows, 1).max(1))

    def _softmax(self, pooled: np.ndarray) -> np.ndarray:
        z = pooled @ self.out + self.out_bias
        z = np.exp(z - z.max(1, keepdims=True))
        return z / z.sum(1, keepdims=True)

    def predict(self, windows: np.ndarray) -> np.ndarray:
        parts = [
            self._softmax(np.maximum(self._pooled(windows[i : i + SCORE_WINDOWS]) + self.bias, 0))
            for i in range(0, len(windows), SCORE_WINDOWS)
        ]
        return np.concatenate(parts)

    def fit(self, windows: np.ndarray, labels: np.ndarray, seed: int = 11) -> ByteCnn:
        """Adam on shuffled batches; every language weighs the same."""
        rng = np.random.default_rng(seed)
        params = [self.embed, self.filters, self.bias, self.out, self.out_bias]
        mean, var = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
        share = np.bincount(labels, minlength=len(self.langs)).astype("f8")
        chance = (1 / np.maximum(share, 1))[labels]
        chance /= chance.sum()
        for step in range(1, STEPS + 1):
            rows = rng.choice(len(windows), BATCH, p=chance)
            for p, g, m, v in zip(params, self._gradient(windows[rows], labels[rows]), mean, var, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        return self

    def _gradient(self, windows: np.ndarray, labels: np.ndarray) -> list[np.ndarray]:
        answers = np.stack([self._answers(windows, 0), self._answers(windows, 1)], 2).reshape(len(windows), WINDOW, -1)
        best = answers.argmax(1)
        pooled = np.take_along_axis(answers, best[:, None], 1)[:, 0] + self.bias
        pooled_on = np.maximum(pooled, 0)
        dz = self._softmax(pooled_on)
        dz[np.arange(len(labels)), labels] -= 1
        dz /= len(labels)
        dp = (dz @ self.out.T) * (pooled > 0)
        seen = _padded(windows)[np.arange(len(windows))[:, None, None], best[:, :, None] + np.arange(max(WIDTHS))]
        inputs = self.embed[seen].reshape(*best.shape, -1)
        d_filters = np.einsum("bf,bfk->kf", dp, inputs) * self.mask
        d_inputs = (dp[:, :, None] * self.filters.T[None]).reshape(*seen.shape, EMBED)
        d_embed = np.zeros_like(self.embed)
        np.add.at(d_embed, seen.ravel(), d_inputs.reshape(-1, EMBED))
        return [d_embed, d_filters, dp.sum(0), pooled_on.T @ dz, dz.sum(0)]


def _sample_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for doc, lang, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "lang", "text")), strict=True):
            all_windows = cut(text.encode())
            for k in sorted({round(x) for x in np.linspace(0, len(all_windows) - 1, WINDOWS_PER_DOC)}):
                rows.append((doc, int(k), lang, all_windows[k].tobytes()))
        yield pa.RecordBatch.from_pydict({
            "doc_id": pa.array([r[0] for r in rows], pa.int64()), "k": pa.array([r[1] for r in rows], pa.int64()),
            "lang": pa.array([r[2] for r in rows], pa.string()), "window": pa.array([r[3] for r in rows], pa.binary()),
        })


def train(labelled: DataFrame, docs_per_lang: int = DOCS_PER_LANG) -> ByteCnn | None:
    """Fit on about ``docs_per_lang`` documents of each language, drawn by a hash of the id.

    The driver receives at most a few windows of each: some megabytes at any
    corpus size. None when nothing is labelled.
    """
    known = labelled.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    sizes = {r["lang"]: r["n"] for r in labelled.where("lang is not null").groupBy("lang").agg(F.count("text").alias("n")).collect()}
    if not sizes:
        return None
    share = F.create_map(*[F.lit(x) for lang, n in sorted(sizes.items()) for x in (lang, min(1.0, docs_per_lang / max(n, 1)))])
    drawn = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("sample")), F.lit(1_000_000)) / 1_000_000 < share[F.col("lang")]
    rows = known.where(drawn).mapInArrow(_sample_windows, "doc_id long, k long, lang string, window binary").toPandas()
    if rows.empty:
        return None
    rows = rows.sort_values(["doc_id", "k", "window"], na_position="last")
    langs = sorted(rows["lang"].unique())
    windows = np.frombuffer(b"".join(rows["window"]), np.uint8).reshape(-1, WINDOW)
    return ByteCnn(langs).fit(windows, rows["lang"].map({x: i for i, x in enumerate(langs)}).to_numpy())


def _has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def _predict(model: ByteCnn | None, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        langs, scores = [], []
        for _, texts in by_bytes(batch.column("text").to_pylist()):
            told = [model is not None and _has_letter(t) for t in texts]
            blocks = [cut(t.encode()) for t, ok in zip(texts, told, strict=True) if ok]
            ends = np.cumsum([0, *map(len, blocks)])
            each = model.predict(np.concatenate(blocks)) if blocks else None
            k = 0
            for ok in told:
                if not ok:
                    langs.append(NONE)
                    scores.append(0.0)
                    continue
                mean = each[ends[k] : ends[k + 1]].mean(0)
                langs.append(model.langs[int(mean.argmax())])
                scores.append(float(min(1.0, mean.max())))
                k += 1
        yield pa.RecordBatch.from_pydict({
            "doc_id": batch.column("doc_id"), "held_out": batch.column("held_out"),
            "lang_pred": pa.array(langs, pa.string()), "score": pa.array(scores, pa.float64()),
        })


def identify(docs: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """Language of every row of ``docs``, from its text alone.

    The network learns from rows of ``labelled`` (``docs`` itself when not
    given) whose crc32(id) mod 3 is not 1. A NULL text, or one without a
    letter, is ``und`` with score 0; so is everything when nothing is
    labelled. The score is the mean probability of the language over all
    windows. Repeated rows are scored each; an empty table gives none.
    """
    source = docs if labelled is None else labelled
    fold = remainder(F.col("doc_id"), 3)
    model = train(source.where(fold != 1).select("doc_id", "text", "lang"))
    return (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), (fold == 1).alias("held_out"), "text")
        .mapInArrow(lambda batches: _predict(model, batches), "doc_id long, held_out boolean, lang_pred string, score double")
    )
