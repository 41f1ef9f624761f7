"""Token counts by a compiled tokenizer (operator 4).

Two deterministic transducers replace the tokenizer. The first reads character
classes and marks where a piece starts; it has five states, so a chunk of text
is a map from entry state to exit state, and the maps of all chunks compose in
a parallel prefix scan. The second reads the bytes of a piece; its states are
determinised on demand, and each transition carries how many tokens the
encoding grows by. It rests on a property of merge tables: the last token of
the encoding of every prefix is unique, and two tokens may stand side by side
exactly when no merge crosses their border before they are complete.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farol.llm.common import by_bytes

LIMIT = 2048            # tokens above which a document is over the limit
LANE = 512              # characters of a chunk whose state map is computed alone
MAX_STATES = 500_000    # determinised states a task keeps; beyond it they are dropped and made again
MAX_UNITS = 700_000     # counted units a task keeps, likewise

# Character classes; an apostrophe that opens a contraction is told apart by what follows it.
BLANK, LETTER, NUMBER, OTHER, SHORT, LONG = range(6)
# States: between pieces, in letters, in other signs, one or two letters of a contraction to come.
_NEXT = np.array([
    [0, 1, 0, 2, 3, 4],
    [0, 1, 0, 2, 3, 4],
    [0, 1, 0, 2, 2, 2],
    [0, 0, 0, 0, 0, 0],
    [3, 3, 3, 3, 3, 3],
], np.uint8)
_STARTS = np.array([
    [0, 1, 1, 1, 1, 1],
    [0, 0, 1, 1, 1, 1],
    [0, 1, 1, 0, 0, 0],
    [0, 0, 0, 0, 0, 0],
    [0, 0, 0, 0, 0, 0],
], bool)
_WHITE = re.compile("[\t-\r\x85\xa0  -     　]")


class Classes:
    """Class of every code point, looked up in the Unicode tables when first seen."""

    def __init__(self):
        self.table = np.full(0x110000, 255, np.uint8)

    def of(self, codes: np.ndarray) -> np.ndarray:
        out = self.table[codes]
        if (out == 255).any():
            for c in np.unique(codes[out == 255]):
                kind = unicodedata.category(chr(c))[0]
                self.table[c] = BLANK if c == 32 else {"L": LETTER, "N": NUMBER}.get(kind, OTHER)
            out = self.table[codes]
        quote = np.flatnonzero(codes == ord("'"))
        if len(quote):
            padded = np.concatenate([codes, [0, 0]])
            one, two = padded[quote + 1], padded[quote + 2]
            out[quote[np.isin(one, [ord(x) for x in "stmd"])]] = SHORT
            pairs = [(one == ord(a)) & (two == ord(b)) for a, b in ("re", "ve", "ll")]
            out[quote[pairs[0] | pairs[1] | pairs[2]]] = LONG
        return out


def piece_starts(classes: np.ndarray, lane: int = LANE) -> np.ndarray:
    """Where pieces start, by composing the state maps of all chunks and then running the chunks side by side."""
    n = len(classes)
    lanes = max(1, -(-n // lane))
    grid = np.zeros(lanes * lane, np.uint8)
    grid[:n] = classes
    grid = np.ascontiguousarray(grid.reshape(lanes, lane).T)
    maps = np.tile(np.arange(len(_NEXT), dtype=np.uint8), (lanes, 1))
    for column in grid:
        maps = _NEXT[maps, column[:, None]]
    step = 1
    while step < lanes:  # inclusive scan: after it maps[i] leads through chunks 0..i
        maps[step:] = np.take_along_axis(maps[step:], maps[:-step].copy(), 1)
        step *= 2
    state = np.concatenate([[0], maps[:-1, 0]]).astype(np.uint8)
    starts = np.empty(grid.shape, bool)
    for j, column in enumerate(grid):
        starts[j] = _STARTS[state, column]
        state = _NEXT[state, column]
    return starts.T.reshape(-1)[:n]


def _byte_symbols() -> str:
    """The printable character that stands for each byte in byte-level vocabularies."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return "".join(chr(b if b in printable else next(spare)) for b in range(256))


class PieceTransducer:
    """Tokens of a piece, read byte by byte.

    A state is a prefix met so far: the last token of its encoding and how
    many tokens it has. ``arcs`` leads from a state and a byte to the next
    state; the closing byte carries the word-end mark and has states of its
    own. ``back`` is the trie of all tokens read from their end.
    """

    MARK = 256

    def __init__(self, model: dict):
        vocab, end = model["vocab"], model["end_of_word_suffix"] or ""
        value = {c: b for b, c in enumerate(_byte_symbols())}
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.rank = {(vocab[a], vocab[b]): i for i, (a, b) in enumerate(merges)}
        self.made = {vocab[a + b]: (vocab[a], vocab[b], i) for i, (a, b) in enumerate(merges)}
        self.marked = bool(end)
        self.spines: dict[tuple[int, int], list[tuple[int, float]]] = {}
        self.beside: dict[tuple[int, int], bool] = {}
        self.whole: dict[int, bool] = {}
        self.back: dict[int, int] = {}
        self.ends = [-1]
        for text, token in vocab.items():
            closing = self.marked and text.endswith(end)
            symbols = [value[c] for c in (text[: -len(end)] if closing else text)] + [self.MARK] * closing
            if self.reachable(token):
                self._insert(symbols, token)
        self.reset()

    def _insert(self, symbols: list[int], token: int) -> None:
        node = 0
        for symbol in reversed(symbols):
            key = node << 9 | symbol
            if key not in self.back:
                self.back[key] = len(self.ends)
                self.ends.append(-1)
            node = self.back[key]
        self.ends[node] = token

    def reset(self) -> None:
        self.arcs: dict[int, int] = {}
        self.token, self.count = [-1], [0]

    def spine(self, token: int, side: int) -> list[tuple[int, float]]:
        """(token, rank of the merge that uses it up) along one edge, from the single symbol to the whole."""
        if (token, side) not in self.spines:
            out, used_by, at = [], float("inf"), token
            while True:
                out.append((at, used_by))
                if at not in self.made:
                    break
                used_by, at = self.made[at][2], self.made[at][side]
            self.spines[(token, side)] = out[::-1]
        return self.spines[(token, side)]

    def crossed(self, a: int, b: int) -> bool:
        """Whether a merge joins the two across their border before both are whole; equal ranks merge from the left."""
        left, right = self.spine(a, 1), self.spine(b, 0)
        i = j = 0
        while i < len(left) - 1 or j < len(right) - 1:
            (x, x_end), (y, y_end) = left[i], right[j]
            merge = self.rank.get((x, y))
            if merge is not None and merge < x_end and merge <= y_end:
                return True
            if x_end <= y_end:
                i += 1
            else:
                j += 1
        return False

    def adjacent(self, a: int, b: int) -> bool:
        """Whether encoding the two tokens' text gives these two tokens."""
        known = self.beside.get((a, b))
        if known is None:
            known = self.beside[(a, b)] = (a, b) not in self.rank and not self.crossed(a, b)
        return known

    def reachable(self, token: int) -> bool:
        """Whether the text of the token encodes to the token itself."""
        known = self.whole.get(token)
        if known is None:
            known = True
            if token in self.made:
                a, b, _ = self.made[token]
                known = self.reachable(a) and self.reachable(b) and not self.crossed(a, b)
            self.whole[token] = known
        return known

    def _state(self, raw: bytes, n: int, path: list[int], node: int) -> int:
        """New state for the first ``n`` bytes; ``path`` holds the states of all shorter prefixes."""
        back, ends, found = self.back, self.ends, []
        at = n
        while at:
            at -= 1
            node = back.get(node << 9 | raw[at])
            if node is None:
                break
            if ends[node] >= 0:
                found.append((at, ends[node]))
        for at, token in reversed(found):
            if not at or self.adjacent(self.token[path[at]], token):
                self.token.append(token)
                self.count.append(self.count[path[at]] + 1)
                return len(self.token) - 1
        raise ValueError("the vocabulary lacks a byte")

    def tokens(self, raw: bytes) -> int:
        """Number of tokens of a piece."""
        if len(self.token) > MAX_STATES:
            self.reset()
        arcs, state, path, last = self.arcs, 0, [0], len(raw) - self.marked
        for i in range(last):
            key = state << 9 | raw[i]
            after = arcs.get(key)
            if after is None:
                after = arcs[key] = self._state(raw, i + 1, path, 0)
            state = after
            path.append(state)
        if not self.marked:
            return self.count[state]
        self._state(raw, len(raw), path, self.back[self.MARK])
        self.token.pop()
        return self.count.pop()


class TokenCounter:
    """Counts tokens of texts as the library does for a lower-casing byte-level file with word ends."""

    def __init__(self, spec: dict):
        kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
        if kinds != ["NFC", "Replace", "Lowercase"] or spec["model"]["type"] != "BPE" or spec["post_processor"]:
            raise ValueError(f"no transducer for {kinds}")
        self.special = re.compile("|".join(re.escape(t["content"]) for t in spec["added_tokens"]) or "(?!)")
        self.transducer, self.classes = PieceTransducer(spec["model"]), Classes()
        self.units: dict[str, int] = {"": 0}
        self.pieces: dict[str, int] = {}

    def normal(self, text: str) -> str:
        text = text if text.isascii() else unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return _WHITE.sub(" ", text).lower()

    def _piece(self, piece: str) -> int:
        n = self.pieces.get(piece)
        if n is None:
            n = self.transducer.tokens(piece.encode())
            if len(piece) <= 64:
                self.pieces[piece] = n
        return n

    def learn(self, units: list[str]) -> None:
        """Count unseen units: runs of text without a space or a line end."""
        if len(self.units) > MAX_UNITS:
            self.units = {"": 0}
        if len(self.pieces) > MAX_UNITS:
            self.pieces = {}
        texts, owner, extra = [], [], {}
        for unit in units:
            cuts = self.special.split(unit) if "<" in unit else [unit]
            extra[unit] = len(cuts) - 1
            for part in cuts:
                texts.append(self.normal(part))
                owner.append(unit)
        joined = " ".join(texts) + " "
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        classes = self.classes.of(codes)
        first = np.flatnonzero(piece_starts(classes))
        stops = np.append(first[1:], len(codes))
        limits = np.cumsum([len(t) + 1 for t in texts])
        unit_of = np.searchsorted(limits, first, side="right")
        found = dict(extra)
        for a, b, k in zip(first.tolist(), stops.tolist(), unit_of.tolist(), strict=True):
            found[owner[k]] += self._piece(joined[a:b].rstrip(" "))
        self.units.update(found)

    def counts(self, texts: list[str]) -> list[int]:
        split = [t.replace("\n", " ").split(" ") for t in texts]
        known = self.units
        unseen = {u for units in split for u in units if u not in known}
        if unseen:
            before = self.units
            self.learn(sorted(unseen))
            if self.units is not before:  # dropped to stay within bounds: what the batch needs is counted again
                rest = {u for units in split for u in units} - self.units.keys()
                self.learn(sorted(rest)) if rest else None
        return [sum(map(self.units.__getitem__, units)) for units in split]


@lru_cache(maxsize=2)
def counter(spec: str) -> TokenCounter:
    """One compiled counter per worker process."""
    return TokenCounter(json.loads(spec))


def _count(spec: str, limit: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    compiled = counter(spec)
    for batch in batches:
        out: list[int] = []
        for _, texts in by_bytes(batch.column("text").to_pylist()):
            out += compiled.counts(texts)
        n = pa.array(out, pa.int64())
        yield pa.RecordBatch.from_pydict({
            "doc_id": batch.column("doc_id"), "n_bytes": batch.column("n_bytes"), "n_tokens": n,
            "over_limit": pa.array([x > limit for x in out], pa.bool_()),
        })


def count_tokens(docs: DataFrame, tokenizer: str, limit: int = LIMIT) -> DataFrame:
    """Bytes and tokens of every row's whole text.

    ``tokenizer`` is the path of a ``tokenizers`` file; its content travels
    with the job, so executors need no file. NULL text is the empty text: no
    tokens. Special strings inside a text count as their one token. Repeated
    rows are counted each; other columns are ignored.
    """
    with open(tokenizer, encoding="utf-8") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())  # one vocabulary file: some megabytes, whatever the corpus
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), "text",
    ).mapInArrow(lambda batches: _count(spec.value, limit, batches),
                 "doc_id long, n_bytes long, n_tokens long, over_limit boolean")

