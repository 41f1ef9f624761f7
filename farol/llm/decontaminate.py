"""Benchmark items inside documents, by random-walk embedding and bit sampling (operator 1).

The random walk of Chakraborty, Goldenberg and Koucky reads a string, writes
the current symbol at each step and moves on when a random bit of (step,
symbol) says so. Strings a few edits apart fall back into step, so their
written strings differ in few places. Here symbols are words. Sampling some
steps gives a key; windows that agree on all sampled steps of one of several
independent walks are candidates. The walk from every word of a text is had at
once: from the last step back, the key at a word is that of the same or the
next word one step later. Candidates are verified by exact edit distance
against the whole item.

Every window of a text is embedded. An item is represented by windows of the
same size along its whole length, so it is found when any of them is near.

The walks may miss, above all short items. So each item is also cut into one
piece more than the edits it allows: edits that stay within the limit leave one
piece unchanged, and every run of a text equal to a piece is a candidate. That
alone finds whatever the exact verification would report.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farol.llm.shingles import mix, word_hashes

SIMILARITY = 80       # an item is present when at most 100 - SIMILARITY percent of its words are edited
SIZES = (12, 6, 3, 1)  # words of a window; an item takes the largest it can fill
STRIDE = 2            # windows of an item start this part of a window apart
WALKS = 8             # independent walks
SAMPLED = 2           # of so many steps one is sampled
BLOCK_WORDS = 1 << 14  # words embedded at a time: the walk's arrays stay in cache
ITEM_BYTES = 32 << 20  # text of the items that a task holds; more are searched in further passes


class Walk:
    """One random walk over words and its sampled steps."""

    def __init__(self, number: int, size: int):
        rng = np.random.default_rng([number, size])
        self.size = size
        self.seed = np.uint64(rng.integers(1, 1 << 62))
        steps = [int(rng.integers(i, min(i + SAMPLED, size))) for i in range(0, size, SAMPLED)]
        self.sampled = {*steps} if size > 3 else {*range(size)}

    def keys(self, words: np.ndarray) -> np.ndarray:
        """Key of the window at each word that begins a full window; a step reads at most one word further."""
        n = len(words) - self.size + 1
        if n <= 0:
            return np.empty(0, np.uint32)
        symbol = (mix(words ^ self.seed) >> np.uint64(32)).astype(np.uint32)
        now, moves, change = np.zeros(len(words) + 1, np.uint32), np.empty_like(symbol), np.empty_like(symbol)
        for step in range(self.size - 1, -1, -1):
            np.left_shift(symbol, np.uint32(step), out=moves)
            np.right_shift(moves.view(np.int32), 31, out=moves.view(np.int32))  # all ones where the walk moves on
            np.bitwise_xor(now[1:], now[:-1], out=change)
            change &= moves
            now[:-1] ^= change
            if step in self.sampled:
                now[:-1] *= np.uint32(0x9E3779B1)
                now[:-1] += symbol
                now[:-1] ^= now[:-1] >> np.uint32(15)
        return now[:n]


def limit_of(words: int) -> int:
    """Edits an item of so many words allows."""
    return (100 - SIMILARITY) * words // 100


def piece_size(words: int) -> int:
    """Words of a piece: one piece more than the limit fits into the item side by side."""
    return words // (limit_of(words) + 1)


def piece_keys(words: np.ndarray, sizes: list[int]) -> dict[int, np.ndarray]:
    """Key of the run of each size at each word that begins a full one."""
    out, key = {}, np.zeros(len(words), np.uint64)
    for k in range(1, min(max(sizes, default=0), len(words)) + 1):
        key = mix(key[: len(words) - k + 1] + words[k - 1 :] + np.uint64(k))
        if k in sizes:
            out[k] = (key >> np.uint64(32)).astype(np.uint32)
    return out


def distance_within(item: np.ndarray, text: np.ndarray, limit: int) -> tuple[int, int] | None:
    """Least edit distance between the item and any run of ``text``, with that run's end; None above ``limit``."""
    row = list(range(len(item) + 1))
    best = (row[-1], 0)
    pattern, kept = item.tolist(), text.tolist()
    for end, word in enumerate(kept, 1):
        before, row[0] = row[0], 0
        for i, p in enumerate(pattern, 1):
            cost = before + (p != word)
            before = row[i]
            row[i] = min(cost, before + 1, row[i - 1] + 1)
        if row[-1] < best[0]:
            best = (row[-1], end)
    return best if best[0] <= limit else None


class Items:
    """Items by the keys of their windows."""

    def __init__(self, rows: list[tuple[int, bytes]]):
        self.ids, self.words, self.known = [], [], []
        for item, raw in rows:
            words = word_hashes(raw)
            if len(words):
                self.ids.append(item)
                self.words.append(words)
                self.known.append(Counter(words.tolist()))
        self.tables: list[tuple[Walk | int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        for size in SIZES:
            mine = [i for i, w in enumerate(self.words) if next(s for s in SIZES if s <= len(w)) == size]
            for walk in [Walk(k, size) for k in range(WALKS if size > 3 else 1)] if mine else []:
                keys, owner, start = [], [], []
                for i in mine:
                    found = walk.keys(self.words[i])
                    at = sorted({*range(0, len(found), max(1, size // STRIDE)), len(found) - 1})
                    keys.append(found[at])
                    owner += [i] * len(at)
                    start += at
                self._table(walk, keys, owner, start)
        self.sizes = sorted({piece_size(len(w)) for w in self.words})
        for size in self.sizes:
            keys, owner, start = [], [], []
            for i in (i for i, w in enumerate(self.words) if piece_size(len(w)) == size):
                at = [size * k for k in range(limit_of(len(self.words[i])) + 1)]
                keys.append(piece_keys(self.words[i], [size])[size][at])
                owner += [i] * len(at)
                start += at
            self._table(size, keys, owner, start)

    def _table(self, of: Walk | int, keys: list[np.ndarray], owner: list[int], start: list[int]) -> None:
        flat = np.concatenate(keys)
        order = np.argsort(flat, kind="stable")
        first = np.zeros(1 << 16, bool)
        first[flat >> np.uint32(16)] = True
        self.tables.append((of, flat[order], np.array(owner)[order], np.array(start)[order], first))

    def candidates(self, words: np.ndarray) -> set[tuple[int, int]]:
        """(item, presumed first word) of all windows that share a key with an item's window or piece."""
        found: set[tuple[int, int]] = set()
        pieces = piece_keys(words, self.sizes)
        for of, keys, owner, start, first in self.tables:
            got = of.keys(words) if isinstance(of, Walk) else pieces.get(of, np.empty(0, np.uint32))
            at = np.flatnonzero(first[got >> np.uint32(16)])
            lo = np.searchsorted(keys, got[at], "left")
            hi = np.searchsorted(keys, got[at], "right")
            for p, a, b in zip(at[hi > lo].tolist(), lo[hi > lo].tolist(), hi[hi > lo].tolist(), strict=True):
                found.update((int(owner[k]), p - int(start[k])) for k in range(a, b))
        return found

    def verify(self, words: np.ndarray, found: set[tuple[int, int]]) -> dict[int, tuple[int, int]]:
        """Least (distance, end) of each candidate item; regions that cannot hold enough of its words are passed over."""
        out: dict[int, tuple[int, int]] = {}
        for i, at in sorted(found):
            if at >= 0 and i not in out and np.array_equal(words[at : at + len(self.words[i])], self.words[i]):
                out[i] = (0, at + len(self.words[i]))
        for i, at in sorted(x for x in found if x[0] not in out):
            item = self.words[i]
            limit = limit_of(len(item))
            low = max(0, at - limit)
            region = words[low : max(0, at + len(item) + limit)]
            inside = [w for w in region.tolist() if w in self.known[i]]
            if not limit or len(inside) < len(item) - limit or (self.known[i] & Counter(inside)).total() < len(item) - limit:
                continue
            near = distance_within(item, region, limit)
            if near:
                out[i] = min(out.get(i, (limit + 1, 0)), (near[0], low + near[1]))
        return out


def _search(items: Items, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "item_id", "distance", "item_words", "end_word"]
    gap = max(SIZES)
    for batch in batches:
        rows: list[tuple] = []
        ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.binary())
        held, starts, size = [], [], 0

        def flush():
            # Documents lie side by side, parted by words that occur in none of them.
            if not held:
                return
            wall = mix(np.arange(gap, dtype=np.uint64) + np.uint64(0xA5A5_0000_0000_0001))
            joined = np.concatenate([x for _, w in held for x in (w, wall)])
            begin = np.array(starts)
            per_doc: dict[int, set] = {}
            for i, at in items.candidates(joined):
                # A presumed start may lie before its document, by the words that may be missing there.
                last = int(np.searchsorted(begin, at + limit_of(len(items.words[i])), "right"))
                for d in range(max(0, int(np.searchsorted(begin, at, "right")) - 1), last):
                    if at - begin[d] < len(held[d][1]):
                        per_doc.setdefault(d, set()).add((i, int(at - begin[d])))
            for d, found in sorted(per_doc.items()):
                doc, w = held[d]
                for i, (dist, end) in sorted(items.verify(w, found).items()):
                    rows.append((doc, items.ids[i], dist, len(items.words[i]), end))

        for k, doc in enumerate(ids):
            raw = texts[k].as_py()
            if not raw:
                continue
            w = word_hashes(raw)
            starts.append(size)
            held.append((doc, w))
            size += len(w) + gap
            if size >= BLOCK_WORDS:
                flush()
                held, starts, size = [], [], 0
        flush()
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(5)], names=names)


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, distance, item_words, end_word) for each item a document holds, exactly or nearly.

    An item is held when some run of the document's words is at most a fifth
    of the item's words away from it, in word insertions, deletions and
    replacements; items under five words must occur unchanged. Words are runs
    without ASCII white space, A-Z lowered. The least distance and the first
    run that reaches it are told. NULL or empty texts and items hold nothing;
    rows that repeat a document or an item are reported each.

    Items are sent to the executors in blocks of bounded size; documents never
    move. Only documents that hold something are returned.
    """
    spark = benchmark.sparkSession
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).cast("binary").alias("raw"))
    total = items.agg(F.coalesce(F.sum(F.octet_length("raw")), F.lit(0)).alias("n")).first()["n"]
    blocks = max(1, -(-total // ITEM_BYTES))
    out = None
    for k in range(blocks):
        mine = items.where(F.pmod(F.xxhash64("item_id", "raw"), F.lit(blocks)) == k) if blocks > 1 else items
        rows = sorted((r["item_id"] if r["item_id"] is not None else -1, bytes(r["raw"])) for r in mine.collect())  # at most about ITEM_BYTES
        held = spark.sparkContext.broadcast(rows)
        found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
            lambda batches, held=held: _search(Items(held.value), batches),
            "doc_id long, item_id long, distance long, item_words long, end_word long")
        out = found if out is None else out.unionByName(found)
    return out
