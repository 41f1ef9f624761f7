"""Repeated passages by sorted suffixes (operator 2).

A byte goes when a string of SPAN bytes that covers it also starts earlier.
Equal strings hold the same anchor, the smallest hash of a short gram inside
them, at the same place. So each run of starts with one anchor is a slice;
only slices of one anchor can hold equal strings. Slices that are equal as a
whole are settled by their hash and extent. Where an anchor has several
different slices, their bytes travel, and all strings of SPAN bytes in them
are put in order by deep-shallow sorting: multikey sorting by eight bytes at a
time to a shallow depth, then a blind trie for each group still equal there.
Of equal neighbours the earliest stays.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farol.llm import bitmap
from farol.llm.common import staged
from farol.llm.shingles import mix
from farol.operators.order import number_rows

SPAN = 100                 # bytes of a repeated string
WINDOW = 64                # grams of a string, a power of two
GRAM = SPAN - WINDOW + 1   # bytes of a gram
SHALLOW = 32               # bytes ordered by multikey sorting
PIECE = 1 << 20            # starts of a text whose anchors are found at a time
BLOCK_BYTES = 2 << 20      # bytes of slices ordered at a time
HOT_SLICES = 50_000        # different slices of one anchor above which its strings are dealt by their own hash
DONE = 255                 # marks a settled run in the place of an offset
BASE = 0x9E3779B97F4A7C15  # of the hash of a run of bytes, whose length is bounded by SPAN and WINDOW


@lru_cache(maxsize=4)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse, modulo 2^64."""
    out = []
    for base in (BASE, pow(BASE, -1, 1 << 64)):
        p = np.full(n, np.uint64(base), np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


def slices(data: np.ndarray) -> tuple[np.ndarray, ...]:
    """(first start, starts, place of the anchor in the first string, anchor, content) of each run of starts with one anchor."""
    n = len(data) - SPAN + 1
    if n <= 0:
        return tuple(np.empty(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
    power, inverse = _powers(1 << max(12, len(data).bit_length()))
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[: len(data)], out=total[1:])
    grams = mix((total[GRAM:] - total[:-GRAM]) * inverse[: len(data) - GRAM + 1])
    least = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
    step = 1
    while step < WINDOW:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    place = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.concatenate([[0], np.flatnonzero(place[1:] != place[:-1]) + 1])
    count = np.diff(np.append(first, n))
    off = place[first] - first
    content = mix((total[first + count + SPAN - 1] - total[first]) * inverse[first] ^ mix((count << 8 | off).astype(np.uint64)))
    return first, count, off, grams[place[first]], content


def _pieces(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray]]:
    """(id, offset, bytes) of all texts, long ones in pieces that together have each start once."""
    for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.binary()), strict=True):
        raw = text.as_py() or b""
        for at in range(0, max(0, len(raw) - SPAN + 1), PIECE):
            yield doc, at, np.frombuffer(raw, np.uint8, min(PIECE + SPAN - 1, len(raw) - at), at)


def runs(doc: np.ndarray, first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same starts as few runs: neighbours of one document are joined."""
    if not len(doc):
        return doc, first, count
    order = np.lexsort((first, doc))
    doc, first, count = doc[order], first[order], count[order]
    new = np.concatenate([[True], (doc[1:] != doc[:-1]) | (first[1:] != first[:-1] + count[:-1])])
    at = np.flatnonzero(new)
    return doc[at], first[at], np.add.reduceat(count, at)


def _anchored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The earliest of equal slices of a batch; the others are settled here and only pass through as runs."""
    for batch in batches:
        parts = [(np.full(len(s[0]), doc), s[0] + at, *s[1:]) for doc, at, data in _pieces(batch) for s in [slices(data)]]
        if not parts:
            continue
        doc, first, count, off, anchor, content = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.lexsort((first, doc, content, anchor))
        doc, first, count, off, anchor, content = (x[order] for x in (doc, first, count, off, anchor, content))
        again = np.concatenate([[False], (anchor[1:] == anchor[:-1]) & (content[1:] == content[:-1])])
        d, f, c = runs(doc[again], first[again], count[again])
        keep = ~again
        spread = mix(d.view(np.uint64) ^ mix(f.astype(np.uint64)))
        yield pa.RecordBatch.from_arrays([
            pa.array(np.concatenate([anchor[keep], spread]).view(np.int64)),
            pa.array(np.concatenate([content[keep].view(np.int64), c])),
            pa.array(np.concatenate([doc[keep], d])),
            pa.array(np.concatenate([first[keep] << 16 | count[keep] << 8 | off[keep], f << 16 | DONE])),
        ], names=["anchor", "content", "doc", "place"])


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come ordered by anchor, content, document and place: later equal slices are settled, anchors with several contents stay open."""
    held = None   # the first row of the content met last, until it is known whether its anchor has another

    def emit(doc, first, count, anchor):
        return pa.RecordBatch.from_arrays([pa.array(doc), pa.array(first), pa.array(count), pa.array(anchor, pa.int64())],
                                          names=["doc", "first", "count", "anchor"])

    for batch in batches:
        a, c, d, p = (batch.column(x).to_numpy() for x in ("anchor", "content", "doc", "place"))
        done = (p & 255) == DONE
        if done.any():
            yield emit(d[done], p[done] >> 16, c[done], pa.nulls(int(done.sum()), pa.int64()))
            a, c, d, p = a[~done], c[~done], d[~done], p[~done]
        if held is not None:
            a, c, d, p = (np.concatenate([[h], x]) for h, x in zip(held[:4], (a, c, d, p), strict=True))
        if not len(a):
            continue
        same = a[1:] == a[:-1]
        lead = np.flatnonzero(np.concatenate([[True], ~same | (c[1:] != c[:-1])]))
        later = np.ones(len(a), bool)
        later[lead] = False
        if later.any():
            gone = runs(d[later], p[later] >> 16, p[later] >> 8 & 255)
            yield emit(*gone, pa.nulls(len(gone[0]), pa.int64()))
        la = a[lead]
        equal = la[1:] == la[:-1]
        several = np.concatenate([[False], equal]) | np.concatenate([equal, [False]])
        several[0] |= held is not None and held[4] and la[0] == held[0]
        ready = several.copy()
        ready[-1] = False   # kept for the next batch
        if held is not None and held[4]:
            ready[0] = False  # passed on before
        x = lead[ready]
        if len(x):
            yield emit(d[x], p[x] >> 16, p[x] >> 8 & 255, a[x])
        z = lead[-1]
        told = bool(several[-1])
        if told and not (len(lead) == 1 and held is not None and held[4]):
            yield emit(d[z : z + 1], p[z : z + 1] >> 16, p[z : z + 1] >> 8 & 255, a[z : z + 1])
        held = (a[z], c[z], d[z], p[z], told)


def _bodies(open_bits: np.ndarray, hot: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bytes of the slices of open anchors, each content once a batch; strings of hot anchors one by one under their own hash."""
    for batch in batches:
        seen: set[tuple[int, int]] = set()
        rows: list[tuple] = []
        size = 0
        for doc, at, data in sorted(_pieces(batch), key=lambda x: x[:2]):
            first, count, off, anchor, content = slices(data)
            if not len(first):
                continue
            for k in np.flatnonzero(bitmap.inside(open_bits, anchor.view(np.int64))).tolist():
                key = (int(anchor[k]), int(content[k]))
                if key in seen:
                    continue
                seen.add(key)
                f, c = int(first[k]), int(count[k])
                signed = int(anchor[k].view(np.int64))
                if len(hot) and hot[min(np.searchsorted(hot, signed), len(hot) - 1)] == signed:
                    for s in range(f, f + c):
                        body = data[s : s + SPAN].tobytes()
                        rows.append((int.from_bytes(hashlib.blake2b(body, digest_size=8).digest(), "little", signed=True), doc, at + s, 1, body))
                else:
                    rows.append((signed, doc, at + f, c, data[f : f + c + SPAN - 1].tobytes()))
                size += c + SPAN
            if size > 8 << 20:
                yield _rows(rows)
                rows, size = [], 0
        if rows:
            yield _rows(rows)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64()] * 4 + [pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)],
                                      names=["anchor", "doc", "first", "count", "body"])


class BlindTrie:
    """Strings of equal length by the places where they differ; inner nodes hold a depth and no text."""

    def __init__(self, skip: int):
        self.skip, self.root = skip, None

    def add(self, text: bytes, tag: int) -> None:
        if self.root is None:
            self.root = (text, [tag])
            return
        node = self.root
        while isinstance(node, list):    # blind descent: any branch will do where the byte is new
            node = node[1].get(text[node[0]]) or next(iter(node[1].values()))
        other = node[0]
        if other == text:
            node[1].append(tag)
            return
        split = next(i for i in range(self.skip, len(text)) if text[i] != other[i])
        above, node = None, self.root
        while isinstance(node, list) and node[0] < split:
            above, node = node, node[1][text[node[0]]]
        leaf = (text, [tag])
        if isinstance(node, list) and node[0] == split:
            node[1][text[split]] = leaf
            return
        made = [split, {other[split]: node, text[split]: leaf}]
        if above is None:
            self.root = made
        else:
            above[1][text[above[0]]] = made

    def ordered(self) -> list[list[int]]:
        """Tags of equal strings, strings ascending."""
        out, stack = [], [self.root] if self.root is not None else []
        while stack:
            node = stack.pop()
            if isinstance(node, list):
                stack += [node[1][b] for b in sorted(node[1], reverse=True)]
            else:
                out.append(node[1])
        return out


def deep_shallow(text: bytes, starts: np.ndarray, span: int = SPAN) -> tuple[np.ndarray, np.ndarray]:
    """Order of the strings text[s : s + span], and for each place of it whether it equals the one before."""
    n = len(starts)
    order, same = np.arange(n), np.zeros(n, bool)
    data = np.frombuffer(text + bytes(8), np.uint8)
    word = np.zeros(len(data) - 7, np.uint64)
    for i in range(8):
        word = word << np.uint64(8) | data[i : len(data) - 7 + i].astype(np.uint64)
    shallow = min(SHALLOW, span // 8 * 8)
    group, active = np.zeros(n, np.int64), np.arange(n)
    for depth in range(0, shallow, 8):
        key, g = word[starts[order[active]] + depth], group[active]
        by = np.lexsort((key, g))
        order[active], key = order[active][by], key[by]
        new = np.concatenate([[True], (g[1:] != g[:-1]) | (key[1:] != key[:-1])]) if len(active) else np.empty(0, bool)
        first = np.flatnonzero(new)
        size = np.diff(np.append(first, len(active)))
        group[active] = np.repeat(active[first], size)
        active = active[np.repeat(size > 1, size)]
    first = np.flatnonzero(np.concatenate([[True], group[active][1:] != group[active][:-1]])) if len(active) else []
    for lo, hi in zip(first, np.append(first[1:], len(active)) if len(active) else [], strict=True):
        place = active[lo:hi]
        trie = BlindTrie(shallow)
        for s in order[place].tolist():
            at = int(starts[s])
            trie.add(text[at : at + span], s)
        at = int(place[0])
        for tags in trie.ordered():
            order[at : at + len(tags)] = tags
            same[at + 1 : at + len(tags)] = True
            at += len(tags)
    return order, same


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Settled runs of the slices, whole anchors at a time; rows come ordered by anchor."""
    held: list[tuple] = []
    size = 0
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("anchor", "doc", "first", "count", "body")), strict=True):
            if size > BLOCK_BYTES and held[-1][0] != row[0]:
                yield _settle(held)
                held, size = [], 0
            held.append(row)
            size += len(row[4])
    if held:
        yield _settle(held)


def _settle(rows: list[tuple]) -> pa.RecordBatch:
    doc, first, count = (np.array([r[i] for r in rows], np.int64) for i in (1, 2, 3))
    begin = np.cumsum([0, *[len(r[4]) for r in rows]])[:-1]
    inner = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    starts, owner, at = np.repeat(begin, count) + inner, np.repeat(doc, count), np.repeat(first, count) + inner
    order, same = deep_shallow(b"".join(r[4] for r in rows), starts)
    kind = np.cumsum(~same)
    o, p = owner[order], at[order]
    by = np.lexsort((p, o, kind))
    kind, o, p = kind[by], o[by], p[by]
    lead = np.concatenate([[True], kind[1:] != kind[:-1]])
    least = np.maximum.accumulate(np.where(lead, np.arange(len(kind)), 0))
    later = (o != o[least]) | (p != p[least])
    d, f, c = runs(o[later], p[later], np.ones(int(later.sum()), np.int64))
    return pa.RecordBatch.from_arrays([pa.array(d), pa.array(f), pa.array(c)], names=["doc", "first", "count"])


def spans(first: list[int], count: list[int]) -> list[tuple[int, int]]:
    """Maximal byte runs covered by strings that begin at the given runs of starts."""
    out: list[list[int]] = []
    for a, n in sorted(zip(first, count, strict=True)):
        b = a + n + SPAN - 1
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def _plain(bits: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents that certainly stay whole are finished here; the texts of the others go on."""
    for batch in batches:
        ids = batch.column("doc_id").to_numpy()
        texts = [x or b"" for x in batch.column("text").cast(pa.binary()).to_pylist()]
        touched = bitmap.inside(bits, ids).tolist()
        yield pa.RecordBatch.from_arrays([
            batch.column("doc_id"), pa.array([len(t) for t in texts], pa.int64()),
            pa.array([None if x else hashlib.sha256(t).hexdigest() for t, x in zip(texts, touched, strict=True)], pa.string()),
            pa.array([t if x else None for t, x in zip(texts, touched, strict=True)], pa.binary()),
        ], names=["doc_id", "n_bytes", "sha", "raw"])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for n, sha, raw, firsts, counts in zip(*(batch.column(c).to_pylist() for c in ("n_bytes", "sha", "raw", "firsts", "counts")), strict=True):
            gone = spans(firsts or [], counts or [])
            if raw is not None:
                edges = [0, *[x for pair in gone for x in pair], len(raw)]
                kept = b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                sha = hashlib.sha256(kept).hexdigest()
            out.append((n, sum(b - a for a, b in gone), len(gone), sha))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *[pa.array([r[i] for r in out], t) for i, t in enumerate([pa.int64()] * 3 + [pa.string()])]],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def repeated_runs(docs: DataFrame) -> DataFrame:
    """(doc, first, count): all starts of strings that also start earlier."""
    judged = staged(
        docs.mapInArrow(_anchored, "anchor long, content long, doc long, place long")
        .repartition("anchor").sortWithinPartitions("anchor", "content", "doc", "place")
        .mapInArrow(_judge, "doc long, first long, count long, anchor long"), "judged")
    unsettled = judged.where("anchor is not null").select("anchor")
    hot = np.sort(np.array([r["anchor"] for r in unsettled.groupBy("anchor").count().where(F.col("count") > HOT_SLICES).collect()], np.int64))
    held = docs.sparkSession.sparkContext.broadcast((bitmap.bitmap(unsettled), hot))  # 8 MB, and an anchor per HOT_SLICES rows
    compared = (
        docs.mapInArrow(lambda b: _bodies(*held.value, b), "anchor long, doc long, first long, count long, body binary")
        .repartition("anchor").sortWithinPartitions("anchor")
        .mapInArrow(_compare, "doc long, first long, count long")
    )
    return staged(judged.where("anchor is null").select("doc", "first", "count").unionByName(compared), "runs")


def remove_repeats(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    Texts are UTF-8 bytes; NULL is the empty text. Rows are ordered by id, a
    NULL id last; rows that share an id are documents of their own, ordered by
    text. Strings never cross documents and are judged on the input. Texts
    under SPAN bytes stay whole; empty tables give empty results; other
    columns are ignored.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    odd = docs.groupBy("doc_id").count().where("count > 1 or doc_id is null").limit(1).count()
    if not odd:
        return _without_repeats(docs)
    order = [F.col("doc_id").isNull(), F.col("doc_id"), F.coalesce("text", F.lit(""))]
    numbered = number_rows(docs, order, "row")
    done = _without_repeats(numbered.select(F.col("row").alias("doc_id"), "text")).withColumnRenamed("doc_id", "row")
    return numbered.select("row", "doc_id").join(done, "row").drop("row")


def _without_repeats(docs: DataFrame) -> DataFrame:
    """The same for ids that are all known and differ."""
    found = repeated_runs(docs)
    bits = docs.sparkSession.sparkContext.broadcast(bitmap.bitmap(found.select("doc")))
    per_doc = found.groupBy("doc").agg(F.collect_list(F.struct("first", "count")).alias("runs")).select(
        "doc", F.col("runs.first").alias("firsts"), F.col("runs.count").alias("counts"))  # one text's runs: no more than its bytes
    texts = docs.mapInArrow(lambda b: _plain(bits.value, b), "doc_id long, n_bytes long, sha string, raw binary")
    return (
        texts.join(per_doc, F.col("doc_id") == F.col("doc"), "left").drop("doc")
        .mapInArrow(_cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    )
