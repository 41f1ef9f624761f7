"""Near duplicates by PartEnum signatures (operator 6).

A document is the set of its five-word shingles. Two sets that overlap enough
have sizes within a fixed ratio, so both belong to one of two neighbouring
size bands, and they differ in at most k shingles, k following from the band.
The shingle domain is cut into more than k / 2 parts, so some part holds at
most one difference; each part is cut into three cells, and the content of
every two of them is a signature: two sets that may be linked share one.

Very frequent shingles are left out of the cells of documents that have enough
others: that never adds a difference, so nothing is lost, and a passage that
many documents share gathers them in no signature.

Links are found in two steps. In the first a document is compared with the document of
its signatures that shares most with all others, which is the middle of a
group of near copies: large groups join at once, by a pair per document. What
is left, signatures whose documents are not all connected, is compared in
full: signatures with the same documents once, in blocks of bounded size,
first by the parities of the shingles in 512 buckets (sets differ in at least
as many shingles as parities do), and then on the sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from hashlib import blake2b
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from farol.llm.common import release, staged
from farol.llm.graph import components
from farol.llm.shingles import mix, shingle_set

PERCENT = 80               # linked when 100 * intersection >= PERCENT * union
SINGLE = 64                # below this size every shingle is a signature
GROUP, DROP = 3, 1         # cells of a part, and how many of them may differ
ROUNDS = 1                 # rounds of comparisons with leaders; a second one finds next to nothing that the last comparison does not
SPREAD = 8                 # tasks that the signatures of one leader are dealt to
DOCS = 4096                # documents of a signature compared with each other in one task
RARE = 0.8                 # share of a set outside the frequent shingles that suffices for the cells
FREQUENT_LOCAL = 4         # occurrences in one batch from which a shingle is reported
FREQUENT_MAX = 1 << 18     # most frequent shingles set aside: 2 MB; any choice gives the same links
BROADCAST_IDS = 1_000_000  # ids sent to all executors at most (8 MB); more are joined by shuffle
BUCKETS = 512              # parities, one bit each
BLOCK = 1 << 14            # pairs compared at a time
PAIRS = 1 << 20            # pairs held to drop repeated ones


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def sketch(grams: np.ndarray) -> bytes:
    """Parity of the shingles in each bucket: every shingle that only one of two sets has flips one bit at most."""
    counts = np.bincount((grams & np.uint64(BUCKETS - 1)).astype(np.int64), minlength=BUCKETS)
    return np.packbits((counts & 1).astype(bool)).tobytes()


def set_name(grams: np.ndarray) -> bytes:
    """Digest of a sorted set: equal sets, and no others, share it."""
    return blake2b(grams.tobytes(), digest_size=16).digest()


def handle(name: bytes) -> int:
    """A number for a set's rows; sets that share one are kept apart by their names."""
    return int.from_bytes(name[:8], "little", signed=True)


def bands(n: int) -> list[int]:
    """Bands a set of n shingles belongs to: its own, and the one below if sets there may be linked to it."""
    own = n.bit_length() - 1
    return [own, own - 1] if own and 100 * ((1 << own) - 1) >= PERCENT * n else [own]


def cell_signatures(grams: np.ndarray, band: int, domain: int) -> np.ndarray:
    """Hashes of all non-empty subsets of GROUP - DROP cells of each part of the band's partition.

    k bounds the differences of two linked sets, the smaller one of the band.
    One part more than pigeonhole asks for, because two agreeing cells may both be empty.
    """
    low = 1 << band
    salt = mix(np.full(1, (band << 2 | domain) + 1, np.uint64))[0]
    if low < SINGLE:
        return grams ^ salt
    largest = 2 * low - 1
    k = int(largest * (1 + 100 / PERCENT) * (100 - PERCENT) / (100 + PERCENT))
    cells = GROUP * (k // (DROP + 1) + 2)
    place = (((grams * (salt | np.uint64(1))) >> np.uint64(32)) * np.uint64(cells) >> np.uint64(32)).astype(np.int64)
    content = np.zeros(cells, np.uint64)
    np.add.at(content, place, grams)  # shingle hashes are random numbers: their sum names the cell's content
    content = content.reshape(-1, GROUP)
    out = []
    for chosen in combinations(range(GROUP), GROUP - DROP):
        total = np.zeros(len(content), np.uint64)
        for c in chosen:
            total = mix(total + content[:, c])
        part = np.arange(len(content), dtype=np.uint64)
        name = mix(salt + np.uint64(sum(1 << c for c in chosen)) + part * np.uint64(8))
        filled = (content[:, list(chosen)] != 0).any(1)
        out.append(mix(total ^ name)[filled])
    return np.concatenate(out)


class Frequent:
    """Sorted frequent shingles behind a small table that settles most others at once."""

    def __init__(self, values: np.ndarray):
        self.values, self.table = values, np.zeros(1 << 22, bool)
        self.table[values >> np.uint64(42)] = True

    def without(self, grams: np.ndarray) -> np.ndarray:
        maybe = np.flatnonzero(self.table[grams >> np.uint64(42)])
        if not len(maybe):
            return grams
        at = np.minimum(np.searchsorted(self.values, grams[maybe]), len(self.values) - 1)
        return np.delete(grams, maybe[self.values[at] == grams[maybe]])


def signatures(grams: np.ndarray, frequent: Frequent) -> np.ndarray:
    """All signatures of a set over the domain without frequent shingles, and over all of it where too few are left."""
    rare = frequent.without(grams)
    out = []
    for band in bands(len(grams)):
        if len(rare):
            out.append(cell_signatures(rare, band, 0))
        if len(rare) <= RARE * len(grams):
            out.append(cell_signatures(grams, band, 1))
    return np.concatenate(out)


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[int | None, bytes]]:
    for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
        yield doc, (text or "").encode("utf-8", "surrogatepass")


SETS = "doc_id long, n long, f1 long, id binary, counts binary"


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per document, and a row with no counts per shingle that is frequent in the batch."""
    for batch in batches:
        rows, held, size = [], [], 0
        for doc, raw in _texts(batch):
            grams = shingle_set(raw)
            name = set_name(grams)
            rows.append((doc, len(grams), handle(name), name, sketch(grams)))
            held.append(grams)
            size += len(grams)
            if size > 4_000_000:
                rows += _frequent(held)
                held, size = [], 0
        rows += _frequent(held)
        yield pa.RecordBatch.from_arrays([
            pa.array([r[i] for r in rows], t) for i, t in enumerate([pa.int64()] * 3 + [pa.binary()] * 2)
        ], names=["doc_id", "n", "f1", "id", "counts"])


def _frequent(held: list[np.ndarray]) -> list[tuple]:
    grams = np.sort(np.concatenate(held)) if held else np.empty(0, np.uint64)
    if not len(grams):
        return []
    first = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]]))
    n = np.diff(np.append(first, len(grams)))
    keep = n >= FREQUENT_LOCAL
    return [(None, c, g, None, None) for c, g in zip(n[keep].tolist(), _signed(grams[first[keep]]).tolist(), strict=True)]


def _sign(values: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    frequent = Frequent(values)
    for batch in batches:
        sigs, owners, size = [], [], 0
        for _, raw in _texts(batch):
            grams = shingle_set(raw)
            if not len(grams):
                continue
            mine = signatures(grams, frequent)
            sigs.append(mine)
            owners.append(np.full(len(mine), handle(set_name(grams))))
            size += len(mine)
            if size > 500_000:
                yield _pairs(sigs, owners)
                sigs, owners, size = [], [], 0
        if sigs:
            yield _pairs(sigs, owners)


def _pairs(sigs: list[np.ndarray], owners: list[np.ndarray]) -> pa.RecordBatch:
    sig, owner = np.concatenate(sigs), np.concatenate(owners)
    return pa.RecordBatch.from_arrays([pa.array(_signed(sig)), pa.array(owner, pa.int64())], names=["sig", "f1"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, out, size = [], [], 0
        for doc, raw in _texts(batch):
            ids.append(doc)
            out.append(_signed(shingle_set(raw)))
            size += len(out[-1])
            if size > 500_000:
                yield _listed(ids, out)
                ids, out, size = [], [], 0
        yield _listed(ids, out)


def _listed(ids: list, sets: list[np.ndarray]) -> pa.RecordBatch:
    ends = pa.array(np.cumsum([0, *map(len, sets)]), pa.int32())
    values = pa.array(np.concatenate(sets) if sets else np.empty(0, np.int64))
    return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.ListArray.from_arrays(ends, values)], names=["doc_id", "grams"])


def may_link(n1: np.ndarray, c1: np.ndarray, n2: np.ndarray, c2: np.ndarray) -> np.ndarray:
    """False only for pairs whose sizes or parities rule a link out."""
    least = np.maximum(np.bitwise_count(c1 ^ c2).sum(-1, dtype=np.int64), np.abs(n1 - n2))
    # |a & b| >= PERCENT/(100+PERCENT) * (|a|+|b|), so the difference is at most the rest.
    return (100 + PERCENT) * least <= (100 - PERCENT) * (n1 + n2)


def _cross(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of unlike components inside a signature's block that the parities allow.

    Rows come ordered by leader, block pair and signature. Signatures of one
    leader hold much the same documents, so what they repeat is dropped here.
    """
    held, pairs, leader = None, [], None
    for batch in batches:
        rows = [batch.column(c).to_numpy() for c in ("leader", "i", "j", "sig", "block", "doc_id", "component", "n")]
        rows.append(np.frombuffer(b"".join(batch.column("counts").to_pylist()), np.uint64).reshape(-1, BUCKETS // 64))
        if held is not None:
            rows = [np.concatenate(x) for x in zip(held, rows, strict=True)]
        if not len(rows[0]):
            continue
        group = np.flatnonzero(np.any([np.diff(rows[c], prepend=rows[c][0] - 1) != 0 for c in range(4)], 0))
        held = [x[group[-1] :] for x in rows]
        rows = [x[: group[-1]] for x in rows]
        for part in np.split(np.arange(group[-1]), np.flatnonzero(np.diff(rows[0])) + 1):
            if len(part) and rows[0][part[0]] != leader:
                yield from _told(pairs)
                pairs, leader = [], rows[0][part[0]]
            pairs += _compare([x[part] for x in rows], np.flatnonzero(np.isin(part, group)))
            if sum(map(len, pairs)) > PAIRS:
                yield from _told(pairs)
                pairs = []
    if held is not None:
        pairs += _compare(held, np.zeros(1, np.int64))
    yield from _told(pairs)


def _told(pairs: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    if pairs:
        found = np.unique(np.concatenate(pairs), axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], names=["a", "b"])


def _compare(rows: list[np.ndarray], starts: np.ndarray) -> list[np.ndarray]:
    """Each row with the one k places on, for all k that stay inside a group: all groups at once."""
    _, i, j, _, block, doc, comp, n, counts = rows
    group = np.zeros(len(doc), np.int64)
    group[starts[1:] if len(starts) and starts[0] == 0 else starts] = 1
    group = np.cumsum(group)
    out, k, at = [], 1, np.arange(len(doc))
    while True:
        at = at[at + k < len(doc)]
        at = at[group[at] == group[at + k]]
        if not len(at):
            return out
        new = at[(comp[at] != comp[at + k]) & ((i[at] == j[at]) | (block[at] != block[at + k]))]
        for part in np.split(new, range(BLOCK, len(new), BLOCK)):
            ok = part[may_link(n[part], counts[part], n[part + k], counts[part + k])]
            if len(ok):
                p, q = doc[ok], doc[ok + k]
                out.append(np.unique(np.stack([np.minimum(p, q), np.maximum(p, q)], 1), axis=0))
        k += 1


def verified(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """Those (a, b) pairs of document ids whose sets are similar enough."""
    pairs = staged(pairs, "candidates")
    ids = staged(pairs.select(F.col("a").alias("doc_id")).unionByName(pairs.select(F.col("b").alias("doc_id"))).distinct(), "candidate_ids")
    wanted = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    sets = staged(docs.join(wanted, "doc_id", "left_semi").mapInArrow(_sets, "doc_id long, grams array<long>"), "sets")
    both = F.size(F.array_intersect("x", "y"))
    links = staged(
        pairs.join(sets.select(F.col("doc_id").alias("a"), F.col("grams").alias("x")), "a")
        .join(sets.select(F.col("doc_id").alias("b"), F.col("grams").alias("y")), "b")
        .where(100 * both >= PERCENT * (F.size("x") + F.size("y") - both)).select("a", "b"), "links")
    release(pairs, ids, sets)
    return links


def _named(classes: DataFrame, links: DataFrame | None) -> DataFrame:
    """Classes with the component their representative is in so far."""
    if links is None:
        return classes.withColumn("component", F.col("doc_id"))
    joined = components(links).withColumnRenamed("node", "doc_id")
    return classes.join(joined, "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id"))


def _mixed(shared: DataFrame, named: DataFrame) -> DataFrame:
    """Rows of signatures whose documents are not all connected, with their leader: the document that shares most."""
    rows = shared.join(named.select("f1", "doc_id", "component"), "f1")
    best = rows.groupBy("sig").agg(
        F.min("component").alias("lo"), F.max("component").alias("hi"), F.count(F.lit(1)).alias("size"),
        F.max(F.struct("degree", "doc_id", "component")).alias("top"), F.sum(F.xxhash64("doc_id").cast("decimal(20,0)")).alias("who"),
    ).where("lo < hi").drop("lo", "hi")
    return rows.join(best, "sig")


def _to_leaders(mixed: DataFrame) -> DataFrame:
    """A pair per document: with the greatest leader of its signatures that it is not connected with."""
    top = (
        mixed.where(F.col("component") != F.col("top.component")).groupBy("doc_id").agg(F.max("top").alias("top"))
        .select("doc_id", F.col("top.doc_id").alias("leader"))
    )
    return top.select(F.least("doc_id", "leader").alias("a"), F.greatest("doc_id", "leader").alias("b")).distinct()


def _all_pairs(mixed: DataFrame, classes: DataFrame) -> DataFrame:
    """All pairs left, signatures of the same documents once and those of many documents block by block."""
    sets = mixed.groupBy("size", "who").agg(F.min("sig").alias("sig"))
    rows = mixed.join(sets.select("sig"), "sig", "left_semi").join(classes.select("doc_id", "n", "counts"), "doc_id")
    blocks = F.ceil(F.col("size") / DOCS).cast("int")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("doc_id"), blocks).cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    rows = rows.select(
        F.col("top.doc_id").alias("leader"), F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
        "sig", "block", "doc_id", "component", "n", "counts")
    # A leader's signatures lie in a few tasks, so that most repeated pairs meet and no task has them all.
    return rows.repartition("leader", "i", "j", F.pmod(F.xxhash64("sig"), F.lit(SPREAD))).sortWithinPartitions("leader", "i", "j", "sig").mapInArrow(_cross, "a long, b long").distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id.

    Words are runs without ASCII white space, A-Z lowered; a text with fewer
    than five words is one shingle; NULL, empty or blank text has none and is
    its own component. Rows with a NULL id belong to a group but never name
    it. Rows that repeat an id with different texts are joined through it.
    Empty tables give empty results; other columns are ignored.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    seen = staged(docs.mapInArrow(_describe, SETS), "shingles")
    per_doc = seen.where("counts is not null").select("doc_id", "n", "f1", "id", "counts")
    top = seen.where("counts is null").groupBy("f1").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "f1").limit(FREQUENT_MAX)
    frequent = np.sort(np.array([r["f1"] for r in top.select("f1").collect()], np.int64).view(np.uint64))
    held = docs.sparkSession.sparkContext.broadcast(frequent)  # at most FREQUENT_MAX numbers
    classes = staged(
        per_doc.where("n > 0 and doc_id is not null").groupBy("f1", "id").agg(
            F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("counts").alias("counts")), "classes")
    signed = staged(
        docs.where("doc_id is not null").mapInArrow(lambda batches: _sign(held.value, batches), "sig long, f1 long")
        .repartition("sig").distinct().withColumn("size", F.count(F.lit(1)).over(W.Window.partitionBy("sig")))
        .where("size > 1").select("sig", "f1", "size"), "signed")
    degrees = signed.groupBy("f1").agg(F.sum("size").alias("degree"))
    shared = staged(signed.join(degrees, "f1").select("sig", "f1", "degree"), "shared")
    release(signed)
    found: list[DataFrame] = []
    mixed: DataFrame | None = None
    for number in range(ROUNDS + 1):
        # Components only grow, so signatures whose documents are connected stay out of all later rounds.
        before, mixed = mixed or shared, staged(_mixed(
            (mixed or shared).select("sig", "f1", "degree"), _named(classes, reduce(DataFrame.unionByName, found) if found else None)), "mixed")
        release(before)
        found.append(verified(docs, _to_leaders(mixed) if number < ROUNDS else _all_pairs(mixed, classes)))
    release(mixed)
    links = reduce(DataFrame.unionByName, found)
    groups = components(links.unionByName(_same_id(per_doc, classes)))
    of_class = classes.join(groups.withColumnRenamed("node", "doc_id"), "doc_id", "left").select(
        "f1", "id", F.coalesce("component", "doc_id").alias("component"))
    return per_doc.join(of_class, ["f1", "id"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))


def _same_id(per_doc: DataFrame, classes: DataFrame) -> DataFrame:
    """Links between the classes of rows that repeat an id."""
    twice = per_doc.where("n > 0 and doc_id is not null").groupBy("doc_id").agg(
        F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo < hi")
    rows = per_doc.select("doc_id", "f1", "id").join(twice.select("doc_id"), "doc_id", "left_semi")
    reps = rows.join(classes.select("f1", "id", F.col("doc_id").alias("rep")), ["f1", "id"])
    return reps.groupBy("doc_id").agg(F.collect_set("rep").alias("reps")).select(
        F.explode("reps").alias("a"), F.array_min("reps").alias("b")).where("a <> b")
