"""Conversation prefix trie in balanced parentheses (operator 13).

A turn is named by 16 bytes of the SHA-256 of its role and text, a
conversation by the string of these names, its path. Equal paths are counted
first. The distinct paths are dealt in order over tasks and cut into shards;
in each a trie is written as balanced parentheses in order of depth first.
Where a parenthesis closes delimits its subtree, the number of leaf pairs
inside counts its leaves, and differences of running totals its members and
savings. All of a trie but its first and last path lies in one shard. Those
spines, with what hangs directly on them, are the paths of the next round,
until one shard holds them all.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farol.llm.common import staged
from farol.operators.joins import lookup_join

FAMILY = 20             # conversations that share the first turns of the first of them
HEADS = 4               # ... up to one less than this many turns
NAME = 16               # bytes of a turn's name
SHARD = 1 << 13         # turns after which a shard is closed
LEAST_PATHS = 16        # paths of a shard at least
FEW = 64                # paths of a task at least; so few make one shard at once
CHUNK = 1 << 16         # conversation ids packed into one row
BLOCK = 64              # parentheses whose least excess is kept
_FAR = np.iinfo(np.int64).max


class Parentheses:
    """Balanced parentheses with the least excess of each block and of each pair of blocks, and so on."""

    def __init__(self, opens: np.ndarray):
        self.opens = opens
        self.excess = np.cumsum(np.where(opens, 1, -1))
        blocks = 1 << max(0, (-(-len(opens) // BLOCK) - 1).bit_length())
        padded = np.full(blocks * BLOCK, _FAR)
        padded[: len(opens)] = self.excess
        self.padded, self.blocks = padded, blocks
        least = padded.reshape(-1, BLOCK).min(1)
        self.tree = np.full(2 * blocks, _FAR)
        self.tree[blocks:] = least
        for node in range(blocks - 1, 0, -1):
            self.tree[node] = min(self.tree[2 * node], self.tree[2 * node + 1])
        leaf = np.zeros(len(opens) + 1, np.int64)
        leaf[1:-1] = opens[:-1] & ~opens[1:]
        self.leaf_rank = np.cumsum(leaf)

    def _first(self, at: np.ndarray, stop: np.ndarray, least: np.ndarray) -> np.ndarray:
        """First position of [at, stop) with an excess of at most ``least``; -1 where there is none."""
        found, open_ = np.full(len(at), -1), np.arange(len(at))
        at = at.copy()
        while len(open_):
            open_ = open_[at[open_] < stop[open_]]
            hit = self.padded[at[open_]] <= least[open_]
            found[open_[hit]] = at[open_[hit]]
            open_ = open_[~hit]
            at[open_] += 1
        return found

    def close(self, at: np.ndarray) -> np.ndarray:
        """Where each opening parenthesis closes."""
        least = self.excess[at] - 1
        block = at // BLOCK
        found = self._first(at + 1, (block + 1) * BLOCK, least)
        left = np.flatnonzero(found < 0)
        if not len(left):
            return found
        node, want = block[left] + self.blocks, least[left]
        up = np.ones(len(left), bool)
        while up.any():  # to the next right neighbour that comes low enough
            hit = up & (node % 2 == 0) & (self.tree[np.minimum(node + 1, 2 * self.blocks - 1)] <= want)
            node = np.where(hit, node + 1, np.where(up, node // 2, node))
            up &= ~hit
        while (node < self.blocks).any():
            node = np.where(node < self.blocks, np.where(self.tree[2 * node % len(self.tree)] <= want, 2 * node, 2 * node + 1), node)
        start = (node - self.blocks) * BLOCK
        found[left] = self._first(start, start + BLOCK, want)
        return found

    def leaves(self, at: np.ndarray, close: np.ndarray) -> np.ndarray:
        """Leaf pairs from an opening parenthesis to the one that closes it."""
        return self.leaf_rank[close] - self.leaf_rank[at]


# One row per path. ``at`` names the depths (the root's is 0) that carry something, in order, and the arrays after it hold what:
# members and least member that hang there, closed children, leaves and savings below them, and the digest of the ids that end there.
PATHS = "path binary, words array<long>, at array<int>, n array<long>, low array<long>, children array<long>, leaves array<long>, saved array<long>, ends array<string>"
NODES = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string, name binary, parent binary"
_NO_ENDS = hashlib.sha256(b"").hexdigest()


class Shard:
    """The trie of some paths in order."""

    def __init__(self, rows: list[dict]):
        parent, depth, words, last, opens = [-1], [0], [0], [0], [True]
        hung = []  # (node, row, place in its arrays)
        before = b""
        stack = [0]
        self.first_path: list[int] = []
        name_of = [b""]
        for row in rows:
            path = row["path"]
            size, same = len(path) // NAME, _common(before, path)
            opens += [False] * (len(stack) - 1 - same)
            del stack[same + 1 :]
            for d in range(same, size):
                stack.append(len(parent))
                parent.append(stack[d])
                depth.append(d + 1)
                words.append(row["words"][d])
                name_of.append(path)
                opens.append(True)
            hung += [(stack[d], row, k) for k, d in enumerate(row["at"])]
            before = path
            self.first_path = self.first_path or list(stack)
        opens += [False] * len(stack)
        self.last_path = list(stack)
        self.parent, self.depth, self.words = np.array(parent), np.array(depth), np.array(words, np.int64)
        self.path_of, self.names = name_of, {0: b""}
        n = len(parent)
        self.own = {c: np.zeros(n, np.int64) for c in ("n", "children", "leaves", "saved")}
        self.low = np.full(n, _FAR)
        self.ends = [_NO_ENDS] * n
        for node, row, k in hung:
            for c, values in self.own.items():
                values[node] += row[c][k]
            if row["low"][k] is not None:
                self.low[node] = min(self.low[node], row["low"][k])
            if row["ends"][k] != _NO_ENDS:
                self.ends[node] = row["ends"][k]
        opens = np.array(opens)
        trie = Parentheses(opens)
        at = np.flatnonzero(opens)
        close = trie.close(at)
        self.size = (close - at + 1) // 2
        self.trie_children = np.bincount(self.parent[1:], minlength=n)
        self.leaf = (self.trie_children == 0) & (self.own["children"] == 0)
        # A leaf pair that carries closed children from an earlier round is no leaf.
        hidden = self._below((self.trie_children == 0) & ~self.leaf)
        self.n = self._below(self.own["n"])
        self.leaves = trie.leaves(at, close) - hidden + self._below(self.own["leaves"])
        for d in range(int(self.depth.max()), 0, -1):
            level = self._of_depth(d)
            np.minimum.at(self.low, self.parent[level], self.low[level])

    def _of_depth(self, d: int) -> np.ndarray:
        if not hasattr(self, "_order"):
            self._order = np.argsort(self.depth, kind="stable")
            self._starts = np.searchsorted(self.depth[self._order], np.arange(int(self.depth.max()) + 2))
        return self._order[self._starts[d] : self._starts[d + 1]]

    def _below(self, own: np.ndarray) -> np.ndarray:
        """Sums over subtrees: differences of running totals."""
        total = np.concatenate([[0], np.cumsum(own)])
        here = np.arange(len(own))
        return total[here + self.size] - total[here]

    def _name(self, node: int) -> bytes:
        """SHA-256 of the parent's name and the last turn's, so that a path costs one digest a turn."""
        way = []
        while node not in self.names:
            way.append(node)
            node = int(self.parent[node])
        name = self.names[node]
        for k in reversed(way):
            end = NAME * int(self.depth[k])
            name = self.names[k] = hashlib.sha256(name + self.path_of[k][end - NAME : end]).digest()
        return name

    def results(self, open_: bool, named: bool) -> tuple[list[tuple], list[dict]]:
        """(rows of closed nodes, paths for the next round); nothing stays open where ``open_`` is false.

        Rows of later rounds, all open once, are ``named`` for what hangs on them.
        """
        spine = np.zeros(len(self.parent), bool)
        if open_:
            spine[self.first_path] = spine[self.last_path] = True
        gain = np.where(spine, 0, (self.n - 1) * self.words)
        saved = self._below(self.own["saved"] + gain)
        children = self.trie_children + self.own["children"]
        rows = []
        for k in np.flatnonzero(~spine).tolist():
            p = int(self.parent[k])
            loose = p >= 0 and bool(spine[p])
            rows.append((int(self.low[k]), int(self.depth[k]), None if loose or p < 0 else int(self.low[p]), int(self.n[k]), int(children[k]),
                         int(self.leaves[k]), int(saved[k]), self.ends[k],
                         self._name(k) if named else None, self._name(p) if loose else None))
        return rows, self._spines(spine, saved) if open_ else []

    def _spines(self, spine: np.ndarray, saved: np.ndarray) -> list[dict]:
        """What hangs directly on the nodes of the first and the last path."""
        nodes = np.flatnonzero(spine)
        # Of the leaves below, those of open leaves are not known yet.
        told = self.leaves - self._below(spine & self.leaf)
        hang = {"n": self.n.copy(), "leaves": told.copy(), "saved": saved.copy()}
        inner = nodes[nodes > 0]
        for c, whole in (("n", self.n), ("leaves", told), ("saved", saved)):
            np.subtract.at(hang[c], self.parent[inner], whole[inner])
        closed = self.own["children"] + self.trie_children
        np.subtract.at(closed, self.parent[inner], 1)
        given, out = set(), []
        for path in (self.first_path, self.last_path):
            fresh = [(d, k) for d, k in enumerate(path) if k not in given]
            given.update(path)
            end = path[-1]
            out.append({
                "path": self.path_of[end][: NAME * (len(path) - 1)], "words": self.words[path[1:]].tolist(), "at": [d for d, _ in fresh],
                "n": [int(hang["n"][k]) for _, k in fresh], "low": [int(self.low[k]) for _, k in fresh],
                "children": [int(closed[k]) for _, k in fresh], "leaves": [int(hang["leaves"][k]) for _, k in fresh],
                "saved": [int(hang["saved"][k]) for _, k in fresh], "ends": [self.ends[k] for _, k in fresh]})
        return out if out[1]["at"] else out[:1]


def _common(a: bytes, b: bytes) -> int:
    """Turns at the start of both paths."""
    n = min(len(a), len(b)) // NAME
    if a[: n * NAME] == b[: n * NAME]:
        return n
    low, high = 0, n  # equal up to low turns, not up to high
    while high - low > 1:
        mid = (low + high) // 2
        if a[low * NAME : mid * NAME] == b[low * NAME : mid * NAME]:
            low = mid
        else:
            high = mid
    return low


_NODE_SCHEMA = [pa.int64()] * 7 + [pa.string(), pa.binary(), pa.binary()]
_PATH_SCHEMA = [pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int32())] + [pa.list_(pa.int64())] * 5 + [pa.list_(pa.string())]
_NODE_NAMES = [c.split()[0] for c in NODES.split(", ")]
_PATH_NAMES = [c.split()[0] for c in PATHS.split(", ")]


def _grown(last: bool, named: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes and, beside them, the paths that stay open; rows come in the order of their paths."""
    def flush() -> Iterator[pa.RecordBatch]:
        rows, spines = Shard(held).results(not last, named)
        for start in range(0, max(len(rows), 1), 50_000):
            part = rows[start : start + 50_000]
            more = spines if not start else []
            nodes = [pa.array([r[i] for r in part] + [None] * len(more), t) for i, t in enumerate(_NODE_SCHEMA)]
            paths = [pa.array([None] * len(part) + [s[c] for s in more], t) for c, t in zip(_PATH_NAMES, _PATH_SCHEMA, strict=True)]
            yield pa.RecordBatch.from_arrays(nodes + paths, names=_NODE_NAMES + _PATH_NAMES)

    held, size = [], 0
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            for row in batch.slice(at, 512).to_pylist():
                held.append(row)
                size += len(row["path"]) // NAME + 1
                if not last and size >= SHARD and len(held) >= LEAST_PATHS:
                    yield from flush()
                    held, size = [], 0
    if held:
        yield from flush()


def turn_name() -> Column:
    """16 bytes of the SHA-256 of role and text; the length of the role parts them."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    return F.unhex(F.substring(F.sha2(F.concat_ws(":", F.length(role).cast("string"), role, text), 256), 1, 2 * NAME))


def rebuilt(conversations: DataFrame) -> DataFrame:
    """conv_id, path and words of each conversation after its first turns were replaced."""
    turns = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), turn_name().alias("name"),
        F.regexp_count(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"),
    ).where("conv_id is not null")
    # Structs order NULL turns first and settle ties by the turn's name.
    own = staged(turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "name", "words"))).alias("turns")), "turns")
    lead = F.col("conv_id") - F.col("conv_id") % FAMILY
    family = own.where(F.col("conv_id") % FAMILY == 0).select(
        F.explode(F.sequence(F.col("conv_id") - (FAMILY - 1), F.col("conv_id") + (FAMILY - 1))).alias("conv_id"),
        F.col("conv_id").alias("lead"), F.slice("turns", 1, HEADS - 1).alias("heads"))
    heads = family.where(lead == F.col("lead")).select("conv_id", "heads")
    h = (F.crc32(F.col("conv_id").cast("string")) % HEADS).cast("int")
    none = F.filter("turns", lambda _: F.lit(False))
    whole = F.concat(F.slice(F.coalesce("heads", none), F.lit(1), h), F.slice(F.col("turns"), h + 1, F.greatest(F.size("turns"), F.lit(1))))
    return own.join(heads, "conv_id", "left").select("conv_id", whole.alias("turns")).select(
        "conv_id", F.col("turns.name").alias("names"), F.col("turns.words").alias("words"))


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            part = batch.slice(at, 512)
            paths = [b"".join(names) for names in part.column("names").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([hashlib.sha256(p).digest() for p in paths], pa.binary()), part.column("conv_id"), pa.array(paths, pa.binary()),
                 part.column("words")], names=["name", "conv_id", "path", "words"])


MEMBERS = "name binary, first long, n long, ids binary, path binary, words array<long>"


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of members of one path, at most CHUNK ids each; rows come ordered by path and id."""
    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([held[0][0]], pa.binary()), pa.array([held[1][0]], pa.int64()), pa.array([len(held[1])], pa.int64()),
             pa.array([",".join(map(str, held[1])).encode()], pa.binary()), pa.array([held[0][1]], pa.binary()),
             pa.array([held[0][2]], pa.list_(pa.int64()))], names=["name", "first", "n", "ids", "path", "words"])

    held: tuple = ((None,), [])
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            for r in batch.slice(at, 512).to_pylist():
                if held[1] and (r["name"] != held[0][0] or len(held[1]) >= CHUNK):
                    yield row()
                    held = ((None,), [])
                if not held[1]:
                    held = ((r["name"], r["path"], r["words"]), [])
                held[1].append(r["conv_id"])
    if held[1]:
        yield row()


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per path; rows come ordered by path and first id, and ids pass through the digest one chunk at a time."""
    def rows() -> Iterator[dict]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                yield from batch.slice(at, 64).to_pylist()

    out: list[dict] = []

    def flush() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([o[c] for o in out], t) for c, t in zip(_PATH_NAMES, _PATH_SCHEMA, strict=True)], names=_PATH_NAMES)

    for _, chunks in groupby(rows(), key=lambda r: r["name"]):
        first = next(chunks)
        digest, n = hashlib.sha256(first["ids"]), first["n"]
        for chunk in chunks:
            digest.update(b",")
            digest.update(chunk["ids"])
            n += chunk["n"]
        out.append({"path": first["path"], "words": first["words"], "at": [len(first["path"]) // NAME], "n": [n], "low": [first["first"]],
                    "children": [0], "leaves": [0], "saved": [0], "ends": [digest.hexdigest()]})
        if len(out) >= 512:
            yield flush()
            out = []
    if out:
        yield flush()


def distinct_paths(whole: DataFrame) -> DataFrame:
    """A row per distinct path with its members' number, least and digest; members of a frequent path are packed in many tasks."""
    named = staged(whole.mapInArrow(_joined, "name binary, conv_id long, path binary, words array<long>"), "rebuilt")
    packed = named.repartitionByRange("name", "conv_id").sortWithinPartitions("name", "conv_id").mapInArrow(_chunks, MEMBERS)
    return staged(packed.repartition("name").sortWithinPartitions("name", "first").mapInArrow(_digested, PATHS), "paths")


def trie(conversations: DataFrame) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    NULL role and text are empty; NULL turns come first, and turns of equal
    number are ordered by their names, so a repeated row is a turn of its own.
    Rows without a conv_id belong to no conversation. Other columns are
    ignored. Without conversations there is no node, not even a root. The
    turns of one conversation travel as one row of some 24 bytes a turn.
    """
    paths, nodes = distinct_paths(rebuilt(conversations)), []
    most = int(conversations.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    while True:
        n, size = paths.agg(F.count(F.lit(1)), F.sum(F.size("words") + 1)).first()
        last = n <= FEW or size <= SHARD
        # Tasks of some shards each, of FEW paths at least, so that every round leaves a fraction of the paths.
        ordered = paths.coalesce(1) if last else paths.repartitionByRange(min(1 + size // SHARD, 1 + n // FEW, most), "path")
        named = bool(nodes)
        grown = staged(ordered.sortWithinPartitions("path").mapInArrow(
            lambda b, last=last, named=named: _grown(last, named, b), f"{NODES}, {PATHS}"), "trie")
        nodes.append(grown.where("depth is not null").select(*_NODE_NAMES))
        if last:
            break
        paths = grown.where("path is not null").select(*_PATH_NAMES)
    found = reduce(DataFrame.unionByName, nodes)
    if len(nodes) > 1:
        # What hangs on a spine learns its parent's least member now that it is known.
        spines = reduce(DataFrame.unionByName, nodes[1:]).select(F.col("name").alias("parent"), F.col("conv_id").alias("above"))
        found = lookup_join(found, spines, spines.count(), ["parent"], ["conv_id", "depth"])
        found = found.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "above"))
    return found.select(*_NODE_NAMES[:8])
