"""Best-fit packing with conflicts (operator 8).

Documents are dealt by a hash of the id into blocks of bounded size. Inside a
block, longest first, each piece goes to the tightest open bin that holds
neither its source nor its duplicate cluster. Bins are ordered by what is left
in them and carry both sets as bitmaps; a tree over the residuals keeps the
bits that all bins below share, so the successor search skips whole ranges
that cannot take the piece and goes on until a compatible bin is found.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farol.llm.common import SPACE

CAPACITY = 2048      # tokens of a bin
BLOCK_DOCS = 1000    # documents of a block, on average


class Bins:
    """Open bins by residual; ``tree`` holds the conjunction of the bitmaps below each node, -1 where none."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.tree = [-1] * (2 * self.size)
        self.at: list[list[list[int]]] = [[] for _ in range(self.size)]

    def _refresh(self, residual: int) -> None:
        node, both = residual + self.size, -1
        for _, bits in self.at[residual]:
            both &= bits
        self.tree[node] = both
        node >>= 1
        while node:
            both = self.tree[2 * node] & self.tree[2 * node + 1]
            if self.tree[node] == both:
                break
            self.tree[node] = both
            node >>= 1

    def add(self, residual: int, number: int, bits: int) -> None:
        self.at[residual].append([number, bits])
        self._refresh(residual)

    def take(self, need: int, mask: int) -> tuple[int, int, int] | None:
        """Remove and return (residual, number, bits) of the tightest bin with room and without a bit of ``mask``."""
        residual = need
        while (residual := self._successor(residual, mask)) is not None:
            for i, (number, bits) in enumerate(self.at[residual]):
                if not bits & mask:
                    del self.at[residual][i]
                    self._refresh(residual)
                    return residual, number, bits
            residual += 1
        return None

    def _successor(self, low: int, mask: int) -> int | None:
        """Smallest residual from ``low`` whose bins may take the mask: not all of them share a bit of it."""
        if low >= self.size:
            return None
        node = low + self.size
        while self.tree[node] & mask:
            while node & 1:
                node >>= 1
                if not node:
                    return None
            node += 1
            while not self.tree[node] & mask and node < self.size:
                node *= 2
        return node - self.size


def pack_block(items: list[tuple], capacity: int) -> list[tuple[int, int]]:
    """(bin, offset) of each (length, source, cluster) item; longest first, then in the given order."""
    bins, spots = Bins(capacity), [(0, 0)] * len(items)
    bit: dict[tuple, int] = {}
    made = 0  # bit 0 of a mask is set in empty nodes only, so a search without conflicts skips those too
    for i in sorted(range(len(items)), key=lambda i: (-items[i][0], i)):
        length, source, cluster = items[i]
        mask = 1
        for key in ((0, source), (1, cluster)):
            if key[1] is not None:
                mask |= 2 << bit.setdefault(key, len(bit))
        found = bins.take(length, mask)
        if found is None:
            residual, number, bits = capacity, made, 0
            made += 1
        else:
            residual, number, bits = found
        spots[i] = (number, capacity - residual)
        bins.add(residual - length, number, bits | (mask & ~1))
    return spots


def pack(
    docs: DataFrame, length: str, source: str | None = "source", cluster: str | None = "cluster",
    capacity: int = CAPACITY, block_docs: int = BLOCK_DOCS,
) -> DataFrame:
    """Bin and offset of every piece of every document.

    A text longer than a bin is cut into full pieces and a rest, each placed
    by itself; a NULL or negative length counts as 0 and still gets a place.
    No bin holds two pieces of one source or of one cluster; NULL source or
    cluster conflicts with nothing. Ties go to the smaller id. Rows that
    repeat an id are packed each. Columns: doc_id, piece, block, bin, start
    (in the bin), n_tokens. A bin is named by (block, bin).
    """
    blocks = max(1, -(-docs.count() // block_docs))
    size = F.greatest(F.coalesce(F.col(length).cast("long"), F.lit(0)), F.lit(0))
    parts = (
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"), size.alias("size"),
            (F.col(source).cast("string") if source else F.lit(None).cast("string")).alias("source"),
            (F.col(cluster).cast("string") if cluster else F.lit(None).cast("string")).alias("cluster"),
            F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit("block")), F.lit(blocks)).alias("block"),
        )
        .withColumn("piece", F.explode(F.sequence(F.lit(0), F.greatest(F.ceil(F.col("size") / capacity) - 1, F.lit(0)).cast("long"))))
        .withColumn("n_tokens", F.least(F.lit(capacity), F.col("size") - F.col("piece") * capacity))
    )

    def place(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["doc_id", "piece", "source", "cluster", "n_tokens"], na_position="last", kind="stable")
        values = [(int(n), None if pd.isna(s) else s, None if pd.isna(c) else c)
                  for n, s, c in zip(group["n_tokens"], group["source"], group["cluster"], strict=True)]
        spots = pack_block(values, capacity)
        return group[["doc_id", "piece", "block"]].assign(
            bin=[b for b, _ in spots], start=[s for _, s in spots], n_tokens=group["n_tokens"])

    return parts.drop("size").groupBy("block").applyInPandas(
        place, "doc_id long, piece long, block long, bin long, start long, n_tokens long")


def word_length(text: str = "text"):
    """Words of a text and one end mark, counted without moving or splitting it."""
    bare = F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"[^\x20\x09-\x0D]+", "w")
    return (F.length(F.regexp_replace(bare, f"{SPACE}+", "")) + 1).cast("long")

