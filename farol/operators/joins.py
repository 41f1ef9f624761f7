"""Lookup joins that stay correct and balanced as either side grows."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farol.functions import rules

# A broadcast copy lives in every executor: at most this many narrow rows (about 20 MB).
BROADCAST_MAX_ROWS = 200_000
# A key holding more than this share of the rows is hot, so there are at most 1 / HOT_SHARE of them.
HOT_SHARE = 0.001
# A hot key's rows are cut into pieces of about this many; its dimension row is repeated once per piece.
PIECE_ROWS = 1_000
# Pieces are made in blocks, so no array grows with the rows of a key.
PIECE_BLOCK = 10_000
# Rows of one range of cells, at least and at most while there are no more than MAX_RANGES; a task sorts and writes one range.
MIN_RANGE_ROWS, RANGE_ROWS, MAX_RANGES = 50_000, 500_000, 2_000


def hot_keys(counts: DataFrame, keys: list[str], n: str = "n", piece_rows: int = PIECE_ROWS) -> DataFrame:
    """Keys above HOT_SHARE of all rows and the pieces each is cut into, from a table of rows per key."""
    total = counts.agg(F.sum(n)).scalar()
    return counts.where(F.col(n) > F.lit(HOT_SHARE) * total).dropna(subset=keys).select(
        *keys, F.ceil(F.col(n) / F.lit(piece_rows)).cast("bigint").alias("_pieces")
    )


def salted_left_join(
    fact: DataFrame, dim: DataFrame, keys: list[str], hot: DataFrame, spread_on: list[str],
) -> DataFrame:
    """Left join on unique ``keys`` of ``dim``, with hot keys cut into pieces and NULL keys spread over all tasks.

    Only hot dimension rows are repeated, once per piece; the hot list is
    bounded by HOT_SHARE, hence the broadcast. A NULL key finds nothing in any
    piece, so its rows need no counterpart.
    """
    marked = F.broadcast(hot)
    unknown = F.lit(False)
    for key in keys:
        unknown = unknown | F.col(key).isNull()
    spread = F.xxhash64(*spread_on)
    left = (
        fact.join(marked, keys, "left")
        .withColumn("_piece", F.when(unknown, spread).otherwise(F.pmod(spread, F.coalesce("_pieces", F.lit(1)))))
        .drop("_pieces")
    )
    last = F.coalesce("_pieces", F.lit(1).cast("bigint")) - 1
    start = F.col("_block") * PIECE_BLOCK
    right = (
        dim.join(marked, keys, "left")
        .withColumn("_block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor(last / PIECE_BLOCK))))
        .withColumn("_piece", F.explode(F.sequence(start, F.least(start + (PIECE_BLOCK - 1), last))))
        .drop("_pieces", "_block")
    )
    return left.join(right, [*keys, "_piece"], "left").drop("_piece")


def cell_ranges(counts: DataFrame, place: Column, n: str = "n") -> list[tuple[str, int, int]]:
    """Ascending ranges of cells with about as many rows each: least ``place``, first number, how many numbers.

    The driver gets one row per narrow range of the counted cells and puts
    neighbours together; a range that cannot be smaller has several numbers,
    among which its rows are dealt.
    """
    total = counts.agg(F.sum(n)).first()[0] or 0
    few = min(2 * counts.sparkSession.sparkContext.defaultParallelism, total // MIN_RANGE_ROWS)
    wanted = min(MAX_RANGES, max(1, few, -(-total // RANGE_ROWS)))
    narrow = (
        counts.select(place.alias("_place"), n).repartitionByRange(4 * wanted, "_place")
        .withColumn("_part", F.spark_partition_id())
        .groupBy("_part").agg(F.min("_place").alias("least"), F.sum(n).alias("rows"))
        .orderBy("_part").collect()
    )
    size, found = max(1, total / wanted), []
    for part in narrow:
        if found and found[-1][1] + part["rows"] <= size:
            found[-1][1] += part["rows"]
        else:
            found.append([part["least"], part["rows"]])
    ranges, first = [], 0
    for least, rows in found or [["", 0]]:
        pieces = max(1, round(rows / size))
        ranges.append((least, first, pieces))
        first += pieces
    return ranges


def _in_range(df: DataFrame, ranges: list[tuple[str, int, int]], place: Column) -> DataFrame:
    """``_first`` and ``_pieces`` of the range a row lies in, found in two steps of about the square root of the ranges."""
    least = ["", *[r[0] for r in ranges[1:]]]
    step = math.isqrt(len(least)) + 1
    blocks = [least[i:i + step] for i in range(0, len(least), step)]

    def up_to(starts: Column) -> Column:
        return F.size(F.filter(starts, lambda start: start <= F.col("_place")))

    return (
        df.withColumn("_place", place)
        .withColumn("_block", up_to(F.lit([block[0] for block in blocks])))
        .withColumn("_at", (F.col("_block") - 1) * step + up_to(F.element_at(F.lit(blocks), F.col("_block"))))
        .withColumns({
            "_first": F.element_at(F.lit([r[1] for r in ranges]), F.col("_at")),
            "_pieces": F.element_at(F.lit([r[2] for r in ranges]), F.col("_at")),
        })
        .drop("_place", "_block", "_at")
    )


def deal_rows(fact: DataFrame, ranges: list[tuple[str, int, int]], place: Column, spread_on: list[str]) -> DataFrame:
    """Rows of each range in one partition, ``_range``; those of a range with several numbers spread over them."""
    spread = F.pmod(F.xxhash64(*spread_on), F.col("_pieces").cast("bigint")).cast("int")
    dealt = _in_range(fact, ranges, place).withColumn("_range", F.col("_first") + spread).drop("_first", "_pieces")
    return dealt.repartitionById(ranges[-1][1] + ranges[-1][2], F.col("_range"))


def cell_join(
    dealt: DataFrame, dim: DataFrame, dim_rows: int, keys: list[str], ranges: list[tuple[str, int, int]], place: Column,
    max_rows: int = BROADCAST_MAX_ROWS,
) -> DataFrame:
    """Left join of dealt rows, which stay where they are, to a dimension where NULL keys are equal.

    A dimension beyond the bound is dealt by the same ranges; its rows are
    repeated only where a range has several numbers.
    """
    on, right = keys, dim
    if dim_rows <= max_rows:
        right = F.broadcast(dim)
    else:
        last = F.col("_first") + F.col("_pieces") - 1
        right = _in_range(dim, ranges, place).withColumn("_range", F.explode(F.sequence("_first", last)))
        on, right = [*keys, "_range"], right.drop("_first", "_pieces").repartitionById(ranges[-1][1] + ranges[-1][2], F.col("_range"))
    same = F.lit(True)
    for key in on:
        same = same & F.col(f"l.{key}").eqNullSafe(F.col(f"r.{key}")) if key != "_range" else same & (F.col("l._range") == F.col("r._range"))
    measures = [F.col(f"r.{c}") for c in dim.columns if c not in keys]
    return dealt.alias("l").join(right.alias("r"), same, "left").select("l.*", *measures).drop("_range")


def lookup_join(
    fact: DataFrame, dim: DataFrame, dim_rows: int, keys: list[str], spread_on: list[str],
    hot: DataFrame | None = None, max_rows: int = BROADCAST_MAX_ROWS,
) -> DataFrame:
    """Row-preserving left join to a dimension that is unique on ``keys``.

    ``dim_rows`` is the counted size. A dimension within the bound is
    broadcast and the fact rows do not move; a larger one is joined by shuffle
    with its hot keys salted.
    """
    if dim_rows <= max_rows:
        return fact.join(F.broadcast(dim), keys, "left")
    if hot is None:
        hot = hot_keys(fact.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")), keys)
    return salted_left_join(fact, dim, keys, hot, spread_on)


def rates_for_all_states(rates: DataFrame, states: DataFrame) -> DataFrame:
    """Every state, with a NULL rate where there is no data."""
    return states.select("uf").join(rates, "uf", "left")


def states_without_data(rates: DataFrame, states: DataFrame) -> DataFrame:
    """States no row refers to."""
    return states.select("uf").join(rates.select("uf"), "uf", "left_anti")


def common_keys(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Distinct keys found on both sides."""
    return left.select(key).distinct().join(right.select(key), key, "left_semi")


def key_match(left: DataFrame, right: DataFrame, key: str, name: str) -> DataFrame:
    """How many distinct keys of ``left`` exist in ``right``, with both key ranges."""
    a = left.where(F.col(key).isNotNull()).groupBy(key).agg(F.lit(1).alias("in_left"))
    b = right.where(F.col(key).isNotNull()).groupBy(key).agg(F.lit(1).alias("in_right"))
    both = a.join(b, key, "full")

    def side(c: str) -> list[Column]:
        mine = F.when(F.col(c) == 1, F.col(key))
        least, greatest = rules.key_range(mine)
        return [F.count(c).alias(f"{c}_keys"), least.alias(f"{c}_min"), greatest.alias(f"{c}_max")]

    matched = F.count(F.when(F.col("in_left").isNotNull() & F.col("in_right").isNotNull(), 1))
    return both.agg(*side("in_left"), *side("in_right"), matched.alias("matched")).select(
        F.lit(name).alias("pair"), "*",
        F.round(rules.share(F.col("matched"), F.col("in_left_keys")) * 100, 4).alias("match_pct"),
    )
