"""Global order without a global task: exact quantiles, running totals and row numbers.

A window with no partition key pulls every row into one task. Here the order
is cut into ranges of nearly equal size, each range is ordered on its own, and
the range totals (a few hundred rows) carry the offsets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from farol.operators.joins import BROADCAST_MAX_ROWS
from farol.sources.sinks import stage

RANGES = 256


def with_range(
    counts: DataFrame, value: str, weight: Column, series: list[str] | None = None, ranges: int = RANGES,
) -> DataFrame:
    """Add ``_range``, a number that never falls as ``value`` grows.

    The cut points come from an approximate quantile sketch over the distinct
    values. They only decide how evenly work is spread: any rising cut points
    give the same results. ``weight`` (rows behind a value) keeps the sketch
    reading the same columns as its caller, so both share one shuffle.
    """
    cuts = [i / ranges for i in range(1, ranges)]
    sketch = F.percentile_approx(F.when(weight > 0, F.col(value)), cuts, 20 * ranges).alias("_cuts")
    if series:
        # One row per series, and a series is a profiled column: bounded by the schema.
        placed = counts.join(F.broadcast(counts.groupBy(*series).agg(sketch)), series)
    else:
        placed = counts.withColumn("_cuts", counts.agg(sketch).scalar())
    return placed.withColumn("_range", F.expr(f"size(filter(_cuts, c -> c < `{value}`))")).drop("_cuts")


def exact_quantiles(
    df: DataFrame, columns: list[str], probs: dict[str, float], by: list[str] | None = None,
    ranges: int = RANGES,
) -> DataFrame:
    """Exact linear-interpolated quantiles per column (and group), NULLs excluded.

    Equal values are counted before the shuffle, so a value held by a third of
    the rows is one row afterwards.
    """
    by = by or []
    keys = [*by, "variavel"]
    counts = (
        df.select(*by, *[F.col(c).cast("double").alias(c) for c in columns])
        .unpivot(by, columns, "variavel", "valor")
        .where(F.col("valor").isNotNull() & ~F.isnan("valor"))
        .groupBy(*keys, "valor").agg(F.count(F.lit(1)).alias("_n"))
    )
    placed = with_range(counts, "valor", F.col("_n"), ["variavel"], ranges)
    inside = W.partitionBy(*keys, "_range").orderBy("valor")
    running = placed.withColumn("_upto", F.sum("_n").over(inside))
    across = W.partitionBy(*keys).orderBy("_range")
    totals = placed.groupBy(*keys, "_range").agg(F.sum("_n").alias("_size"))
    offsets = totals.select(
        *keys, "_range",
        (F.sum("_size").over(across) - F.col("_size")).alias("_before"),
        F.sum("_size").over(W.partitionBy(*keys)).alias("n"),
    )
    placed = running.join(offsets, [*keys, "_range"]).withColumns({
        "_first": F.col("_before") + F.col("_upto") - F.col("_n"),
        "_last": F.col("_before") + F.col("_upto") - 1,
    })

    def at(rank: Column) -> Column:
        return F.max(F.when((F.col("_first") <= rank) & (rank <= F.col("_last")), F.col("valor")))

    ends, exprs = [], []
    for name, p in probs.items():
        spot = F.lit(float(p)) * (F.col("n") - 1).cast("double")
        ends += [at(F.floor(spot)).alias(f"_lo_{name}"), at(F.ceil(spot)).alias(f"_hi_{name}")]
        low, high = F.col(f"_lo_{name}"), F.col(f"_hi_{name}")
        exprs.append((low + (high - low) * (spot - F.floor(spot))).alias(name))
    return placed.groupBy(*keys).agg(F.max("n").alias("n"), *ends).select(*keys, "n", *exprs)


def number_rows(
    df: DataFrame, order: list[Column], name: str, rows: int | None = None, max_rows: int = BROADCAST_MAX_ROWS,
) -> DataFrame:
    """Row numbers 1..n in a total order.

    A counted small table is numbered by one window. Anything else is range
    sorted and written, so that sort positions and partition offsets describe
    the same layout even when tasks are retried.
    """
    if rows is not None and rows <= max_rows:
        return df.withColumn(name, F.row_number().over(W.orderBy(*order)).cast("bigint"))
    placed, _ = stage(df.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()), "ordered")
    placed = placed.withColumns({
        "_part": F.shiftright("_at", 33), "_pos": F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)),
    })
    # One row per partition of the sort.
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    offsets = sizes.select("_part", (F.sum("_n").over(W.orderBy("_part")) - F.col("_n")).alias("_before"))
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_before") + F.col("_pos") + 1)
        .drop("_at", "_part", "_pos", "_before")
    )
