"""Splits, folds and samples decided by hashes of the group id (M1-M6)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from farol import constants as K
from farol.functions import rules
from farol.functions.hashing import below, hash_number

# Groups per deal of the stratified folds: bounds the rows one window task orders.
GROUPS_PER_DEAL = 100_000


def group_split(df: DataFrame, group: str = K.GROUP, share: float = K.TEST_SHARE) -> DataFrame:
    """M1: ``lado`` is the same for all rows of a group; no shuffle, stable on any cluster."""
    return df.withColumn("lado", F.when(below(hash_number("split", group), share), "teste").otherwise("treino"))


def train_rows(df: DataFrame) -> DataFrame:
    return group_split(df).where(F.col("lado") == "treino").drop("lado")


def test_rows(df: DataFrame) -> DataFrame:
    return group_split(df).where(F.col("lado") == "teste").drop("lado")


def group_subsample(df: DataFrame, budget: int = K.SEARCH_ROWS, group: str = K.GROUP) -> DataFrame:
    """M2: whole groups, about ``budget`` rows; everything when the table is smaller."""
    rows = df.agg(F.count(F.lit(1))).scalar()
    fraction = rules.share(F.lit(budget), rows)
    return df.where(below(hash_number("search", group), fraction))


def group_classes(df: DataFrame, label: str, group: str = K.GROUP) -> DataFrame:
    return df.groupBy(group).agg(
        F.count(F.when(F.col(label) == 0, 1)).alias("n0"), F.count(F.when(F.col(label) == 1, 1)).alias("n1")
    )


def dealt(df: DataFrame) -> DataFrame:
    """Rows to fit on, one part for each slot: the files of the mart differ in size, and the largest holds up every pass of a fit."""
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism, *df.columns)


def stratified_group_folds(df: DataFrame, label: str, k: int = K.SEARCH_FOLDS, group: str = K.GROUP) -> DataFrame:
    """M3: fold per group, class mix and size evened out.

    Groups are dealt like cards, there and back, in order of size and class
    mix. Hash-made deals of bounded size are ordered side by side, so no mix
    of classes, however common, ends up in one task.
    """
    groups = group_classes(df, label, group)
    total = groups.agg(F.count(F.lit(1))).scalar()
    deals = F.greatest(F.lit(1).cast("bigint"), F.ceil(total / F.lit(GROUPS_PER_DEAL)))
    placed = groups.withColumn("_h", hash_number("fold", group)).withColumn("_deal", F.col("_h") % deals)
    order = W.partitionBy("_deal").orderBy(F.desc(F.col("n0") + F.col("n1")), F.desc("n1"), "_h", group)
    turn = (F.row_number().over(order) - 1 + F.col("_deal")) % (2 * k)
    return placed.withColumn("_turn", turn).select(
        group, "n0", "n1",
        F.when(F.col("_turn") < k, F.col("_turn")).otherwise(2 * k - 1 - F.col("_turn")).cast("int").alias("fold"),
    )


def group_folds(df: DataFrame, k: int = K.AB_FOLDS, group: str = K.GROUP) -> DataFrame:
    """M4: fold by group hash, no shuffle."""
    return df.withColumn("fold", (hash_number("fold", group) % k).cast("int"))


def sample_rows(df: DataFrame, n: int, keys: list[str] | None = None) -> DataFrame:
    """M5: ``n`` rows without replacement; a distributed top-n by row hash.

    Rows equal in every key column are interchangeable, so ties do no harm.
    """
    keys = keys or df.columns
    return (
        df.withColumn("_h", hash_number("sample", *keys)).orderBy("_h", *keys).limit(n).drop("_h")
    )


def undersample(df: DataFrame, label: str, keys: list[str]) -> DataFrame:
    """M6: keep each class with the chance that brings it to the smallest class's size."""
    sizes = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    by_class = sizes.agg(F.map_from_entries(F.collect_list(F.struct(label, "n")))).scalar()
    smallest = sizes.agg(F.min("n")).scalar()
    fraction = rules.share(smallest, F.try_element_at(by_class, F.col(label)))
    return df.where(below(hash_number("undersample", *keys), fraction))
