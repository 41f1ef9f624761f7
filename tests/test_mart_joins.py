"""The shuffled way to the mart: same rows, and student rows that move only while narrow."""

import re

from pyspark.sql import functions as F
from test_plans import plan_of

from farol.operators import joins as J
from farol.plans import mart as M
from farol.sources import star as S
from farol.sources.star import Star


def same_rows(left, right):
    # Means of doubles depend on the order of the rows in their last bits.
    a, b = (df.select(*[F.round(c, 6).alias(c) if t == "double" else c for c, t in df.dtypes]) for df in (left, right))
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


class Holes:
    """Views whose students lack a network, and whose networks are many NULLs in one municipality."""

    def __init__(self, star):
        self.star = star

    def __getattr__(self, name):
        return getattr(self.star, name)

    @property
    def students(self):
        return self.star.students.withColumn("rede", F.when(F.col("id_aluno").cast("bigint") % 3 > 0, F.col("rede")))


def test_shuffled_mart_moves_student_rows_twice(spark, base):
    # Line items meet orders in one more join of their own.
    plan = plan_of(M.build_mart(Star(spark, base), max_rows=0))
    assert plan.count("SortMergeJoin") <= 3


def test_shuffled_mart_equals_broadcast_mart(spark, base):
    for silver in (Star(spark, base), Holes(Star(spark, base))):
        assert same_rows(M.build_mart(silver, max_rows=0), M.build_mart(silver))


def test_kept_views_are_the_same_and_read_one_table(spark, base, monkeypatch):
    plain = Star(spark, base)
    monkeypatch.setattr(S, "SPLIT_BYTES", 0)
    kept = Star(spark, base).kept()
    for name in ("students", "census", "indicators"):
        assert same_rows(getattr(kept, name), getattr(plain, name))
        assert "Join" not in plan_of(getattr(kept, name))


def test_mart_rows_are_dealt_while_they_are_narrow(spark, base, monkeypatch):
    monkeypatch.setattr(J, "MIN_RANGE_ROWS", 200)
    mart = M.build_mart(Star(spark, base), max_rows=0)
    # What is written is joined after the last shuffle, whose partitions are ranges of the stored order.
    assert "Join" in plan_of(mart).split("Exchange")[0]
    place = F.struct("ano", "id_municipio", "rede")
    parts = mart.groupBy(F.spark_partition_id().alias("p")).agg(F.min(place).alias("a"), F.max(place).alias("z"))
    ranges = [(r["a"], r["z"]) for r in parts.orderBy("a").collect()]
    assert len(ranges) > 3 and all(before[1] <= after[0] for before, after in zip(ranges, ranges[1:]))


def test_small_ranges_give_the_same_mart(spark, base, monkeypatch):
    monkeypatch.setattr(J, "MIN_RANGE_ROWS", 20)
    monkeypatch.setattr(J, "RANGE_ROWS", 40)
    for silver in (Star(spark, base), Holes(Star(spark, base))):
        assert same_rows(M.build_mart(silver, max_rows=0), M.build_mart(silver))


def test_a_range_that_is_one_heavy_cell_has_several_numbers(spark, monkeypatch):
    monkeypatch.setattr(J, "MIN_RANGE_ROWS", 10)
    monkeypatch.setattr(J, "RANGE_ROWS", 100)
    sizes = {f"{i:03}": 700 if i == 30 else 10 for i in range(100)}
    counts = spark.createDataFrame(list(sizes.items()), "k string, n bigint")
    ranges = J.cell_ranges(counts, F.col("k"))
    assert [r[1] for r in ranges] == [sum(r[2] for r in ranges[:i]) for i in range(len(ranges))]
    for row in J._in_range(counts, ranges, F.col("k")).collect():
        # The least start at or before the key, by search over all of them.
        at = max(0, sum(r[0] <= row["k"] for r in ranges) - 1)
        assert (row["_first"], row["_pieces"]) == ranges[at][1:]
        assert row["_pieces"] >= 4 or row["k"] != "030"
    rows = counts.withColumn("x", F.explode(F.sequence(F.lit(1).cast("bigint"), "n")))
    dealt = J.deal_rows(rows, ranges, F.col("k"), ["x"])
    assert dealt.groupBy("_range").count().agg(F.max("count")).first()[0] < 350
    assert dealt.where(F.col("_range") != F.spark_partition_id()).count() == 0
