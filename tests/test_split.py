import pytest
from pyspark.sql import functions as F

from farol.operators import joins, prepare, split


@pytest.fixture(scope="module")
def rows(spark):
    """5,000 students with one to three rows each; one student holds a third of everything."""
    usual = spark.range(5000).select(
        F.concat(F.lit("s"), "id").alias("id_aluno"), F.explode(F.sequence(F.lit(1), 1 + F.col("id") % 3)).alias("k")
    )
    heavy = spark.range(5000).select(F.lit("heavy").alias("id_aluno"), F.col("id").alias("k"))
    return usual.select("id_aluno", F.col("k").cast("bigint").alias("k")).unionByName(heavy).withColumn(
        "label", (F.xxhash64("id_aluno", "k") % 10 < 5).cast("int")
    ).cache()


def test_split_keeps_students_whole(rows):
    train, test = split.train_rows(rows), split.test_rows(rows)
    assert train.count() + test.count() == rows.count()
    assert joins.common_keys(train, test, "id_aluno").count() == 0
    share = test.select("id_aluno").distinct().count() / 5001
    assert abs(share - 0.2) < 0.03


def test_subsample_keeps_groups_whole_and_is_a_no_op_when_small(rows):
    usual = rows.where(F.col("id_aluno") != "heavy")
    some = split.group_subsample(usual, 2000)
    kept = some.groupBy("id_aluno").agg(F.count("*").alias("n"))
    whole = usual.groupBy("id_aluno").agg(F.count("*").alias("m"))
    assert kept.join(whole, "id_aluno").where("n <> m").count() == 0
    assert 1700 < some.count() < 2300
    assert split.group_subsample(usual, 10**9).count() == usual.count()


def test_stratified_folds_are_even_and_grouped(rows):
    usual = rows.where(F.col("id_aluno") != "heavy")
    folds = split.stratified_group_folds(usual, "label", 3)
    assert folds.count() == folds.select("id_aluno").distinct().count() == 5000
    sums = folds.groupBy("fold").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).collect()
    assert {r["fold"] for r in sums} == {0, 1, 2}
    size = [r["n0"] + r["n1"] for r in sums]
    mix = [r["n1"] / (r["n0"] + r["n1"]) for r in sums]
    assert max(size) - min(size) <= 6 and max(mix) - min(mix) < 0.01


def test_folds_use_every_deal(rows, monkeypatch):
    usual = rows.where(F.col("id_aluno") != "heavy")
    monkeypatch.setattr(split, "GROUPS_PER_DEAL", 100)
    folds = split.stratified_group_folds(usual, "label", 3)
    assert folds.count() == 5000
    sizes = [r["n"] for r in folds.groupBy("fold").agg(F.sum(F.col("n0") + F.col("n1")).alias("n")).collect()]
    assert max(sizes) - min(sizes) < 0.03 * sum(sizes)


def test_group_folds_keep_students_whole(rows):
    folds = split.group_folds(rows, 3)
    assert folds.groupBy("id_aluno").agg(F.countDistinct("fold").alias("f")).where("f > 1").count() == 0


def test_sample_has_the_size_asked_for(rows):
    got = split.sample_rows(rows, 250)
    assert got.count() == 250 and sorted(map(tuple, got.collect())) == sorted(map(tuple, split.sample_rows(rows.repartition(3), 250).collect()))


def test_undersample_evens_the_classes(spark):
    df = spark.range(20_000).select("id", (F.col("id") % 5 == 0).cast("int").alias("label"))
    n = {r["label"]: r["count"] for r in split.undersample(df, "label", ["id"]).groupBy("label").count().collect()}
    assert n[1] == 4000 and abs(n[0] - 4000) < 300


def test_mode_takes_the_smallest_on_a_tie(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("a",), ("b",)], "x string")
    assert prepare.modes(df, ["x"]).first()["moda"] == "a"
    assert [r["x"] for r in prepare.mode_impute(df, ["x"]).collect()] == ["b", "a", "a", "a", "b"]


def test_median_fill_uses_the_fitted_rows(spark):
    train = spark.createDataFrame([(1.0,), (2.0,), (10.0,), (None,)], "x double")
    test = spark.createDataFrame([(None,), (7.0,)], "x double")
    assert [r["x"] for r in prepare.median_impute(test, ["x"], train).collect()] == [2.0, 7.0]


def test_standardise_constant_is_zero(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, k double")
    assert [(r["a_z"], r["k_z"]) for r in prepare.standardise(df, ["a", "k"]).orderBy("a").collect()] == [(-1.0, 0.0), (1.0, 0.0)]


def test_target_encoding_excludes_the_own_fold(spark):
    df = spark.createDataFrame(
        [("a", 0, 1), ("a", 1, 0), ("a", 1, 0), ("b", 0, 1), ("b", 0, 0)], "k string, fold int, label int"
    )
    got = {(r["k"], r["fold"]): r["codificado"] for r in prepare.target_encoding(df, "k").collect()}
    # b is seen in fold 0 only: its value is the mean of the other folds, which hold two zeros.
    assert got == {("a", 0): 0.0, ("a", 1): 1.0, ("b", 0): 0.0}
