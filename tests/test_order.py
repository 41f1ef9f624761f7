"""Global order operators against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from farol.operators import metrics, profile
from farol.operators.order import exact_quantiles, number_rows, with_range


def brute_auc(labels, scores):
    pairs = [(a, b) for a, x in zip(scores, labels) if x == 1 for b, y in zip(scores, labels) if y == 0]
    return sum(1.0 if a > b else 0.5 if a == b else 0.0 for a, b in pairs) / len(pairs)


@pytest.mark.parametrize("ranges", [2, 7, 256])
def test_quantiles_equal_numpy(spark, ranges):
    rng = np.random.default_rng(7)
    # A third of the rows share one value; the second column is nearly all ties; NULLs are left out.
    rows = [
        (int(i % 2), 5.0 if i % 3 == 0 else float(x), float(i % 4), None if i % 10 == 0 else float(i))
        for i, x in enumerate(rng.exponential(10, 997))
    ]
    df = spark.createDataFrame(rows, "g int, a double, b double, c double")
    probs = {"p0": 0.0, "q1": 0.25, "mediana": 0.5, "p99": 0.99, "p100": 1.0}
    got = {(r["g"], r["variavel"]): r for r in exact_quantiles(df, ["a", "b", "c"], probs, ["g"], ranges).collect()}
    for g in (0, 1):
        for i, c in enumerate("abc", start=1):
            x = [r[i] for r in rows if r[0] == g and r[i] is not None]
            assert got[(g, c)]["n"] == len(x)
            for name, p in probs.items():
                assert got[(g, c)][name] == pytest.approx(np.quantile(x, p), abs=1e-9)


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "a double")
    assert exact_quantiles(df, ["a"], {"m": 0.5}).collect() == []


@pytest.mark.parametrize("ranges", [2, 5, 256])
def test_auc_equals_brute_force(spark, ranges):
    draw = random.Random(3)
    rows = [(draw.choice("xy"), draw.randint(0, 1), round(draw.random(), draw.choice([1, 3]))) for _ in range(400)]
    df = spark.createDataFrame(rows, "g string, label int, s double")
    got = {r["g"]: r["roc_auc"] for r in metrics.roc_auc(df, "label", "s", ["g"], ranges).collect()}
    for g in "xy":
        want = brute_auc([r[1] for r in rows if r[0] == g], [r[2] for r in rows if r[0] == g])
        assert got[g] == pytest.approx(want, abs=1e-12)


@pytest.mark.parametrize("rows, want", [
    ([(0, 0.5), (1, 0.5), (1, 0.5)], 0.5), ([(0, 0.1), (1, 0.9)], 1.0), ([(0, 0.9), (1, 0.1)], 0.0),
    ([(1, 0.1), (1, 0.2)], None),
])
def test_auc_edges(spark, rows, want):
    df = spark.createDataFrame(rows, "label int, s double")
    assert metrics.roc_auc(df, "label", "s").first()["roc_auc"] == want


def test_measures_with_empty_denominators(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.8)], "label int, s double")
    r = metrics.confusion(df, "label", "s").first()
    assert (r["tn"], r["fp"], r["fn"], r["tp"]) == (0, 1, 0, 1)
    assert r["precision_nao_alfabetizado"] == 0.0 and r["recall_nao_alfabetizado"] == 0.0
    assert r["f1_macro"] == pytest.approx((0 + 2 / 3) / 2)
    only = spark.createDataFrame([(1, 0.9)], "label int, s double")
    assert metrics.confusion(only, "label", "s").first()["f1_macro"] == 1.0


def test_counts_give_the_same_measures(spark):
    draw = random.Random(5)
    df = spark.createDataFrame([(draw.randint(0, 1), round(draw.random(), 2)) for _ in range(300)], "label int, s double")
    direct = metrics.confusion(df, "label", "s").first().asDict()
    collapsed = metrics.confusion_of_counts(metrics.score_counts(df, "label", "s")).first().asDict()
    assert direct == collapsed


def test_row_numbers_small_and_large_way(spark):
    df = spark.range(1000).select((F.col("id") % 37).alias("v"), F.col("id").cast("string").alias("k"))
    order = [F.desc("v"), F.col("k")]
    small = number_rows(df, order, "p", 1000).collect()
    large = number_rows(df, order, "p").collect()
    assert sorted(map(tuple, small)) == sorted(map(tuple, large))
    assert sorted(r["p"] for r in large) == list(range(1, 1001))


def test_ranges_rise_with_the_value(spark):
    df = spark.range(5000).select((F.col("id") * 1.5).alias("x"), F.lit(1).alias("n"))
    placed = with_range(df, "x", F.col("n"), ranges=16)
    bounds = placed.groupBy("_range").agg(F.min("x").alias("lo"), F.max("x").alias("hi"), F.count("*").alias("n")).orderBy("_range").collect()
    assert all(a["hi"] < b["lo"] for a, b in zip(bounds, bounds[1:]))
    assert max(b["n"] for b in bounds) < 2 * 5000 / 16


def test_threshold_simulation_recall_never_falls(spark):
    draw = random.Random(9)
    df = spark.createDataFrame([(draw.randint(0, 1), draw.random()) for _ in range(500)], "label int, s double")
    sim = metrics.threshold_simulation(df, "label", "s").orderBy("threshold").collect()
    recall = [r["recall_nao_alfabetizado"] for r in sim]
    assert len(sim) == 6 and recall == sorted(recall)


def test_best_row_takes_the_first_on_a_tie(spark):
    df = spark.createDataFrame([("b", 0.7), ("a", 0.7), ("c", 0.6), ("d", None)], "model string, auc double")
    assert metrics.best_row(df, "auc", "model").first()["model"] == "a"


def test_histogram_area_is_one_per_class(spark):
    df = spark.range(1000).select((F.col("id") % 2).alias("c"), (F.col("id") * 0.37).alias("x"))
    out = profile.density_histogram(df, "x", "c", 20)
    width = (999 * 0.37) / 20
    for r in out.groupBy("c").agg(F.sum("densidade").alias("d"), F.sum("n").alias("n"), F.max("faixa").alias("f")).collect():
        assert r["d"] * width == pytest.approx(1.0) and r["n"] == 500 and r["f"] == 19


def test_histogram_of_a_constant(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 1.0)], "c string, x double")
    assert profile.density_histogram(df, "x", "c").select("faixa", "n", "densidade").first() == (25, 2, 50.0)


def test_correlations_do_not_depend_on_the_order_of_rows(spark):
    rng = random.Random(7)
    rows = [(rng.gauss(500, 3), None if i % 5 == 0 else rng.random(), 0.1, rng.choice([None, -1e6, 1e6 + 0.25])) for i in range(3000)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    seen = set()
    for parts in (3, 8, 200):
        got = {(r["a"], r["b"]): r["corr"] for r in profile.correlations(df.repartition(parts), ["a", "b", "c", "d"]).collect()}
        seen.add(tuple(sorted((k, None if v is None else v.hex()) for k, v in got.items())))
    assert len(seen) == 1 and got["a", "c"] is None and got["c", "d"] is None
    both = [(a, b) for a, b, _, _ in rows if b is not None]
    assert abs(got["a", "b"] - np.corrcoef(*zip(*both))[0, 1]) < 1e-8


def test_constant_column_has_no_correlation(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, 4.0, 5.0), (3.0, 6.0, 5.0)], "a double, b double, k double")
    got = {(r["a"], r["b"]): r["corr"] for r in profile.correlations(df, ["a", "b", "k"]).collect()}
    assert got[("a", "b")] == pytest.approx(1.0) and got[("a", "k")] is None
    assert [r["variavel"] for r in profile.constant_columns(df, ["a", "b", "k"]).collect()] == ["k"]
