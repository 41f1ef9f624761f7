import pytest
from pyspark.sql import functions as F

from farol.operators import experiment, search


def history(spark, rows):
    return spark.createDataFrame(
        [("m", t, f, v, 4 + t % 3, f"p{t}", s) for t, f, v, s in rows], search.HISTORY
    )


def test_candidates_repeat(spark):
    assert search.candidate("random_forest", 3) == search.candidate("random_forest", 3)
    assert search.candidate("random_forest", 3) != search.candidate("random_forest", 4)
    drawn = [search.candidate("xgboost", t) for t in range(50)]
    assert all(3 <= c["max_depth"] <= 10 and 0.01 <= c["learning_rate"] <= 0.3 for c in drawn)


def test_median_rule(spark):
    good = [(t, f, 0.6 + t / 100, "COMPLETE") for t in range(6) for f in range(3)]
    poor = [(6, 0, 0.1, "PRUNED"), (6, 1, 0.1, "PRUNED"), (7, 0, 0.9, "COMPLETE"), (7, 1, 0.2, "COMPLETE"), (7, 2, 0.2, "COMPLETE")]
    got = {(r["trial"], r["fold"]): r["parar"] for r in search.median_stop(history(spark, good + poor)).collect()}
    assert all(got[(t, f)] == 0 for t in range(5) for f in range(3))  # start-up trials
    assert got[(6, 0)] == 0 and got[(6, 1)] == 1  # first fold spared
    assert got[(7, 1)] == 0  # its best running mean, 0.9, is above the median


def test_rule_in_the_loop_equals_the_table_rule(spark):
    values = {t: [0.5 + (t * 7 % 11) / 50, 0.5 + (t * 5 % 13) / 60, 0.55] for t in range(12)}
    finished, rows, loop = [], [], {}
    for t, v in values.items():
        state = "COMPLETE"
        for f in range(3):
            loop[(t, f)] = int(search._should_stop(v[: f + 1], finished))
            if loop[(t, f)]:
                state = "PRUNED"
                break
        if state == "COMPLETE":
            finished.append(v)
        rows += [(t, g, v[g], state) for g in range(f + 1)]
    table = {(r["trial"], r["fold"]): r["parar"] for r in search.median_stop(history(spark, rows)).collect()}
    assert table == loop and sum(loop.values()) > 0


def test_curve_and_best(spark):
    rows = [(t, f, 0.6 + t / 100, "PRUNED" if t == 5 else "COMPLETE") for t in range(6) for f in range(2)] + [(9, 0, None, "COMPLETE")]
    h = history(spark, rows)
    curve = {r["max_depth"]: (r["n_trials"], r["roc_auc_medio"]) for r in search.depth_curve(h).collect()}
    assert curve[4] == (2, pytest.approx(0.615)) and sum(n for n, _ in curve.values()) == 6
    assert search.curve_peak(search.depth_curve(h)).first()["max_depth"] == 6
    best = search.best_per_model(h).first()
    assert best["trial"] == 4 and best["best_params"] == "p4"
    assert search.best_document(search.best_per_model(h)).first()["modelos"]["m"]["best_params"] == "p4"


def test_alarm_boundary(spark):
    df = spark.createDataFrame([(0.70, 0.685), (0.70, 0.695), (0.60, 0.70)], "roc_auc_teste double, roc_auc_cv_media double")
    assert [r["suspeita_de_vazamento"] for r in experiment.leakage_alarm(df).collect()] == [True, False, False]


def test_arm_delta(spark):
    df = spark.createDataFrame([("com", "m", 0.7), ("sem", "m", 0.6)], "braco string, model string, roc_auc_teste double")
    r = experiment.arm_delta(df, "com", "sem").first()
    assert (r["com"], r["sem"]) == (0.7, 0.6) and r["delta"] == pytest.approx(0.1)
