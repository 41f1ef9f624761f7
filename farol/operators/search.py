"""Hyper-parameter search and its trial history.

A trial history has one row per ``(model, trial, fold)`` with the fold's value,
the trial's parameters and its ``state``: COMPLETE or PRUNED.
"""

from __future__ import annotations

import json
import math
import random
from statistics import median

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from farol import constants as K
from farol.operators import metrics, models
from farol.operators.split import stratified_group_folds

HISTORY = "model string, trial int, fold int, value double, max_depth int, params string, state string"
# The pruning rule waits for this many complete trials and spares the first fold.
STARTUP_TRIALS, WARMUP_FOLDS = 5, 1


def candidate(name: str, trial: int, seed: int = K.SEED) -> dict:
    """The same draw for the same model, trial and seed."""
    draw = random.Random(f"{name}/{trial}/{seed}")
    params = {}
    for key, space in K.SEARCH_SPACE[name].items():
        if isinstance(space, list):
            params[key] = draw.choice(space)
            continue
        low, high, kind = space
        if kind == "int":
            params[key] = draw.randint(low, high)
        elif kind == "log":
            params[key] = math.exp(draw.uniform(math.log(low), math.log(high)))
        else:
            params[key] = draw.uniform(low, high)
    return params


def running_mean(history: DataFrame) -> DataFrame:
    """Mean of a trial's values up to each fold, and the best such mean so far."""
    so_far = W.partitionBy("model", "trial").orderBy("fold").rowsBetween(W.unboundedPreceding, 0)
    return history.withColumn("media_parcial", F.avg("value").over(so_far)).withColumn(
        "melhor_parcial", F.max("media_parcial").over(so_far)
    )


def median_stop(history: DataFrame) -> DataFrame:
    """Stop when a trial's best running mean is under the median of earlier complete trials.

    One window per model and fold walks the trials in order; nothing is paired.
    """
    earlier = W.partitionBy("model", "fold").orderBy("trial").rowsBetween(W.unboundedPreceding, -1)
    complete = F.when(F.col("state") == "COMPLETE", F.col("media_parcial"))
    judged = running_mean(history).withColumns({
        "mediana_anteriores": F.percentile(complete, F.lit(0.5)).over(earlier),
        "completos_antes": F.count(complete).over(earlier),
    })
    stop = (
        (F.col("fold") >= WARMUP_FOLDS) & (F.col("completos_antes") >= STARTUP_TRIALS)
        & (F.col("melhor_parcial") < F.col("mediana_anteriores"))
    )
    return judged.withColumn("parar", F.coalesce(stop, F.lit(False)).cast("int"))


def trial_values(history: DataFrame) -> DataFrame:
    """one row per trial with a value: the mean over its folds."""
    return history.where(F.col("value").isNotNull()).groupBy("model", "trial").agg(
        F.avg("value").alias("value"), F.max("max_depth").alias("max_depth"),
        F.max("params").alias("params"), F.max("state").alias("state"),
    )


def depth_curve(history: DataFrame) -> DataFrame:
    """Trials and mean value per depth."""
    return trial_values(history).where(F.col("max_depth").isNotNull()).groupBy("model", "max_depth").agg(
        F.count(F.lit(1)).alias("n_trials"), F.avg("value").alias("roc_auc_medio")
    )


def curve_peak(curve: DataFrame) -> DataFrame:
    """T5: best depth per model, the smallest depth on a tie."""
    return metrics.best_row(curve, "roc_auc_medio", "max_depth", ["model"])


def best_per_model(history: DataFrame) -> DataFrame:
    """Best complete trial of each model."""
    finished = trial_values(history).where(F.col("state") == "COMPLETE")
    best = metrics.best_row(finished, "value", "trial", ["model"])
    return best.select("model", F.col("value").alias("best_roc_auc_cv"), "trial", F.col("params").alias("best_params"))


def best_document(best: DataFrame) -> DataFrame:
    """The best of every model as one document, ready for the JSON sink."""
    return best.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(
        "model", F.struct("best_roc_auc_cv", "best_params")
    )))).alias("modelos"))


def _should_stop(scores: list[float], finished: list[list[float]]) -> bool:
    """The rule of ``median_stop`` for the trial at hand, over the few values in memory."""
    fold = len(scores) - 1
    if fold < WARMUP_FOLDS or len(finished) < STARTUP_TRIALS:
        return False
    means = [sum(scores[: i + 1]) / (i + 1) for i in range(len(scores))]
    return max(means) < median(sum(done[: fold + 1]) / (fold + 1) for done in finished)


def run_search(
    train: DataFrame, name: str, trials: int = K.SEARCH_TRIALS, folds: int = K.SEARCH_FOLDS,
    seed: int = K.SEED, history: DataFrame | None = None, overrides: dict | None = None,
) -> DataFrame:
    """Seeded random candidates scored by grouped, stratified cross-validation.

    Trials already in ``history`` are not run again. Each fold is a distributed
    fit; the driver holds one number per trial and fold.
    """
    spark = train.sparkSession
    assigned = train.join(stratified_group_folds(train, "label", folds).select(K.GROUP, "fold"), K.GROUP)
    assigned = assigned.persist()
    rows = [] if history is None else [tuple(r) for r in history.where(F.col("model") == name).select(
        "model", "trial", "fold", "value", "max_depth", "params", "state").collect()]
    done = {r[1] for r in rows}
    finished = [
        [r[3] for r in sorted(rows, key=lambda r: r[2]) if r[1] == t]
        for t in sorted(done) if any(r[1] == t and r[6] == "COMPLETE" for r in rows)
    ]
    try:
        for trial in range(trials):
            if trial in done:
                continue
            params = {**candidate(name, trial, seed), **(overrides or {})}
            scores, state = [], "COMPLETE"
            for fold in range(folds):
                model = models.fit(assigned.where(F.col("fold") != fold).drop("fold"), name, params)
                held_out = models.score(model, assigned.where(F.col("fold") == fold))
                scores.append(metrics.roc_auc(held_out, "label", "prob_alfabetizado").first()["roc_auc"])
                if _should_stop(scores, finished):
                    state = "PRUNED"
                    break
            if state == "COMPLETE":
                finished.append(scores)
            rows += [
                (name, trial, fold, value, params.get("max_depth"), json.dumps(params), state)
                for fold, value in enumerate(scores)
            ]
    finally:
        assigned.unpersist()
    return spark.createDataFrame(rows, HISTORY)
