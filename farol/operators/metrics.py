"""Classification measures as aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from farol import constants as K
from farol.functions import rules
from farol.operators.order import RANGES, with_range


def class_balance(df: DataFrame, label: str = "label") -> DataFrame:
    """Class counts, imbalance ratio and the balanced class weights."""
    one = df.agg(
        F.count(F.when(F.col(label) == 0, 1)).alias("n_neg"), F.count(F.when(F.col(label) == 1, 1)).alias("n_pos")
    )
    n = F.col("n_neg") + F.col("n_pos")
    return one.select(
        "n_neg", "n_pos",
        F.coalesce(rules.share(F.col("n_neg"), F.col("n_pos")), F.lit(1.0)).alias("scale_pos_weight"),
        rules.share(n, 2 * F.col("n_neg")).alias("peso_0"),
        rules.share(n, 2 * F.col("n_pos")).alias("peso_1"),
    )


def _measures(tn: Column, fp: Column, fn: Column, tp: Column) -> dict[str, Column]:
    """Accuracy, macro F1, recall and precision; an empty denominator counts as 0."""

    def ratio(part: Column, whole: Column) -> Column:
        return F.coalesce(rules.share(part, whole), F.lit(0.0))

    # Macro F1 averages the classes that occur in the labels or the predictions.
    seen0, seen1 = (tn + fp + fn > 0).cast("int"), (tp + fp + fn > 0).cast("int")
    f1 = ratio(2 * tn, 2 * tn + fp + fn) + ratio(2 * tp, 2 * tp + fp + fn)
    return {
        "accuracy": ratio(tn + tp, tn + fp + fn + tp),
        "f1_macro": F.coalesce(rules.share(f1, seen0 + seen1), F.lit(0.0)),
        "recall_nao_alfabetizado": ratio(tn, tn + fp),
        "recall_alfabetizado": ratio(tp, tp + fn),
        "precision_nao_alfabetizado": ratio(tn, tn + fn),
        "precision_alfabetizado": ratio(tp, tp + fp),
    }


def _cells(label: str, predicted: Column, tag: str = "") -> list[Column]:
    y = F.col(label)

    def n(condition: Column) -> Column:
        return F.count(F.when(condition, 1))

    return [
        n((y == 0) & (predicted == 0)).alias(f"tn{tag}"), n((y == 0) & (predicted == 1)).alias(f"fp{tag}"),
        n((y == 1) & (predicted == 0)).alias(f"fn{tag}"), n((y == 1) & (predicted == 1)).alias(f"tp{tag}"),
    ]


def confusion(df: DataFrame, label: str, score: str, threshold: float = 0.5, by: list[str] | None = None) -> DataFrame:
    """The four counts and the measures drawn from them, in one aggregate."""
    counts = df.groupBy(*(by or [])).agg(*_cells(label, rules.decide(score, threshold)))
    return counts.withColumns(_measures(*[F.col(c) for c in ("tn", "fp", "fn", "tp")]))


def score_counts(df: DataFrame, label: str, score: str, by: list[str] | None = None) -> DataFrame:
    """Negatives and positives per distinct score: all that the measures need."""
    return df.where(F.col(score).isNotNull()).groupBy(*(by or []), F.col(score).alias("_score")).agg(
        F.count(F.when(F.col(label) == 0, 1)).alias("_neg"), F.count(F.when(F.col(label) == 1, 1)).alias("_pos")
    )


def confusion_of_counts(counts: DataFrame, threshold: float = 0.5, by: list[str] | None = None) -> DataFrame:
    """A26 from ``score_counts``."""
    above = rules.decide("_score", threshold) == 1

    def n(side: str, condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col(side))), F.lit(0))

    cells = counts.groupBy(*(by or [])).agg(
        n("_neg", ~above).alias("tn"), n("_neg", above).alias("fp"),
        n("_pos", ~above).alias("fn"), n("_pos", above).alias("tp"),
    )
    return cells.withColumns(_measures(*[F.col(c) for c in ("tn", "fp", "fn", "tp")]))


def auc_of_counts(counts: DataFrame, by: list[str] | None = None, ranges: int = RANGES) -> DataFrame:
    """A27 from ``score_counts``.

    Distinct scores are cut into ranges. Pairs inside a range need that range
    alone; pairs across ranges need only range totals.
    """
    by = by or []
    placed = with_range(counts, "_score", F.col("_neg") + F.col("_pos"), ranges=ranges)
    inside = W.partitionBy(*by, "_range").orderBy("_score")
    below = F.sum("_neg").over(inside) - F.col("_neg")
    per_range = (
        placed.withColumn("_won", F.col("_pos").cast("double") * (below + F.col("_neg") / F.lit(2.0)))
        .groupBy(*by, "_range")
        .agg(F.sum("_won").alias("_won"), F.sum("_neg").alias("_neg"), F.sum("_pos").alias("_pos"))
    )
    # At most ``ranges`` rows per group from here on.
    across = W.partitionBy(*by).orderBy("_range")
    lower = F.sum("_neg").over(across) - F.col("_neg")
    total = per_range.withColumn("_cross", F.col("_pos").cast("double") * lower).groupBy(*by).agg(
        F.sum("_neg").alias("n_neg"), F.sum("_pos").alias("n_pos"),
        F.sum(F.col("_won") + F.col("_cross")).alias("_won"),
    )
    return total.withColumn(
        "roc_auc", F.try_divide(F.col("_won"), F.col("n_neg").cast("double") * F.col("n_pos"))
    ).drop("_won")


def roc_auc(df: DataFrame, label: str, score: str, by: list[str] | None = None, ranges: int = RANGES) -> DataFrame:
    """Exact area under the ROC curve, tied pairs counted half; NULL for one class only."""
    return auc_of_counts(score_counts(df, label, score, by), by, ranges)


def threshold_simulation(
    df: DataFrame, label: str, score: str, thresholds: list[float] | None = None,
) -> DataFrame:
    """Measures at each cut, rounded half-even to 4 digits.

    All cuts are counted side by side in one aggregate; rows are not repeated.
    """
    thresholds = thresholds or K.THRESHOLDS
    cells = [c for i, t in enumerate(thresholds) for c in _cells(label, rules.decide(score, t), f"_{i}")]
    rows = [
        F.struct(F.lit(float(t)).alias("threshold"), *[F.col(f"{c}_{i}").alias(c) for c in ("tn", "fp", "fn", "tp")])
        for i, t in enumerate(thresholds)
    ]
    counts = df.agg(*cells).select(F.inline(F.array(*rows)))
    names = ["accuracy", "f1_macro", "recall_nao_alfabetizado", "precision_nao_alfabetizado"]
    measures = _measures(*[F.col(c) for c in ("tn", "fp", "fn", "tp")])
    return counts.select("threshold", *[rules.round_even(measures[n], 4).alias(n) for n in names])


def best_row(df: DataFrame, measure: str, first_by: str, by: list[str] | None = None, highest: bool = True) -> DataFrame:
    """The row with the best measure; ties go to the lowest ``first_by``."""
    by = by or []
    rest = [c for c in df.columns if c not in by]
    value = F.col(measure) if highest else -F.col(measure)
    row = F.struct(*[F.col(c) for c in rest])
    pick = F.min_by(row, F.struct((-value).alias("v"), F.col(first_by).alias("t")))
    return df.where(F.col(measure).isNotNull()).groupBy(*by).agg(pick.alias("_best")).select(*by, "_best.*")
