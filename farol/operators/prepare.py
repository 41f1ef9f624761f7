"""Labels, imputation, scaling, encoding and the fitted pipeline."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import (
    Imputer, OneHotEncoder, SQLTransformer, StandardScaler, StringIndexer, VectorAssembler,
)
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from farol import constants as K
from farol.functions import rules
from farol.operators.order import exact_quantiles

NO_VALUE = "sem valor"  # label of a category that is NULL in every training row


def model_frame(df: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """Group id, features as doubles and strings, strict 0/1 label."""
    return df.select(
        K.GROUP, *(extra or []), *[F.col(c).cast("double").alias(c) for c in K.NUMERIC_FEATURES],
        *K.CATEGORICAL_FEATURES, rules.strict_label().cast("double").alias("label"),
    )


def medians(df: DataFrame, columns: list[str]) -> DataFrame:
    """M7: exact median per column."""
    return exact_quantiles(df, columns, {"mediana": 0.5})


def median_impute(df: DataFrame, columns: list[str], fit_on: DataFrame | None = None) -> DataFrame:
    """M7: fill NULLs with the medians of ``fit_on`` (one small map, not a join)."""
    fitted = medians(df if fit_on is None else fit_on, columns)
    by_name = fitted.agg(F.map_from_entries(F.collect_list(F.struct("variavel", "mediana")))).scalar()
    filled = {c: F.coalesce(F.col(c).cast("double"), F.try_element_at("_m", F.lit(c))) for c in columns}
    return df.withColumn("_m", by_name).withColumns(filled).drop("_m")


def modes(df: DataFrame, columns: list[str]) -> DataFrame:
    """M8: most frequent text per column, smallest on a tie; values are counted before they meet."""
    counts = (
        df.select(*columns).unpivot([], columns, "variavel", "valor").where(F.col("valor").isNotNull())
        .groupBy("variavel", "valor").agg(F.count(F.lit(1)).alias("n"))
    )
    return counts.groupBy("variavel").agg(
        F.min_by("valor", F.struct((-F.col("n")).alias("n"), F.col("valor").alias("v"))).alias("moda"),
        F.max("n").alias("n"),
    )


def mode_impute(df: DataFrame, columns: list[str], fit_on: DataFrame | None = None) -> DataFrame:
    """M8: fill missing text with the fitted mode."""
    fitted = modes(df if fit_on is None else fit_on, columns)
    by_name = fitted.agg(F.map_from_entries(F.collect_list(F.struct("variavel", "moda")))).scalar()
    filled = {c: F.coalesce(F.col(c), F.try_element_at("_m", F.lit(c))) for c in columns}
    return df.withColumn("_m", by_name).withColumns(filled).drop("_m")


def standardise(df: DataFrame, columns: list[str], suffix: str = "_z", fit_on: DataFrame | None = None) -> DataFrame:
    """M9: (x - mean) / population deviation; a constant column becomes 0."""
    source = df if fit_on is None else fit_on
    stats = source.agg(F.struct(*[
        F.struct(F.avg(c).alias("mean"), F.stddev_pop(c).alias("std")).alias(c) for c in columns
    ])).scalar()
    z = {
        f"{c}{suffix}": (F.col(c) - F.col(f"_s.{c}.mean"))
        / F.when(F.col(f"_s.{c}.std") == 0, 1.0).otherwise(F.col(f"_s.{c}.std"))
        for c in columns
    }
    return df.withColumn("_s", stats).withColumns(z).drop("_s")


def target_encoding(df: DataFrame, key: str, label: str = "label", fold: str = "fold") -> DataFrame:
    """Mean label per key from the other folds; the other folds' overall mean when the key is new.

    Kept for the leakage audit only: classmates of the same edition leak
    through it, so the model never sees it.
    """
    per = df.groupBy(key, fold).agg(F.count(F.lit(1)).alias("n"), F.sum(label).cast("double").alias("s"))
    # At most one row per fold and key is left here.
    of_key = W.partitionBy(key)
    whole = per.withColumns({"_n": F.sum("n").over(of_key), "_s": F.sum("s").over(of_key)})
    folds = per.groupBy(fold).agg(F.sum("n").alias("fn"), F.sum("s").alias("fs"))
    by_fold = folds.agg(F.map_from_entries(F.collect_list(F.struct(F.col(fold), F.struct("fn", "fs"))))).scalar()
    overall = folds.agg(F.struct(F.sum("fn").alias("n"), F.sum("fs").alias("s"))).scalar()
    mine = F.try_element_at("_b", F.col(fold))
    prior = F.try_divide(F.col("_o.s") - mine["fs"], (F.col("_o.n") - mine["fn"]).cast("double"))
    others = F.try_divide(F.col("_s") - F.col("s"), (F.col("_n") - F.col("n")).cast("double"))
    return whole.withColumns({"_b": by_fold, "_o": overall}).select(
        key, fold, "n", F.coalesce(others, prior).alias("codificado")
    )


def known_numbers(df: DataFrame, numeric: list[str]) -> list[str]:
    """Columns with at least one value, in one pass over all of them."""
    if not numeric:
        return []
    counts = df.agg(*[F.count(F.when(F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")), 1)).alias(f"c{i}") for i, c in enumerate(numeric)]).first()
    return [c for c, n in zip(numeric, counts, strict=True) if n]


def preprocessor(df: DataFrame, numeric: list[str], categorical: list[str]) -> Pipeline:
    """Impute, scale and one-hot, as unfitted stages around the fitted text modes.

    Categories unseen in training become an all-zero block. A number without
    any value is left out, as there is nothing to impute it by.
    """
    numeric = known_numbers(df, numeric)
    mode = {r["variavel"]: r["moda"] for r in modes(df, categorical).collect()} if categorical else {}
    # A category without any value gets one label.
    literal = {c: (mode.get(c) or NO_VALUE).replace("\\", "\\\\").replace("'", "\\'") for c in categorical}
    fills = ", ".join(f"coalesce({c}, '{literal[c]}') AS {c}_f" for c in categorical)
    stages = [SQLTransformer(statement=f"SELECT *{', ' + fills if fills else ''} FROM __THIS__")]
    blocks = []
    if numeric:
        stages.append(Imputer(strategy="median", inputCols=numeric, outputCols=[f"{c}_i" for c in numeric]))
        stages.append(VectorAssembler(inputCols=[f"{c}_i" for c in numeric], outputCol="numeric_raw"))
        stages.append(StandardScaler(inputCol="numeric_raw", outputCol="numeric", withMean=True, withStd=True))
        blocks.append("numeric")
    if categorical:
        stages.append(StringIndexer(
            inputCols=[f"{c}_f" for c in categorical], outputCols=[f"{c}_x" for c in categorical],
            handleInvalid="keep", stringOrderType="alphabetAsc",
        ))
        stages.append(OneHotEncoder(
            inputCols=[f"{c}_x" for c in categorical], outputCols=[f"{c}_o" for c in categorical], dropLast=True,
        ))
        blocks += [f"{c}_o" for c in categorical]
    stages.append(VectorAssembler(inputCols=blocks, outputCol="features"))
    return Pipeline(stages=stages)


def feature_names(pre: PipelineModel, numeric: list[str], categorical: list[str]) -> list[str]:
    """Names of the vector slots, in order."""
    assembled = next(s for s in pre.stages if s.__class__.__name__ == "VectorAssembler")
    kept = {c.removesuffix("_i") for c in assembled.getInputCols()}
    names = [f"numeric__{c}" for c in numeric if c in kept]
    indexer = next((s for s in pre.stages if s.__class__.__name__ == "StringIndexerModel"), None)
    if indexer is not None:
        for c, values in zip(categorical, indexer.labelsArray):
            names += [f"categorical__{c}_{v}" for v in values]
    return names


def require_columns(df: DataFrame, columns: list[str], add_missing: bool = False) -> DataFrame:
    """Check a scoring input: missing columns fail, or become NULL when asked."""
    missing = [c for c in columns if c not in df.columns]
    if missing and not add_missing:
        raise ValueError(f"scoring input lacks columns: {', '.join(missing)}")
    kind = {c: "string" if c in K.CATEGORICAL_FEATURES else "double" for c in missing}
    return df.withColumns({c: F.lit(None).cast(t) for c, t in kind.items()}) if missing else df
