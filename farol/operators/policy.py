"""Scores rolled up into policy answers."""

from __future__ import annotations

from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from farol import constants as K
from farol.functions import rules
from farol.operators.order import number_rows
from farol.operators.prepare import standardise

MUNICIPAL_CONSTANTS = ["taxa_alfabetizacao_municipio", "inse_municipio", "percentual_participacao"]


def _latest(c: str) -> Column:
    """Value of the latest year that has one."""
    return F.max_by(c, F.when(F.col(c).isNotNull(), F.col("ano")))


def municipal_view(
    scored: DataFrame, goals: DataFrame, label: str = "label", min_support: int = K.MIN_SUPPORT,
) -> DataFrame:
    """One row per municipality with enough scored students."""
    rolled = scored.groupBy("id_municipio").agg(
        F.count(F.lit(1)).alias("n_alunos_avaliados"),
        F.avg(rules.risk("prob_alfabetizado")).alias("risco_medio"),
        (F.avg(label) * 100).alias("taxa_alfabetizacao_real"),
        *[_latest(c).alias(c) for c in MUNICIPAL_CONSTANTS],
    )
    return (
        rolled.where(F.col("n_alunos_avaliados") >= min_support)
        .join(goals, "id_municipio", "left")
        .withColumn("uf", rules.state_name(F.substring("id_municipio", 1, 2)))
    )


def risk_ranking(view: DataFrame, rows: int | None = None) -> DataFrame:
    """Municipalities from highest to lowest risk, id as the tie-break."""
    ranked = number_rows(view, [F.desc("risco_medio"), F.col("id_municipio")], "posicao", rows)
    return ranked.select(
        "posicao", "id_municipio", "uf", "n_alunos_avaliados", "risco_medio", "taxa_alfabetizacao_real",
        "inse_municipio", "gap_meta_2030",
    )


def top_risk(view: DataFrame, n: int = 20) -> DataFrame:
    """The first ``n`` of the ranking by a distributed top-n; the whole is never sorted."""
    return view.orderBy(F.desc("risco_medio"), "id_municipio").limit(n)


def risk_by_state(view: DataFrame) -> DataFrame:
    """A10: municipalities and their unweighted mean risk per state."""
    return view.where(F.col("uf").isNotNull()).groupBy("uf").agg(
        F.count(F.lit(1)).alias("municipios"), F.avg("risco_medio").alias("risco_medio")
    ).orderBy(F.desc("risco_medio"), "uf")


def goal_projection(view: DataFrame) -> DataFrame:
    """Pace needed until the goal year, projection, distance and tier.

    The projection keeps the current rate when it is under the goal and falls
    back to the goal when above, as the published rule does.
    """
    years = K.GOAL_YEAR - K.BASE_YEAR
    current, goal, pace = F.col("taxa_atual"), F.col("meta_2030"), F.col("ritmo_necessario_aa")
    return (
        view.dropna(subset=["meta_2030", "taxa_alfabetizacao_municipio"])
        .withColumn("taxa_atual", F.col("taxa_alfabetizacao_real"))
        .withColumn("ritmo_necessario_aa", (goal - current) / years)
        .withColumns({
            "projecao_2030": current + rules.clip_upper(pace, 0.0) * years,
            "atinge_meta_2030": current >= goal,
            "distancia_meta_pp": current - goal,
            "classificacao_meta": rules.goal_tier(current, goal, pace),
        })
    )


def tier_mix(projected: DataFrame) -> DataFrame:
    """Municipalities and percent per tier, one decimal."""
    counts = projected.groupBy(F.col("classificacao_meta").alias("classificacao")).agg(
        F.count(F.lit(1)).alias("municipios")
    )
    total = counts.agg(F.sum("municipios")).scalar()
    return counts.withColumn("percentual", rules.round_even(rules.share(F.col("municipios"), total) * 100, 1))


def goal_risk_list(projected: DataFrame, tier: str = K.TIERS[-1]) -> DataFrame:
    """Municipalities of the high-risk tier (or another), steepest pace first."""
    return (
        projected.where(F.col("classificacao_meta") == tier)
        .orderBy(F.desc("ritmo_necessario_aa"), "id_municipio")
        .select("id_municipio", "uf", "taxa_atual", "meta_2030", "distancia_meta_pp", "ritmo_necessario_aa",
                "risco_medio")
    )


def contingency(df: DataFrame, row: str, column: str, values: list[str]) -> DataFrame:
    """Percent of each value within a row; an absent combination is 0."""
    wide = df.where(F.col(row).isNotNull()).groupBy(row).pivot(column, values).count().fillna(0)
    total = sum((F.col(v) for v in values), F.lit(0))
    return wide.select(row, *[(rules.share(F.col(v), total) * 100).alias(v) for v in values])


def clusters(
    view: DataFrame, k: int = 4, restarts: int = 10, features: list[str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(municipalities with cluster and profile name, profile table).

    The restart with the lowest cost wins; clusters are named by falling risk.
    """
    features = features or K.CLUSTER_FEATURES
    data = view.dropna(subset=features)
    z = [f"{c}_z" for c in features]
    ready = VectorAssembler(inputCols=z, outputCol="features").transform(standardise(data, features)).persist()
    try:
        fitted = [KMeans(k=k, seed=K.SEED + i).fit(ready) for i in range(restarts)]
        best = min(fitted, key=lambda m: m.summary.trainingCost)
    finally:
        ready.unpersist()
    assigned = best.transform(ready).withColumnRenamed("prediction", "cluster").drop("features", *z)
    profile = assigned.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("municipios"), F.avg("risco_medio").alias("risco_medio"),
        F.avg("taxa_alfabetizacao_real").alias("taxa_alfabetizacao"), F.avg("inse_municipio").alias("inse"),
        F.avg("gap_meta_2030").alias("gap_meta"), F.avg("percentual_participacao").alias("participacao"),
    )
    # k rows: the severity order is one small window.
    rank = F.row_number().over(W.orderBy(F.desc("risco_medio"), "cluster")) - 1
    names = F.array(*[F.lit(n) for n in K.CLUSTER_NAMES])
    named = profile.withColumn("_rank", rank).withColumn(
        "perfil", F.coalesce(F.get(names, F.col("_rank")), F.concat(F.lit("Grupo "), F.col("_rank").cast("string")))
    ).drop("_rank")
    assigned = assigned.join(F.broadcast(named.select("cluster", "perfil")), "cluster")
    return assigned, named
