"""Exploratory profile as one long table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farol import constants as K
from farol.operators import profile


def profile_bundle(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Shape, missing counts, target mix and description, as ``(secao, variavel, medida, valor)``."""
    columns = columns or K.PROFILE_FEATURES

    def long(table: DataFrame, section: str, name: str | None, measures: list[str]) -> DataFrame:
        label = F.lit("*") if name is None else F.col(name)
        return table.select(
            F.lit(section).alias("secao"), label.alias("variavel"),
            *[F.col(m).cast("double").alias(m) for m in measures],
        ).unpivot(["secao", "variavel"], measures, "medida", "valor")

    described = profile.describe(df, columns)
    stats = [c for c in described.columns if c != "variavel"]
    return (
        long(profile.shape(df), "forma", None, ["linhas", "colunas"])
        .unionByName(long(profile.null_profile(df, df.columns), "nulos", "variavel", ["nulos", "pct"]))
        .unionByName(long(profile.value_shares(df, K.TARGET), "alvo", K.TARGET, ["n", "pct"]))
        .unionByName(long(described, "descricao", "variavel", stats))
    )
