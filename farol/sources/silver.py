"""The six conformable source tables and their expected columns."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession

SCHEMAS = {
    "students": "ano bigint, id_aluno string, id_municipio string, id_escola string, rede string, "
                "presenca string, peso_aluno string, alfabetizado string, proficiencia double",
    "municipal": "id_municipio string, ano bigint, serie string, taxa_alfabetizacao string, "
                 "media_portugues string, proporcao_abaixo_basico string, proporcao_basico string, "
                 "proporcao_adequado_avancado string",
    "inse": "id_municipio string, inse string",
    "goals": "escopo string, id_municipio string, ano bigint, meta_alfabetizacao_2030 double, "
             "meta_alfabetizacao_2024 double, percentual_participacao double, nivel_alfabetizacao string",
    "census": "id_municipio string, rede string, ano bigint, tipo_localizacao string, biblioteca int, "
              "biblioteca_sala_leitura int, internet int, agua_potavel int, esgoto_rede_publica int, "
              "energia_rede_publica int",
    "indicators": "id_municipio string, rede string, ano bigint, atu_ef_2_ano double, had_ef_2_ano double, "
                  "tdi_ef_2_ano double, afd_ef_anos_iniciais_grupo_1 double, "
                  "ird_media_regularidade_docente double, icg_nivel_complexidade_gestao_escola string, "
                  "dsu_ef_anos_iniciais double, taxa_reprovacao_ef_2_ano double, "
                  "taxa_abandono_ef_2_ano double",
}


@dataclass(frozen=True)
class Silver:
    """Source tables of the mart, as received."""

    students: DataFrame
    municipal: DataFrame
    inse: DataFrame
    goals: DataFrame
    census: DataFrame
    indicators: DataFrame


def read_silver(spark: SparkSession, base: str, fmt: str = "parquet") -> Silver:
    """Read ``<base>/<table>`` with the declared schemas; no inference pass."""
    return Silver(**{
        f.name: spark.read.schema(SCHEMAS[f.name]).format(fmt).load(f"{base}/{f.name}")
        for f in fields(Silver)
    })
