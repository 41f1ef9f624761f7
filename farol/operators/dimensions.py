"""Sources reduced to the grain they are joined at.

Every aggregate is a partial-then-final hash aggregate, so a municipality or
school holding a large share of the rows is reduced before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farol import constants as K
from farol.functions import conform as C

Years = tuple[int, int] | None

MUNICIPAL_MEASURES = {
    "taxa_alfabetizacao": "taxa_alfabetizacao_municipio",
    "media_portugues": "media_portugues_municipio",
    "proporcao_abaixo_basico": "proporcao_abaixo_basico",
    "proporcao_basico": "proporcao_basico",
    "proporcao_adequado_avancado": "proporcao_adequado_avancado",
}
INDICATOR_MEASURES = {
    "atu_ef_2_ano": "atu_2ano",
    "had_ef_2_ano": "had_2ano",
    "tdi_ef_2_ano": "tdi_2ano",
    "afd_ef_anos_iniciais_grupo_1": "afd_grupo1_pct",
    "ird_media_regularidade_docente": "ird_medio",
    "dsu_ef_anos_iniciais": "dsu_medio",
    "icg_nivel_complexidade_gestao_escola": "icg_medio",
}
OUTCOME_MEASURES = {
    "taxa_reprovacao_ef_2_ano": "taxa_reprovacao_2ano_prior",
    "taxa_abandono_ef_2_ano": "taxa_abandono_2ano_prior",
}
CELL = ["id_municipio_7dig", "rede", "ano"]


def _in_years(c: str, years: Years, back: int = 0) -> Column:
    if years is None:
        return F.lit(True)
    return F.col(c).between(years[0] - back, years[1] - back)


def municipal_year(municipal: DataFrame, lag_years: int = 0) -> DataFrame:
    """A1: means per municipality and year; ``lag_years=1`` serves them one year later."""
    return (
        municipal.where(F.trim("serie") == K.GRADE)
        .groupBy(C.key6("id_municipio").alias("id_municipio"), (C.hard_long("ano") + lag_years).alias("ano"))
        .agg(*[F.avg(C.decimal_text(src)).alias(name) for src, name in MUNICIPAL_MEASURES.items()])
    )


def school_year(students: DataFrame) -> DataFrame:
    """Rows, present rows and positive rate per school and year: one pass feeds A2 and the hot-key list."""
    present = F.col("presenca") == K.PRESENT
    positive = C.indicator(F.col("alfabetizado") == "Sim")
    return students.groupBy(
        C.integer_key("id_escola").alias("id_escola"), C.hard_long("ano").alias("ano")
    ).agg(
        F.count(F.lit(1)).alias("n"),
        F.count(F.when(present, 1)).alias("n_present"),
        F.avg(F.when(present, positive)).alias("rate"),
    )


def school_prior(by_school: DataFrame) -> DataFrame:
    """A2: a school's rate, keyed by the year that may look back at it."""
    return by_school.where(F.col("n_present") > 0).select(
        "id_escola",
        (F.col("ano") + 1).alias("ano"),
        F.col("rate").alias("taxa_alfabetizacao_escola_prior"),
        F.col("n_present").alias("n_alunos_prior_escola"),
    )


def municipal_inse(inse: DataFrame) -> DataFrame:
    """A3: mean socio-economic index per municipality, all years."""
    return (
        inse.where(F.col("id_municipio").isNotNull())
        .groupBy(C.key6("id_municipio").alias("id_municipio"))
        .agg(F.avg(C.decimal_text("inse")).alias("inse_municipio"))
    )


def municipal_goals(goals: DataFrame) -> DataFrame:
    """A4: published goals per municipality and year."""
    return (
        goals.where((F.col("escopo") == K.GOAL_SCOPE) & F.col("id_municipio").isNotNull())
        .groupBy(C.key6("id_municipio").alias("id_municipio"), C.hard_long("ano").alias("ano"))
        .agg(
            F.max("meta_alfabetizacao_2030").alias("meta_2030"),
            F.max("meta_alfabetizacao_2024").alias("meta_2024"),
            F.max("percentual_participacao").alias("percentual_participacao"),
            F.max(C.safe_long("nivel_alfabetizacao")).alias("nivel_alfabetizacao"),
        )
    )


def census_cells(census: DataFrame, years: Years = None) -> DataFrame:
    """A5: school infrastructure per municipality, network and year."""
    library = (F.col("biblioteca") == 1) | (F.col("biblioteca_sala_leitura") == 1)
    return (
        census.where(
            _in_years("ano", years)
            & F.trim(F.col("rede").cast("string")).isin(list(K.NETWORK_OF_CODE))
            & F.col("id_municipio").isNotNull()
        )
        .groupBy(
            C.key7("id_municipio").alias("id_municipio_7dig"),
            C.network_from_code("rede").alias("rede"),
            C.hard_long("ano").alias("ano"),
        )
        .agg(
            F.avg(C.indicator(F.trim(F.col("tipo_localizacao").cast("string")) == K.RURAL_CODE))
            .alias("pct_escolas_rurais"),
            F.avg(C.indicator(library)).alias("pct_escolas_biblioteca"),
            F.avg(C.safe_double("internet")).alias("pct_escolas_internet"),
            F.avg(C.safe_double("agua_potavel")).alias("pct_escolas_agua_potavel"),
            F.avg(C.safe_double("esgoto_rede_publica")).alias("pct_escolas_esgoto_publico"),
            F.avg(C.safe_double("energia_rede_publica")).alias("pct_escolas_energia_publica"),
            F.count(F.lit(1)).alias("n_escolas_censo_celula"),
        )
    )


def indicator_base(indicators: DataFrame, years: Years = None) -> DataFrame:
    """Inputs and outcomes of a cell in one scan, over the target years and the year before them."""
    wanted = _in_years("ano", years) | _in_years("ano", years, back=1)
    measures = {**INDICATOR_MEASURES, **OUTCOME_MEASURES}
    number = {c: C.text_double if t == "string" else C.safe_double for c, t in indicators.dtypes}
    return (
        indicators.where(
            wanted & F.trim("rede").isin(K.INDICATOR_NETWORKS) & F.col("id_municipio").isNotNull()
        )
        .groupBy(
            C.key7("id_municipio").alias("id_municipio_7dig"),
            C.network_title("rede").alias("rede"),
            C.hard_long("ano").alias("ano"),
        )
        .agg(*[F.avg(number[src](src)).alias(name) for src, name in measures.items()])
    )


def indicator_cells(base: DataFrame, years: Years = None) -> DataFrame:
    """Classroom and staff inputs of the same year."""
    return base.where(_in_years("ano", years)).select(*CELL, *INDICATOR_MEASURES.values())


def lagged_outcomes(base: DataFrame, years: Years = None) -> DataFrame:
    """Outcomes of the year before, keyed by the year that may use them."""
    return base.where(_in_years("ano", years, back=1)).select(
        "id_municipio_7dig", "rede", (F.col("ano") + 1).alias("ano"), *OUTCOME_MEASURES.values()
    )


def _merge(parts: list[DataFrame], keys: list[str]) -> DataFrame:
    """Full outer combination of tables unique on the same keys.

    Stacking them and taking MAX is exact, as each measure is set in at most
    one row per key, and needs one shuffle of pre-aggregated rows.
    """
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part, allowMissingColumns=True)
    return stacked.groupBy(*keys).agg(*[F.max(c).alias(c) for c in stacked.columns if c not in keys])


def year_context(municipal: DataFrame, goals: DataFrame, lag_years: int = 0) -> DataFrame:
    """A1 and A4 as one dimension by municipality and year."""
    return _merge([municipal_year(municipal, lag_years), municipal_goals(goals)], ["id_municipio", "ano"])


def cell_context(census: DataFrame, indicators: DataFrame, years: Years = None) -> DataFrame:
    """A5, A6 and A7 as one dimension by municipality, network and year; indicators are read once."""
    base = indicator_base(indicators, years)

    def shaped(lag: int) -> Column:
        kept = OUTCOME_MEASURES if lag else INDICATOR_MEASURES
        measures = [*INDICATOR_MEASURES.values(), *OUTCOME_MEASURES.values()]
        cols = [
            (F.col(m) if m in kept.values() else F.lit(None).cast("double")).alias(m) for m in measures
        ]
        return F.struct((F.col("ano") + lag).alias("ano"), F.lit(lag).alias("lag"), *cols)

    served = base.select(
        "id_municipio_7dig", "rede", F.explode(F.array(shaped(0), shaped(1))).alias("s")
    ).select("id_municipio_7dig", "rede", "s.*")
    # After the shift both shapes are keyed by the year they serve.
    served = served.where(_in_years("ano", years)).drop("lag")
    found = census_cells(census, years).withColumn("tem_censo_escolar", F.lit(1))
    return _merge([found, served], CELL)
