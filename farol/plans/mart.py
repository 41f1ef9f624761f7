"""The feature mart: students joined to every context, row count preserved."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farol import constants as K
from farol.functions import conform as C
from farol.operators import dimensions as D
from farol.operators.joins import BROADCAST_MAX_ROWS, cell_join, cell_ranges, deal_rows, hot_keys, lookup_join
from farol.sources.silver import Silver
from farol.sources.sinks import deal, read_table, stage, write_mart

MART_SCHEMA = (
    "ano bigint, id_aluno string, id_municipio string, sigla_uf_code string, id_escola string, "
    "rede string, presenca string, peso_aluno double, alfabetizado string, inse_municipio double, "
    "taxa_alfabetizacao_municipio double, media_portugues_municipio double, "
    "proporcao_abaixo_basico double, proporcao_basico double, proporcao_adequado_avancado double, "
    "taxa_alfabetizacao_escola_prior double, n_alunos_prior_escola bigint, tem_historico_escola int, "
    "meta_2030 double, meta_2024 double, percentual_participacao double, nivel_alfabetizacao bigint, "
    "gap_meta_2030 double, pct_escolas_rurais double, pct_escolas_biblioteca double, "
    "pct_escolas_internet double, pct_escolas_agua_potavel double, pct_escolas_esgoto_publico double, "
    "pct_escolas_energia_publica double, n_escolas_censo_celula bigint, atu_2ano double, "
    "had_2ano double, tdi_2ano double, afd_grupo1_pct double, ird_medio double, dsu_medio double, "
    "icg_medio double, taxa_reprovacao_2ano_prior double, taxa_abandono_2ano_prior double, "
    "tem_censo_escolar int"
)
MART_COLUMNS = [field.split()[0] for field in MART_SCHEMA.split(", ")]


def student_fields(students: DataFrame) -> DataFrame:
    """Student-edition rows, absentees too; the municipality is still the code as received."""
    return students.where(F.col("id_municipio").isNotNull() & F.col("id_aluno").isNotNull()).select(
        C.hard_long("ano").alias("ano"),
        "id_aluno",
        "id_municipio",
        C.integer_key("id_escola").alias("id_escola"),
        C.network("rede").alias("rede"),
        "presenca",
        C.decimal_text("peso_aluno").alias("peso_aluno"),
        "alfabetizado",
    )


def municipal_keys(rows: DataFrame) -> DataFrame:
    """The three keys held in the code of the municipality; made where they are needed, so that one text travels."""
    return rows.withColumns({
        "id_municipio": C.key6("id_municipio"),
        "sigla_uf_code": C.state_code("id_municipio"),
        "id_municipio_7dig": C.key7("id_municipio"),
    })


def student_rows(students: DataFrame) -> DataFrame:
    """Student-edition rows with every key conformed once; absentees stay."""
    return municipal_keys(student_fields(students))


def cell_place() -> Column:
    """Text in whose order the mart is stored: year, municipality, network; a missing one comes first."""
    year, code = F.lpad(F.col("ano").cast("string"), 20, "0"), C.key6("id_municipio")
    return F.concat_ws("|", *[F.coalesce(part, F.lit("")) for part in (year, code, F.col("rede"))])


def join_history(rows: DataFrame, by_school: DataFrame, prior_rows: int, max_rows: int) -> DataFrame:
    """Last year's rate of the same school; a gap year gives no history."""
    return lookup_join(
        rows, D.school_prior(by_school), prior_rows, ["id_escola", "ano"],
        ["id_aluno", "peso_aluno"], hot_keys(by_school, ["id_escola", "ano"]), max_rows,
    ).withColumn("tem_historico_escola", C.hit("n_alunos_prior_escola"))


def join_contexts(
    rows: DataFrame, counts: DataFrame, contexts: list[tuple[DataFrame, int, list[str]]], spread: list[str], max_rows: int,
) -> DataFrame:
    """J1, J2, J4-J7 in one shuffle of the student rows, by the ranges of cells in which they are stored.

    ``counts`` holds each cell of the rows once, NULL keys included, so the
    contexts are joined to it and every row finds its cell.
    """
    keys = ["id_municipio", *D.CELL]
    found = counts
    for dim, dim_rows, on in contexts:
        hot = None if dim_rows <= max_rows else hot_keys(counts.groupBy(*on).agg(F.count(F.lit(1)).alias("n")), on)
        found = lookup_join(found, dim, dim_rows, on, keys, hot, max_rows)
    context, cells = stage(found, "context")
    ranges = cell_ranges(context, cell_place())
    dealt = municipal_keys(deal_rows(rows, ranges, cell_place(), spread))
    return cell_join(dealt, context.drop("n"), cells, keys, ranges, cell_place(), max_rows)


def build_mart(
    silver: Silver, years: D.Years = None, lag_years: int = 0, max_rows: int = BROADCAST_MAX_ROWS,
) -> DataFrame:
    """Mart rows in the published column order, dealt by the ranges in which they are stored.

    The dimensions are written first, so their sizes are known when each join
    is chosen. Within the bound student rows are dealt while they are narrow
    and no join moves them. Beyond it one count of the student rows, written
    before the first join, gives the cells that occur; the contexts meet there,
    as small tables. Narrow student rows then move twice: to their school, and
    to their range of cells, where they meet their context and stay.
    """
    dims = {
        "inse": D.municipal_inse(silver.inse),
        "year-context": D.year_context(silver.municipal, silver.goals, lag_years),
        "cell-context": D.cell_context(silver.census, silver.indicators, years),
        "school-year": D.school_year(silver.students),
    }
    # Independent jobs: submitted together, they fill the cluster while each waits for its last tasks.
    with ThreadPoolExecutor(len(dims)) as pool:
        staged = pool.map(lambda item: stage(item[1], item[0]), dims.items())
        (inse, inse_rows), (year, year_rows), (cell, cell_rows), (school, school_rows) = staged
    spread = ["id_aluno", "peso_aluno"]

    rows = student_fields(silver.students)
    contexts = [(inse, inse_rows, ["id_municipio"]), (year, year_rows, ["id_municipio", "ano"]), (cell, cell_rows, D.CELL)]
    if max(inse_rows, year_rows, cell_rows, school_rows) > max_rows:
        counts, _ = stage(
            municipal_keys(rows).groupBy("id_municipio", *D.CELL).agg(F.count(F.lit(1)).alias("n")), "key-counts"
        )
        rows = join_contexts(join_history(rows, school, school_rows, max_rows), counts, contexts, spread, max_rows)
    else:
        rows = municipal_keys(deal(rows, C.key6("id_municipio")))
        for dim, dim_rows, keys in contexts:
            rows = lookup_join(rows, dim, dim_rows, keys, spread, None, max_rows)
        rows = join_history(rows, school, school_rows, max_rows)
    return rows.withColumns({
        "gap_meta_2030": C.gap("taxa_alfabetizacao_municipio", "meta_2030"),
        "tem_censo_escolar": F.coalesce("tem_censo_escolar", F.lit(0)),
    }).select(*MART_COLUMNS)


def save_mart(silver: Silver, path: str, **options) -> int:
    """Build and write the mart; returns the rows written."""
    return write_mart(build_mart(silver, **options), path, dealt=True)


def load_mart(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, MART_SCHEMA)


def model_scan(mart: DataFrame) -> DataFrame:
    """Columns the models and reports use, in-scope networks only."""
    wanted = [K.GROUP, *K.FEATURES, *K.GOAL_COLUMNS, *K.ID_COLUMNS, K.TARGET]
    return mart.where(F.col("rede").isin(K.SCOPE_NETWORKS)).select(*wanted)


def profile_scan(mart: DataFrame) -> DataFrame:
    """The narrower scan of the exploratory profile."""
    wanted = [*K.PROFILE_FEATURES, *K.CATEGORICAL_FEATURES, K.TARGET]
    return mart.where(F.col("rede").isin(K.SCOPE_NETWORKS)).select(*wanted)


def goal_scan(mart: DataFrame) -> DataFrame:
    """Goal and mean gap per municipality, weighted by students."""
    return mart.where(F.col("rede").isin(K.SCOPE_NETWORKS)).groupBy("id_municipio").agg(
        F.max("meta_2030").alias("meta_2030"), F.avg("gap_meta_2030").alias("gap_meta_2030")
    )


def key_audit(tables: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """Q5: rows and repeated keys per dimension; no repeats means joins keep the row count."""
    out = None
    for name, (df, keys) in tables.items():
        part = (
            df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
            .agg(
                F.coalesce(F.sum("n"), F.lit(0)).alias("linhas"),
                F.count(F.when(F.col("n") > 1, 1)).alias("chaves_repetidas"),
            )
            .select(F.lit(name).alias("tabela"), "*")
        )
        out = part if out is None else out.unionByName(part)
    return out
