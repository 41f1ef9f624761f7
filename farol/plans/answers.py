"""Policy answers from a scored population (Q2, Q3 and Q4 of the programme)."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from farol import constants as K
from farol.operators import models, policy
from farol.plans.mart import goal_scan
from farol.plans.training import split_frames
from farol.sources.sinks import stage, write_csv


def scored_view(mart: DataFrame, model: PipelineModel) -> tuple[DataFrame, int]:
    """Municipal view of the scored test rows, written once for the reports that share it."""
    _, test = split_frames(mart, ["id_municipio", "ano"])
    return stage(policy.municipal_view(models.score(model, test), goal_scan(mart)), "municipal-view")


def policy_reports(mart: DataFrame, model: PipelineModel, out: str | None = None) -> dict[str, DataFrame]:
    """Ranking, state risk, clusters, contingency, goal tiers and the high-risk list."""
    view, rows = scored_view(mart, model)
    assigned, profile = policy.clusters(view)
    projected = policy.goal_projection(view)
    reports = {
        "q2_ranking_municipios_risco": policy.risk_ranking(view, rows),
        "q2_risco_por_uf": policy.risk_by_state(view),
        "q3_perfil_clusters": profile,
        "q3_municipios_por_cluster": assigned.select(
            "id_municipio", "uf", "cluster", "perfil", "risco_medio", "taxa_alfabetizacao_real", "inse_municipio"
        ),
        "q3_composicao_uf_cluster": policy.contingency(assigned, "uf", "perfil", K.CLUSTER_NAMES),
        "q4_resumo_metas_2030": policy.tier_mix(projected),
        "q4_municipios_risco_meta": policy.goal_risk_list(projected),
    }
    if out:
        for name, table in reports.items():
            write_csv(table, f"{out}/{name}")
    return reports
