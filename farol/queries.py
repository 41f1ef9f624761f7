"""Every operator as a named query over the star-schema tables in ``base``."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farol import constants as K
from farol.functions import conform as C
from farol.functions import rules
from farol.operators import dimensions as D
from farol.operators import experiment, explain, joins, metrics, models, order, policy, prepare, profile, search, split, trees
from farol.plans import eda
from farol.plans import mart as M
from farol.plans import training
from farol.plans.gold_models import gold_model, gold_models
from farol.session import new_path
from farol.sources import sinks
from farol.sources.gold import gold_mart
from farol.sources.star import LABEL_CUT, Star
from farol.sources.states import states

EXTRA_MEASURES = ["icg_medio", "taxa_reprovacao_2ano_prior", "taxa_abandono_2ano_prior"]
LINEAR_WEIGHTS = {"peso_aluno": 0.04, "inse_municipio": 0.3, "meta_2024": -0.01, "atu_2ano": 0.02}
TEXT_KEYS = ["ano", "id_aluno", "id_municipio", "id_escola", "rede", "presenca", "alfabetizado", "peso_aluno"]
TRIALS = 14
# Trees of the supplied ensemble: tree, node, feature (place in LINEAR_WEIGHTS), threshold, left, right, value.
SUPPLIED_TREES = [
    (0, 0, 1, 4.2, 1, 4, 0.0), (0, 1, 0, 25.0, 2, 3, 0.0), (0, 2, None, None, None, None, 0.2), (0, 3, None, None, None, None, 0.6),
    (0, 4, 2, 56.0, 5, 6, 0.0), (0, 5, None, None, None, None, 0.5), (0, 6, None, None, None, None, 0.9),
    (1, 0, 0, 13.0, 1, 2, 0.0), (1, 1, None, None, None, None, 0.3), (1, 2, 0, 38.0, 3, 4, 0.0), (1, 3, None, None, None, None, 0.7),
    (1, 4, 1, 4.2, 5, 6, 0.0), (1, 5, None, None, None, None, 0.4), (1, 6, None, None, None, None, 0.8),
]


# Means of short decimals often end in an exact 5 at the digit after the last one
# kept, where the last bit of a sum would decide the result. The nudge is far
# below that digit and takes such means off the edge.
NUDGE = 3e-9


def _r(c: Column | str, digits: int = 6) -> Column:
    return F.round((F.col(c) if isinstance(c, str) else c) + NUDGE, digits)


def _rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded: the last bits of a sum depend on the order of the rows."""
    return df.select(*[_r(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def _silver(spark: SparkSession, base: str) -> Star:
    return Star(spark, base)


def _scope(spark: SparkSession, base: str) -> DataFrame:
    return gold_mart(spark, base).where(F.col("rede").isin(K.SCOPE_NETWORKS))


def _scored(spark: SparkSession, base: str) -> DataFrame:
    """In-scope mart rows with two closed-form scores: with and without the row weight."""
    rest = (F.col("id_escola").cast("bigint") % 97).cast("double") / 97
    return _scope(spark, base).withColumns({
        "label": rules.strict_label(), "prob_alfabetizado": (F.col("peso_aluno") + rest) / 51, "prob_sem_peso": rest,
    })


def _view(spark: SparkSession, base: str) -> DataFrame:
    return policy.municipal_view(split.test_rows(_scored(spark, base)), M.goal_scan(gold_mart(spark, base)))


# --- sources and sinks -------------------------------------------------------------------------


def s1_mart_scan(spark, base):
    mart, keys, measures = M.model_scan(gold_mart(spark, base)), ["ano", "rede", "sigla_uf_code"], [*K.NUMERIC_FEATURES, *K.GOAL_COLUMNS]
    means = mart.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *[_r(F.avg(c)).alias(c) for c in measures])
    # Students are counted apart: in one aggregate the sums of all measures would travel once for each of them.
    students = mart.select(*keys, K.GROUP).distinct().groupBy(*keys).agg(F.count(K.GROUP).alias("alunos"))
    same = reduce(and_, [F.col(f"m.{c}").eqNullSafe(F.col(f"s.{c}")) for c in keys])
    return means.alias("m").join(students.alias("s"), same).select(*[f"m.{c}" for c in [*keys, "n"]], "alunos", *measures)


def s2_profile_scan(spark, base):
    mart = M.profile_scan(gold_mart(spark, base))
    return mart.groupBy(*K.CATEGORICAL_FEATURES, K.TARGET).agg(
        F.count(F.lit(1)).alias("n"), *[_r(F.avg(c)).alias(c) for c in K.PROFILE_FEATURES]
    )


def s3_goal_scan(spark, base):
    return _rounded(M.goal_scan(gold_mart(spark, base)))


def s5_sink_roundtrip(spark, base):
    path = new_path(spark, "mart-copy")
    written = M.save_mart(_silver(spark, base).kept(), path)
    return M.load_mart(spark, path).groupBy("ano").agg(
        F.count(F.lit(1)).alias("linhas"), F.countDistinct("id_municipio").alias("municipios"),
        _r(F.avg("gap_meta_2030")).alias("gap"),
    ).withColumn("linhas_gravadas", F.lit(written).cast("bigint"))


def s7_csv_roundtrip(spark, base):
    path = new_path(spark, "csv")
    rates = _rounded(profile.state_rates(_scope(spark, base)))
    sinks.write_csv(rates, path)
    return sinks.read_csv(spark, path, rates.schema)


def s8_json_roundtrip(spark, base):
    path = new_path(spark, "json")
    nested = _rounded(profile.state_rates(_scope(spark, base))).select("uf", F.struct("n", "taxa").alias("resumo"))
    sinks.write_json(nested, path)
    return sinks.read_json(spark, path, nested.schema).select("uf", "resumo.n", "resumo.taxa")


def s9_model_roundtrip(spark, base):
    _, test = training.split_frames(gold_mart(spark, base))
    model = gold_model(spark, base, "logistic")
    path = new_path(spark, "model")
    models.save(model, path)
    before = models.score(model, test).withColumnRenamed("prob_alfabetizado", "_antes")
    after = models.score(models.load(spark, path), before)
    return after.agg(
        F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("_antes") != F.col("prob_alfabetizado"), 1)).alias("diferentes"),
    )


def s10_state_dimension(spark, base):
    seen = _scope(spark, base).groupBy("sigla_uf_code").agg(F.count(F.lit(1)).alias("n"))
    return seen.join(F.broadcast(states(spark)), "sigla_uf_code", "full").select("sigla_uf_code", "uf", "n")


# --- scalar expressions ------------------------------------------------------------------------


def e1_locale_decimal(spark, base):
    m = _silver(spark, base).municipal
    return m.groupBy(C.key6("id_municipio").alias("id_municipio"), "serie").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count(C.decimal_text(c)).alias(f"n_{c}") for c in ("taxa_alfabetizacao", "media_portugues")],
        *[_r(F.avg(C.decimal_text(c))).alias(c) for c in D.MUNICIPAL_MEASURES],
    )


def e2_key_conformance(spark, base):
    s = _silver(spark, base).students
    return s.groupBy(
        C.key6("id_municipio").alias("id6"), C.key7("id_municipio").alias("id7"),
        C.state_code("id_municipio").alias("uf"),
    ).agg(
        F.count(F.lit(1)).alias("n"), F.min(C.integer_key("id_escola")).alias("menor_escola"),
        F.max(C.integer_key("id_escola")).alias("maior_escola"), F.min(C.network("rede")).alias("rede_menor"),
    )


def e4_integer_key(spark, base):
    # Grades, labels and decimal texts are not integers; years and codes are.
    i = _silver(spark, base).indicators
    return i.groupBy("icg_nivel_complexidade_gestao_escola").agg(
        F.count(C.integer_key("icg_nivel_complexidade_gestao_escola")).alias("n_rotulo"),
        F.count(C.integer_key("id_municipio")).alias("n_codigo"),
        F.count(C.integer_key(F.col("atu_ef_2_ano").cast("string"))).alias("n_decimal"),
    )


def e6_network_title(spark, base):
    i = _silver(spark, base).indicators
    return i.groupBy("rede").agg(F.count(F.lit(1)).alias("n")).withColumn("titulo", C.network_title("rede"))


def e7_domain_recode(spark, base):
    c = _silver(spark, base).census
    return c.groupBy("rede").agg(F.count(F.lit(1)).alias("n")).withColumn("nome", C.network_from_code("rede"))


def e8_indicator_flags(spark, base):
    c = _silver(spark, base).census
    library = (F.col("biblioteca") == 1) | (F.col("biblioteca_sala_leitura") == 1)
    return c.groupBy("rede", "tipo_localizacao").agg(
        F.count(F.lit(1)).alias("n"),
        _r(F.avg(C.indicator(library))).alias("qualquer_biblioteca"),
        _r(F.avg(C.indicator(F.col("internet") == 1))).alias("internet_nulo_conta"),
        _r(F.avg(C.safe_double("internet"))).alias("internet_nulo_fora"),
    )


def e9_safe_casts(spark, base):
    i = _silver(spark, base).indicators
    return i.groupBy("ano").agg(
        F.count(F.lit(1)).alias("n"),
        F.count(C.text_double("icg_nivel_complexidade_gestao_escola")).alias("n_icg"),
        _r(F.avg(C.text_double("icg_nivel_complexidade_gestao_escola"))).alias("icg"),
        F.count(C.safe_double("tdi_ef_2_ano")).alias("n_tdi"),
    )


def e11_year_shift(spark, base):
    s = _silver(spark, base).students
    return s.groupBy(C.hard_long("ano").alias("ano")).agg(F.count(F.lit(1)).alias("n")).withColumn(
        "ano_alvo", F.col("ano") + 1
    )


def e12_hit_and_gap(spark, base):
    return gold_mart(spark, base).groupBy("ano", "tem_historico_escola", "tem_censo_escolar").agg(
        F.count(F.lit(1)).alias("n"), F.count("gap_meta_2030").alias("n_gap"),
        _r(F.avg("gap_meta_2030")).alias("gap"), _r(F.avg("n_alunos_prior_escola")).alias("prior"),
    )


def e14_label_maps(spark, base):
    s = _silver(spark, base).students
    return s.groupBy("alfabetizado").agg(
        F.count(F.lit(1)).alias("n"), F.sum(rules.strict_label()).alias("estrito"),
        F.sum(rules.label_or_null()).alias("tolerante"), F.count(rules.label_or_null("presenca")).alias("desconhecido"),
    )


def e16_risk_clip_decide(spark, base):
    p = F.col("prob_alfabetizado")
    return _scored(spark, base).groupBy("sigla_uf_code").agg(
        _r(F.avg(rules.risk(p))).alias("risco"), _r(F.avg(rules.clip_upper(p, 0.5))).alias("p_limitada"),
        F.sum(rules.decide(p, 0.55)).alias("positivos"),
    ).withColumn("uf", rules.state_name("sigla_uf_code"))


def e19_rounding(spark, base):
    # Eighths are exact in binary, so the ties are real ones.
    eighth = F.col("peso_aluno") / 8
    return gold_mart(spark, base).groupBy("peso_aluno").agg(F.count(F.lit(1)).alias("n")).select(
        "peso_aluno", "n", rules.round_even(eighth, 2).alias("par"), rules.round_away(eighth, 2).alias("afastado"),
    )


def e20_safe_divide(spark, base):
    absent = F.count(F.when(F.col("presenca") == "Ausente", 1))
    present = F.count(F.when(F.col("presenca") == "Presente", 1))
    return gold_mart(spark, base).groupBy("id_aluno", "ano").agg(
        _r(rules.share(present, absent)).alias("presentes_por_ausente"), F.count(F.lit(1)).alias("n")
    )


def e23_readable_names(spark, base):
    slots = gold_mart(spark, base).select(F.explode(F.array(
        F.concat(F.lit("categorical__sigla_uf_code_"), "sigla_uf_code"),
        F.concat(F.lit("categorical__rede_"), "rede"),
        F.when(F.col("peso_aluno").isNotNull(), "numeric__peso_aluno"),
    )).alias("variavel"))
    return slots.groupBy("variavel").agg(F.count(F.lit(1)).alias("n")).withColumn(
        "rotulo", rules.readable_feature("variavel")
    )


# --- dimensions and joins ----------------------------------------------------------------------


def a1_municipal_same_year(spark, base):
    return _rounded(D.municipal_year(_silver(spark, base).municipal))


def a2_school_prior_rate(spark, base):
    return _rounded(D.school_prior(D.school_year(_silver(spark, base).students)))


def a3_inse(spark, base):
    return _rounded(D.municipal_inse(_silver(spark, base).inse))


def a4_goals(spark, base):
    return _rounded(D.municipal_goals(_silver(spark, base).goals))


def a5_census_cell(spark, base):
    return _rounded(D.census_cells(_silver(spark, base).census))


def a6_indicator_cell(spark, base):
    return _rounded(D.indicator_cells(D.indicator_base(_silver(spark, base).indicators, (1996, 1999)), (1996, 1999)))


def a7_lagged_outcome(spark, base):
    return _rounded(D.lagged_outcomes(D.indicator_base(_silver(spark, base).indicators, (1996, 1999)), (1996, 1999)))


def _joined(spark, base, dim: DataFrame, keys: list[str], name: str) -> DataFrame:
    rows = M.student_rows(_silver(spark, base).students)
    staged, n = sinks.stage(dim, name)
    return joins.lookup_join(rows, staged, n, keys, ["id_aluno", "peso_aluno"])


def j1_inse_join(spark, base):
    out = _joined(spark, base, D.municipal_inse(_silver(spark, base).inse), ["id_municipio"], "inse")
    return out.groupBy("ano", "sigla_uf_code").agg(
        F.count(F.lit(1)).alias("n"), F.count("inse_municipio").alias("achados"),
        _r(F.avg("inse_municipio")).alias("inse"),
    )


def j2_same_year_join(spark, base):
    out = _joined(
        spark, base, D.municipal_year(_silver(spark, base).municipal), ["id_municipio", "ano"], "municipal-year"
    )
    return out.groupBy("ano", "sigla_uf_code").agg(
        F.count(F.lit(1)).alias("n"), F.count("taxa_alfabetizacao_municipio").alias("achados"),
        _r(F.avg("taxa_alfabetizacao_municipio")).alias("taxa"),
    )


def j2_salted_join(spark, base):
    """Shuffled, with hot keys in small pieces and absentees without a key."""
    silver, keys = _silver(spark, base), ["id_municipio", "ano"]
    present = F.when(F.col("presenca") == "Presente", F.col("id_municipio"))
    rows = M.student_rows(silver.students).withColumn("id_municipio", present)
    hot = joins.hot_keys(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")), keys, piece_rows=10)
    out = joins.salted_left_join(rows, D.municipal_year(silver.municipal), keys, hot, ["id_aluno", "peso_aluno"])
    return out.groupBy("ano", "sigla_uf_code").agg(
        F.count(F.lit(1)).alias("n"), F.count("taxa_alfabetizacao_municipio").alias("achados"),
        _r(F.avg("taxa_alfabetizacao_municipio")).alias("taxa"),
    )


def j3_prior_year_join(spark, base):
    silver = _silver(spark, base)
    by_school, n = sinks.stage(D.school_year(silver.students), "school-year")
    out = M.join_history(M.student_rows(silver.students), by_school, n, joins.BROADCAST_MAX_ROWS)
    return out.groupBy("ano", "sigla_uf_code", "tem_historico_escola").agg(
        F.count(F.lit(1)).alias("n"), F.sum("n_alunos_prior_escola").alias("alunos_prior"),
        _r(F.avg("taxa_alfabetizacao_escola_prior")).alias("taxa_prior"),
    )


def j3_salted_join(spark, base):
    """The same join with the broadcast ruled out: shuffled, hot and NULL keys in pieces."""
    silver = _silver(spark, base)
    by_school, n = sinks.stage(D.school_year(silver.students), "school-year")
    out = M.join_history(M.student_rows(silver.students), by_school, n, 0)
    return out.groupBy("ano", "sigla_uf_code", "tem_historico_escola").agg(
        F.count(F.lit(1)).alias("n"), F.sum("n_alunos_prior_escola").alias("alunos_prior"),
        _r(F.avg("taxa_alfabetizacao_escola_prior")).alias("taxa_prior"),
    )


def j4_goals_join(spark, base):
    out = _joined(spark, base, D.municipal_goals(_silver(spark, base).goals), ["id_municipio", "ano"], "goals")
    return out.groupBy("ano", "sigla_uf_code").agg(
        F.count(F.lit(1)).alias("n"), F.count("meta_2030").alias("achados"), _r(F.avg("meta_2024")).alias("meta_2024"),
        F.count("nivel_alfabetizacao").alias("niveis"), F.max("nivel_alfabetizacao").alias("maior_nivel"),
    )


def j5_j7_cell_joins(spark, base):
    silver = _silver(spark, base)
    out = _joined(spark, base, D.cell_context(silver.census, silver.indicators), D.CELL, "cell-context")
    measures = ["pct_escolas_rurais", "n_escolas_censo_celula", "atu_2ano", "tdi_2ano", "icg_medio", *EXTRA_MEASURES[1:]]
    return out.groupBy("ano", "rede").agg(
        F.count(F.lit(1)).alias("n"), F.sum("tem_censo_escolar").alias("com_censo"),
        *[F.count(c).alias(f"n_{c}") for c in measures], *[_r(F.avg(c)).alias(c) for c in measures],
    )


def mart_rollup(spark, base):
    return gold_mart(spark, base).groupBy("ano", "rede").agg(
        F.count(F.lit(1)).alias("n"), F.sum("tem_historico_escola").alias("com_historico"),
        F.sum("tem_censo_escolar").alias("com_censo"),
        *[F.count(c).alias(f"n_{c}") for c in [*K.NUMERIC_FEATURES, *EXTRA_MEASURES]],
        *[_r(F.avg(c)).alias(c) for c in [*K.NUMERIC_FEATURES, *EXTRA_MEASURES, "gap_meta_2030"]],
    )


def q5_row_preservation(spark, base):
    s = _silver(spark, base)
    students = M.student_rows(s.students)
    return M.key_audit({
        "inse": (D.municipal_inse(s.inse), ["id_municipio"]),
        "municipio_ano": (D.year_context(s.municipal, s.goals), ["id_municipio", "ano"]),
        "celula": (D.cell_context(s.census, s.indicators), D.CELL),
        "escola_ano": (D.school_prior(D.school_year(s.students)), ["id_escola", "ano"]),
        "alunos": (students, ["id_aluno", "ano"]),
        "mart": (gold_mart(spark, base), ["id_aluno", "ano"]),
    })


def j8_goal_merge(spark, base):
    return _rounded(_view(spark, base).select("id_municipio", "uf", "meta_2030", "gap_meta_2030"))


def j10_state_rates(spark, base):
    return _rounded(joins.rates_for_all_states(profile.state_rates(_scope(spark, base)), states(spark)))


def j11_states_without_data(spark, base):
    return joins.states_without_data(profile.state_rates(_scope(spark, base)), states(spark))


def j12_split_overlap(spark, base):
    rows = _scope(spark, base)
    return joins.common_keys(split.train_rows(rows), split.test_rows(rows), K.GROUP).agg(
        F.count(F.lit(1)).alias("alunos_em_comum")
    )


def u2_returning_students(spark, base):
    rows = gold_mart(spark, base)
    return joins.common_keys(rows.where("ano < 1995"), rows.where("ano >= 1995"), K.GROUP)


def j13_key_match(spark, base):
    s = _silver(spark, base)
    key = "chave"
    students = s.students.select(C.key7("id_municipio").alias(key))
    school = s.students.select(C.integer_key("id_escola").alias(key))
    census = s.census.select(C.key7("id_municipio").alias(key))
    inse = s.inse.select(C.key7("id_municipio").alias(key))
    return (
        joins.key_match(students, census, key, "alunos x censo")
        .unionByName(joins.key_match(inse, census, key, "inse x censo"))
        .unionByName(joins.key_match(school, census, key, "escola x municipio"))
    )


# --- profile and audits ------------------------------------------------------------------------


def a13_duplicate_students(spark, base):
    return profile.duplicate_students(_scope(spark, base))


def a14_rate_by_network(spark, base):
    return _rounded(profile.positive_rate(_scope(spark, base), "rede").orderBy(F.desc("taxa")))


def a15_rate_by_state(spark, base):
    return _rounded(profile.state_rates(_scope(spark, base)))


def a15_rate_range(spark, base):
    return _rounded(profile.rate_range(profile.state_rates(_scope(spark, base))))


def a16_null_profile(spark, base):
    return profile.null_profile(gold_mart(spark, base), [*K.FEATURES, *EXTRA_MEASURES])


def f9_columns_with_nulls(spark, base):
    return profile.columns_with_nulls(_scope(spark, base), [*K.FEATURES, *EXTRA_MEASURES])


def a17_target_mix(spark, base):
    return _rounded(profile.value_shares(_scope(spark, base), K.TARGET))


def a18_describe(spark, base):
    return _rounded(profile.describe(_scope(spark, base), K.PROFILE_FEATURES))


def a19_correlations(spark, base):
    return _rounded(profile.correlations(_scope(spark, base), K.PROFILE_FEATURES))


def a19_target_correlation(spark, base):
    return _rounded(profile.correlation_to_target(_scope(spark, base), K.PROFILE_FEATURES))


def a23_box_stats(spark, base):
    return _rounded(profile.box_stats(_scope(spark, base), "inse_municipio", K.TARGET))


def a24_histogram(spark, base):
    # The mean behind the gap is rounded first, so that both engines bin the same numbers.
    data = _scope(spark, base).withColumn("gap", _r("gap_meta_2030", 4))
    return _rounded(profile.density_histogram(data, "gap", K.TARGET))


def a28_id_audit(spark, base):
    return profile.id_audit(gold_mart(spark, base), ["id_aluno", "id_municipio", "id_escola", "rede", "sigla_uf_code"])


def a29_cell_grain(spark, base):
    return _rounded(profile.cell_grain(D.census_cells(_silver(spark, base).census)))


def a30_coverage(spark, base):
    return _rounded(profile.coverage(_scope(spark, base), [*K.NUMERIC_FEATURES, *EXTRA_MEASURES]))


def a30_coverage_by_year(spark, base):
    return _rounded(profile.coverage_by_year(_scope(spark, base), [*K.NUMERIC_FEATURES, *EXTRA_MEASURES]))


def q1_label_cut(spark, base):
    return _rounded(profile.label_cut(_silver(spark, base).students, LABEL_CUT), 2)


def q2_constant_columns(spark, base):
    return profile.constant_columns(_scope(spark, base), [*K.NUMERIC_FEATURES, *K.GOAL_COLUMNS, "tem_censo_escolar"])


def q2_collinear_pairs(spark, base):
    columns = ["taxa_alfabetizacao_municipio", "gap_meta_2030", "media_portugues_municipio", "meta_2024", "peso_aluno"]
    return _rounded(profile.collinear_pairs(_scope(spark, base), columns))


def q3_missing_proxy(spark, base):
    return _rounded(profile.missing_as_proxy(_scope(spark, base), [*K.NUMERIC_FEATURES, *EXTRA_MEASURES]))


def q4_dense_ids(spark, base):
    return _rounded(profile.dense_ids(gold_mart(spark, base), ["id_aluno", "id_escola", "id_municipio"]))


def m31_profile_bundle(spark, base):
    return _rounded(eda.profile_bundle(M.profile_scan(gold_mart(spark, base))))


# --- splits, samples, preparation --------------------------------------------------------------


def m1_group_split(spark, base):
    return split.group_split(_scope(spark, base)).groupBy("lado").agg(
        F.count(F.lit(1)).alias("linhas"), F.countDistinct(K.GROUP).alias("alunos")
    )


def m2_group_subsample(spark, base):
    kept = split.group_subsample(split.train_rows(_scope(spark, base)), 10_000)
    return kept.groupBy("rede", "ano").agg(F.count(F.lit(1)).alias("linhas"), F.countDistinct(K.GROUP).alias("alunos"))


def m3_stratified_folds(spark, base):
    return split.stratified_group_folds(_scored(spark, base), "label")


def m4_group_folds(spark, base):
    return split.group_folds(_scored(spark, base)).groupBy("fold").agg(
        F.count(F.lit(1)).alias("linhas"), F.countDistinct(K.GROUP).alias("alunos"), F.sum("label").alias("positivos")
    )


def m5_sample_n(spark, base):
    return split.sample_rows(_silver(spark, base).students.select(*TEXT_KEYS), 2000)


def m6_undersample(spark, base):
    rows = _silver(spark, base).students.select(*TEXT_KEYS)
    return split.undersample(rows, K.TARGET, TEXT_KEYS).groupBy(K.TARGET, "rede").agg(F.count(F.lit(1)).alias("n"))


def m7_median_impute(spark, base):
    rows = _scope(spark, base)
    filled = prepare.median_impute(rows, K.BASE_FEATURES)
    means = filled.agg(*[F.avg(c).alias(c) for c in K.BASE_FEATURES]).select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("variavel"), F.col(c).alias("media_preenchida")) for c in K.BASE_FEATURES
    ])))
    return _rounded(prepare.medians(rows, K.BASE_FEATURES).join(means, "variavel"))


def m8_mode_impute(spark, base):
    rows = gold_mart(spark, base).withColumn("nivel", F.col("nivel_alfabetizacao").cast("string"))
    columns = ["rede", "sigla_uf_code", "presenca", "nivel"]
    filled = prepare.mode_impute(rows, columns).groupBy("nivel").agg(F.count(F.lit(1)).alias("n"))
    fitted = prepare.modes(rows, columns).select("variavel", "moda", "n")
    return fitted.unionByName(filled.select(F.lit("nivel preenchido").alias("variavel"), F.col("nivel").alias("moda"), "n"))


def m9_standardise(spark, base):
    columns = ["peso_aluno", "inse_municipio", "meta_2024", "pct_escolas_energia_publica"]
    return prepare.standardise(_scope(spark, base), columns).groupBy("sigla_uf_code").agg(
        *[_r(F.avg(f"{c}_z")).alias(c) for c in columns], _r(F.max("peso_aluno_z")).alias("maior_peso")
    )


def m13_class_weights(spark, base):
    return _rounded(metrics.class_balance(split.train_rows(_scored(spark, base))))


def m14_target_encode_oof(spark, base):
    return _rounded(prepare.target_encoding(split.group_folds(_scored(spark, base)), "id_escola"))


def m11_feature_matrix(spark, base):
    """Slot names of the fitted encoder, with the filled slots of the training rows."""
    train, _ = training.split_frames(gold_mart(spark, base))
    pre = prepare.preprocessor(train, K.NUMERIC_FEATURES, K.CATEGORICAL_FEATURES).fit(train)
    names = prepare.feature_names(pre, K.NUMERIC_FEATURES, K.CATEGORICAL_FEATURES)
    from pyspark.ml.functions import vector_to_array
    slots = pre.transform(train).select(F.posexplode(vector_to_array("features")).alias("slot", "x"))
    labels = F.array(*[F.lit(n) for n in names])
    return slots.groupBy("slot").agg(
        F.count(F.when(F.col("x") != 0, 1)).alias("preenchidos"), _r(F.avg("x"), 4).alias("media")
    ).withColumn("variavel", F.get(labels, F.col("slot")))


# --- measures on supplied scores ---------------------------------------------------------------


def a25_class_balance(spark, base):
    return _rounded(metrics.class_balance(_scored(spark, base)))


def a26_confusion(spark, base):
    return _rounded(metrics.confusion(_scored(spark, base), "label", "prob_alfabetizado", 0.5, ["rede"]))


def a27_roc_auc(spark, base):
    return _rounded(metrics.roc_auc(_scored(spark, base), "label", "prob_alfabetizado", ["rede", "ano"]))


def u1_stacked_measures(spark, base):
    rows = _scored(spark, base)
    parts = [
        metrics.confusion(rows, "label", c).select(F.lit(arm).alias("braco"), "accuracy", "f1_macro")
        for arm, c in (("com_peso_aluno", "prob_alfabetizado"), ("sem_peso_aluno", "prob_sem_peso"))
    ]
    return _rounded(parts[0].unionByName(parts[1]))


def m22_scoring_rule(spark, base):
    ruled = models.apply_rule(_scored(spark, base))
    return ruled.groupBy("predicao_final", "status_risco", "rede").agg(
        F.count(F.lit(1)).alias("n"), F.min("probabilidade_alfabetizado").alias("menor"),
        F.max("probabilidade_alfabetizado").alias("maior"),
    )


def m23_threshold_sim(spark, base):
    return metrics.threshold_simulation(_scored(spark, base), "label", "prob_alfabetizado")


def t5_best_threshold(spark, base):
    sim = metrics.threshold_simulation(_scored(spark, base), "label", "prob_alfabetizado")
    return metrics.best_row(sim, "recall_nao_alfabetizado", "threshold")


def a8_municipal_view(spark, base):
    return _rounded(_view(spark, base))


def m29_risk_ranking(spark, base):
    view, n = sinks.stage(_view(spark, base), "municipal-view")
    return _rounded(policy.risk_ranking(view, n))


def w1_global_rank(spark, base):
    """Row numbers over all students: the range-sorted way, for tables of any size."""
    rows = gold_mart(spark, base).groupBy("id_aluno").agg(F.count(F.lit(1)).alias("n"))
    return order.number_rows(rows, [F.desc("n"), F.col("id_aluno")], "posicao")


def a10_risk_by_state(spark, base):
    return _rounded(policy.risk_by_state(_view(spark, base)))


def t2_top20(spark, base):
    return _rounded(policy.top_risk(_view(spark, base)).select("id_municipio", "uf", "risco_medio"))


def m30_goal_projection(spark, base):
    return _rounded(policy.goal_projection(_view(spark, base)).select(
        "id_municipio", "uf", "taxa_atual", "meta_2030", "ritmo_necessario_aa", "projecao_2030", "atinge_meta_2030",
        "distancia_meta_pp", "classificacao_meta",
    ))


def a12_tier_mix(spark, base):
    return policy.tier_mix(policy.goal_projection(_view(spark, base)))


def t3_high_risk(spark, base):
    # No municipality of these tables is in the highest tier, so the one below it is listed.
    return _rounded(policy.goal_risk_list(policy.goal_projection(_view(spark, base)), K.TIERS[2]).limit(20))


def t4_top_n_rest(spark, base):
    sizes = gold_mart(spark, base).groupBy("id_municipio").agg(F.count(F.lit(1)).alias("linhas"))
    return explain.top_with_rest(sizes, "id_municipio", "linhas")


def a20_contingency(spark, base):
    rows = _scope(spark, base).withColumn("uf", rules.state_name("sigla_uf_code"))
    return _rounded(policy.contingency(rows, "uf", "rede", K.SCOPE_NETWORKS))


# --- comparisons and trial histories -----------------------------------------------------------


def _arms(spark, base) -> DataFrame:
    """AUC of both scores per network, from one pass over the rows."""
    long = _scored(spark, base).select(
        F.col("rede").alias("model"), "label",
        F.col("prob_alfabetizado").alias("com_peso_aluno"), F.col("prob_sem_peso").alias("sem_peso_aluno"),
    ).unpivot(["model", "label"], ["com_peso_aluno", "sem_peso_aluno"], "braco", "score")
    return metrics.roc_auc(long, "label", "score", ["braco", "model"]).withColumnRenamed("roc_auc", "roc_auc_teste")


def a21_arm_delta(spark, base):
    return _rounded(experiment.arm_delta(_arms(spark, base), "com_peso_aluno", "sem_peso_aluno"))


def t6_arm_champion(spark, base):
    return _rounded(metrics.best_row(_arms(spark, base), "roc_auc_teste", "model", ["braco"]).select(
        "braco", "model", "roc_auc_teste"
    ))


def m27_leakage_alarm(spark, base):
    rows = _scored(spark, base)
    test = metrics.roc_auc(split.test_rows(rows), "label", "prob_alfabetizado", ["rede"])
    folds = split.group_folds(split.train_rows(rows))
    cv = metrics.roc_auc(folds, "label", "prob_alfabetizado", ["rede", "fold"]).groupBy("rede").agg(
        F.avg("roc_auc").alias("roc_auc_cv_media")
    )
    both = test.select("rede", F.col("roc_auc").alias("roc_auc_teste")).join(cv, "rede")
    return _rounded(experiment.leakage_alarm(both))


def trial_history(spark, base) -> DataFrame:
    """Trials of a cut-off search: accuracy of each score at each cut in each fold, in one pass."""
    rows = split.group_folds(_scored(spark, base))
    scores = {"random_forest": "prob_alfabetizado", "xgboost": "prob_sem_peso"}
    cuts = {t: (15 + t * 37 % TRIALS * 5) / 100 for t in range(TRIALS)}

    def name(model: str, trial: int) -> str:
        return f"{model}_{trial}"

    wide = rows.groupBy("fold").agg(F.count(F.lit(1)).alias("_n"), *[
        F.count(F.when(rules.decide(c, cut) == F.col("label"), 1)).alias(name(m, t))
        for m, c in scores.items() for t, cut in cuts.items()
    ])
    history = wide.select("fold", F.inline(F.array(*[
        F.struct(
            F.lit(m).alias("model"), F.lit(t).alias("trial"),
            rules.share(F.col(name(m, t)), F.col("_n")).alias("value"), F.lit(4 + t % 5).alias("max_depth"),
            F.lit(f'{{"max_depth": {4 + t % 5}, "corte": {cut}}}').alias("params"),
        ) for m in scores for t, cut in cuts.items()
    ])))
    first = history.where(F.col("fold") == 0)
    usual = first.groupBy("model").agg((F.avg("value") - 0.05).alias("_low"))
    state = first.join(usual, "model").select(
        "model", "trial", F.when(F.col("value") < F.col("_low"), "PRUNED").otherwise("COMPLETE").alias("state")
    )
    return history.join(state, ["model", "trial"])


def w4_running_mean(spark, base):
    return _rounded(search.running_mean(trial_history(spark, base)).select(
        "model", "trial", "fold", "value", "media_parcial", "melhor_parcial"
    ))


def m20_median_stop(spark, base):
    return _rounded(search.median_stop(trial_history(spark, base)).select(
        "model", "trial", "fold", "state", "melhor_parcial", "mediana_anteriores", "completos_antes", "parar"
    ))


def a22_depth_curve(spark, base):
    return _rounded(search.depth_curve(trial_history(spark, base)))


def t5_depth_peak(spark, base):
    return _rounded(search.curve_peak(search.depth_curve(trial_history(spark, base))))


def m21_merge_best(spark, base):
    return _rounded(search.best_per_model(trial_history(spark, base)))


# --- fitted models -----------------------------------------------------------------------------


REPORT = "model string, accuracy double, f1_macro double, recall_nao_alfabetizado double, recall_alfabetizado double, roc_auc double, params string"


def _fit_and_evaluate(spark, base, name: str) -> DataFrame:
    _, test = training.split_frames(gold_mart(spark, base))
    return models.evaluate(models.score(gold_model(spark, base, name), test), name, K.DEFAULT_PARAMS[name])


def m15_logistic(spark, base):
    return _fit_and_evaluate(spark, base, "logistic")


def m16_forest(spark, base):
    return _fit_and_evaluate(spark, base, "random_forest")


def m17_boosted(spark, base):
    return _fit_and_evaluate(spark, base, "xgboost")


def m18_compare(spark, base):
    """The three models side by side; the champion is marked."""
    gold_models(spark, base, [(name, K.FEATURES) for name in K.MODEL_NAMES])
    # One report row per model, each measured once.
    with ThreadPoolExecutor(K.FITS_AT_ONCE) as pool:
        rows = pool.map(lambda name: _fit_and_evaluate(spark, base, name).first(), K.MODEL_NAMES)
        table = spark.createDataFrame(list(rows), REPORT)
    champion = training.champion(table).select("campeao").scalar()
    return table.withColumn("campeao", F.col("model") == champion)


def m19_search(spark, base):
    train, _ = training.split_frames(gold_mart(spark, base))
    sampled = split.group_subsample(train)
    return search.run_search(sampled, "logistic", trials=2, overrides={"max_iter": 20})


def m24_importance(spark, base):
    model = gold_model(spark, base, "random_forest")
    return explain.importance(model, gold_mart(spark, base), K.NUMERIC_FEATURES, K.CATEGORICAL_FEATURES)


def m32_group_importance(spark, base):
    return explain.group_importance(m24_importance(spark, base))


def m25_linear_attribution(spark, base):
    parts = explain.linear_attribution(_scope(spark, base), LINEAR_WEIGHTS, ["sigla_uf_code"])
    return parts.groupBy("sigla_uf_code").agg(
        *[_r(F.avg(f"contrib_{c}")).alias(c) for c in LINEAR_WEIGHTS],
        *[_r(F.avg(F.abs(f"contrib_{c}"))).alias(f"abs_{c}") for c in LINEAR_WEIGHTS],
    )


def m25_tree_attribution(spark, base):
    _, test = training.split_frames(gold_mart(spark, base))
    model = gold_model(spark, base, "random_forest")
    parts = explain.tree_attribution(model, test, K.NUMERIC_FEATURES, K.CATEGORICAL_FEATURES)
    return parts.groupBy("variavel").agg(
        F.count(F.lit(1)).alias("n"), _r(F.avg(F.abs("contribuicao"))).alias("impacto_medio"),
        _r(F.avg("contribuicao")).alias("contribuicao_media"),
    )


def _supplied_trees(spark, base) -> tuple[DataFrame, DataFrame, Column]:
    """Fixed trees over the columns of ``LINEAR_WEIGHTS``, covers counted on the rows in scope; the rows and their features."""
    rows = _scope(spark, base)
    x = F.array(*[F.col(c).cast("double") for c in LINEAR_WEIGHTS])
    nodes = spark.createDataFrame(SUPPLIED_TREES, "tree int, node int, feature int, threshold double, left int, right int, value double").withColumn(
        "weight", F.lit(0.5))
    return trees.with_cover(nodes, rows, x, 3), rows, x


def m16_supplied_trees(spark, base):
    """Scores of a supplied ensemble, read from its node table, per state."""
    nodes, rows, x = _supplied_trees(spark, base)
    return trees.with_score(rows, x, nodes, 3).groupBy("sigla_uf_code").agg(
        F.count(F.lit(1)).alias("n"), _r(F.avg("score")).alias("media"), _r(F.min("score")).alias("menor"),
        _r(F.max("score")).alias("maior"))


def m25_path_attribution(spark, base):
    """Exact contributions to the same ensemble's scores, mean per state, with the base value."""
    nodes, rows, x = _supplied_trees(spark, base)
    paths = trees.paths(nodes)
    sums = trees.path_attribution(rows, x, paths, list(LINEAR_WEIGHTS), ["sigla_uf_code"])
    sizes = rows.groupBy(F.col("sigla_uf_code").alias("uf")).agg(F.count(F.lit(1)).alias("n"))
    return sums.join(sizes, F.col("uf").eqNullSafe(F.col("sigla_uf_code"))).select(
        "sigla_uf_code", "variavel", "n", _r(F.col("contribuicao") / F.col("n")).alias("contribuicao_media"),
        _r(trees.base_value(paths).scalar()).alias("base"))


# The arms' boosted trees are left to the library call: two more fits of 200 rounds take seven minutes on one machine.
ARM_MODELS = ["logistic", "random_forest"]


def _gold_arms(spark, base, arms: dict[str, list[str]]) -> None:
    gold_models(spark, base, [(name, columns) for columns in arms.values() for name in ARM_MODELS])


def m26_ab_block(spark, base):
    train, test = training.split_frames(gold_mart(spark, base))
    arms = {"com_peso_aluno": K.FEATURES, "sem_peso_aluno": [c for c in K.FEATURES if c != "peso_aluno"]}
    _gold_arms(spark, base, arms)
    return experiment.run_arms(train, test, arms, ARM_MODELS, fit=lambda name, columns: gold_model(spark, base, name, columns))


def m26_enrichment_block(spark, base):
    train, test = training.split_frames(gold_mart(spark, base))
    arms = {"enriquecido": K.FEATURES, "baseline": [c for c in K.FEATURES if c not in K.CENSUS_FEATURES]}
    _gold_arms(spark, base, arms)
    return experiment.compare_arms(
        split.dealt(train), test, arms, "enriquecido", "baseline", ARM_MODELS,
        fit=lambda name, columns: gold_model(spark, base, name, columns),
    )


def m28_clusters(spark, base):
    view, _ = sinks.stage(_view(spark, base), "municipal-view")
    _, profile_table = policy.clusters(view)
    return _rounded(profile_table)


QUERIES = [
    s1_mart_scan, s2_profile_scan, s3_goal_scan, s5_sink_roundtrip, s7_csv_roundtrip, s8_json_roundtrip,
    s9_model_roundtrip, s10_state_dimension,
    e1_locale_decimal, e2_key_conformance, e4_integer_key, e6_network_title, e7_domain_recode, e8_indicator_flags,
    e9_safe_casts, e11_year_shift, e12_hit_and_gap, e14_label_maps, e16_risk_clip_decide, e19_rounding,
    e20_safe_divide, e23_readable_names,
    a1_municipal_same_year, a2_school_prior_rate, a3_inse, a4_goals, a5_census_cell, a6_indicator_cell,
    a7_lagged_outcome,
    j1_inse_join, j2_same_year_join, j2_salted_join, j3_prior_year_join, j3_salted_join, j4_goals_join, j5_j7_cell_joins,
    mart_rollup, q5_row_preservation, j8_goal_merge, j10_state_rates, j11_states_without_data, j12_split_overlap,
    u2_returning_students, j13_key_match,
    a13_duplicate_students, a14_rate_by_network, a15_rate_by_state, a15_rate_range, a16_null_profile,
    f9_columns_with_nulls, a17_target_mix, a18_describe, a19_correlations, a19_target_correlation, a23_box_stats,
    a24_histogram, a28_id_audit, a29_cell_grain, a30_coverage, a30_coverage_by_year,
    q1_label_cut, q2_constant_columns, q2_collinear_pairs, q3_missing_proxy, q4_dense_ids, m31_profile_bundle,
    m1_group_split, m2_group_subsample, m3_stratified_folds, m4_group_folds, m5_sample_n, m6_undersample,
    m7_median_impute, m8_mode_impute, m9_standardise, m11_feature_matrix, m13_class_weights, m14_target_encode_oof,
    a25_class_balance, a26_confusion, a27_roc_auc, u1_stacked_measures, m22_scoring_rule, m23_threshold_sim,
    t5_best_threshold, a8_municipal_view, m29_risk_ranking, w1_global_rank, a10_risk_by_state, t2_top20,
    m30_goal_projection, a12_tier_mix, t3_high_risk, t4_top_n_rest, a20_contingency,
    a21_arm_delta, t6_arm_champion, m27_leakage_alarm, w4_running_mean, m20_median_stop, a22_depth_curve,
    t5_depth_peak, m21_merge_best,
    m15_logistic, m16_forest, m17_boosted, m18_compare, m19_search, m24_importance, m32_group_importance,
    m25_linear_attribution, m25_tree_attribution, m16_supplied_trees, m25_path_attribution, m26_ab_block, m26_enrichment_block, m28_clusters,
]


def flagship(spark: SparkSession, base: str) -> DataFrame:
    """Positive rate and history coverage per state, from sources to report in one plan."""
    silver = _silver(spark, base)
    by_school, n = sinks.stage(D.school_year(silver.students), "school-year")
    rows = M.join_history(M.student_rows(silver.students), by_school, n, joins.BROADCAST_MAX_ROWS)
    named = rows.withColumn("uf", rules.state_name("sigla_uf_code")).where(F.col("uf").isNotNull())
    return named.groupBy("uf").agg(
        F.count(F.lit(1)).alias("n"),
        _r(F.avg(C.indicator(F.col(K.TARGET) == "Sim")) * 100).alias("taxa"),
        _r(F.avg("tem_historico_escola") * 100).alias("cobertura_historico"),
        _r(F.avg("taxa_alfabetizacao_escola_prior") * 100).alias("taxa_prior"),
    ).orderBy("uf")
