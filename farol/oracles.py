"""DuckDB SQL that states each query's expected result independently of the Spark code."""

from __future__ import annotations

from farol import constants as K

# --- building blocks ---------------------------------------------------------------------------

CODE7 = "cast((s.s_nationkey + 11) * cast(100000 as bigint) + {k} * 10 + {k} % 10 as varchar)"
LINES = "lineitem l join orders o on l.l_orderkey = o.o_orderkey join supplier s on l.l_suppkey = s.s_suppkey"
YEAR = "cast(year(o.o_orderdate) as bigint)"


def by_priority(high: str, mid: str, low: str) -> str:
    return (f"case when o.o_orderpriority in ('1-URGENT', '2-HIGH') then '{high}' "
            f"when o.o_orderpriority in ('3-MEDIUM', '4-NOT SPECIFIED') then '{mid}' else '{low}' end")


def comma(x: str) -> str:
    return f"replace(cast({x} as varchar), '.', ',')"


def num(x: str) -> str:
    return f"try_cast(replace({x}, ',', '.') as double)"


def r(x: str, digits: int = 6) -> str:
    """Rounded, with the same nudge off exact halves as the queries."""
    return f"round(({x}) + 3e-9::double, {digits})"


def h(salt: str, *cols: str) -> str:
    text = " || '|' || ".join(f"cast({c} as varchar)" for c in cols)
    return f"cast('0x' || substr(md5('{salt}|' || {text}), 1, 8) as bigint)"


def state(code: str) -> str:
    cases = " ".join(f"when '{k}' then '{v}'" for k, v in K.STATES.items())
    return f"case {code} {cases} end"


MUN = CODE7.format(k="l.l_suppkey")
SUP = CODE7.format(k="s.s_suppkey")

VIEWS = {
    "students": f"""
        select {YEAR} as ano, cast(o.o_custkey as varchar) as id_aluno, {MUN} as id_municipio,
          cast(l.l_partkey as varchar) as id_escola, {by_priority('Estadual', 'Municipal', 'Federal')} as rede,
          case when l.l_returnflag = 'R' then 'Ausente' else 'Presente' end as presenca,
          {comma('l.l_quantity')} as peso_aluno,
          case when l.l_extendedprice + 1000 * l.l_quantity >= 70000 then 'Sim' else 'Não' end as alfabetizado,
          l.l_extendedprice + 1000 * l.l_quantity as proficiencia
        from {LINES}""",
    "municipal": f"""
        select {MUN} as id_municipio, cast(year(l.l_shipdate) as bigint) as ano,
          case when l.l_linestatus = 'O' then ' 2° ano do Ensino Fundamental '
               else '5° ano do Ensino Fundamental' end as serie,
          case when l.l_linenumber = 7 then 'n/d' else {comma('l.l_extendedprice / 1000')} end as taxa_alfabetizacao,
          {comma('700 + l.l_quantity')} as media_portugues,
          {comma('round(l.l_discount * 100, 1)')} as proporcao_abaixo_basico,
          {comma('round(l.l_tax * 100, 1)')} as proporcao_basico,
          {comma('round(100 - l.l_discount * 100 - l.l_tax * 100, 1)')} as proporcao_adequado_avancado
        from lineitem l join supplier s on l.l_suppkey = s.s_suppkey""",
    "inse": f"""
        select case when s.s_suppkey % 50 = 49 then null else {SUP} end as id_municipio,
          {comma('3 + (s.s_acctbal + 1000) / 5000')} as inse from supplier s""",
    "goals": f"""
        select case when s.s_suppkey % 20 = 0 then 'uf' else 'municipio' end as escopo, {SUP} as id_municipio, y.ano,
          cast(80 as double) as meta_alfabetizacao_2030,
          cast(40 + s.s_suppkey % 40 as double) as meta_alfabetizacao_2024,
          cast(70 + s.s_suppkey % 30 as double) as percentual_participacao,
          case when s.s_suppkey % 11 = 0 then '-' else cast(s.s_suppkey % 6 as varchar) end as nivel_alfabetizacao
        from supplier s cross join (select distinct cast(year(o_orderdate) as bigint) as ano from orders) y""",
    "census": f"""
        select {MUN} as id_municipio, {by_priority('2', '3', '1')} as rede, {YEAR} as ano,
          case when p.p_type in ('SMALL', 'ECONOMY') then '2' else '1' end as tipo_localizacao,
          p.p_size % 2 as biblioteca,
          case when p.p_size % 5 = 0 then null else p.p_size % 3 % 2 end as biblioteca_sala_leitura,
          case when p.p_size % 7 = 0 then null else p.p_size % 2 end as internet,
          p.p_size % 3 % 2 as agua_potavel, p.p_size % 5 % 2 as esgoto_rede_publica, 1 as energia_rede_publica
        from {LINES} join part p on l.l_partkey = p.p_partkey""",
    "indicators": f"""
        select {MUN} as id_municipio, {by_priority(' estadual', 'municipal', 'federal')} as rede, {YEAR} as ano,
          l.l_quantity as atu_ef_2_ano, l.l_tax * 100 as had_ef_2_ano,
          case when p.p_size % 6 = 0 then null else l.l_discount * 100 end as tdi_ef_2_ano,
          cast(p.p_size as double) as afd_ef_anos_iniciais_grupo_1,
          p.p_retailprice / 500 as ird_media_regularidade_docente,
          cast(p.p_size % 50 as double) as dsu_ef_anos_iniciais,
          case when p.p_size % 25 = 0 then '3' else 'Nivel 3' end as icg_nivel_complexidade_gestao_escola,
          case when year(o.o_orderdate) <= 1997 then null else l.l_tax * 100 end as taxa_reprovacao_ef_2_ano,
          l.l_discount * 10 as taxa_abandono_ef_2_ano
        from {LINES} join part p on l.l_partkey = p.p_partkey""",
    "d_mun": f"""
        select substr(id_municipio, 1, 6) as id_municipio, ano,
          avg({num('taxa_alfabetizacao')}) as taxa_alfabetizacao_municipio,
          avg({num('media_portugues')}) as media_portugues_municipio,
          avg({num('proporcao_abaixo_basico')}) as proporcao_abaixo_basico,
          avg({num('proporcao_basico')}) as proporcao_basico,
          avg({num('proporcao_adequado_avancado')}) as proporcao_adequado_avancado
        from municipal where trim(serie) = '2° ano do Ensino Fundamental' group by all""",
    "d_school": """
        select id_escola, ano + 1 as ano, avg((alfabetizado = 'Sim')::int::double) as taxa_alfabetizacao_escola_prior,
          count(*) as n_alunos_prior_escola
        from students where presenca = 'Presente' group by all""",
    "d_inse": f"""
        select substr(id_municipio, 1, 6) as id_municipio, avg({num('inse')}) as inse_municipio
        from inse where id_municipio is not null group by all""",
    "d_goals": """
        select substr(id_municipio, 1, 6) as id_municipio, ano, max(meta_alfabetizacao_2030) as meta_2030,
          max(meta_alfabetizacao_2024) as meta_2024, max(percentual_participacao) as percentual_participacao,
          max(try_cast(nivel_alfabetizacao as bigint)) as nivel_alfabetizacao
        from goals where escopo = 'municipio' and id_municipio is not null group by all""",
    "d_census": """
        select id_municipio as id_municipio_7dig, case rede when '2' then 'Estadual' else 'Municipal' end as rede, ano,
          avg((tipo_localizacao = '2')::int::double) as pct_escolas_rurais,
          avg(coalesce(biblioteca = 1 or biblioteca_sala_leitura = 1, false)::int::double) as pct_escolas_biblioteca,
          avg(internet) as pct_escolas_internet, avg(agua_potavel) as pct_escolas_agua_potavel,
          avg(esgoto_rede_publica) as pct_escolas_esgoto_publico,
          avg(energia_rede_publica) as pct_escolas_energia_publica, count(*) as n_escolas_censo_celula
        from census where rede in ('2', '3') and id_municipio is not null group by all""",
    "d_ind": """
        select id_municipio as id_municipio_7dig,
          case trim(rede) when 'estadual' then 'Estadual' else 'Municipal' end as rede, ano,
          avg(atu_ef_2_ano) as atu_2ano, avg(had_ef_2_ano) as had_2ano, avg(tdi_ef_2_ano) as tdi_2ano,
          avg(afd_ef_anos_iniciais_grupo_1) as afd_grupo1_pct, avg(ird_media_regularidade_docente) as ird_medio,
          avg(dsu_ef_anos_iniciais) as dsu_medio,
          avg(try_cast(icg_nivel_complexidade_gestao_escola as double)) as icg_medio
        from indicators where trim(rede) in ('estadual', 'municipal') and id_municipio is not null group by all""",
    "d_out": """
        select id_municipio as id_municipio_7dig,
          case trim(rede) when 'estadual' then 'Estadual' else 'Municipal' end as rede, ano + 1 as ano,
          avg(taxa_reprovacao_ef_2_ano) as taxa_reprovacao_2ano_prior,
          avg(taxa_abandono_ef_2_ano) as taxa_abandono_2ano_prior
        from indicators where trim(rede) in ('estadual', 'municipal') and id_municipio is not null group by all""",
    "mart": f"""
        select a.ano, a.id_aluno, substr(a.id_municipio, 1, 6) as id_municipio,
          substr(a.id_municipio, 1, 2) as sigla_uf_code, a.id_escola, a.rede, a.presenca,
          {num('a.peso_aluno')} as peso_aluno, a.alfabetizado,
          i.* exclude (id_municipio), m.* exclude (id_municipio, ano), e.* exclude (id_escola, ano),
          (e.id_escola is not null)::int as tem_historico_escola, g.* exclude (id_municipio, ano),
          m.taxa_alfabetizacao_municipio - g.meta_2030 as gap_meta_2030,
          c.* exclude (id_municipio_7dig, rede, ano), x.* exclude (id_municipio_7dig, rede, ano),
          p.* exclude (id_municipio_7dig, rede, ano), (c.ano is not null)::int as tem_censo_escolar
        from students a
        left join d_inse i on substr(a.id_municipio, 1, 6) = i.id_municipio
        left join d_mun m on substr(a.id_municipio, 1, 6) = m.id_municipio and a.ano = m.ano
        left join d_school e on a.id_escola = e.id_escola and a.ano = e.ano
        left join d_goals g on substr(a.id_municipio, 1, 6) = g.id_municipio and a.ano = g.ano
        left join d_census c on a.id_municipio = c.id_municipio_7dig and a.rede = c.rede and a.ano = c.ano
        left join d_ind x on a.id_municipio = x.id_municipio_7dig and a.rede = x.rede and a.ano = x.ano
        left join d_out p on a.id_municipio = p.id_municipio_7dig and a.rede = p.rede and a.ano = p.ano""",
    "escopo": "select * from mart where rede in ('Municipal', 'Estadual')",
    "pontuado": """
        select *, (alfabetizado = 'Sim')::int as label,
          (peso_aluno + cast(cast(id_escola as bigint) % 97 as double) / 97) / 51 as prob_alfabetizado,
          cast(cast(id_escola as bigint) % 97 as double) / 97 as prob_sem_peso
        from escopo""",
    "metas": """
        select id_municipio, max(meta_2030) as meta_2030, avg(gap_meta_2030) as gap_meta_2030
        from escopo group by id_municipio""",
    "lados": f"""
        select *, case when {h('split', 'id_aluno')} < 0.2::double * 4294967296 then 'teste' else 'treino' end as lado
        from pontuado""",
    "municipios": f"""
        select v.*, m.meta_2030, m.gap_meta_2030, {state('substr(v.id_municipio, 1, 2)')} as uf
        from (
          select id_municipio, count(*) as n_alunos_avaliados, avg(1 - prob_alfabetizado) as risco_medio,
            avg(label) * 100 as taxa_alfabetizacao_real,
            arg_max(taxa_alfabetizacao_municipio, ano) filter (taxa_alfabetizacao_municipio is not null)
              as taxa_alfabetizacao_municipio,
            arg_max(inse_municipio, ano) filter (inse_municipio is not null) as inse_municipio,
            arg_max(percentual_participacao, ano) filter (percentual_participacao is not null)
              as percentual_participacao
          from lados where lado = 'teste' group by id_municipio having count(*) >= 20
        ) v left join metas m on v.id_municipio = m.id_municipio""",
    "projecao": """
        select id_municipio, uf, risco_medio, taxa_alfabetizacao_real as taxa_atual, meta_2030,
          (meta_2030 - taxa_alfabetizacao_real) / 6 as ritmo_necessario_aa,
          taxa_alfabetizacao_real + (case when (meta_2030 - taxa_alfabetizacao_real) / 6 > 0 then 0
            else (meta_2030 - taxa_alfabetizacao_real) / 6 end) * 6 as projecao_2030,
          taxa_alfabetizacao_real >= meta_2030 as atinge_meta_2030,
          taxa_alfabetizacao_real - meta_2030 as distancia_meta_pp,
          case when taxa_alfabetizacao_real >= meta_2030 then 'Meta ja atingida'
            when (meta_2030 - taxa_alfabetizacao_real) / 6 <= 3 then 'Provavel atingir'
            when (meta_2030 - taxa_alfabetizacao_real) / 6 <= 7 then 'Risco moderado'
            else 'Risco alto de nao atingir' end as classificacao_meta
        from municipios where meta_2030 is not null and taxa_alfabetizacao_municipio is not null""",
    "taxas_uf": f"""
        select {state('sigla_uf_code')} as uf, count(*) as n, avg((alfabetizado = 'Sim')::int) * 100 as taxa
        from escopo where {state('sigla_uf_code')} is not null group by all""",
    "ufs": "select * from (values " + ", ".join(f"('{k}', '{v}')" for k, v in K.STATES.items())
           + ") t(sigla_uf_code, uf)",
    "dobras": f"select *, cast({h('fold', 'id_aluno')} % 3 as int) as fold from pontuado",
}

DEPENDS = {
    "d_mun": ["municipal"], "d_school": ["students"], "d_inse": ["inse"], "d_goals": ["goals"],
    "d_census": ["census"], "d_ind": ["indicators"], "d_out": ["indicators"],
    "mart": ["students", "d_inse", "d_mun", "d_school", "d_goals", "d_census", "d_ind", "d_out"],
    "escopo": ["mart"], "pontuado": ["escopo"], "metas": ["escopo"], "lados": ["pontuado"],
    "municipios": ["lados", "metas"], "projecao": ["municipios"], "taxas_uf": ["escopo"], "dobras": ["pontuado"],
}


def sql(body: str, *views: str) -> str:
    """``body`` behind the views it uses, each after those it depends on."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in DEPENDS.get(name, []):
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for view in views:
        add(view)
    ctes = ",\n".join(f"{name} as materialized ({VIEWS[name].strip()})" for name in ordered)
    # A query may open with CTEs of its own.
    own = body.strip()
    if own.startswith("with "):
        return f"with {ctes},\n{own[5:]}"
    return f"with {ctes}\n{own}"


# --- shared shapes -----------------------------------------------------------------------------

ALL_MEASURES = [*K.NUMERIC_FEATURES, "icg_medio", "taxa_reprovacao_2ano_prior", "taxa_abandono_2ano_prior"]


def avgs(cols) -> str:
    return ", ".join(f"{r(f'avg({c})')} as {c}" for c in cols)


def counts(cols) -> str:
    return ", ".join(f"count({c}) as n_{c}" for c in cols)


def each(cols, template: str) -> str:
    """One SELECT per column, stacked."""
    return " union all ".join(template.replace("{c}", c) for c in cols)


def f1(tn="tn", fp="fp", fn="fn", tp="tp") -> str:
    return f"""(coalesce(2.0::double * {tn} / nullif(2 * {tn} + {fp} + {fn}, 0), 0)
        + coalesce(2.0::double * {tp} / nullif(2 * {tp} + {fp} + {fn}, 0), 0))
        / nullif(({tn} + {fp} + {fn} > 0)::int + ({tp} + {fp} + {fn} > 0)::int, 0)"""


def cells(score: str, cut: str) -> str:
    return f"""count(*) filter (label = 0 and {score} < {cut}) as tn, count(*) filter (label = 0 and {score} >= {cut}) as fp,
        count(*) filter (label = 1 and {score} < {cut}) as fn, count(*) filter (label = 1 and {score} >= {cut}) as tp"""


def auc(source: str, score: str, by: str) -> str:
    """Rank-sum over average ranks."""
    keys = f"{by}, " if by else ""
    part = f"partition by {by}" if by else ""
    return f"""select {keys} count(*) filter (label = 0) as n_neg, count(*) filter (label = 1) as n_pos,
        (sum(rk) filter (label = 1) - count(*) filter (label = 1) * (count(*) filter (label = 1) + 1) / 2.0::double)
        / nullif(count(*) filter (label = 1) * (count(*) filter (label = 0))::double, 0) as roc_auc
      from (select *, rank() over ({part} order by {score})
              + (count(*) over ({part + ', ' if part else 'partition by '}{score}) - 1) / 2.0::double as rk from {source})
      {'group by ' + by if by else ''}"""


SIMULATION = f"""
    select t as threshold, round_even((tn + tp)::double / (tn + fp + fn + tp), 4) as accuracy,
      round_even({f1()}, 4) as f1_macro,
      round_even(coalesce(tn::double / nullif(tn + fp, 0), 0), 4) as recall_nao_alfabetizado,
      round_even(coalesce(tn::double / nullif(tn + fn, 0), 0), 4) as precision_nao_alfabetizado
    from (select t, {cells('prob_alfabetizado', 't')}
          from pontuado, (select unnest([0.50, 0.52, 0.55, 0.58, 0.60, 0.65]::double[]) as t) group by t)"""

TRIALS = 14
HISTORY = f"""
    cortes as (select i as trial, (15 + i * 37 % {TRIALS} * 5) / 100.0::double as corte from range({TRIALS}) t(i)),
    medidas as (
      select 'random_forest' as model, trial, fold, corte,
        count(*) filter ((prob_alfabetizado >= corte)::int = label)::double / count(*) as value
      from dobras, cortes group by all
      union all
      select 'xgboost', trial, fold, corte,
        count(*) filter ((prob_sem_peso >= corte)::int = label)::double / count(*) as value
      from dobras, cortes group by all),
    historia as (
      select cast(m.trial as int) as trial, model, fold, value, cast(4 + trial % 5 as int) as max_depth,
        '{{"max_depth": ' || (4 + trial % 5) || ', "corte": ' || corte || '}}' as params,
        case when (select f.value from medidas f where f.model = m.model and f.trial = m.trial and f.fold = 0)
             < (select avg(f.value) - 0.05::double from medidas f where f.model = m.model and f.fold = 0)
             then 'PRUNED' else 'COMPLETE' end as state
      from medidas m),
    parciais as (
      select *, avg(value) over (partition by model, trial order by fold) as media_parcial from historia),
    melhores as (
      select *, max(media_parcial) over (partition by model, trial order by fold) as melhor_parcial from parciais),
    tentativas as (
      select model, trial, avg(value) as value, max(max_depth) as max_depth, max(params) as params,
        max(state) as state from historia where value is not null group by all),
    curva as (
      select model, max_depth, count(*) as n_trials, avg(value) as roc_auc_medio from tentativas group by all)
"""

RATE = "avg((alfabetizado = 'Sim')::int) * 100"


def quantiles(source: str, c: str, by: str = "") -> str:
    return ", ".join(
        f"quantile_cont({c}, {p}) as {n}" for n, p in (("q1", 0.25), ("mediana", 0.5), ("q3", 0.75))
    )


def describe(c: str) -> str:
    return f"""select '{c}' as variavel, count({c}) as count, avg({c}) as mean, stddev_samp({c}) as std,
        min({c})::double as min, max({c})::double as max, {quantiles('escopo', c)} from escopo"""


def arms() -> str:
    return f"""
      select 'com_peso_aluno' as braco, * from ({auc('pontuado', 'prob_alfabetizado', 'rede')})
      union all select 'sem_peso_aluno', * from ({auc('pontuado', 'prob_sem_peso', 'rede')})"""


# --- one statement per query -------------------------------------------------------------------


def key_min(c: str) -> str:
    """Smallest key: by value where keys are integers, else by text."""
    return f"coalesce(arg_min({c}, try_cast({c} as bigint)), min({c}))"


def key_max(c: str) -> str:
    return f"coalesce(arg_max({c}, try_cast({c} as bigint)), max({c}))"


def all_sql() -> dict[str, str]:
    o: dict[str, str] = {}

    # Sources and sinks.
    o["s1_mart_scan"] = sql(f"""
        select ano, rede, sigla_uf_code, count(*) as n, count(distinct id_aluno) as alunos,
          {avgs([*K.NUMERIC_FEATURES, *K.GOAL_COLUMNS])} from escopo group by ano, rede, sigla_uf_code""", "escopo")
    o["s2_profile_scan"] = sql(f"""
        select rede, sigla_uf_code, alfabetizado, count(*) as n, {avgs(K.PROFILE_FEATURES)}
        from escopo group by rede, sigla_uf_code, alfabetizado""", "escopo")
    o["s3_goal_scan"] = sql(
        f"select id_municipio, meta_2030, {r('gap_meta_2030')} as gap_meta_2030 from metas", "metas")
    o["s5_sink_roundtrip"] = sql(f"""
        select ano, count(*) as linhas, count(distinct id_municipio) as municipios, {r('avg(gap_meta_2030)')} as gap,
          (select count(*) from mart) as linhas_gravadas from mart group by ano""", "mart")
    o["s7_csv_roundtrip"] = o["s8_json_roundtrip"] = o["a15_rate_by_state"] = sql(
        f"select uf, n, {r('taxa')} as taxa from taxas_uf", "taxas_uf")
    o["s10_state_dimension"] = sql("""
        select coalesce(e.sigla_uf_code, u.sigla_uf_code) as sigla_uf_code, u.uf, e.n
        from (select sigla_uf_code, count(*) as n from escopo group by all) e
        full join ufs u on e.sigla_uf_code = u.sigla_uf_code""", "escopo", "ufs")

    # Scalar expressions.
    mun = ["taxa_alfabetizacao", "media_portugues", "proporcao_abaixo_basico", "proporcao_basico",
           "proporcao_adequado_avancado"]
    o["e1_locale_decimal"] = sql(f"""
        select substr(id_municipio, 1, 6) as id_municipio, serie, count(*) as n,
          count({num('taxa_alfabetizacao')}) as n_taxa_alfabetizacao, count({num('media_portugues')}) as n_media_portugues,
          {', '.join(f"{r(f'avg({num(c)})')} as {c}" for c in mun)}
        from municipal group by 1, 2""", "municipal")
    o["e2_key_conformance"] = sql("""
        select substr(id_municipio, 1, 6) as id6, trim(id_municipio) as id7, substr(id_municipio, 1, 2) as uf,
          count(*) as n, min(cast(try_cast(id_escola as bigint) as varchar)) as menor_escola,
          max(cast(try_cast(id_escola as bigint) as varchar)) as maior_escola, min(trim(rede)) as rede_menor
        from students group by 1, 2, 3""", "students")
    o["e4_integer_key"] = sql("""
        select icg_nivel_complexidade_gestao_escola,
          count(case when regexp_full_match(icg_nivel_complexidade_gestao_escola, '[0-9]+') then 1 end) as n_rotulo,
          count(case when regexp_full_match(id_municipio, '[0-9]+') then 1 end) as n_codigo,
          count(case when regexp_full_match(cast(atu_ef_2_ano as varchar), '[0-9]+') then 1 end) as n_decimal
        from indicators group by all""", "indicators")
    o["e6_network_title"] = sql("""
        select rede, count(*) as n, upper(substr(trim(rede), 1, 1)) || lower(substr(trim(rede), 2)) as titulo
        from indicators group by rede""", "indicators")
    o["e7_domain_recode"] = sql("""
        select rede, count(*) as n, case trim(rede) when '2' then 'Estadual' when '3' then 'Municipal' end as nome
        from census group by rede""", "census")
    o["e8_indicator_flags"] = sql(f"""
        select rede, tipo_localizacao, count(*) as n,
          {r("avg(case when biblioteca = 1 or biblioteca_sala_leitura = 1 then 1 else 0 end)")} as qualquer_biblioteca,
          {r('avg(case when internet = 1 then 1 else 0 end)')} as internet_nulo_conta,
          {r('avg(internet)')} as internet_nulo_fora
        from census group by rede, tipo_localizacao""", "census")
    o["e9_safe_casts"] = sql(f"""
        select ano, count(*) as n, count(try_cast(icg_nivel_complexidade_gestao_escola as double)) as n_icg,
          {r('avg(try_cast(icg_nivel_complexidade_gestao_escola as double))')} as icg, count(tdi_ef_2_ano) as n_tdi
        from indicators group by ano""", "indicators")
    o["e11_year_shift"] = sql("select ano, count(*) as n, ano + 1 as ano_alvo from students group by ano", "students")
    o["e12_hit_and_gap"] = sql(f"""
        select ano, tem_historico_escola, tem_censo_escolar, count(*) as n, count(gap_meta_2030) as n_gap,
          {r('avg(gap_meta_2030)')} as gap, {r('avg(n_alunos_prior_escola)')} as prior
        from mart group by ano, tem_historico_escola, tem_censo_escolar""", "mart")
    o["e14_label_maps"] = sql("""
        select alfabetizado, count(*) as n, cast(sum((alfabetizado = 'Sim')::int) as bigint) as estrito,
          cast(sum((alfabetizado = 'Sim')::int) as bigint) as tolerante, cast(0 as bigint) as desconhecido
        from students group by alfabetizado""", "students")
    o["e16_risk_clip_decide"] = sql(f"""
        select sigla_uf_code, {r('avg(1 - prob_alfabetizado)')} as risco,
          {r('avg(least(prob_alfabetizado, 0.5::double))')} as p_limitada,
          count(*) filter (prob_alfabetizado >= 0.55::double) as positivos, {state('sigla_uf_code')} as uf
        from pontuado group by sigla_uf_code""", "pontuado")
    o["e19_rounding"] = sql("""
        select peso_aluno, count(*) as n, round_even(peso_aluno / 8, 2) as par, round(peso_aluno / 8, 2) as afastado
        from mart group by peso_aluno""", "mart")
    o["e20_safe_divide"] = sql(f"""
        select id_aluno, ano, {r('''count(*) filter (presenca = 'Presente')::double
          / nullif(count(*) filter (presenca = 'Ausente'), 0)''')} as presentes_por_ausente, count(*) as n
        from mart group by id_aluno, ano""", "mart")
    o["e23_readable_names"] = sql(f"""
        select variavel, count(*) as n, case
            when variavel like 'categorical__sigla_uf_code_%'
              then 'UF: ' || coalesce({state("split_part(variavel, '_code_', 2)")}, split_part(variavel, '_code_', 2))
            when variavel like 'categorical__rede_%' then 'Rede: ' || split_part(variavel, '__rede_', 2)
            else split_part(variavel, '__', 2) end as rotulo
        from (select 'categorical__sigla_uf_code_' || sigla_uf_code as variavel from mart
              union all select 'categorical__rede_' || rede from mart
              union all select 'numeric__peso_aluno' from mart where peso_aluno is not null)
        group by variavel""", "mart")

    # Dimensions and joins.
    o["a1_municipal_same_year"] = sql(f"""
        select id_municipio, ano, {', '.join(f'{r(c)} as {c}' for c in K.BASE_FEATURES[:5])} from d_mun""", "d_mun")
    o["a2_school_prior_rate"] = sql(f"""
        select id_escola, ano, {r('taxa_alfabetizacao_escola_prior')} as taxa_alfabetizacao_escola_prior,
          n_alunos_prior_escola from d_school""", "d_school")
    o["a3_inse"] = sql(f"select id_municipio, {r('inse_municipio')} as inse_municipio from d_inse", "d_inse")
    o["a4_goals"] = sql("select * from d_goals", "d_goals")
    census = K.CENSUS_FEATURES[:6]
    o["a5_census_cell"] = sql(f"""
        select id_municipio_7dig, rede, ano, {', '.join(f'{r(c)} as {c}' for c in census)}, n_escolas_censo_celula
        from d_census""", "d_census")
    ind = [*K.CENSUS_FEATURES[7:], "icg_medio"]
    o["a6_indicator_cell"] = sql(f"""
        select id_municipio_7dig, rede, ano, {', '.join(f'{r(c)} as {c}' for c in ind)}
        from d_ind where ano between 1996 and 1999""", "d_ind")
    o["a7_lagged_outcome"] = sql(f"""
        select id_municipio_7dig, rede, ano, {r('taxa_reprovacao_2ano_prior')} as taxa_reprovacao_2ano_prior,
          {r('taxa_abandono_2ano_prior')} as taxa_abandono_2ano_prior
        from d_out where ano between 1996 and 1999""", "d_out")
    o["j1_inse_join"] = sql(f"""
        select ano, substr(a.id_municipio, 1, 2) as sigla_uf_code, count(*) as n, count(inse_municipio) as achados,
          {r('avg(inse_municipio)')} as inse
        from students a left join d_inse i on substr(a.id_municipio, 1, 6) = i.id_municipio group by 1, 2""",
        "students", "d_inse")
    o["j2_same_year_join"] = sql(f"""
        select a.ano, substr(a.id_municipio, 1, 2) as sigla_uf_code, count(*) as n,
          count(taxa_alfabetizacao_municipio) as achados, {r('avg(taxa_alfabetizacao_municipio)')} as taxa
        from students a left join d_mun m on substr(a.id_municipio, 1, 6) = m.id_municipio and a.ano = m.ano
        group by 1, 2""", "students", "d_mun")
    o["j3_prior_year_join"] = o["j3_salted_join"] = sql(f"""
        select a.ano, substr(a.id_municipio, 1, 2) as sigla_uf_code,
          (e.id_escola is not null)::int as tem_historico_escola, count(*) as n,
          cast(sum(n_alunos_prior_escola) as bigint) as alunos_prior,
          {r('avg(taxa_alfabetizacao_escola_prior)')} as taxa_prior
        from students a left join d_school e on a.id_escola = e.id_escola and a.ano = e.ano group by 1, 2, 3""",
        "students", "d_school")
    o["j2_salted_join"] = sql(f"""
        select a.ano, substr(a.id_municipio, 1, 2) as sigla_uf_code, count(*) as n,
          count(taxa_alfabetizacao_municipio) as achados, {r('avg(taxa_alfabetizacao_municipio)')} as taxa
        from students a left join d_mun m
          on case when a.presenca = 'Presente' then substr(a.id_municipio, 1, 6) end = m.id_municipio and a.ano = m.ano
        group by 1, 2""", "students", "d_mun")
    o["j4_goals_join"] = sql(f"""
        select a.ano, substr(a.id_municipio, 1, 2) as sigla_uf_code, count(*) as n, count(meta_2030) as achados,
          {r('avg(meta_2024)')} as meta_2024, count(nivel_alfabetizacao) as niveis,
          max(nivel_alfabetizacao) as maior_nivel
        from students a left join d_goals g on substr(a.id_municipio, 1, 6) = g.id_municipio and a.ano = g.ano
        group by 1, 2""", "students", "d_goals")
    joined = ["pct_escolas_rurais", "n_escolas_censo_celula", "atu_2ano", "tdi_2ano", "icg_medio",
              "taxa_reprovacao_2ano_prior", "taxa_abandono_2ano_prior"]
    o["j5_j7_cell_joins"] = sql(f"""
        select ano, rede, count(*) as n, sum(nullif(tem_censo_escolar, 0))::bigint as com_censo, {counts(joined)}, {avgs(joined)}
        from mart group by ano, rede""", "mart")
    o["mart_rollup"] = sql(f"""
        select ano, rede, count(*) as n, sum(tem_historico_escola)::bigint as com_historico,
          sum(tem_censo_escolar)::bigint as com_censo, {counts(ALL_MEASURES)}, {avgs([*ALL_MEASURES, 'gap_meta_2030'])}
        from mart group by ano, rede""", "mart")
    audit = "select '{t}' as tabela, cast(coalesce(sum(n), 0) as bigint) as linhas, count(*) filter (n > 1) as chaves_repetidas from ({q})"

    def one(name: str, inner: str) -> str:
        return audit.replace("{t}", name).replace("{q}", inner)

    o["q5_row_preservation"] = sql(" union all ".join([
        one("inse", "select id_municipio, count(*) as n from d_inse group by all"),
        one("municipio_ano", """select id_municipio, ano, count(*) as n from
            (select id_municipio, ano from d_mun union select id_municipio, ano from d_goals) group by all"""),
        one("celula", """select id_municipio_7dig, rede, ano, count(*) as n from
            (select id_municipio_7dig, rede, ano from d_census union select id_municipio_7dig, rede, ano from d_ind
             union select id_municipio_7dig, rede, ano from d_out) group by all"""),
        one("escola_ano", "select id_escola, ano, count(*) as n from d_school group by all"),
        one("alunos", "select id_aluno, ano, count(*) as n from students group by all"),
        one("mart", "select id_aluno, ano, count(*) as n from mart group by all"),
    ]), "mart")
    o["j8_goal_merge"] = sql(
        f"select id_municipio, uf, meta_2030, {r('gap_meta_2030')} as gap_meta_2030 from municipios", "municipios")
    o["j10_state_rates"] = sql(
        f"select u.uf, t.n, {r('t.taxa')} as taxa from ufs u left join taxas_uf t on u.uf = t.uf", "taxas_uf", "ufs")
    o["j11_states_without_data"] = sql("select uf from ufs except select uf from taxas_uf", "taxas_uf", "ufs")
    o["j12_split_overlap"] = sql("""
        select count(*) as alunos_em_comum from (select id_aluno from lados where lado = 'treino'
          intersect select id_aluno from lados where lado = 'teste')""", "lados")
    o["u2_returning_students"] = sql("""
        select id_aluno from mart where ano < 1995 intersect select id_aluno from mart where ano >= 1995""", "mart")
    pairs = {"alunos x censo": ("id_municipio from students", "id_municipio from census"),
             "inse x censo": ("id_municipio from inse", "id_municipio from census"),
             "escola x municipio": ("id_escola from students", "id_municipio from census")}
    o["j13_key_match"] = sql(" union all ".join(f"""
        select '{name}' as pair, (select count(*) from a{i}) as in_left_keys, (select {key_min('k')} from a{i}) as in_left_min,
          (select {key_max('k')} from a{i}) as in_left_max, (select count(*) from b{i}) as in_right_keys,
          (select {key_min('k')} from b{i}) as in_right_min, (select {key_max('k')} from b{i}) as in_right_max,
          (select count(*) from a{i} where k in (select k from b{i})) as matched,
          round((select count(*) from a{i} where k in (select k from b{i})) * 100.0::double
            / (select count(*) from a{i}), 4) as match_pct""" for i, name in enumerate(pairs)
    ).join(["with " + ", ".join(
        f"a{i} as (select distinct {a.replace(' from', ' as k from')} where {a.split()[0]} is not null), "
        f"b{i} as (select distinct {b.replace(' from', ' as k from')})"
        for i, (a, b) in enumerate(pairs.values())) + " ", ""]), "students", "inse", "census")

    # Profile and audits.
    o["a13_duplicate_students"] = sql("""
        select count(*) as alunos, count(*) filter (n > 1) as duplicados,
          round(count(*) filter (n > 1)::double / count(*) * 100, 2) as pct
        from (select id_aluno, count(*) as n from escopo group by id_aluno)""", "escopo")
    o["a14_rate_by_network"] = sql(
        f"select rede, count(*) as n, {r(RATE)} as taxa from escopo group by rede", "escopo")
    o["a15_rate_range"] = sql(f"""
        select count(*) as grupos, {r('min(taxa)')} as taxa_min, {r('max(taxa)')} as taxa_max,
          {r('max(taxa) - min(taxa)')} as amplitude, {r('avg(taxa)')} as media_nao_ponderada from taxas_uf""", "taxas_uf")
    null_of = ("select '{c}' as variavel, count(*) - count({c}) as nulos, "
               "round_even((count(*) - count({c}))::double / count(*) * 100, 2) as pct from ")
    profiled = [*K.FEATURES, *ALL_MEASURES[-3:]]
    o["a16_null_profile"] = sql(each(profiled, null_of + "mart"), "mart")
    o["f9_columns_with_nulls"] = sql(
        f"select * from ({each(profiled, null_of + 'escopo')}) where nulos > 0", "escopo")
    o["a17_target_mix"] = sql(f"""
        select alfabetizado, count(*) as n, {r('count(*)::double / (select count(*) from escopo) * 100')} as pct
        from escopo where alfabetizado is not null group by alfabetizado""", "escopo")
    stats = ["mean", "std", "min", "max", "q1", "mediana", "q3"]
    described = " union all ".join(describe(c) for c in K.PROFILE_FEATURES)
    o["a18_describe"] = sql(
        f"select variavel, count, {', '.join(f'{r(s)} as {s}' for s in stats)} from ({described})", "escopo")
    corr = "select '{a}' as a, '{b}' as b, case when {u} then {e} end as corr from escopo"

    def pair(a: str, b: str) -> str:
        # Undefined where one of them is constant over the rows that have both.
        varied = " and ".join(f"min({x}) filter ({y} is not null) < max({x}) filter ({y} is not null)" for x, y in ((a, b), (b, a)))
        return corr.replace("{a}", a).replace("{b}", b).replace("{u}", varied).replace("{e}", f"corr({a}, {b})")

    def pairs_of(cols) -> str:
        return " union all ".join(pair(a, b) for i, a in enumerate(cols) for b in cols[i + 1:])

    o["a19_correlations"] = sql(f"select a, b, {r('corr')} as corr from ({pairs_of(K.PROFILE_FEATURES)})", "escopo")
    o["a19_target_correlation"] = sql(each(K.PROFILE_FEATURES, """
        select '{c}' as variavel, round((corr({c}, (alfabetizado = 'Sim')::int)) + 3e-9::double, 6) as corr from escopo"""), "escopo")
    o["a23_box_stats"] = sql(f"""
        with q as (select alfabetizado, {quantiles('', 'inse_municipio')} from escopo group by alfabetizado)
        select e.alfabetizado, count(*) as n, {r('min(inse_municipio)')} as min, {r('any_value(q1)')} as q1,
          {r('any_value(mediana)')} as mediana, {r('any_value(q3)')} as q3, {r('max(inse_municipio)')} as max,
          {r('min(inse_municipio) filter (inse_municipio between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1))')} as haste_inferior,
          {r('max(inse_municipio) filter (inse_municipio between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1))')} as haste_superior,
          count(*) filter (inse_municipio not between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1)) as discrepantes
        from escopo e join q on e.alfabetizado = q.alfabetizado where inse_municipio is not null
        group by e.alfabetizado""", "escopo")
    o["a24_histogram"] = sql("""
        with g as (select alfabetizado, round((gap_meta_2030) + 3e-9::double, 4) as x from escopo where gap_meta_2030 is not null),
        e as (select min(x) as lo, (max(x) - min(x)) / 50 as w from g)
        select alfabetizado, cast(least(floor((x - lo) / w), 49) as int) as faixa,
          round((any_value(lo) + cast(least(floor((x - lo) / w), 49) as int) * any_value(w)) + 3e-9::double, 6) as inicio, count(*) as n,
          round((count(*) / (sum(count(*)) over (partition by alfabetizado)::double * any_value(w))) + 3e-9::double, 6) as densidade
        from g, e group by alfabetizado, cast(least(floor((x - lo) / w), 49) as int), least(floor((x - lo) / w), 49)
        """, "escopo")
    o["a28_id_audit"] = sql(each(["id_aluno", "id_municipio", "id_escola", "rede", "sigla_uf_code"], f"""
        select '{{c}}' as coluna, cast(sum(n) as bigint) as linhas, count(*) as distintos, {key_min('v')} as menor,
          {key_max('v')} as maior, max(n) as maior_grupo
        from (select {{c}} as v, count(*) as n from mart where {{c}} is not null group by {{c}})"""), "mart")
    o["a29_cell_grain"] = sql(f"""
        select count(*) as celulas, count(distinct id_municipio_7dig) as municipios,
          {r('avg(n_escolas_censo_celula)')} as escolas_por_celula,
          count(*) filter (n_escolas_censo_celula = 1) as celulas_escola_unica from d_census""", "d_census")
    o["a30_coverage"] = sql(each(ALL_MEASURES, """
        select '{c}' as variavel, round((count({c})::double / count(*) * 100) + 3e-9::double, 6) as cobertura_pct from escopo"""), "escopo")
    by_year = each(ALL_MEASURES, """
        select ano, '{c}' as variavel, count({c}) as preenchidas, count(*) as linhas,
          count({c})::double / count(*) * 100 as cobertura_pct from escopo group by ano""")
    o["a30_coverage_by_year"] = sql(
        f"select ano, variavel, preenchidas, linhas, {r('cobertura_pct')} as cobertura_pct from ({by_year})", "escopo")
    o["q1_label_cut"] = sql("""
        select count(*) as linhas, count(*) filter (alfabetizado = 'Sim' and proficiencia < 70000) as sim_abaixo_do_corte,
          count(*) filter (alfabetizado <> 'Sim' and proficiencia >= 70000) as nao_acima_do_corte,
          round((min(proficiencia) filter (alfabetizado = 'Sim')) + 3e-9::double, 2) as menor_sim,
          round((max(proficiencia) filter (alfabetizado <> 'Sim')) + 3e-9::double, 2) as maior_nao from students""", "students")
    o["q2_constant_columns"] = sql(f"""select variavel, valor from ({each(
        [*K.NUMERIC_FEATURES, *K.GOAL_COLUMNS, 'tem_censo_escolar'],
        "select '{c}' as variavel, min({c})::double as valor, count(distinct {c}) as d from escopo")}) where d = 1""",
        "escopo")
    collinear = ["taxa_alfabetizacao_municipio", "gap_meta_2030", "media_portugues_municipio", "meta_2024", "peso_aluno"]
    o["q2_collinear_pairs"] = sql(f"""
        select a, b, {r('corr')} as corr from ({pairs_of(collinear)}) where abs(corr) >= 1 - 1e-9""", "escopo")
    o["q3_missing_proxy"] = sql(f"""
        select variavel, {r('min(cobertura_pct)')} as cobertura_min, {r('max(cobertura_pct)')} as cobertura_max,
          {r('max(cobertura_pct) - min(cobertura_pct)')} as amplitude,
          (max(cobertura_pct) - min(cobertura_pct) >= 50)::int as proxy_do_ano
        from ({by_year}) group by variavel""", "escopo")
    o["q4_dense_ids"] = sql(each(["id_aluno", "id_escola", "id_municipio"], """
        select '{c}' as coluna, count(distinct v) as distintos, min(v) as menor, max(v) as maior,
          max(v) - min(v) + 1 as faixa, round((count(distinct v)::double / (max(v) - min(v) + 1)) + 3e-9::double, 6) as densidade,
          (count(distinct v)::double / (max(v) - min(v) + 1) >= 0.99)::int as parece_contador
        from (select cast({c} as bigint) as v from mart)"""), "mart")
    seen = [*K.PROFILE_FEATURES, *K.CATEGORICAL_FEATURES, K.TARGET]
    o["m31_profile_bundle"] = sql(f"""
        with nulos as ({each(seen, null_of + 'escopo')}), descr as ({described}),
        alvo as (select alfabetizado, count(*) as n, count(*)::double / (select count(*) from escopo) * 100 as pct
                 from escopo group by alfabetizado)
        select secao, variavel, medida, {r('valor')} as valor from (
          select 'forma' as secao, '*' as variavel, 'linhas' as medida, count(*)::double as valor from escopo
          union all select 'forma', '*', 'colunas', {len(seen)}
          union all select 'nulos', variavel, 'nulos', nulos from nulos
          union all select 'nulos', variavel, 'pct', pct from nulos
          union all select 'alvo', alfabetizado, 'n', n from alvo
          union all select 'alvo', alfabetizado, 'pct', pct from alvo
          union all {' union all '.join(f"select 'descricao', variavel, '{s}', {s} from descr" for s in ['count', *stats])}
        )""", "escopo")

    # Splits, samples, preparation.
    o["m1_group_split"] = sql(
        "select lado, count(*) as linhas, count(distinct id_aluno) as alunos from lados group by lado", "lados")
    o["m2_group_subsample"] = sql(f"""
        select rede, ano, count(*) as linhas, count(distinct id_aluno) as alunos from lados where lado = 'treino'
          and {h('search', 'id_aluno')} < 10000::double / (select count(*) from lados where lado = 'treino') * 4294967296
        group by rede, ano""", "lados")
    o["m3_stratified_folds"] = sql(f"""
        with g as (select id_aluno, count(*) filter (label = 0) as n0, count(*) filter (label = 1) as n1,
                   {h('fold', 'id_aluno')} as hx from pontuado group by id_aluno),
        m as (select greatest(1, cast(ceil(count(*) / 100000.0) as bigint)) as maos from g),
        t as (select id_aluno, n0, n1, (row_number() over (
                partition by hx % maos order by n0 + n1 desc, n1 desc, hx, id_aluno) - 1 + hx % maos) % 6 as vez
              from g, m)
        select id_aluno, n0, n1, cast(case when vez < 3 then vez else 5 - vez end as int) as fold from t""", "pontuado")
    o["m4_group_folds"] = sql("""
        select fold, count(*) as linhas, count(distinct id_aluno) as alunos, cast(sum(label) as bigint) as positivos
        from dobras group by fold""", "dobras")
    keys = ["ano", "id_aluno", "id_municipio", "id_escola", "rede", "presenca", "alfabetizado", "peso_aluno"]
    o["m5_sample_n"] = sql(f"""
        select {', '.join(keys)} from students order by {h('sample', *keys)}, {', '.join(keys)} limit 2000""", "students")
    o["m6_undersample"] = sql(f"""
        with c as (select alfabetizado, count(*) as k from students group by alfabetizado)
        select s.alfabetizado, s.rede, count(*) as n from students s join c on s.alfabetizado = c.alfabetizado
        where {h('undersample', *[f's.{k}' for k in keys])} < (select min(k) from c)::double / k * 4294967296
        group by s.alfabetizado, s.rede""", "students")
    o["m7_median_impute"] = sql(each(K.BASE_FEATURES, """
        select '{c}' as variavel, count({c}) as n, round((median({c})) + 3e-9::double, 6) as mediana,
          round((avg(coalesce({c}, (select median({c}) from escopo)))) + 3e-9::double, 6) as media_preenchida from escopo"""), "escopo")
    mode_of = """(select cast({c} as varchar) from mart where {c} is not null group by {c} order by count(*) desc, cast({c} as varchar) limit 1)"""
    modes = [("rede", "rede"), ("sigla_uf_code", "sigla_uf_code"), ("presenca", "presenca"),
             ("nivel", "nivel_alfabetizacao")]
    o["m8_mode_impute"] = sql(" union all ".join(f"""
        select '{name}' as variavel, {mode_of.replace('{c}', c)} as moda, count(*) as n from mart
        where cast({c} as varchar) = {mode_of.replace('{c}', c)}""" for name, c in modes) + f"""
        union all select 'nivel preenchido', coalesce(cast(nivel_alfabetizacao as varchar),
          {mode_of.replace('{c}', 'nivel_alfabetizacao')}) as moda, count(*) from mart group by 2""", "mart")
    z = ["peso_aluno", "inse_municipio", "meta_2024", "pct_escolas_energia_publica"]

    def zscore(c: str) -> str:
        return (f"({c} - (select avg({c}) from escopo)) / (select case when stddev_pop({c}) = 0 then 1 "
                f"else stddev_pop({c}) end from escopo)")

    o["m9_standardise"] = sql(f"""
        select sigla_uf_code, {', '.join(f"{r(f'avg({zscore(c)})')} as {c}" for c in z)},
          {r(f"max({zscore('peso_aluno')})")} as maior_peso from escopo group by sigla_uf_code""", "escopo")
    balance = """count(*) filter (label = 0) as n_neg, count(*) filter (label = 1) as n_pos,
          round((count(*) filter (label = 0)::double / count(*) filter (label = 1)) + 3e-9::double, 6) as scale_pos_weight,
          round((count(*)::double / (2 * count(*) filter (label = 0))) + 3e-9::double, 6) as peso_0,
          round((count(*)::double / (2 * count(*) filter (label = 1))) + 3e-9::double, 6) as peso_1"""
    o["m13_class_weights"] = sql(f"select {balance} from lados where lado = 'treino'", "lados")
    o["m14_target_encode_oof"] = sql(f"""
        with p as (select id_escola, fold, count(*) as n, sum(label)::double as s from dobras group by all)
        select p.id_escola, p.fold, p.n, {r('''coalesce(
          (select sum(q.s) / nullif(sum(q.n), 0) from p q where q.id_escola = p.id_escola and q.fold <> p.fold),
          (select sum(q.s) / sum(q.n) from p q where q.fold <> p.fold))''')} as codificado from p""", "dobras")

    # Measures on supplied scores.
    o["a25_class_balance"] = sql(f"select {balance} from pontuado", "pontuado")
    o["a26_confusion"] = sql(f"""
        select rede, tn, fp, fn, tp, {r('(tn + tp)::double / (tn + fp + fn + tp)')} as accuracy, {r(f1())} as f1_macro,
          {r('coalesce(tn::double / nullif(tn + fp, 0), 0)')} as recall_nao_alfabetizado,
          {r('coalesce(tp::double / nullif(tp + fn, 0), 0)')} as recall_alfabetizado,
          {r('coalesce(tn::double / nullif(tn + fn, 0), 0)')} as precision_nao_alfabetizado,
          {r('coalesce(tp::double / nullif(tp + fp, 0), 0)')} as precision_alfabetizado
        from (select rede, {cells('prob_alfabetizado', '0.5::double')} from pontuado group by rede)""", "pontuado")
    o["a27_roc_auc"] = sql(f"""
        select rede, ano, n_neg, n_pos, {r('roc_auc')} as roc_auc
        from ({auc('pontuado', 'prob_alfabetizado', 'rede, ano')})""", "pontuado")
    o["u1_stacked_measures"] = sql(" union all ".join(f"""
        select '{arm}' as braco, {r('(tn + tp)::double / (tn + fp + fn + tp)')} as accuracy, {r(f1())} as f1_macro
        from (select {cells(c, '0.5::double')} from pontuado)"""
        for arm, c in (("com_peso_aluno", "prob_alfabetizado"), ("sem_peso_aluno", "prob_sem_peso"))), "pontuado")
    o["m22_scoring_rule"] = sql("""
        select (prob_alfabetizado >= 0.55::double)::int as predicao_final, case when prob_alfabetizado >= 0.55::double
            then 'Baixo Risco / Adequado' else 'ALTO RISCO (Busca Ativa)' end as status_risco, rede, count(*) as n,
          min(round_even(prob_alfabetizado, 4)) as menor, max(round_even(prob_alfabetizado, 4)) as maior
        from pontuado group by 1, 2, 3""", "pontuado")
    o["m23_threshold_sim"] = sql(SIMULATION, "pontuado")
    o["t5_best_threshold"] = sql(f"""
        select * from ({SIMULATION}) order by recall_nao_alfabetizado desc, threshold limit 1""", "pontuado")
    o["a8_municipal_view"] = sql(f"""
        select id_municipio, n_alunos_avaliados, {', '.join(f'{r(c)} as {c}' for c in [
            'risco_medio', 'taxa_alfabetizacao_real', 'taxa_alfabetizacao_municipio', 'inse_municipio',
            'percentual_participacao', 'meta_2030', 'gap_meta_2030'])}, uf from municipios""", "municipios")
    o["m29_risk_ranking"] = sql(f"""
        select row_number() over (order by risco_medio desc, id_municipio) as posicao, id_municipio, uf,
          n_alunos_avaliados, {', '.join(f'{r(c)} as {c}' for c in [
              'risco_medio', 'taxa_alfabetizacao_real', 'inse_municipio', 'gap_meta_2030'])} from municipios""", "municipios")
    o["w1_global_rank"] = sql("""
        select id_aluno, n, row_number() over (order by n desc, id_aluno) as posicao
        from (select id_aluno, count(*) as n from mart group by id_aluno)""", "mart")
    o["a10_risk_by_state"] = sql(f"""
        select uf, count(*) as municipios, {r('avg(risco_medio)')} as risco_medio from municipios
        where uf is not null group by uf""", "municipios")
    o["t2_top20"] = sql(f"""
        select id_municipio, uf, {r('risco_medio')} as risco_medio from municipios m
        order by m.risco_medio desc, id_municipio limit 20""", "municipios")
    o["m30_goal_projection"] = sql(f"""
        select id_municipio, uf, {', '.join(f'{r(c)} as {c}' for c in [
            'taxa_atual', 'meta_2030', 'ritmo_necessario_aa', 'projecao_2030', 'distancia_meta_pp'])},
          atinge_meta_2030, classificacao_meta from projecao""", "projecao")
    o["a12_tier_mix"] = sql("""
        select classificacao_meta as classificacao, count(*) as municipios,
          round_even(count(*)::double / (select count(*) from projecao) * 100, 1) as percentual
        from projecao group by classificacao_meta""", "projecao")
    listed = ["taxa_atual", "meta_2030", "distancia_meta_pp", "ritmo_necessario_aa", "risco_medio"]
    o["t3_high_risk"] = sql(f"""
        select id_municipio, uf, {', '.join(f'{r(f"p.{c}")} as {c}' for c in listed)} from projecao p
        where classificacao_meta = 'Risco moderado' order by p.ritmo_necessario_aa desc, id_municipio limit 20""", "projecao")
    o["t4_top_n_rest"] = sql("""
        with t as (select id_municipio, count(*) as linhas from mart group by id_municipio),
        k as (select *, row_number() over (order by linhas desc, id_municipio) as p from t)
        select id_municipio, linhas, id_municipio as rotulo from k where p <= 20
        union all select 'outras', cast(sum(linhas) as bigint), 'Outras ' || count(*) || ' variaveis' from k
        where p > 20 having count(*) > 0""", "mart")
    o["a20_contingency"] = sql(f"""
        select {state('sigla_uf_code')} as uf,
          {r("count(*) filter (rede = 'Municipal')::double / count(*) * 100")} as "Municipal",
          {r("count(*) filter (rede = 'Estadual')::double / count(*) * 100")} as "Estadual"
        from escopo where {state('sigla_uf_code')} is not null group by 1""", "escopo")

    # Comparisons and trial histories.
    o["a21_arm_delta"] = sql(f"""
        select rede as model, {r("max(roc_auc) filter (braco = 'com_peso_aluno')")} as com_peso_aluno,
          {r("max(roc_auc) filter (braco = 'sem_peso_aluno')")} as sem_peso_aluno,
          {r("max(roc_auc) filter (braco = 'com_peso_aluno') - max(roc_auc) filter (braco = 'sem_peso_aluno')")} as delta
        from ({arms()}) group by rede""", "pontuado")
    o["t6_arm_champion"] = sql(f"""
        select braco, rede as model, {r('roc_auc')} as roc_auc_teste from ({arms()})
        qualify row_number() over (partition by braco order by roc_auc desc, rede) = 1""", "pontuado")
    cv_rows = f"(select *, cast({h('fold', 'id_aluno')} % 3 as int) as fold from lados where lado = 'treino')"
    o["m27_leakage_alarm"] = sql(f"""
        with t as ({auc("(select * from lados where lado = 'teste')", 'prob_alfabetizado', 'rede')}),
        f as ({auc(cv_rows, 'prob_alfabetizado', 'rede, fold')}),
        c as (select rede, avg(roc_auc) as cv from f group by rede)
        select t.rede, {r('t.roc_auc')} as roc_auc_teste, {r('cv')} as roc_auc_cv_media,
          {r('t.roc_auc - cv')} as delta_teste_menos_cv, t.roc_auc - cv > 0.01::double as suspeita_de_vazamento
        from t join c on t.rede = c.rede""", "lados")
    o["w4_running_mean"] = sql(f"""
        with {HISTORY} select model, trial, fold, {r('value')} as value, {r('media_parcial')} as media_parcial,
          {r('melhor_parcial')} as melhor_parcial from melhores""", "dobras")
    o["m20_median_stop"] = sql(f"""
        with {HISTORY}, j as (select *,
            quantile_cont(media_parcial, 0.5) filter (state = 'COMPLETE') over w as mediana_anteriores,
            count(*) filter (state = 'COMPLETE') over w as completos_antes
          from melhores window w as (partition by model, fold order by trial rows between unbounded preceding and 1 preceding))
        select model, trial, fold, state, {r('melhor_parcial')} as melhor_parcial,
          {r('mediana_anteriores')} as mediana_anteriores, completos_antes,
          coalesce(fold >= 1 and completos_antes >= 5 and melhor_parcial < mediana_anteriores, false)::int as parar
        from j""", "dobras")
    o["a22_depth_curve"] = sql(f"""
        with {HISTORY} select model, max_depth, n_trials, {r('roc_auc_medio')} as roc_auc_medio from curva""", "dobras")
    o["t5_depth_peak"] = sql(f"""
        with {HISTORY} select model, max_depth, n_trials, {r('roc_auc_medio')} as roc_auc_medio from curva c
        qualify row_number() over (partition by model order by c.roc_auc_medio desc, max_depth) = 1""", "dobras")
    o["m21_merge_best"] = sql(f"""
        with {HISTORY} select model, {r('value')} as best_roc_auc_cv, trial, params as best_params from tentativas t
        where state = 'COMPLETE' qualify row_number() over (partition by model order by t.value desc, trial) = 1""", "dobras")
    weights = {"peso_aluno": 0.04, "inse_municipio": 0.3, "meta_2024": -0.01, "atu_2ano": 0.02}

    def part(c: str) -> str:
        return f"{weights[c]}::double * ({c} - (select avg({c}) from escopo))"

    o["m25_linear_attribution"] = sql(f"""
        select sigla_uf_code, {', '.join(f"{r(f'avg({part(c)})')} as {c}" for c in weights)},
          {', '.join(f"{r(f'avg(abs({part(c)}))')} as abs_{c}" for c in weights)}
        from escopo group by sigla_uf_code""", "escopo")
    # The supplied ensemble by brute force: its expected score for each set of known features (p, i, m).
    ensemble = """
        bits as (select sigla_uf_code, coalesce(inse_municipio <= 4.2::double, false)::int::double as inse,
            coalesce(meta_2024 <= 56, false)::int::double as meta, coalesce(peso_aluno <= 13, false)::int::double as p13,
            coalesce(peso_aluno <= 25, false)::int::double as p25, coalesce(peso_aluno <= 38, false)::int::double as p38
          from escopo),
        shares as (select avg(inse) as inse, avg(p25) filter (inse = 1) as p25, avg(meta) filter (inse = 0) as meta,
            avg(p13) as p13, avg(p38) filter (p13 = 0) as p38, avg(inse) filter (p38 = 0) as inse38 from bits),
        known as (select * from (values (0), (1)) a(p), (values (0), (1)) b(i), (values (0), (1)) c(m)),
        ways as (select sigla_uf_code, p, i, m, if(i = 1, b.inse, s.inse) as x1, if(p = 1, b.p25, s.p25) as x2,
            if(m = 1, b.meta, s.meta) as x3, if(p = 1, b.p13, s.p13) as x4, if(p = 1, b.p38, s.p38) as x5,
            if(i = 1, b.inse, s.inse38) as x6 from bits b, shares s, known),
        scores as (select sigla_uf_code, p, i, m, p + i + m as k,
            0.5 * (x1 * (x2 * 0.2 + (1 - x2) * 0.6) + (1 - x1) * (x3 * 0.5 + (1 - x3) * 0.9))
            + 0.5 * (x4 * 0.3 + (1 - x4) * (x5 * 0.7 + (1 - x5) * (x6 * 0.4 + (1 - x6) * 0.8))) as f from ways)"""
    o["m16_supplied_trees"] = sql(f"""
        with {ensemble} select sigla_uf_code, count(*) as n, {r('avg(f)')} as media, {r('min(f)')} as menor, {r('max(f)')} as maior
        from scores where k = 3 group by sigla_uf_code""", "escopo")
    fraction = "case {k} when 1 then 1.0::double / 6 else 1.0::double / 3 end"

    def shapley(known: str, name: str) -> str:
        signed = f"if({known} = 1, {fraction.format(k='k - 1')}, -{fraction.format(k='k')}) * f"
        return (f"select sigla_uf_code, '{name}' as variavel, count(*) // 8 as n, {r(f'sum({signed}) / (count(*) / 8)')} as contribuicao_media, "
                f"{r('(select min(f) from scores where k = 0)')} as base from scores group by sigla_uf_code")

    o["m25_path_attribution"] = sql(f"""
        with {ensemble} {' union all '.join(shapley(*x) for x in (('p', 'peso_aluno'), ('i', 'inse_municipio'), ('m', 'meta_2024')))}""", "escopo")
    return o
