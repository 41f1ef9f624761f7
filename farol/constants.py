"""Fixed values shared by the whole package.

Every value below is part of the published data model or of the reporting
rules: results only agree with earlier reports when these are equal.
"""

# IBGE state code -> abbreviation.
STATES = {
    "11": "RO", "12": "AC", "13": "AM", "14": "RR", "15": "PA", "16": "AP", "17": "TO",
    "21": "MA", "22": "PI", "23": "CE", "24": "RN", "25": "PB", "26": "PE", "27": "AL",
    "28": "SE", "29": "BA", "31": "MG", "32": "ES", "33": "RJ", "35": "SP", "41": "PR",
    "42": "SC", "43": "RS", "50": "MS", "51": "MT", "52": "GO", "53": "DF",
}

# Domains found in the sources.
GRADE = "2° ano do Ensino Fundamental"
PRESENT = "Presente"
GOAL_SCOPE = "municipio"
SCOPE_NETWORKS = ["Municipal", "Estadual"]
NETWORK_OF_CODE = {"2": "Estadual", "3": "Municipal"}
INDICATOR_NETWORKS = ["estadual", "municipal"]
RURAL_CODE = "2"
LABEL_NEGATIVE = ["Não", "Nao", "0"]
LABEL_POSITIVE = ["Sim", "1"]

# Model input columns of the mart.
BASE_FEATURES = [
    "taxa_alfabetizacao_municipio", "media_portugues_municipio", "proporcao_abaixo_basico",
    "proporcao_basico", "proporcao_adequado_avancado", "inse_municipio", "peso_aluno",
    "taxa_alfabetizacao_escola_prior", "n_alunos_prior_escola", "tem_historico_escola",
    "meta_2024", "percentual_participacao", "nivel_alfabetizacao",
]
CENSUS_FEATURES = [
    "pct_escolas_rurais", "pct_escolas_biblioteca", "pct_escolas_internet",
    "pct_escolas_agua_potavel", "pct_escolas_esgoto_publico", "pct_escolas_energia_publica",
    "n_escolas_censo_celula", "atu_2ano", "had_2ano", "tdi_2ano", "afd_grupo1_pct",
    "ird_medio", "dsu_medio",
]
NUMERIC_FEATURES = BASE_FEATURES + CENSUS_FEATURES
CATEGORICAL_FEATURES = ["rede", "sigla_uf_code"]
FEATURES = NUMERIC_FEATURES + CATEGORICAL_FEATURES
ID_COLUMNS = ["id_municipio", "id_escola", "ano"]
GROUP = "id_aluno"
TARGET = "alfabetizado"
GOAL_COLUMNS = ["meta_2030", "gap_meta_2030"]
PROFILE_FEATURES = BASE_FEATURES[:10]

# Feature families used when importances are summed by theme.
FEATURE_GROUPS = {
    "contexto_municipal": BASE_FEATURES[:5],
    "nivel_socioeconomico": ["inse_municipio"],
    "peso_aluno": ["peso_aluno"],
    "historico_escola": BASE_FEATURES[7:10],
    "metas": BASE_FEATURES[10:],
    "enriquecimento": CENSUS_FEATURES,
    "territorio": CATEGORICAL_FEATURES,
}

# Split, search and decision parameters.
SEED = 42
TEST_SHARE = 0.2
SEARCH_ROWS = 150_000
SEARCH_FOLDS = 3
SEARCH_TRIALS = 20
AB_FOLDS = 3
# Independent fits submitted together; the tasks of all share the same slots.
FITS_AT_ONCE = 4
LEAKAGE_TOLERANCE = 0.01
THRESHOLDS = [0.50, 0.52, 0.55, 0.58, 0.60, 0.65]
DECISION_THRESHOLD = 0.55
MIN_SUPPORT = 20
BASE_YEAR, GOAL_YEAR = 2024, 2030
STATUS_TEXT = {0: "ALTO RISCO (Busca Ativa)", 1: "Baixo Risco / Adequado"}
TIERS = ["Meta ja atingida", "Provavel atingir", "Risco moderado", "Risco alto de nao atingir"]
TIER_PACE = [3.0, 7.0]
CLUSTER_FEATURES = [
    "risco_medio", "taxa_alfabetizacao_real", "inse_municipio", "gap_meta_2030",
    "percentual_participacao",
]
CLUSTER_NAMES = ["Critico", "Atencao", "Intermediario", "Consolidado"]

# Model settings used when no search result is supplied.
DEFAULT_PARAMS = {
    "logistic": {"C": 1.0},
    "random_forest": {
        "n_estimators": 200, "max_depth": 12, "min_samples_leaf": 2, "max_features": "sqrt",
    },
    "xgboost": {
        "n_estimators": 200, "max_depth": 8, "learning_rate": 0.05, "subsample": 0.8,
        "colsample_bytree": 0.8, "min_child_weight": 1, "reg_lambda": 1.0,
    },
}
# Search ranges (low, high, scale) or choices.
SEARCH_SPACE = {
    "logistic": {"C": (1e-3, 1e2, "log")},
    "random_forest": {
        "n_estimators": (100, 400, "int"), "max_depth": (4, 20, "int"),
        "min_samples_leaf": (1, 10, "int"), "max_features": ["sqrt", "log2"],
    },
    "xgboost": {
        "n_estimators": (100, 500, "int"), "max_depth": (3, 10, "int"),
        "learning_rate": (0.01, 0.3, "log"), "subsample": (0.5, 1.0, "float"),
        "colsample_bytree": (0.5, 1.0, "float"), "min_child_weight": (1, 10, "int"),
    },
}
MODEL_NAMES = list(DEFAULT_PARAMS)
