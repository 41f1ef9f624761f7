import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from farol import constants as K
from farol.operators import experiment, explain, metrics, models, policy, prepare, search, split
from farol.plans import answers, training
from farol.session import new_path
from farol.sources.gold import gold_mart


# Small settings: these tests look at properties of fits, not at their quality.
LIGHT = {
    "logistic": {"C": 1.0, "max_iter": 50},
    "random_forest": {"n_estimators": 10, "max_depth": 6, "min_samples_leaf": 2, "max_features": "sqrt"},
    "xgboost": {"n_estimators": 5, "max_depth": 4, "learning_rate": 0.3, "subsample": 0.8, "colsample_bytree": 0.8, "min_child_weight": 1},
}


@pytest.fixture(scope="module")
def mart(spark, base):
    return gold_mart(spark, base)


@pytest.fixture(scope="module")
def frames(mart):
    train, test = training.split_frames(mart)
    return train.cache(), test.cache()


@pytest.fixture(scope="module")
def fitted(frames):
    train, _ = frames
    pre = prepare.preprocessor(train, K.NUMERIC_FEATURES, K.CATEGORICAL_FEATURES).fit(train)
    return {n: models.fit(train, n, LIGHT[n], pre=pre) for n in K.MODEL_NAMES}


@pytest.mark.parametrize("name", K.MODEL_NAMES)
def test_scores_are_probabilities_with_signal(frames, fitted, name):
    scored = models.score(fitted[name], frames[1]).cache()
    low, high = scored.agg(F.min("prob_alfabetizado"), F.max("prob_alfabetizado")).first()
    assert 0.0 <= low < high <= 1.0
    assert models.evaluate(scored, name, {}).first()["roc_auc"] > 0.55


def test_random_label_has_no_signal(frames):
    train, test = (d.withColumn("label", (F.xxhash64("id_aluno", *K.NUMERIC_FEATURES) % 2 == 0).cast("double")) for d in frames)
    model = models.fit(train, "logistic", LIGHT["logistic"])
    auc = models.evaluate(models.score(model, test), "logistic", {}).first()["roc_auc"]
    assert abs(auc - 0.5) < 0.08


def test_unknown_names_and_missing_models(spark, frames):
    with pytest.raises(ValueError, match="unknown model"):
        models.fit(frames[0], "perceptron")
    with pytest.raises(KeyError):
        search.candidate("perceptron", 0)
    with pytest.raises(FileNotFoundError):
        models.load(spark, new_path(spark, "nothing"))


def test_saved_model_scores_the_same(spark, frames, fitted):
    path = new_path(spark, "model")
    models.save(fitted["xgboost"], path)
    again = models.load(spark, path)
    a = [r[0] for r in models.score(fitted["xgboost"], frames[1]).select("prob_alfabetizado").collect()]
    b = [r[0] for r in models.score(again, frames[1]).select("prob_alfabetizado").collect()]
    assert a == b


def test_scoring_checks_its_columns(spark, mart, fitted):
    path = new_path(spark, "model")
    models.save(fitted["logistic"], path)
    some = mart.where(F.col("rede").isin(K.SCOPE_NETWORKS)).select("id_aluno", *[c for c in K.FEATURES if c not in K.CENSUS_FEATURES]).limit(50)
    with pytest.raises(ValueError, match="lacks columns"):
        models.predict_risk(some, path)
    out = models.predict_risk(some, path, add_missing=True)
    assert set(out.columns) >= {"probabilidade_alfabetizado", "predicao_final", "status_risco"}
    for r in out.collect():
        assert r["status_risco"] == K.STATUS_TEXT[r["predicao_final"]]


def test_unseen_category_is_all_zero(spark, frames):
    train, _ = frames
    pre = prepare.preprocessor(train, ["peso_aluno"], ["rede"]).fit(train)
    odd = train.limit(1).withColumn("rede", F.lit("Marciana"))
    vector = pre.transform(odd).select(vector_to_array("features").alias("v")).first()["v"]
    names = prepare.feature_names(pre, ["peso_aluno"], ["rede"])
    assert names == ["numeric__peso_aluno", "categorical__rede_Estadual", "categorical__rede_Municipal"]
    assert len(vector) == 3 and vector[1:] == [0.0, 0.0]
    missing = train.limit(1).withColumn("rede", F.lit(None).cast("string"))
    assert sum(pre.transform(missing).select(vector_to_array("features").alias("v")).first()["v"][1:]) == 1.0


def test_importance_adds_up(frames, fitted):
    table = explain.importance(fitted["random_forest"], frames[0], K.NUMERIC_FEATURES, K.CATEGORICAL_FEATURES)
    total, pct = table.agg(F.sum("importancia"), F.sum("contribuicao_pct")).first()
    assert total == pytest.approx(1.0) and pct == pytest.approx(100, abs=1)
    groups = explain.group_importance(table)
    assert groups.where("grupo is null").count() == 0
    assert groups.agg(F.sum("importancia")).first()[0] == pytest.approx(1.0)
    assert table.orderBy(F.desc("importancia")).first()["variavel"] == "numeric__peso_aluno"
    with pytest.raises(ValueError):
        explain.importance(fitted["logistic"], frames[0], K.NUMERIC_FEATURES, K.CATEGORICAL_FEATURES)


def test_tree_contributions_add_up(frames, fitted):
    numeric, categorical = K.NUMERIC_FEATURES, K.CATEGORICAL_FEATURES
    model = fitted["random_forest"]
    parts = explain.tree_attribution(model, frames[1], numeric, categorical, sample=8, permutations=3, background=1)
    got = {r["linha"]: r["s"] for r in parts.groupBy("linha").agg(F.sum("contribuicao").alias("s")).collect()}
    # With one background row, a row's contributions sum to its score less that row's score.
    base_row = split.sample_rows(frames[1].select(*numeric, *categorical), 1, [*numeric, *categorical])
    base_score = models.score(model, base_row).first()["prob_alfabetizado"]
    rows = split.sample_rows(frames[1].select(*numeric, *categorical), 8)
    want = sorted(r["prob_alfabetizado"] - base_score for r in models.score(model, rows).collect())
    assert sorted(got.values()) == pytest.approx(want, abs=1e-9)


def test_linear_contributions_add_up(spark):
    df = spark.createDataFrame([(1, 1.0, 2.0), (2, 3.0, 6.0)], "i int, a double, b double")
    out = explain.linear_attribution(df, {"a": 2.0, "b": 1.0}, ["i"]).orderBy("i").collect()
    assert [(r["contrib_a"], r["contrib_b"]) for r in out] == [(-2.0, -2.0), (2.0, 2.0)]
    summary = explain.attribution_summary(explain.linear_attribution(df, {"a": 2.0, "b": 1.0}, ["i"]), ["a", "b"])
    assert {r["variavel"]: r["impacto_medio"] for r in summary.collect()} == {"a": 2.0, "b": 2.0}


def test_leaking_feature_raises_the_alarm(frames):
    """Positive control: the label of a row's own class-mates, known to the test rows only."""
    train, test = frames
    leaky = test.withColumn("peso_aluno", F.col("label") * 10)
    model = models.fit(train, "logistic", LIGHT["logistic"])
    shown = models.evaluate(models.score(model, leaky), "logistic", {}).first()["roc_auc"]
    cv = experiment.grouped_cv_auc(train, "logistic", LIGHT["logistic"])
    df = train.sparkSession.createDataFrame([(shown, cv)], "roc_auc_teste double, roc_auc_cv_media double")
    assert experiment.leakage_alarm(df).first()["suspeita_de_vazamento"]


def test_arms_with_champion_and_its_cross_validation(frames):
    arms = {"todas": K.FEATURES, "sem_inse": [c for c in K.FEATURES if c != "inse_municipio"]}
    row = experiment.compare_arms(*frames, arms, "todas", "sem_inse", ["logistic"], LIGHT, folds=2).first()
    assert (row["campeao"], row["braco"], row["cv_folds"]) == ("logistic", "todas", 2)
    assert 0.5 < row["roc_auc_cv_media"] < 1 and set(row["delta_por_modelo"]) == {"logistic"}


def test_comparison_and_reports(spark, mart, tmp_path):
    table, fitted = training.train_and_compare(mart, LIGHT, ["logistic"], str(tmp_path / "m"), str(tmp_path / "r"))
    assert training.champion(table).first()["campeao"] == "logistic"
    assert models.load(spark, str(tmp_path / "m" / "logistic")) is not None
    reports = answers.policy_reports(mart, fitted["logistic"], str(tmp_path / "out"))
    ranking = reports["q2_ranking_municipios_risco"].orderBy("posicao").collect()
    assert [r["posicao"] for r in ranking] == list(range(1, len(ranking) + 1))
    risk = [r["risco_medio"] for r in ranking]
    assert risk == sorted(risk, reverse=True)
    assert spark.read.option("header", True).csv(str(tmp_path / "out" / "q3_perfil_clusters")).count() <= 4


def test_clusters_are_named_by_falling_risk(spark):
    rows = [(f"{35 + i % 4}{i:04d}", "SP", 30, 0.1 * (i % 4) + i / 1e4, 90.0 - 20 * (i % 4), 5.0, -10.0 * (i % 4), 80.0) for i in range(80)]
    view = spark.createDataFrame(rows, "id_municipio string, uf string, n_alunos_avaliados bigint, risco_medio double, "
                                 "taxa_alfabetizacao_real double, inse_municipio double, gap_meta_2030 double, percentual_participacao double")
    assigned, profile = policy.clusters(view, restarts=3)
    by_risk = [r["perfil"] for r in profile.orderBy(F.desc("risco_medio")).collect()]
    assert by_risk == K.CLUSTER_NAMES and assigned.count() == 80
    assert policy.clusters(view.limit(79).union(view.limit(1).withColumn("inse_municipio", F.lit(None).cast("double"))), restarts=1)[0].count() == 79


def test_minimum_support(spark):
    rows = [("350001", 2020, 0.5, 1, 50.0, 5.0, 90.0)] * 19 + [("350002", 2020, 0.5, 1, 50.0, 5.0, 90.0)] * 20
    scored = spark.createDataFrame(rows, "id_municipio string, ano bigint, prob_alfabetizado double, label int, "
                                   "taxa_alfabetizacao_municipio double, inse_municipio double, percentual_participacao double")
    goals = spark.createDataFrame([("350002", 80.0, -30.0)], "id_municipio string, meta_2030 double, gap_meta_2030 double")
    assert [r["id_municipio"] for r in policy.municipal_view(scored, goals).collect()] == ["350002"]


def test_latest_year_with_a_value_wins(spark):
    rows = [("350001", 2019, 0.5, 1, 40.0, 4.0, 90.0)] * 10 + [("350001", 2020, 0.5, 0, 50.0, None, 80.0)] * 10
    scored = spark.createDataFrame(rows, "id_municipio string, ano bigint, prob_alfabetizado double, label int, "
                                   "taxa_alfabetizacao_municipio double, inse_municipio double, percentual_participacao double")
    goals = spark.createDataFrame([], "id_municipio string, meta_2030 double, gap_meta_2030 double")
    r = policy.municipal_view(scored, goals).first()
    assert (r["taxa_alfabetizacao_municipio"], r["inse_municipio"], r["percentual_participacao"]) == (50.0, 4.0, 80.0)
    assert r["meta_2030"] is None and r["uf"] == "SP" and r["taxa_alfabetizacao_real"] == 50.0


def test_goal_projection(spark):
    view = spark.createDataFrame(
        [("a", "SP", 85.0, 80.0, 1.0, 0.1), ("b", "SP", 50.0, 80.0, 1.0, 0.2), ("c", "SP", 30.0, 80.0, 1.0, 0.3), ("d", "SP", 70.0, None, 1.0, 0.3)],
        "id_municipio string, uf string, taxa_alfabetizacao_real double, meta_2030 double, taxa_alfabetizacao_municipio double, risco_medio double",
    )
    projected = policy.goal_projection(view)
    got = {r["id_municipio"]: (r["projecao_2030"], r["classificacao_meta"]) for r in projected.collect()}
    assert got == {"a": (80.0, K.TIERS[0]), "b": (50.0, K.TIERS[2]), "c": (30.0, K.TIERS[3])}
    assert [r["id_municipio"] for r in policy.goal_risk_list(projected).collect()] == ["c"]
    assert {r["percentual"] for r in policy.tier_mix(projected).collect()} == {33.3}


def test_search_resumes(spark, frames):
    train, _ = frames
    first = search.run_search(train, "logistic", trials=1, overrides={"max_iter": 5})
    second = search.run_search(train, "logistic", trials=1, history=first, overrides={"max_iter": 5})
    assert sorted(map(tuple, first.collect()), key=str) == sorted(map(tuple, second.collect()), key=str)
    assert first.count() == K.SEARCH_FOLDS
