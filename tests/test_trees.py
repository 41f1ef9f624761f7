"""Node tables against Spark's own ensembles, DuckDB and brute force over subsets."""

from itertools import combinations
from math import factorial, isclose, log

import duckdb
import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from farol.operators import trees

NAMES = ["a", "b", "c", "d"]
DEPTH = 3


def features():
    return vector_to_array("features")


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(3)
    v = rng.random((300, 4))
    v[:, 2] = v[:, 2] > 0.5
    y = (v[:, 0] + v[:, 1] * v[:, 2] + 0.2 * rng.random(300) > 0.8).astype(float)
    data = [(i, *map(float, r), float(t), 1.5 if t else 1.0) for i, (r, t) in enumerate(zip(v, y, strict=True))]
    df = spark.createDataFrame(data, "id long, a double, b double, c double, d double, label double, weight double")
    return VectorAssembler(inputCols=NAMES, outputCol="features").transform(df).cache()


@pytest.fixture(scope="module", params=["forest", "boosted"])
def fitted(request, spark, rows):
    common = {"maxDepth": DEPTH, "labelCol": "label", "weightCol": "weight", "seed": 1}
    kind = RandomForestClassifier(numTrees=4, **common) if request.param == "forest" else GBTClassifier(maxIter=4, **common)
    model = kind.fit(rows)
    return model, trees.node_table(spark, PipelineModel(stages=[model])).cache()


def boosted(model):
    return isinstance(model, GBTClassificationModel)


def expected_scores(model, rows):
    p = vector_to_array("probability")[1]
    out = {r["id"]: r["p"] for r in model.transform(rows).select("id", p.alias("p")).collect()}
    return out if not boosted(model) else {k: log(v / (1 - v)) for k, v in out.items()}


def test_scores_equal_the_models(rows, fitted):
    model, nodes = fitted
    want = expected_scores(model, rows)
    got = {r["id"]: r["score"] for r in trees.with_score(rows, features(), nodes, DEPTH).select("id", "score").collect()}
    assert got.keys() == want.keys() and all(isclose(got[k], want[k], abs_tol=1e-9) for k in want)


def test_importance_equals_the_models_and_duckdb(fitted):
    model, nodes = fitted
    per_tree = not boosted(model)
    got = {r["variavel"]: r["importancia"] for r in trees.node_importance(nodes, NAMES, per_tree).collect()}
    assert np.allclose([got[n] for n in NAMES], model.featureImportances.toArray())
    con = duckdb.connect()
    con.register("nodes", nodes.toPandas())
    per = "sum(gain * cover) / sum(sum(gain * cover)) over (partition by tree)" if per_tree else "sum(gain * cover)"
    found = con.execute(f"""
        with g as (select tree, feature, {per} as g from nodes where feature is not null group by tree, feature)
        select feature::int, sum(g) / (select sum(g) from g) from g group by feature""").fetchall()
    assert all(isclose(got[NAMES[f]], v, rel_tol=1e-9) for f, v in found)
    assert {NAMES[f] for f, _ in found} == {n for n in NAMES if got[n] > 0}


def expectation(tree, at, x, known):
    """Score of a tree when only some features are known: unknown ones go both ways by cover."""
    node = tree[at]
    if node["feature"] is None:
        return node["value"] * node["weight"]
    if node["feature"] in known:
        return expectation(tree, node["left"] if x[node["feature"]] <= node["threshold"] else node["right"], x, known)
    return sum(tree[k]["cover"] / node["cover"] * expectation(tree, k, x, known) for k in (node["left"], node["right"]))


def test_contributions_equal_brute_force_and_add_up(rows, fitted):
    model, nodes = fitted
    some = rows.where("id % 15 = 0")
    paths = trees.paths(nodes)
    base = trees.base_value(paths).first()["base"]
    got = {(r["id"], r["variavel"]): r["contribuicao"] for r in trees.path_attribution(some, features(), paths, NAMES, ["id"]).collect()}
    held = {}
    for r in nodes.collect():
        held.setdefault(r["tree"], {})[r["node"]] = r
    want = expected_scores(model, some)
    for row in some.collect():
        x = row["features"].toArray()

        def f(known):
            return sum(expectation(t, 0, x, known) for t in held.values())

        assert isclose(base + sum(v for (i, _), v in got.items() if i == row["id"]), want[row["id"]], abs_tol=1e-9)
        for i, name in enumerate(NAMES):
            others = [j for j in range(4) if j != i]
            phi = sum(
                factorial(n) * factorial(3 - n) / factorial(4) * (f({*s, i}) - f(set(s)))
                for n in range(4) for s in combinations(others, n))
            assert isclose(got.get((row["id"], name), 0.0), phi, abs_tol=1e-9)


def test_nulls_go_right_and_a_lone_leaf_has_no_contribution(spark):
    nodes = spark.createDataFrame(
        [(0, 0, 0, 0.5, 1, 2, 4.0, 1.0, 0.0, 1.0), (0, 1, None, None, None, None, 1.0, None, 1.0, 1.0),
         (0, 2, None, None, None, None, 3.0, None, 5.0, 1.0), (1, 0, None, None, None, None, 4.0, None, 7.0, 1.0)],
        "tree int, node int, feature int, threshold double, left int, right int, cover double, gain double, value double, weight double")
    df = spark.createDataFrame([(1, 0.2), (2, 0.7), (3, None), (4, float("nan"))], "id int, v double")
    x = F.array("v")
    scores = {r["id"]: r["score"] for r in trees.with_score(df, x, nodes, 1).collect()}
    assert scores == {1: 8.0, 2: 12.0, 3: 12.0, 4: 12.0}
    counted = {(r["tree"], r["node"]): r["cover"] for r in trees.with_cover(nodes, df, x, 1).collect()}
    assert counted == {(0, 0): 4.0, (0, 1): 1.0, (0, 2): 3.0, (1, 0): 4.0}
    paths = trees.paths(nodes)
    assert trees.base_value(paths).first()["base"] == 11.0
    parts = {r["id"]: r["contribuicao"] for r in trees.path_attribution(df, x, paths, ["v"], ["id"]).collect()}
    assert {k: round(v, 9) for k, v in parts.items()} == {1: -3.0, 2: 1.0, 3: 1.0, 4: 1.0}
    assert trees.path_attribution(df.limit(0), x, paths, ["v"], ["id"]).count() == 0


def test_other_models_have_no_nodes(spark, rows):
    with pytest.raises(ValueError, match="no trees"):
        trees.node_table(spark, PipelineModel(stages=[VectorAssembler(inputCols=NAMES, outputCol="f")]))
