import pytest
from pyspark.sql import functions as F

from farol.functions import rules
from farol.operators import dimensions as D
from farol.operators import joins
from farol.plans import mart as M
from farol.sources.star import Star


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows on one key, a third on NULL, the rest spread."""
    k = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.lit(None)).otherwise((F.col("id") % 500).cast("string"))
    fact = spark.range(30_000).select("id", k.alias("k"))
    dim = spark.range(0, 500, 2).select(F.col("id").cast("string").alias("k"), F.col("id").alias("v")).unionByName(
        spark.sql("select 'hot' as k, -1L as v")
    )
    return fact, dim


def totals(df):
    return df.agg(F.count(F.lit(1)), F.count("v"), F.sum("v"), F.countDistinct("id")).first()


def test_salted_join_equals_plain_join(skewed):
    fact, dim = skewed
    plain = totals(fact.join(dim, "k", "left"))
    salted = joins.lookup_join(fact, dim, dim.count(), ["k"], ["id"], max_rows=0)
    assert totals(salted) == plain
    assert plain[0] == plain[3] == 30_000


def test_hot_and_null_keys_are_cut_into_pieces(spark, skewed):
    fact, dim = skewed
    counts = fact.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    hot = joins.hot_keys(counts, ["k"])
    assert {r["k"] for r in hot.collect()} >= {"hot"}
    assert hot.count() <= 1 / joins.HOT_SHARE
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = joins.salted_left_join(fact, dim, ["k"], hot, ["id"])
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert max(sizes) < 0.25 * sum(sizes)


def test_pieces_follow_the_rows_of_a_key(spark, skewed):
    fact, dim = skewed
    counts = fact.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    hot = joins.hot_keys(counts, ["k"], piece_rows=10)
    rows = {r["k"]: r["n"] for r in counts.collect()}
    pieces = {r["k"]: r["_pieces"] for r in hot.collect()}
    assert pieces["hot"] > 64 and all(n == -(-rows[k] // 10) for k, n in pieces.items())
    assert totals(joins.salted_left_join(fact, dim, ["k"], hot, ["id"])) == totals(fact.join(dim, "k", "left"))


def test_pieces_beyond_one_block(spark, skewed, monkeypatch):
    monkeypatch.setattr(joins, "PIECE_BLOCK", 7)
    test_pieces_follow_the_rows_of_a_key(spark, skewed)


def test_shuffled_mart_holds_the_facts_once(spark, base):
    plan = M.build_mart(Star(spark, base), max_rows=0)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("l_orderkey") and len([x for x in plan.split("\n") if "Relation" in x and "l_orderkey" in x]) == 1
    assert plan.count("Join LeftOuter") <= 12  # four joins, and the hot marks on both sides of each


def test_key_ranges_follow_the_numbers(spark):
    a = spark.createDataFrame([(str(i),) for i in range(150)], "k string")
    row = joins.key_match(a, a.where("k < '2'"), "k", "x").first()
    assert (row["in_left_min"], row["in_left_max"], row["in_right_max"]) == ("0", "149", "149")
    assert spark.createDataFrame([("b",), ("a",)], "k string").agg(*rules.key_range(F.col("k"))).first()[:] == ("a", "b")


def test_small_dimension_is_broadcast_and_large_is_not(spark, skewed):
    fact, dim = skewed
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    small = joins.lookup_join(fact, dim, 251, ["k"], ["id"])
    assert "BroadcastHashJoin" in plan(small)
    assert "_piece" not in plan(small) and "_piece" in plan(joins.lookup_join(fact, dim, 10**9, ["k"], ["id"]))


def test_history_needs_the_year_before(spark):
    rows = [("1", 2022, "Sim"), ("1", 2022, "Não"), ("1", 2023, "Sim"), ("2", 2023, "Sim"), ("3", 2021, "Sim"), ("3", 2023, "Sim"), ("x", 2023, "Sim")]
    students = spark.createDataFrame(
        [(y, str(i), "3550308", s, "Municipal", "Presente", "1,0", a) for i, (s, y, a) in enumerate(rows)],
        "ano bigint, id_aluno string, id_municipio string, id_escola string, rede string, presenca string, "
        "peso_aluno string, alfabetizado string",
    )
    for max_rows in (1000, 0):
        by_school = D.school_year(students)
        out = M.join_history(M.student_rows(students), by_school, by_school.count(), max_rows)
        got = {(r["id_escola"], r["ano"]): (r["tem_historico_escola"], r["taxa_alfabetizacao_escola_prior"], r["n_alunos_prior_escola"])
               for r in out.where("ano = 2023").collect()}
        assert got == {("1", 2023): (1, 0.5, 2), ("2", 2023): (0, None, None), ("3", 2023): (0, None, None),
                       (None, 2023): (0, None, None)}


def test_absentees_stay_in_the_mart_but_not_in_the_history(spark):
    students = spark.createDataFrame(
        [(2022, "x", "3550308", "1", "Municipal", p, "1,0", a)
         for p, a in (("Presente", "Sim"), ("Ausente", "Não"))],
        "ano bigint, id_aluno string, id_municipio string, id_escola string, rede string, presenca string, "
        "peso_aluno string, alfabetizado string",
    )
    assert M.student_rows(students).count() == 2
    prior = D.school_prior(D.school_year(students)).first()
    assert (prior["ano"], prior["n_alunos_prior_escola"], prior["taxa_alfabetizacao_escola_prior"]) == (2023, 1, 1.0)


def test_both_mart_paths_agree(spark, base):
    silver = Star(spark, base)
    measure = [F.count(F.lit(1)), F.sum("tem_historico_escola"), F.sum("tem_censo_escolar"),
               *[F.round(F.sum(c), 4) for c in ("inse_municipio", "gap_meta_2030", "tdi_2ano", "taxa_alfabetizacao_escola_prior")]]
    small = M.build_mart(silver).agg(*measure).first()
    large = M.build_mart(silver, max_rows=0).agg(*measure).first()
    assert small == large and small[0] == silver.students.count()


def test_lag_years_serves_last_year(spark):
    municipal = spark.createDataFrame(
        [("3550308", 2022, " 2° ano do Ensino Fundamental ", "50,0", "1", "1", "1", "1")],
        "id_municipio string, ano bigint, serie string, taxa_alfabetizacao string, media_portugues string, "
        "proporcao_abaixo_basico string, proporcao_basico string, proporcao_adequado_avancado string",
    )
    assert D.municipal_year(municipal).first()["ano"] == 2022
    assert D.municipal_year(municipal, lag_years=1).first()["ano"] == 2023


def test_year_bounds_shift_for_outcomes(spark, base):
    silver = Star(spark, base)
    bounded = D.cell_context(silver.census, silver.indicators, (1997, 1998))
    assert {r["ano"] for r in bounded.select("ano").distinct().collect()} == {1997, 1998}
    whole = D.cell_context(silver.census, silver.indicators).where(F.col("ano").between(1997, 1998))
    measure = [F.count(F.lit(1)), *[F.round(F.sum(c), 4) for c in ("atu_2ano", "taxa_abandono_2ano_prior", "pct_escolas_rurais")]]
    assert bounded.agg(*measure).first() == whole.agg(*measure).first()
