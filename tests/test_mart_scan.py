"""The report of the mart: what travels once for each student, and rows without a key."""

import re

from pyspark.sql import functions as F

from farol import queries as q
from farol.sources.gold import gold_mart


def test_no_measure_travels_once_for_each_student(spark, base):
    plan = q.s1_mart_scan(spark, base)._jdf.queryExecution().executedPlan().toString()
    functions = re.findall(r"Aggregate\(keys=\[[^\]]*id_aluno[^\]]*\], functions=\[([^\]]*)", plan)
    assert functions and not any(functions)


def test_rows_without_a_state_are_counted_together(spark, base, monkeypatch):
    mart = gold_mart(spark, base)
    state = F.when(F.col("sigla_uf_code") != "35", F.col("sigla_uf_code"))
    monkeypatch.setattr(q, "gold_mart", lambda spark, base: mart.withColumn("sigla_uf_code", state))
    scope = mart.where(F.col("rede").isin("Municipal", "Estadual"))
    want = scope.where("sigla_uf_code = '35'").groupBy("ano", "rede").agg(F.count("*"), F.countDistinct("id_aluno")).collect()
    got = q.s1_mart_scan(spark, base).where("sigla_uf_code is null").select("ano", "rede", "n", "alunos").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want)) and len(got) > 0
