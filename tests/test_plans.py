"""What the physical plans must and must not contain."""

import re

import pytest
from pyspark.sql import functions as F

from farol import oracles
from farol import queries as q
from farol.operators import dimensions as D
from farol.operators import profile, split
from farol.plans import mart as M
from farol.sources.gold import gold_mart
from farol.sources.star import Star

# Queries that fit models or write files run jobs before they return a plan.
LAZY = [n for n in oracles.all_sql() if not n.endswith("roundtrip")]
QUERIES = {f.__name__: f for f in q.QUERIES}
# Numbers a view whose rows were counted to be under the limit.
BOUNDED_WINDOWS = {"m29_risk_ranking"}


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_pairing_no_python_no_global_window(spark, base, name):
    plan = plan_of(QUERIES[name](spark, base))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    assert not re.search(r"BatchEvalPython|ArrowEvalPython|MapInPandas|MapInArrow|FlatMapGroups|FlatMapCoGroups|AggregateInPandas|ArrowAggregate", plan)
    if name not in BOUNDED_WINDOWS:
        # A window whose definition opens with a sort order has no key and runs in one task.
        keyless = re.findall(r"windowspecdefinition\((\w+)#\d+L? (?:ASC|DESC)", plan)
        assert set(keyless) <= {"_range", "_part"}


def test_scope_filter_and_columns_reach_the_files(spark, base):
    plan = plan_of(M.goal_scan(gold_mart(spark, base).where(F.col("ano") == 1999)))
    assert re.search(r"PushedFilters: \[[^]]*In\(rede", plan)
    assert re.search(r"PartitionFilters: \[[^]]*ano", plan)
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert {c.split(":")[0] for c in schema.split(",")} == {"id_municipio", "rede", "meta_2030", "gap_meta_2030"}


def test_year_bounds_reach_the_census_files(spark, base, tmp_path):
    path = str(tmp_path / "census")
    Star(spark, base).census.write.partitionBy("ano").parquet(path)
    plan = plan_of(D.census_cells(spark.read.parquet(path), (1997, 1998)))
    assert re.search(r"PartitionFilters: \[[^]]*>= 1997[^]]*<= 1998", plan)


def test_split_and_folds_do_not_shuffle(spark, base):
    mart = gold_mart(spark, base)
    assert "Exchange" not in plan_of(split.group_split(mart))
    assert "Exchange" not in plan_of(split.group_folds(mart))


def test_mart_rows_are_not_shuffled_below_the_bound(spark, base):
    silver = Star(spark, base)
    plan = plan_of(M.build_mart(silver))
    assert plan.count("BroadcastHashJoin") >= 4 and "SortMergeJoin" not in plan


def test_correlations_are_one_aggregate(spark, base):
    plan = plan_of(profile.correlations(gold_mart(spark, base), ["peso_aluno", "inse_municipio", "meta_2024"]))
    # Rows are summed per pattern of missing values; the pairs are drawn from those few rows.
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 2
    assert plan.rindex("Generate") < plan.index("FileScan")


def test_stored_mart_is_sorted_and_split_by_year(spark, base):
    mart = gold_mart(spark, base)
    files = mart.select(F.input_file_name().alias("f"), "ano", "id_municipio").groupBy("f").agg(F.countDistinct("ano").alias("years"))
    assert files.where("years > 1").count() == 0
