from pyspark.sql import functions as F

from farol.plans import mart as M
from farol.sources import sinks
from farol.sources.silver import SCHEMAS, read_silver
from farol.sources.star import Star
from farol.sources.states import states


def test_declared_sources_build_the_same_mart(spark, base, tmp_path):
    star = Star(spark, base)
    for name in SCHEMAS:
        getattr(star, name).write.parquet(str(tmp_path / name))
    silver = read_silver(spark, str(tmp_path))
    measure = [F.count(F.lit(1)), F.sum("tem_historico_escola"), F.round(F.sum("gap_meta_2030"), 4), F.count("icg_medio")]
    path = str(tmp_path / "mart")
    rows = M.save_mart(silver, path)
    assert rows == star.students.count()
    assert M.load_mart(spark, path).agg(*measure).first() == M.build_mart(star).agg(*measure).first()


def test_mart_overwrite_replaces_rows(spark, base, tmp_path):
    path = str(tmp_path / "mart")
    first = M.save_mart(Star(spark, base), path)
    assert M.save_mart(Star(spark, base), path) == first == M.load_mart(spark, path).count()


def test_states(spark):
    assert states(spark).count() == 27 and states(spark).where("uf = 'SP'").first()["sigla_uf_code"] == "35"


def test_json_keeps_nested_and_missing_fields(spark, tmp_path):
    df = spark.createDataFrame([("a", (1, None)), ("b", (2, 0.5))], "k string, s struct<n: int, x: double>")
    sinks.write_json(df, str(tmp_path / "j"))
    assert sorted(map(tuple, sinks.read_json(spark, str(tmp_path / "j"), df.schema).collect())) == sorted(map(tuple, df.collect()))
