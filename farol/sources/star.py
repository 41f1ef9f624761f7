"""Source tables of the mart derived from a star-schema data set.

Line item = one student in one edition, supplier = municipality, nation =
state, part = school, customer = student, order priority = network. The label
is cut from a row measure, so models have a signal to find.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from farol.sources.sinks import stage

LABEL_CUT = 70000.0
SPLIT_BYTES = 128 << 20  # a read split at Spark's default

_schemas: dict[str, StructType] = {}


def _comma(c: Column) -> Column:
    return F.replace(c.cast("string"), F.lit("."), F.lit(","))


def _code7(suppkey: str) -> Column:
    key = F.col(suppkey)
    return ((F.col("s_nationkey") + 11) * F.lit(100000).cast("bigint") + key * 10 + key % 10).cast("string")


def _by_priority(high: str, middle: str, rest: str) -> Column:
    p = F.col("o_orderpriority")
    return (
        F.when(p.isin("1-URGENT", "2-HIGH"), high)
        .when(p.isin("3-MEDIUM", "4-NOT SPECIFIED"), middle)
        .otherwise(rest)
    )


class Star:
    """Lazy views named as in ``Silver``; each query prunes them down to the columns it uses."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base

    def table(self, name: str) -> DataFrame:
        """One table; its schema is read from the file footers once per process."""
        path = f"{self.base}/{name}.parquet"
        if path not in _schemas:
            _schemas[path] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(_schemas[path]).parquet(path)

    def kept(self) -> Star:
        """The same views over line items joined once: for readers of several views of a table larger than one read split.

        The joined rows are written narrow and read again, instead of meeting orders, suppliers and parts anew in each view.
        """
        if self._size > SPLIT_BYTES:
            wanted = [
                "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
                "o_custkey", "o_orderpriority", "ano", "s_nationkey", "p_partkey", "p_type", "p_size", "p_retailprice",
            ]
            parts = self._lines.join(self.table("part"), F.col("l_partkey") == F.col("p_partkey"), "left")
            lines, _ = stage(parts.select(*wanted), "lines")
            self._lines = lines.drop("p_partkey", "p_type", "p_size", "p_retailprice")
            self._school_lines = lines.where(F.col("p_partkey").isNotNull())
        return self

    @cached_property
    def _size(self) -> int:
        """Bytes of the line item files."""
        return int(str(self.table("lineitem")._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))

    @cached_property
    def _lineitem(self) -> DataFrame:
        """Line items; a table of no more than one read split is spread over the cores, any larger one stays as it is."""
        lines = self.table("lineitem")
        return lines.repartition(self.spark.sparkContext.defaultParallelism, "l_orderkey") if self._size <= SPLIT_BYTES else lines

    @cached_property
    def _lines(self) -> DataFrame:
        # No hint: the supplier side is broadcast only if its file size is under Spark's threshold.
        return (
            self._lineitem
            .join(self.table("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
            .join(self.table("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
            .withColumn("ano", F.year("o_orderdate").cast("bigint"))
        )

    @cached_property
    def _school_lines(self) -> DataFrame:
        return self._lines.join(self.table("part"), F.col("l_partkey") == F.col("p_partkey"))

    @cached_property
    def students(self) -> DataFrame:
        score = F.col("l_extendedprice") + 1000 * F.col("l_quantity")
        return self._lines.select(
            "ano",
            F.col("o_custkey").cast("string").alias("id_aluno"),
            _code7("l_suppkey").alias("id_municipio"),
            F.col("l_partkey").cast("string").alias("id_escola"),
            _by_priority("Estadual", "Municipal", "Federal").alias("rede"),
            F.when(F.col("l_returnflag") == "R", "Ausente").otherwise("Presente").alias("presenca"),
            _comma(F.col("l_quantity")).alias("peso_aluno"),
            F.when(score >= LABEL_CUT, "Sim").otherwise("Não").alias("alfabetizado"),
            score.alias("proficiencia"),
        )

    @cached_property
    def municipal(self) -> DataFrame:
        low, mid = F.col("l_discount") * 100, F.col("l_tax") * 100
        return self._lineitem.join(
            self.table("supplier"), F.col("l_suppkey") == F.col("s_suppkey")
        ).select(
            _code7("l_suppkey").alias("id_municipio"),
            F.year("l_shipdate").cast("bigint").alias("ano"),
            F.when(F.col("l_linestatus") == "O", " 2° ano do Ensino Fundamental ")
            .otherwise("5° ano do Ensino Fundamental").alias("serie"),
            F.when(F.col("l_linenumber") == 7, "n/d")
            .otherwise(_comma(F.col("l_extendedprice") / 1000)).alias("taxa_alfabetizacao"),
            _comma(700 + F.col("l_quantity")).alias("media_portugues"),
            _comma(F.round(low, 1)).alias("proporcao_abaixo_basico"),
            _comma(F.round(mid, 1)).alias("proporcao_basico"),
            _comma(F.round(100 - low - mid, 1)).alias("proporcao_adequado_avancado"),
        )

    @cached_property
    def inse(self) -> DataFrame:
        return self.table("supplier").select(
            F.when(F.col("s_suppkey") % 50 != 49, _code7("s_suppkey")).alias("id_municipio"),
            _comma(3 + (F.col("s_acctbal") + 1000) / 5000).alias("inse"),
        )

    @cached_property
    def goals(self) -> DataFrame:
        # Published goals repeat for every edition: the few years travel as one array.
        years = self.table("orders").agg(
            F.array_sort(F.collect_set(F.year("o_orderdate").cast("bigint")))
        ).scalar()
        key = F.col("s_suppkey")
        return (
            self.table("supplier")
            .withColumn("ano", F.explode(years))
            .select(
                F.when(key % 20 == 0, "uf").otherwise("municipio").alias("escopo"),
                _code7("s_suppkey").alias("id_municipio"),
                "ano",
                F.lit(80.0).alias("meta_alfabetizacao_2030"),
                (40 + key % 40).cast("double").alias("meta_alfabetizacao_2024"),
                (70 + key % 30).cast("double").alias("percentual_participacao"),
                F.when(key % 11 == 0, "-").otherwise((key % 6).cast("string")).alias("nivel_alfabetizacao"),
            )
        )

    @cached_property
    def census(self) -> DataFrame:
        size = F.col("p_size")
        return self._school_lines.select(
            _code7("l_suppkey").alias("id_municipio"),
            _by_priority("2", "3", "1").alias("rede"),
            "ano",
            F.when(F.col("p_type").isin("SMALL", "ECONOMY"), "2").otherwise("1").alias("tipo_localizacao"),
            (size % 2).alias("biblioteca"),
            F.when(size % 5 != 0, size % 3 % 2).alias("biblioteca_sala_leitura"),
            F.when(size % 7 != 0, size % 2).alias("internet"),
            (size % 3 % 2).alias("agua_potavel"),
            (size % 5 % 2).alias("esgoto_rede_publica"),
            F.lit(1).alias("energia_rede_publica"),
        )

    @cached_property
    def indicators(self) -> DataFrame:
        size = F.col("p_size")
        return self._school_lines.select(
            _code7("l_suppkey").alias("id_municipio"),
            _by_priority(" estadual", "municipal", "federal").alias("rede"),
            "ano",
            F.col("l_quantity").alias("atu_ef_2_ano"),
            (F.col("l_tax") * 100).alias("had_ef_2_ano"),
            F.when(size % 6 != 0, F.col("l_discount") * 100).alias("tdi_ef_2_ano"),
            size.cast("double").alias("afd_ef_anos_iniciais_grupo_1"),
            (F.col("p_retailprice") / 500).alias("ird_media_regularidade_docente"),
            (size % 50).cast("double").alias("dsu_ef_anos_iniciais"),
            F.when(size % 25 == 0, "3").otherwise("Nivel 3").alias("icg_nivel_complexidade_gestao_escola"),
            F.when(F.col("ano") > 1997, F.col("l_tax") * 100).alias("taxa_reprovacao_ef_2_ano"),
            (F.col("l_discount") * 10).alias("taxa_abandono_ef_2_ano"),
        )
