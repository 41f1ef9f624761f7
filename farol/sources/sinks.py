"""Table and report sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farol.session import new_path


def row_count(spark: SparkSession, path: str) -> int:
    """Rows of a written table, from the file footers; no column is read."""
    return spark.read.parquet(path).count()


def deal(df: DataFrame, municipality: Column | str = "id_municipio") -> DataFrame:
    """Rows by ranges of the clustering keys; a hash of the student ends the order, so a cell of any size is cut over several tasks."""
    return df.repartitionByRange("ano", municipality, "rede", F.xxhash64("id_aluno"))


def write_mart(df: DataFrame, path: str, dealt: bool = False) -> int:
    """Replace the mart, one folder per year, clustered by municipality and network.

    Rows lie in ranges of the clustering keys (``dealt``: they do already), so
    the files of a large year hold neighbouring municipalities and their
    statistics prune.
    """
    (
        (df if dealt else deal(df))
        .sortWithinPartitions("ano", "id_municipio", "rede")
        .write.mode("overwrite").partitionBy("ano").parquet(path)
    )
    return row_count(df.sparkSession, path)


def read_table(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Declared schema, so partition columns keep their type."""
    return spark.read.schema(schema).parquet(path)


def stage(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """Write a derived table to the shared folder and read it back with its row count.

    The lineage ends there: a lost executor costs a re-read, not a recompute.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return read_table(spark, path, df.schema), row_count(spark, path)


def write_csv(df: DataFrame, path: str) -> None:
    """Report table as CSV with a header."""
    df.write.mode("overwrite").option("header", True).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    """Summary document as JSON, nested fields kept; NULL fields are written too."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def read_json(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).json(path)
