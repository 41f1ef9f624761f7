"""Corpus pipeline: five stages of the training-data operators, one after the other.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
it as Parquet to the shared folder and reads it back as the next one's docs.
All but the last return the columns of ``docs``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farol.llm import decontaminate, exact_dedup, jaccard_join, language_id, packing
from farol.llm.common import read, staged
from farol.operators.order import number_rows

# A text goes when its language is unknown or less certain than this.
MIN_SCORE = 0.4
#: The statement for ``run``'s rows: a trained network cannot be expressed in SQL.
ORACLE_SQL = None


def numbered(docs: DataFrame) -> tuple[DataFrame, str | None]:
    """``docs`` and the name of a row number, where ids are unknown or repeated; no name where they tell rows apart.

    Numbers follow the ids, unknown ones last, then the texts.
    """
    if docs.groupBy("doc_id").count().where("count > 1 or doc_id is null").isEmpty():
        return docs, None
    name = "row"
    while name in docs.columns:
        name += "_"
    order = [F.col("doc_id").isNull(), F.col("doc_id"), F.coalesce("text", F.lit(""))]
    return number_rows(docs, order, name), name


def only(docs: DataFrame, decide: Callable[[DataFrame], DataFrame], how: str = "left_semi") -> DataFrame:
    """Rows whose id is, or with ``left_anti`` is not, among the doc_ids that ``decide`` returns.

    Every row is decided on by itself: rows without an id or with a repeated
    one go by their row number. The texts are shuffled once at most.
    """
    rows, name = numbered(docs)
    asked = rows.withColumn("doc_id", F.col(name)) if name else rows
    ids = decide(asked).select(F.col("doc_id").alias(name or "doc_id")).distinct()
    return rows.join(ids, name or "doc_id", how).select(docs.columns)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without a letter (NULL and empty ones too) and those no learned language fits.

    Equal texts are told alike. Rows without an id and rows that repeat one
    are told by their own text; an empty table stays empty.
    """
    return only(docs, lambda d: language_id.identify(d).where((F.col("lang_pred") != language_id.NONE) & (F.col("score") >= MIN_SCORE)))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts stays, of NULL and blank texts too.

    It is the longest, then the smallest id; a row without an id is last, and
    of rows alike in all that one stays. An empty table stays empty.
    """
    return only(docs, lambda d: exact_dedup.exact_duplicates(d).where("kept"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest id of each component stays; a row without an id only where none of its copies has one.

    Texts without words, NULL included, are components of their own. An empty
    table stays empty.
    """
    return only(docs, lambda d: jaccard_join.near_duplicates(d).where(F.col("doc_id") == F.col("component_id")))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, exactly or nearly, go.

    Rows without an id or with a repeated one go by their own text; NULL and
    empty texts hold nothing. An empty table stays empty.
    """
    return only(docs, lambda d: decontaminate.find_leaks(d, read(spark, sf_dir, "benchmark")), "left_anti")


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bin and offset of every piece; copies are gone, so only sources conflict.

    Rows without an id or with a repeated one are packed each by itself and
    carry the id they have; an empty table gives no rows.
    """
    rows, name = numbered(docs)
    asked = rows.select(F.col(name or "doc_id").alias("doc_id"), "source", packing.word_length().alias("words"))
    packed = packing.pack(asked, "words", cluster=None)
    if not name:
        return packed
    ids = rows.select(F.col(name).alias("packed"), F.col("doc_id").alias("id"))
    return packed.join(ids, packed["doc_id"] == ids["packed"]).withColumn("doc_id", F.col("id")).select(packed.columns)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("jaccard_join", drop_near_copies),
    ("decontaminate", drop_contaminated),
    ("packing", pack_documents),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
