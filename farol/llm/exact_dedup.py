"""Exact duplicates by recipes of content-defined chunks (operator 10, SQL functions only).

Each normalised text is cut where its own characters say so. A chunk gets a
64-bit identifier; all chunks are moved once, to prove by grouping on the
chunk itself that no two chunks share one. Documents are then compared by
their ordered identifier lists, so whole texts never travel.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farol.llm.common import SPACE, staged

# A chunk ends after MIN characters at the first letter pair of this kind, or after MAX characters.
MIN_CHUNK, MAX_CHUNK = 256, 2048
CUT = f"(?s).{{{MIN_CHUNK - 3},{MAX_CHUNK - 3}}}?[a-f][^a-f][a-f]|.{{1,{MAX_CHUNK}}}"


def normalised(text: Column) -> Column:
    """Text without ASCII white space; NULL is the empty text."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), f"{SPACE}+", "")


def chunks(norm: Column) -> Column:
    """Consecutive chunks that together are the text; the empty text has none."""
    return F.regexp_extract_all(norm, F.lit(CUT), F.lit(0))


def shared_identifiers(docs: DataFrame, text: str, identify: Callable[[Column], Column]) -> DataFrame:
    """Identifiers that stand for more than one chunk, found by grouping on the chunks themselves."""
    distinct = (
        docs.select(F.explode(chunks(normalised(F.col(text)))).alias("chunk"))
        .select(identify(F.col("chunk")).alias("ident"), "chunk")
        .distinct()
    )
    return distinct.groupBy("ident").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("ident")


def exact_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", identify: Callable[[Column], Column] = F.xxhash64,
) -> DataFrame:
    """One row per row of ``docs``: which row of its group of equal texts stays.

    Texts are equal when they agree without ASCII white space. The row with
    the most code points in its original text stays, then the smallest id;
    NULL ids come last. NULL text is the empty text, and all empty texts form
    one group. Rows that repeat an id, a text and its length are told apart by
    their place in the written table: one of them stays at most. Other columns
    are ignored, an empty table gives an empty result.

    A list is proof of equality once no identifier in it is shared. Documents
    that hold a shared one are compared by the SHA-256 of the text as well.
    """
    recipes = staged(
        docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.length(text), F.lit(0)).alias("n_chars"),
                    normalised(F.col(text)).alias("norm"))
        .select("doc_id", "n_chars", F.sha2("norm", 256).alias("text_sha256"), F.monotonically_increasing_id().alias("place"),
                F.transform(chunks(F.col("norm")), lambda c: identify(c)).alias("recipe")),
        "recipes",
    )
    shared = staged(shared_identifiers(docs, text, identify), "shared_identifiers")
    if shared.isEmpty():
        keyed = recipes.withColumn("extra", F.lit(""))
    else:
        unsure = (
            recipes.select("text_sha256", F.explode("recipe").alias("ident")).join(shared, "ident", "left_semi")
            .groupBy(F.col("text_sha256").alias("unsure")).agg(F.lit(1).alias("_one")).select("unsure")
        )
        keyed = recipes.join(unsure, F.col("text_sha256") == F.col("unsure"), "left").withColumn("extra", F.coalesce("unsure", F.lit("")))
    # Written first: both sides of the join are then plain shuffles, and adaptive execution splits a hot group's rows.
    groups = staged(keyed.groupBy(F.col("recipe").alias("g_recipe"), F.col("extra").alias("g_extra")).agg(
        F.count(F.lit(1)).alias("group_size"),
        F.min(F.struct((-F.col("n_chars")).alias("n"), F.col("doc_id").isNull().alias("last"), "doc_id", "place")).alias("best"),
    ), "groups")
    return keyed.join(groups, (F.col("recipe") == F.col("g_recipe")) & (F.col("extra") == F.col("g_extra"))).select(
        "doc_id", F.col("best.doc_id").alias("keep_id"), "group_size", (F.col("place") == F.col("best.place")).alias("kept"), "text_sha256")
