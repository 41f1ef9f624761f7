"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farol.session import new_path

# One task works on about this many bytes of text at a time, whatever the Arrow batch holds.
BATCH_BYTES = 4 << 20
# ASCII white space of the word and equality rules.
SPACE = r"[\x20\x09-\x0D]"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write to the folder of ``spark.checkpoint.dir`` and read back: the lineage ends there."""
    path = new_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.staged_path = path
    return out


def release(*tables: DataFrame) -> None:
    """Delete staged tables that nothing reads any more."""
    for df in tables:
        context = df.sparkSession.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(df.staged_path)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def remainder(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n; NULL ids count as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % n


def by_bytes(texts: Iterable[str | None], limit: int = BATCH_BYTES) -> Iterator[tuple[int, list[str]]]:
    """(first position, texts) slices of about ``limit`` characters; NULL becomes the empty text."""
    start, kept, size, at = 0, [], 0, 0
    for at, text in enumerate(texts):
        text = text or ""
        if kept and size + len(text) > limit:
            yield start, kept
            start, kept, size = at, [], 0
        kept.append(text)
        size += len(text)
    if kept:
        yield start, kept


def words(text: str) -> list[str]:
    """Maximal runs without ASCII white space, A-Z lowered."""
    return text.translate(LOWER).replace("\t", " ").replace("\n", " ").replace("\v", " ").replace("\f", " ").replace("\r", " ").split(" ")
