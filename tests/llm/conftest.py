import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # names that operators use inside
    T.StructField("component", T.StringType()), T.StructField("recipe", T.StringType()), T.StructField("word", T.StringType()),
])


def table(spark, rows):
    """Documents from (id, text[, lang[, source]]) rows."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", 0, "x", "y", "z") for r in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def documents(spark):
    return lambda rows: table(spark, rows)


BASE = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()
ROWS = [
    (1, " ".join(BASE * 3)), (2, " ".join(BASE * 3)), (3, " ".join(BASE * 3).upper()), (4, None), (5, ""), (6, " \n\t"),
    (7, "one two"), (8, "ONE  two"), (9, "tést ñandú 漢字 it's <|endoftext|>  x"), (10, "x" * 5000), (11, " ".join(BASE * 3 + ["tail"])),
    (12, "\n".join(" ".join(BASE[i:] + BASE[:i]) for i in range(12))), (None, "no id at all here today"), (1, " ".join(BASE * 3)),
]


@pytest.fixture(scope="session")
def odd(spark):
    return table(spark, ROWS)


@pytest.fixture(scope="session")
def none(spark):
    return table(spark, [])
