"""State dimension."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farol import constants as K


def states(spark: SparkSession) -> DataFrame:
    """27 rows, fixed by law, so it may always be broadcast."""
    pairs = F.create_map(*[F.lit(x) for x in chain.from_iterable(K.STATES.items())])
    return spark.range(1, numPartitions=1).select(F.explode(pairs).alias("sigla_uf_code", "uf"))
