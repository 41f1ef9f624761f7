"""Stable hash numbers, equal on every run and engine.

Sampling, splitting and folding use these instead of random draws: a retried
task repeats its answer, and no shuffle is needed to decide where a row goes.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = 1 << 32


def hash_number(salt: str, *cols: Column | str) -> Column:
    """Number in [0, 2**32) from the first 32 bits of an md5 digest."""
    text = [F.coalesce(F.col(c).cast("string") if isinstance(c, str) else c.cast("string"), F.lit("~"))
            for c in cols]
    digest = F.md5(F.concat_ws("|", F.lit(salt), *text).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def below(number: Column, fraction: Column | float) -> Column:
    """True for the given fraction of the hash range."""
    if not isinstance(fraction, Column):
        fraction = F.lit(float(fraction))
    return number.cast("double") < fraction * F.lit(float(SPAN))
