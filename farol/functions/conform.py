"""Conformance of untrusted source columns to numbers, keys and domains."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from farol import constants as K


NUMBER = r"^\s*[-+]?(?:[0-9]+\.?[0-9]*(?:[eE][-+]?[0-9]+)?|\.[0-9]+(?:[eE][-+]?[0-9]+)?|(?i:inf|infinity))\s*$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c: Column | str) -> Column:
    """Keep NULL as the only missing value: one NaN would poison every mean it meets."""
    c = _col(c)
    return F.when(~F.isnan(c), c)


def text_double(c: Column | str) -> Column:
    """E9 for text: double or NULL.

    The pattern admits whole numbers only: a plain cast would also read type
    suffixes such as ``1.5d``, and a failed one costs several times a match.
    """
    c = _col(c)
    return nan_to_null(F.when(c.rlike(NUMBER), c.try_cast("double")))


def decimal_text(c: Column | str) -> Column:
    """Text with a decimal comma to double; anything unparsable is NULL."""
    return text_double(F.replace(_col(c).cast("string"), F.lit(","), F.lit(".")))


def safe_double(c: Column | str) -> Column:
    """E9 for numbers: double or NULL."""
    return nan_to_null(_col(c).try_cast("double"))


def safe_long(c: Column | str) -> Column:
    """Long or NULL."""
    return _col(c).try_cast("bigint")


def hard_long(c: Column | str) -> Column:
    """Long, failing the job on bad input under ANSI mode."""
    return _col(c).cast("bigint")


def key6(c: Column | str) -> Column:
    """Municipality code without its check digit."""
    return F.substring(_col(c).cast("string"), 1, 6)


def key7(c: Column | str) -> Column:
    """E5: full municipality code, trimmed."""
    return F.trim(_col(c).cast("string"))


def state_code(c: Column | str) -> Column:
    """Two-digit state prefix of a municipality code."""
    return F.substring(_col(c).cast("string"), 1, 2)


def integer_key(c: Column | str) -> Column:
    """Canonical text of an integer id; NULL when it is not an integer."""
    return safe_long(c).cast("string")


def network(c: Column | str) -> Column:
    """E5: network name as carried by the mart."""
    return F.trim(_col(c))


def network_title(c: Column | str) -> Column:
    """Network name from a lower-case source."""
    return F.initcap(F.trim(_col(c)))


def network_from_code(c: Column | str) -> Column:
    """Network name from its census code; other codes are NULL."""
    code = F.trim(_col(c).cast("string"))
    out = None
    for value, name in K.NETWORK_OF_CODE.items():
        out = F.when(code == value, name) if out is None else out.when(code == value, name)
    return out


def indicator(condition: Column) -> Column:
    """1.0 where true, 0.0 where false or unknown."""
    return F.when(condition, F.lit(1.0)).otherwise(F.lit(0.0))


def hit(c: Column | str) -> Column:
    """1 where the joined side was found."""
    return _col(c).isNotNull().cast("int")


def gap(value: Column | str, goal: Column | str) -> Column:
    """Distance to a goal; NULL when either side is unknown."""
    return _col(value) - _col(goal)
