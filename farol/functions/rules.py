"""Labels, scores and policy rules as column expressions."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from farol import constants as K


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def label_or_null(c: Column | str = K.TARGET) -> Column:
    """1 / 0 for known labels, NULL for the rest."""
    text = _col(c).cast("string")
    return F.when(text.isin(K.LABEL_POSITIVE), 1).when(text.isin(K.LABEL_NEGATIVE), 0)


def strict_label(c: Column | str = K.TARGET) -> Column:
    """1 / 0 for known labels; any other value, NULL included, fails the job."""
    mapped = label_or_null(c)
    bad = F.concat(F.lit("unmapped label: "), F.coalesce(_col(c).cast("string"), F.lit("NULL")))
    return F.when(mapped.isNull(), F.raise_error(bad).cast("int")).otherwise(mapped)


def risk(probability: Column | str) -> Column:
    """Probability of the unwanted class."""
    return F.lit(1.0) - _col(probability)


def clip_upper(c: Column | str, bound: float) -> Column:
    """Values above the bound become the bound; NULL stays NULL."""
    c = _col(c)
    return F.when(c > bound, F.lit(bound)).otherwise(c)


def decide(probability: Column | str, threshold: float) -> Column:
    """Class 1 at or above the cut."""
    return (_col(probability) >= threshold).cast("int")


def round_even(c: Column | str, digits: int) -> Column:
    """Half-to-even rounding, as the report tables use."""
    return F.bround(_col(c), digits)


def round_away(c: Column | str, digits: int) -> Column:
    """Half-away rounding, as warehouse SQL uses."""
    return F.round(_col(c), digits)


def share(part: Column, whole: Column) -> Column:
    """Part / whole, NULL for an empty whole."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def lookup(c: Column | str, mapping: dict) -> Column:
    """Mapped value, NULL when the key is unknown."""
    pairs = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    return F.try_element_at(pairs, _col(c))


def state_name(code: Column | str) -> Column:
    """State abbreviation of a two-digit code."""
    return lookup(code, K.STATES)


def goal_tier(current: Column, goal: Column, pace: Column) -> Column:
    """First matching tier, from goal met to high risk."""
    met, likely, moderate, high = K.TIERS
    return (
        F.when(current >= goal, met)
        .when(pace <= K.TIER_PACE[0], likely)
        .when(pace <= K.TIER_PACE[1], moderate)
        .otherwise(high)
    )


def readable_feature(c: Column | str) -> Column:
    """Label for an encoded feature name such as ``categorical__sigla_uf_code_23``."""
    name = F.regexp_replace(_col(c), "^.*?__", "")
    code = F.regexp_extract(name, "^sigla_uf_code_(.*)$", 1)
    net = F.regexp_extract(name, "^rede_(.*)$", 1)
    return (
        F.when(code != "", F.concat(F.lit("UF: "), F.coalesce(state_name(code), code)))
        .when(net != "", F.concat(F.lit("Rede: "), net))
        .otherwise(name)
    )


def key_range(key: Column) -> tuple[Column, Column]:
    """Smallest and largest key as aggregates: by value where keys are integers, else by text."""
    number = key.try_cast("bigint")
    rank = F.when(number.isNotNull(), F.struct(number, key))
    return F.coalesce(F.min_by(key, rank), F.min(key)), F.coalesce(F.max_by(key, rank), F.max(key))
