"""Exploratory profile and data audits."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farol import constants as K
from farol.functions import conform as C
from farol.functions import rules
from farol.operators.order import exact_quantiles

QUARTILES = {"q1": 0.25, "mediana": 0.5, "q3": 0.75}


# Values enter sums of products as whole parts of this size, so sums are exact and no order of rows or tasks changes a bit
# (38 digits: values of 100,000 over 10^12 rows).
SCALE = 100_000_000


def _comoments(df: DataFrame, values: dict[str, Column], pairs: list[tuple[str, str]]) -> DataFrame:
    """(a, b, corr) over the rows where both are set; NULL where one of them is constant or no such row exists.

    Rows are summed per pattern of missing values, one aggregate with a task
    sending a row per pattern; pairs are drawn from those few rows. Values
    that are no number of 10 digits before the point count as missing.
    """
    names = list(values)
    whole = df.select(*[F.round(v.cast("double") * SCALE).try_cast("decimal(18,0)").alias(f"v{i}") for i, v in enumerate(values.values())])
    x = [F.col(f"v{i}") for i in range(len(names))]
    at = {n: i for i, n in enumerate(names)}
    wanted = {(at[a], at[b]) for a, b in pairs} | {(i, i) for i in range(len(names))}
    held = whole.groupBy(F.concat(*[F.when(c.isNull(), "-").otherwise("x") for c in x]).alias("known")).agg(
        F.count(F.lit(1)).cast("decimal(18,0)").alias("n"), *[F.sum(c).cast("decimal(38,0)").alias(f"s{i}") for i, c in enumerate(x)],
        *[F.sum((x[i] * x[j]).cast("decimal(36,0)")).cast("decimal(38,0)").alias(f"p{i}_{j}") for i, j in sorted(wanted)])

    def both(a: str, b: str, c: Column) -> Column:
        known = (F.substring("known", at[a] + 1, 1) == "x") & (F.substring("known", at[b] + 1, 1) == "x")
        return F.when(known, c)

    rows = held.select(_rows([
        F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), *[both(a, b, F.col(c)).alias(name) for name, c in (
            ("n", "n"), ("sx", f"s{at[a]}"), ("sy", f"s{at[b]}"), ("xx", f"p{at[a]}_{at[a]}"), ("yy", f"p{at[b]}_{at[b]}"), ("xy", f"p{at[a]}_{at[b]}"))])
        for a, b in pairs
    ]))
    sums = rows.groupBy("a", "b").agg(*[F.sum(c).cast("decimal(38,0)").alias(c) for c in ("n", "sx", "sy", "xx", "yy", "xy")])

    def whole_mean(s: str) -> Column:
        return F.round(F.try_divide(F.col(s), F.col("n")), 0).cast("decimal(18,0)")

    # About a whole number near the mean, still exact; what the mean lies beside it is taken off at the end.
    near = sums.withColumns({"mx": whole_mean("sx"), "my": whole_mean("sy")})
    n, mx, my = F.col("n"), F.col("mx"), F.col("my")

    def about(p: str, s: str, t: str, m: Column, k: Column) -> Column:
        return F.col(p) - (m * F.col(t)).cast("decimal(38,0)") - (k * F.col(s)).cast("decimal(38,0)") + (
            (m * k).cast("decimal(38,0)") * n).cast("decimal(38,0)")

    def beside(s: str, m: Column) -> Column:
        return (F.col(s) - (m * n).cast("decimal(38,0)")).cast("double")

    rx, ry, rows_ = beside("sx", mx), beside("sy", my), n.cast("double")
    xy = about("xy", "sx", "sy", mx, my).cast("double") - rx * ry / rows_
    xx = about("xx", "sx", "sx", mx, mx).cast("double") - rx * rx / rows_
    yy = about("yy", "sy", "sy", my, my).cast("double") - ry * ry / rows_
    return near.select("a", "b", F.try_divide(xy, F.sqrt(xx) * F.sqrt(yy)).alias("corr"))


def _rows(structs: list[Column]) -> Column:
    """Turn columns of one aggregate row into rows."""
    return F.inline(F.array(*structs))


def null_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """Missing count and percent per column, in one pass."""
    one = df.agg(
        F.count(F.lit(1)).alias("_all"), *[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in columns]
    )
    return one.select(_rows([
        F.struct(
            F.lit(c).alias("variavel"), F.col(c).alias("nulos"),
            rules.round_even(rules.share(F.col(c), F.col("_all")) * 100, 2).alias("pct"),
        ) for c in columns
    ]))


def columns_with_nulls(df: DataFrame, columns: list[str]) -> DataFrame:
    """Only columns that miss something, worst first."""
    return null_profile(df, columns).where(F.col("nulos") > 0).orderBy(F.desc("pct"), "variavel")


def value_shares(df: DataFrame, column: str) -> DataFrame:
    """Rows and percent per value, NULL excluded."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("pct", rules.share(F.col("n"), total) * 100)


def positive_rate(df: DataFrame, *keys: str) -> DataFrame:
    """Rows and percent of positive labels per key."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        (F.avg(C.indicator(F.col(K.TARGET) == "Sim")) * 100).alias("taxa"),
    )


def state_rates(df: DataFrame) -> DataFrame:
    """Positive rate per known state."""
    named = df.withColumn("uf", rules.state_name("sigla_uf_code")).where(F.col("uf").isNotNull())
    return positive_rate(named, "uf")


def rate_range(rates: DataFrame) -> DataFrame:
    """Spread of the rates and their unweighted mean."""
    return rates.agg(
        F.count(F.lit(1)).alias("grupos"),
        F.min("taxa").alias("taxa_min"), F.max("taxa").alias("taxa_max"),
        (F.max("taxa") - F.min("taxa")).alias("amplitude"),
        F.avg("taxa").alias("media_nao_ponderada"),
    )


def describe(df: DataFrame, columns: list[str], ranges: int = 256) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact quartiles."""
    aggs = []
    for c in columns:
        aggs += [
            F.count(c).alias(f"n_{c}"), F.avg(c).alias(f"m_{c}"), F.stddev_samp(c).alias(f"s_{c}"),
            F.min(c).cast("double").alias(f"a_{c}"), F.max(c).cast("double").alias(f"z_{c}"),
        ]
    moments = df.agg(*aggs).select(_rows([
        F.struct(
            F.lit(c).alias("variavel"), F.col(f"n_{c}").alias("count"), F.col(f"m_{c}").alias("mean"),
            F.col(f"s_{c}").alias("std"), F.col(f"a_{c}").alias("min"), F.col(f"z_{c}").alias("max"),
        ) for c in columns
    ]))
    quartiles = exact_quantiles(df, columns, QUARTILES, ranges=ranges).drop("n")
    return moments.join(quartiles, "variavel", "left")


def correlations(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson correlation of every column pair over their common rows; NULL where it is not defined."""
    return _comoments(df, {c: F.col(c) for c in columns}, list(combinations(columns, 2)))


def correlation_to_target(df: DataFrame, columns: list[str]) -> DataFrame:
    """Correlation of each column with the 0/1 label, strongest first."""
    values = {c: F.col(c) for c in columns} | {"": rules.label_or_null()}
    found = _comoments(df, values, [(c, "") for c in columns])
    return found.select(F.col("a").alias("variavel"), "corr").orderBy(F.desc_nulls_last("corr"), "variavel")


def box_stats(df: DataFrame, measure: str, by: str, ranges: int = 256) -> DataFrame:
    """Quartiles, whiskers at 1.5 IQR and outliers of a measure per class."""
    q = exact_quantiles(df, [measure], QUARTILES, [by], ranges).drop("variavel")
    spread = F.col("q3") - F.col("q1")
    q = q.withColumns({"_lo": F.col("q1") - 1.5 * spread, "_hi": F.col("q3") + 1.5 * spread})
    x = F.col(measure)
    inside = x.between(F.col("_lo"), F.col("_hi"))
    # Equal values are merged first: the join then moves distinct values, not rows.
    values = df.where(x.isNotNull()).groupBy(by, measure).agg(F.count(F.lit(1)).alias("_n"))
    return values.join(q, by).groupBy(by).agg(
        F.max("n").alias("n"), F.min(x).alias("min"), F.max("q1").alias("q1"),
        F.max("mediana").alias("mediana"), F.max("q3").alias("q3"), F.max(x).alias("max"),
        F.min(F.when(inside, x)).alias("haste_inferior"), F.max(F.when(inside, x)).alias("haste_superior"),
        F.sum(F.when(inside, 0).otherwise(F.col("_n"))).alias("discrepantes"),
    )


def density_histogram(df: DataFrame, measure: str, by: str, bins: int = 50) -> DataFrame:
    """Equal bins over the shared range, each class normalised to area one."""
    data = df.where(F.col(measure).isNotNull() & F.col(by).isNotNull())
    lo, hi = F.min(measure), F.max(measure)
    # A constant measure gets a range of width one around it.
    pad = F.when(lo == hi, 0.5).otherwise(0.0)
    edges = data.agg(F.struct((lo - pad).alias("lo"), (hi + pad).alias("hi"))).scalar()
    width = (F.col("_e.hi") - F.col("_e.lo")) / bins
    slot = F.least(F.floor((F.col(measure) - F.col("_e.lo")) / width).cast("int"), F.lit(bins - 1))
    counts = (
        data.withColumn("_e", edges)
        .groupBy(by, slot.alias("faixa"), F.col("_e.lo").alias("_lo"), width.alias("_w"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    totals = counts.groupBy(by).agg(F.sum("n").alias("_total"))
    return counts.join(totals, by).select(
        by, "faixa", (F.col("_lo") + F.col("faixa") * F.col("_w")).alias("inicio"), "n",
        F.try_divide(F.col("n").cast("double"), F.col("_total") * F.col("_w")).alias("densidade"),
    )


def duplicate_students(df: DataFrame) -> DataFrame:
    """Students, those with more than one row, and their percent."""
    return df.groupBy(K.GROUP).agg(F.count(F.lit(1)).alias("n")).agg(
        F.count(F.lit(1)).alias("alunos"), F.count(F.when(F.col("n") > 1, 1)).alias("duplicados")
    ).withColumn("pct", rules.round_away(rules.share(F.col("duplicados"), F.col("alunos")) * 100, 2))


def id_audit(df: DataFrame, columns: list[str]) -> DataFrame:
    """Filled rows, distinct values and range per column, all as text of one long table."""
    least, greatest = rules.key_range(F.col("valor"))
    return (
        df.select(*[F.col(c).cast("string").alias(c) for c in columns])
        .unpivot([], columns, "coluna", "valor").where(F.col("valor").isNotNull())
        .groupBy("coluna", "valor").agg(F.count(F.lit(1)).alias("n"))
        .groupBy("coluna").agg(
            F.sum("n").alias("linhas"), F.count(F.lit(1)).alias("distintos"),
            least.alias("menor"), greatest.alias("maior"), F.max("n").alias("maior_grupo"),
        )
    )


def cell_grain(cells: DataFrame) -> DataFrame:
    """Cells against municipalities, schools per cell, single-school cells."""
    return cells.groupBy("id_municipio_7dig").agg(
        F.count(F.lit(1)).alias("n"), F.sum("n_escolas_censo_celula").alias("escolas"),
        F.count(F.when(F.col("n_escolas_censo_celula") == 1, 1)).alias("unicas"),
    ).agg(
        F.sum("n").alias("celulas"), F.count(F.lit(1)).alias("municipios"),
        rules.share(F.sum("escolas"), F.sum("n")).alias("escolas_por_celula"),
        F.sum("unicas").alias("celulas_escola_unica"),
    )


def coverage_by_year(df: DataFrame, columns: list[str]) -> DataFrame:
    """Percent of filled rows per column and year."""
    return df.groupBy("ano").agg(
        F.count(F.lit(1)).alias("_n"), *[F.count(c).alias(c) for c in columns]
    ).select("ano", _rows([
        F.struct(
            F.lit(c).alias("variavel"), F.col(c).alias("preenchidas"), F.col("_n").alias("linhas"),
            (rules.share(F.col(c), F.col("_n")) * 100).alias("cobertura_pct"),
        ) for c in columns
    ]))


def coverage(df: DataFrame, columns: list[str]) -> DataFrame:
    """Percent of filled rows per column, all years."""
    by_year = coverage_by_year(df, columns)
    return by_year.groupBy("variavel").agg(
        (rules.share(F.sum("preenchidas"), F.sum("linhas")) * 100).alias("cobertura_pct")
    )


def missing_as_proxy(df: DataFrame, columns: list[str], spread: float = 50.0) -> DataFrame:
    """Q3: columns whose coverage depends on the year, so that being filled tells the year."""
    return coverage_by_year(df, columns).groupBy("variavel").agg(
        F.min("cobertura_pct").alias("cobertura_min"), F.max("cobertura_pct").alias("cobertura_max")
    ).withColumn("amplitude", F.col("cobertura_max") - F.col("cobertura_min")).withColumn(
        "proxy_do_ano", (F.col("amplitude") >= spread).cast("int")
    )


def label_cut(students: DataFrame, cut: float) -> DataFrame:
    """Q1: rows that break ``label positive <=> measure >= cut``, each way."""
    above, positive = F.col("proficiencia") >= cut, F.col("alfabetizado") == "Sim"
    return students.agg(
        F.count(F.lit(1)).alias("linhas"),
        F.count(F.when(positive & ~above, 1)).alias("sim_abaixo_do_corte"),
        F.count(F.when(~positive & above, 1)).alias("nao_acima_do_corte"),
        F.min(F.when(positive, F.col("proficiencia"))).alias("menor_sim"),
        F.max(F.when(~positive, F.col("proficiencia"))).alias("maior_nao"),
    )


def constant_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Q2: numeric columns with one distinct value: smallest equals largest."""
    one = df.agg(*[
        F.struct(F.min(c).cast("double").alias("lo"), F.max(c).cast("double").alias("hi")).alias(c) for c in columns
    ])
    return one.select(_rows([
        F.struct(F.lit(c).alias("variavel"), F.col(f"{c}.lo").alias("valor"),
                 (F.col(f"{c}.lo") == F.col(f"{c}.hi")).alias("constante"))
        for c in columns
    ])).where("constante").drop("constante")


def collinear_pairs(df: DataFrame, columns: list[str], tolerance: float = 1e-9) -> DataFrame:
    """Q2: pairs that repeat each other, |corr| = 1 within the tolerance."""
    return correlations(df, columns).where(F.abs("corr") >= 1 - tolerance)


def dense_ids(df: DataFrame, columns: list[str], density: float = 0.99) -> DataFrame:
    """Q4: ids that fill their own range look like a counter given on anonymisation."""
    return (
        df.select(*[C.safe_long(c).alias(c) for c in columns])
        .unpivot([], columns, "coluna", "valor").where(F.col("valor").isNotNull())
        .groupBy("coluna", "valor").agg(F.lit(1).alias("one"))
        .groupBy("coluna").agg(
            F.count(F.lit(1)).alias("distintos"), F.min("valor").alias("menor"), F.max("valor").alias("maior")
        )
        .withColumn("faixa", F.col("maior") - F.col("menor") + 1)
        .withColumn("densidade", rules.share(F.col("distintos"), F.col("faixa")))
        .withColumn("parece_contador", (F.col("densidade") >= density).cast("int"))
    )


def shape(df: DataFrame) -> DataFrame:
    """Rows and columns."""
    return df.agg(F.count(F.lit(1)).alias("linhas")).withColumn("colunas", F.lit(len(df.columns)))
