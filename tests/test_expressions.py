import math

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from farol.functions import conform as C
from farol.functions import rules


def values(spark, kind, rows, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(rows)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(expr).collect()]


def test_locale_decimal(spark):
    rows = ["12,5", "1.234,5", "", "NaN", None, " 7,25 ", "-3,5", "n/d", ",5", "+2", "1e3"]
    assert values(spark, "string", rows, C.decimal_text("x")) == [
        12.5, None, None, None, None, 7.25, -3.5, None, 0.5, 2.0, 1000.0
    ]


def test_keys(spark):
    assert values(spark, "string", ["3550308", None], C.key6("x")) == ["355030", None]
    assert values(spark, "string", ["3550308"], C.state_code("x")) == ["35"]
    assert values(spark, "string", [" 60000001 ", "12.0", "x", None], C.integer_key("x")) == [
        "60000001", None, None, None
    ]


def test_networks(spark):
    assert values(spark, "string", ["2", " 3 ", "4", None], C.network_from_code("x")) == [
        "Estadual", "Municipal", None, None
    ]
    assert values(spark, "string", [" estadual", "municipal "], C.network_title("x")) == ["Estadual", "Municipal"]


def test_flags_and_means_treat_null_differently(spark):
    df = spark.createDataFrame([(1, None), (None, None), (0, 0)], "a int, b int")
    flag = C.indicator((F.col("a") == 1) | (F.col("b") == 1))
    assert [r[0] for r in df.select(flag).collect()] == [1.0, 0.0, 0.0]
    one = df.agg(F.avg(C.indicator(F.col("a") == 1)), F.avg(C.safe_double("a"))).first()
    assert one[0] == pytest.approx(1 / 3) and one[1] == 0.5


def test_nan_becomes_null(spark):
    assert values(spark, "double", [math.nan, 1.0, None], C.safe_double("x")) == [None, 1.0, None]


def test_hard_cast_fails_on_bad_text(spark):
    with pytest.raises(PySparkException):
        values(spark, "string", ["20x3"], C.hard_long("x"))


def test_labels(spark):
    rows = ["Não", "Nao", "0", "Sim", "1"]
    assert values(spark, "string", rows, rules.strict_label("x")) == [0, 0, 0, 1, 1]
    assert values(spark, "int", [0, 1], rules.strict_label("x")) == [0, 1]
    assert values(spark, "string", ["talvez", None], rules.label_or_null("x")) == [None, None]


@pytest.mark.parametrize("bad", ["talvez", None])
def test_strict_label_fails(spark, bad):
    with pytest.raises(PySparkException, match="unmapped label"):
        values(spark, "string", ["Sim", bad], rules.strict_label("x"))


def test_rounding(spark):
    assert values(spark, "double", [0.125, 2.5], rules.round_even("x", 2)) == [0.12, 2.5]
    assert values(spark, "double", [0.125], rules.round_away("x", 2)) == [0.13]
    assert values(spark, "double", [2.5], rules.round_even("x", 0)) == [2.0]


def test_clip_decide_share(spark):
    assert values(spark, "double", [1.0, -1.0, None], rules.clip_upper("x", 0.0)) == [0.0, -1.0, None]
    assert values(spark, "double", [0.55, 0.5499], rules.decide("x", 0.55)) == [1, 0]
    assert values(spark, "double", [2.0, 0.0], rules.share(F.lit(1.0), F.col("x"))) == [0.5, None]


def test_tiers(spark):
    # Current rate 0, so only the pace decides, except for the first row.
    pace = values(spark, "double", [3.0, 3.01, 7.0, 7.01], rules.goal_tier(F.lit(0.0), F.lit(80.0), F.col("x")))
    assert pace == ["Provavel atingir", "Risco moderado", "Risco moderado", "Risco alto de nao atingir"]
    assert values(spark, "double", [0.0], rules.goal_tier(F.lit(80.0), F.lit(80.0), F.col("x"))) == ["Meta ja atingida"]


def test_readable_names(spark):
    rows = ["numeric__meta_2024", "categorical__sigla_uf_code_23", "categorical__sigla_uf_code_99",
            "categorical__rede_Estadual"]
    assert values(spark, "string", rows, rules.readable_feature("x")) == [
        "meta_2024", "UF: CE", "UF: 99", "Rede: Estadual"
    ]


def test_type_suffixes_are_no_numbers(spark):
    df = spark.createDataFrame([("1,5d",), ("1,5f",), ("1,5",), (" -2 ",), (",5",), ("1e3",), ("x",), ("1,2,3",)], "v string")
    assert [r[0] for r in df.select(C.decimal_text("v")).collect()] == [None, None, 1.5, -2.0, 0.5, 1000.0, None, None]


def test_modes_with_quotes_and_without_values(spark):
    from farol.operators.prepare import preprocessor

    df = spark.createDataFrame([("D'Oeste\\", None, 1.0), ("D'Oeste\\", None, 2.0), (None, None, 3.0)], "a string, b string, n double")
    assert preprocessor(df, ["n"], ["a", "b"]).fit(df).transform(df).select("a_f", "b_f").distinct().collect() == [("D'Oeste\\", "sem valor")]


def test_number_without_any_value_is_left_out(spark):
    from farol.operators.prepare import feature_names, preprocessor
    df = spark.createDataFrame([(1.0, None, "x"), (2.0, float("nan"), "y"), (None, None, "x")], "n double, none double, a string")
    for numeric, expected in ((["n", "none"], ["numeric__n"]), (["none"], [])):
        fitted = preprocessor(df, numeric, ["a"]).fit(df)
        names = feature_names(fitted, numeric, ["a"])
        assert names == [*expected, "categorical__a_x", "categorical__a_y"]
        assert {len(r["features"]) for r in fitted.transform(df).collect()} == {len(names)}
