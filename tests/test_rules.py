"""Golden values of the business rules, for inputs the driver tables do not reach."""

from datetime import date, datetime

import pytest
from pyspark.errors import ArithmeticException
from pyspark.sql import functions as F

from moraflow.functions import dates, rules


def values(spark, rows, schema, column):
    df = spark.createDataFrame(rows, schema)
    return [r[0] for r in df.coalesce(1).select(column).collect()]


def test_portfolio(spark):
    names = [
        ("Cartera_Agencia_Cobranding_Gestion_Temprana_20250617.txt",), ("Cartera_Gestion_CF_ANN_20250617.txt",),
        ("x_cuota_fija_1.txt",), ("Cartera_Gestion_AN_20250617.txt",), ("altas_nuevas.txt",), ("Cobranding.txt",),
        ("Other_File_Name.txt",), (None,),
    ]
    expected = [
        "TEMPRANA", "CUOTA_FIJA_ANUAL", "CUOTA_FIJA_ANUAL", "ALTAS_NUEVAS", "ALTAS_NUEVAS", "COBRANDING", "OTRAS",
        "OTRAS",
    ]
    assert values(spark, names, "a string", rules.portfolio(F.col("a"))) == expected
    stored = values(spark, names, "a string", rules.portfolio(F.col("a"), alternates=False))
    assert stored[2] == "OTRAS" and stored[4] == "OTRAS"


def test_objective(spark):
    rows = [("AL VCTO",), ("ENTRE 4 Y 15D",), ("TEMPRANA",), ("TARDIA",), ("OTHER",), (None,)]
    assert values(spark, rows, "s string", rules.objective(F.col("s"))) == [0.15, 0.25, 0.2, 0.3, 0.2, 0.2]
    assert values(spark, rows, "s string", rules.objective(F.col("s"), late_rate=False))[3] == 0.2


def test_due_category(spark):
    ref = F.lit(date(2025, 6, 19))
    days = [
        None, date(2025, 6, 19), date(2025, 7, 19), date(2025, 7, 20), date(2025, 8, 18), date(2025, 8, 19),
        date(2025, 9, 17), date(2025, 9, 18),
    ]
    assert values(spark, [(d,) for d in days], "d date", rules.due_category(F.col("d"), ref)) == [
        "SIN_VENCIMIENTO", "VENCIDO", "POR_VENCER_30D", "POR_VENCER_60D", "POR_VENCER_60D", "POR_VENCER_90D",
        "POR_VENCER_90D", "VIGENTE_MAS_90D",
    ]
    old = [(date(1900, 1, 1),)]
    assert values(spark, old, "d date", rules.due_category(F.col("d"), ref)) == ["VENCIDO"]
    assert values(spark, old, "d date", rules.due_category(F.col("d"), ref, sentinel=True)) == ["SIN_VENCIMIENTO"]


def test_segment(spark):
    rows = [("AL VCTO", "SI", "3"), (None, "SI", None), (None, "NO", None), ("X", "NO", " "), ("X", "NO", "0")]
    label = rules.segment_label(F.col("t"), F.col("f"), F.col("q"))
    assert values(spark, rows, "t string, f string, q string", label) == [
        "AL VCTO - FRACCIONADO - CUOTA_3", " - FRACCIONADO", "NO_ESPECIFICADO", "X", "X",
    ]


def test_response(spark):
    rows = [(" a ", None, "c", "M"), (None, " ", None, "M"), (None, None, None, None)]
    gloss = rules.detailed_response(F.col("a"), F.col("b"), F.col("c"), F.col("m"))
    assert values(spark, rows, "a string, b string, c string, m string", gloss) == ["a - c", "M", "NO_DISPONIBLE"]


def test_file_date(spark):
    names = [
        ("X_20250617.txt",), ("TRAN_DEUDA_1706.txt",), ("P_17062025.txt",), ("TRAN_DEUDA_3102.txt",), ("abc.txt",),
        (None,),
    ]
    day = date(2025, 6, 17)
    assert values(spark, names, "a string", dates.file_date(F.col("a"), F.lit(2025))) == [
        day, day, day, None, None, None,
    ]


def test_debt_date(spark):
    made = datetime(2025, 6, 20, 6)
    rows = [("TRAN_DEUDA_1706.txt", made), ("TRAN_DEUDA_3102.txt", made), ("OTRO.txt", made), (None, made)]
    built = dates.debt_date(F.col("a"), F.col("c"))
    assert values(spark, rows, "a string, c timestamp", built) == [
        date(2025, 6, 17), None, date(2025, 6, 20), date(2025, 6, 20),
    ]


def test_attribution_score(spark):
    p, g = date(2025, 6, 10), date(2025, 6, 1)
    rows = [
        (1, p, p, g), (1, p, date(2025, 6, 13), g), (1, p, date(2025, 5, 31), date(2025, 5, 1)),
        (1, p, date(2025, 6, 15), g), (0, None, date(2025, 6, 8), g), (0, None, date(2025, 6, 9), g),
        (None, None, p, None), (1, p, date(2025, 6, 18), date(2025, 6, 17)),
    ]
    score = rules.attribution_score(F.col("e"), F.col("p"), F.col("q"), F.col("g"))
    assert values(spark, rows, "e int, p date, q date, g date", score) == [1.0, 0.8, 0.8, 0.6, 0.4, 0.2, 0.0, 0.4]


def test_payment_flags_are_never_null(spark):
    p = date(2025, 6, 10)
    rows = [(None, None, p), (1, None, p), (1, p, p), (1, p, date(2025, 6, 17)), (1, p, date(2025, 6, 9)), (0, p, p)]
    schema = "e int, p date, q date"
    e, promised, paid = F.col("e"), F.col("p"), F.col("q")
    assert values(spark, rows, schema, rules.paid_with_promise(e)) == [False, True, True, True, True, False]
    live = rules.promise_was_live(e, promised, paid)
    assert values(spark, rows, schema, live) == [False, False, True, True, False, False]
    on_time = rules.paid_on_time(e, promised, paid)
    assert values(spark, rows, schema, on_time) == [False, False, True, False, False, False]


def test_ratios_and_money(spark):
    rows = [(1.0, 0.0), (1.0, 4.0), (1.0, -4.0), (None, 2.0)]
    schema = "a double, b double"
    assert values(spark, rows, schema, rules.ratio(F.col("a"), F.col("b"))) == [None, 0.25, -0.25, None]
    assert values(spark, rows, schema, rules.ratio_or_zero(F.col("a"), F.col("b"))) == [0.0, 0.25, 0.0, 0.0]
    rare = spark.createDataFrame([(1, 3_000_000)], "a long, b long").select(rules.ratio(F.col("a"), F.col("b")).alias("r"))
    assert rare.first()[0] == 1 / 3_000_000
    assert rare.agg(rules.mean_of(F.col("r"))).first()[0] == 3.33e-07
    amounts = spark.createDataFrame([(0.1,), (0.2,), (None,), (1e9 + 0.01,)], "a double")
    assert amounts.agg(rules.money_sum(F.col("a"))).first()[0] == 1000000000.31
    assert amounts.where("a > 1e12").agg(rules.money_sum(F.col("a"))).first()[0] == 0.0
    with pytest.raises(ArithmeticException):
        spark.createDataFrame([(float("nan"),)], "a double").agg(rules.money_sum(F.col("a"))).collect()


def test_effective_and_commitment(spark):
    rows = [("CONTACTO_EFECTIVO",), ("contacto_no_efectivo",), ("Contacto_Efectivo",), ("Compromiso_Pago",), (None,)]
    m = F.col("m")
    assert values(spark, rows, "m string", rules.is_effective_like(m)) == [True, True, True, False, False]
    assert values(spark, rows, "m string", rules.is_effective_exact(m)) == [True, False, True, False, False]
    assert values(spark, rows, "m string", rules.declares_commitment(m)) == [False, False, False, True, False]


def test_labels(spark):
    assert values(spark, [(1.0,), (0.8,), (0.79,), (None,)], "a double", rules.objective_status(F.col("a"))) == [
        "🟢 SUPERADO", "🟡 EN RANGO", "🔴 BAJO OBJETIVO", "🔴 BAJO OBJETIVO",
    ]
    assert values(spark, [(0,), (999,), (1000,)], "n int", rules.check_label(F.col("n"))) == [
        "✅ OK", "⚠️ REVISAR", "❌ PROBLEMA",
    ]
