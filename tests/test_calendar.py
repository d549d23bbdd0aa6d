"""Golden dates of the business-day calendar."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from moraflow.functions import dates
from moraflow.operators import calendar as cal


@pytest.fixture(scope="module")
def days(spark):
    span = cal.date_range(spark, date(2024, 1, 1), date(2025, 12, 31))
    return {r.fecha: r for r in cal.business_calendar(span).collect()}


@pytest.mark.parametrize(
    "day, number, previous",
    [
        (date(2025, 6, 19), 14, date(2025, 5, 21)),
        (date(2025, 6, 22), 0, None),
        (date(2025, 5, 30), 21, date(2025, 4, 30)),
        (date(2025, 1, 31), 22, date(2024, 12, 31)),
        (date(2025, 1, 2), 1, date(2024, 12, 2)),
        (date(2025, 4, 17), 0, None),
        (date(2025, 3, 31), 21, date(2025, 2, 28)),
        (date(2025, 9, 30), 22, date(2025, 8, 29)),
        (date(2024, 1, 15), 10, date(2023, 12, 15)),
    ],
)
def test_golden_days(days, day, number, previous):
    row = days[day]
    assert (row.dia_habil_del_mes, row.fecha_mismo_dia_habil_mes_anterior) == (number, previous)
    assert row.es_dia_habil == (number > 0)


def test_business_days_per_month(days):
    def per_month(year):
        return [days[date(year, m, 1)].total_dias_habiles_mes_actual for m in range(1, 13)]

    assert per_month(2025) == [22, 20, 21, 20, 21, 21, 21, 21, 22, 22, 20, 21]
    assert per_month(2024) == [22, 21, 19, 22, 22, 20, 22, 21, 21, 22, 20, 21]


def test_easter(spark):
    rows = spark.createDataFrame([(2024,), (2025,), (2026,), (1954,), (1981,), (2100,)], "y int")
    assert [r[0] for r in rows.coalesce(1).select(dates.easter(F.col("y"))).collect()] == [
        date(2024, 3, 31), date(2025, 4, 20), date(2026, 4, 5), date(1954, 4, 18), date(1981, 4, 19), date(2100, 3, 28),
    ]


def test_saturdays_ignore_holidays(spark):
    """2025-11-01 is a holiday on a Saturday: a business day once Saturdays count."""
    span = cal.date_range(spark, date(2025, 11, 1), date(2025, 11, 30))
    rows = cal.business_calendar(span, include_saturdays=True).where("fecha = '2025-11-01'").collect()
    assert rows[0].es_dia_habil and rows[0].es_feriado and rows[0].dia_habil_del_mes == 1


def test_custom_holidays(spark):
    closed = spark.createDataFrame([(date(2025, 6, 19), "Local")], "fecha date, nombre_feriado string")
    span = cal.date_range(spark, date(2025, 6, 1), date(2025, 6, 30))
    rows = {r.fecha: r for r in cal.mapping(span, closed).collect()}
    assert len(rows) == 30 and not rows[date(2025, 6, 19)].es_dia_habil
    assert rows[date(2025, 6, 20)].dia_habil_del_mes == 14 and rows[date(2025, 6, 2)].nombre_feriado == ""


def test_stored_table_links_same_number(spark):
    span = cal.date_range(spark, date(2025, 1, 1), date(2025, 12, 31))
    rows = {r.FECHA: r for r in cal.stored_calendar(span).collect()}
    first = rows[date(2025, 2, 3)]
    assert (first.DIA_HABIL_DEL_MES, first.FECHA_MISMO_DIA_HABIL_MES_ANTERIOR) == (1, date(2025, 1, 2))
    assert rows[date(2025, 1, 2)].FECHA_MISMO_DIA_HABIL_MES_ANTERIOR is None
    assert rows[date(2025, 5, 1)].ES_FERIADO and date(2025, 6, 22) not in rows
