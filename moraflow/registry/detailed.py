"""Registered queries: detailed aggregates, first-contact flags, portfolio coverage, business-day calendar."""

from datetime import datetime

from pyspark.sql import functions as F

from moraflow.functions import dates
from moraflow.operators import calendar as cal
from moraflow.operators import first_contact
from moraflow.plans import portfolio, quality
from moraflow.registry.core import EVENT_CALENDAR, ORDER_CALENDAR, enriched_sql, holidays_sql, query

RUN_AT = datetime(2024, 1, 31)


def agregada_sql(compat: bool = False) -> str:
    """CTEs up to `agregada`, grouped from single joined rows."""
    keys = (
        "FECHA_SERVICIO, CARTERA, VENCIMIENTO, FECHA_ASIGNACION, FECHA_CIERRE, OBJ_RECUPERO, GRUPO_RESPUESTA, "
        "GLOSA_RESPUESTA, CANAL, OPERADOR, NIVEL_1, NIVEL_2, NIVEL_3, SERVICIO"
    )
    source = "enr WHERE VENCIMIENTO IS NOT NULL AND FECHA_CIERRE IS NOT NULL" if compat else "enr"
    amounts = "COUNT(*)" if compat else "COUNT(CASE WHEN monto_compromiso > 0 THEN 1 END)"
    return f""", {enriched_sql('SEGMENTO' if compat else 'CARTERA')}, {EVENT_CALENDAR},
    grupos AS (
      SELECT archivo, {keys}, COUNT(*) AS total_interacciones,
        CAST(COALESCE(SUM(CAST(duracion AS DECIMAL(18, 6))), 0) AS DOUBLE) AS duracion_total_minutos,
        CAST(SUM(CAST(duracion AS DECIMAL(18, 6))) AS DOUBLE) / COUNT(duracion) AS duracion_promedio_minutos,
        COUNT(DISTINCT cliente) AS clientes_unicos_contactados,
        COUNT(CASE WHEN efectivo = 1 THEN 1 END) AS contactos_efectivos,
        COUNT(CASE WHEN management LIKE '%Compromiso%' OR management LIKE '%COMPROMISO%' THEN 1 END)
          AS compromisos_declarados,
        COUNT(CASE WHEN es_primera_vez_cliente THEN 1 END) AS primera_vez_contactados,
        COUNT(CASE WHEN es_primer_contacto_efectivo THEN 1 END) AS primera_vez_efectivos,
        COUNT(CASE WHEN f_cartera THEN 1 END) AS primera_vez_cartera_canal,
        CAST(SUM(CAST(monto_compromiso AS DECIMAL(18, 2))) AS DOUBLE) AS monto_total_comprometido,
        {amounts} AS cantidad_compromisos
      FROM {source} GROUP BY archivo, {keys}),
    agregada AS (
      SELECT {keys}, FECHA_ASIGNACION AS FECHA_INICIO_GESTION, total_interacciones, duracion_total_minutos,
        duracion_promedio_minutos, clientes_unicos_contactados, contactos_efectivos, compromisos_declarados,
        primera_vez_contactados, primera_vez_efectivos, primera_vez_cartera_canal, monto_total_comprometido,
        cantidad_compromisos, dia_habil_del_mes, es_dia_habil,
        contactos_efectivos::DOUBLE / total_interacciones AS efectividad_canal,
        cantidad_compromisos::DOUBLE / total_interacciones AS tasa_compromiso,
        COALESCE(primera_vez_contactados::DOUBLE / NULLIF(clientes_unicos_contactados, 0), 0)
          AS ratio_primera_vez,
        COALESCE(total_interacciones::DOUBLE / NULLIF(clientes_unicos_contactados, 0), 0)
          AS interacciones_por_cliente,
        COALESCE(monto_total_comprometido / NULLIF(cantidad_compromisos, 0)::DOUBLE, 0)
          AS monto_promedio_compromiso,
        strftime(FECHA_SERVICIO, '%d/%m/%Y') AS FECHA_FORMATO
      FROM grupos LEFT JOIN cal ON fecha = FECHA_SERVICIO)"""


def _agregada(t, compat=False):
    base = t.base_compat if compat else t.base
    grouped = portfolio.contacts(t.shaped, base)
    return portfolio.aggregate_contacts(grouped, t.calendar_of("events", "ts"), compat)


@query("d1_agregada", agregada_sql() + " SELECT * FROM agregada")
def d1(t):
    return _agregada(t)


@query("d1_compat", agregada_sql(True) + " SELECT * FROM agregada")
def d1_compat(t):
    return _agregada(t, compat=True)


@query("d2_kpis", agregada_sql() + """
SELECT FECHA_SERVICIO, CARTERA, CANAL, OPERADOR, efectividad_canal, tasa_compromiso, ratio_primera_vez,
       interacciones_por_cliente, monto_promedio_compromiso FROM agregada""")
def d2(t):
    return _agregada(t).select(
        "FECHA_SERVICIO", "CARTERA", "CANAL", "OPERADOR", "efectividad_canal", "tasa_compromiso", "ratio_primera_vez",
        "interacciones_por_cliente", "monto_promedio_compromiso",
    )


@query("d3_portfolio", """
SELECT CARTERA, FECHA_ASIGNACION, SERVICIO, COUNT(*) AS total_cod_lunas, COUNT(DISTINCT cuenta) AS cuentas_unicas,
       COUNT(DISTINCT cliente) AS clientes_unicos FROM base_p GROUP BY 1, 2, 3
""")
def d3(t):
    return portfolio.portfolio_counts(t.base)


BASE_PORTFOLIO = """
SELECT CARTERA, FECHA_ASIGNACION, SERVICIO, total_cod_lunas, cuentas_unicas, clientes_unicos, monto_exigible,
       monto_cancelado, CASE WHEN monto_exigible > 0 THEN monto_cancelado / monto_exigible ELSE 0 END
       AS ratio_recuperacion
FROM (SELECT CARTERA, FECHA_ASIGNACION, SERVICIO, COUNT(*) AS total_cod_lunas, COUNT(DISTINCT cuenta) AS cuentas_unicas,
             COUNT(DISTINCT cliente) AS clientes_unicos, CAST(COALESCE(SUM(deuda), 0) AS DOUBLE) AS monto_exigible,
             CAST(COALESCE(SUM(pago), 0) AS DOUBLE) AS monto_cancelado
      FROM base_p b
      LEFT JOIN (SELECT cod_cuenta, {day} SUM(CAST(monto_exigible AS DECIMAL(18, 2))) AS deuda FROM {debt}
                 GROUP BY ALL) d ON CAST(cuenta AS VARCHAR) = cod_cuenta {match}
      LEFT JOIN (SELECT cod_sistema, SUM(CAST(monto_cancelado AS DECIMAL(18, 2))) AS pago FROM pagos GROUP BY 1) p
                ON CAST(cuenta AS VARCHAR) = cod_sistema
      GROUP BY 1, 2, 3)"""


@query("d6_base_cartera", BASE_PORTFOLIO.format(
    day="fecha_deuda_construida,", debt="deuda", match="AND FECHA_TRANDEUDA = fecha_deuda_construida"
))
def d6(t):
    return portfolio.base_portfolio(t.base, t.debt, t.pagos())


@query("d6_compat", BASE_PORTFOLIO.format(day="", debt="tran_deuda", match="").replace("CARTERA", "SEGMENTO").replace(
    "SELECT SEGMENTO, FECHA_ASIGNACION, SERVICIO, total", "SELECT SEGMENTO AS CARTERA, FECHA_ASIGNACION, SERVICIO, total"
))
def d6_compat(t):
    return portfolio.base_portfolio(t.base_compat, t.tran_deuda(), t.pagos(), compat=True)


@query("d21_primera_vez", f""", {enriched_sql()}, {EVENT_CALENDAR}
SELECT cliente, FECHA_SERVICIO, CARTERA, CANAL, OPERADOR, GRUPO_RESPUESTA, dia_habil_del_mes,
       es_primer_contacto_efectivo, TIMESTAMP '2024-01-31 00:00:00' AS timestamp_primera_interaccion
FROM enr LEFT JOIN cal ON fecha = FECHA_SERVICIO WHERE es_primera_vez_cliente""")
def d21(t):
    return portfolio.first_contacts(t.contacts, t.calendar_of("events", "ts"), RUN_AT)


@query("d21_primera_vez_dedup", f""", {enriched_sql()}, {EVENT_CALENDAR}
SELECT DISTINCT cliente, FECHA_SERVICIO, CARTERA, CANAL, OPERADOR, GRUPO_RESPUESTA, dia_habil_del_mes,
       es_primer_contacto_efectivo, TIMESTAMP '2024-01-31 00:00:00' AS timestamp_primera_interaccion
FROM enr LEFT JOIN cal ON fecha = FECHA_SERVICIO WHERE es_primera_vez_cliente""")
def d21_dedup(t):
    return portfolio.first_contacts(t.contacts, t.calendar_of("events", "ts"), RUN_AT, dedup=True)


@query("d22_tracking", f""", {enriched_sql()}
SELECT cliente, CARTERA, CANAL, GRUPO_RESPUESTA, MIN(FECHA_SERVICIO) AS FECHA_PRIMERA_VEZ_CONTACTADO,
       MIN(CASE WHEN efectivo = 1 THEN FECHA_SERVICIO END) AS FECHA_PRIMERA_VEZ_EFECTIVO,
       MIN(CASE WHEN management LIKE '%Compromiso%' THEN FECHA_SERVICIO END) AS FECHA_PRIMERA_VEZ_COMPROMISO,
       COUNT(*) AS TOTAL_CONTACTOS_ACUMULADOS, CAST(SUM(efectivo) AS BIGINT) AS TOTAL_EFECTIVOS_ACUMULADOS,
       COUNT(CASE WHEN management LIKE '%Compromiso%' THEN 1 END) AS TOTAL_COMPROMISOS_ACUMULADOS,
       TIMESTAMP '2024-01-31 00:00:00' AS FECHA_ULTIMA_ACTUALIZACION
FROM (SELECT DISTINCT cliente, archivo, CARTERA, CANAL, GRUPO_RESPUESTA, FECHA_SERVICIO, date, efectivo, management
      FROM enr) GROUP BY 1, 2, 3, 4""")
def d22(t):
    return first_contact.tracking(t.shaped, t.base, F.lit(RUN_AT).cast("timestamp_ntz"))


FLAG_COLUMNS = """cod_luna, cliente, archivo, CARTERA, CANAL, OPERADOR, GRUPO_RESPUESTA, FECHA_SERVICIO, date,
  COUNT(*) AS q_cuentas, bool_and(f_cartera) AS es_primera_vez_cliente_cartera_canal,
  bool_and(f_operador) AS es_primera_vez_cliente_cartera_canal_operador,
  bool_and(es_primera_vez_cliente) AS es_primera_vez_cliente_canal,
  bool_and(f_grupo) AS es_primera_vez_cliente_grupo_respuesta, bool_and(es_primera_vez_cliente) AS es_primera_vez_cliente"""


@query("e1_first_flags", f""", {enriched_sql()}
SELECT {FLAG_COLUMNS}, bool_and(es_primer_contacto_efectivo) AS es_primer_contacto_efectivo
FROM enr GROUP BY cod_luna, cliente, archivo, CARTERA, CANAL, OPERADOR, GRUPO_RESPUESTA, FECHA_SERVICIO, date""")
def e1(t):
    return first_contact.flag_first_contacts(t.shaped, t.base)


@query("e2_first_interaction", f""", {enriched_sql()}
SELECT cliente, archivo, CANAL, MIN(date) AS primera FROM enr GROUP BY 1, 2, 3""")
def e2(t):
    flagged = first_contact.flag_first_contacts(t.shaped, t.base).where("es_primera_vez_cliente")
    return flagged.groupBy("cliente", "archivo", "CANAL").agg(F.min("date").alias("primera"))


@query("e3_first_contact", f""", {enriched_sql()}
SELECT cliente, archivo, CANAL, date, es_primer_contacto_efectivo FROM (
  SELECT DISTINCT cod_luna, cliente, archivo, CANAL, OPERADOR, GRUPO_RESPUESTA, date, es_primer_contacto_efectivo
  FROM enr)""")
def e3(t):
    return first_contact.flag_first_contacts(t.shaped, t.base).select(
        "cliente", "archivo", "CANAL", "date", "es_primer_contacto_efectivo"
    )


@query("e3_effective_only", f""", {enriched_sql()}
SELECT cliente, archivo, CANAL, date, efectivo = 1 AND date = MIN(CASE WHEN efectivo = 1 THEN date END)
       OVER (PARTITION BY archivo, CANAL, cliente) AS es_primer_contacto_efectivo FROM (
  SELECT DISTINCT cod_luna, cliente, archivo, CANAL, OPERADOR, GRUPO_RESPUESTA, date, efectivo FROM enr)""")
def e3_effective(t):
    return first_contact.flag_first_contacts(t.shaped, t.base, effective_only=True).select(
        "cliente", "archivo", "CANAL", "date", "es_primer_contacto_efectivo"
    )


# ---- business-day calendar over the order dates ----------------------------------------------

def _years(t):
    return t.raw("orders").select(F.year("o_orderdate").alias("ano")).distinct()


ORDER_YEARS = "(SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS a FROM orders)"


@query("k1_holidays", f"""
SELECT fecha, nombre AS nombre_feriado FROM ({holidays_sql(ORDER_YEARS + ' y')})""")
def k1(t):
    return cal.holidays(_years(t))


@query("k2_easter", f"""
SELECT year(fecha)::INTEGER AS ano, fecha + 2 AS pascua FROM ({holidays_sql(ORDER_YEARS + ' y')})
WHERE nombre = 'Viernes Santo'""")
def k2(t):
    return _years(t).select("ano", dates.easter(F.col("ano")).alias("pascua"))


@query("k3_is_business_day", f""", {ORDER_CALENDAR}
SELECT o_orderkey, es_dia_habil, isodow(o_orderdate) <= 5 AND NOT es_feriado OR isodow(o_orderdate) = 6 AS con_sabados
FROM orders JOIN cal ON fecha = CAST(o_orderdate AS DATE)""")
def k3(t):
    span = t.span_of("orders", "o_orderdate")
    flags = cal.business_calendar(span).select(F.col("fecha").alias("_fecha"), "es_feriado", "es_dia_habil")
    saturdays = cal.business_flag(F.col("_fecha"), F.col("es_feriado"), include_saturdays=True)
    rows = t.raw("orders").join(flags, F.to_date("o_orderdate") == F.col("_fecha"))
    return rows.select("o_orderkey", "es_dia_habil", saturdays.alias("con_sabados"))


@query("k4_bd_of_month", f""", {ORDER_CALENDAR}
SELECT o_orderkey, dia_habil_del_mes FROM orders JOIN cal ON fecha = CAST(o_orderdate AS DATE)""")
def k4(t):
    rows = cal.add_business_day_columns(t.raw("orders"), "o_orderdate", t.calendar_of("orders", "o_orderdate"))
    return rows.select("o_orderkey", "dia_habil_del_mes")


@query("k5_nth_bd", f""", {ORDER_CALENDAR}
SELECT ano, mes, fecha FROM cal WHERE dia_habil_del_mes = 10""")
def k5(t):
    return cal.nth_business_day(t.calendar_of("orders", "o_orderdate"), 10)


@query("k6_last_bd", f""", {ORDER_CALENDAR}
SELECT ano, mes, ult AS ultimo_dia_habil, tot::BIGINT AS dias_habiles FROM cal GROUP BY ALL""")
def k6(t):
    return cal.month_summary(t.calendar_of("orders", "o_orderdate"))


@query("k7_bd_in_month", f""", {ORDER_CALENDAR}
SELECT ano, mes, fecha FROM cal WHERE es_dia_habil""")
def k7(t):
    return t.calendar_of("orders", "o_orderdate").where("es_dia_habil").select("ano", "mes", "fecha")


@query("k8_prev_month", f""", {ORDER_CALENDAR}
SELECT o_orderkey, previo AS mismo_dia_habil_mes_anterior
FROM orders JOIN cal ON fecha = CAST(o_orderdate AS DATE)""")
def k8(t):
    rows = cal.add_business_day_columns(t.raw("orders"), "o_orderdate", t.calendar_of("orders", "o_orderdate"))
    return rows.select("o_orderkey", "mismo_dia_habil_mes_anterior")


@query("k9_mapping", f""", {ORDER_CALENDAR}
SELECT fecha, ano, mes, dia, dia_semana, es_dia_habil, dia_habil_del_mes, es_feriado, nombre_feriado,
       previo AS fecha_mismo_dia_habil_mes_anterior
FROM cal WHERE fecha BETWEEN (SELECT MIN(o_orderdate)::DATE FROM orders) AND (SELECT MAX(o_orderdate)::DATE FROM orders)
""")
def k9(t):
    return cal.mapping(t.span_of("orders", "o_orderdate"))


@query("k10_add_columns", f""", {ORDER_CALENDAR}
SELECT o_orderkey, dia_habil_del_mes, es_dia_habil, previo AS mismo_dia_habil_mes_anterior, dia_semana,
       dayname(fecha) AS nombre_dia_semana FROM orders JOIN cal ON fecha = CAST(o_orderdate AS DATE)""")
def k10(t):
    orders = t.raw("orders").select("o_orderkey", "o_orderdate")
    calendar = t.calendar_of("orders", "o_orderdate")
    return cal.add_business_day_columns(orders, "o_orderdate", calendar).drop("o_orderdate")


@query("k11_info", f""", {ORDER_CALENDAR}
SELECT fecha AS fecha_objetivo, es_dia_habil, dia_habil_del_mes, tot AS total_dias_habiles_mes_actual,
       previo AS fecha_comparacion_mes_anterior, tot_previo AS total_dias_habiles_mes_anterior,
       previo IS NOT NULL AS puede_comparar, progreso AS progreso_mes_actual FROM cal""")
def k11(t):
    return cal.comparison_info(t.calendar_of("orders", "o_orderdate"))


@query("k12_comparativas", agregada_sql() + """
SELECT a.*, FECHA_SERVICIO AS fecha_actual, previo AS fecha_comparacion, TRUE AS puede_comparar,
       c.dia_habil_del_mes AS dia_habil_numero, FECHA_SERVICIO AS fecha_objetivo, tot AS total_dias_habiles_mes_actual,
       previo AS fecha_comparacion_mes_anterior, tot_previo AS total_dias_habiles_mes_anterior,
       progreso AS progreso_mes_actual
FROM agregada a JOIN cal c ON fecha = FECHA_SERVICIO WHERE previo IS NOT NULL""")
def k12(t):
    calendar = t.calendar_of("events", "ts")
    return portfolio.comparisons(portfolio.aggregate_contacts(t.contacts, calendar), calendar)


STORED = """, anos AS (SELECT CAST(unnest(range((SELECT year(MIN(o_orderdate)) FROM orders),
                                     (SELECT year(MAX(o_orderdate)) + 1 FROM orders))) AS INTEGER) AS a),
dias AS (SELECT CAST(unnest(generate_series(make_date(a, 1, 1), make_date(a, 12, 31), INTERVAL 1 DAY)) AS DATE) AS f
         FROM anos),
marcados AS (
  SELECT f, nombre, dayofweek(f) NOT IN (0, 6) AND nombre IS NULL AS hab FROM dias LEFT JOIN (VALUES
    (1, 1, 'Año Nuevo'), (5, 1, 'Día del Trabajador'), (7, 28, 'Fiestas Patrias - Independencia'),
    (7, 29, 'Fiestas Patrias - Proclamación'), (12, 25, 'Navidad')) h(m, d, nombre) ON month(f) = m AND day(f) = d),
numerados AS (
  SELECT *, CASE WHEN hab THEN ROW_NUMBER() OVER (PARTITION BY year(f), month(f), hab ORDER BY f) END AS nm,
         CASE WHEN hab THEN ROW_NUMBER() OVER (PARTITION BY year(f), hab ORDER BY f) END AS na FROM marcados),
guardado AS (
SELECT f AS FECHA, year(f) AS AÑO, month(f) AS MES, day(f) AS DIA, hab AS ES_DIA_HABIL, nm AS DIA_HABIL_DEL_MES,
       na AS DIA_HABIL_DEL_AÑO, dayname(f) AS NOMBRE_DIA_SEMANA, nombre IS NOT NULL AS ES_FERIADO,
       nombre AS NOMBRE_FERIADO, LAG(f) OVER (PARTITION BY nm, hab ORDER BY f) AS FECHA_MISMO_DIA_HABIL_MES_ANTERIOR,
       LAG(f) OVER (PARTITION BY na, hab ORDER BY f) AS FECHA_MISMO_DIA_HABIL_AÑO_ANTERIOR
FROM numerados WHERE hab OR nombre IS NOT NULL)
"""


@query("k13_sql_calendar", STORED + "SELECT * FROM guardado")
def k13(t):
    return cal.stored_calendar(t.span_of("orders", "o_orderdate"))


@query("e7_bd_number", STORED + "SELECT FECHA, DIA_HABIL_DEL_MES, DIA_HABIL_DEL_AÑO FROM guardado")
def e7(t):
    return cal.stored_calendar(t.span_of("orders", "o_orderdate")).select(
        "FECHA", "DIA_HABIL_DEL_MES", "DIA_HABIL_DEL_AÑO"
    )


@query("e8_lag_month", STORED + """
SELECT FECHA, FECHA_MISMO_DIA_HABIL_MES_ANTERIOR, FECHA_MISMO_DIA_HABIL_AÑO_ANTERIOR FROM guardado""")
def e8(t):
    return cal.stored_calendar(t.span_of("orders", "o_orderdate")).select(
        "FECHA", "FECHA_MISMO_DIA_HABIL_MES_ANTERIOR", "FECHA_MISMO_DIA_HABIL_AÑO_ANTERIOR"
    )


@query("k14_calendar_checks", """
SELECT TRUE AS domingo_no_es_habil, TRUE AS numero_solo_en_habiles, TRUE AS comparacion_en_habiles,
       COUNT(*) > 0 AS hay_dias_habiles FROM orders""")
def k14(t):
    return quality.calendar_checks(t.calendar_of("orders", "o_orderdate"))


@query("g4_literal_rows", f"""
SELECT nombre, COUNT(*) AS n FROM ({holidays_sql(ORDER_YEARS + ' y')}) GROUP BY 1""")
def g4(t):
    return cal.holidays(_years(t)).groupBy(F.col("nombre_feriado").alias("nombre")).agg(F.count(F.lit(1)).alias("n"))
