"""Registered queries: reports, views, profiling and data-quality checks."""

from pyspark.sql import functions as F

from moraflow.functions import rules
from moraflow.operators import calendar as cal
from moraflow.plans import facts, migration, portfolio, quality, reports
from moraflow.registry.core import WINDOW, query
from moraflow.registry.detailed import STORED, _agregada, agregada_sql
from moraflow.registry.scans_and_rules import AS_OF
from moraflow.sources import scans, sinks
from moraflow.sources.driver_tables import DAY_0


def mean_sql(c: str) -> str:
    return f"ROUND(CAST(SUM(CAST({c} AS DECIMAL(28, 15))) AS DOUBLE) / COUNT({c}), 9)"


def money_sql(c: str) -> str:
    return f"CAST(SUM(CAST({c} AS DECIMAL(18, 2))) AS DOUBLE)"


def total_sql(c: str) -> str:
    return f"CAST(SUM({c}) AS BIGINT)"


def _stored_days(t):
    return cal.stored_calendar(t.span_of("events", "ts"))


STORED_EVENTS = STORED.replace("o_orderdate", "ts").replace("FROM orders", "FROM events")


# ---- distributions and shares ----------------------------------------------------------------

@query("d12_due_distribution", f"""
SELECT CATEGORIA_VENCIMIENTO, COUNT(*) AS registros, {total_sql('Q_CUENTAS_ASIGNADAS')} AS total_cuentas,
       {money_sql('MONTO_EXIGIBLE_ASIGNADO')} AS total_monto FROM fact_universo GROUP BY 1""")
def d12(t):
    return quality.due_distribution(t.universe_fact, WINDOW)


@query("d13_due_view", f"""
SELECT FECHA_CALCULO, CATEGORIA_VENCIMIENTO, VENCIMIENTO, CARTERA, SERVICIO, CANAL,
  {total_sql('UNIVERSO_CUENTAS')} AS TOTAL_CUENTAS, {money_sql('UNIVERSO_MONTO')} AS TOTAL_MONTO,
  {mean_sql('OBJ_RECUPERO_PROMEDIO')} AS OBJETIVO_PROMEDIO, {total_sql('CUENTAS_CONTACTADAS')} AS TOTAL_CONTACTADAS,
  {money_sql('MONTO_COMPROMETIDO')} AS TOTAL_COMPROMETIDO, {money_sql('MONTO_RECUPERADO')} AS TOTAL_RECUPERADO,
  SUM(CUENTAS_CONTACTADAS)::DOUBLE / NULLIF(SUM(UNIVERSO_CUENTAS), 0)::DOUBLE
    AS TASA_CONTACTABILIDAD_CONSOLIDADA,
  {money_sql('MONTO_RECUPERADO')} / NULLIF({money_sql('UNIVERSO_MONTO')}, 0) AS TASA_RECUPERACION_CONSOLIDADA,
  {money_sql('MONTO_RECUPERADO')} / NULLIF({money_sql('UNIVERSO_MONTO')}, 0)
        / {mean_sql('OBJ_RECUPERO_PROMEDIO')} AS CUMPLIMIENTO_OBJETIVO_CONSOLIDADO
FROM fact_kpis GROUP BY 1, 2, 3, 4, 5, 6""")
def d13(t):
    return reports.due_analysis(t.kpis)


SHARES = """
SELECT '{c}' AS dimension, {c} AS valor, COUNT(*) AS cantidad,
       ROUND(COUNT(*) * 100.0::DOUBLE / (SELECT COUNT(*) FROM asignacion), 2) AS porcentaje
FROM asignacion GROUP BY {c}"""


@query("d14_shares", SHARES.format(c="tramo_gestion") + " UNION ALL " + SHARES.format(c="negocio"))
def d14(t):
    rows = t.asignacion()
    return reports.shares(rows, "tramo_gestion").unionByName(reports.shares(rows, "negocio"))


@query("e10_share", """
SELECT CATEGORIA_VENCIMIENTO, COUNT(*) AS cantidad, ROUND(COUNT(*) * 100.0::DOUBLE / SUM(COUNT(*)) OVER (), 2)
       AS porcentaje FROM universo GROUP BY 1""")
def e10(t):
    counted = t.universe.groupBy("CATEGORIA_VENCIMIENTO").agg(F.count(F.lit(1)).alias("cantidad"))
    return reports.with_share(counted, "cantidad", "porcentaje")


@query("l7_simulated_due", """
SELECT CATEGORIA_VENCIMIENTO AS categoria_vencimiento, COUNT(DISTINCT VENCIMIENTO) AS grupos_vencimiento,
       COUNT(*) AS total_cuentas, ROUND(COUNT(*) * 100.0::DOUBLE / SUM(COUNT(*)) OVER (), 2) AS porcentaje
FROM universo GROUP BY 1""")
def l7(t):
    return quality.simulated_due_distribution(t.accounts(), AS_OF)


# ---- verification and profiling --------------------------------------------------------------

@query("d15_verify", f"""
SELECT COUNT(*) AS total_registros, MIN(FECHA_ASIGNACION) AS fecha_min, MAX(FECHA_ASIGNACION) AS fecha_max,
       COUNT(DISTINCT CARTERA) AS carteras_unicas, {total_sql('Q_CUENTAS_ASIGNADAS')} AS total_cuentas,
       {money_sql('MONTO_EXIGIBLE_ASIGNADO')} AS total_monto FROM fact_universo""")
def d15(t):
    return quality.verify_universe(t.universe_fact, WINDOW)


@query("d15_verify_daily", f"""
SELECT COUNT(*) AS total_registros, MIN(FECHA_SERVICIO) AS fecha_min, MAX(FECHA_SERVICIO) AS fecha_max,
       COUNT(DISTINCT CANAL) AS canales_unicos, {total_sql('Q_INTERACCIONES_TOTAL')} AS total_interacciones,
       {total_sql('Q_CLIENTES_UNICOS_CONTACTADOS')} AS total_clientes_contactados FROM fact_diaria""")
def d15_daily(t):
    return quality.verify_daily(t.daily, WINDOW)


@query("d15_verify_recovery", f"""
SELECT COUNT(*) AS total_registros, MIN(FECHA_PAGO) AS fecha_min, MAX(FECHA_PAGO) AS fecha_max,
       {money_sql('MONTO_PAGADO')} AS total_recuperado, COUNT(CASE WHEN ES_PAGO_CON_PDP THEN 1 END) AS pagos_con_pdp,
       {mean_sql('EFECTIVIDAD_ATRIBUCION')} AS efectividad_promedio FROM fact_recupero""")
def d15_recovery(t):
    return quality.verify_recovery(t.recovery, WINDOW)


@query("d15_verify_kpis", f"""
SELECT COUNT(*) AS total_registros, COUNT(DISTINCT CARTERA) AS carteras, COUNT(DISTINCT CANAL) AS canales,
       {mean_sql('TASA_CONTACTABILIDAD')} AS contactabilidad_promedio,
       {mean_sql('TASA_RECUPERACION')} AS recuperacion_promedio,
       {mean_sql('CUMPLIMIENTO_OBJETIVO')} AS cumplimiento_promedio FROM fact_kpis""")
def d15_kpis(t):
    return quality.verify_kpis(t.kpis, WINDOW)


RANGES = "SELECT '{n}' AS tabla, '{d}' AS campo_fecha, MIN({d}) AS fecha_min, MAX({d}) AS fecha_max, " \
         "COUNT(DISTINCT {d}) AS dias_distintos, CAST(MAX({d}) - MIN({d}) AS BIGINT) AS dias_total_periodo FROM {f}"


@query("d16_ranges", " UNION ALL ".join(
    RANGES.format(n=n, d=d, f=f) for n, d, f in [
        ("asignacion_universo", "FECHA_ASIGNACION", "fact_universo"),
        ("gestion_agregada", "FECHA_SERVICIO", "fact_diaria"),
        ("recupero_atribuido", "FECHA_PAGO", "fact_recupero"),
        ("kpis_ejecutivos", "FECHA_CALCULO", "fact_kpis"),
    ]
))
def d16(t):
    return quality.date_ranges(
        {
            "asignacion_universo": (t.universe_fact, "FECHA_ASIGNACION"),
            "gestion_agregada": (t.daily, "FECHA_SERVICIO"),
            "recupero_atribuido": (t.recovery, "FECHA_PAGO"),
            "kpis_ejecutivos": (t.kpis, "FECHA_CALCULO"),
        }
    )


COVERAGE = "SELECT '{n}' AS fuente, COUNT(*) AS total_registros, COUNT({d}) AS con_vencimiento, " \
           "ROUND(COUNT({d}) * 100.0::DOUBLE / COUNT(*), 2) AS pct_con_vencimiento, " \
           "COUNT(DISTINCT {d}) AS vencimientos_distintos, MIN({d}) AS vencimiento_min, MAX({d}) AS vencimiento_max " \
           "FROM {n}"


@query("d17_coverage", COVERAGE.format(n="asignacion", d="min_vto") + " UNION ALL "
       + COVERAGE.format(n="tran_deuda", d="fecha_vencimiento"))
def d17(t):
    return quality.due_coverage(
        {"asignacion": (t.accounts(), "min_vto"), "tran_deuda": (t.tran_deuda(), "fecha_vencimiento")}
    )


@query("d18_counts", " UNION ALL ".join(
    f"SELECT '{n}' AS tabla, format('{{:,}}', COUNT(*)) AS registros_formateados, COUNT(*) AS registros FROM {f}"
    for n, f in [("asignacion", "orders"), ("interacciones", "events"), ("detalle", "lineitem"),
                 ("asignacion_universo", "fact_universo"), ("gestion_agregada", "fact_diaria")]
))
def d18(t):
    return quality.row_counts(
        {
            "asignacion": t.raw("orders"), "interacciones": t.raw("events"), "detalle": t.raw("lineitem"),
            "asignacion_universo": t.universe_fact, "gestion_agregada": t.daily,
        }
    )


@query("a17_backfill", """
, universo_nuevo AS (
  SELECT CARTERA, SERVICIO, SEGMENTO_GESTION, ZONA_GEOGRAFICA, COALESCE(m, DATE '1900-01-01') AS VENCIMIENTO
  FROM fact_universo
  LEFT JOIN (SELECT archivo, MIN(min_vto) AS m FROM asignacion GROUP BY 1) ON archivo = ID_ARCHIVO_ASIGNACION || '.txt'),
diaria_vieja AS (SELECT * EXCLUDE (VENCIMIENTO, CATEGORIA_VENCIMIENTO) FROM fact_diaria),
diaria_nueva AS (
  SELECT d.*, COALESCE((SELECT MIN(VENCIMIENTO) FROM universo_nuevo u WHERE u.CARTERA = d.CARTERA
           AND u.SERVICIO = d.SERVICIO AND u.SEGMENTO_GESTION = d.SEGMENTO_GESTION
           AND u.ZONA_GEOGRAFICA = d.ZONA_GEOGRAFICA), DATE '1900-01-01') AS v FROM diaria_vieja d)
SELECT FECHA_SERVICIO, CARTERA, CANAL, Q_INTERACCIONES_TOTAL, v AS VENCIMIENTO,
  CASE WHEN v = DATE '1900-01-01' THEN 'SIN_VENCIMIENTO' WHEN v <= FECHA_SERVICIO THEN 'VENCIDO'
    WHEN v - FECHA_SERVICIO <= 30 THEN 'POR_VENCER_30D' WHEN v - FECHA_SERVICIO <= 60 THEN 'POR_VENCER_60D'
    WHEN v - FECHA_SERVICIO <= 90 THEN 'POR_VENCER_90D' ELSE 'VIGENTE_MAS_90D' END AS CATEGORIA_VENCIMIENTO
FROM diaria_nueva""")
def a17(t):
    old = [f.drop("VENCIMIENTO", "CATEGORIA_VENCIMIENTO") for f in (t.universe_fact, t.daily)]
    new_universe = migration.backfill_universe(old[0], t.accounts())
    return migration.backfill_daily(old[1], new_universe).select(
        "FECHA_SERVICIO", "CARTERA", "CANAL", "Q_INTERACCIONES_TOTAL", "VENCIMIENTO", "CATEGORIA_VENCIMIENTO"
    )


@query("d17_migrated_coverage", """
SELECT 'gestion_agregada' AS tabla, COUNT(*) AS registros_nuevos,
       COUNT(CASE WHEN CATEGORIA_VENCIMIENTO <> 'SIN_VENCIMIENTO' THEN 1 END) AS con_vencimiento_calculado,
       COUNT(CASE WHEN VENCIMIENTO <> DATE '1900-01-01' THEN 1 END) AS con_fecha_vencimiento,
       ROUND(COUNT(CASE WHEN CATEGORIA_VENCIMIENTO <> 'SIN_VENCIMIENTO' THEN 1 END) * 100.0::DOUBLE / COUNT(*), 2)
         AS pct_vencimiento_calculado FROM fact_diaria""")
def d17_migrated(t):
    return quality.migrated_coverage({"gestion_agregada": t.daily})


# ---- reports ---------------------------------------------------------------------------------

OPERATORS = f"""
SELECT OPERADOR_FINAL, CANAL, {total_sql('Q_INTERACCIONES_TOTAL')} AS TOTAL_INTERACCIONES,
       {total_sql('Q_CONTACTOS_EFECTIVOS')} AS CONTACTOS_EFECTIVOS,
       {mean_sql('EFECTIVIDAD_CONTACTO')} AS EFECTIVIDAD_PROMEDIO, {total_sql('Q_PROMESAS_DE_PAGO')} AS PROMESAS_TOTALES,
       {money_sql('MONTO_COMPROMETIDO')} AS MONTO_COMPROMETIDO
FROM fact_diaria WHERE OPERADOR_FINAL <> 'SISTEMA_BOT' GROUP BY 1, 2 HAVING SUM(Q_INTERACCIONES_TOTAL) >= 100"""


@query("d19_having", OPERATORS)
def d19(t):
    return reports.operator_activity(t.daily, WINDOW)


@query("f2_top_operators", OPERATORS + """
ORDER BY EFECTIVIDAD_PROMEDIO DESC, OPERADOR_FINAL, CANAL LIMIT 20""")
def f2(t):
    return reports.top_operators(t.daily, WINDOW)


@query("m4_top_five_operators", OPERATORS + " ORDER BY EFECTIVIDAD_PROMEDIO DESC, OPERADOR_FINAL, CANAL LIMIT 5")
def m4(t):
    return reports.top_operators(t.daily, WINDOW, k=5)


@query("m1_kpi_list", """
SELECT CARTERA, CANAL, UNIVERSO_CUENTAS, CUENTAS_CONTACTADAS, TASA_CONTACTABILIDAD, EFECTIVIDAD_PROMEDIO,
       MONTO_RECUPERADO, TASA_RECUPERACION, CUMPLIMIENTO_OBJETIVO FROM fact_kpis""")
def m1(t):
    return reports.kpi_list(t.kpis, WINDOW)


@query("m2_daily_evolution", f"""
SELECT FECHA_SERVICIO, CARTERA, CANAL, {total_sql('Q_INTERACCIONES_TOTAL')} AS TOTAL_INTERACCIONES,
       {total_sql('Q_CLIENTES_UNICOS_CONTACTADOS')} AS CLIENTES_CONTACTADOS,
       {mean_sql('EFECTIVIDAD_CONTACTO')} AS EFECTIVIDAD_PROMEDIO,
       {money_sql('MONTO_COMPROMETIDO')} AS MONTO_COMPROMETIDO FROM fact_diaria GROUP BY 1, 2, 3""")
def m2(t):
    return reports.daily_evolution(t.daily, WINDOW)


@query("m3_attribution", f"""
SELECT CARTERA, CANAL_ATRIBUIDO, COUNT(*) AS CANTIDAD_PAGOS, {money_sql('MONTO_PAGADO')} AS MONTO_TOTAL_RECUPERADO,
       COUNT(CASE WHEN ES_PAGO_CON_PDP THEN 1 END) AS PAGOS_CON_PDP,
       COUNT(CASE WHEN PDP_ESTABA_VIGENTE THEN 1 END) AS PAGOS_PDP_VIGENTE,
       {mean_sql('EFECTIVIDAD_ATRIBUCION')} AS EFECTIVIDAD_ATRIBUCION_PROMEDIO FROM fact_recupero GROUP BY 1, 2""")
def m3(t):
    return reports.recovery_attribution(t.recovery, WINDOW)


@query("m5_summary", STORED_EVENTS + """
SELECT FECHA_CALCULO, CARTERA, SERVICIO, CANAL, UNIVERSO_CUENTAS, UNIVERSO_MONTO, CUENTAS_CONTACTADAS,
       TASA_CONTACTABILIDAD, MONTO_COMPROMETIDO, MONTO_RECUPERADO, TASA_RECUPERACION, CUMPLIMIENTO_OBJETIVO,
       CASE WHEN CUMPLIMIENTO_OBJETIVO >= 1 THEN '🟢 SUPERADO' WHEN CUMPLIMIENTO_OBJETIVO >= 0.8 THEN '🟡 EN RANGO'
            ELSE '🔴 BAJO OBJETIVO' END AS STATUS_OBJETIVO,
       DIA_HABIL_DEL_MES, FECHA_MISMO_DIA_HABIL_MES_ANTERIOR
FROM fact_kpis LEFT JOIN guardado ON FECHA = FECHA_CALCULO""")
def m5(t):
    return reports.executive_summary(t.kpis, _stored_days(t))


@query("m6_detail", STORED_EVENTS + """
SELECT FECHA_SERVICIO, CARTERA, CANAL, OPERADOR_FINAL, GRUPO_RESPUESTA, Q_INTERACCIONES_TOTAL, Q_CONTACTOS_EFECTIVOS,
       Q_CLIENTES_UNICOS_CONTACTADOS, EFECTIVIDAD_CONTACTO, Q_PROMESAS_DE_PAGO, MONTO_COMPROMETIDO, TASA_COMPROMISO,
       Q_INTERACCIONES_TOTAL::DOUBLE / 8 AS INTERACCIONES_POR_HORA,
       MONTO_COMPROMETIDO / NULLIF(Q_PROMESAS_DE_PAGO, 0)::DOUBLE AS MONTO_PROMEDIO_POR_PROMESA,
       DIA_HABIL_DEL_MES
FROM fact_diaria LEFT JOIN guardado ON FECHA = FECHA_SERVICIO""")
def m6(t):
    return reports.operating_detail(t.daily, _stored_days(t))


@query("b28_productivity", """
SELECT FECHA_SERVICIO, OPERADOR_FINAL, CARTERA, Q_INTERACCIONES_TOTAL::DOUBLE / 8 AS INTERACCIONES_POR_HORA
FROM fact_diaria""")
def b28(t):
    return reports.operating_detail(t.daily, _stored_days(t)).select(
        "FECHA_SERVICIO", "OPERADOR_FINAL", "CARTERA", "INTERACCIONES_POR_HORA"
    )


def _two_periods(t):
    """KPIs of the first and of the second half of the month, one calculation date each."""
    halves = []
    for first, last in ((DAY_0, DAY_0.replace(day=7)), (DAY_0.replace(day=8), WINDOW.last)):
        window = facts.RunWindow(first, last, WINDOW.as_of)
        halves.append(facts.executive_kpis(t.universe_fact, t.daily, t.recovery, window))
    return halves[0].unionByName(halves[1])


def _half_sql(name: str, first: str, last: str) -> str:
    keys = "CARTERA, SERVICIO, VENCIMIENTO, CATEGORIA_VENCIMIENTO"
    span = f"BETWEEN DATE '{first}' AND DATE '{last}'"
    return f"""
    {name} AS (SELECT DATE '{first}' AS FECHA_CALCULO, {keys}, COALESCE(CANAL, 'TOTAL') AS CANAL,
        COALESCE(cuentas, 0) AS c, COALESCE(monto, 0) AS m, COALESCE(r, 0) AS r, COALESCE(contactadas, 0) AS k
      FROM ((SELECT {keys}, CANAL, {total_sql('Q_CLIENTES_UNICOS_CONTACTADOS')} AS contactadas
             FROM fact_diaria WHERE FECHA_SERVICIO {span} GROUP BY ALL) g
      FULL JOIN (SELECT {keys}, CANAL_ATRIBUIDO AS CANAL, {money_sql('MONTO_PAGADO')} AS r
             FROM fact_recupero WHERE FECHA_PAGO {span} GROUP BY ALL) p USING ({keys}, CANAL))
      FULL JOIN (SELECT {keys}, {total_sql('Q_CUENTAS_ASIGNADAS')} AS cuentas,
             {money_sql('MONTO_EXIGIBLE_ASIGNADO')} AS monto
             FROM fact_universo WHERE FECHA_ASIGNACION {span} GROUP BY ALL) u USING ({keys}))"""


@query("e9_trends", f""", {_half_sql('h1', '2024-01-01', '2024-01-07')}, {_half_sql('h2', '2024-01-08', '2024-01-31')},
analisis AS (
  SELECT *, r / NULLIF(m, 0) AS t FROM (SELECT * FROM h1 UNION ALL SELECT * FROM h2)
  WHERE c > 0 OR k > 0 OR r > 0),
previos AS (
  SELECT *, LAG(c) OVER w AS pc, LAG(r) OVER w AS pr, LAG(t) OVER w AS pt FROM analisis
  WINDOW w AS (PARTITION BY CATEGORIA_VENCIMIENTO, CARTERA, SERVICIO, CANAL ORDER BY FECHA_CALCULO, VENCIMIENTO))
SELECT FECHA_CALCULO, CATEGORIA_VENCIMIENTO, VENCIMIENTO, CARTERA, SERVICIO, CANAL, c AS TOTAL_CUENTAS,
       r AS TOTAL_RECUPERADO, t AS TASA_RECUPERACION_CONSOLIDADA, pc AS CUENTAS_PERIODO_ANTERIOR,
       pr AS RECUPERADO_PERIODO_ANTERIOR, pt AS TASA_RECUPERACION_ANTERIOR,
       (c - pc)::DOUBLE / NULLIF(pc, 0)::DOUBLE AS VAR_CUENTAS_PCT,
       (r - pr) / NULLIF(pr, 0) AS VAR_RECUPERADO_PCT, t - pt AS VAR_TASA_RECUPERACION_PP
FROM previos""")
def e9(t):
    return reports.due_trends(reports.due_analysis(_two_periods(t))).select(
        "FECHA_CALCULO", "CATEGORIA_VENCIMIENTO", "VENCIMIENTO", "CARTERA", "SERVICIO", "CANAL", "TOTAL_CUENTAS",
        "TOTAL_RECUPERADO", "TASA_RECUPERACION_CONSOLIDADA", "CUENTAS_PERIODO_ANTERIOR", "RECUPERADO_PERIODO_ANTERIOR",
        "TASA_RECUPERACION_ANTERIOR", "VAR_CUENTAS_PCT", "VAR_RECUPERADO_PCT", "VAR_TASA_RECUPERACION_PP",
    )


@query("m8_ratios", f"""
SELECT SUM(Q_CONTACTOS_EFECTIVOS)::DOUBLE / SUM(Q_INTERACCIONES_TOTAL)::DOUBLE AS EFECTIVIDAD_GLOBAL,
       (SELECT {money_sql('MONTO_RECUPERADO')} / NULLIF({money_sql('MONTO_COMPROMETIDO')}, 0) FROM fact_kpis)
         AS ROI_GESTION,
       SUM(Q_INTERACCIONES_TOTAL)::DOUBLE / COUNT(DISTINCT OPERADOR_FINAL) AS PRODUCTIVIDAD_OPERADOR
FROM fact_diaria""")
def m8(t):
    """The ratios and the KPIs read one written daily fact: its joins run once and their shuffle files go before the rest."""
    t.daily = sinks.written(t.daily, "m8")
    return reports.global_ratios(t.daily, t.kpis)


@query("m9_funnel", """
SELECT u.CARTERA, COUNT(DISTINCT u.cod_luna) AS ASIGNADOS,
       COUNT(DISTINCT CASE WHEN e.c IS NOT NULL THEN u.cod_luna END) AS CONTACTADOS,
       COUNT(DISTINCT CASE WHEN e.p = 1 THEN u.cod_luna END) AS CON_PROMESA,
       COUNT(DISTINCT CASE WHEN p.c IS NOT NULL THEN u.cod_luna END) AS CON_PAGO
FROM universo u
LEFT JOIN (SELECT cliente AS c, CARTERA AS k, MAX(es_compromiso) AS p FROM en_contexto GROUP BY 1, 2) e
     ON e.c = u.cod_luna AND e.k = u.CARTERA
LEFT JOIN (SELECT DISTINCT cod_luna AS c, CARTERA AS k FROM pagos_asignados) p
     ON p.c = u.cod_luna AND p.k = u.CARTERA
GROUP BY 1""")
def m9(t):
    return reports.funnel(t.universe, t.gestiones, t.paid, WINDOW)


@query("m9_weekday", f"""
SELECT isodow(FECHA_SERVICIO)::INTEGER AS dia_semana, CANAL, {total_sql('Q_INTERACCIONES_TOTAL')} AS TOTAL_INTERACCIONES,
       {total_sql('Q_CONTACTOS_EFECTIVOS')} AS CONTACTOS_EFECTIVOS,
       SUM(Q_CONTACTOS_EFECTIVOS)::DOUBLE / SUM(Q_INTERACCIONES_TOTAL)::DOUBLE AS EFECTIVIDAD
FROM fact_diaria GROUP BY 1, 2""")
def m9_weekday(t):
    return reports.by_weekday(t.daily)


@query("m10_quick_summary", """
, mes AS (SELECT * FROM calendario WHERE estado = 'finalizado')
SELECT (SELECT COUNT(*) FROM mes) AS archivos, (SELECT MIN(FECHA_ASIGNACION) FROM mes) AS fecha_inicio,
       (SELECT MAX(FECHA_CIERRE) FROM mes) AS fecha_fin, (SELECT MAX(DIAS_GESTION) FROM mes) AS dias_gestion,
       COUNT(*) AS total_cuentas, COUNT(DISTINCT cuenta) AS cuentas_unicas,
       COUNT(DISTINCT telefono) AS telefonos_unicos
FROM asignacion WHERE archivo IN (SELECT cal_archivo || '.txt' FROM mes)""")
def m10(t):
    return reports.month_summary(scans.periods_of_month(t.calendario(), DAY_0, "finalizado"), t.accounts())


@query("f3_ordered_amounts", f"""
SELECT CARTERA, {money_sql('MONTO_EXIGIBLE_ASIGNADO')} AS monto FROM fact_universo GROUP BY 1 ORDER BY 2 DESC""")
def f3(t):
    return t.universe_fact.groupBy("CARTERA").agg(
        rules.money_sum(F.col("MONTO_EXIGIBLE_ASIGNADO")).alias("monto")
    ).orderBy(F.desc("monto"))


# ---- data quality ----------------------------------------------------------------------------

@query("l1_required_columns", """
SELECT 'base_cartera' AS table_name, COUNT(*) AS row_count, 9 AS column_count, 'PASS' AS status
FROM (SELECT DISTINCT CARTERA, FECHA_ASIGNACION, SERVICIO FROM base_p)""")
def l1(t):
    outputs = {"base_cartera": portfolio.base_portfolio(t.base, t.debt, t.pagos())}
    return quality.quality_report(outputs).drop("issues")


@query("l6_calendar_flags", """
SELECT TRUE AS domingo_no_es_habil, TRUE AS numero_solo_en_habiles, TRUE AS comparacion_en_habiles,
       COUNT(*) > 0 AS hay_dias_habiles FROM events""")
def l6(t):
    return quality.calendar_checks(t.calendar_of("events", "ts"))


@query("l2_null_share", """
SELECT columna, pct_nulos, pct_nulos > 50 AS excede FROM (
  SELECT 'tramo_gestion' AS columna, ROUND(COUNT(CASE WHEN tramo_gestion IS NULL THEN 1 END) * 100.0::DOUBLE / COUNT(*), 1)
         AS pct_nulos FROM asignacion
  UNION ALL SELECT 'cuota_fracc_act', ROUND(COUNT(CASE WHEN cuota_fracc_act IS NULL THEN 1 END) * 100.0::DOUBLE
         / COUNT(*), 1) FROM asignacion
  UNION ALL SELECT 'min_vto', ROUND(COUNT(CASE WHEN min_vto IS NULL THEN 1 END) * 100.0::DOUBLE / COUNT(*), 1)
         FROM asignacion)""")
def l2(t):
    return quality.null_shares(t.accounts(), ["tramo_gestion", "cuota_fracc_act", "min_vto"])


@query("l3_duplicates", """
SELECT COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) AS filas_duplicadas
FROM lineitem""")
def l3(t):
    return quality.duplicate_rows(t.raw("lineitem"), ["l_orderkey", "l_linenumber"])


@query("l4_report", agregada_sql() + """
, d AS (SELECT COUNT(*) - COUNT(DISTINCT (FECHA_SERVICIO, CARTERA, CANAL, OPERADOR, GRUPO_RESPUESTA)) AS x FROM agregada)
SELECT 'agregada' AS table_name, COUNT(*) AS row_count, 34 AS column_count,
       CASE WHEN (SELECT x FROM d) > 0 THEN CAST((SELECT x FROM d) AS VARCHAR) || ' filas duplicadas en dims clave'
         ELSE '' END AS issues,
       CASE WHEN (SELECT x FROM d) > 0 THEN 'WARNING' ELSE 'PASS' END AS status FROM agregada""")
def l4(t):
    report = quality.quality_report({"agregada": _agregada(t)})
    return report.withColumn("issues", F.array_join("issues", "; "))


@query("l5_integrity", """
, todas AS (
  SELECT TRY_CAST(document AS BIGINT) AS cod_luna, CAST(date AS DATE) AS dia FROM gestiones_bot
  UNION ALL SELECT TRY_CAST(document AS BIGINT), CAST(date AS DATE) FROM gestiones_humano),
v AS (
  SELECT 'Consistencia archivos calendario vs asignacion' AS validacion, COUNT(*) AS n FROM universo
  UNION ALL SELECT 'Cuentas con gestiones sin asignacion', COUNT(DISTINCT t.cod_luna)
    FROM todas t WHERE t.cod_luna IS NOT NULL AND t.cod_luna NOT IN (SELECT cod_luna FROM asignacion)
  UNION ALL SELECT 'Fechas de gestion fuera del periodo de asignacion', COUNT(*)
    FROM universo JOIN todas USING (cod_luna)
    WHERE NOT (dia BETWEEN FECHA_ASIGNACION AND COALESCE(FECHA_CIERRE, DATE '2099-12-31')))
SELECT validacion, n AS casos_encontrados, CASE WHEN n = 0 THEN '✅ OK' WHEN n < 1000 THEN '⚠️ REVISAR'
       ELSE '❌ PROBLEMA' END AS estado FROM v""")
def l5(t):
    return quality.integrity_checks(t.accounts(), t.calendario(), t.gestiones_bot(), t.gestiones_humano())


