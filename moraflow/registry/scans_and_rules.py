"""Registered queries: input scans and business rules, over whole tables."""

from datetime import date

from pyspark.sql import functions as F

from moraflow.functions import dates, rules
from moraflow.operators import harmonise
from moraflow.registry.core import query
from moraflow.sources import scans
from moraflow.sources.driver_tables import AS_OF, DAY_0

FIRST, LAST = date(2024, 1, 5), date(2024, 1, 20)


def open_clients(t):
    """Clients assigned in the open periods of the month."""
    files = scans.period_files(scans.periods_of_month(t.calendario(), DAY_0, "abierto"))
    return scans.assignment_of_files(t.accounts(), files).select("cod_luna")


OPEN_CLIENTS = """(SELECT cod_luna FROM asignacion WHERE archivo IN (
    SELECT cal_archivo || '.txt' FROM calendario WHERE estado = 'abierto'))"""


@query("a1_calendar_scan", """
SELECT cal_archivo AS ARCHIVO, cant_cod_luna_unique, cant_registros_archivo, FECHA_ASIGNACION, FECHA_TRANDEUDA,
       FECHA_CIERRE, DIAS_GESTION, ESTADO
FROM calendario WHERE date_trunc('month', FECHA_ASIGNACION) = DATE '2024-01-01' AND upper(ESTADO) = 'FINALIZADO'
""")
def a1(t):
    return scans.periods_of_month(t.calendario(), DAY_0, "Finalizado").drop("VENCIMIENTO", "DIAS_PARA_CIERRE")


@query("a2_assignment_semi", """
SELECT cod_luna, cuenta, cliente, telefono, archivo, min_vto, tramo_gestion, DATE '2024-01-01' AS fecha_carga
FROM asignacion WHERE archivo IN (SELECT cal_archivo || '.txt' FROM calendario WHERE estado = 'finalizado')
""")
def a2(t):
    files = scans.period_files(t.calendario().where("ESTADO = 'finalizado'"))
    rows = scans.assignment_of_files(t.accounts(), files)
    return rows.select(
        "cod_luna", "cuenta", "cliente", "telefono", "archivo", "min_vto", "tramo_gestion", "fecha_carga"
    )


@query("a3_bot_scan", f"""
SELECT TRY_CAST(document AS BIGINT) AS cod_luna, date, management, sub_management, compromiso, duracion
FROM gestiones_bot
WHERE CAST(date AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-20' AND TRY_CAST(document AS BIGINT) IS NOT NULL
  AND TRY_CAST(document AS BIGINT) IN {OPEN_CLIENTS}
""")
def a3(t):
    return scans.interactions_of_clients(t.gestiones_bot(), open_clients(t), FIRST, LAST).drop("fecha_compromiso")


@query("a4_human_scan", f"""
SELECT TRY_CAST(document AS BIGINT) AS cod_luna, date, management, sub_management, n1, n2, n3, monto_compromiso,
       fecha_compromiso, nombre_agente, duracion
FROM gestiones_humano
WHERE CAST(date AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-20' AND TRY_CAST(document AS BIGINT) IS NOT NULL
  AND TRY_CAST(document AS BIGINT) IN {OPEN_CLIENTS}
""")
def a4(t):
    return scans.interactions_of_clients(t.gestiones_humano(), open_clients(t), FIRST, LAST)


@query("a5_debt_files", "SELECT DISTINCT archivo FROM tran_deuda")
def a5(t):
    return scans.debt_files(t.tran_deuda())


DEBT_BY_DATE = """
  SELECT cod_cuenta, nro_documento, fecha_vencimiento, monto_exigible, archivo FROM tran_deuda
  WHERE archivo LIKE 'TRAN_DEUDA_%' AND
        CAST(TRY_STRPTIME('2024' || substr(archivo, 14, 2) || substr(archivo, 12, 2), '%Y%m%d') AS DATE) IN (
          SELECT FECHA_TRANDEUDA FROM calendario WHERE estado = 'finalizado')"""


def _debt_by_date(t):
    days = t.calendario().where("ESTADO = 'finalizado'").select(F.col("FECHA_TRANDEUDA").alias("fecha"))
    return scans.debt_of_dates(t.tran_deuda(), days, F.lit(2024))


@query("a6_debt_by_date", DEBT_BY_DATE)
def a6(t):
    return _debt_by_date(t)


@query("a7_payments_semi", f"""
SELECT cod_sistema, nro_documento, monto_cancelado, fecha_pago, archivo FROM pagos
WHERE nro_documento IN (SELECT nro_documento FROM ({DEBT_BY_DATE}) d)
""")
def a7(t):
    return scans.payments_of_documents(t.pagos(), _debt_by_date(t))


@query("a8_lookups", """
SELECT GRUPO_RESPUESTA, NIVEL_1, OPERADOR_FINAL, COUNT(*) AS n FROM gestiones GROUP BY 1, 2, 3
""")
def a8(t):
    return t.gestiones.groupBy("GRUPO_RESPUESTA", "NIVEL_1", "OPERADOR_FINAL").agg(F.count(F.lit(1)).alias("n"))


# ---- rules -----------------------------------------------------------------------------------

@query("b1_safe_cast", """
SELECT event_id, TRY_CAST(d AS BIGINT) AS cod_luna FROM (
  SELECT event_id, CASE WHEN event_id % 97 = 0 THEN 'X' ELSE '' END || CAST(user_id AS VARCHAR) AS d FROM events)
WHERE TRY_CAST(d AS BIGINT) IS NOT NULL
""")
def b1(t):
    document = F.concat(F.when(F.col("event_id") % 97 == 0, "X").otherwise(""), F.col("user_id").cast("string"))
    return t.raw("events").select("event_id", rules.safe_long(document).alias("cod_luna")).where(
        "cod_luna IS NOT NULL"
    )


@query("b2_portfolio", """
SELECT cuenta, archivo, CARTERA, CASE WHEN archivo LIKE '%Temprana%' THEN 'TEMPRANA'
  WHEN archivo LIKE '%CF\\_ANN%' ESCAPE '\\' THEN 'CUOTA_FIJA_ANUAL' WHEN archivo LIKE '%\\_AN\\_%' ESCAPE '\\'
  THEN 'ALTAS_NUEVAS' WHEN archivo LIKE '%Cobranding%' THEN 'COBRANDING' ELSE 'OTRAS' END AS CARTERA_S FROM base_p
""")
def b2(t):
    name = F.col("archivo")
    return t.accounts().select(
        "cuenta", "archivo", rules.portfolio(name).alias("CARTERA"),
        rules.portfolio(name, alternates=False).alias("CARTERA_S"),
    )


@query("b3_objective", """
SELECT b.cuenta, b.OBJ_RECUPERO, CAST(u.OBJ_RECUPERO AS DOUBLE) AS OBJ_RECUPERO_S
FROM base_p b JOIN universo u USING (cuenta)
""")
def b3(t):
    segment = F.col("tramo_gestion")
    return t.accounts().select(
        "cuenta", rules.objective(segment).alias("OBJ_RECUPERO"),
        rules.objective(segment, late_rate=False).alias("OBJ_RECUPERO_S"),
    )


@query("b4_due_category", "SELECT cuenta, CATEGORIA_VENCIMIENTO FROM universo")
def b4(t):
    return t.accounts().select(
        "cuenta", rules.due_category(F.col("min_vto"), F.lit(AS_OF)).alias("CATEGORIA_VENCIMIENTO")
    )


@query("b5_due_category_row", """
SELECT cuenta, CASE WHEN VENCIMIENTO = DATE '1900-01-01' THEN 'SIN_VENCIMIENTO'
  WHEN VENCIMIENTO <= FECHA_ASIGNACION THEN 'VENCIDO' WHEN VENCIMIENTO - FECHA_ASIGNACION <= 30 THEN 'POR_VENCER_30D'
  WHEN VENCIMIENTO - FECHA_ASIGNACION <= 60 THEN 'POR_VENCER_60D'
  WHEN VENCIMIENTO - FECHA_ASIGNACION <= 90 THEN 'POR_VENCER_90D' ELSE 'VIGENTE_MAS_90D' END AS CATEGORIA_VENCIMIENTO
FROM universo
""")
def b5(t):
    from moraflow.plans import facts

    rows = facts.assigned_universe(
        t.accounts().withColumns({"negocio": F.lit(None), "zona": F.lit(None)}), t.calendario(), AS_OF
    )
    category = rules.due_category(F.col("VENCIMIENTO"), F.col("FECHA_ASIGNACION"), sentinel=True)
    return rows.select("cuenta", category.alias("CATEGORIA_VENCIMIENTO"))


@query("b6_instalment", "SELECT cuenta, TIPO_FRACCIONAMIENTO FROM universo")
def b6(t):
    return t.accounts().select("cuenta", rules.instalment_type(F.col("fraccionamiento")).alias("TIPO_FRACCIONAMIENTO"))


@query("b7_segment", "SELECT cuenta, SEGMENTO FROM base_p")
def b7(t):
    label = rules.segment_label(F.col("tramo_gestion"), F.col("fraccionamiento"), F.col("cuota_fracc_act"))
    return t.accounts().select("cuenta", label.alias("SEGMENTO"))


@query("b8_response", """
SELECT date, GLOSA_RESPUESTA FROM gestiones_p WHERE CANAL = 'HUMANO'
""")
def b8(t):
    return harmonise.shape_human(t.gestiones_humano()).select("date", "GLOSA_RESPUESTA")


@query("b9_file_date", """
SELECT cod_cuenta, archivo, CASE WHEN archivo LIKE 'TRAN_DEUDA_%' THEN
  CAST(TRY_STRPTIME('2024' || substr(archivo, 14, 2) || substr(archivo, 12, 2), '%Y%m%d') AS DATE) END AS fecha
FROM tran_deuda
""")
def b9(t):
    return t.tran_deuda().select(
        "cod_cuenta", "archivo", dates.file_date(F.col("archivo"), F.lit(2024)).alias("fecha")
    )


@query("b9_file_date_patterns", """
SELECT k, nombre, CASE k % 3
  WHEN 0 THEN CAST(d AS DATE)
  WHEN 1 THEN CAST(d AS DATE)
  ELSE CAST(d AS DATE) END AS fecha
FROM (SELECT o_orderkey AS k, CAST(o_orderdate AS DATE) AS d,
        CASE o_orderkey % 3 WHEN 0 THEN 'X_' || strftime(o_orderdate, '%Y%m%d') || '.txt'
             WHEN 1 THEN 'P_' || strftime(o_orderdate, '%d%m%Y') || '.txt'
             ELSE 'TRAN_DEUDA_' || strftime(o_orderdate, '%d%m') || '.txt' END AS nombre FROM orders)
""")
def b9_patterns(t):
    k, d = F.col("o_orderkey"), F.col("o_orderdate")
    name = (
        F.when(k % 3 == 0, F.concat(F.lit("X_"), F.date_format(d, "yyyyMMdd"), F.lit(".txt")))
        .when(k % 3 == 1, F.concat(F.lit("P_"), F.date_format(d, "ddMMyyyy"), F.lit(".txt")))
        .otherwise(F.concat(F.lit("TRAN_DEUDA_"), F.date_format(d, "ddMM"), F.lit(".txt")))
    )
    named = t.raw("orders").select(k.alias("k"), name.alias("nombre"), F.year(d).alias("ano"))
    return named.select("k", "nombre", dates.file_date(F.col("nombre"), F.col("ano")).alias("fecha"))


@query("b10_debt_date", "SELECT cod_cuenta, archivo, fecha_deuda_construida FROM deuda")
def b10(t):
    return t.debt.select("cod_cuenta", "archivo", "fecha_deuda_construida")


@query("b11_bot_shape", """
SELECT date, OPERADOR, GRUPO_RESPUESTA, GLOSA_RESPUESTA, NIVEL_1, NIVEL_2, NIVEL_3, monto_compromiso
FROM gestiones_p WHERE CANAL = 'BOT'
""")
def b11(t):
    return harmonise.shape_bot(t.gestiones_bot()).select(
        "date", "OPERADOR", "GRUPO_RESPUESTA", "GLOSA_RESPUESTA", "NIVEL_1", "NIVEL_2", "NIVEL_3", "monto_compromiso"
    )


@query("b12_human_shape", """
SELECT date, OPERADOR, GRUPO_RESPUESTA, NIVEL_1, NIVEL_2, NIVEL_3, monto_compromiso
FROM gestiones_p WHERE CANAL = 'HUMANO'
""")
def b12(t):
    return harmonise.shape_human(t.gestiones_humano()).select(
        "date", "OPERADOR", "GRUPO_RESPUESTA", "NIVEL_1", "NIVEL_2", "NIVEL_3", "monto_compromiso"
    )


@query("b13_normalise", """
SELECT * FROM unificadas WHERE canal_origen = 'HUMANO' OR CAST(fecha_gestion AS DATE) >= DATE '2024-01-10'
""")
def b13(t):
    return harmonise.unify(
        harmonise.normalise_bot(t.gestiones_bot(), date(2024, 1, 10)),
        harmonise.normalise_human(t.gestiones_humano()),
    )


@query("b14_operator", "SELECT fecha_gestion, CANAL, OPERADOR_FINAL FROM gestiones")
def b14(t):
    return t.gestiones.select("fecha_gestion", "CANAL", "OPERADOR_FINAL")


@query("b15_harmonise", """
SELECT cod_luna, fecha_gestion, monto_compromiso, fecha_compromiso, CANAL, OPERADOR_FINAL, GRUPO_RESPUESTA, NIVEL_1,
       NIVEL_2, es_compromiso, es_contacto_efectivo FROM gestiones
""")
def b15(t):
    return t.gestiones


@query("b16_promise_flag", "SELECT CANAL, es_compromiso, COUNT(*) AS n FROM gestiones GROUP BY 1, 2")
def b16(t):
    return t.gestiones.groupBy("CANAL", "es_compromiso").agg(F.count(F.lit(1)).alias("n"))


EVENT_KIND = "CASE event_type WHEN 'click' THEN 'CONTACTO_EFECTIVO' WHEN 'view' THEN 'CONTACTO_NO_EFECTIVO' " \
             "WHEN 'signup' THEN 'Compromiso_Pago' WHEN 'error' THEN 'Contacto_Efectivo' ELSE NULL END"


def _managements(t):
    kind = F.col("event_type")
    management = (
        F.when(kind == "click", "CONTACTO_EFECTIVO").when(kind == "view", "CONTACTO_NO_EFECTIVO")
        .when(kind == "signup", "Compromiso_Pago").when(kind == "error", "Contacto_Efectivo")
    )
    return t.raw("events").select("event_id", management.alias("management"))


@query("b17_effective_like", f"""
SELECT event_id, COALESCE(upper({EVENT_KIND}) LIKE '%EFECTIVO%', FALSE) AS efectivo FROM events
""")
def b17(t):
    return _managements(t).select("event_id", rules.is_effective_like(F.col("management")).alias("efectivo"))


@query("b18_effective_exact", """
SELECT event_id, event_type IN ('click', 'error') AS efectivo FROM events
""")
def b18(t):
    return _managements(t).select("event_id", rules.is_effective_exact(F.col("management")).alias("efectivo"))


@query("b19_commitment", "SELECT event_id, event_type = 'signup' AS compromiso FROM events")
def b19(t):
    return _managements(t).select("event_id", rules.declares_commitment(F.col("management")).alias("compromiso"))


@query("b20_defaults", """
SELECT SEGMENTO_GESTION, VENCIMIENTO, SERVICIO, ZONA_GEOGRAFICA, COUNT(*) AS n FROM universo GROUP BY 1, 2, 3, 4
""")
def b20(t):
    return t.universe.groupBy("SEGMENTO_GESTION", "VENCIMIENTO", "SERVICIO", "ZONA_GEOGRAFICA").agg(
        F.count(F.lit(1)).alias("n")
    )


@query("b21_missing_dimension", """
SELECT GRUPO_RESPUESTA, 'NO_DISPONIBLE' AS SUCURSAL, COUNT(*) AS n FROM gestiones_p GROUP BY 1
""")
def b21(t):
    from moraflow.operators import first_contact

    rows = first_contact.ensure_dimensions(t.shaped, ["GRUPO_RESPUESTA", "SUCURSAL"])
    return rows.groupBy("GRUPO_RESPUESTA", "SUCURSAL").agg(F.count(F.lit(1)).alias("n"))


@query("b22_base_dimensions", """
SELECT cuenta, CARTERA, SEGMENTO, SERVICIO, FECHA_ASIGNACION AS FECHA_INICIO_GESTION, VENCIMIENTO, OBJ_RECUPERO
FROM base_p
""")
def b22(t):
    return t.base.select(
        "cuenta", "CARTERA", "SEGMENTO", "SERVICIO", "FECHA_INICIO_GESTION", "VENCIMIENTO", "OBJ_RECUPERO"
    )


@query("b23_payment_flags", """
SELECT FECHA_PAGO, MONTO_PAGADO, ES_PAGO_CON_PDP, PDP_ESTABA_VIGENTE, PAGO_ES_PUNTUAL FROM fact_recupero
""")
def b23(t):
    return t.recovery.select(
        "FECHA_PAGO", "MONTO_PAGADO", "ES_PAGO_CON_PDP", "PDP_ESTABA_VIGENTE", "PAGO_ES_PUNTUAL"
    )


@query("b24_days_between", "SELECT FECHA_PAGO, FECHA_GESTION_ATRIBUIDA, DIAS_ENTRE_GESTION_Y_PAGO FROM fact_recupero")
def b24(t):
    return t.recovery.select("FECHA_PAGO", "FECHA_GESTION_ATRIBUIDA", "DIAS_ENTRE_GESTION_Y_PAGO")


@query("b25_score", """
SELECT EFECTIVIDAD_ATRIBUCION, COUNT(*) AS n, CAST(SUM(CAST(MONTO_PAGADO AS DECIMAL(18, 2))) AS DOUBLE) AS monto
FROM fact_recupero GROUP BY 1
""")
def b25(t):
    return t.recovery.groupBy("EFECTIVIDAD_ATRIBUCION").agg(
        F.count(F.lit(1)).alias("n"), rules.money_sum(F.col("MONTO_PAGADO")).alias("monto")
    )


@query("b26_status", """
SELECT CARTERA, SERVICIO, VENCIMIENTO, CANAL, CASE WHEN CUMPLIMIENTO_OBJETIVO >= 1 THEN '🟢 SUPERADO'
  WHEN CUMPLIMIENTO_OBJETIVO >= 0.8 THEN '🟡 EN RANGO' ELSE '🔴 BAJO OBJETIVO' END AS STATUS_OBJETIVO FROM fact_kpis
""")
def b26(t):
    status = rules.objective_status(F.col("CUMPLIMIENTO_OBJETIVO"))
    return t.kpis.select("CARTERA", "SERVICIO", "VENCIMIENTO", "CANAL", status.alias("STATUS_OBJETIVO"))


@query("b27_safe_ratio", """
SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice / NULLIF(l_discount, 0) AS razon,
       COALESCE(l_tax / NULLIF(l_discount, 0), 0) AS razon_o_cero FROM lineitem
""")
def b27(t):
    price, discount, tax = F.col("l_extendedprice"), F.col("l_discount"), F.col("l_tax")
    return t.raw("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        rules.ratio(price, discount).alias("razon"), rules.ratio_or_zero(tax, discount).alias("razon_o_cero"),
    )


@query("b29_service_date", """
SELECT event_id, CAST(ts AS DATE) AS FECHA_SERVICIO, strftime(ts, '%d/%m/%Y') AS FECHA_FORMATO FROM events
""")
def b29(t):
    return t.raw("events").select(
        "event_id", F.to_date("ts").alias("FECHA_SERVICIO"), rules.day_text(F.col("ts")).alias("FECHA_FORMATO")
    )


@query("b30_check_label", """
SELECT archivo, COUNT(*) AS n, CASE WHEN COUNT(*) = 0 THEN '✅ OK' WHEN COUNT(*) < 1000 THEN '⚠️ REVISAR'
  ELSE '❌ PROBLEMA' END AS estado FROM asignacion GROUP BY 1
""")
def b30(t):
    counts = t.accounts().groupBy("archivo").agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("estado", rules.check_label(F.col("n")))
