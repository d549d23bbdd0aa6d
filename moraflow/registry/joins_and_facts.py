"""Registered queries: joins, fact tables and their aggregations."""

from pyspark.sql import functions as F

from moraflow.functions import rules
from moraflow.operators import attribution, harmonise, periods
from moraflow.plans import facts, quality
from moraflow.registry.core import WINDOW, query
from moraflow.registry.scans_and_rules import OPEN_CLIENTS, open_clients


@query("c1_left_calendar", """
SELECT cuenta, archivo, FECHA_ASIGNACION, FECHA_CIERRE, FECHA_TRANDEUDA FROM asignacion
LEFT JOIN (SELECT * FROM calendario WHERE estado = 'finalizado') ON archivo = cal_archivo || '.txt'
""")
def c1(t):
    closed = periods.period_columns(t.calendario().where("ESTADO = 'finalizado'"))
    return periods.with_period(t.accounts(), closed, "left").select(
        "cuenta", "archivo", "FECHA_ASIGNACION", "FECHA_CIERRE", "FECHA_TRANDEUDA"
    )


@query("c2_inner_calendar", """
SELECT cuenta, archivo, FECHA_ASIGNACION, FECHA_CIERRE, FECHA_TRANDEUDA FROM asignacion
JOIN (SELECT * FROM calendario WHERE estado = 'finalizado') ON archivo = cal_archivo || '.txt'
""")
def c2(t):
    closed = periods.period_columns(t.calendario().where("ESTADO = 'finalizado'"))
    return periods.with_period(t.accounts(), closed).select(
        "cuenta", "archivo", "FECHA_ASIGNACION", "FECHA_CIERRE", "FECHA_TRANDEUDA"
    )


@query("c3_interaction_assignment", """
SELECT archivo, CANAL, COUNT(*) AS filas, COUNT(DISTINCT cod_luna) AS clientes
FROM gestiones_p JOIN base_p USING (cod_luna) GROUP BY 1, 2
""")
def c3(t):
    per_client = t.shaped.groupBy("cod_luna", "CANAL").agg(F.count(F.lit(1)).alias("q"))
    held = t.accounts().groupBy("cod_luna", "archivo").agg(F.count(F.lit(1)).alias("q_cuentas"))
    return per_client.join(held, "cod_luna").groupBy("archivo", "CANAL").agg(
        F.sum(F.col("q") * F.col("q_cuentas")).alias("filas"), F.count_distinct("cod_luna").alias("clientes")
    )


@query("c4_semi", f"""
SELECT event_id, user_id FROM events WHERE user_id IN {OPEN_CLIENTS}
""")
def c4(t):
    ids = open_clients(t).select(F.col("cod_luna").alias("user_id")).distinct()
    return t.raw("events").select("event_id", "user_id").join(ids, "user_id", "left_semi")


@query("c8_null_tolerant", """
SELECT fecha_gestion, CANAL, OPERADOR_FINAL, GRUPO_RESPUESTA, NIVEL_1, NIVEL_2, es_compromiso FROM gestiones
""")
def c8(t):
    """Lookup keys stored as null where the interaction has an empty text."""
    keys = ["bot_sub_management", "bot_compromiso"]
    lookup = t.homolog_bot().withColumns({k: F.nullif(F.col(k), F.lit("")) for k in keys})
    rows = harmonise.harmonise(
        t.gestiones_bot(), t.gestiones_humano(), lookup, t.homolog_humano(), t.homolog_usuarios(),
        first_valid_day=WINDOW.first, null_tolerant=True,
    )
    return rows.select(
        "fecha_gestion", "CANAL", "OPERADOR_FINAL", "GRUPO_RESPUESTA", "NIVEL_1", "NIVEL_2", "es_compromiso"
    )


@query("c9_debt_match", """
SELECT cuenta, FECHA_TRANDEUDA, CAST(CAST(monto_exigible AS DECIMAL(18, 2)) AS DOUBLE) AS monto_exigible
FROM universo LEFT JOIN deuda ON CAST(cuenta AS VARCHAR) = cod_cuenta AND FECHA_TRANDEUDA = fecha_deuda_construida
""")
def c9(t):
    rows = facts.match_debt(t.universe, t.debt)
    amount = F.when(F.col("centavos").isNotNull(), rules.from_cents(F.col("centavos")))
    return rows.select("cuenta", "FECHA_TRANDEUDA", amount.alias("monto_exigible"))


@query("c10_interval", """
SELECT FECHA_SERVICIO, ID_ARCHIVO_ASIGNACION, CANAL, COUNT(*) AS filas, COUNT(DISTINCT cliente) AS clientes,
       CAST(SUM(CAST(monto_compromiso AS DECIMAL(18, 2))) AS DOUBLE) AS monto
FROM en_contexto GROUP BY 1, 2, 3
""")
def c10(t):
    held = periods.account_groups(t.universe, ["ID_ARCHIVO_ASIGNACION"])
    rows = periods.match_periods(periods.daily_responses(t.gestiones), held)
    n = F.col("q_cuentas")
    return rows.groupBy("FECHA_SERVICIO", "ID_ARCHIVO_ASIGNACION", "CANAL").agg(
        F.sum(F.col("q") * n).alias("filas"),
        F.count_distinct("cliente").alias("clientes"),
        rules.from_cents(F.sum(F.col("centavos") * n)).alias("monto"),
    )


@query("c11_payment_chain", """
SELECT CARTERA, SERVICIO, COUNT(*) AS filas, CAST(SUM(CAST(monto_cancelado AS DECIMAL(18, 2))) AS DOUBLE) AS monto
FROM pagos p JOIN deuda d ON p.nro_documento = d.nro_documento JOIN universo ON CAST(cuenta AS VARCHAR) = cod_cuenta
GROUP BY 1, 2
""")
def c11(t):
    return attribution.payment_chain(t.pagos(), t.debt, t.universe, ["CARTERA", "SERVICIO"])


@query("c12_asof", """
SELECT cod_sistema, fecha_pago, fecha_gestion, CANAL, OPERADOR_FINAL FROM pagos_atribuidos
""")
def c12(t):
    credited = attribution.with_last_interaction(t.paid, t.gestiones)
    return credited.select("cod_sistema", "fecha_pago", "fecha_gestion", "CANAL", "OPERADOR_FINAL")


@query("c13_latest", """
SELECT cod_sistema, fecha_pago, FECHA_ASIGNACION, CARTERA, ID_ARCHIVO_ASIGNACION FROM pagos_asignados
""")
def c13(t):
    return t.paid.select("cod_sistema", "fecha_pago", "FECHA_ASIGNACION", "CARTERA", "ID_ARCHIVO_ASIGNACION")


@query("c14_full_outer", """
SELECT CARTERA, SERVICIO, VENCIMIENTO, CATEGORIA_VENCIMIENTO, CANAL, UNIVERSO_CUENTAS, CUENTAS_CONTACTADAS,
       MONTO_RECUPERADO FROM kpi_rows
WHERE UNIVERSO_CUENTAS > 0 OR CUENTAS_CONTACTADAS > 0 OR MONTO_RECUPERADO > 0
""")
def c14(t):
    return t.kpis.select(*facts.DUE_KEYS, "CANAL", "UNIVERSO_CUENTAS", "CUENTAS_CONTACTADAS", "MONTO_RECUPERADO")


@query("c18_anti", f"""
SELECT DISTINCT cod_luna FROM gestiones
WHERE cod_luna NOT IN {OPEN_CLIENTS}
""")
def c18(t):
    """Interacted clients without an assignment in an open period."""
    return periods.clients_without_assignment(t.gestiones, open_clients(t))


@query("c5_bot_lookup", """
SELECT fecha_gestion, GRUPO_RESPUESTA, NIVEL_1, NIVEL_2, es_compromiso FROM gestiones WHERE CANAL = 'BOT'
""")
def c5(t):
    rows = harmonise.harmonise_bot(harmonise.normalise_bot(t.gestiones_bot(), WINDOW.first), t.homolog_bot())
    return rows.select("fecha_gestion", "GRUPO_RESPUESTA", "NIVEL_1", "NIVEL_2", "es_compromiso")


@query("c6_human_lookup", """
SELECT fecha_gestion, OPERADOR_FINAL, GRUPO_RESPUESTA, NIVEL_1, NIVEL_2, es_compromiso FROM gestiones
WHERE CANAL = 'HUMANO'
""")
def c6(t):
    human = harmonise.normalise_human(t.gestiones_humano())
    rows = harmonise.harmonise_human(human, t.homolog_humano(), t.homolog_usuarios())
    return rows.select("fecha_gestion", "OPERADOR_FINAL", "GRUPO_RESPUESTA", "NIVEL_1", "NIVEL_2", "es_compromiso")


@query("c19_outside_period", """
SELECT COUNT(*) AS casos FROM universo JOIN gestiones USING (cod_luna)
WHERE NOT (dia BETWEEN FECHA_ASIGNACION AND COALESCE(FECHA_CIERRE, DATE '2099-12-31'))
""")
def c19(t):
    per_day = periods.daily_responses(t.gestiones)
    return periods.outside_period_count(per_day, periods.account_groups(t.universe, []))


@query("c20_min_by_key", """
SELECT FECHA_ASIGNACION, f.ID_ARCHIVO_ASIGNACION, f.CARTERA, SEGMENTO_GESTION, Q_CUENTAS_ASIGNADAS,
       COALESCE(m, DATE '1900-01-01') AS VENCIMIENTO,
       CASE WHEN m IS NULL THEN 'SIN_VENCIMIENTO' WHEN m <= FECHA_ASIGNACION THEN 'VENCIDO'
            WHEN m - FECHA_ASIGNACION <= 30 THEN 'POR_VENCER_30D' WHEN m - FECHA_ASIGNACION <= 60 THEN 'POR_VENCER_60D'
            WHEN m - FECHA_ASIGNACION <= 90 THEN 'POR_VENCER_90D' ELSE 'VIGENTE_MAS_90D' END AS CATEGORIA_VENCIMIENTO
FROM fact_universo f
LEFT JOIN (SELECT archivo, MIN(min_vto) AS m FROM asignacion GROUP BY 1) a
     ON a.archivo = f.ID_ARCHIVO_ASIGNACION || '.txt'
""")
def c20(t):
    from moraflow.plans import migration

    old = t.universe_fact.drop("VENCIMIENTO", "CATEGORIA_VENCIMIENTO")
    return migration.backfill_universe(old, t.accounts()).select(
        "FECHA_ASIGNACION", "ID_ARCHIVO_ASIGNACION", "CARTERA", "SEGMENTO_GESTION", "Q_CUENTAS_ASIGNADAS",
        "VENCIMIENTO", "CATEGORIA_VENCIMIENTO",
    )


FACT_TABLES = ["asignacion_universo", "gestion_agregada", "recupero_atribuido", "kpis_ejecutivos"]


@query("c21_cross", """
SELECT table_name, CATEGORIA_VENCIMIENTO, CAST(1 AS BIGINT) AS registros
FROM (SELECT DISTINCT CATEGORIA_VENCIMIENTO FROM universo),
     (VALUES ('asignacion_universo'), ('gestion_agregada'), ('recupero_atribuido'), ('kpis_ejecutivos')) v(table_name)
""")
def c21(t):
    return quality.tables_by_category(t.universe, FACT_TABLES)


# ---- facts -----------------------------------------------------------------------------------

@query("d7_universe", "SELECT * FROM fact_universo")
def d7(t):
    return t.universe_fact


@query("d7_dedupe_account", """
SELECT FECHA_ASIGNACION, CARTERA, SERVICIO, SEGMENTO_GESTION, VENCIMIENTO, CATEGORIA_VENCIMIENTO,
       ID_ARCHIVO_ASIGNACION, ZONA_GEOGRAFICA, TIPO_FRACCIONAMIENTO, Q_CUENTAS_ASIGNADAS, MONTO_EXIGIBLE_ASIGNADO
FROM fact_universo
""")
def d7_dedupe(t):
    fact = facts.universe_fact(t.universe, t.debt, WINDOW, dedupe_account=True)
    return fact.select(*facts.UNIVERSE_KEYS, "Q_CUENTAS_ASIGNADAS", "MONTO_EXIGIBLE_ASIGNADO")


@query("d8_daily", "SELECT * FROM fact_diaria")
def d8(t):
    return t.daily


@query("d8_recovery", "SELECT * FROM fact_recupero")
def d8_recovery(t):
    return t.recovery


@query("d8_recovery_compat", """
SELECT nro_documento, dp AS FECHA_PAGO, monto_cancelado AS MONTO_PAGADO,
       COALESCE(CANAL, 'SIN_GESTION_PREVIA') AS CANAL_ATRIBUIDO
FROM (SELECT *, CAST(fecha_pago AS DATE) AS dp,
             ROW_NUMBER() OVER (PARTITION BY nro_documento ORDER BY fecha_pago DESC, monto_cancelado DESC) AS r
      FROM pagos_atribuidos) WHERE r = 1
""")
def d8_recovery_compat(t):
    """One payment per document, as the document-wise ranking leaves it."""
    latest = attribution.latest_assignment_by_document(t.debt, t.universe)
    paid = attribution.with_latest_assignment(attribution.one_payment_per_document(t.pagos()), latest)
    return attribution.with_last_interaction(paid, t.gestiones).select(
        "nro_documento",
        F.to_date("fecha_pago").alias("FECHA_PAGO"),
        F.col("monto_cancelado").alias("MONTO_PAGADO"),
        rules.or_default(F.col("CANAL"), "SIN_GESTION_PREVIA").alias("CANAL_ATRIBUIDO"),
    )


@query("d9_kpis", "SELECT * FROM fact_kpis")
def d9(t):
    return t.kpis


@query("d9_compat", """
, filas AS (
  SELECT COALESCE(u.CARTERA, g.CARTERA, r.CARTERA) AS CARTERA, COALESCE(u.SERVICIO, g.SERVICIO, r.SERVICIO) AS SERVICIO,
         COALESCE(u.VENCIMIENTO, g.VENCIMIENTO, r.VENCIMIENTO) AS VENCIMIENTO,
         COALESCE(u.CATEGORIA_VENCIMIENTO, g.CATEGORIA_VENCIMIENTO, r.CATEGORIA_VENCIMIENTO) AS CATEGORIA_VENCIMIENTO,
         COALESCE(g.CANAL, r.CANAL_ATRIBUIDO, 'TOTAL') AS CANAL,
         CAST(SUM(COALESCE(u.Q_CUENTAS_ASIGNADAS, 0)) AS BIGINT) AS UNIVERSO_CUENTAS,
         CAST(SUM(COALESCE(CAST(u.MONTO_EXIGIBLE_ASIGNADO AS DECIMAL(18, 2)), 0)) AS DOUBLE) AS UNIVERSO_MONTO,
         ROUND(CAST(SUM(CAST(COALESCE(u.OBJ_RECUPERO, 0.20) AS DECIMAL(28, 12))) AS DOUBLE) / COUNT(*), 9)
              AS OBJ_RECUPERO_PROMEDIO,
         CAST(SUM(COALESCE(g.Q_CLIENTES_UNICOS_CONTACTADOS, 0)) AS BIGINT) AS CUENTAS_CONTACTADAS,
         ROUND(CAST(SUM(CAST(COALESCE(g.EFECTIVIDAD_CONTACTO, 0) AS DECIMAL(28, 12))) AS DOUBLE) / COUNT(*), 9)
              AS EFECTIVIDAD_PROMEDIO,
         CAST(SUM(COALESCE(CAST(g.MONTO_COMPROMETIDO AS DECIMAL(18, 2)), 0)) AS DOUBLE) AS MONTO_COMPROMETIDO,
         ROUND(CAST(SUM(CAST(COALESCE(g.TASA_COMPROMISO, 0) AS DECIMAL(28, 12))) AS DOUBLE) / COUNT(*), 9)
              AS TASA_COMPROMISO_PROMEDIO,
         CAST(SUM(COALESCE(CAST(r.MONTO_PAGADO AS DECIMAL(18, 2)), 0)) AS DOUBLE) AS MONTO_RECUPERADO
  FROM fact_universo u
  FULL JOIN fact_diaria g ON u.CARTERA = g.CARTERA AND u.SERVICIO = g.SERVICIO
       AND u.CATEGORIA_VENCIMIENTO = g.CATEGORIA_VENCIMIENTO
  FULL JOIN fact_recupero r ON COALESCE(u.CARTERA, g.CARTERA) = r.CARTERA
       AND COALESCE(u.SERVICIO, g.SERVICIO) = r.SERVICIO
       AND COALESCE(u.CATEGORIA_VENCIMIENTO, g.CATEGORIA_VENCIMIENTO) = r.CATEGORIA_VENCIMIENTO
  WHERE u.FECHA_ASIGNACION BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'
     OR g.FECHA_SERVICIO BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'
     OR r.FECHA_PAGO BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'
  GROUP BY 1, 2, 3, 4, 5)
SELECT DATE '2024-01-05' AS FECHA_CALCULO, *,
       CUENTAS_CONTACTADAS::DOUBLE / NULLIF(UNIVERSO_CUENTAS, 0)::DOUBLE AS TASA_CONTACTABILIDAD,
       MONTO_RECUPERADO / NULLIF(UNIVERSO_MONTO, 0) AS TASA_RECUPERACION,
       MONTO_RECUPERADO / NULLIF(UNIVERSO_MONTO, 0) / NULLIF(OBJ_RECUPERO_PROMEDIO, 0)
            AS CUMPLIMIENTO_OBJETIVO
FROM filas WHERE UNIVERSO_CUENTAS > 0 OR CUENTAS_CONTACTADAS > 0 OR MONTO_RECUPERADO > 0
""")
def d9_compat(t):
    """Facts of the whole month, KPI window inside it, so that rows outside the window take part."""
    from datetime import date

    inner = facts.RunWindow(date(2024, 1, 5), date(2024, 1, 20), WINDOW.as_of)
    return facts.executive_kpis_row_product(t.universe_fact, t.daily, t.recovery, inner)


@query("d10_conditional_distinct", """
SELECT CARTERA, COUNT(DISTINCT CASE WHEN es_compromiso = 1 THEN cliente END) AS clientes_con_promesa
FROM en_contexto GROUP BY 1
""")
def d10(t):
    held = t.universe.select("cod_luna", "cliente", "CARTERA", "FECHA_ASIGNACION", "FECHA_CIERRE").distinct()
    rows = periods.match_periods(periods.daily_responses(t.gestiones), held)
    promised = F.when(F.col("q_promesas") > 0, F.col("cliente"))
    return rows.groupBy("CARTERA").agg(F.count_distinct(promised).alias("clientes_con_promesa"))


@query("d11_conditional_sum", """
SELECT CANAL, COUNT(CASE WHEN es_contacto_efectivo = 1 THEN 1 END) AS efectivos,
       CAST(SUM(CASE WHEN es_compromiso = 1 THEN CAST(monto_compromiso AS DECIMAL(18, 2)) ELSE 0 END) AS DOUBLE) AS monto
FROM gestiones GROUP BY 1
""")
def d11(t):
    amount = F.when(F.col("es_compromiso") == 1, F.col("monto_compromiso")).otherwise(0.0)
    return t.gestiones.groupBy("CANAL").agg(
        F.count_if(F.col("es_contacto_efectivo") == 1).alias("efectivos"), rules.money_sum(amount).alias("monto")
    )


@query("e4_first_of_day", """
SELECT cod_luna, dia AS FECHA_SERVICIO, fecha_gestion, CANAL, OPERADOR_FINAL, GRUPO_RESPUESTA, NIVEL_1, NIVEL_2
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY cod_luna, dia ORDER BY fecha_gestion, CANAL) AS r FROM gestiones)
WHERE r = 1
""")
def e4(t):
    return periods.first_of_day(t.gestiones)


@query("e5_last_assignment", """
SELECT nro_documento, FECHA_ASIGNACION, CARTERA, cod_luna FROM (
  SELECT d.nro_documento, u.*, ROW_NUMBER() OVER (PARTITION BY d.nro_documento
         ORDER BY FECHA_ASIGNACION DESC, cuenta DESC) AS r
  FROM deuda d JOIN universo u ON CAST(cuenta AS VARCHAR) = cod_cuenta) WHERE r = 1
""")
def e5(t):
    return attribution.latest_assignment_by_document(t.debt, t.universe).select(
        "nro_documento", "FECHA_ASIGNACION", "CARTERA", "cod_luna"
    )


@query("e6_last_before", """
SELECT p.event_id, MAX(g.fecha_gestion) AS fecha_gestion
FROM events p LEFT JOIN gestiones g ON g.cod_luna = p.user_id AND g.dia <= CAST(p.ts AS DATE)
WHERE event_type = 'purchase' GROUP BY 1
""")
def e6(t):
    bought = t.raw("events").where("event_type = 'purchase'").select(
        "event_id", F.col("user_id").alias("cod_luna"), F.col("ts").alias("fecha_pago")
    )
    return attribution.with_last_interaction(bought, t.gestiones).select("event_id", "fecha_gestion")


@query("g1_union_all", "SELECT canal_origen, COUNT(*) AS n FROM unificadas GROUP BY 1")
def g1(t):
    rows = harmonise.unify(
        harmonise.normalise_bot(t.gestiones_bot(), WINDOW.first), harmonise.normalise_human(t.gestiones_humano())
    )
    return rows.groupBy("canal_origen").agg(F.count(F.lit(1)).alias("n"))


@query("g2_concat_channels", """
SELECT date, n1, compromiso FROM (
  SELECT date, CAST(NULL AS VARCHAR) AS n1, compromiso FROM gestiones_bot
  UNION ALL SELECT date, n1, NULL FROM gestiones_humano)
""")
def g2(t):
    both = t.gestiones_bot().unionByName(t.gestiones_humano(), allowMissingColumns=True)
    return both.select("date", "n1", "compromiso")


@query("g3_union_distinct", """
SELECT document FROM gestiones_bot UNION SELECT document FROM gestiones_humano
""")
def g3(t):
    return t.gestiones_bot().select("document").union(t.gestiones_humano().select("document")).distinct()


@query("g5_distinct", "SELECT DISTINCT CATEGORIA_VENCIMIENTO, CARTERA FROM universo")
def g5(t):
    return t.universe.select("CATEGORIA_VENCIMIENTO", "CARTERA").distinct()
