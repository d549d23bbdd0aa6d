"""Registration of queries with their SQL oracle, and the inputs both sides share."""

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from moraflow.operators import attribution, harmonise
from moraflow.operators import calendar as cal
from moraflow.operators import first_contact
from moraflow.plans import facts, portfolio
from moraflow.sources import scans
from moraflow.sources.driver_tables import AS_OF, DAY_0, LAST_DAY, DriverTables

WINDOW = facts.RunWindow(DAY_0, LAST_DAY, AS_OF)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Inputs(DriverTables):
    """Driver tables with the derived tables the queries start from (all lazy, each built once per query)."""

    @cached_property
    def universe(self) -> DataFrame:
        return facts.assigned_universe(self.asignacion(), self.calendario(), AS_OF)

    @cached_property
    def debt(self) -> DataFrame:
        return scans.dated_debt(self.tran_deuda())

    @cached_property
    def gestiones(self) -> DataFrame:
        return harmonise.harmonise(
            self.gestiones_bot(), self.gestiones_humano(), self.homolog_bot(), self.homolog_humano(),
            self.homolog_usuarios(), first_valid_day=DAY_0,
        )

    @cached_property
    def shaped(self) -> DataFrame:
        return harmonise.shape_bot(self.gestiones_bot()).unionByName(harmonise.shape_human(self.gestiones_humano()))

    @cached_property
    def base(self) -> DataFrame:
        return first_contact.base_dimensions(self.asignacion(), self.calendario())

    @cached_property
    def base_compat(self) -> DataFrame:
        return first_contact.base_dimensions(self.asignacion(), self.calendario(), segment_as_portfolio=True)

    @cached_property
    def universe_fact(self) -> DataFrame:
        return facts.universe_fact(self.universe, self.debt, WINDOW)

    @cached_property
    def daily(self) -> DataFrame:
        return facts.daily_management(self.universe, self.gestiones, WINDOW)

    @cached_property
    def recovery(self) -> DataFrame:
        return facts.attributed_recovery(self.pagos(), self.debt, self.universe, self.gestiones, WINDOW)

    @cached_property
    def kpis(self) -> DataFrame:
        return facts.executive_kpis(self.universe_fact, self.daily, self.recovery, WINDOW)

    @cached_property
    def paid(self) -> DataFrame:
        latest = attribution.latest_assignment_by_document(self.debt, self.universe)
        return attribution.with_latest_assignment(self.pagos(), latest)

    def calendar_of(self, table: str, day: str) -> DataFrame:
        return cal.business_calendar(self.span_of(table, day))

    def span_of(self, table: str, day: str) -> DataFrame:
        df = self.raw(table)
        return cal.range_of(df, df[day])

    @cached_property
    def contacts(self) -> DataFrame:
        return portfolio.contacts(self.shaped, self.base)


def query(name: str, sql: str | None = None):
    """Register a function of Inputs under a name, with the SQL that gives the same rows."""

    def register(build: Callable[[Inputs], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            from moraflow.session import configure

            return build(Inputs(configure(spark), sf_dir))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = f"WITH {BASE_SQL}\n{sql}"
        return build

    return register


def holidays_sql(years: str) -> str:
    """The default holidays for the years of a one-column relation, Easter by Carter's rule (1900 to 2099)."""
    return f"""
      SELECT make_date(a, m, d) AS fecha, nombre FROM {years}, (VALUES
        (1, 1, 'Año Nuevo'), (5, 1, 'Día del Trabajo'), (7, 28, 'Fiestas Patrias'), (7, 29, 'Fiestas Patrias'),
        (8, 30, 'Santa Rosa de Lima'), (10, 8, 'Combate de Angamos'), (11, 1, 'Todos los Santos'),
        (12, 8, 'Inmaculada Concepción'), (12, 25, 'Navidad')) f(m, d, nombre)
      UNION ALL
      SELECT easter - back, nombre FROM (
        SELECT a, make_date(a, 3, 1) + CAST(dd + 6 - (a + a // 4 + dd + 1) % 7 AS INTEGER) AS easter
        FROM (SELECT a, CASE WHEN d0 > 48 THEN d0 - 1 ELSE d0 END AS dd
              FROM (SELECT a, 21 + ((225 - 11 * (a % 19) - 21) % 30 + 30) % 30 AS d0 FROM {years}))
      ), (VALUES (3, 'Jueves Santo'), (2, 'Viernes Santo')) b(back, nombre)"""


def calendar_sql(first: str, last: str) -> str:
    """CTEs `cal` (per day) over whole months from the month before `first` to that of `last` (scalar SQL)."""
    return f"""
    cal_range AS (SELECT CAST(date_trunc('month', {first}) - INTERVAL 1 MONTH AS DATE) AS d1, last_day({last}) AS d2),
    cal_years AS (SELECT CAST(unnest(range(year(d1), year(d2) + 1)) AS INTEGER) AS a FROM cal_range),
    cal_holidays AS ({holidays_sql('cal_years')}),
    cal_days AS (SELECT CAST(unnest(generate_series(d1, d2, INTERVAL 1 DAY)) AS DATE) AS fecha FROM cal_range),
    cal_flag AS (
      SELECT d.fecha, h.nombre, isodow(d.fecha) <= 5 AND h.nombre IS NULL AS hab
      FROM cal_days d LEFT JOIN cal_holidays h ON d.fecha = h.fecha),
    cal_num AS (
      SELECT *, CASE WHEN hab THEN COUNT(CASE WHEN hab THEN 1 END) OVER (
               PARTITION BY year(fecha), month(fecha) ORDER BY fecha) ELSE 0 END AS n,
             COUNT(CASE WHEN hab THEN 1 END) OVER (PARTITION BY year(fecha), month(fecha)) AS tot,
             MAX(CASE WHEN hab THEN fecha END) OVER (PARTITION BY year(fecha), month(fecha)) AS ult,
             year(fecha) * 12 + month(fecha) AS ym
      FROM cal_flag),
    cal_month AS (SELECT ym, MAX(ult) AS ult, MAX(tot) AS tot FROM cal_num GROUP BY ym),
    cal AS (
      SELECT c.fecha, CAST(year(c.fecha) AS INTEGER) AS ano, CAST(month(c.fecha) AS INTEGER) AS mes,
             CAST(day(c.fecha) AS INTEGER) AS dia, CAST(isodow(c.fecha) AS INTEGER) AS dia_semana,
             c.hab AS es_dia_habil, CAST(c.n AS INTEGER) AS dia_habil_del_mes, c.nombre IS NOT NULL AS es_feriado,
             COALESCE(c.nombre, '') AS nombre_feriado,
             CASE WHEN c.hab THEN COALESCE(p.fecha, m.ult) END AS previo,
             CAST(c.tot AS INTEGER) AS tot, CAST(m.tot AS INTEGER) AS tot_previo, c.ult,
             ROUND(c.n::DOUBLE / c.tot, 6) AS progreso
      FROM cal_num c JOIN cal_month m ON m.ym = c.ym - 1
      LEFT JOIN cal_num p ON p.ym = c.ym - 1 AND p.n = c.n AND p.hab)"""


BASE_SQL = """
asignacion AS (
  SELECT o_custkey AS cod_luna, o_orderkey AS cuenta, o_custkey AS cliente, o_custkey * 10 + o_orderkey % 10 AS telefono,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'AL VCTO' WHEN '2-HIGH' THEN 'ENTRE 4 Y 15D'
              WHEN '3-MEDIUM' THEN 'TEMPRANA' WHEN '5-LOW' THEN NULL ELSE 'TARDIA' END AS tramo_gestion,
         c_mktsegment AS negocio, n_name AS zona,
         'Cartera_Gestion_' || CASE o_orderkey % 5 WHEN 0 THEN 'Temprana' WHEN 1 THEN 'CF_ANN' WHEN 2 THEN 'AN'
              WHEN 3 THEN 'Cobranding' ELSE 'Otra' END || '_W' || CAST((o_orderkey // 5) % 3 AS VARCHAR) || '.txt'
              AS archivo,
         CASE WHEN o_orderkey % 10 <> 0 THEN DATE '2023-12-15' + CAST(o_orderkey % 160 AS INTEGER) END AS min_vto,
         CASE WHEN o_orderstatus = 'P' THEN 'SI' ELSE 'NO' END AS fraccionamiento,
         CASE WHEN o_orderstatus = 'P' AND o_orderkey % 4 > 0 THEN CAST(o_orderkey % 4 AS VARCHAR) END
              AS cuota_fracc_act
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
calendario AS (
  SELECT a AS cal_archivo, n_cl AS cant_cod_luna_unique, n AS cant_registros_archivo,
         DATE '2024-01-01' + w * 7 AS FECHA_ASIGNACION, DATE '2024-01-01' + w * 7 AS FECHA_TRANDEUDA,
         CASE WHEN w <> 2 THEN DATE '2024-01-01' + w * 7 + 13 END AS FECHA_CIERRE, CAST(14 AS DOUBLE) AS DIAS_GESTION,
         CASE WHEN w = 2 THEN 'abierto' ELSE 'finalizado' END AS ESTADO
  FROM (SELECT replace(archivo, '.txt', '') AS a, CAST(right(replace(archivo, '.txt', ''), 1) AS INTEGER) AS w,
               COUNT(DISTINCT cod_luna) AS n_cl, COUNT(*) AS n FROM asignacion GROUP BY 1, 2)),
gestiones_bot AS (
  SELECT event_id, CASE WHEN event_id % 97 = 0 THEN 'X' ELSE '' END || CAST(user_id AS VARCHAR) AS document, ts AS date,
         CASE WHEN event_id % 23 = 0 THEN NULL WHEN event_type = 'click' THEN 'CONTACTO_EFECTIVO' ELSE 'NO_CONTESTA' END
              AS management,
         '' AS sub_management, CASE WHEN event_id % 5 = 0 THEN 'SI' ELSE '' END AS compromiso, value AS duracion
  FROM events WHERE event_type IN ('click', 'view')),
gestiones_humano AS (
  SELECT event_id, CAST(user_id AS VARCHAR) AS document, ts AS date,
         CASE WHEN event_id % 23 = 0 THEN NULL WHEN event_type = 'signup' THEN 'Compromiso_Pago'
              ELSE 'Contacto_Efectivo' END AS management,
         '' AS sub_management, event_type AS n1,
         CASE WHEN event_id % 2 = 0 THEN ' ' ELSE 'N2_' || CAST(event_id % 3 AS VARCHAR) END AS n2,
         CAST(NULL AS VARCHAR) AS n3, CASE WHEN event_type = 'signup' THEN value END AS monto_compromiso,
         CASE WHEN event_type = 'signup' THEN CAST(ts AS DATE) + CAST(event_id % 5 AS INTEGER) END AS fecha_compromiso,
         CASE WHEN event_id % 11 <> 0 THEN 'AG_' || CAST(event_id % 7 AS VARCHAR) END AS nombre_agente,
         value AS duracion
  FROM events WHERE event_type IN ('signup', 'error')),
tran_deuda AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS cod_cuenta, 'D' || CAST(o_custkey AS VARCHAR) AS nro_documento,
         CASE WHEN o_orderkey % 10 <> 0 THEN DATE '2023-12-15' + CAST(o_orderkey % 160 AS INTEGER) END
              AS fecha_vencimiento,
         o_totalprice AS monto_exigible,
         CASE WHEN o_orderkey % 13 = 0 THEN 'OTRO_ARCHIVO.txt' WHEN o_orderkey % 17 = 0 THEN 'TRAN_DEUDA_3102.txt'
              ELSE 'TRAN_DEUDA_' || CASE (o_orderkey // 5) % 3 WHEN 0 THEN '0101' WHEN 1 THEN '0801' ELSE '1501' END
                   || '.txt' END AS archivo,
         TIMESTAMP '2024-01-01 06:00:00' AS creado_el
  FROM orders),
pagos AS (
  SELECT CAST(event_id AS VARCHAR) AS cod_sistema, 'D' || CAST(user_id AS VARCHAR) AS nro_documento,
         value AS monto_cancelado, ts AS fecha_pago, 'PAGOS' AS archivo
  FROM events WHERE event_type = 'purchase'),
homolog_bot AS (
  SELECT * FROM (VALUES ('CONTACTO_EFECTIVO', '', '', 'CONTACTO', 'N1A', 'N2A', 0),
                        ('CONTACTO_EFECTIVO', '', 'SI', 'PROMESA', 'N1B', 'N2B', 1),
                        ('NO_CONTESTA', '', '', 'SIN_CONTACTO', 'N1C', 'N2C', 0))
  t(bot_management, bot_sub_management, bot_compromiso, contactabilidad_homologada, n1_homologado, n2_homologado,
    es_pdp_homologado)),
homolog_humano AS (
  SELECT * FROM (VALUES ('Compromiso_Pago', 'PROMESA', 'N1D', 'N2D', 'si'),
                        ('Contacto_Efectivo', 'CONTACTO', 'N1E', NULL, 'NO'))
  t(management, contactabilidad, n_1, n_2, pdp)),
homolog_usuarios AS (
  SELECT * FROM (VALUES ('AG_0', 'AGENTE_CERO'), ('AG_1', 'AGENTE_UNO')) t(usuario, usuario_homologado)),
unificadas AS (
  SELECT TRY_CAST(document AS BIGINT) AS cod_luna, date AS fecha_gestion,
         COALESCE(management, 'SIN_MANAGEMENT') AS management, '' AS sub_management, compromiso,
         'SISTEMA_BOT' AS nombre_agente, CAST(0 AS DOUBLE) AS monto_compromiso, CAST(NULL AS DATE) AS fecha_compromiso,
         'BOT' AS canal_origen
  FROM gestiones_bot WHERE TRY_CAST(document AS BIGINT) IS NOT NULL
  UNION ALL
  SELECT TRY_CAST(document AS BIGINT), date, COALESCE(management, 'SIN_MANAGEMENT'), '', '',
         COALESCE(nombre_agente, 'SIN_AGENTE'), COALESCE(monto_compromiso, 0), fecha_compromiso, 'HUMANO'
  FROM gestiones_humano WHERE TRY_CAST(document AS BIGINT) IS NOT NULL),
gestiones AS (
  SELECT g.cod_luna, g.fecha_gestion, CAST(g.fecha_gestion AS DATE) AS dia, g.monto_compromiso, g.fecha_compromiso,
         g.canal_origen AS CANAL,
         CASE WHEN canal_origen = 'BOT' THEN 'SISTEMA_BOT' ELSE COALESCE(usuario_homologado, nombre_agente) END
              AS OPERADOR_FINAL,
         COALESCE(CASE WHEN canal_origen = 'BOT' THEN contactabilidad_homologada ELSE contactabilidad END, g.management)
              AS GRUPO_RESPUESTA,
         COALESCE(CASE WHEN canal_origen = 'BOT' THEN n1_homologado ELSE n_1 END, 'SIN_N1') AS NIVEL_1,
         COALESCE(CASE WHEN canal_origen = 'BOT' THEN n2_homologado ELSE n_2 END, 'SIN_N2') AS NIVEL_2,
         CAST(CASE WHEN canal_origen = 'BOT' THEN COALESCE(es_pdp_homologado, 0)
              WHEN UPPER(pdp) = 'SI' THEN 1 ELSE 0 END AS BIGINT) AS es_compromiso,
         CAST(CASE WHEN UPPER(g.management) LIKE '%EFECTIVO%' THEN 1 ELSE 0 END AS BIGINT) AS es_contacto_efectivo
  FROM unificadas g
  LEFT JOIN homolog_bot b ON canal_origen = 'BOT' AND g.management = bot_management
       AND g.sub_management = bot_sub_management AND g.compromiso = bot_compromiso
  LEFT JOIN homolog_humano h ON canal_origen = 'HUMANO' AND g.management = h.management
  LEFT JOIN homolog_usuarios u ON canal_origen = 'HUMANO' AND nombre_agente = usuario),
universo AS (
  SELECT cod_luna, cuenta, cliente, telefono, COALESCE(negocio, 'SIN_SERVICIO') AS SERVICIO,
         COALESCE(tramo_gestion, 'SIN_SEGMENTO') AS SEGMENTO_GESTION, COALESCE(zona, 'SIN_ZONA') AS ZONA_GEOGRAFICA,
         COALESCE(min_vto, DATE '1900-01-01') AS VENCIMIENTO,
         CASE WHEN min_vto IS NULL THEN 'SIN_VENCIMIENTO' WHEN min_vto <= DATE '2024-01-31' THEN 'VENCIDO'
              WHEN min_vto <= DATE '2024-01-31' + 30 THEN 'POR_VENCER_30D'
              WHEN min_vto <= DATE '2024-01-31' + 60 THEN 'POR_VENCER_60D'
              WHEN min_vto <= DATE '2024-01-31' + 90 THEN 'POR_VENCER_90D' ELSE 'VIGENTE_MAS_90D' END
              AS CATEGORIA_VENCIMIENTO,
         FECHA_ASIGNACION, FECHA_CIERRE, FECHA_TRANDEUDA, DIAS_GESTION, cal_archivo AS ID_ARCHIVO_ASIGNACION,
         CASE WHEN upper(archivo) LIKE '%TEMPRANA%' THEN 'TEMPRANA' WHEN contains(upper(archivo), 'CF_ANN')
              THEN 'CUOTA_FIJA_ANUAL' WHEN contains(upper(archivo), '_AN_') THEN 'ALTAS_NUEVAS'
              WHEN contains(upper(archivo), 'COBRANDING') THEN 'COBRANDING' ELSE 'OTRAS' END AS CARTERA,
         CASE tramo_gestion WHEN 'AL VCTO' THEN 0.15 WHEN 'ENTRE 4 Y 15D' THEN 0.25 ELSE 0.20 END AS OBJ_RECUPERO,
         CASE WHEN fraccionamiento = 'SI' THEN 'FRACCIONADO' ELSE 'NORMAL' END AS TIPO_FRACCIONAMIENTO
  FROM asignacion JOIN calendario ON archivo = cal_archivo || '.txt'),
deuda AS (
  SELECT * FROM (
    SELECT *, CASE WHEN archivo LIKE 'TRAN_DEUDA_%'
                   THEN CAST(TRY_STRPTIME('2024' || substr(archivo, 14, 2) || substr(archivo, 12, 2), '%Y%m%d') AS DATE)
                   ELSE CAST(creado_el AS DATE) END AS fecha_deuda_construida
    FROM tran_deuda) WHERE fecha_deuda_construida IS NOT NULL),
fact_universo AS (
  SELECT FECHA_ASIGNACION, CARTERA, SERVICIO, SEGMENTO_GESTION, VENCIMIENTO, CATEGORIA_VENCIMIENTO,
         ID_ARCHIVO_ASIGNACION, ZONA_GEOGRAFICA, TIPO_FRACCIONAMIENTO,
         CAST(SUM(CAST(OBJ_RECUPERO AS DECIMAL(24, 6))) AS DOUBLE) / COUNT(OBJ_RECUPERO) AS OBJ_RECUPERO,
         COUNT(DISTINCT cuenta) AS Q_CUENTAS_ASIGNADAS, COUNT(DISTINCT cliente) AS Q_CLIENTES_ASIGNADOS,
         CAST(SUM(COALESCE(CAST(monto_exigible AS DECIMAL(18, 2)), 0)) AS DOUBLE) AS MONTO_EXIGIBLE_ASIGNADO,
         AVG(DIAS_GESTION) AS DIAS_GESTION_DISPONIBLES
  FROM universo LEFT JOIN deuda ON CAST(cuenta AS VARCHAR) = cod_cuenta AND FECHA_TRANDEUDA = fecha_deuda_construida
  WHERE FECHA_ASIGNACION BETWEEN DATE '2024-01-01' AND DATE '2024-01-31'
  GROUP BY 1, 2, 3, 4, 5, 6, 7, 8, 9),
en_contexto AS (
  SELECT dia AS FECHA_SERVICIO, CARTERA, CANAL, OPERADOR_FINAL, GRUPO_RESPUESTA, NIVEL_1, NIVEL_2, SERVICIO,
         SEGMENTO_GESTION, VENCIMIENTO, CATEGORIA_VENCIMIENTO, ZONA_GEOGRAFICA, cliente, es_contacto_efectivo,
         es_compromiso, monto_compromiso, ID_ARCHIVO_ASIGNACION,
         ROW_NUMBER() OVER (PARTITION BY cliente, dia ORDER BY fecha_gestion, CANAL, OPERADOR_FINAL, GRUPO_RESPUESTA,
                            NIVEL_1, NIVEL_2, cuenta) = 1 AS es_primera
  FROM universo JOIN gestiones USING (cod_luna)
  WHERE dia BETWEEN DATE '2024-01-01' AND DATE '2024-01-31'
    AND dia BETWEEN FECHA_ASIGNACION AND COALESCE(FECHA_CIERRE, DATE '2099-12-31')),
fact_diaria AS (
  SELECT FECHA_SERVICIO, CARTERA, CANAL, OPERADOR_FINAL, GRUPO_RESPUESTA, NIVEL_1, NIVEL_2, SERVICIO, SEGMENTO_GESTION,
         VENCIMIENTO, CATEGORIA_VENCIMIENTO, ZONA_GEOGRAFICA,
         COUNT(*) AS Q_INTERACCIONES_TOTAL, CAST(SUM(es_contacto_efectivo) AS BIGINT) AS Q_CONTACTOS_EFECTIVOS,
         CAST(SUM(es_compromiso) AS BIGINT) AS Q_PROMESAS_DE_PAGO,
         CAST(SUM(CAST(monto_compromiso AS DECIMAL(18, 2))) AS DOUBLE) AS MONTO_COMPROMETIDO,
         COUNT(CASE WHEN es_primera THEN 1 END) AS Q_CLIENTES_UNICOS_CONTACTADOS,
         COUNT(CASE WHEN es_primera THEN 1 END) AS Q_CLIENTES_PRIMERA_VEZ_DIA,
         COUNT(DISTINCT CASE WHEN es_compromiso = 1 THEN cliente END) AS Q_CLIENTES_CON_PROMESA,
         SUM(es_contacto_efectivo)::DOUBLE / COUNT(*) AS EFECTIVIDAD_CONTACTO,
         SUM(es_compromiso)::DOUBLE / COUNT(*) AS TASA_COMPROMISO,
         CAST(SUM(CAST(monto_compromiso AS DECIMAL(18, 2))) AS DOUBLE) / NULLIF(SUM(es_compromiso)::DOUBLE, 0)
              AS MONTO_PROMEDIO_COMPROMISO
  FROM en_contexto GROUP BY 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12),
pagos_id AS (
  SELECT *, ROW_NUMBER() OVER (ORDER BY fecha_pago, nro_documento, cod_sistema) AS pago_id FROM pagos
  WHERE CAST(fecha_pago AS DATE) BETWEEN DATE '2024-01-01' AND DATE '2024-01-31'),
pagos_asignados AS (
  SELECT * FROM (
    SELECT p.pago_id, p.cod_sistema, p.nro_documento, p.monto_cancelado, p.fecha_pago, a.*,
           ROW_NUMBER() OVER (PARTITION BY pago_id ORDER BY FECHA_ASIGNACION DESC, cuenta DESC) AS rn
    FROM pagos_id p JOIN deuda d ON p.nro_documento = d.nro_documento
    JOIN universo a ON CAST(cuenta AS VARCHAR) = cod_cuenta) WHERE rn = 1),
pagos_atribuidos AS (
  SELECT * FROM (
    SELECT p.* EXCLUDE (rn), g.fecha_gestion, g.fecha_compromiso, g.CANAL, g.OPERADOR_FINAL, g.es_compromiso,
           ROW_NUMBER() OVER (PARTITION BY pago_id ORDER BY g.fecha_gestion DESC NULLS LAST, g.CANAL DESC,
                              g.OPERADOR_FINAL DESC) AS rg
    FROM pagos_asignados p LEFT JOIN gestiones g ON p.cod_luna = g.cod_luna AND g.dia <= CAST(p.fecha_pago AS DATE))
  WHERE rg = 1),
fact_recupero AS (
  SELECT dp AS FECHA_PAGO, CARTERA, SERVICIO, VENCIMIENTO, CATEGORIA_VENCIMIENTO, ID_ARCHIVO_ASIGNACION,
         COALESCE(CANAL, 'SIN_GESTION_PREVIA') AS CANAL_ATRIBUIDO,
         COALESCE(OPERADOR_FINAL, 'SIN_GESTION_PREVIA') AS OPERADOR_ATRIBUIDO, dg AS FECHA_GESTION_ATRIBUIDA,
         fecha_compromiso AS FECHA_COMPROMISO, monto_cancelado AS MONTO_PAGADO,
         COALESCE(es_compromiso = 1, FALSE) AS ES_PAGO_CON_PDP,
         COALESCE(es_compromiso = 1 AND dp BETWEEN fecha_compromiso AND fecha_compromiso + 7, FALSE)
              AS PDP_ESTABA_VIGENTE,
         COALESCE(es_compromiso = 1 AND dp = fecha_compromiso, FALSE) AS PAGO_ES_PUNTUAL,
         CAST(dp - dg AS BIGINT) AS DIAS_ENTRE_GESTION_Y_PAGO,
         CAST(CASE WHEN es_compromiso = 1 AND dp = fecha_compromiso THEN 1.0
              WHEN es_compromiso = 1 AND dp <= fecha_compromiso + 3 THEN 0.8
              WHEN es_compromiso = 1 AND dp <= fecha_compromiso + 7 THEN 0.6
              WHEN dp - dg <= 7 THEN 0.4 WHEN dg IS NOT NULL THEN 0.2 ELSE 0.0 END AS DOUBLE) AS EFECTIVIDAD_ATRIBUCION
  FROM (SELECT *, CAST(fecha_pago AS DATE) AS dp, CAST(fecha_gestion AS DATE) AS dg FROM pagos_atribuidos)),
kpi_u AS (
  SELECT CARTERA, SERVICIO, VENCIMIENTO, CATEGORIA_VENCIMIENTO, CAST(SUM(Q_CUENTAS_ASIGNADAS) AS BIGINT) AS cuentas,
         CAST(SUM(CAST(MONTO_EXIGIBLE_ASIGNADO AS DECIMAL(18, 2))) AS DOUBLE) AS monto,
         ROUND(CAST(SUM(CAST(OBJ_RECUPERO AS DECIMAL(28, 15))) AS DOUBLE) / COUNT(OBJ_RECUPERO), 9) AS objetivo
  FROM fact_universo GROUP BY 1, 2, 3, 4),
kpi_g AS (
  SELECT CARTERA, SERVICIO, VENCIMIENTO, CATEGORIA_VENCIMIENTO, CANAL,
         CAST(SUM(Q_CLIENTES_UNICOS_CONTACTADOS) AS BIGINT) AS contactadas,
         ROUND(CAST(SUM(CAST(EFECTIVIDAD_CONTACTO AS DECIMAL(28, 15))) AS DOUBLE) / COUNT(EFECTIVIDAD_CONTACTO), 9)
              AS efectividad,
         CAST(SUM(CAST(MONTO_COMPROMETIDO AS DECIMAL(18, 2))) AS DOUBLE) AS comprometido,
         ROUND(CAST(SUM(CAST(TASA_COMPROMISO AS DECIMAL(28, 15))) AS DOUBLE) / COUNT(TASA_COMPROMISO), 9) AS tasa
  FROM fact_diaria GROUP BY 1, 2, 3, 4, 5),
kpi_r AS (
  SELECT CARTERA, SERVICIO, VENCIMIENTO, CATEGORIA_VENCIMIENTO, CANAL_ATRIBUIDO AS CANAL,
         CAST(SUM(CAST(MONTO_PAGADO AS DECIMAL(18, 2))) AS DOUBLE) AS recuperado
  FROM fact_recupero GROUP BY 1, 2, 3, 4, 5),
kpi_rows AS (
  SELECT CARTERA, SERVICIO, VENCIMIENTO, CATEGORIA_VENCIMIENTO, COALESCE(CANAL, 'TOTAL') AS CANAL,
         COALESCE(cuentas, 0) AS UNIVERSO_CUENTAS, COALESCE(monto, 0) AS UNIVERSO_MONTO,
         COALESCE(objetivo, 0.20::DOUBLE) AS OBJ_RECUPERO_PROMEDIO, COALESCE(contactadas, 0) AS CUENTAS_CONTACTADAS,
         COALESCE(efectividad, 0) AS EFECTIVIDAD_PROMEDIO, COALESCE(comprometido, 0) AS MONTO_COMPROMETIDO,
         COALESCE(tasa, 0) AS TASA_COMPROMISO_PROMEDIO, COALESCE(recuperado, 0) AS MONTO_RECUPERADO
  FROM (kpi_g FULL JOIN kpi_r USING (CARTERA, SERVICIO, VENCIMIENTO, CATEGORIA_VENCIMIENTO, CANAL))
  FULL JOIN kpi_u USING (CARTERA, SERVICIO, VENCIMIENTO, CATEGORIA_VENCIMIENTO)),
fact_kpis AS (
  SELECT DATE '2024-01-01' AS FECHA_CALCULO, *,
         CUENTAS_CONTACTADAS::DOUBLE / NULLIF(UNIVERSO_CUENTAS, 0)::DOUBLE AS TASA_CONTACTABILIDAD,
         MONTO_RECUPERADO / NULLIF(UNIVERSO_MONTO, 0) AS TASA_RECUPERACION,
         MONTO_RECUPERADO / NULLIF(UNIVERSO_MONTO, 0) / NULLIF(OBJ_RECUPERO_PROMEDIO, 0)
              AS CUMPLIMIENTO_OBJETIVO
  FROM kpi_rows WHERE UNIVERSO_CUENTAS > 0 OR CUENTAS_CONTACTADAS > 0 OR MONTO_RECUPERADO > 0),
base_p AS (
  SELECT cod_luna, cuenta, cliente, archivo, negocio AS SERVICIO, min_vto AS VENCIMIENTO, FECHA_ASIGNACION,
         FECHA_CIERRE, FECHA_TRANDEUDA,
         CASE WHEN contains(upper(archivo), 'TEMPRANA') THEN 'TEMPRANA'
              WHEN contains(upper(archivo), 'CF_ANN') OR contains(upper(archivo), 'CUOTA_FIJA') THEN 'CUOTA_FIJA_ANUAL'
              WHEN contains(upper(archivo), '_AN_') OR contains(upper(archivo), 'ALTAS_NUEVAS') THEN 'ALTAS_NUEVAS'
              WHEN contains(upper(archivo), 'COBRANDING') THEN 'COBRANDING' ELSE 'OTRAS' END AS CARTERA,
         COALESCE(NULLIF(COALESCE(tramo_gestion, '')
              || CASE WHEN fraccionamiento = 'SI' THEN ' - FRACCIONADO' ELSE '' END
              || COALESCE(' - CUOTA_' || cuota_fracc_act, ''), ''), 'NO_ESPECIFICADO') AS SEGMENTO,
         CAST(CASE tramo_gestion WHEN 'AL VCTO' THEN 0.15 WHEN 'ENTRE 4 Y 15D' THEN 0.25 WHEN 'TARDIA' THEN 0.30
              ELSE 0.20 END AS DOUBLE) AS OBJ_RECUPERO
  FROM asignacion LEFT JOIN calendario ON archivo = cal_archivo || '.txt'),
gestiones_p AS (
  SELECT TRY_CAST(document AS BIGINT) AS cod_luna, date, management, duracion, 'BOT' AS CANAL,
         'SISTEMA_BOT' AS OPERADOR, COALESCE(management, 'NO_DISPONIBLE') AS GRUPO_RESPUESTA,
         COALESCE(management, 'NO_DISPONIBLE') AS GLOSA_RESPUESTA, COALESCE(management, 'NO_DISPONIBLE') AS NIVEL_1,
         '' AS NIVEL_2, '' AS NIVEL_3, CAST(0 AS DOUBLE) AS monto_compromiso
  FROM gestiones_bot WHERE TRY_CAST(document AS BIGINT) IS NOT NULL
  UNION ALL
  SELECT TRY_CAST(document AS BIGINT), date, management, duracion, 'HUMANO', COALESCE(nombre_agente, 'SIN_AGENTE'),
         COALESCE(management, 'NO_DISPONIBLE'),
         COALESCE(NULLIF(concat_ws(' - ', NULLIF(trim(n1), ''), NULLIF(trim(n2), ''), NULLIF(trim(n3), '')), ''),
                  management, 'NO_DISPONIBLE'),
         COALESCE(n1, ''), COALESCE(n2, ''), COALESCE(n3, ''), COALESCE(monto_compromiso, 0)
  FROM gestiones_humano WHERE TRY_CAST(document AS BIGINT) IS NOT NULL)"""


def enriched_sql(portfolio_column: str = "CARTERA") -> str:
    """CTE `enr`: detailed interactions x assignment rows within the period, with the flags by window minima."""
    return f"""
    enr AS (
      SELECT *, efectivo_cliente AND es_primera_vez_cliente AS es_primer_contacto_efectivo FROM (
        SELECT *,
          date = MIN(date) OVER (PARTITION BY archivo, CANAL, cliente) AS es_primera_vez_cliente,
          date = MIN(date) OVER (PARTITION BY archivo, CANAL, cliente, CARTERA) AS f_cartera,
          date = MIN(date) OVER (PARTITION BY archivo, CANAL, cliente, CARTERA, OPERADOR) AS f_operador,
          date = MIN(date) OVER (PARTITION BY archivo, CANAL, cliente, GRUPO_RESPUESTA) AS f_grupo,
          MAX(efectivo) OVER (PARTITION BY archivo, CANAL, cliente) = 1 AS efectivo_cliente
        FROM (
          SELECT g.*, CAST(date AS DATE) AS FECHA_SERVICIO, b.cuenta, b.cliente, b.archivo,
                 b.{portfolio_column} AS CARTERA, b.VENCIMIENTO, b.FECHA_ASIGNACION, b.FECHA_CIERRE, b.OBJ_RECUPERO,
                 b.SERVICIO,
                 CASE WHEN management IN ('CONTACTO_EFECTIVO', 'Contacto_Efectivo') THEN 1 ELSE 0 END AS efectivo
          FROM gestiones_p g JOIN base_p b USING (cod_luna)
          WHERE CAST(date AS DATE) BETWEEN FECHA_ASIGNACION AND COALESCE(FECHA_CIERRE, DATE '2099-12-31'))))"""


EVENT_CALENDAR = calendar_sql(
    "(SELECT MIN(CAST(ts AS DATE)) FROM events)", "(SELECT MAX(CAST(ts AS DATE)) FROM events)"
)
ORDER_CALENDAR = calendar_sql(
    "(SELECT MIN(CAST(o_orderdate AS DATE)) FROM orders)", "(SELECT MAX(CAST(o_orderdate AS DATE)) FROM orders)"
)
