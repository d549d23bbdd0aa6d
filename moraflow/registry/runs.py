"""Registered queries: writing, replacing and previewing the outputs."""

from datetime import date, datetime

from pyspark.sql import functions as F

from moraflow.plans import ledger, month_run, reports
from moraflow.registry.core import WINDOW, enriched_sql, query
from moraflow.registry.detailed import _agregada, agregada_sql
from moraflow.operators import calendar as cal
from moraflow.schemas import OUTPUTS, conform
from moraflow.session import shared_folder
from moraflow.sources import scans, sinks


@query("a9_roundtrip", "SELECT * FROM fact_diaria")
def a9(t):
    """The daily fact written in day partitions and read back."""
    path = shared_folder(t.spark, "a9")
    sinks.append(conform(t.daily, OUTPUTS["gestion_agregada"]), "gestion_agregada", path)
    return t.spark.read.schema(OUTPUTS["gestion_agregada"]).parquet(path).select(*t.daily.columns)


@query("a10_overwrite", """
SELECT FECHA_SERVICIO, COUNT(*) AS filas FROM fact_diaria WHERE NOT FECHA_SERVICIO BETWEEN DATE '2024-01-10'
  AND DATE '2024-01-12' OR CANAL = 'BOT' GROUP BY 1""")
def a10(t):
    """A month written, then three of its days replaced by a rerun that has only one channel."""
    path = shared_folder(t.spark, "a10")
    first, last = date(2024, 1, 10), date(2024, 1, 12)
    sinks.replace_range(t.daily, "gestion_agregada", path, WINDOW.first, WINDOW.last)
    rerun = t.daily.where(F.col("FECHA_SERVICIO").between(F.lit(first), F.lit(last)) & (F.col("CANAL") == "BOT"))
    sinks.replace_range(rerun, "gestion_agregada", path, first, last)
    stored = t.spark.read.schema(OUTPUTS["gestion_agregada"]).parquet(path)
    return stored.groupBy("FECHA_SERVICIO").agg(F.count(F.lit(1)).alias("filas"))


@query("a11_contract", "SELECT * FROM fact_recupero")
def a11(t):
    """Recovery rows through the typed contract: a null in a NOT NULL column would fail the job."""
    return conform(t.recovery, OUTPUTS["recupero_atribuido"])


@query("a12_backup", "SELECT CARTERA, COUNT(*) AS filas FROM fact_universo GROUP BY 1")
def a12(t):
    path = shared_folder(t.spark, "a12")
    sinks.append(conform(t.universe_fact, OUTPUTS["asignacion_universo"]), "asignacion_universo", path)
    copy = sinks.backup(t.spark, "asignacion_universo", path, "20240131_000000")
    return t.spark.read.parquet(copy).groupBy("CARTERA").agg(F.count(F.lit(1)).alias("filas"))


@query("a13_statistics", """
SELECT 'orders' AS tabla, COUNT(*) AS num_rows, TRUE AS con_fecha FROM orders
UNION ALL SELECT 'events', COUNT(*), TRUE FROM events""")
def a13(t):
    """Rows and file metadata of the stored tables; sizes and times differ by storage, so they are left out here."""
    stats = sinks.statistics(t.spark, {n: f"{t.path}/{n}.parquet" for n in ("orders", "events")})
    return stats.select("tabla", "num_rows", F.col("last_modified").isNotNull().alias("con_fecha"))


@query("a14_views", """
SELECT CARTERA, CANAL, COUNT(*) AS filas FROM (
  SELECT DISTINCT FECHA_CALCULO, VENCIMIENTO, CARTERA, SERVICIO, CANAL FROM fact_kpis
  WHERE CATEGORIA_VENCIMIENTO = 'VENCIDO') GROUP BY 1, 2""")
def a14(t):
    days = cal.stored_calendar(t.span_of("events", "ts"))
    reports.register_views(t.spark, t.kpis, t.daily, days)
    return t.spark.sql(
        "SELECT CARTERA, CANAL, COUNT(*) AS filas FROM vencimiento_analysis WHERE CATEGORIA_VENCIMIENTO = 'VENCIDO' "
        "GROUP BY CARTERA, CANAL"
    )


@query("a15_by_period", f""", {enriched_sql()}
SELECT archivo, CANAL, COUNT(*) AS interacciones FROM enr GROUP BY 1, 2""")
def a15(t):
    """All periods in one plan, the file as a column."""
    return t.contacts.groupBy("archivo", "CANAL").agg(F.sum(F.col("q") * F.col("q_cuentas")).alias("interacciones"))


@query("a16_dry_run", agregada_sql() + """
SELECT 'agregada' AS tabla, COUNT(*) AS filas FROM agregada
UNION ALL SELECT 'asignacion_universo', COUNT(*) FROM fact_universo
UNION ALL SELECT 'gestion_agregada', COUNT(*) FROM fact_diaria
UNION ALL SELECT 'recupero_atribuido', COUNT(*) FROM fact_recupero""")
def a16(t):
    return sinks.dry_run(
        {
            "agregada": _agregada(t), "asignacion_universo": t.universe_fact, "gestion_agregada": t.daily,
            "recupero_atribuido": t.recovery,
        }
    )


def sources(t) -> month_run.Sources:
    """The driver tables as the inputs of a run."""
    return month_run.Sources(
        t.calendario(), t.asignacion(), t.gestiones_bot(), t.gestiones_humano(), t.tran_deuda(), t.pagos(),
        t.homolog_bot(), t.homolog_humano(), t.homolog_usuarios(),
    )


@query("a15_month_run", """
SELECT CARTERA, SERVICIO, VENCIMIENTO, CANAL, UNIVERSO_CUENTAS, CUENTAS_CONTACTADAS, MONTO_RECUPERADO FROM fact_kpis""")
def a15_month(t):
    """A whole run: the three facts written, the KPIs computed from the written tables and read back."""
    folder = shared_folder(t.spark, "run")
    month_run.run_facts(t.spark, sources(t), WINDOW, folder, first_valid_day=WINDOW.first)
    kpis = t.spark.read.schema(OUTPUTS["kpis_ejecutivos"]).parquet(f"{folder}/kpis_ejecutivos")
    return kpis.select(
        "CARTERA", "SERVICIO", "VENCIMIENTO", "CANAL", "UNIVERSO_CUENTAS", "CUENTAS_CONTACTADAS", "MONTO_RECUPERADO"
    )


@query("a15_detailed_month", agregada_sql() + """
SELECT CARTERA, CANAL, FECHA_SERVICIO, COUNT(*) AS filas, CAST(SUM(total_interacciones) AS BIGINT) AS interacciones
FROM agregada WHERE FECHA_CIERRE IS NOT NULL GROUP BY 1, 2, 3""")
def a15_detailed(t):
    """The detailed outputs for the closed periods of the month."""
    outputs = month_run.build_detailed(
        t.spark, sources(t), WINDOW.first, "finalizado", datetime(2024, 1, 31), date(2024, 2, 29)
    )
    return outputs["agregada"].groupBy("CARTERA", "CANAL", "FECHA_SERVICIO").agg(
        F.count(F.lit(1)).alias("filas"), F.sum("total_interacciones").alias("interacciones")
    )


DETAILED_TOTALS = """
SELECT CARTERA, CANAL, FECHA_SERVICIO, COUNT(*) AS filas, CAST(SUM(total_interacciones) AS BIGINT) AS interacciones
FROM agregada GROUP BY 1, 2, 3"""


def _commit(t, calendario, state, folder, run):
    """A run of the aggregate over the periods in a state. Returns the table's schema."""
    src = sources(t)
    src.calendario = calendario
    outputs = month_run.build_detailed(
        t.spark, src, WINDOW.first, state, datetime(2024, 1, 31), date(2024, 2, 29), by_file=True
    )
    periods = scans.periods_of_month(calendario, WINDOW.first, state)
    ledger.commit_run({"agregada": outputs["agregada"]}, periods, folder, run)
    return outputs["agregada"].schema


def _stored_totals(t, folder, schema):
    return ledger.read(t.spark, folder, "agregada", schema).groupBy("CARTERA", "CANAL", "FECHA_SERVICIO").agg(
        F.count(F.lit(1)).alias("filas"), F.sum("total_interacciones").alias("interacciones")
    )


@query("a15_rerun_periods", agregada_sql() + DETAILED_TOTALS)
def a15_rerun(t):
    """Closed periods written, then the open ones, whose days overlap, then the closed ones again; all rows stay."""
    folder = shared_folder(t.spark, "detailed")
    for k, state in enumerate(("finalizado", "abierto", "finalizado")):
        schema = _commit(t, t.calendario(), state, folder, f"run{k}")
    return _stored_totals(t, folder, schema)


@query("a15_state_change", agregada_sql() + DETAILED_TOTALS)
def a15_state(t):
    """The closed and the open periods, then all periods closed: every period has its rows once."""
    folder = shared_folder(t.spark, "detailed")
    for state in ("finalizado", "abierto"):
        _commit(t, t.calendario(), state, folder, f"run-{state}")
    closed = t.calendario().withColumn("ESTADO", F.lit("FINALIZADO"))
    return _stored_totals(t, folder, _commit(t, closed, "finalizado", folder, "run-all-closed"))
