"""Dashboard reports and views over the facts."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from moraflow.functions import fixed_values as fv
from moraflow.functions import rules
from moraflow.operators import periods
from moraflow.plans.facts import RunWindow
from moraflow.sources import scans


def _mean(c: str):
    return rules.mean_of(F.col(c))


def kpi_list(kpis: DataFrame, window: RunWindow) -> DataFrame:
    return kpis.where(window.covers("FECHA_CALCULO")).select(
        "CARTERA", "CANAL", "UNIVERSO_CUENTAS", "CUENTAS_CONTACTADAS", "TASA_CONTACTABILIDAD", "EFECTIVIDAD_PROMEDIO",
        "MONTO_RECUPERADO", "TASA_RECUPERACION", "CUMPLIMIENTO_OBJETIVO",
    ).orderBy("CARTERA", "CANAL")


def daily_evolution(daily: DataFrame, window: RunWindow) -> DataFrame:
    return daily.where(window.covers("FECHA_SERVICIO")).groupBy("FECHA_SERVICIO", "CARTERA", "CANAL").agg(
        F.sum("Q_INTERACCIONES_TOTAL").alias("TOTAL_INTERACCIONES"),
        F.sum("Q_CLIENTES_UNICOS_CONTACTADOS").alias("CLIENTES_CONTACTADOS"),
        _mean("EFECTIVIDAD_CONTACTO").alias("EFECTIVIDAD_PROMEDIO"),
        rules.money_sum(F.col("MONTO_COMPROMETIDO")).alias("MONTO_COMPROMETIDO"),
    ).orderBy("FECHA_SERVICIO", "CARTERA", "CANAL")


def recovery_attribution(recovery: DataFrame, window: RunWindow) -> DataFrame:
    return recovery.where(window.covers("FECHA_PAGO")).groupBy("CARTERA", "CANAL_ATRIBUIDO").agg(
        F.count(F.lit(1)).alias("CANTIDAD_PAGOS"),
        rules.money_sum(F.col("MONTO_PAGADO")).alias("MONTO_TOTAL_RECUPERADO"),
        F.count_if("ES_PAGO_CON_PDP").alias("PAGOS_CON_PDP"),
        F.count_if("PDP_ESTABA_VIGENTE").alias("PAGOS_PDP_VIGENTE"),
        _mean("EFECTIVIDAD_ATRIBUCION").alias("EFECTIVIDAD_ATRIBUCION_PROMEDIO"),
    ).orderBy(F.desc("CANTIDAD_PAGOS"), "CARTERA", "CANAL_ATRIBUIDO")


def operator_activity(daily: DataFrame, window: RunWindow, at_least: int = 100) -> DataFrame:
    """Human operators with at least so many interactions."""
    rows = daily.where(window.covers("FECHA_SERVICIO") & (F.col("OPERADOR_FINAL") != fv.BOT_OPERATOR))
    return rows.groupBy("OPERADOR_FINAL", "CANAL").agg(
        F.sum("Q_INTERACCIONES_TOTAL").alias("TOTAL_INTERACCIONES"),
        F.sum("Q_CONTACTOS_EFECTIVOS").alias("CONTACTOS_EFECTIVOS"),
        _mean("EFECTIVIDAD_CONTACTO").alias("EFECTIVIDAD_PROMEDIO"),
        F.sum("Q_PROMESAS_DE_PAGO").alias("PROMESAS_TOTALES"),
        rules.money_sum(F.col("MONTO_COMPROMETIDO")).alias("MONTO_COMPROMETIDO"),
    ).where(F.col("TOTAL_INTERACCIONES") >= at_least)


def top_operators(daily: DataFrame, window: RunWindow, k: int = 20, at_least: int = 100) -> DataFrame:
    """The k operators with the best average effectiveness; ties by name, so the cut is deterministic."""
    return operator_activity(daily, window, at_least).orderBy(
        F.desc("EFECTIVIDAD_PROMEDIO"), "OPERADOR_FINAL", "CANAL"
    ).limit(k)


def executive_summary(kpis: DataFrame, business_days: DataFrame) -> DataFrame:
    """KPIs with their objective status and business-day position."""
    days = business_days.select(
        F.col("FECHA").alias("_fecha"), "DIA_HABIL_DEL_MES", "FECHA_MISMO_DIA_HABIL_MES_ANTERIOR"
    )
    return kpis.join(days, F.col("FECHA_CALCULO") == F.col("_fecha"), "left").select(
        "FECHA_CALCULO", "CARTERA", "SERVICIO", "CANAL", "UNIVERSO_CUENTAS", "UNIVERSO_MONTO", "CUENTAS_CONTACTADAS",
        "TASA_CONTACTABILIDAD", "MONTO_COMPROMETIDO", "MONTO_RECUPERADO", "TASA_RECUPERACION",
        "CUMPLIMIENTO_OBJETIVO",
        rules.objective_status(F.col("CUMPLIMIENTO_OBJETIVO")).alias("STATUS_OBJETIVO"),
        "DIA_HABIL_DEL_MES", "FECHA_MISMO_DIA_HABIL_MES_ANTERIOR",
    )


def operating_detail(daily: DataFrame, business_days: DataFrame) -> DataFrame:
    """Daily management with productivity and business-day number."""
    days = business_days.select(F.col("FECHA").alias("_fecha"), "DIA_HABIL_DEL_MES")
    return daily.join(days, F.col("FECHA_SERVICIO") == F.col("_fecha"), "left").select(
        "FECHA_SERVICIO", "CARTERA", "CANAL", "OPERADOR_FINAL", "GRUPO_RESPUESTA", "Q_INTERACCIONES_TOTAL",
        "Q_CONTACTOS_EFECTIVOS", "Q_CLIENTES_UNICOS_CONTACTADOS", "EFECTIVIDAD_CONTACTO", "Q_PROMESAS_DE_PAGO",
        "MONTO_COMPROMETIDO", "TASA_COMPROMISO",
        rules.ratio(F.col("Q_INTERACCIONES_TOTAL"), F.lit(8)).alias("INTERACCIONES_POR_HORA"),
        rules.ratio(F.col("MONTO_COMPROMETIDO"), F.col("Q_PROMESAS_DE_PAGO")).alias("MONTO_PROMEDIO_POR_PROMESA"),
        "DIA_HABIL_DEL_MES",
    )


def due_analysis(kpis: DataFrame) -> DataFrame:
    """KPI totals per due date, with ratios of the sums."""
    keys = ["FECHA_CALCULO", "CATEGORIA_VENCIMIENTO", "VENCIMIENTO", "CARTERA", "SERVICIO", "CANAL"]
    totals = kpis.groupBy(*keys).agg(
        F.sum("UNIVERSO_CUENTAS").alias("TOTAL_CUENTAS"),
        rules.money_sum(F.col("UNIVERSO_MONTO")).alias("TOTAL_MONTO"),
        _mean("OBJ_RECUPERO_PROMEDIO").alias("OBJETIVO_PROMEDIO"),
        F.sum("CUENTAS_CONTACTADAS").alias("TOTAL_CONTACTADAS"),
        rules.money_sum(F.col("MONTO_COMPROMETIDO")).alias("TOTAL_COMPROMETIDO"),
        rules.money_sum(F.col("MONTO_RECUPERADO")).alias("TOTAL_RECUPERADO"),
    )
    recovered, owed = F.col("TOTAL_RECUPERADO"), F.col("TOTAL_MONTO")
    return totals.withColumns(
        {
            "TASA_CONTACTABILIDAD_CONSOLIDADA": rules.ratio(F.col("TOTAL_CONTACTADAS"), F.col("TOTAL_CUENTAS")),
            "TASA_RECUPERACION_CONSOLIDADA": rules.ratio(recovered, owed),
            "CUMPLIMIENTO_OBJETIVO_CONSOLIDADO": rules.ratio(
                F.try_divide(recovered, owed), F.col("OBJETIVO_PROMEDIO")
            ),
        }
    )


def due_trends(analysis: DataFrame) -> DataFrame:
    """Each period against the one before it, per category, portfolio, service and channel.

    Rows of one calculation date are ordered by due date, so the previous row is well defined.
    """
    series = W.partitionBy("CATEGORIA_VENCIMIENTO", "CARTERA", "SERVICIO", "CANAL").orderBy(
        "FECHA_CALCULO", "VENCIMIENTO"
    )
    before = analysis.withColumns(
        {
            "CUENTAS_PERIODO_ANTERIOR": F.lag("TOTAL_CUENTAS").over(series),
            "RECUPERADO_PERIODO_ANTERIOR": F.lag("TOTAL_RECUPERADO").over(series),
            "TASA_RECUPERACION_ANTERIOR": F.lag("TASA_RECUPERACION_CONSOLIDADA").over(series),
        }
    )

    def change(now, then):
        return rules.ratio(F.col(now) - F.col(then), F.col(then))

    points = F.col("TASA_RECUPERACION_CONSOLIDADA") - F.col("TASA_RECUPERACION_ANTERIOR")
    return before.withColumns(
        {
            "VAR_CUENTAS_PCT": change("TOTAL_CUENTAS", "CUENTAS_PERIODO_ANTERIOR"),
            "VAR_RECUPERADO_PCT": change("TOTAL_RECUPERADO", "RECUPERADO_PERIODO_ANTERIOR"),
            "VAR_TASA_RECUPERACION_PP": points,
        }
    )


def global_ratios(daily: DataFrame, kpis: DataFrame) -> DataFrame:
    """Overall effectiveness and operator productivity from management, recovery return from the KPIs; one row."""
    management = daily.agg(
        rules.ratio(F.sum("Q_CONTACTOS_EFECTIVOS"), F.sum("Q_INTERACCIONES_TOTAL")).alias("EFECTIVIDAD_GLOBAL"),
        rules.ratio(F.sum("Q_INTERACCIONES_TOTAL"), F.count_distinct("OPERADOR_FINAL")).alias(
            "PRODUCTIVIDAD_OPERADOR"
        ),
    )
    roi = kpis.agg(
        rules.ratio(
            rules.money_sum(F.col("MONTO_RECUPERADO")), rules.money_sum(F.col("MONTO_COMPROMETIDO"))
        ).alias("roi")
    )
    return management.select("EFECTIVIDAD_GLOBAL", roi.scalar().alias("ROI_GESTION"), "PRODUCTIVIDAD_OPERADOR")


def funnel(universe: DataFrame, harmonised: DataFrame, credited: DataFrame, window: RunWindow) -> DataFrame:
    """Distinct clients assigned, contacted, with a promise, and paid, per portfolio.

    `credited` holds the payments with the client (cod_luna) and portfolio of their assignment.
    """
    in_window = harmonised.where(rules.within_days(F.col("fecha_gestion"), window.first, window.last))
    contacts = in_window.groupBy("cod_luna", F.to_date("fecha_gestion").alias("FECHA_SERVICIO")).agg(
        F.max("es_compromiso").alias("es_compromiso")
    )
    held = universe.select("cod_luna", "CARTERA", "FECHA_ASIGNACION", "FECHA_CIERRE").distinct()
    stage = ["ASIGNADOS", "CONTACTADOS", "CON_PROMESA", "CON_PAGO"]
    no, yes = F.lit(0), F.lit(1)
    assigned = held.select("CARTERA", "cod_luna", yes, no, no, no)
    contacted = periods.match_periods(contacts, held).select("CARTERA", "cod_luna", no, yes, "es_compromiso", no)
    paid = credited.select("CARTERA", "cod_luna", no, no, no, yes)
    steps = [df.toDF("CARTERA", "cod_luna", *stage) for df in (assigned, contacted, paid)]
    clients = steps[0].union(steps[1]).union(steps[2]).groupBy("CARTERA", "cod_luna").agg(
        *[F.max(s).alias(s) for s in stage]
    )
    return clients.groupBy("CARTERA").agg(*[F.sum(s).cast("bigint").alias(s) for s in stage])


def by_weekday(daily: DataFrame) -> DataFrame:
    """Management per weekday (1 = Monday) and channel."""
    return daily.groupBy((F.weekday("FECHA_SERVICIO") + 1).alias("dia_semana"), "CANAL").agg(
        F.sum("Q_INTERACCIONES_TOTAL").alias("TOTAL_INTERACCIONES"),
        F.sum("Q_CONTACTOS_EFECTIVOS").alias("CONTACTOS_EFECTIVOS"),
        rules.ratio(F.sum("Q_CONTACTOS_EFECTIVOS"), F.sum("Q_INTERACCIONES_TOTAL")).alias("EFECTIVIDAD"),
    )


def with_share(grouped: DataFrame, count: str, share: str) -> DataFrame:
    """Percent of the total per group. The total is a scalar subquery over the groups, not a one-task window."""
    total = grouped.agg(F.sum(count)).scalar()
    return grouped.withColumn(share, F.round(F.try_divide(F.col(count) * 100.0, total.cast("double")), 2))


def shares(df: DataFrame, column: str) -> DataFrame:
    """Rows and percent per value of a column."""
    counted = df.groupBy(F.col(column).alias("valor")).agg(F.count(F.lit(1)).alias("cantidad"))
    return with_share(counted, "cantidad", "porcentaje").select(
        F.lit(column).alias("dimension"), "valor", "cantidad", "porcentaje"
    )


def month_summary(calendario: DataFrame, asignacion: DataFrame) -> DataFrame:
    """Size of the month's assignment: files, rows, distinct accounts and phones, first and last day; one row."""
    period = calendario.agg(
        F.count_distinct("ARCHIVO").alias("archivos"),
        F.min("FECHA_ASIGNACION").alias("fecha_inicio"),
        F.max("FECHA_CIERRE").alias("fecha_fin"),
        F.max("DIAS_GESTION").alias("dias_gestion"),
    )
    rows = scans.assignment_of_files(asignacion, scans.period_files(calendario)).agg(
        F.count(F.lit(1)).alias("total_cuentas"),
        F.count_distinct("cuenta").alias("cuentas_unicas"),
        F.count_distinct("telefono").alias("telefonos_unicos"),
    )
    fields = ["archivos", "fecha_inicio", "fecha_fin", "dias_gestion"]
    whole = period.select(F.struct(*fields)).scalar()
    return rows.withColumn("p", whole).select("p.*", "total_cuentas", "cuentas_unicas", "telefonos_unicos")


def register_views(spark: SparkSession, kpis: DataFrame, daily: DataFrame, business_days: DataFrame) -> None:
    """Dashboard views over the facts; a filter on a view reaches the partitions of the fact."""
    analysis = due_analysis(kpis)
    views = {
        "resumen_ejecutivo": executive_summary(kpis, business_days),
        "operativo_detalle": operating_detail(daily, business_days),
        "vencimiento_analysis": analysis,
        "vencimiento_trends": due_trends(analysis),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(name)
