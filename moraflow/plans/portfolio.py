"""The four detailed outputs: agregada, comparativas, primera_vez, base_cartera."""

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moraflow.functions import rules
from moraflow.operators import calendar as cal
from moraflow.operators import first_contact

ACCOUNT_DIMS = ["CARTERA", "VENCIMIENTO", "OBJ_RECUPERO", "SERVICIO"]
# Grouping dimensions of the detailed aggregate, in output order.
DIMENSIONS = [
    "FECHA_SERVICIO", "CARTERA", "VENCIMIENTO", "FECHA_ASIGNACION", "FECHA_INICIO_GESTION", "FECHA_CIERRE",
    "OBJ_RECUPERO", "GRUPO_RESPUESTA", "GLOSA_RESPUESTA", "CANAL", "OPERADOR", "NIVEL_1", "NIVEL_2", "NIVEL_3",
    "SERVICIO",
]
PORTFOLIO_KEYS = ["CARTERA", "FECHA_ASIGNACION", "SERVICIO"]


def contacts(interactions: DataFrame, base: DataFrame) -> DataFrame:
    """Grouped contacts that agregada and primera_vez share."""
    return first_contact.contacts_in_period(
        first_contact.detailed_responses(interactions), base, ACCOUNT_DIMS
    )


def aggregate_contacts(grouped: DataFrame, calendar: DataFrame, compat: bool = False, by_file: bool = False) -> DataFrame:
    """Contacts by the fifteen dimensions: actions, clients, first contacts, amounts, business day and ratios.

    `compat` counts every row as an amount and drops groups with a null dimension. `by_file` also returns the period's
    file, `archivo`.
    """
    n = F.col("q_cuentas")

    def times(c):
        return F.sum(F.col(c) * n)

    rows = grouped.withColumn("FECHA_INICIO_GESTION", F.col("FECHA_ASIGNACION"))
    if compat:
        rows = rows.dropna(subset=DIMENSIONS)
    # Periods are reported apart even where all fifteen dimensions agree.
    totals = rows.groupBy("archivo", *DIMENSIONS).agg(
        times("q").alias("total_interacciones"),
        F.coalesce(F.sum(F.col("duracion") * n.cast("decimal(10,0)")).cast("decimal(38,6)"), F.lit(0)).alias("duracion"),
        times("q_duracion").alias("q_duracion"),
        F.count_distinct("cliente").alias("clientes_unicos_contactados"),
        times("q_efectivos").alias("contactos_efectivos"),
        times("q_compromisos").alias("compromisos_declarados"),
        F.sum("q_primera_cliente").alias("primera_vez_contactados"),
        F.sum("q_primera_efectiva").alias("primera_vez_efectivos"),
        F.sum("q_primera_cartera").alias("primera_vez_cartera_canal"),
        rules.from_cents(times("centavos")).alias("monto_total_comprometido"),
        times("q" if compat else "q_montos").alias("cantidad_compromisos"),
    )
    days = calendar.select(
        F.col("fecha").alias("_fecha"), F.col("dia_habil_del_mes"), F.col("es_dia_habil")
    )
    total, clients = F.col("total_interacciones"), F.col("clientes_unicos_contactados")
    promises, amount = F.col("cantidad_compromisos"), F.col("monto_total_comprometido")
    return totals.join(days, F.col("FECHA_SERVICIO") == F.col("_fecha"), "left").select(
        *DIMENSIONS,
        *(["archivo"] if by_file else []),
        "total_interacciones",
        F.col("duracion").cast("double").alias("duracion_total_minutos"),
        rules.ratio(F.col("duracion"), F.col("q_duracion")).alias("duracion_promedio_minutos"),
        "clientes_unicos_contactados",
        "contactos_efectivos",
        "compromisos_declarados",
        "primera_vez_contactados",
        "primera_vez_efectivos",
        "primera_vez_cartera_canal",
        "monto_total_comprometido",
        "cantidad_compromisos",
        "dia_habil_del_mes",
        "es_dia_habil",
        rules.ratio_or_zero(F.col("contactos_efectivos"), total).alias("efectividad_canal"),
        rules.ratio_or_zero(promises, total).alias("tasa_compromiso"),
        rules.ratio_or_zero(F.col("primera_vez_contactados"), clients).alias("ratio_primera_vez"),
        rules.ratio_or_zero(total, clients).alias("interacciones_por_cliente"),
        rules.ratio_or_zero(amount, promises).alias("monto_promedio_compromiso"),
        rules.day_text(F.col("FECHA_SERVICIO")).alias("FECHA_FORMATO"),
    )


def comparisons(aggregated: DataFrame, calendar: DataFrame) -> DataFrame:
    """Aggregated rows of business days, with the same business day of the previous month."""
    info = cal.comparison_info(calendar).where("puede_comparar")
    extra = info.select(
        F.col("fecha_objetivo").alias("fecha_actual"),
        F.col("fecha_comparacion_mes_anterior").alias("fecha_comparacion"),
        "puede_comparar",
        F.col("dia_habil_del_mes").alias("dia_habil_numero"),
        "fecha_objetivo",
        "total_dias_habiles_mes_actual",
        "fecha_comparacion_mes_anterior",
        "total_dias_habiles_mes_anterior",
        "progreso_mes_actual",
    )
    return aggregated.join(extra, F.col("FECHA_SERVICIO") == F.col("fecha_actual"))


def first_contacts(
    grouped: DataFrame, calendar: DataFrame, run_at: datetime, dedup: bool = False, by_file: bool = False
) -> DataFrame:
    """Rows on which a client is contacted for the first time in the period and channel.

    One row per interaction and assignment row, ties included; `dedup` keeps distinct rows. `by_file` also returns the
    period's file, `archivo`.
    """
    days = calendar.select(F.col("fecha").alias("_fecha"), "dia_habil_del_mes")
    copies = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("q_primera_cliente")))
    rows = grouped.where("q_primera_cliente > 0").join(days, F.col("FECHA_SERVICIO") == F.col("_fecha"), "left")
    if not dedup:
        rows = rows.withColumn("_copia", copies)
    columns = rows.select(
        "cliente", "FECHA_SERVICIO", "CARTERA", "CANAL", "OPERADOR", "GRUPO_RESPUESTA", "dia_habil_del_mes",
        F.col("tiene_efectivo").alias("es_primer_contacto_efectivo"), *(["archivo"] if by_file else []),
    )
    stamped = columns.distinct() if dedup else columns
    return stamped.withColumn("timestamp_primera_interaccion", F.lit(run_at).cast("timestamp_ntz"))


def portfolio_counts(base: DataFrame) -> DataFrame:
    """Assignment rows, distinct accounts and distinct clients per portfolio."""
    return base.groupBy(*PORTFOLIO_KEYS).agg(
        F.count("cod_luna").alias("total_cod_lunas"),
        F.count_distinct("cuenta").alias("cuentas_unicas"),
        F.count_distinct("cliente").alias("clientes_unicos"),
    )


def base_portfolio(
    base: DataFrame, debt: DataFrame, payments: DataFrame, compat: bool = False, by_file: bool = False
) -> DataFrame:
    """Portfolio size, debt, payments and recovery ratio.

    Debt counts where its date is the debt date of the period; `compat` takes all debt rows of the account, and drops
    portfolios with a null key. `by_file` reports each period's file apart, as runs period by period do.
    """
    if compat:
        owed_keys, base = ["cod_cuenta"], base.dropna(subset=PORTFOLIO_KEYS)
    else:
        owed_keys = ["cod_cuenta", "FECHA_TRANDEUDA"]
        debt = debt.withColumnRenamed("fecha_deuda_construida", "FECHA_TRANDEUDA")
    owed = debt.groupBy(*owed_keys).agg(F.sum(rules.cents(F.col("monto_exigible"))).alias("deuda"))
    paid = payments.groupBy(F.col("cod_sistema").alias("cod_cuenta")).agg(
        F.sum(rules.cents(F.col("monto_cancelado"))).alias("pago")
    )
    # Both sums are one row per account (and date), so the joins keep one row per assignment row.
    rows = (
        base.withColumn("cod_cuenta", F.col("cuenta").cast("string"))
        .join(owed, owed_keys, "left")
        .join(paid, "cod_cuenta", "left")
    )
    totals = rows.groupBy(*PORTFOLIO_KEYS, *(["archivo"] if by_file else [])).agg(
        F.count("cod_luna").alias("total_cod_lunas"),
        F.count_distinct("cuenta").alias("cuentas_unicas"),
        F.count_distinct("cliente").alias("clientes_unicos"),
        rules.from_cents(F.sum("deuda")).alias("monto_exigible"),
        rules.from_cents(F.sum("pago")).alias("monto_cancelado"),
    )
    recovery = rules.ratio_or_zero(F.col("monto_cancelado"), F.col("monto_exigible"))
    return totals.withColumn("ratio_recuperacion", recovery)
