"""Profiling and data-quality checks; each returns a small lazy DataFrame."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moraflow.functions import fixed_values as fv
from moraflow.functions import rules
from moraflow.operators import periods
from moraflow.plans.facts import RunWindow
from moraflow.plans.reports import with_share


def stack(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


# ---- verification summaries of the facts -----------------------------------------------------

def verify_universe(fact: DataFrame, window: RunWindow) -> DataFrame:
    return fact.where(window.covers("FECHA_ASIGNACION")).agg(
        F.count(F.lit(1)).alias("total_registros"),
        F.min("FECHA_ASIGNACION").alias("fecha_min"),
        F.max("FECHA_ASIGNACION").alias("fecha_max"),
        F.count_distinct("CARTERA").alias("carteras_unicas"),
        F.sum("Q_CUENTAS_ASIGNADAS").alias("total_cuentas"),
        rules.money_sum(F.col("MONTO_EXIGIBLE_ASIGNADO")).alias("total_monto"),
    )


def verify_daily(fact: DataFrame, window: RunWindow) -> DataFrame:
    return fact.where(window.covers("FECHA_SERVICIO")).agg(
        F.count(F.lit(1)).alias("total_registros"),
        F.min("FECHA_SERVICIO").alias("fecha_min"),
        F.max("FECHA_SERVICIO").alias("fecha_max"),
        F.count_distinct("CANAL").alias("canales_unicos"),
        F.sum("Q_INTERACCIONES_TOTAL").alias("total_interacciones"),
        F.sum("Q_CLIENTES_UNICOS_CONTACTADOS").alias("total_clientes_contactados"),
    )


def verify_recovery(fact: DataFrame, window: RunWindow) -> DataFrame:
    return fact.where(window.covers("FECHA_PAGO")).agg(
        F.count(F.lit(1)).alias("total_registros"),
        F.min("FECHA_PAGO").alias("fecha_min"),
        F.max("FECHA_PAGO").alias("fecha_max"),
        rules.money_sum(F.col("MONTO_PAGADO")).alias("total_recuperado"),
        F.count_if("ES_PAGO_CON_PDP").alias("pagos_con_pdp"),
        rules.mean_of(F.col("EFECTIVIDAD_ATRIBUCION")).alias("efectividad_promedio"),
    )


def verify_kpis(fact: DataFrame, window: RunWindow) -> DataFrame:
    return fact.where(window.covers("FECHA_CALCULO")).agg(
        F.count(F.lit(1)).alias("total_registros"),
        F.count_distinct("CARTERA").alias("carteras"),
        F.count_distinct("CANAL").alias("canales"),
        rules.mean_of(F.col("TASA_CONTACTABILIDAD")).alias("contactabilidad_promedio"),
        rules.mean_of(F.col("TASA_RECUPERACION")).alias("recuperacion_promedio"),
        rules.mean_of(F.col("CUMPLIMIENTO_OBJETIVO")).alias("cumplimiento_promedio"),
    )


# ---- profiling -------------------------------------------------------------------------------

def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table, plain and with thousands separators."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("registros")).select(F.lit(name).alias("tabla"), "registros")
        for name, df in tables.items()
    ]
    text = F.format_number("registros", 0).alias("registros_formateados")
    return stack(counts).select("tabla", text, "registros").orderBy(F.desc("registros"), "tabla")


def date_ranges(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """First and last day, distinct days and span of each table's day column."""
    rows = [
        df.agg(
            F.min(day).alias("fecha_min"), F.max(day).alias("fecha_max"), F.count_distinct(day).alias("dias_distintos")
        ).withColumns({"tabla": F.lit(name), "campo_fecha": F.lit(day)})
        for name, (df, day) in tables.items()
    ]
    span = F.datediff("fecha_max", "fecha_min").cast("bigint").alias("dias_total_periodo")
    return stack(rows).select("tabla", "campo_fecha", "fecha_min", "fecha_max", "dias_distintos", span).orderBy(
        "fecha_min", "tabla"
    )


def due_coverage(sources: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Share of rows with a due date, its distinct values and its range, per source."""
    rows = [
        df.agg(
            F.count(F.lit(1)).alias("total_registros"),
            F.count(due).alias("con_vencimiento"),
            F.count_distinct(due).alias("vencimientos_distintos"),
            F.min(due).alias("vencimiento_min"),
            F.max(due).alias("vencimiento_max"),
        ).withColumn("fuente", F.lit(name))
        for name, (df, due) in sources.items()
    ]
    percent = F.round(F.try_divide(F.col("con_vencimiento") * 100.0, F.col("total_registros").cast("double")), 2)
    return stack(rows).select(
        "fuente", "total_registros", "con_vencimiento", percent.alias("pct_con_vencimiento"), "vencimientos_distintos",
        "vencimiento_min", "vencimiento_max",
    )


def migrated_coverage(facts: dict[str, DataFrame]) -> DataFrame:
    """Share of fact rows with a due category and a due date."""
    rows = [
        df.agg(
            F.count(F.lit(1)).alias("registros_nuevos"),
            F.count_if(F.col("CATEGORIA_VENCIMIENTO") != fv.DUE_NONE).alias("con_vencimiento_calculado"),
            F.count_if(F.col("VENCIMIENTO") != F.lit(fv.MISSING_DUE_DATE)).alias("con_fecha_vencimiento"),
        ).withColumn("tabla", F.lit(name))
        for name, df in facts.items()
    ]
    part, whole = F.col("con_vencimiento_calculado") * 100.0, F.col("registros_nuevos").cast("double")
    return stack(rows).withColumn("pct_vencimiento_calculado", F.round(F.try_divide(part, whole), 2))


def due_distribution(universe_fact: DataFrame, window: RunWindow) -> DataFrame:
    """Universe rows, accounts and amount per due category, largest amount first."""
    return universe_fact.where(window.covers("FECHA_ASIGNACION")).groupBy("CATEGORIA_VENCIMIENTO").agg(
        F.count(F.lit(1)).alias("registros"),
        F.sum("Q_CUENTAS_ASIGNADAS").alias("total_cuentas"),
        rules.money_sum(F.col("MONTO_EXIGIBLE_ASIGNADO")).alias("total_monto"),
    ).orderBy(F.desc("total_monto"), "CATEGORIA_VENCIMIENTO")


def simulated_due_distribution(asignacion: DataFrame, as_of) -> DataFrame:
    """Due categories the assignment would get, with the number of due dates and the share of accounts."""
    by_date = asignacion.groupBy("min_vto").agg(F.count(F.lit(1)).alias("cantidad"))
    grouped = by_date.groupBy(
        rules.due_category(F.col("min_vto"), F.lit(as_of)).alias("categoria_vencimiento")
    ).agg(F.count(F.lit(1)).alias("grupos_vencimiento"), F.sum("cantidad").alias("total_cuentas"))
    return with_share(grouped, "total_cuentas", "porcentaje").orderBy(F.desc("total_cuentas"), "categoria_vencimiento")


def tables_by_category(universe_fact: DataFrame, table_names: list[str]) -> DataFrame:
    """Every table name with every due category present."""
    names = F.explode(F.array(*[F.lit(n) for n in table_names])).alias("table_name")
    present = universe_fact.select("CATEGORIA_VENCIMIENTO").distinct()
    return present.select(names, "CATEGORIA_VENCIMIENTO").withColumn("registros", F.lit(1).cast("bigint"))


# ---- integrity checks ------------------------------------------------------------------------

def integrity_checks(asignacion: DataFrame, calendario: DataFrame, bot: DataFrame, human: DataFrame) -> DataFrame:
    """Counts of assignment rows with a period, interacted clients without assignment, and interactions outside their
    period, labelled by size."""
    gestiones = bot.select("document", "date").unionByName(human.select("document", "date"))
    numbered = gestiones.select(
        rules.safe_long(F.col("document")).alias("cod_luna"), F.to_date("date").alias("FECHA_SERVICIO")
    ).where("cod_luna IS NOT NULL")
    placed = periods.with_period(asignacion, periods.period_columns(calendario))
    matched = placed.agg(F.count(F.lit(1)).alias("casos"))
    unassigned = periods.clients_without_assignment(numbered, asignacion).agg(F.count(F.lit(1)).alias("casos"))
    per_day = numbered.groupBy("cod_luna", "FECHA_SERVICIO").agg(F.count(F.lit(1)).alias("q"))
    held = placed.groupBy("cod_luna", "FECHA_ASIGNACION", "FECHA_CIERRE").agg(F.count(F.lit(1)).alias("q_cuentas"))
    outside = periods.outside_period_count(per_day, held)
    checks = [
        df.select(F.lit(label).alias("validacion"), F.col("casos").alias("casos_encontrados"))
        for label, df in (
            (fv.CHECK_PERIODS, matched), (fv.CHECK_UNASSIGNED, unassigned), (fv.CHECK_OUTSIDE, outside)
        )
    ]
    return stack(checks).withColumn("estado", rules.check_label(F.col("casos_encontrados")))


def null_shares(df: DataFrame, columns: list[str]) -> DataFrame:
    """Percent of nulls per column, in one pass; flagged above 50."""
    shares = df.agg(
        *[
            F.round(F.try_divide(F.count_if(F.col(c).isNull()) * 100.0, F.count(F.lit(1))), 1).alias(c)
            for c in columns
        ]
    )
    pairs = F.array(
        *[F.struct(F.lit(c).alias("columna"), F.col(c).cast("double").alias("pct_nulos")) for c in columns]
    )
    flag = F.coalesce(F.col("pct_nulos") > 50, F.lit(False)).alias("excede")
    return shares.select(F.inline(pairs)).select("columna", "pct_nulos", flag)


def duplicate_rows(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows beyond the first of each key, as one row."""
    return df.groupBy(*keys).agg((F.count(F.lit(1)) - 1).alias("extra")).agg(
        F.coalesce(F.sum("extra"), F.lit(0)).alias("filas_duplicadas")
    )


def quality_report(outputs: dict[str, DataFrame]) -> DataFrame:
    """PASS, WARNING or EMPTY per output table, with the issues found."""
    reports = []
    for name, df in outputs.items():
        missing = [c for c in fv.REQUIRED_COLUMNS.get(name, []) if c not in df.columns]
        checked = [c for c in fv.NULL_CHECKED_COLUMNS.get(name, []) if c in df.columns]
        keys = [c for c in fv.DUPLICATE_KEYS if c in df.columns] if name == "agregada" else []
        grouped = df.groupBy(*keys) if keys else df
        # One pass; with keys, duplicates are counted from per-key counts of the same aggregation.
        counts = [F.count(F.lit(1)).alias("n"), *[F.count_if(F.col(c).isNull()).alias(f"nulos_{c}") for c in checked]]
        partial = grouped.agg(*counts)
        totals = partial.agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
            (F.sum(F.col("n") - 1) if keys else F.lit(0).cast("bigint")).alias("duplicadas"),
            *[F.sum(f"nulos_{c}").alias(f"nulos_{c}") for c in checked],
        )
        rows = F.col("row_count")
        issues = [F.lit(f"Columnas faltantes: {missing}") if missing else F.lit(None).cast("string")]
        for c in checked:
            percent = F.try_divide(F.col(f"nulos_{c}") * 100.0, rows.cast("double"))
            text = F.format_string(f"Columna {c}: %.1f%% valores nulos", percent)
            issues.append(F.when(percent > 50, text))
        repeated = F.concat(F.col("duplicadas").cast("string"), F.lit(" filas duplicadas en dims clave"))
        issues.append(F.when(F.col("duplicadas") > 0, repeated))
        found = F.array_compact(F.array(*issues))
        status = F.when(rows == 0, "EMPTY").when(F.size(found) == 0, "PASS").otherwise("WARNING")
        reports.append(
            totals.select(
                F.lit(name).alias("table_name"),
                "row_count",
                F.lit(len(df.columns)).alias("column_count"),
                F.when(rows == 0, F.array().cast("array<string>")).otherwise(found).alias("issues"),
                status.alias("status"),
            )
        )
    return stack(reports)


def calendar_checks(calendar: DataFrame) -> DataFrame:
    """Sanity of a calendar: no Sunday is a business day, numbers and comparison dates exist exactly on business days."""
    is_bd, number = F.col("es_dia_habil"), F.col("dia_habil_del_mes")
    return calendar.agg(
        (~F.bool_or(is_bd & (F.col("dia_semana") == 7))).alias("domingo_no_es_habil"),
        F.bool_and(is_bd == (number > 0)).alias("numero_solo_en_habiles"),
        F.bool_and(is_bd == F.col("fecha_mismo_dia_habil_mes_anterior").isNotNull()).alias("comparacion_en_habiles"),
        F.bool_or(is_bd).alias("hay_dias_habiles"),
    )
