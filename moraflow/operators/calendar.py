"""Business-day calendar: one row per day, joined to facts on their date.

The calendar is generated from a date range, at most 366 rows a year, which bounds every broadcast of it.
"""

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from moraflow.functions import dates
from moraflow.functions import fixed_values as fv


def date_range(spark: SparkSession, first: date, last: date) -> DataFrame:
    """One-row range (desde, hasta)."""
    return spark.range(1).select(F.lit(first).alias("desde"), F.lit(last).alias("hasta"))


def range_of(df: DataFrame, day: Column) -> DataFrame:
    """One-row range of the days found in a table (a single-column scan)."""
    return df.agg(F.min(F.to_date(day)).alias("desde"), F.max(F.to_date(day)).alias("hasta"))


def _literal_days(days) -> Column:
    return F.array(*[F.struct(F.lit(m).alias("m"), F.lit(d).alias("d"), F.lit(n).alias("n")) for m, d, n in days])


def holidays(years: DataFrame) -> DataFrame:
    """Default holiday table (fecha, nombre_feriado) for the years in column `ano`."""
    sunday = dates.easter(F.col("ano"))
    movable = [
        F.struct(F.date_sub(sunday, days).alias("fecha"), F.lit(name).alias("nombre_feriado"))
        for days, name in fv.HOLIDAYS_BEFORE_EASTER
    ]
    fixed = F.transform(
        _literal_days(fv.HOLIDAYS_BY_DAY),
        lambda h: F.struct(F.make_date("ano", h["m"], h["d"]).alias("fecha"), h["n"].alias("nombre_feriado")),
    )
    return years.select(F.inline(F.concat(fixed, F.array(*movable))))


def _whole_months(days: DataFrame) -> DataFrame:
    """Every day from the month before the range to the end of its last month."""
    start = F.add_months(F.trunc("desde", "MM"), -1)
    return days.select(F.explode(F.sequence(start, F.last_day("hasta"))).alias("fecha"))


def _years(days: DataFrame) -> DataFrame:
    first = F.year(F.add_months(F.trunc("desde", "MM"), -1))
    return days.select(F.explode(F.sequence(first, F.year("hasta"))).alias("ano"))


def business_flag(day: Column, is_holiday: Column, include_saturdays: bool) -> Column:
    """Monday to Friday without holidays; Saturday follows the switch alone, before the holiday test."""
    weekday = F.weekday(day)
    return F.when(weekday == 6, False).when(weekday == 5, include_saturdays).otherwise(~is_holiday)


def business_calendar(
    span: DataFrame, holiday_table: DataFrame | None = None, include_saturdays: bool = False
) -> DataFrame:
    """Calendar of the range (desde, hasta), with business-day numbers and month-on-month comparison dates."""
    closed = holidays(_years(span)) if holiday_table is None else holiday_table
    all_days = _whole_months(span).join(closed, "fecha", "left").select(
        "fecha",
        (F.year("fecha") * 12 + F.month("fecha")).alias("ym"),
        F.col("nombre_feriado").isNotNull().alias("es_feriado"),
        F.coalesce("nombre_feriado", F.lit("")).alias("nombre_feriado"),
        business_flag(F.col("fecha"), F.col("nombre_feriado").isNotNull(), include_saturdays).alias("es_dia_habil"),
    )
    # At most 31 days a month are collected per group.
    business_days = F.sort_array(F.collect_list(F.when(F.col("es_dia_habil"), F.col("fecha"))))
    months = all_days.groupBy("ym").agg(business_days.alias("habiles"))
    previous = months.select((F.col("ym") + 1).alias("ym"), F.col("habiles").alias("habiles_previos"))
    number = F.coalesce(F.nullif(F.array_position("habiles", F.col("fecha")), F.lit(0)), F.lit(0)).cast("int")
    same_number = F.coalesce(
        F.try_element_at("habiles_previos", F.col("dia_habil_del_mes")),
        F.try_element_at("habiles_previos", F.lit(-1)),
    )
    total = F.size("habiles")
    return (
        all_days.join(months, "ym")
        .join(previous, "ym")
        .withColumn("dia_habil_del_mes", number)
        .select(
            "fecha",
            F.year("fecha").alias("ano"),
            F.month("fecha").alias("mes"),
            F.day("fecha").alias("dia"),
            (F.weekday("fecha") + 1).alias("dia_semana"),
            "es_dia_habil",
            "dia_habil_del_mes",
            "es_feriado",
            "nombre_feriado",
            F.when(F.col("dia_habil_del_mes") > 0, same_number).alias("fecha_mismo_dia_habil_mes_anterior"),
            F.try_element_at("habiles", F.lit(-1)).alias("ultimo_dia_habil"),
            total.alias("total_dias_habiles_mes_actual"),
            F.size("habiles_previos").alias("total_dias_habiles_mes_anterior"),
            F.coalesce(F.round(F.try_divide("dia_habil_del_mes", total), 6), F.lit(0.0)).alias("progreso_mes_actual"),
        )
    )


def mapping(span: DataFrame, holiday_table: DataFrame | None = None, include_saturdays: bool = False) -> DataFrame:
    """Calendar rows of exactly the days in the range, the ten mapping columns."""
    cal = business_calendar(span, holiday_table, include_saturdays)
    inside = span.select(F.explode(F.sequence("desde", "hasta")).alias("fecha"))
    return cal.join(inside, "fecha", "left_semi").select(
        "fecha", "ano", "mes", "dia", "dia_semana", "es_dia_habil", "dia_habil_del_mes", "es_feriado",
        "nombre_feriado", "fecha_mismo_dia_habil_mes_anterior",
    )


def nth_business_day(calendar: DataFrame, n: int) -> DataFrame:
    """The n-th business day of each month that has one."""
    return calendar.where(F.col("dia_habil_del_mes") == n).select("ano", "mes", "fecha")


def month_summary(calendar: DataFrame) -> DataFrame:
    """Business days and last business day per month."""
    return calendar.groupBy("ano", "mes").agg(
        F.count_if("es_dia_habil").alias("dias_habiles"),
        F.max(F.when(F.col("es_dia_habil"), F.col("fecha"))).alias("ultimo_dia_habil"),
    )


def add_business_day_columns(df: DataFrame, day: str, calendar: DataFrame) -> DataFrame:
    """Five business-day columns for any table, by its date column."""
    columns = calendar.select(
        F.col("fecha").alias("_fecha"),
        "dia_habil_del_mes",
        "es_dia_habil",
        F.col("fecha_mismo_dia_habil_mes_anterior").alias("mismo_dia_habil_mes_anterior"),
        "dia_semana",
        F.date_format("fecha", "EEEE").alias("nombre_dia_semana"),
    )
    return df.join(columns, F.to_date(day) == F.col("_fecha"), "left").drop("_fecha")


def comparison_info(calendar: DataFrame) -> DataFrame:
    """Period-comparison fields per day."""
    previous = F.col("fecha_mismo_dia_habil_mes_anterior")
    return calendar.select(
        F.col("fecha").alias("fecha_objetivo"),
        "es_dia_habil",
        "dia_habil_del_mes",
        "total_dias_habiles_mes_actual",
        previous.alias("fecha_comparacion_mes_anterior"),
        "total_dias_habiles_mes_anterior",
        previous.isNotNull().alias("puede_comparar"),
        "progreso_mes_actual",
    )


def stored_calendar(span: DataFrame, holiday_table: DataFrame | None = None) -> DataFrame:
    """The stored business-day table over whole years: business days and holidays only.

    The comparison dates are the previous row with the same number, so a month without that number is skipped;
    holidays form one sequence of their own.
    """
    years = span.select(F.explode(F.sequence(F.year("desde"), F.year("hasta"))).alias("ano"))
    if holiday_table is None:
        listed = F.transform(
            _literal_days(fv.STORED_TABLE_HOLIDAYS),
            lambda h: F.struct(F.make_date("ano", h["m"], h["d"]).alias("fecha"), h["n"].alias("nombre_feriado")),
        )
        holiday_table = years.select(F.inline(listed))
    year_days = F.sequence(F.make_date("ano", F.lit(1), F.lit(1)), F.make_date("ano", F.lit(12), F.lit(31)))
    flagged = (
        years.select(F.explode(year_days).alias("FECHA"))
        .join(holiday_table.withColumnRenamed("fecha", "FECHA"), "FECHA", "left")
        .select(
            "FECHA",
            F.year("FECHA").cast("bigint").alias("AÑO"),
            F.month("FECHA").cast("bigint").alias("MES"),
            F.day("FECHA").cast("bigint").alias("DIA"),
            (~F.dayofweek("FECHA").isin(1, 7) & F.col("nombre_feriado").isNull()).alias("ES_DIA_HABIL"),
            F.date_format("FECHA", "EEEE").alias("NOMBRE_DIA_SEMANA"),
            F.col("nombre_feriado").isNotNull().alias("ES_FERIADO"),
            F.col("nombre_feriado").alias("NOMBRE_FERIADO"),
        )
        .where("ES_DIA_HABIL OR ES_FERIADO")
    )

    def number(*keys):
        window = W.partitionBy(*keys, "ES_DIA_HABIL").orderBy("FECHA")
        return F.when(F.col("ES_DIA_HABIL"), F.row_number().over(window).cast("bigint"))

    def previous(key):
        return F.lag("FECHA").over(W.partitionBy(key, "ES_DIA_HABIL").orderBy("FECHA"))

    return (
        flagged.withColumn("DIA_HABIL_DEL_MES", number("AÑO", "MES"))
        .withColumn("DIA_HABIL_DEL_AÑO", number("AÑO"))
        .withColumn("FECHA_MISMO_DIA_HABIL_MES_ANTERIOR", previous("DIA_HABIL_DEL_MES"))
        .withColumn("FECHA_MISMO_DIA_HABIL_AÑO_ANTERIOR", previous("DIA_HABIL_DEL_AÑO"))
    )
