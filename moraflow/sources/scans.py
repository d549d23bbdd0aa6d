"""Input scans. Id lists of any length are key DataFrames, applied as semi joins."""

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moraflow.functions import dates, rules


def periods_of_month(calendario: DataFrame, month: date, state: str) -> DataFrame:
    """Assignment periods that start in a month and are in a state (any case), newest first."""
    first = F.trunc(F.lit(month), "MM")
    start = F.col("FECHA_ASIGNACION")
    return calendario.where(
        (start >= first) & (start < F.add_months(first, 1)) & (F.upper("ESTADO") == state.upper())
    ).orderBy(F.desc("FECHA_ASIGNACION"), "ARCHIVO")


def period_files(calendario: DataFrame) -> DataFrame:
    """Assignment file names of the periods."""
    return calendario.select(F.concat("ARCHIVO", F.lit(".txt")).alias("archivo"))


def assignment_of_files(asignacion: DataFrame, files: DataFrame) -> DataFrame:
    """Assignment rows of the given files, with their load date."""
    return asignacion.join(files, "archivo", "left_semi").withColumn("fecha_carga", F.to_date("creado_el"))


def interactions_of_clients(gestiones: DataFrame, clients: DataFrame, first: date, last: date) -> DataFrame:
    """Interactions of the given cod_luna values on days in [first, last]; non-numeric documents are dropped."""
    return (
        gestiones.where(rules.within_days(F.col("date"), first, last))
        .withColumn("cod_luna", rules.safe_long(F.col("document")))
        .where(F.col("cod_luna").isNotNull())
        .drop("document")
        .join(clients.select("cod_luna").distinct(), "cod_luna", "left_semi")
    )


def debt_files(tran_deuda: DataFrame) -> DataFrame:
    return tran_deuda.select("archivo").distinct()


def debt_of_dates(tran_deuda: DataFrame, days: DataFrame, year: Column) -> DataFrame:
    """Debt rows of the files whose name carries one of the given dates (column `fecha`)."""
    return (
        tran_deuda.withColumn("fecha", dates.file_date(F.col("archivo"), year))
        .where(F.col("fecha").isNotNull())
        .join(days.select("fecha"), "fecha", "left_semi")
        .drop("fecha", "creado_el")
    )


def payments_of_documents(pagos: DataFrame, documents: DataFrame) -> DataFrame:
    """Payments of the documents present in the debt rows."""
    return pagos.join(documents.select("nro_documento").distinct(), "nro_documento", "left_semi")


def dated_debt(tran_deuda: DataFrame) -> DataFrame:
    """Debt rows with the date built from the file name; impossible dates are dropped."""
    built = dates.debt_date(F.col("archivo"), F.col("creado_el"))
    return tran_deuda.withColumn("fecha_deuda_construida", built).where(F.col("fecha_deuda_construida").isNotNull())
