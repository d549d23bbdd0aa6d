"""Backfill of the due-date dimensions into facts written before they existed."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moraflow.functions import fixed_values as fv
from moraflow.functions import rules

GESTION_KEYS = ["CARTERA", "SERVICIO", "SEGMENTO_GESTION", "ZONA_GEOGRAFICA"]


def _categorised(fact: DataFrame, day: str) -> DataFrame:
    due = rules.or_default(F.col("VENCIMIENTO"), fv.MISSING_DUE_DATE)
    category = rules.due_category(due, F.col(day), sentinel=True)
    return fact.withColumns({"VENCIMIENTO": due, "CATEGORIA_VENCIMIENTO": category})


def backfill_universe(old: DataFrame, asignacion: DataFrame) -> DataFrame:
    """Universe rows with the earliest due date of their assignment file, category against the assignment day.

    The minimum is taken once per file and joined, in place of a lookup per row.
    """
    earliest = asignacion.groupBy(F.regexp_replace("archivo", r"\.txt$", "").alias("ID_ARCHIVO_ASIGNACION")).agg(
        F.min("min_vto").alias("VENCIMIENTO")
    )
    return _categorised(old.join(earliest, "ID_ARCHIVO_ASIGNACION", "left"), "FECHA_ASIGNACION")


def backfill_daily(old: DataFrame, universe: DataFrame) -> DataFrame:
    """Daily rows with the earliest due date of the universe rows of the same portfolio, service, segment and zone."""
    earliest = universe.groupBy(*GESTION_KEYS).agg(F.min("VENCIMIENTO").alias("VENCIMIENTO"))
    return _categorised(old.join(earliest, GESTION_KEYS, "left"), "FECHA_SERVICIO")
