"""Interactions within assignment periods, without materialising interaction x account pairs.

An interaction belongs to every account its client holds on that day, so a plain join emits
(interactions of a client) x (accounts of a client) rows. Here both sides are first grouped to what the facts need:
interactions to (client, day, response) with counts and sums, accounts to (client, period, dimensions) with a count.
Measures of a pair of groups are products of the two sides, so results are the same as those of the plain join, and a
client that holds a third of all rows is reduced on the map side before anything is shuffled by client.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moraflow.functions import fixed_values as fv
from moraflow.functions import rules

RESPONSE = ["CANAL", "OPERADOR_FINAL", "GRUPO_RESPUESTA", "NIVEL_1", "NIVEL_2"]


def with_period(asignacion: DataFrame, calendario: DataFrame, how: str = "inner") -> DataFrame:
    """Assignment rows with the columns of their calendar period, matched on the file name."""
    return asignacion.join(calendario, F.col("archivo") == F.concat(F.col("cal_archivo"), F.lit(".txt")), how)


def period_columns(calendario: DataFrame) -> DataFrame:
    """Calendar columns the assignment needs, with the file name out of the way of `archivo`."""
    return calendario.select(
        F.col("ARCHIVO").alias("cal_archivo"), "FECHA_ASIGNACION", "FECHA_CIERRE", "FECHA_TRANDEUDA", "DIAS_GESTION"
    )


def is_active(day: Column, opened: Column, closed: Column) -> Column:
    """Day lies in the period; an open period never ends."""
    return day.between(opened, F.coalesce(closed, F.lit(fv.OPEN_PERIOD_END)))


def daily_responses(harmonised: DataFrame) -> DataFrame:
    """Interactions per client, day and response, with the first timestamp of each group."""
    return harmonised.groupBy("cod_luna", F.to_date("fecha_gestion").alias("FECHA_SERVICIO"), *RESPONSE).agg(
        F.count(F.lit(1)).alias("q"),
        F.sum("es_contacto_efectivo").alias("q_efectivos"),
        F.sum("es_compromiso").alias("q_promesas"),
        F.sum(rules.cents(F.col("monto_compromiso"))).alias("centavos"),
        F.min("fecha_gestion").alias("primera"),
    )


def account_groups(universe: DataFrame, dims: list[str]) -> DataFrame:
    """Accounts per client, period and dimensions."""
    return universe.groupBy("cod_luna", "cliente", "FECHA_ASIGNACION", "FECHA_CIERRE", *dims).agg(
        F.count(F.lit(1)).alias("q_cuentas"),
        F.min("cuenta").alias("primera_cuenta"),
    )


def match_periods(interactions: DataFrame, accounts: DataFrame, day: str = "FECHA_SERVICIO") -> DataFrame:
    """Grouped interactions x grouped accounts of the same client, where the period covers the day."""
    return interactions.join(accounts, "cod_luna").where(
        is_active(F.col(day), F.col("FECHA_ASIGNACION"), F.col("FECHA_CIERRE"))
    )


def outside_period_count(interactions: DataFrame, accounts: DataFrame) -> DataFrame:
    """Number of interaction x account combinations whose day is outside the period, as one row."""
    outside = ~is_active(F.col("FECHA_SERVICIO"), F.col("FECHA_ASIGNACION"), F.col("FECHA_CIERRE"))
    joined = interactions.join(accounts, "cod_luna").where(outside)
    return joined.agg(F.coalesce(F.sum(F.col("q") * F.col("q_cuentas")), F.lit(0)).alias("casos"))


def clients_without_assignment(interactions: DataFrame, asignacion: DataFrame) -> DataFrame:
    """Interacted clients that no assignment row names."""
    return interactions.select("cod_luna").distinct().join(asignacion.select("cod_luna").distinct(), "cod_luna", "left_anti")


def first_of_day(harmonised: DataFrame) -> DataFrame:
    """First interaction of each client and day.

    A map-side combined minimum in place of a ranking window, so no client-day is sorted in one task.
    """
    first = F.min(F.struct("fecha_gestion", *RESPONSE)).alias("primera")
    return harmonised.groupBy("cod_luna", F.to_date("fecha_gestion").alias("FECHA_SERVICIO")).agg(first).select(
        "cod_luna", "FECHA_SERVICIO", "primera.*"
    )
