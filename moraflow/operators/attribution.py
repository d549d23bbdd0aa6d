"""Payments matched to their latest assignment and to the last interaction before them."""

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from moraflow.functions import rules

GESTION = ["fecha_gestion", "CANAL", "OPERADOR_FINAL", "es_compromiso", "fecha_compromiso", "monto_compromiso"]
ASSIGNMENT = ["cod_luna", "CARTERA", "SERVICIO", "VENCIMIENTO", "CATEGORIA_VENCIMIENTO", "ID_ARCHIVO_ASIGNACION"]


def latest_assignment_by_document(debt: DataFrame, universe: DataFrame) -> DataFrame:
    """Latest assignment of each document, over all accounts its debt rows name.

    The choice does not depend on the payment. So the payment x debt x assignment chain is never built: accounts are
    reduced to their latest assignment, documents to the latest of their accounts, one row each.
    """
    order = F.struct("FECHA_ASIGNACION", "cuenta", *ASSIGNMENT)
    by_account = universe.groupBy(F.col("cuenta").cast("string").alias("cod_cuenta")).agg(F.max(order).alias("asig"))
    accounts_of = debt.select("nro_documento", "cod_cuenta").distinct()
    return (
        accounts_of.join(by_account, "cod_cuenta")
        .groupBy("nro_documento")
        .agg(F.max("asig").alias("asig"))
        .select("nro_documento", "asig.FECHA_ASIGNACION", *[f"asig.{c}" for c in ASSIGNMENT])
    )


def with_latest_assignment(payments: DataFrame, latest: DataFrame) -> DataFrame:
    """Each payment of a document with an assignment, once; every payment row is kept."""
    return payments.join(latest, "nro_documento")


def payment_chain(payments: DataFrame, debt: DataFrame, universe: DataFrame, dims: list[str]) -> DataFrame:
    """Rows and amount of the full payment x debt x assignment chain per dimension, from counts alone."""
    paid = payments.groupBy("nro_documento").agg(
        F.count(F.lit(1)).alias("q_pagos"), F.sum(rules.cents(F.col("monto_cancelado"))).alias("centavos")
    )
    owed = debt.groupBy("nro_documento", "cod_cuenta").agg(F.count(F.lit(1)).alias("q_deudas"))
    held = universe.groupBy(F.col("cuenta").cast("string").alias("cod_cuenta"), *dims).agg(
        F.count(F.lit(1)).alias("q_asignaciones")
    )
    links = F.col("q_deudas") * F.col("q_asignaciones")
    # Grouped to (document, dims) before payments come in: one row per document on both sides of that join.
    per_document = owed.join(held, "cod_cuenta").groupBy("nro_documento", *dims).agg(F.sum(links).alias("q_enlaces"))
    chain = per_document.join(paid, "nro_documento")
    return chain.groupBy(*dims).agg(
        F.sum(F.col("q_pagos") * F.col("q_enlaces")).alias("filas"),
        rules.from_cents(F.sum(F.col("centavos") * F.col("q_enlaces"))).alias("monto"),
    )


def last_interaction_by_day(harmonised: DataFrame) -> DataFrame:
    """Last interaction of each client and day."""
    # Ties on the timestamp are broken by the payload itself, so the result does not depend on row order.
    last = F.max(F.struct(*GESTION)).alias("gestion")
    return harmonised.groupBy("cod_luna", F.to_date("fecha_gestion").alias("dia")).agg(last)


def last_interaction_as_of(wanted: DataFrame, harmonised: DataFrame) -> DataFrame:
    """For each (cod_luna, dia) wanted: the last interaction on that day or before, null if none.

    Both sides are first reduced to one row per client and day with map-side combine, so the window over a client
    holds days, not interactions, however many rows the client has.
    """
    daily = last_interaction_by_day(harmonised).select("cod_luna", "dia", F.lit(0).alias("pregunta"), "gestion")
    asked = wanted.select("cod_luna", "dia").distinct()
    asked = asked.select("cod_luna", "dia", F.lit(1).alias("pregunta"), F.lit(None).alias("gestion"))
    upto = W.partitionBy("cod_luna").orderBy("dia", "pregunta").rowsBetween(W.unboundedPreceding, W.currentRow)
    return (
        daily.unionByName(asked)
        .withColumn("gestion", F.last("gestion", ignorenulls=True).over(upto))
        .where("pregunta = 1")
        .select("cod_luna", "dia", *[f"gestion.{c}" for c in GESTION])
    )


def with_last_interaction(payments: DataFrame, harmonised: DataFrame) -> DataFrame:
    """As-of join: each payment with the last interaction of its cod_luna up to the payment day, unmatched kept."""
    dated = payments.withColumn("dia", F.to_date("fecha_pago"))
    return dated.join(last_interaction_as_of(dated, harmonised), ["cod_luna", "dia"], "left").drop("dia")


def one_payment_per_document(payments: DataFrame) -> DataFrame:
    """The latest payment of each document (the reading that ranks rows by document instead of by payment)."""
    first = ["fecha_pago", "monto_cancelado"]
    others = [c for c in payments.columns if c not in first and c != "nro_documento"]
    latest = F.max(F.struct(*first, *others)).alias("pago")
    return payments.groupBy("nro_documento").agg(latest).select("nro_documento", "pago.*")
