"""The four fact tables: assigned universe, daily management, attributed recovery, executive KPIs."""

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moraflow.functions import fixed_values as fv
from moraflow.functions import rules
from moraflow.operators import attribution, periods


@dataclass(frozen=True)
class RunWindow:
    """Days the run covers (both ends included) and the reference day of the due categories."""

    first: date
    last: date
    as_of: date

    def covers(self, day: str):
        return F.col(day).between(F.lit(self.first), F.lit(self.last))


DUE_KEYS = ["CARTERA", "SERVICIO", "VENCIMIENTO", "CATEGORIA_VENCIMIENTO"]
UNIVERSE_KEYS = [
    "FECHA_ASIGNACION", "CARTERA", "SERVICIO", "SEGMENTO_GESTION", "VENCIMIENTO", "CATEGORIA_VENCIMIENTO",
    "ID_ARCHIVO_ASIGNACION", "ZONA_GEOGRAFICA", "TIPO_FRACCIONAMIENTO",
]
ACCOUNT_DIMS = [
    "CARTERA", "SERVICIO", "SEGMENTO_GESTION", "VENCIMIENTO", "CATEGORIA_VENCIMIENTO", "ZONA_GEOGRAFICA",
]
DAILY_KEYS = ["FECHA_SERVICIO", "CARTERA", *periods.RESPONSE, *ACCOUNT_DIMS[1:]]


def assigned_universe(asignacion: DataFrame, calendario: DataFrame, as_of: date) -> DataFrame:
    """Assignment rows within their period, with the reporting dimensions; dimensions are never null."""
    matched = periods.with_period(asignacion, periods.period_columns(calendario))
    return matched.select(
        "cod_luna",
        "cuenta",
        "cliente",
        "telefono",
        rules.or_default(F.col("negocio"), fv.NO_SERVICE).alias("SERVICIO"),
        rules.or_default(F.col("tramo_gestion"), fv.NO_SEGMENT).alias("SEGMENTO_GESTION"),
        rules.or_default(F.col("zona"), fv.NO_ZONE).alias("ZONA_GEOGRAFICA"),
        rules.or_default(F.col("min_vto"), fv.MISSING_DUE_DATE).alias("VENCIMIENTO"),
        rules.due_category(F.col("min_vto"), F.lit(as_of)).alias("CATEGORIA_VENCIMIENTO"),
        "FECHA_ASIGNACION",
        "FECHA_CIERRE",
        "FECHA_TRANDEUDA",
        "DIAS_GESTION",
        rules.or_default(F.col("cal_archivo"), fv.NO_FILE).alias("ID_ARCHIVO_ASIGNACION"),
        rules.portfolio(F.col("archivo"), alternates=False).alias("CARTERA"),
        rules.objective(F.col("tramo_gestion"), late_rate=False).alias("OBJ_RECUPERO"),
        rules.instalment_type(F.col("fraccionamiento")).alias("TIPO_FRACCIONAMIENTO"),
    )


def match_debt(universe: DataFrame, debt: DataFrame) -> DataFrame:
    """Assignment rows with the debt of their account on the debt date of their period.

    Debt is summed per account and date first, so the join keeps one row per assignment; `q_deudas` is the number of
    debt rows it stands for.
    """
    owed = debt.groupBy("cod_cuenta", "fecha_deuda_construida").agg(
        F.sum(rules.cents(F.col("monto_exigible"))).alias("centavos"),
        F.count(F.lit(1)).alias("q_deudas"),
    )
    keyed = universe.withColumn("cod_cuenta", F.col("cuenta").cast("string"))
    same = (keyed["cod_cuenta"] == owed["cod_cuenta"]) & (keyed["FECHA_TRANDEUDA"] == owed["fecha_deuda_construida"])
    return keyed.join(owed, same, "left").drop("cod_cuenta", "fecha_deuda_construida")


def universe_fact(
    universe: DataFrame, debt: DataFrame, window: RunWindow, dedupe_account: bool = False
) -> DataFrame:
    """Assigned accounts, clients and debt per portfolio dimension.

    An account with several assignment rows counts its debt once per row; `dedupe_account` keeps one row per account
    within each group of dimensions.
    """
    rows = match_debt(universe.where(window.covers("FECHA_ASIGNACION")), debt)
    if dedupe_account:
        one = [F.min(c).alias(c) for c in ("cliente", "OBJ_RECUPERO", "DIAS_GESTION", "centavos", "q_deudas")]
        rows = rows.groupBy(*UNIVERSE_KEYS, "cuenta").agg(*one)
    # An assignment row without debt still counts once in the averages, one with n debt rows n times.
    weight = F.greatest(F.coalesce("q_deudas", F.lit(1)), F.lit(1))

    def weighted_mean(c):
        known = F.when(F.col(c).isNotNull(), weight)
        total = F.sum(rules.millionths(F.col(c)) * weight).cast("double") / 1_000_000
        return rules.ratio(total, F.sum(known))

    return rows.groupBy(*UNIVERSE_KEYS).agg(
        weighted_mean("OBJ_RECUPERO").alias("OBJ_RECUPERO"),
        F.count_distinct("cuenta").alias("Q_CUENTAS_ASIGNADAS"),
        F.count_distinct("cliente").alias("Q_CLIENTES_ASIGNADOS"),
        rules.from_cents(F.sum("centavos")).alias("MONTO_EXIGIBLE_ASIGNADO"),
        weighted_mean("DIAS_GESTION").alias("DIAS_GESTION_DISPONIBLES"),
    )


def _first_of_client_days(daily: DataFrame, accounts: DataFrame) -> DataFrame:
    """The combination of dimensions under which the first interaction of each client's day is counted.

    The first response of a day is picked before the accounts come in, and the choice is a minimum with map-side
    combine: a client's day is never gathered in one task.
    """
    response = F.min(F.struct("primera", *periods.RESPONSE)).alias("primera")
    firsts = daily.groupBy("cod_luna", "FECHA_SERVICIO").agg(response)
    order = F.struct("primera", "primera_cuenta", *ACCOUNT_DIMS, "cod_luna", "FECHA_ASIGNACION")
    winners = periods.match_periods(firsts, accounts).groupBy("cliente", "FECHA_SERVICIO").agg(
        F.min(order).alias("elegida")
    )
    return winners.select(
        "cliente",
        "FECHA_SERVICIO",
        *[F.col(f"elegida.primera.{c}").alias(c) for c in periods.RESPONSE],
        *[F.col(f"elegida.{c}").alias(c) for c in ACCOUNT_DIMS],
    )


def daily_management(universe: DataFrame, harmonised: DataFrame, window: RunWindow) -> DataFrame:
    """Interactions of assigned clients per day and reporting dimension."""
    in_window = harmonised.where(rules.within_days(F.col("fecha_gestion"), window.first, window.last))
    daily = periods.daily_responses(in_window)
    accounts = periods.account_groups(universe, ACCOUNT_DIMS)
    n, zero = F.col("q_cuentas"), F.lit(0).cast("bigint")
    sums = ["q", "q_efectivos", "q_promesas", "centavos"]
    measured = periods.match_periods(daily, accounts).select(
        *DAILY_KEYS, "cliente", *[(F.col(c) * n).alias(c) for c in sums], zero.alias("q_primeras")
    )
    firsts = _first_of_client_days(daily, accounts).select(
        *DAILY_KEYS, "cliente", *[zero.alias(c) for c in sums], F.lit(1).cast("bigint").alias("q_primeras")
    )
    # Per client first, so that the distinct clients of the next step become a plain count.
    per_client = measured.unionByName(firsts).groupBy(*DAILY_KEYS, "cliente").agg(
        *[F.sum(c).alias(c) for c in [*sums, "q_primeras"]]
    )
    has_promise = F.col("cliente").isNotNull() & (F.col("q_promesas") > 0)
    total, effective, promises = F.sum("q"), F.sum("q_efectivos"), F.sum("q_promesas")
    amount = rules.from_cents(F.sum("centavos"))
    return per_client.groupBy(*DAILY_KEYS).agg(
        total.alias("Q_INTERACCIONES_TOTAL"),
        effective.alias("Q_CONTACTOS_EFECTIVOS"),
        promises.alias("Q_PROMESAS_DE_PAGO"),
        amount.alias("MONTO_COMPROMETIDO"),
        F.sum("q_primeras").alias("Q_CLIENTES_UNICOS_CONTACTADOS"),
        F.sum("q_primeras").alias("Q_CLIENTES_PRIMERA_VEZ_DIA"),
        F.count_if(has_promise).alias("Q_CLIENTES_CON_PROMESA"),
        rules.ratio(effective, total).alias("EFECTIVIDAD_CONTACTO"),
        rules.ratio(promises, total).alias("TASA_COMPROMISO"),
        rules.ratio(amount, promises).alias("MONTO_PROMEDIO_COMPROMISO"),
    )


def attributed_recovery(
    payments: DataFrame,
    debt: DataFrame,
    universe: DataFrame,
    harmonised: DataFrame,
    window: RunWindow,
    per_document: bool = False,
) -> DataFrame:
    """Payments credited to the last interaction on or before the payment day.

    One row per payment; `per_document` keeps a single payment of each document.
    """
    paid = payments.where(rules.within_days(F.col("fecha_pago"), window.first, window.last))
    if per_document:
        paid = attribution.one_payment_per_document(paid)
    latest = attribution.latest_assignment_by_document(debt, universe)
    credited = attribution.with_last_interaction(attribution.with_latest_assignment(paid, latest), harmonised)
    paid_on, contacted_on = F.to_date("fecha_pago"), F.to_date("fecha_gestion")
    promise, promised_for = F.col("es_compromiso"), F.col("fecha_compromiso")
    return credited.select(
        paid_on.alias("FECHA_PAGO"),
        "CARTERA",
        "SERVICIO",
        "VENCIMIENTO",
        "CATEGORIA_VENCIMIENTO",
        "ID_ARCHIVO_ASIGNACION",
        rules.or_default(F.col("CANAL"), fv.NO_PRIOR_CONTACT).alias("CANAL_ATRIBUIDO"),
        rules.or_default(F.col("OPERADOR_FINAL"), fv.NO_PRIOR_CONTACT).alias("OPERADOR_ATRIBUIDO"),
        contacted_on.alias("FECHA_GESTION_ATRIBUIDA"),
        promised_for.alias("FECHA_COMPROMISO"),
        F.col("monto_cancelado").alias("MONTO_PAGADO"),
        rules.paid_with_promise(promise).alias("ES_PAGO_CON_PDP"),
        rules.promise_was_live(promise, promised_for, paid_on).alias("PDP_ESTABA_VIGENTE"),
        rules.paid_on_time(promise, promised_for, paid_on).alias("PAGO_ES_PUNTUAL"),
        F.datediff(paid_on, contacted_on).cast("bigint").alias("DIAS_ENTRE_GESTION_Y_PAGO"),
        rules.attribution_score(promise, promised_for, paid_on, contacted_on).alias("EFECTIVIDAD_ATRIBUCION"),
    )


# ---- executive KPIs --------------------------------------------------------------------------

def _kpi_columns(rows: DataFrame, calculated_on: date) -> DataFrame:
    """Ratios over the totals, all-zero rows dropped."""
    accounts, owed, paid = F.col("UNIVERSO_CUENTAS"), F.col("UNIVERSO_MONTO"), F.col("MONTO_RECUPERADO")
    recovery = F.try_divide(paid, owed)
    return rows.where((accounts > 0) | (F.col("CUENTAS_CONTACTADAS") > 0) | (paid > 0)).select(
        F.lit(calculated_on).alias("FECHA_CALCULO"),
        *DUE_KEYS,
        "CANAL",
        "UNIVERSO_CUENTAS",
        "UNIVERSO_MONTO",
        "OBJ_RECUPERO_PROMEDIO",
        "CUENTAS_CONTACTADAS",
        rules.ratio(F.col("CUENTAS_CONTACTADAS"), accounts).alias("TASA_CONTACTABILIDAD"),
        "EFECTIVIDAD_PROMEDIO",
        "MONTO_COMPROMETIDO",
        "TASA_COMPROMISO_PROMEDIO",
        "MONTO_RECUPERADO",
        rules.ratio(paid, owed).alias("TASA_RECUPERACION"),
        rules.ratio(recovery, F.col("OBJ_RECUPERO_PROMEDIO")).alias("CUMPLIMIENTO_OBJETIVO"),
    )


def executive_kpis(universe_f: DataFrame, daily_f: DataFrame, recovery_f: DataFrame, window: RunWindow) -> DataFrame:
    """Universe, management and recovery side by side, each summed to the KPI key before the join."""
    assigned = universe_f.where(window.covers("FECHA_ASIGNACION")).groupBy(*DUE_KEYS).agg(
        F.sum("Q_CUENTAS_ASIGNADAS").alias("cuentas"),
        rules.money_sum(F.col("MONTO_EXIGIBLE_ASIGNADO")).alias("monto"),
        rules.mean_of(F.col("OBJ_RECUPERO")).alias("objetivo"),
    )
    managed = daily_f.where(window.covers("FECHA_SERVICIO")).groupBy(*DUE_KEYS, "CANAL").agg(
        F.sum("Q_CLIENTES_UNICOS_CONTACTADOS").alias("contactadas"),
        rules.mean_of(F.col("EFECTIVIDAD_CONTACTO")).alias("efectividad"),
        rules.money_sum(F.col("MONTO_COMPROMETIDO")).alias("comprometido"),
        rules.mean_of(F.col("TASA_COMPROMISO")).alias("tasa"),
    )
    recovered = recovery_f.where(window.covers("FECHA_PAGO")).groupBy(
        *DUE_KEYS, F.col("CANAL_ATRIBUIDO").alias("CANAL")
    ).agg(rules.money_sum(F.col("MONTO_PAGADO")).alias("recuperado"))
    rows = (
        managed.join(recovered, [*DUE_KEYS, "CANAL"], "full")
        .join(assigned, DUE_KEYS, "full")
        .select(
            *DUE_KEYS,
            rules.or_default(F.col("CANAL"), fv.CHANNEL_TOTAL).alias("CANAL"),
            rules.or_default(F.col("cuentas"), 0).alias("UNIVERSO_CUENTAS"),
            rules.or_default(F.col("monto"), 0.0).alias("UNIVERSO_MONTO"),
            rules.or_default(F.col("objetivo"), fv.OBJECTIVE_DEFAULT).alias("OBJ_RECUPERO_PROMEDIO"),
            rules.or_default(F.col("contactadas"), 0).alias("CUENTAS_CONTACTADAS"),
            rules.or_default(F.col("efectividad"), 0.0).alias("EFECTIVIDAD_PROMEDIO"),
            rules.or_default(F.col("comprometido"), 0.0).alias("MONTO_COMPROMETIDO"),
            rules.or_default(F.col("tasa"), 0.0).alias("TASA_COMPROMISO_PROMEDIO"),
            rules.or_default(F.col("recuperado"), 0.0).alias("MONTO_RECUPERADO"),
        )
    )
    return _kpi_columns(rows, window.first)


JOIN_KEYS = ["CARTERA", "SERVICIO", "CATEGORIA_VENCIMIENTO"]


def _side(fact: DataFrame, keys: dict, in_window, measures: dict, prefix: str) -> DataFrame:
    """Row count, count outside the window, and for each measure both sums, per key."""
    outside = F.coalesce(~in_window, F.lit(True))
    aggregates = [F.count(F.lit(1)).alias(f"{prefix}_n"), F.count_if(outside).alias(f"{prefix}_n_fuera")]
    for name, value in measures.items():
        exact = F.coalesce(value, F.lit(0)).cast("decimal(26,12)")
        aggregates.append(F.sum(exact).alias(f"{prefix}_{name}"))
        out = F.when(outside, exact).otherwise(F.lit(0).cast("decimal(26,12)"))
        aggregates.append(F.sum(out).alias(f"{prefix}_{name}_fuera"))
    return fact.groupBy(*JOIN_KEYS, *[v.alias(k) for k, v in keys.items()]).agg(*aggregates)


def _regroup(side: DataFrame, keys: dict, prefix: str) -> DataFrame:
    sums = [c for c in side.columns if c.startswith(f"{prefix}_")]
    return side.groupBy(*JOIN_KEYS, *[v.alias(k) for k, v in keys.items()]).agg(*[F.sum(c).alias(c) for c in sums])


def executive_kpis_row_product(
    universe_f: DataFrame, daily_f: DataFrame, recovery_f: DataFrame, window: RunWindow
) -> DataFrame:
    """KPIs as the row-level three-way full join of the facts gives them: sums repeat for each matched row, and the
    window admits a joined row when any of its three dates is inside.

    The rows of that join are never built. Within a join key every row of one fact meets every row of the other two, so
    each sum is the side's sum times the row counts of the others, less the same product over rows outside the window.
    A fact without the key takes part as one all-null row.
    """
    u = _side(
        universe_f, {"v_u": F.col("VENCIMIENTO")}, window.covers("FECHA_ASIGNACION"),
        {
            "cuentas": F.col("Q_CUENTAS_ASIGNADAS"),
            "monto": F.col("MONTO_EXIGIBLE_ASIGNADO"),
            "objetivo": F.coalesce("OBJ_RECUPERO", F.lit(fv.OBJECTIVE_DEFAULT)),
        },
        "u",
    )
    g = _side(
        daily_f, {"v_g": F.col("VENCIMIENTO"), "canal_g": F.col("CANAL")}, window.covers("FECHA_SERVICIO"),
        {
            "contactadas": F.col("Q_CLIENTES_UNICOS_CONTACTADOS"),
            "efectividad": F.col("EFECTIVIDAD_CONTACTO"),
            "comprometido": F.col("MONTO_COMPROMETIDO"),
            "tasa": F.col("TASA_COMPROMISO"),
        },
        "g",
    )
    r = _side(
        recovery_f, {"v_r": F.col("VENCIMIENTO"), "canal_r": F.col("CANAL_ATRIBUIDO")}, window.covers("FECHA_PAGO"),
        {"recuperado": F.col("MONTO_PAGADO")},
        "r",
    )
    # A later side's due date and channel only show where the earlier sides lack the key; elsewhere they are summed out.
    in_u = u.select(*JOIN_KEYS, F.lit(True).alias("en_u")).distinct()
    in_g = g.select(*JOIN_KEYS, F.lit(True).alias("en_g")).distinct()
    g = _regroup(
        g.join(in_u, JOIN_KEYS, "left"),
        {"v_g": F.when(F.col("en_u").isNull(), F.col("v_g")), "canal_g": F.col("canal_g")},
        "g",
    )
    r = _regroup(
        r.join(in_u, JOIN_KEYS, "left").join(in_g, JOIN_KEYS, "left"),
        {
            "v_r": F.when(F.col("en_u").isNull() & F.col("en_g").isNull(), F.col("v_r")),
            "canal_r": F.when(F.col("en_g").isNull(), F.col("canal_r")),
        },
        "r",
    )
    joined = u.join(g, JOIN_KEYS, "full").join(r, JOIN_KEYS, "full")

    def count(side, suffix):
        return F.coalesce(F.col(f"{side}_n{suffix}"), F.lit(1)).cast("decimal(12,0)")

    def product(side, name, suffix, missing):
        total = F.coalesce(F.col(f"{side}_{name}{suffix}"), F.lit(missing).cast("decimal(26,12)"))
        for other in "ugr":
            if other != side:
                total = (total * count(other, suffix)).cast("decimal(38,12)")
        return total

    def kept(side, name, missing=0):
        return product(side, name, "", missing) - product(side, name, "_fuera", missing)

    n = count("u", "") * count("g", "") * count("r", "")
    n = (n - count("u", "_fuera") * count("g", "_fuera") * count("r", "_fuera")).cast("decimal(38,0)")
    rows = joined.withColumn("n", n).where("n > 0").select(
        "CARTERA",
        "SERVICIO",
        F.coalesce("v_u", "v_g", "v_r", F.lit(fv.MISSING_DUE_DATE)).alias("VENCIMIENTO"),
        "CATEGORIA_VENCIMIENTO",
        F.coalesce("canal_g", "canal_r", F.lit(fv.CHANNEL_TOTAL)).alias("CANAL"),
        kept("u", "cuentas").cast("bigint").alias("UNIVERSO_CUENTAS"),
        kept("u", "monto").cast("double").alias("UNIVERSO_MONTO"),
        F.round(rules.ratio(kept("u", "objetivo", fv.OBJECTIVE_DEFAULT), F.col("n")), rules.MEAN_PLACES).alias("OBJ_RECUPERO_PROMEDIO"),
        kept("g", "contactadas").cast("bigint").alias("CUENTAS_CONTACTADAS"),
        F.round(rules.ratio(kept("g", "efectividad"), F.col("n")), rules.MEAN_PLACES).alias("EFECTIVIDAD_PROMEDIO"),
        kept("g", "comprometido").cast("double").alias("MONTO_COMPROMETIDO"),
        F.round(rules.ratio(kept("g", "tasa"), F.col("n")), rules.MEAN_PLACES).alias("TASA_COMPROMISO_PROMEDIO"),
        kept("r", "recuperado").cast("double").alias("MONTO_RECUPERADO"),
    )
    return _kpi_columns(rows, window.first)
